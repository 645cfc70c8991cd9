"""Rules over many users at once equal those over one; calls to the state do not grow with users."""

import json
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tempera.operators.sequence import step_function
from tempera.streaming.asof import ACTION, CHANGE, Meet
from tempera.streaming.stateful import Sessions, debouncing, sampling, session_rule, step_functions
from tempera.streaming.stretches import NEVER, Compose, in_order, no_idle_partitions


class Values:
    """A state variable that counts what is asked of it."""

    def __init__(self, handle):
        self.handle, self.rows = handle, {}

    def __getattr__(self, name):
        def ask(*args):
            self.handle.calls += 1
            if name == "exists":
                return bool(self.rows)
            if name in ("get", "getValue"):
                return self.rows.get(args[0] if args else None)
            if name in ("update", "updateValue"):
                self.rows[args[0] if name == "updateValue" else None] = args[-1]
            if name == "containsKey":
                return args[0] in self.rows
            if name == "removeKey":
                self.rows.pop(args[0], None)
            if name == "clear":
                self.rows.clear()
            return list(self.rows) if name == "keys" else None

        return ask


class Handle:
    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, *_):
        return Values(self)

    getMapState = getValueState

    def registerTimer(self, at):
        self.calls, self.timers = self.calls + 1, self.timers | {at}

    def deleteTimer(self, at):
        self.calls, self.timers = self.calls + 1, self.timers - {at}


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def table(users):
    """Sorted rows of several users and where each begins; ``users`` are lists of (time, mood, manual, reset)."""
    rows = [(f"u{u:03}", i, *r) for u, mine in enumerate(users) for i, r in enumerate(mine)]
    columns = ["_key", "event_id", "_at", "mood", "manual", "reset"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    return in_order(pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], columns))


def some_users(rnd, n=30, untimed=False):
    def row(at):
        return (None if untimed and rnd.random() < 0.2 else at, rnd.choice(["a", "b", None]), rnd.random() < 0.2, rnd.random() < 0.15)

    users = []
    for _ in range(n):
        times = sorted(rnd.randrange(60) for _ in range(rnd.randrange(1, 25)))
        users.append(sorted((row(t) for t in times), key=lambda r: (r[0] is None, r[0] or 0)))
    return users


@pytest.mark.parametrize("seed", range(20))
def test_step_functions_of_many_users(seed):
    rnd = random.Random(seed)
    users, gap = some_users(rnd), rnd.choice([1, 5, 15, 100])
    rows, starts = table(users)
    upto, leave, begin = step_functions(rows["_at"].to_numpy(), starts, gap)
    for mine, b, e in zip(users, begin, np.append(begin[1:], len(upto)), strict=True):
        expected = step_function(np.array([r[0] for r in mine]), gap)
        assert upto[b:e].tolist() == expected[0].tolist() and leave[b:e].tolist() == expected[1].tolist()
    far = [[(t + u * 2**57, "a", False, False) for t, *_ in mine] for u, mine in enumerate(users)]  # more than one line can hold
    rows, starts = table(far)
    assert step_functions(rows["_at"].to_numpy(), starts, gap)[2].tolist() == begin.tolist()


@pytest.mark.parametrize("seed", range(20))
def test_sampling_of_many_users(seed):
    rnd = random.Random(100 + seed)
    users, gap = some_users(rnd, untimed=True), rnd.choice([1, 5, 15, 100])
    rows, starts = table(users)
    states = [(rnd.choice([None, rnd.randrange(-20, 1)]),) for _ in users]
    rule = sampling(gap)
    kept, after = rule.folds(rows, starts, states).tolist(), []
    expected = []
    for (last,), mine in zip(states, users, strict=True):
        for at, *_ in mine:
            expected.append(at is None or last is None or at >= last + gap)
            last = at if expected[-1] and at is not None else last
        after.append((last,))
    assert kept == expected
    assert [rule.advance(s, x) for s, x in zip(states, rule.summaries(rows, starts), strict=True)] == after


@pytest.mark.parametrize("seed", range(20))
def test_debounce_of_many_users(seed):
    rnd = random.Random(200 + seed)
    users, count = some_users(rnd), rnd.randrange(1, 4)
    rows, starts = table(users)
    states = [(rnd.choice(["a", "b", "c", None]), rnd.randrange(0, count + 1), rnd.choice(["a", "c", None])) for _ in users]
    rule = debouncing(count)
    expected, after = [], []
    for (pending, run, sent), mine in zip(states, users, strict=True):
        for _, mood, by_hand, _ in mine:
            if not by_hand:
                run, pending = (run + 1 if mood == pending and run else 1), mood
            expected.append(by_hand or (run >= count and mood != sent))
            if by_hand or run >= count:
                sent = mood
        after.append((pending, min(run, count), sent))
    assert rule.folds(rows, starts, states).tolist() == expected
    assert [rule.advance(s, x) for s, x in zip(states, rule.summaries(rows, starts), strict=True)] == after


def summaries(rule, users, stretch):
    rows, starts = table(users)
    keys = [None if k == "u000" else k for k in rows["_key"].take(pa.array(starts)).to_pylist()]
    return pd.DataFrame({"key": keys, "stretch": stretch, "at": 10**6, "summary": rule.summaries(rows, starts)})


def stepped(processor, batches, watermark=0):
    handle = Handle()
    processor.init(handle)
    told = [r for batch in batches for out in processor.handleInputRows((0,), iter([batch]), Clock(watermark)) for r in out.itertuples(index=False)]
    return handle, told


def test_a_bucket_is_one_value():
    """Whether it has ten users or a thousand, among them one without a key."""
    calls = []
    for n in (10, 1000):
        users = [[(0, "a", False, False), (1, "a", False, False)]] * n
        rule, session = debouncing(2), session_rule(2, 10)
        handle, told = stepped(Compose(rule, 1000), [summaries(rule, users, s) for s in (0, 1)])
        assert len(told) == 2 * n and handle.timers == {2000}
        assert {json.loads(r.entry)[2] for r in told if r.stretch == 0} == {None}
        assert {json.loads(r.entry)[2] for r in told if r.stretch == 1} == {"a"}
        sessions, rows = stepped(Sessions(session, 1000, 2, 10), [summaries(session, users, s) for s in (0, 1)])
        assert {(r.version, r.detections, r.sends, tuple(r.history)) for r in rows[n:]} == {(2, 4, 1, ("a",) * 4)}
        assert None in {r.user_id for r in rows} and len(rows) == 2 * n
        calls += [(handle.calls, sessions.calls)]
    assert calls[0] == calls[1]


def test_only_silent_users_of_a_bucket_are_forgotten():
    rule = debouncing(1)
    processor = Compose(rule, 1000)
    first = summaries(rule, [[(0, "a", False, False)]] * 3, 0)
    handle, _ = stepped(processor, [first])
    later = first.iloc[1:].assign(at=5 * 10**6, stretch=1)
    list(processor.handleInputRows((0,), iter([later]), Clock(0)))
    assert handle.timers == {2000}
    list(processor.handleExpiredTimer((0,), Clock(2000), Clock(2000)))
    assert set(processor.known()) == {"u001", "u002"} and 6000 in handle.timers
    untimed = first.iloc[:1].assign(at=NEVER, stretch=2)
    list(processor.handleInputRows((0,), iter([untimed]), Clock(3000)))
    assert processor.known()[None][0] == 3001


def test_waiting_rows_of_a_bucket_are_one_value_for_a_stretch():
    calls = []
    for n in (10, 1000):
        columns = {"key": [None, *[f"u{i}" for i in range(1, n)]], "timed": True, "has_id": True, "kind": CHANGE, "action": None}
        change = pd.DataFrame({**columns, "at": 5, "id": range(n), "change": [json.dumps({"genre": f"g{i}"}) for i in range(n)]})
        action = pd.DataFrame({**columns, "kind": ACTION, "at": 5, "id": 2**60, "action": [str(i) for i in range(n)], "change": None})
        before = action.assign(at=4, action="early")
        meet, handle = Meet({"genre": "none"}, 1000), Handle()
        meet.init(handle)
        assert not list(meet.handleInputRows((0,), iter([pd.concat([action, change, before])]), Clock(0)))
        assert handle.timers == {1000}
        told = [r for out in meet.handleExpiredTimer((0,), Clock(1000), Clock(1000)) for r in out.itertuples(index=False)]
        got = {r.action: json.loads(r.change)["genre"] for r in told}
        assert got == {"early": "none", **{str(i): f"g{i}" for i in range(n)}} and len(told) == 2 * n
        calls.append(handle.calls)
    assert calls[0] == calls[1]


def test_no_more_partitions_than_buckets(spark):
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    with no_idle_partitions(spark, 3):
        assert spark.conf.get(name) == "3"
    with no_idle_partitions(spark, 10**6):
        assert spark.conf.get(name) == old
    assert spark.conf.get(name) == old
