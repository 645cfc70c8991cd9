"""Sampling, debounce and sessions on a stream, with state per user.

How rows are folded without holding all of a user is in ``stretches``; what is here works on all users of a bucket's
stretch at once, in NumPy. The state of a user is dropped once event time has moved ``idle_seconds`` past the user's last row, by default a month. Event time, unlike
processing time, lets a bounded stream end.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempera import dims
from tempera.operators.sequence import step
from tempera.streaming.stretches import (
    BUCKETS,
    DELAY,
    IDLE_SECONDS,
    NEVER,
    STRETCH_SECONDS,
    Compose,
    Rule,
    cut,
    over_stretches,
    run,
    segments,
    summaries_of,
)

# --- sampling -----------------------------------------------------------------------------


def _next_due(times: np.ndarray, starts: np.ndarray, gap: int) -> np.ndarray:
    """For each of the sorted times of several users the first of the same user at least ``gap`` later, or their number."""
    n, ends = len(times), np.append(starts[1:], len(times))
    after = np.full(n + 1, n)
    # Users are laid out one after the other on one line of time, as many at once as a number can tell apart.
    span = int(times.max() - times.min()) + gap + 1
    many = max(1, 2**62 // span)
    for low in range(0, len(starts), many):
        mine = starts[low : low + many]
        begin, end = mine[0], ends[min(low + many, len(starts)) - 1]
        line = times[begin:end] - times.min() + segments(mine - begin, end - begin) * span
        found = begin + np.searchsorted(line, line + gap)
        after[begin:end] = np.where(found < np.repeat(ends[low : low + many], np.diff(np.append(mine, end))), found, n)
    return after


def step_functions(times: np.ndarray, starts: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sequence.step_function`` of the sorted times of several users: its two columns, and where each user's rows begin."""
    new = np.append(True, times[1:] != times[:-1])
    new[starts] = True
    starts = np.cumsum(new)[starts] - 1
    times = times[new]
    after, place = _next_due(times, starts, gap)[:-1], np.arange(len(times))
    leave = np.where(after < len(times), after, place)
    while True:  # each round doubles the length of the jumps
        further = leave[leave]
        if np.array_equal(further, leave):
            break
        leave = further
    # Without steps due more than a gap after the first time, and with one step for equal outcomes in a row.
    user = segments(starts, len(times))
    used = place <= after[starts][user]
    last = np.append(user[1:] != user[:-1], True) | ~np.append(used[1:], False)
    used &= last | (leave != np.append(leave[1:], -1))
    return times[used], times[leave[used]], (np.cumsum(used) - used)[starts]


def _kept(times: np.ndarray, starts: np.ndarray, last: list[int | None], gap: int) -> np.ndarray:
    """Which of the sorted times of several users are kept, from the time of each kept last."""
    n, keep = len(times), np.zeros(len(times) + 1, bool)
    jump, ends = _next_due(times, starts, gap), np.append(starts[1:], n)
    first = [b if x is None else b + int(np.searchsorted(times[b:e], x + gap)) for b, e, x in zip(starts, ends, last, strict=True)]
    seen = np.array(first)[np.array(first) < ends]
    while len(seen):  # each round doubles the part of the chains that is known and the length of the jumps
        keep[seen] = True
        more = jump[seen]
        more = more[more < n]
        if not len(more):
            break
        seen, jump = np.append(seen, more), jump[jump]
    return keep[:n]


def _timed(rows: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which rows have a time, these times, which users have some, and where they begin among the times."""
    timed = rows["_at"].is_valid().to_numpy(zero_copy_only=False)
    times = rows["_at"].drop_null().to_numpy().astype(np.int64)
    counts = np.add.reduceat(timed.astype(np.int64), starts)
    some = np.flatnonzero(counts)
    return timed, times, some, (np.cumsum(counts) - counts)[some]


def sampling(gap: int) -> Rule:
    """The state is the last kept time. A stretch is a step function of it."""

    def summaries(rows: pa.Table, starts: np.ndarray) -> list[bytes]:
        _, times, some, begin = _timed(rows, starts)
        out = [b""] * len(starts)
        if len(times):
            upto, leave, begin = step_functions(times, begin, gap)
            ends = np.append(begin[1:], len(upto))
            both = np.stack([upto, leave])
            for user, b, e in zip(some.tolist(), begin.tolist(), ends.tolist(), strict=True):
                out[user] = both[:, b:e].tobytes()
        return out

    def advance(state: tuple, summary: bytes) -> tuple:
        upto, leave = np.frombuffer(summary, np.int64).reshape(2, -1)
        return (step(upto, leave, state[0], gap),)

    def folds(rows: pa.Table, starts: np.ndarray, states: list[tuple]) -> np.ndarray:
        timed, times, some, begin = _timed(rows, starts)
        keep = ~timed
        if len(times):
            keep[timed] = _kept(times, begin, [states[user][0] for user in some.tolist()], gap)
        return keep

    return Rule(summaries, advance, (None,), folds)


def stream_throttle(
    readings: DataFrame,
    gap_seconds: float = dims.SAMPLING_GAP_SECONDS,
    idle_seconds: float = IDLE_SECONDS,
    delay: str = DELAY,
    stretch_seconds: float = STRETCH_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keep a reading if the gap has passed since the last kept one of its user, or if it has no time."""
    return over_stretches(readings, "user_id", sampling(round(gap_seconds * 1e6)), idle_seconds, delay, stretch_seconds, buckets)


# --- debounce -----------------------------------------------------------------------------


def _flags(rows: pa.Table, name: str) -> np.ndarray:
    if name not in rows.column_names:
        return np.zeros(rows.num_rows, bool)
    return rows[name].cast(pa.bool_()).fill_null(False).to_numpy()


@dataclass(frozen=True)
class Detections:
    """The sorted moods of several users as codes, and the runs of equal moods among the detections of each.

    ``position`` counts a detection in its run within these rows; one in its user's ``lead`` run may go on a run before.
    """

    moods: list
    codes: np.ndarray
    by_hand: np.ndarray
    starts: np.ndarray

    def __post_init__(self):
        seen = np.flatnonzero(~self.by_hand)
        user, codes, number = self.user[seen], self.codes[seen], np.arange(len(seen))
        of_user = np.append(True, user[1:] != user[:-1])[: len(seen)]
        of_run = of_user | np.append(True, codes[1:] != codes[:-1])[: len(seen)]
        begun = np.maximum.accumulate(np.where(of_run, number, 0))
        object.__setattr__(self, "seen", seen)
        object.__setattr__(self, "position", number - begun + 1)
        object.__setattr__(self, "lead", begun == np.maximum.accumulate(np.where(of_user, number, 0)))

    @classmethod
    def of(cls, moods: pa.ChunkedArray | pa.Array, by_hand: np.ndarray, starts: np.ndarray) -> Detections:
        coded = pa.chunked_array([moods]) if isinstance(moods, pa.Array) else moods
        coded = coded.combine_chunks().dictionary_encode(null_encoding="encode")
        words = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        return cls(words, codes, by_hand, starts)

    @cached_property
    def user(self) -> np.ndarray:
        return segments(self.starts, len(self.codes))

    @cached_property
    def code(self) -> dict:
        return {mood: k for k, mood in enumerate(self.moods)}

    @cached_property
    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each user the places of the first and the last detection among ``seen``; -1 without any."""
        user, number = self.user[self.seen], np.arange(len(self.seen))
        first, last = np.full(len(self.starts), -1), np.full(len(self.starts), -1)
        first[user[::-1]] = number[::-1]
        last[user] = number
        return first, last

    def setters(self, before: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that set the mood sent last, if the lead run of each user goes on ``before`` detections, and of each
        row the one of its user that did so before it, or -1."""
        sets = self.by_hand.copy()
        sets[self.seen] = self.position + np.where(self.lead, before[self.user[self.seen]], 0) >= count
        last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
        last = np.append([-1], last[:-1])[: len(sets)]
        return sets, np.where(last >= self.starts[self.user], last, -1)

    def sends(self, states: list[tuple], count: int) -> np.ndarray:
        """Which rows are sent, from the pending mood, its run and the mood sent last of each user."""
        first, _ = self.ends
        opening = np.append(self.codes[self.seen], [-1])[first].tolist()
        runs = [r if r and k == self.code.get(p, -2) else 0 for k, (p, r, _) in zip(opening, states, strict=True)]
        sent = np.array([self.code.get(s[2], -2) for s in states])
        sets, before = self.setters(np.array(runs), count)
        return self.by_hand | (sets & (self.codes != np.where(before >= 0, self.codes[before], sent[self.user])))

    def summaries(self, fresh: np.ndarray, count: int) -> list[dict]:
        """What the rows of each user make of any state before them; sends are counted among the ``fresh`` rows.

        There is a lane for each run that may go before, 0 to ``count`` equal moods. The mood sent last before is unknown: at
        most one row is sent or not depending on it, the first that is confirmed, if none is sent by hand before it.
        """
        n, place = len(self.codes), np.arange(len(self.codes))
        first, last = self.ends
        words = [*self.moods, None]
        codes = np.append(self.codes[self.seen], [-1])
        opening, pending, some = codes[first].tolist(), codes[last].tolist(), (first >= 0).tolist()
        position, lead = np.append(self.position, [0])[last], np.append(self.lead, [False])[last]
        lanes = []
        for run_ in range(count + 1):
            sets, before = self.setters(np.full(len(self.starts), run_), count)
            known = before >= 0
            sent = fresh & (self.by_hand | (sets & known & (self.codes != self.codes[before])))
            setter = np.minimum.reduceat(np.where(sets, place, n), self.starts)
            final = np.maximum.reduceat(np.where(sets, place, -1), self.starts)
            asked = (setter < n) & ~np.append(self.by_hand, True)[setter]
            coded = np.append(self.codes, [-1])
            columns = (
                asked,
                coded[setter],
                np.append(fresh, False)[setter],
                np.add.reduceat(sent.astype(np.int64), self.starts),
                np.minimum(position + np.where(lead, run_, 0), count),
                final >= 0,
                coded[final],
            )
            lanes.append(list(zip(*(c.tolist() for c in columns), strict=True)))
        out = []
        for user, seen in enumerate(some):
            mood = words[pending[user]]
            said = [
                [[words[a], f] if asks else None, k, mood, r, known, words[s] if known else None]
                for asks, a, f, k, r, known, s in (lane[user] for lane in (lanes if seen else lanes[:1]))
            ]
            out.append({"seen": seen, "first": words[opening[user]], "lanes": said})
        return out


def _one_user(moods: np.ndarray, by_hand: np.ndarray) -> Detections:
    return Detections.of(pa.array(moods.tolist(), from_pandas=True), np.asarray(by_hand, bool), np.zeros(1, np.int64))


def sends(moods: np.ndarray, by_hand: np.ndarray, count: int, old: tuple[str | None, int, str | None]) -> tuple[np.ndarray, tuple]:
    """Which rows of one user are sent, and the pending mood, its run (up to ``count``) and the mood sent last after them."""
    if not len(moods):
        return np.zeros(0, bool), old
    every = np.ones(len(moods), bool)
    return _one_user(moods, by_hand).sends([old], count), debounce_step(old, debounce_summary(moods, by_hand, every, count), count)[0]


def debounce_summary(moods: np.ndarray, by_hand: np.ndarray, fresh: np.ndarray, count: int) -> dict:
    """What the sorted rows of one user make of any state before them."""
    return _one_user(moods, by_hand).summaries(np.asarray(fresh, bool), count)[0]


def debounce_step(state: tuple, summary: dict, count: int) -> tuple[tuple, int]:
    """The state after a stretch, and how many fresh rows of it were sent."""
    pending, run_, sent = state
    goes_on = summary["seen"] and run_ > 0 and pending == summary["first"]
    asked, n, pending_then, run_then, known, sent_then = summary["lanes"][min(run_, count) if goes_on else 0]
    if asked is not None and asked[0] != sent:
        n += asked[1]
    if summary["seen"]:
        pending, run_ = pending_then, run_then
    return (pending, run_, sent_then if known else sent), n


def debouncing(count: int) -> Rule:
    def summaries(rows: pa.Table, starts: np.ndarray) -> list[bytes]:
        found = Detections.of(rows["mood"], _flags(rows, "manual"), starts)
        return [json.dumps(s).encode() for s in found.summaries(np.ones(rows.num_rows, bool), count)]

    def advance(state: tuple, summary: bytes) -> tuple:
        return debounce_step(state, json.loads(summary), count)[0]

    def folds(rows: pa.Table, starts: np.ndarray, states: list[tuple]) -> np.ndarray:
        return Detections.of(rows["mood"], _flags(rows, "manual"), starts).sends(states, count)

    return Rule(summaries, advance, (None, 0, None), folds)


def stream_debounce(
    readings: DataFrame,
    count: int = dims.DEBOUNCE_COUNT,
    idle_seconds: float = IDLE_SECONDS,
    delay: str = DELAY,
    stretch_seconds: float = STRETCH_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Send a mood seen ``count`` times in a row that is not the one sent last.

    Rows flagged ``manual`` are sent at once and are no detections.
    """
    return over_stretches(readings, "user_id", debouncing(count), idle_seconds, delay, stretch_seconds, buckets)


# --- sessions -----------------------------------------------------------------------------

SESSION = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("detections", T.LongType()),
        T.StructField("sends", T.LongType()),
        T.StructField("history", T.ArrayType(T.StringType())),
        T.StructField("last_reading", T.TimestampNTZType()),
    ]
)


def session_rule(count: int, length: int) -> Rule:
    """A summary has the debounce of the stretch and the counters since its last reset."""

    def summaries(rows: pa.Table, starts: np.ndarray) -> list[bytes]:
        by_hand, cleared = _flags(rows, "manual"), _flags(rows, "reset")
        found = Detections.of(rows["mood"], by_hand, starts)
        place = np.arange(rows.num_rows)
        clears = np.maximum.reduceat(np.where(cleared, place, -1), starts)
        fresh = place > clears[found.user]
        new = fresh & ~by_hand
        at = np.maximum.reduceat(np.where(by_hand, NEVER, rows["_at"].fill_null(NEVER).to_numpy()), starts)
        moods = rows["mood"].to_pylist()
        told = np.flatnonzero(new & rows["mood"].is_valid().to_numpy(zero_copy_only=False))
        low = np.searchsorted(told, starts).tolist()
        high = [*low[1:], len(told)]
        told = told.tolist()
        columns = (low, high, clears.tolist(), np.add.reduceat(new.astype(np.int64), starts).tolist(), at.tolist())
        return [
            json.dumps(
                {
                    **summary,
                    "cleared": c >= 0,
                    "detections": n,
                    "history": [moods[i] for i in told[max(a, b - length) : b]],
                    "last": None if last == NEVER else last,
                }
            ).encode()
            for summary, a, b, c, n, last in zip(found.summaries(fresh, count), *columns, strict=True)
        ]

    return Rule(summaries, lambda state, _: state, (None, 0, None))


class Sessions(Compose):
    """Beside the debounce, a state has the version, the counters, the last reading and the last moods."""

    def __init__(self, rule: Rule, idle_ms: int, count: int, length: int):
        super().__init__(rule, idle_ms)
        self.count, self.length = count, length
        self.first = (*rule.start, 0, 0, 0, None, [])

    def passed(self, bucket: int, states: dict, found: list[tuple]) -> pd.DataFrame:
        for user in {f[0] for f in found}:
            state = list(states.get(user, self.first))
            state[3] += 1
            states[user] = tuple(state)
        for user, _, _, summary in found:
            *debounced, version, detections, sent, last, history = states[user]
            new = json.loads(summary)
            if new["cleared"]:
                detections, sent, history = 0, 0, []
            debounced, n = debounce_step(tuple(debounced), new, self.count)
            history = [*history, *new["history"]][-self.length :]
            last = max((t for t in (last, new["last"]) if t is not None), default=None)
            states[user] = (*debounced, version, detections + new["detections"], sent + n, last, history)
        rows = []
        for user in {f[0] for f in found}:
            _, _, _, version, detections, sent, last, history = states[user]
            rows.append((user, version, detections, sent, history, pd.NaT if last is None else pd.Timestamp(last, unit="us")))
        return pd.DataFrame(rows, columns=SESSION.names)


def stream_session(
    events: DataFrame,
    count: int = dims.DEBOUNCE_COUNT,
    length: int = dims.HISTORY_LENGTH,
    idle_seconds: float = IDLE_SECONDS,
    delay: str = DELAY,
    stretch_seconds: float = STRETCH_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The session of each user after every micro-batch that has rows of the user; the highest ``version``
    is the newest.

    Rows flagged ``manual`` are sent at once; the others are detections. A row flagged ``reset`` clears the
    counters and the history after it has counted itself; runs and the mood sent last go on.
    """
    rule = session_rule(count, length)
    summaries = summaries_of(cut(events, "user_id", stretch_seconds, buckets), rule, delay)
    found = run(summaries, Sessions(rule, int(idle_seconds * 1000), count, length), SESSION)
    return found.withColumn("user_id", F.col("user_id").cast(events.schema["user_id"].dataType))
