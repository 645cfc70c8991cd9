"""Sequences against brute force, with and without keys that are split over tasks."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempera.operators import sequence
from tempera.operators.ordered import over_sequence, split

START = dt.datetime(2024, 1, 1)
SPLIT = 40  # rows per key from which a key is split in these tests
SIZES = pytest.mark.parametrize("max_rows", [10**6, SPLIT])


def readings(seed=1, rows=900, seconds=40, moods=("happy", "sad", "angry")):
    """One user has more than a third of the rows; moods repeat in runs; some times are equal."""
    rnd = random.Random(seed)
    out, clock, last = [], 0, {}
    for i in range(rows):
        user = "hot" if rnd.random() < 0.4 else f"u{rnd.randrange(25)}"
        clock += rnd.choice([0, 1, 1, 2, seconds // 4])
        mood = last.get(user, "happy") if rnd.random() < 0.6 else rnd.choice(moods)
        last[user] = mood
        out.append((i, user, START + dt.timedelta(seconds=clock), mood, rnd.random() < 0.1))
    return out


def frame(spark, rows):
    schema = "event_id bigint, user_id string, ts timestamp_ntz, mood string, manual boolean"
    return spark.createDataFrame(rows, schema).repartition(5)


def by_user(rows):
    users = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        users[row[1]].append(row)
    return users


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def sent_ids(rows, count, manual):
    out = []
    for mine in by_user(rows).values():
        pending, run, sent = None, 0, None
        for event, _, _, mood, by_hand in mine:
            by_hand = by_hand and manual
            if not by_hand:
                run = run + 1 if mood == pending else 1
                pending = mood
            if by_hand or (run >= count and mood != sent):
                sent = mood
                out.append(event)
    return sorted(out)


def kept_ids(rows, gap):
    out = []
    for mine in by_user(rows).values():
        last = None
        for event, _, ts, *_ in mine:
            if last is None or (ts - last).total_seconds() >= gap:
                last = ts
                out.append(event)
    return sorted(out)


def test_hot_key_is_cut_into_bounded_chunks(spark):
    rows = readings()
    cold, hot = split(frame(spark, rows), "user_id", ("ts", "event_id"), SPLIT)
    assert [r.user_id for r in hot.df.select("user_id").distinct().collect()] == ["hot"]
    assert cold.df.filter("user_id = 'hot'").count() == 0
    sizes = [r["count"] for r in hot.df.groupBy("_chunk").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 3 * SPLIT
    edges = hot.df.groupBy("_chunk").agg(F.min(F.struct("ts", "event_id")), F.max(F.struct("ts", "event_id")))
    ends = sorted(tuple(e)[1:] for e in edges.collect())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert cold.df.count() + hot.df.count() == len(rows)


@SIZES
def test_runs(spark, max_rows):
    rows = readings(2)
    expected = {}
    for mine in by_user(rows).values():
        pending, run = None, 0
        for event, _, _, mood, _ in mine:
            run = run + 1 if mood == pending else 1
            pending = mood
            expected[event] = run
    out = sequence.mood_runs(frame(spark, rows), max_rows=max_rows).collect()
    assert {r.event_id: r.run_position for r in out} == expected


@SIZES
@pytest.mark.parametrize("count", [1, 2, 3])
@pytest.mark.parametrize("manual", [None, "manual"])
def test_debounce(spark, max_rows, count, manual):
    rows = readings(3)
    out = sequence.debounce(frame(spark, rows), count, manual=manual, max_rows=max_rows)
    assert ids(out) == sent_ids(rows, count, manual)


def test_long_run_crosses_many_chunks(spark):
    rows = [(i, "hot", START + dt.timedelta(seconds=i), "sad" if i == 250 else "happy", False) for i in range(500)]
    out = sequence.mood_runs(frame(spark, rows), max_rows=30)
    assert {r.event_id: r.run_position for r in out.collect()} == {
        i: i + 1 if i < 250 else 1 if i == 250 else i - 250 for i in range(500)
    }
    assert ids(sequence.debounce(frame(spark, rows), max_rows=30)) == [1]


def test_debounce_by_hand(spark):
    moods = ["a", "a", "b", "a", "b", "b", "b", "a", "a"]
    rows = [(i, "u", START + dt.timedelta(seconds=i), m, i == 2) for i, m in enumerate(moods)]
    # 1 confirmed; 2 sent by hand; 3 continues the run of a and differs from b; 5 confirmed; 8 confirmed
    assert ids(sequence.debounce(frame(spark, rows), manual="manual")) == [1, 2, 3, 5, 8]


@SIZES
@pytest.mark.parametrize("gap", [1, 10, 37, 100000])
def test_throttle(spark, max_rows, gap):
    rows = readings(4)
    out = sequence.throttle(frame(spark, rows), gap, max_rows=max_rows)
    assert ids(out) == kept_ids(rows, gap)


@pytest.mark.parametrize("step,gap", [(1, 10), (1, 7), (3, 10), (10, 10), (0, 5)])
def test_throttle_of_a_regular_hot_user(spark, step, gap):
    """Chains from different starts never meet here, so every chunk depends on the ones before."""
    rows = [(i, "hot", START + dt.timedelta(seconds=step * i), "m", False) for i in range(400)]
    assert ids(sequence.throttle(frame(spark, rows), gap, max_rows=30)) == kept_ids(rows, gap)


@pytest.mark.parametrize("step,gap", [(1, 100), (1, 333), (0.5, 60)])
def test_throttle_of_a_dense_hot_user(spark, step, gap):
    """The gap spans many chunks; their steps pass in small batches, and no task folds a key at once."""
    rows = [(i, "hot", START + dt.timedelta(seconds=step * i), "m", False) for i in range(1200)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert ids(sequence.throttle(frame(spark, rows), gap, max_rows=20)) == kept_ids(rows, gap)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@SIZES
def test_null_moods_are_moods(spark, max_rows):
    rows = [r if r[0] % 4 else (*r[:3], None, r[4]) for r in readings(9, moods=("happy", None))]
    out = sequence.mood_runs(frame(spark, rows), max_rows=max_rows).collect()
    expected = {}
    for mine in by_user(rows).values():
        pending, run = None, 0
        for event, _, _, mood, _ in mine:
            run, pending = (run + 1 if mood == pending else 1), mood
            expected[event] = run
    assert {r.event_id: r.run_position for r in out} == expected
    for count in (1, 2):
        out = sequence.debounce(frame(spark, rows), count, manual="manual", max_rows=max_rows)
        assert ids(out) == sent_ids(rows, count, "manual")


def test_null_moods_between_others(spark):
    rows = [(i, "u", START + dt.timedelta(seconds=i), m, False) for i, m in enumerate(["a", None, "b"])]
    assert sorted((r.event_id, r.run_position) for r in sequence.mood_runs(frame(spark, rows)).collect()) == [(0, 1), (1, 1), (2, 1)]
    assert ids(sequence.debounce(frame(spark, rows))) == []


def test_throttle_keeps_readings_without_a_time(spark):
    rows = readings(10, 50) + [(100 + i, "hot", None, "m", False) for i in range(5)]
    kept = ids(sequence.throttle(frame(spark, rows), 10))
    assert [i for i in kept if i >= 100] == [100, 101, 102, 103, 104]
    assert [i for i in kept if i < 100] == kept_ids(readings(10, 50), 10)


def test_throttle_is_a_chain_and_not_a_window(spark):
    rows = [(i, "u", START + dt.timedelta(seconds=s), "m", False) for i, s in enumerate([0, 9, 11, 19, 20, 21, 31])]
    assert ids(sequence.throttle(frame(spark, rows), 10)) == [0, 2, 5, 6]


def test_throttle_without_gap_keeps_all(spark):
    rows = readings(5, 50)
    assert ids(sequence.throttle(frame(spark, rows), 0)) == list(range(50))


@SIZES
def test_history(spark, max_rows):
    rows = readings(6)
    expected = {}
    for mine in by_user(rows).values():
        for n, row in enumerate(mine):
            expected[row[0]] = [r[3] for r in mine[max(0, n - 9) : n + 1]]
    out = sequence.mood_history(frame(spark, rows), max_rows=max_rows).collect()
    assert {r.event_id: r.history for r in out} == expected
    shown = {"happy": "😊", "sad": "😢", "angry": "😠"}
    assert {r.event_id: r.history_text for r in out} == {
        e: " → ".join(shown[m] for m in h[-5:]) for e, h in expected.items()
    }


@SIZES
def test_history_with_resets(spark, max_rows):
    rows = readings(13)
    df = frame(spark, rows)
    resets = df.filter("event_id % 17 = 3").select("event_id", "user_id", "ts")
    expected = {}
    for mine in by_user(rows).values():
        for row in mine:
            cleared = [r[2] for r in mine if r[0] % 17 == 3 and r[2] < row[2]]
            fresh = [r for r in mine if r <= row or (r[2], r[0]) <= (row[2], row[0])]
            fresh = [r for r in fresh if not cleared or r[2] > cleared[-1]]
            expected[row[0]] = [r[3] for r in fresh][-10:]
    out = sequence.mood_history(df, max_rows=max_rows, resets=resets).collect()
    assert {r.event_id: r.history for r in out} == expected


@pytest.mark.parametrize("seed", range(20))
def test_chain(seed):
    rnd = random.Random(seed)
    times = np.array(sorted(rnd.randrange(200) for _ in range(rnd.randrange(1, 60))))
    gap, kept = rnd.randrange(1, 40), [0]
    for i, t in enumerate(times):
        if t >= times[kept[-1]] + gap:
            kept.append(i)
    assert sequence.chain(times, gap).tolist() == kept


@pytest.mark.parametrize("seed", range(30))
def test_step_functions_compose(seed):
    """Stretches one after the other, in any grouping, act as their rows do; the gap may exceed them by far."""
    rnd = random.Random(seed)
    times = np.array(sorted(rnd.randrange(300) for _ in range(rnd.randrange(2, 80))))
    gap = rnd.choice([1, 5, 40, 150, 1000])
    cuts = sorted(rnd.sample(range(1, len(times)), min(len(times) - 1, rnd.randrange(1, 9))))
    pieces = np.split(times, cuts)
    functions = [sequence.step_function(p, gap) for p in pieces]
    half = len(pieces) // 2

    def whole(fs, start):
        out = fs[0]
        for f in fs[1:]:
            out = sequence.composed(out, f, gap, start)
        return out

    left, right = whole(functions[: half or 1], int(times[0])), functions[half or 1 :]
    both = sequence.composed(left, whole(right, int(right[0][0][0])), gap, int(times[0])) if right else left
    for before in [None, *range(int(times[0]) - gap - 3, int(times[0]) + 1, max(1, gap // 9))]:
        last = before
        for t in times:
            if last is None or t >= last + gap:
                last = int(t)
        assert sequence.step(*both, before, gap) == last
        one_by_one = before
        for f in functions:
            one_by_one = sequence.step(*f, one_by_one, gap)
        assert one_by_one == last


def test_no_task_sees_all_steps(spark, monkeypatch):
    """With a gap far above a chunk, no composition gets more than ``FAN`` functions."""
    rows = [(i, "hot", START + dt.timedelta(seconds=i), "m", False) for i in range(900)]
    _, hot = split(frame(spark, rows).withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp"))), "user_id", ("_at", "event_id"), 20)
    chunks = hot.df.select("_chunk").distinct().count()
    assert chunks > sequence.FAN**2
    entries = {r["_chunk"]: r["_carry"] for r in sequence._entries(hot, 400 * 10**6).collect()}
    assert len(entries) == chunks
    first = {r["_chunk"]: r["at"] for r in hot.df.groupBy("_chunk").agg(F.min("_at").alias("at")).collect()}
    start = min(first.values())
    for chunk, at in first.items():
        past = (at - start) // 10**6
        want = None if past == 0 else start + (past - 1) // 400 * 400 * 10**6
        assert entries[chunk] == want


def test_history_over_tiny_chunks(spark):
    rows = [(i, "hot", START + dt.timedelta(seconds=i), f"m{i % 7}", False) for i in range(60)]
    out = sequence.mood_history(frame(spark, rows), max_rows=2).collect()
    assert {r.event_id: r.history for r in out} == {
        i: [f"m{j % 7}" for j in range(max(0, i - 9), i + 1)] for i in range(60)
    }


@SIZES
def test_as_of(spark, max_rows):
    rows = readings(7)
    df = frame(spark, rows)
    clicks = df.filter("event_id % 3 = 0").drop("mood", "manual")
    changes = df.filter("event_id % 3 <> 0").select(
        "event_id", "user_id", "ts", F.when(~F.col("manual"), F.col("mood")).alias("genre")
    )
    out = sequence.as_of(clicks, changes, {"genre": "none"}, max_rows=max_rows).collect()
    expected = {}
    for mine in by_user(rows).values():
        for event, _, ts, *_ in mine:
            if event % 3 == 0:
                known = [r[3] for r in mine if r[0] % 3 and r[2] <= ts and not r[4]]
                expected[event] = known[-1] if known else "none"
    assert {r.event_id: r.genre for r in out} == expected


@SIZES
def test_refresh_with_resets(spark, max_rows):
    rows = readings(8)
    df = frame(spark, rows)
    kind = F.col("event_id") % 5
    out = sequence.refresh_requests(
        df.filter(kind == 0).select("event_id", "user_id", "ts"),
        df.filter(kind > 1),
        df.filter(kind == 1).select("event_id", "user_id", "ts"),
        max_rows=max_rows,
    ).collect()
    expected = {}
    for mine in by_user(rows).values():
        for event, _, ts, *_ in mine:
            if event % 5 == 0:
                before = [r for r in mine if r[0] % 5 and r[2] <= ts]
                if before and before[-1][0] % 5 > 1:
                    expected[event] = before[-1][3]
    assert {r.event_id: r.mood for r in out} == expected
    assert all(r.manual and r.confidence == 100 for r in out)


def test_null_key_is_a_group(spark):
    rows = [(i, None if i % 2 else "u", START + dt.timedelta(seconds=i), "m", False) for i in range(100)]
    df = frame(spark, rows)
    for max_rows in (10**6, 20):
        out = over_sequence(df, "user_id", ("ts", "event_id"), lambda s: s.running_count("n", F.lit(True)), max_rows)
        assert {r.event_id: r.n for r in out.collect()} == {i: i // 2 + 1 for i in range(100)}


def test_dominant_emotion(spark):
    """The first label wins a tie; a reading without any score is a failed one."""
    nan = float("nan")
    rows = [(1, [3.0, 5.0]), (2, [5.0, 5.0]), (3, [None, nan]), (4, None), (5, [None, 1.0]), (6, [2.0, nan])]
    df = spark.createDataFrame(rows, "id int, s array<double>").selectExpr(
        "id", "map_from_arrays(array('happy', 'sad'), s) as scores"
    )
    out = sequence.dominant_emotion(df).collect()
    assert {r.id: (r.mood, r.confidence) for r in out} == {
        1: ("sad", 5.0),
        2: ("happy", 5.0),
        5: ("sad", 1.0),
        6: ("happy", 2.0),
    }


def test_plain_sequences_shuffle_once(spark):
    plan = sequence.debounce(frame(spark, readings()).drop("manual"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Sort [") == 1
