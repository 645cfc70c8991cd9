"""Per-user sequences: dominant label, sampling, runs, debounce, history, as-of values."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempera import dims
from tempera.functions.clock import micros
from tempera.functions.labels import mood_emoji
from tempera.operators.ordered import MAX_ROWS, PARTS, Ordered, over_sequence, split
from tempera.session import materialise

# --- one reading --------------------------------------------------------------------------


def dominant_emotion(readings: DataFrame, scores: str = "scores") -> DataFrame:
    """Adds ``mood`` and ``confidence``: the label with the highest score; the first on ties.

    NULL and NaN are no scores. Readings without any score are dropped: they are failed analyses.
    """
    ranked = F.transform(
        F.map_entries(scores), lambda e, i: F.struct(e["value"].alias("s"), (-i).alias("i"), e["key"].alias("k"))
    )
    best = F.array_max(F.filter(ranked, lambda e: e["s"].isNotNull() & ~F.isnan(e["s"])))
    return (
        readings.withColumn("_best", best)
        .filter("_best is not null")
        .withColumn("mood", F.col("_best.k"))
        .withColumn("confidence", F.col("_best.s"))
        .drop("_best")
    )


# --- sampling -----------------------------------------------------------------------------


def throttle(
    readings: DataFrame,
    gap_seconds: float = dims.SAMPLING_GAP_SECONDS,
    key: str = "user_id",
    ts: str = "ts",
    order_id: str = "event_id",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Keep a reading if at least ``gap_seconds`` passed since the last kept one of its key.

    The rule is a chain, so rows are folded in order. Spark shuffles and sorts; Python sees
    Arrow batches of sorted rows and holds one batch and one time. A key with too many
    rows is folded chunk by chunk at once: see ``_entries``. Readings without a time cannot be
    too close to any other, so all of them are kept.
    """
    gap = round(gap_seconds * 1e6)
    if gap <= 0:
        return readings
    timed = readings.withColumn("_at", micros(ts))
    untimed = timed.filter("_at is null").select(readings.columns)
    timed = timed.filter("_at is not null")
    out = None
    for part in split(timed, key, ("_at", order_id), max_rows):
        df = part.df
        if part.split:
            df = part.carried(df, _entries(part, gap)).withColumnRenamed("_carry", "_entry")
        else:
            df = df.withColumn("_entry", F.lit(None).cast("long"))
        ordered = df.withColumn("_first", F.row_number().over(part.window) == 1)
        kept = ordered.mapInArrow(_keep(gap), ordered.schema).select(*readings.columns)
        out = kept if out is None else out.unionByName(kept)
    return out.unionByName(untimed)


def chain(times: np.ndarray, gap: int) -> np.ndarray:
    """Positions of the first of the ascending ``times`` and of each next one at least ``gap`` after the one before.

    Every round doubles the part of the chain that is known and the length of the jumps.
    """
    n = len(times)
    jump = np.append(np.searchsorted(times, times + gap), n)
    seen = np.zeros(1, np.int64)
    while True:
        more = jump[seen]
        more = more[more < n]
        whole = len(more) == len(seen)
        seen = np.append(seen, more)
        if not whole:
            return seen
        jump = jump[jump]


def _keep(gap: int):
    """Filter of sorted batches; ``_first`` marks a new fold, which starts from ``_entry``.

    A reading at least one gap after the reading before it is kept whatever came earlier.
    Such readings are found at once; only the closer ones between them are followed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        due = None  # earliest time the next reading may be kept; None keeps any
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch.column("_at").to_numpy(zero_copy_only=False)
            first = batch.column("_first").to_numpy(zero_copy_only=False)
            known = batch.column("_entry").is_valid().to_numpy(zero_copy_only=False)
            entry = batch.column("_entry").fill_null(0).to_numpy(zero_copy_only=False)
            apart = np.append(True, np.diff(times) >= gap) | first
            begin = np.flatnonzero(apart)
            end = np.append(begin[1:], len(times))
            free = ~(first[begin] & known[begin])
            if not first[0]:
                free[0] = due is None
            kept = np.zeros(len(times), dtype=bool)
            kept[begin[free]] = True
            follow = (end - begin > 1) | ~free
            follow[-1] = True  # its last kept time goes on to the next batch
            for b, e, is_free in zip(begin[follow], end[follow], free[follow], strict=True):
                i = b
                if is_free:
                    due, i = int(times[b]) + gap, b + 1
                elif first[b]:
                    due = int(entry[b]) + gap
                i += int(np.searchsorted(times[i:e], due))
                if i < e:
                    chosen = i + chain(times[i:e], gap)
                    kept[chosen] = True
                    due = int(times[chosen[-1]]) + gap
            yield batch.filter(pa.array(kept))

    return run


def step_function(times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """What a stretch of ascending ``times`` makes of the last kept time before it.

    A time that is due up to ``upto[i]`` (and after ``upto[i - 1]``) leads to the last kept time ``leave[i]``; one due
    later leaves the last kept time as it is. Only times within one gap of the first can be the first kept one.
    """
    if not len(times):
        return times, times
    times = np.unique(times)
    after = np.searchsorted(times, times + gap)
    leave = np.where(after < len(times), after, np.arange(len(times)))
    while True:  # each round doubles the length of the jumps
        further = leave[leave]
        if np.array_equal(further, leave):
            break
        leave = further
    return _shortened(times, times[leave], int(times[0]) + gap)


def _shortened(upto: np.ndarray, leave: np.ndarray, latest: int) -> tuple[np.ndarray, np.ndarray]:
    """Without steps due after ``latest``, and with one step for equal outcomes in a row."""
    n = int(np.searchsorted(upto, latest)) + 1
    upto, leave = upto[:n], leave[:n]
    ends = np.append(leave[1:] != leave[:-1], True)
    return upto[ends], leave[ends]


def step(upto: np.ndarray, leave: np.ndarray, last: int | None, gap: int) -> int | None:
    """The last kept time after a stretch, from the one before it."""
    at = 0 if last is None else int(np.searchsorted(upto, last + gap))
    return int(leave[at]) if at < len(upto) else last


def composed(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], gap: int, start: int):
    """The step function of two stretches, one after the other, that begin at ``start``."""
    (upto, leave), (upto_2, leave_2) = first, second
    at = np.searchsorted(upto_2, leave + gap)
    through = np.where(at < len(upto_2), leave_2[np.minimum(at, len(upto_2) - 1)], leave)
    passed = upto_2 > upto[-1]
    return _shortened(np.append(upto, upto_2[passed]), np.append(through, leave_2[passed]), start + gap)


FAN = 4


def _entries(part: Ordered, gap: int) -> DataFrame:
    """For each chunk of a split key, the time of the last reading kept before the chunk.

    A chunk acts on that time as a step function, and so do several in a row. Functions of neighbouring chunks are composed
    in a tree, ``FAN`` at a time, until there is one per key; then the times are handed down the same tree. A task
    sees ``FAN`` functions, each with the readings of one gap at most, never all those of a key.
    """
    hot, chunk = PARTS
    numbers = [part.df.schema[hot], T.StructField(chunk, T.LongType())]
    held = [T.StructField("start", T.LongType()), T.StructField("upto", T.BinaryType()), T.StructField("leave", T.BinaryType())]
    held, carry = T.StructType([*numbers, *held]), T.StructType([*numbers, T.StructField("_carry", T.LongType())])

    def row(h, c, start: int, function: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
        upto, leave = (a.astype(np.int64).tobytes() for a in function)
        return pd.DataFrame({hot: [h], chunk: [c], "start": [start], "upto": [upto], "leave": [leave]})

    def functions(pdf: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.frombuffer(u, np.int64), np.frombuffer(v, np.int64)) for u, v in zip(pdf["upto"], pdf["leave"], strict=True)]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        times = np.unique(pdf["_at"].to_numpy())
        return row(pdf[hot].iloc[0], pdf[chunk].iloc[0], int(times[0]), step_function(times, gap))

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(chunk)
        start, (whole, *others) = int(pdf["start"].iloc[0]), functions(pdf)
        for function in others:
            whole = composed(whole, function, gap, start)
        return row(pdf[hot].iloc[0], pdf[chunk].iloc[0] // FAN, start, whole)

    def apart(parent: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(chunk)
        last = None if pd.isna(parent["_carry"].iloc[0]) else int(parent["_carry"].iloc[0])
        before = []
        for upto, leave in functions(pdf):
            before.append(last)
            last = step(upto, leave, last, gap)
        out = pd.DataFrame({hot: pdf[hot].to_numpy(), chunk: pdf[chunk].to_numpy()})
        return out.assign(_carry=pd.array(before, dtype="Int64"))

    levels = [materialise(part.df.select(*PARTS, "_at").groupBy(*PARTS).applyInPandas(one, held))]
    up = F.expr(f"{chunk} div {FAN}").alias("_up")
    while not levels[-1].groupBy(hot).count().filter("count > 1").isEmpty():
        levels.append(materialise(levels[-1].groupBy(hot, up).applyInPandas(together, held)))
    down = levels.pop().select(hot, chunk, F.lit(None).cast("bigint").alias("_carry"))
    while levels:
        children = levels.pop().groupBy(hot, up)
        parents = down.withColumnRenamed(chunk, "_up").groupBy(hot, "_up")
        down = materialise(parents.cogroup(children).applyInPandas(apart, carry))
    return down.select(hot, F.col(chunk).cast(part.df.schema[chunk].dataType).alias(chunk), "_carry")


# --- runs and debounce --------------------------------------------------------------------


def _runs(seq: Ordered, detection: Column) -> Ordered:
    """Adds ``run_position``, counted over detections only."""
    mood = F.struct("mood")
    seq = seq.last_known("_before", F.when(detection, mood), current=False)
    seq = seq.running_count("_seen", detection)
    starts = detection & (F.col("_before").isNull() | ~F.col("_before.mood").eqNullSafe(F.col("mood")))
    seq = seq.last_known("_start", F.when(starts, F.col("_seen")))
    seq = seq.with_column("run_position", F.when(detection, F.col("_seen") - F.col("_start") + 1))
    return Ordered(seq.df.drop("_before", "_seen", "_start"), seq.key, seq.order, seq.split)


def mood_runs(
    readings: DataFrame,
    key: str = "user_id",
    order: tuple[str, ...] = ("ts", "event_id"),
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Adds ``run_position``: how many equal moods in a row end with this reading."""
    return over_sequence(readings, key, order, lambda seq: _runs(seq, F.lit(True)), max_rows)


def debounce(
    readings: DataFrame,
    count: int = dims.DEBOUNCE_COUNT,
    key: str = "user_id",
    order: tuple[str, ...] = ("ts", "event_id"),
    manual: str | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Readings that are sent: mood seen ``count`` times in a row and not the one sent last.

    Rows flagged by ``manual`` are always sent and change what was sent last, but are no
    detections. No user state is needed: after any confirmed detection the mood sent last
    is its own, whether it was sent or not, so comparing with the last confirmed or
    manual row is enough. NULL is a mood like any other, except that it counts as sent before the first send.
    """
    by_hand = F.coalesce(F.col(manual), F.lit(False)) if manual else F.lit(False)

    def steps(seq: Ordered) -> Ordered:
        seq = _runs(seq, ~by_hand)
        confirmed = F.coalesce(F.col("run_position") >= count, F.lit(False))
        # In a struct, because a mood that was sent may itself be NULL. Before any, NULL counts as sent.
        seq = seq.last_known("_sent", F.when(by_hand | confirmed, F.struct("mood")), current=False)
        changed = ~F.col("_sent.mood").eqNullSafe(F.col("mood"))
        sent = seq.df.filter(by_hand | (confirmed & changed))
        return Ordered(sent.drop("_sent", "run_position"), seq.key, seq.order, seq.split)

    return over_sequence(readings, key, order, steps, max_rows)


# --- history ------------------------------------------------------------------------------


def mood_history(
    readings: DataFrame,
    key: str = "user_id",
    order: tuple[str, ...] = ("ts", "event_id"),
    length: int = dims.HISTORY_LENGTH,
    shown: int = dims.HISTORY_SHOWN,
    max_rows: int = MAX_ROWS,
    resets: DataFrame | None = None,
) -> DataFrame:
    """Adds ``history``, the last moods of the user, and ``history_text``, the newest as emoji.

    A reset forgets the readings up to its time.
    """
    known = readings.filter("mood is not null")
    if resets is None:
        out = over_sequence(known, key, order, lambda seq: seq.recent("history", F.col("mood"), length), max_rows)
    else:
        ts, order_id = order
        marked = known.withColumn("_kind", F.lit(0)).unionByName(
            resets.select(key, ts, order_id).withColumn("_kind", F.lit(1)), allowMissingColumns=True
        )

        def steps(seq: Ordered) -> Ordered:
            seq = seq.last_known("_since", F.when(F.col("_kind") == 1, F.col(order_id)))
            seq = Ordered(seq.df.filter("_kind = 0"), seq.key, seq.order, seq.split)
            return seq.recent("history", F.struct("mood", "_since"), length)

        out = over_sequence(marked, key, (ts, "_kind", order_id), steps, max_rows)
        mine = F.filter("history", lambda h: h["_since"].eqNullSafe(F.col("_since")))
        out = out.withColumn("history", F.transform(mine, lambda h: h["mood"])).select(*readings.columns, "history")
    newest = F.slice("history", F.greatest(F.size("history") - F.lit(shown - 1), F.lit(1)), shown)
    return out.withColumn("history_text", F.array_join(F.transform(newest, mood_emoji), " → "))


# --- as-of values -------------------------------------------------------------------------


def as_of(
    actions: DataFrame,
    changes: DataFrame,
    values: dict[str, object],
    key: str = "user_id",
    ts: str = "ts",
    order_id: str = "event_id",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Adds to each action the value in force at its time, for each of ``values``.

    ``values`` maps a column of ``changes`` to the value before any change. NULL in
    ``changes`` means that this value did not change. A change at the very time of an
    action counts.
    """
    marked = actions.withColumn("_kind", F.lit(1)).unionByName(
        changes.select(key, ts, order_id, *values).withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )

    def steps(seq: Ordered) -> Ordered:
        for name in values:
            seq = seq.last_known(f"_now_{name}", F.when(F.col("_kind") == 0, F.col(name)))
        return Ordered(seq.df.filter("_kind = 1"), seq.key, seq.order, seq.split)

    out = over_sequence(marked, key, (ts, "_kind", order_id), steps, max_rows)
    for name, initial in values.items():
        now = F.col(f"_now_{name}")
        out = out.withColumn(name, now if initial is None else F.coalesce(now, F.lit(initial)))
    return out.select(*actions.columns, *values)


def refresh_requests(
    clicks: DataFrame,
    detections: DataFrame,
    resets: DataFrame | None = None,
    max_rows: int = MAX_ROWS,
    find: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Refresh clicks re-send the latest detected mood by hand; without one nothing is sent.

    A reset forgets the detected mood. ``find`` is another ``as_of``, such as that of streams.
    """
    find = find or partial(as_of, max_rows=max_rows)
    mood = detections.select("user_id", "ts", "event_id", F.struct("mood").alias("_detected"))
    if resets is not None:
        nothing = F.struct(F.lit(None).cast("string").alias("mood")).alias("_detected")
        mood = mood.unionByName(resets.select("user_id", "ts", "event_id", nothing))
    seen = find(clicks, mood, {"_detected": None})
    return (
        seen.withColumn("mood", F.col("_detected.mood"))
        .filter("mood is not null")
        .withColumn("confidence", F.lit(dims.MANUAL_CONFIDENCE))
        .withColumn("manual", F.lit(True))
        .drop("_detected")
    )
