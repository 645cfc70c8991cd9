"""Rules over the rows of a user in order, on a stream, by stretches that are folded in parallel.

The rows of a user in one micro-batch are cut into stretches of event time, and the users are dealt into buckets. Three
steps follow, none of which holds more than one stretch of a user's rows. Each works on a whole bucket at a time, so its
calls grow with buckets and stretches, not with users:

1. Each user's stretch becomes a summary: what it makes of any state before it. All stretches of all buckets at once.
2. Per bucket, the states of its users are passed through the summaries in order. This is the only stateful step; it sees a
   few numbers per stretch, and keeps the states as one value with an event timer that drops idle users.
3. Each user's stretch meets the state before it, and its rows are folded from there. All stretches at once.

Rows without a time come last in their micro-batch, in the order of their ids. Stretches that arrive after newer ones were folded
count in the order of arrival; one whose rows are all more than ``delay`` late is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tempera.functions.clock import micros

IDLE_SECONDS = 30 * 24 * 3600.0
DELAY = "1 hour"
STRETCH_SECONDS = 24 * 3600.0
UNTIMED_ROWS = 100_000  # ids of one stretch of rows without a time
UNTIMED = 2**61  # such stretches come after all others
#: Buckets of users, fixed for the life of a checkpoint. A micro-batch rewrites the states of the buckets it touches; take
#: as many as keep a bucket's states, and its rows of one stretch, at a size that a task holds with ease.
BUCKETS = 64
NEVER = -(2**62)  # for the time of a row without one
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"

State = tuple


@dataclass(frozen=True)
class Rule:
    """``summaries`` of the users of a stretch, ``advance`` a state through a summary, and ``folds``: which rows stay, from
    the state of each user before them. Rows are sorted by user, time and id; users begin at ``starts``. A state is a
    tuple of plain values."""

    summaries: Callable[[pa.Table, np.ndarray], list[bytes]]
    advance: Callable[[State, bytes], State]
    start: State
    folds: Callable[[pa.Table, np.ndarray, list[State]], np.ndarray] | None = None

    def summarise(self, rows: pd.DataFrame) -> bytes:
        """The summary of one user's sorted rows."""
        return self.summaries(pa.Table.from_pandas(rows, preserve_index=False), np.zeros(1, np.int64))[0]


def with_state_variables(spark: SparkSession) -> None:
    """State variables need the state store on disk; streams that start later use it too."""
    if spark.conf.get(STORE, None) != ROCKS:
        spark.conf.set(STORE, ROCKS)


@contextmanager
def no_idle_partitions(spark: SparkSession, buckets: int = BUCKETS) -> Iterator[None]:
    """A stream that starts here has no more partitions than buckets. Each partition of state starts a Python process in
    every micro-batch, also one that no bucket falls into."""
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    spark.conf.set(name, str(min(int(old), buckets)))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def cut(stream: DataFrame, key: str, seconds: float, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_at``, the microseconds of ``_event_time``, the number of the ``_stretch``, the ``_key`` as text and its ``_bucket``.

    A numeric key would come to Python as a float where a NULL one is beside it, and find no state.
    """
    width = round(seconds * 1e6)
    timed = stream.withColumn("_at", micros("ts")).withColumn("_event_time", F.unix_micros(F.col("ts").cast("timestamp")))
    by_time = F.expr(f"(_at - pmod(_at, {width}L)) div {width}L")
    by_id = F.expr(f"{UNTIMED}L + coalesce(try_cast(event_id as bigint) div {UNTIMED_ROWS}L, 0L)")
    keyed = timed.withColumn("_stretch", F.coalesce(by_time, by_id)).withColumn("_key", F.col(key).cast("string"))
    return keyed.withColumn("_bucket", bucket_of("_key", buckets))


def in_order(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows by user, time and id, NULLs last, and where each user begins."""
    user = rows["_key"].combine_chunks().dictionary_encode(null_encoding="encode").indices
    by = [(c, "ascending") for c in ("_user", "_at", "event_id")]
    order = pc.sort_indices(pa.table({"_user": user, "_at": rows["_at"], "event_id": rows["event_id"]}), sort_keys=by)
    numbers = user.take(order).to_numpy()
    return rows.take(order), np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))


def segments(starts: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` rows the number of its user."""
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))


def summaries_of(rows: DataFrame, rule: Rule, delay: str) -> DataFrame:
    """A row for every stretch of every user of the micro-batch; ``at`` has the time as a number."""
    schema = "bucket int, key string, stretch bigint, at bigint, summary binary"

    def one(group: pa.Table) -> pa.Table:
        group, starts = in_order(group)
        at = np.maximum.reduceat(group["_event_time"].fill_null(NEVER).to_numpy(), starts)
        firsts = group.select(["_bucket", "_key", "_stretch"]).take(pa.array(starts))
        columns = [*firsts.columns, pa.array(at), pa.array(rule.summaries(group, starts), pa.binary())]
        return pa.table(columns, ["bucket", "key", "stretch", "at", "summary"])

    found = rows.groupBy("_bucket", "_stretch").applyInArrow(one, schema)
    timed = found.withColumn("event_time", F.expr(f"timestamp_micros(nullif(at, {NEVER}L))"))
    return timed.withWatermark("event_time", delay)


class Compose(StatefulProcessor):
    """Passes the states of a bucket of users through the summaries of their stretches; forgets users that are silent.

    The bucket is one value: of each user the state, and until when it is kept. One timer waits for the first to go.
    """

    def __init__(self, rule: Rule, idle_ms: int):
        self.rule, self.idle_ms = rule, idle_ms
        self.first: State = rule.start

    def init(self, handle) -> None:
        self.handle = handle
        self.users = handle.getValueState("users", "users string")
        self.until = handle.getValueState("until", "until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = []
        for batch in rows:
            found += zip(*(batch[c].tolist() for c in ("key", "stretch", "at", "summary")), strict=True)
        found.sort(key=lambda r: r[1])
        users = self.known()
        states = {user: state for user, (_, state) in users.items()}
        yield self.passed(key[0], states, found)
        newest: dict = {}
        for user, _, at, _ in found:
            newest[user] = max(at, newest.get(user, NEVER))
        floor = timerValues.getCurrentWatermarkInMs() + 1
        for user, at in newest.items():
            last = floor if at == NEVER else at // 1000 + self.idle_ms
            users[user] = (max(last, floor, users[user][0] if user in users else floor), states[user])
        self.keep(users)

    def known(self) -> dict[str | None, tuple[int, State]]:
        rows = json.loads(self.users.get()[0]) if self.users.exists() else []
        return {user: (until, tuple(state)) for user, until, state in rows}

    def passed(self, bucket: int, states: dict, found: list[tuple]) -> pd.DataFrame:
        """The state before each stretch; ``states`` are moved on."""
        out = []
        for user, stretch, _, summary in found:
            state = states.get(user, self.first)
            out.append((bucket, user, stretch, json.dumps(state).encode()))
            states[user] = self.rule.advance(state, summary)
        return pd.DataFrame(out, columns=["bucket", "key", "stretch", "entry"])

    def keep(self, users: dict, fired: int | None = None) -> None:
        """Write the bucket, and move its timer to the first user to forget. A timer that has ``fired`` deletes itself."""
        old = self.until.get()[0] if self.until.exists() else None
        until = min((u for u, _ in users.values()), default=None)
        if until is None:
            self.users.clear()
            self.until.clear()
        else:
            self.users.update((json.dumps([(user, u, state) for user, (u, state) in users.items()]),))
            self.until.update((until,))
        if until != old:
            if old is not None and old != fired:
                self.handle.deleteTimer(old)
            if until is not None:
                self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(fired, timerValues.getCurrentWatermarkInMs())
        self.keep({user: kept for user, kept in self.known().items() if kept[0] > passed}, fired)
        return iter([])

    def close(self) -> None:
        pass


def run(summaries: DataFrame, processor: Compose, schema: str | T.StructType) -> DataFrame:
    with_state_variables(summaries.sparkSession)
    return summaries.groupBy("bucket").transformWithStateInPandas(processor, schema, "append", "EventTime")


def over_stretches(
    stream: DataFrame,
    key: str,
    rule: Rule,
    idle_seconds: float = IDLE_SECONDS,
    delay: str = DELAY,
    stretch_seconds: float = STRETCH_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows that ``rule.folds`` keeps, of every stretch of every user."""
    rows = cut(stream, key, stretch_seconds, buckets)
    processor = Compose(rule, int(idle_seconds * 1000))
    entries = run(summaries_of(rows, rule, delay), processor, "bucket int, key string, stretch bigint, entry binary")
    names = stream.columns

    def fold(group: pa.Table, before: pa.Table) -> pa.Table:
        if not group.num_rows or not before.num_rows:  # a stretch that came too late
            return group.select(names).slice(0, 0)
        known = dict(zip(before["key"].to_pylist(), before["entry"].to_pylist(), strict=True))
        group = group.filter(pc.is_in(group["_key"], before["key"].combine_chunks()))
        if not group.num_rows:
            return group.select(names)
        group, starts = in_order(group)
        states = [tuple(json.loads(known[user])) for user in group["_key"].take(pa.array(starts)).to_pylist()]
        return group.select(names).filter(pa.array(rule.folds(group, starts, states)))

    entries = entries.groupBy("bucket", "stretch")
    return rows.groupBy("_bucket", "_stretch").cogroup(entries).applyInArrow(fold, stream.schema)
