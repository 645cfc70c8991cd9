"""Ordered computations per key that stay distributed when one key holds much of the table.

A window over ``partitionBy(user)`` puts all rows of a user into one task. Here the users
with more than ``max_rows`` rows are cut into consecutive chunks by a range shuffle on
(user, order), each chunk is a window partition of its own, and what a chunk must know of
the chunks before it arrives as one carried row per chunk. All other users take the plain
window, at one shuffle for any number of steps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera.operators.lookup import may_broadcast
from tempera.session import materialise, measured

MAX_ROWS = 5_000_000
PARTS = ["_hot", "_chunk"]


@dataclass(frozen=True)
class Ordered:
    """Rows with a key and a total order inside the key.

    If ``split``, the rows have the number of their key in ``_hot`` and of its chunk in
    ``_chunk``, and are partitioned and sorted by both: no step moves or sorts them again.
    """

    df: DataFrame
    key: str
    order: tuple[str, ...]
    split: bool = False

    @property
    def parts(self) -> list[str]:
        return PARTS if self.split else [self.key]

    @property
    def window(self) -> WindowSpec:
        return W.partitionBy(*self.parts).orderBy(*self.order)

    def with_column(self, name: str, value: Column) -> Ordered:
        return replace(self, df=self.df.withColumn(name, value))

    def last_known(self, name: str, value: Column, current: bool = True) -> Ordered:
        """Newest non-NULL ``value`` up to this row, or before it if not ``current``.

        Wrap a value that may itself be NULL in a struct.
        """
        df = self.df.withColumn("_value", value)
        frame = self.window.rowsBetween(W.unboundedPreceding, 0 if current else -1)
        out = df.withColumn(name, F.last("_value", ignorenulls=True).over(frame))
        if self.split:
            position = F.when(F.col("_value").isNotNull(), F.struct(*self.order))
            before = W.partitionBy("_hot").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
            tails = df.groupBy(*self.parts).agg(F.max_by("_value", position).alias("_tail"))
            carry = tails.withColumn("_carry", F.last("_tail", ignorenulls=True).over(before)).drop("_tail")
            out = self.carried(out, carry).withColumn(name, F.coalesce(name, "_carry")).drop("_carry")
        return replace(self, df=out.drop("_value"))

    def running_count(self, name: str, flag: Column) -> Ordered:
        """Rows up to and including this one for which ``flag`` holds."""
        df = self.df.withColumn("_one", F.when(flag, 1).otherwise(0))
        out = df.withColumn(name, F.sum("_one").over(self.window.rowsBetween(W.unboundedPreceding, 0)))
        if self.split:
            before = W.partitionBy("_hot").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
            sums = df.groupBy(*self.parts).agg(F.sum("_one").alias("_sum"))
            carry = sums.withColumn("_carry", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
            out = self.carried(out, carry).withColumn(name, F.col(name) + F.col("_carry")).drop("_carry")
        return replace(self, df=out.drop("_one"))

    def recent(self, name: str, value: Column, length: int) -> Ordered:
        """The last ``length`` values up to this row, oldest first."""
        df = self.df.withColumn("_value", value)
        out = df.withColumn(name, F.collect_list("_value").over(self.window.rowsBetween(1 - length, 0)))
        if self.split:
            newest = W.partitionBy(*self.parts).orderBy(*[F.desc(c) for c in self.order])
            ends = df.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") < length)
            tails = ends.groupBy(*self.parts).agg(
                F.sort_array(F.collect_list(F.struct((-F.col("_age")).alias("age"), "_value"))).alias("_tail")
            )
            # Every chunk has a row, so the last length - 1 rows lie in the last length - 1 chunks. Only as many
            # values go on, however many those chunks have together.
            before = W.partitionBy("_hot").orderBy("_chunk").rowsBetween(1 - length, -1)
            tails = tails.withColumn("_all", F.flatten(F.collect_list("_tail").over(before))["_value"])
            first = F.greatest(F.size("_all") - F.lit(length - 2), F.lit(1))
            carry = tails.withColumn("_carry", F.slice("_all", first, length - 1)).drop("_all")
            out = self.carried(out, carry.drop("_tail"))
            joined = F.concat(F.coalesce("_carry", F.array()), F.col(name))
            start = F.greatest(F.size("_joined") - F.lit(length - 1), F.lit(1))
            out = out.withColumn("_joined", joined).withColumn(name, F.slice("_joined", start, length))
            out = out.drop("_carry", "_joined")
        return replace(self, df=out.drop("_value"))

    def carried(self, out: DataFrame, carry: DataFrame) -> DataFrame:
        """Join the carried value of each chunk.

        A small table is broadcast, which keeps the order of the rows for the next step. A large one is shuffled
        to the chunks; the rows stay where they are, as they are partitioned and sorted by chunk already.
        """
        other, *size = measured(carry.select(*[F.col(p).alias(f"_{p}") for p in PARTS], "_carry"))
        if may_broadcast(*size):
            other = F.broadcast(other)
        return out.join(other, [out[p] == other[f"_{p}"] for p in PARTS], "left").drop(*[f"_{p}" for p in PARTS])


def split(df: DataFrame, key: str, order: tuple[str, ...], max_rows: int = MAX_ROWS) -> list[Ordered]:
    """Plain rows and, when some key has too many rows for one task, its chunked rows.

    ``order`` must end in a unique column: then any run of rows can be cut, even one with
    equal times. A chunk has about ``max_rows`` rows, whatever the size of the table.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows)
    if counts.isEmpty():  # most tables: nothing is written for them
        return [Ordered(df, key, order)]
    hot, *size = measured(counts.withColumn("_hot", F.monotonically_increasing_id()))
    rows = hot.agg(F.sum("_n")).first()[0]
    listed = F.broadcast(hot.drop("_n")) if may_broadcast(*size) else hot.drop("_n")
    same = df[key].eqNullSafe(listed["_key"])
    cold = df.join(listed, same, "left_anti")
    chunks = -(-rows // max_rows) + 1
    pieces = (
        df.join(listed, same)
        .drop("_key")
        .repartitionByRange(chunks, "_hot", *order)
        .withColumn("_chunk", F.spark_partition_id())
    )
    # Written once: the cut points come from a sample, and every pass must see the same ones.
    placed = materialise(pieces).repartition(*PARTS).sortWithinPartitions(*PARTS, *order)
    return [Ordered(cold, key, order), Ordered(placed, key, order, True)]


def over_sequence(
    df: DataFrame,
    key: str,
    order: tuple[str, ...],
    steps: Callable[[Ordered], Ordered],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Apply ``steps`` to the rows of every key in order, whatever the size of a key."""
    done = [steps(part).df.drop(*PARTS) for part in split(df, key, order, max_rows)]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
