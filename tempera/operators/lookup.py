"""Many-to-one join against a table whose size is measured before the strategy is chosen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempera.session import measured

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 5_000_000


def may_broadcast(rows: int, size: int) -> bool:
    """Whether a table of so many rows and bytes is small enough."""
    return rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES


class Lookup:
    """A table with one row per key, measured once and joined any number of times.

    Within the size bound the table is broadcast and the other side is not shuffled.
    Beyond it both sides shuffle, and keys with more rows on the other side than a task should
    have are spread over salts: such a key gets as many buckets as its rows need, and only the
    table's rows of those keys are copied into their buckets.
    """

    def __init__(
        self,
        table: DataFrame,
        max_rows: int = MAX_BROADCAST_ROWS,
        max_bytes: int = MAX_BROADCAST_BYTES,
        rows_per_task: int = ROWS_PER_TASK,
    ):
        self.table, rows, size = measured(table)
        self.small = rows <= max_rows and size <= max_bytes
        self.rows_per_task = rows_per_task

    def join(self, df: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "left") -> DataFrame:
        """Join on ``{column of df: column of the table}``; ``take`` maps table columns to new names."""
        keys = {theirs: f"_key_{i}" for i, theirs in enumerate(on.values())}
        right = self.table.select(
            *[F.col(c).alias(k) for c, k in keys.items()], *[F.col(c).alias(n) for c, n in take.items()]
        )
        pairs = list(zip(on, keys.values(), strict=True))
        if self.small:
            same = [df[mine] == right[key] for mine, key in pairs]
            return df.join(F.broadcast(right), same, how).drop(*keys.values())
        return self._salted(df, right, pairs, how).drop(*keys.values())

    def _salted(self, df: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
        mine = [m for m, _ in pairs]
        counts = df.groupBy(*mine).agg(F.count("*").alias("_n")).filter(F.col("_n") > self.rows_per_task)
        buckets = F.ceil(F.col("_n") / self.rows_per_task).cast("int").alias("_salts")
        hot, *size = measured(counts.select(*[F.col(m).alias(f"_hot_{i}") for i, m in enumerate(mine)], buckets))
        hot = F.broadcast(hot) if may_broadcast(*size) else hot
        # The salt follows from the row itself, so a task that runs again puts it in the same
        # bucket. Rows that are copies in all columns share one; AQE's skew join splits those.
        hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        left = df.join(hot, [df[m] == hot[f"_hot_{i}"] for i, m in enumerate(mine)], "left").withColumn(
            "_salt", F.coalesce(F.pmod(F.xxhash64(*hashed), F.col("_salts")).cast("int"), F.lit(0))
        )
        left = left.select(*df.columns, "_salt")
        theirs = [k for _, k in pairs]
        spread = (
            right.join(hot, [right[k] == hot[f"_hot_{i}"] for i, k in enumerate(theirs)], "left")
            .withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
            .select(*right.columns, "_bucket")
        )
        same = [left[m] == spread[k] for m, k in pairs] + [left["_salt"] == spread["_bucket"]]
        return left.join(spread, same, how).drop("_salt", "_bucket")
