"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 1000
#: What separates words: space and the ASCII controls from tab to carriage return.
SPACES = r"\x20\x09-\x0D"


def col(name: str) -> Column:
    """A column by its exact name, also if the name has dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Only ``doc_id`` and the whole text (NULL: empty); whatever else the table has cannot clash."""
    return docs.select(col(id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))


def bytes_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    """As ``text_of``, with the text as UTF-8 bytes: Python then need not decode it."""
    return lean(text_of(docs, id, text).withColumn("text", F.col("text").cast("binary")))


def lean(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends Python no more than ``BATCH_ROWS`` rows at once unless it sets a
    number itself.

    Spark's own number is made for narrow rows: ten thousand whole texts fill buffers on both sides.
    """
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if conf.get(name) == "10000":
        conf.set(name, str(BATCH_ROWS))
    return df


def words(text: Column) -> Column:
    """Runs of characters other than ``SPACES``; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), lambda w: w != "")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the values of ``column`` have about ``limit`` bytes in a piece, whole rows
    always."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(sizes):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(sizes):
            yield batch.slice(start)
