"""The interaction log and the score snapshots, replay-safe by run and batch.

A run is the life of one checkpoint: batch ids start at 0 in each. Every batch of every run is a folder of
its own, so a new checkpoint on an old log adds to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LOG_SCHEMA = "mood string, genre string, confidence double, language string, action_time timestamp_ntz"
PARTS_SCHEMA = (
    "mood string, genre string, confidence_sum double, confidence_count bigint, interaction_count bigint"
)
RUNS_SCHEMA = "number int, parent string, parent_batch bigint, run string"
FIRST_RUN = "0"


def write_batch(rows: DataFrame, root: str, batch_id: int, run: str = FIRST_RUN) -> None:
    """Write one batch. A replay replaces the batch, also when it is empty now."""
    rows.write.mode("overwrite").parquet(f"{root}/run={run}/batch_id={batch_id}")


def read_folder(spark: SparkSession, path: str, schema: str, root: str, recursive: bool = False) -> DataFrame | None:
    """The table in a folder; None if there is no folder."""
    try:
        reader = spark.read.schema(schema).option("recursiveFileLookup", str(recursive).lower())
        return (reader if recursive else reader.option("basePath", root)).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All batches with ``run`` and ``batch_id``; no rows, but the same columns, before the first write."""
    full = f"{schema}, run string, batch_id bigint"
    found = read_folder(spark, root, full, root)
    return spark.createDataFrame([], full) if found is None else found


def read_batch(spark: SparkSession, root: str, batch_id: int, schema: str, run: str = FIRST_RUN) -> DataFrame:
    """One batch alone: a single folder is listed, whatever the age of the log. A missing batch is an
    error."""
    path = f"{root}/run={run}/batch_id={batch_id}"
    found = read_folder(spark, path, schema, path)
    if found is None:
        raise FileNotFoundError(f"no batch {batch_id} of run {run} in {root}")
    return found


def begin_run(spark: SparkSession, root: str, run: str, newest: Callable[[], dict[str, int]]) -> tuple[str, int] | None:
    """Where a run goes on from: the ``newest`` committed batch of the run before it, or None for the
    first run.

    Decided once and written down, so that a replay goes on from the same place.
    """
    runs = read_folder(spark, root, RUNS_SCHEMA, root)
    known = {r["run"]: r for r in runs.collect()} if runs is not None else {}  # a row per checkpoint
    if run not in known:
        parent = None
        done = newest() if known else {}
        for r in sorted(known.values(), key=lambda r: r["number"]):
            if r["run"] in done:
                parent = (r["run"], done[r["run"]])
        row = (len(known), *(parent or (None, None)))
        spark.createDataFrame([row], "number int, parent string, parent_batch bigint").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{root}/run={run}")
        return parent
    mine = known[run]
    return None if mine["parent"] is None else (mine["parent"], mine["parent_batch"])

