"""A live table of the newest row per key: a stream is upserted into hash buckets, replaced bucket by bucket.

A micro-batch is first cut to its newest row per key, in one aggregate that combines before the shuffle. Of the buckets that
it touches, the old rows are read, merged and written as a new version; the other buckets stay where they are. A manifest that
says which version each bucket has is written last, so a reader sees a batch whole or not at all, and a batch that runs
again starts from the manifest before it and writes the same. Rows are ordered by ``order``, so late and repeated rows change
nothing. NULL keys are one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempera.sources.commits import delete, folders
from tempera.sources.log import read_folder

BUCKETS = 64
MANIFEST = "bucket int, version bigint"


@dataclass(frozen=True)
class NewestPerKey:
    """``schema`` has the columns of the rows; of equal keys the row with the greatest ``order`` columns stays.

    ``buckets`` is fixed for the life of the table; take as many as keep one at a size that a task rewrites with ease.
    """

    root: str
    schema: str
    key: str
    order: tuple[str, ...]
    buckets: int = BUCKETS

    def newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c != self.key]
        best = F.max_by(F.struct(*rest), F.struct(*self.order)).alias("_newest")
        return rows.groupBy(self.key).agg(best).select(self.key, "_newest.*")

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Merge a micro-batch. Batches come in order, and one may come again until the next has."""
        spark = batch.sparkSession
        at = F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")
        mine = [f.name for f in spark.createDataFrame([], self.schema).schema]
        new = self.newest(batch.select(*mine)).withColumn("bucket", at).persist()
        try:
            touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}  # a row per bucket
            versions = self.versions(spark, batch_id - 1)
            old = self._rows(spark, {b: v for b, v in versions.items() if b in touched})
            merged = self.newest(old.unionByName(new.select(*mine))).withColumn("bucket", at)
            if touched:
                merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._version(batch_id))
            rows = sorted({**versions, **{b: batch_id for b in touched}}.items())
            table = spark.createDataFrame(rows, MANIFEST).coalesce(1)
            table.write.mode("overwrite").parquet(f"{self.root}/manifest/batch={batch_id}")
        finally:
            new.unpersist()

    def versions(self, spark: SparkSession, upto: int | None = None) -> dict[int, int]:
        """Version of every bucket after the newest batch, or after batch ``upto``."""
        done = [int(f.rsplit("=", 1)[1]) for f in folders(spark, f"{self.root}/manifest")]
        done = [b for b in done if upto is None or b <= upto]
        if not done:
            return {}
        path = f"{self.root}/manifest/batch={max(done)}"
        rows = read_folder(spark, path, MANIFEST, path)
        return {r["bucket"]: r["version"] for r in rows.collect()}

    def _version(self, version: int) -> str:
        return f"{self.root}/rows/version={version}"

    def _rows(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self._version(v)}/bucket={b}" for b, v in sorted(versions.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of every key, after the last batch that is whole."""
        return self._rows(spark, self.versions(spark))

    def expire(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete all that the last ``keep`` manifests do not name; a replay needs two."""
        done = sorted(int(f.rsplit("=", 1)[1]) for f in folders(spark, f"{self.root}/manifest"))
        needed = {(v, b) for batch in done[-keep:] for b, v in self.versions(spark, batch).items()}
        for batch in done[:-keep]:
            delete(spark, f"{self.root}/manifest/batch={batch}")
        for version in folders(spark, f"{self.root}/rows"):
            number = int(version.rsplit("=", 1)[1])
            if done and number <= done[-1]:
                for bucket in folders(spark, version):
                    if (number, int(bucket.rsplit("=", 1)[1])) not in needed:
                        delete(spark, bucket)

    def start(self, rows: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(self.upsert).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "2 seconds"})).start()
