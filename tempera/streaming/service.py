"""The serving job: a stream of action messages to playlists, log and learned scores."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempera import dims
from tempera.operators.learn import merge_parts, score_parts, scores_from_parts, stats_from_parts
from tempera.operators.lookup import Lookup
from tempera.operators.parse import clean_requests, parse_actions, rejection
from tempera.operators.publish import interactions, playlist_payload
from tempera.operators.recommend import learned_genres
from tempera.plans.serve import SEED, answer_wishes, serve
from tempera.sources.commits import commit, newest_batches
from tempera.sources.log import FIRST_RUN, LOG_SCHEMA, PARTS_SCHEMA, begin_run, read_batch, write_batch

PLAYLIST_SCHEMA = f"request string, user_id string, value string, primary_genre string, {LOG_SCHEMA}"
REJECTED_SCHEMA = "value string, reason string"
STATS_SCHEMA = (
    "total_interactions bigint, moods_learned bigint, genres_seen bigint, top_mood string, top_genre string, "
    "batch_rows bigint"
)


#: Outputs of a service that ``commits.compact`` keeps whole, and the one of which the newest snapshots are enough.
OUTPUTS = {"playlists": PLAYLIST_SCHEMA, "rejected": REJECTED_SCHEMA, "log": LOG_SCHEMA, "stats": STATS_SCHEMA}
SNAPSHOTS = ("scores",)


@dataclass(frozen=True)
class Service:
    """Handler of micro-batches. Everything it writes is one folder per run and batch, replaced on replay.

    All requests of a batch see the scores as they were before the batch. So a replay of the batch reads the
    same snapshot and writes the same rows. A run is the life of one checkpoint; a new one goes on from the
    newest snapshot of those before. ``key`` names a column that identifies a message, such as its place in
    a topic; without it a message is known by its text and how often that occurred in the batch before.
    ``deliver`` sends the playlist messages on, for instance to a topic. It does so before the batch is committed: a
    batch that stops in between is sent again, with the same ``request`` in each message's row, by which
    ``sources.topics.received_once`` drops repeats.
    """

    root: str
    cells: Lookup
    seed: str = SEED
    integer_confidence: bool = False
    stats_every: int = dims.STATS_EVERY
    deliver: Callable[[DataFrame], None] | None = None
    key: str | None = None

    def handle(self, messages: DataFrame, batch_id: int, run: str = FIRST_RUN) -> None:
        spark = messages.sparkSession
        before = scores_before(spark, self.root, batch_id, run)
        named = [F.col(self.key).cast("string").alias("_name")] if self.key else []
        text = F.col("value").cast("string")
        raw = messages.select(text.alias("value"), text.alias("_text"), *named)
        # Parsed once for all that follows.
        batch = parse_actions(raw, integer_confidence=self.integer_confidence).withColumn("reason", rejection())
        batch = batch.withColumn("_part", F.spark_partition_id()).persist()
        try:
            # The rows of the batch are counted while the rejected ones are written.
            seen = Observation()
            observed = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
            rejected = observed.filter("reason is not null").select(F.col("_text").alias("value"), "reason")
            write_batch(rejected, f"{self.root}/rejected", batch_id, run)
            if not seen.get["rows"]:
                write_batch(before, f"{self.root}/scores", batch_id, run)
                commit(spark, self.root, batch_id, ["rejected", "scores"], run)
                return
            requests = self._named(clean_requests(batch))
            learned = learned_genres(scores_from_parts(before))
            served = serve(requests, answer_wishes(requests, learned, self.cells), "request", self.seed)
            rows = served.select(
                "request",
                "user_id",
                playlist_payload().alias("value"),
                "primary_genre",
                "mood",
                "genre",
                F.col("confidence").cast("double").alias("confidence"),
                "language",
                "action_time",
            )
            write_batch(rows, f"{self.root}/playlists", batch_id, run)
            # Read back, so that log and delivery do not serve the batch a second time.
            written = read_batch(spark, f"{self.root}/playlists", batch_id, PLAYLIST_SCHEMA, run)
            outputs = learn_batch(interactions(written), self.root, batch_id, self.stats_every, run, seen.get["rows"])
            if self.deliver:
                self.deliver(written)
            commit(spark, self.root, batch_id, ["rejected", "playlists", *outputs], run)
        finally:
            batch.unpersist()

    def _named(self, requests: DataFrame) -> DataFrame:
        """Adds ``request``. Equal texts, such as heartbeats, are counted per partition; then each partition knows where
        its own start, and no task gets all of one text."""
        if self.key:
            return requests.withColumn("request", F.col("_name"))
        rows = requests.withColumn("_same", F.md5("_text"))
        counts = rows.groupBy("_same", "_part").agg(F.count(F.lit(1)).alias("_n"))
        before = W.partitionBy("_same").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        starts = counts.select("_same", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        here = F.row_number().over(W.partitionBy("_same", "_part").orderBy(F.lit(0)))
        named = rows.join(starts, ["_same", "_part"]).withColumn("_number", F.col("_start") + here)
        return named.withColumn("request", F.concat_ws("-", "_same", "_number"))

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start serving; the default trigger is a micro-batch every two seconds."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            self.handle(batch, batch_id, run_of(batch.sparkSession, checkpoint))

        return (
            messages.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 seconds"}))
            .start()
        )


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps over restarts; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def scores_before(spark: SparkSession, root: str, batch_id: int, run: str = FIRST_RUN) -> DataFrame:
    """The snapshot that a batch starts from. Only the first batch of the first run has none; a lost one is
    an error."""
    if batch_id > 0:
        return read_batch(spark, f"{root}/scores", batch_id - 1, PARTS_SCHEMA, run)
    parent = begin_run(spark, f"{root}/runs", run, lambda: newest_batches(spark, root))
    if parent is None:
        return spark.createDataFrame([], PARTS_SCHEMA)
    return read_batch(spark, f"{root}/scores", parent[1], PARTS_SCHEMA, parent[0])


def learn_batch(
    rows: DataFrame, root: str, batch_id: int, stats_every: int, run: str = FIRST_RUN, batch_rows: int | None = None
) -> list[str]:
    """Log interactions and add them to the scores; report with every ``stats_every``-th batch. Returns the outputs
    that were written, for the commit.

    The report comes from the small score snapshot, not from the log. ``batch_rows`` is the number of
    messages of the batch, by default that of its interactions.
    """
    spark = rows.sparkSession
    seen = Observation()
    write_batch(rows.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/log", batch_id, run)
    logged = read_batch(spark, f"{root}/log", batch_id, LOG_SCHEMA, run)
    new = score_parts(logged)
    write_batch(merge_parts(scores_before(spark, root, batch_id, run), new), f"{root}/scores", batch_id, run)
    if (batch_id + 1) % stats_every == 0:
        parts = read_batch(spark, f"{root}/scores", batch_id, PARTS_SCHEMA, run)
        n = seen.get["rows"] if batch_rows is None else batch_rows
        write_batch(stats_from_parts(parts).withColumn("batch_rows", F.lit(n).cast("bigint")), f"{root}/stats", batch_id, run)
        return ["log", "scores", "stats"]
    return ["log", "scores"]
