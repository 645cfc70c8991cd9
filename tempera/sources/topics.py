"""Streams and tables of messages: one column ``value`` with the message text.

The format is an argument. A deployment names ``kafka`` and its options; the tests use files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC_ACTIONS = "user_actions"
TOPIC_PLAYLISTS = "user_playlists"


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Start at the newest message; a message lost by the broker does not end the query."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def read_messages(
    spark: SparkSession, source: str, path: str | None = None, columns: str = "value string", **options: str
) -> DataFrame:
    """Stream of messages. A file source has a column ``value`` and may have more beside it."""
    reader = spark.readStream.format(source).options(**options)
    if source != "kafka":
        reader = reader.schema(columns)
    stream = reader.load(path) if path else reader.load()
    return stream.withColumn("value", stream["value"].cast("string"))


def write_messages(
    messages: DataFrame, sink: str, path: str | None = None, beside: tuple[str, ...] = (), **options: str
) -> None:
    """Batch write of a ``value`` column, from a table or inside ``foreachBatch``.

    ``beside`` names columns that go with it, such as a topic's ``key``.
    """
    writer = messages.select(*beside, "value").write.format(sink).options(**options)
    if path:
        writer.mode("append").save(path)
    else:
        writer.save()


def received_once(messages: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """A stream without the repeats that a replay sends: of equal keys that come within ``delay``, the first."""
    return messages.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
