"""Mixing sources to target weights over a time-varying curriculum.

Each source has a weight that varies over training time 0 to 1; its integral is the source's share. Targets
are the shares of all words to take, held to ``MOST_PASSES`` times the source's size, with the excess
reshared by weight. In a source documents follow a hash of their id; a running sum of their words gives each
the share of the source's demand that lies before it, and the inverse of the integrated schedule turns that
into a training position. Documents are then range-sorted by position.

A running sum over a large source does not lie in one task: the hash cuts a source into buckets of about
``BUCKET`` documents, sums of buckets are added up first, and each bucket continues from the sum before it.

NULL text has no words; documents without words are placed like others. A NULL source is a source of its
own, last in order. Rows with the same ``doc_id`` are separate documents, in the order of their size; a NULL
id hashes like an empty one. Without any words all targets are zero and nothing is taken. An empty table
gives an empty result. Extra columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera.llm.common import SPACES, col
from tempera.operators.lookup import Lookup
from tempera.session import materialise

WEIGHTS = (5, 2, 1)
TAKE_PERCENT = 150
MOST_PASSES = 2
BUCKET = 4096
#: Weight over training time as (time, weight) knots, joined by lines; the scale does not matter, only the shape.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def keyed(docs: DataFrame, id: str, text: str, source: str, carry: list[str]) -> DataFrame:
    """The carried columns as ``row``, the source as a key that is never NULL, its size in words and its
    place in the hash order."""
    return docs.select(
        F.struct(*[col(c) for c in carry]).alias("row"),
        col(id).alias("id"),
        F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("")).alias("source_key"),
        F.coalesce(F.regexp_count(col(text), F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce(col(id).cast("string"), F.lit("")).cast("binary")).alias("hash"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = TAKE_PERCENT) -> DataFrame:
    """Per ``source_key``: its size, weight number ``kind``, number of documents and ``target`` words.

    The table has a row per source, and sources are taken to be few beside documents.
    """
    each = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # Names by code point; the key of the missing name goes last.
    by_name = W.orderBy(F.col("source_key") == "", "source_key")
    kind = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("kind") + 1)
    each = each.withColumn("kind", kind).withColumn("weight", weight.cast("decimal(38,0)"))
    # Sources reach their limit in the order of size for weight. One that would pass it, with all earlier ones at
    # theirs, is held; the first that would not sets the level for the rest.
    whole, words = W.partitionBy(), F.col("source_size").cast("decimal(38,0)")
    order = W.orderBy(F.col("source_size") / F.col("weight").cast("double"), "source_key")
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum(words).over(whole) * percent - 100 * MOST_PASSES * F.coalesce(F.sum(words).over(before), F.lit(0))
    each = each.withColumn("left", left).withColumn("rest", F.sum("weight").over(after))
    level = F.col("left").cast("double") * F.col("weight").cast("double") / (100 * F.col("rest")).cast("double")
    held = F.col("left") * F.col("weight") >= 100 * MOST_PASSES * words * F.col("rest")
    each = each.withColumn("held", held)
    free = F.when(~F.col("held"), F.struct("left", "rest"))
    everywhere = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    each = each.withColumn("level", F.first(free, ignorenulls=True).over(everywhere))
    share = F.col("level.left").cast("double") * F.col("weight").cast("double") / (100 * F.col("level.rest")).cast("double")
    target = F.when(F.col("held"), (MOST_PASSES * F.col("source_size")).cast("double")).otherwise(share)
    return each.select("source_key", "source_size", "n_docs", "kind", target.alias("target"))


def position(demand: Column, kind: Column, schedules: tuple = SCHEDULES) -> Column:
    """The time by which a source has had the share ``demand`` (0 to 1) of its words: the inverse of its
    integral."""
    out = F.lit(None).cast("double")
    for number, knots in enumerate(schedules):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
        total, time = sum(areas), F.lit(float(knots[-1][0]))
        for i in reversed(range(len(areas))):
            (t0, w0), (t1, w1), area, done = knots[i], knots[i + 1], areas[i], sum(areas[:i])
            x = F.greatest(demand * total - done, F.lit(0.0))
            slope = (w1 - w0) / (t1 - t0)
            # w0 * s + slope * s * s / 2 = x, in the form that also holds for a flat line
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * x, F.lit(0.0)))
            inside = F.lit(t0) + F.when(x > 0, 2 * x / (w0 + root)).otherwise(0.0)
            time = F.when(demand * total <= done + area, F.least(inside, F.lit(t1))).otherwise(time)
        out = F.when(kind == number, time).otherwise(out)
    return out


def assign(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    schedules: tuple = SCHEDULES,
    percent: int = TAKE_PERCENT,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per document: ``row`` (all columns or those to ``carry``), ``size``, ``source_size``, ``target``,
    ``copies`` and the ``positions`` of these."""
    rows = keyed(docs, id, text, source, docs.columns if carry is None else carry)
    sizes = materialise(rows.select("source_key", "size", "hash"))
    wanted = Lookup(targets(sizes, weights, percent))
    known = {c: c for c in ("source_size", "n_docs", "kind", "target")}
    # Buckets ascend with the hash, so a source's order runs through them.
    place = F.conv(F.substring("hash", 1, 8), 16, 10).cast("bigint")
    bucket = F.floor(place * F.ceil(F.col("n_docs") / BUCKET) / (1 << 32))

    def placed(df: DataFrame) -> DataFrame:
        return wanted.join(df, {"source_key": "source_key"}, known).withColumn("bucket", bucket)

    sums = placed(sizes).groupBy("source_key", "bucket").agg(F.sum("size").alias("n"))
    before = W.partitionBy("source_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = Lookup(sums.select("source_key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    both = {"source_key": "source_key", "bucket": "bucket"}
    rows = offsets.join(placed(rows), both, {"before": "before"})
    inside = W.partitionBy("source_key", "bucket").orderBy("hash", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    middle = F.col("start") + F.col("size") / 2
    rows = rows.withColumn("passes", F.least(passes, F.lit(MOST_PASSES)).cast("int")).withColumn("middle", middle)
    more = (F.col("middle") < rest) & (F.col("passes") < MOST_PASSES)
    rows = rows.withColumn("copies", F.col("passes") + more.cast("int"))
    demand = lambda k: F.least((k * F.col("source_size") + F.col("middle")) / F.col("target"), F.lit(1.0))
    times = [F.when(F.col("copies") > k, position(demand(F.lit(k)), F.col("kind"), schedules)) for k in range(MOST_PASSES)]
    positions = F.filter(F.array(*times), lambda t: t.isNotNull())
    return rows.select("row", "size", "source_size", "target", "copies", positions.alias("positions"))


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The documents to train on, each as often as it is taken, range-sorted by training position."""
    rows = assign(docs, **options).select("row", F.explode("positions").alias("position"))
    return rows.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS n, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS kind FROM d GROUP BY source),
w AS (SELECT source, n, kind, (CASE kind WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::HUGEINT AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY n::DOUBLE / weight::DOUBLE, encode(source) NULLS LAST) AS r FROM w),
l AS (SELECT *, sum(n) OVER () * {TAKE_PERCENT} - {100 * MOST_PASSES} * coalesce(sum(n) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM o),
h AS (SELECT *, left_over * weight >= {100 * MOST_PASSES} * n * rest AS held FROM l),
f AS (SELECT left_over AS f_left, rest AS f_rest FROM h WHERE NOT held ORDER BY r LIMIT 1),
t AS (SELECT source, n AS source_size, CASE WHEN held THEN ({MOST_PASSES} * n)::DOUBLE
    ELSE f_left::DOUBLE * weight::DOUBLE / (100 * f_rest)::DOUBLE END AS target FROM h LEFT JOIN f ON true),
c AS (SELECT doc_id, size, source_size::BIGINT AS source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source
    ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MOST_PASSES}) ELSE 0 END AS passes FROM c)
SELECT doc_id, size, source_size, target,
    (size * (passes + CASE WHEN middle < target - passes * source_size AND passes < {MOST_PASSES} THEN 1 ELSE 0 END))::BIGINT AS taken FROM p
"""
