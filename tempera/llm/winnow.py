"""Document fingerprints by winnowing, with DataFrame functions alone.

The grams are ``GRAM`` words in a row, hashed to 64 bits. In every window of ``WINDOW`` grams the smallest
hash is chosen, the rightmost of equal ones, and kept with the position of its first word. Two texts that
share ``GRAM + WINDOW - 1`` words in a row therefore share a chosen gram. A text with fewer words than a
gram has one gram of all its words; with fewer grams than a window, one window of them all. A text without
words has no grams.

NULL text is empty. Two fingerprints without grams are alike (1), and one without differs from any other
(0). Documents are ordered by id, NULL ids first, rows with the same id by a hash of their text. The only
document is its own next one. Columns other than the two named ones are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera.llm.common import text_of, words

GRAM = 5
WINDOW = 16  # a power of two
ROWS = 2048  # documents of a bucket, about
MOST_BUCKETS = 1 << 16
PICK = "array<struct<hash:bigint,back:int>>"


def grams(said: Column, k: int = GRAM) -> Column:
    """Hash and negated position of every gram: the smaller of two is that with the smaller hash, then the
    rightmost."""
    many = F.transform(
        F.sequence(F.lit(0), F.size(said) - k),
        lambda i: F.struct(F.xxhash64(*[F.get(said, i + j) for j in range(k)]).alias("hash"), (-i).alias("back")),
    )
    one = F.array(F.struct(F.xxhash64(F.array_join(said, " ")).alias("hash"), F.lit(0).alias("back")))
    return F.when(F.size(said) >= k, many).when(F.size(said) > 0, one).otherwise(F.array().cast(PICK))


def halved(least: Column, step: int) -> Column:
    """Minima over twice as many grams, from those over ``step`` grams."""
    wider = F.transform(
        F.sequence(F.lit(0), F.size(least) - step - 1), lambda i: F.least(F.get(least, i), F.get(least, i + step))
    )
    return F.when(F.size(least) > step, wider).otherwise(F.filter(F.array(F.array_min(least)), lambda p: p.isNotNull()))


def chosen(least: Column) -> Column:
    """Each chosen gram once: the choices of windows in a row never step back."""
    return F.filter(least, lambda p, i: (i == 0) | (p["back"] != F.get(least, i - 1)["back"]))


def fingerprint(df: DataFrame, text: str, into: str, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with the fingerprint of column ``text``: an array of ``hash`` and ``at``, by position."""
    df = df.withColumn("_w", words(F.col(text)))
    df = df.withColumn("_w", grams(F.col("_w"), k))
    step = 1
    while step < window:
        df = df.withColumn("_w", halved(F.col("_w"), step))
        step *= 2
    picks = F.transform(chosen(F.col("_w")), lambda p: F.struct(p["hash"].alias("hash"), (-p["back"]).alias("at")))
    return df.withColumn(into, picks).drop("_w")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all hashes of two fingerprints."""
    x, y = F.transform(a, lambda p: p["hash"]), F.transform(b, lambda p: p["hash"])
    both, either = F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))
    return F.when(either > 0, both / either).otherwise(1.0)


def listed(picks: Column) -> Column:
    """``hash@position`` of each chosen gram, comma-joined."""
    return F.array_join(F.transform(picks, lambda p: F.concat(F.hex(p["hash"]), F.lit("@"), p["at"])), ",")


def literal(numbers: list[int], kind: str) -> Column:
    """An array of constants, as one folded literal."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def bucket_of(id: Column, edges: list[int]) -> Column:
    """How many of the ascending ``edges`` are not above the id, by binary search."""
    if not edges:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(edges).bit_length()))]
    table = literal(edges, "bigint")
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(table, at + s - 1) <= id, at + s).otherwise(at),
    )
    return F.when(id.isNull(), 0).otherwise(found)


def with_next(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``text`` and fingerprint ``marks`` of every document, and ``next_text``, ``next_marks``
    of the next.

    Buckets of neighbouring ids are windows of their own. Each also gets a copy of the first document of the
    bucket after it, so that its last document finds its next one there, and the texts are shuffled once.
    """
    ids = docs.select("doc_id")
    total = docs.count()
    n = max(1, min(MOST_BUCKETS, total // rows))
    cuts = [i / n for i in range(1, n)]
    edges = sorted({int(e) for e in ids.approxQuantile("doc_id", cuts, 1 / (4 * n))}) if cuts else []
    heads = ids.groupBy(bucket_of(F.col("doc_id"), edges).alias("b")).agg(
        F.min("doc_id").alias("head"), F.max(F.col("doc_id").isNull().cast("int")).alias("no_id")
    )
    first = sorted((r["b"], None if r["no_id"] else r["head"]) for r in heads.collect())  # a row per bucket
    marked = fingerprint(docs, "text", "marks").withColumn("hash", F.xxhash64("text"))
    placed = marked.withColumn("bucket", bucket_of(F.col("doc_id"), edges)).withColumn("ghost", F.lit(False))
    earlier = [0] * (len(edges) + 1)
    for (b, _), (before, _) in zip(first, first[-1:] + first[:-1], strict=True):
        earlier[b] = before
    known = [h for _, h in first if h is not None]
    copied = F.coalesce(F.col("doc_id").isin(known), F.lit(False)) if known else F.lit(False)
    if len(known) < len(first):
        copied = copied | F.col("doc_id").isNull()
    ghosts = placed.filter(copied).withColumn("bucket", F.get(literal(earlier, "int"), F.col("bucket"))).withColumn("ghost", F.lit(True))
    order = W.partitionBy("bucket").orderBy("ghost", "doc_id", "hash")
    both = placed.unionByName(ghosts)
    led = both.withColumn("next_text", F.lead("text").over(order))
    led = led.withColumn("next_marks", F.lead("marks").over(order))
    return led.filter(~F.col("ghost")).select("doc_id", "text", "marks", "next_text", "next_marks")


def edited(text: Column, other: Column) -> Column:
    """The text with its last half replaced by as many first code points of the other, or all it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def compare(docs: DataFrame, id: str = "doc_id", text: str = "text", rows: int = ROWS) -> DataFrame:
    """Every document with its fingerprint, its edited text and that one's fingerprint, and their likeness.

    ``doc_id``, ``n_chars``, ``edited_text``, ``marks``, ``edited_marks``, ``near_edited``, ``near_next``.
    """
    out = with_next(text_of(docs, id, text), rows)
    out = out.withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    out = fingerprint(out, "edited_text", "edited_marks")
    return out.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        "edited_text",
        "marks",
        "edited_marks",
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
