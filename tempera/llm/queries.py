"""Registered queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempera.llm import bpe, centroids, chat, html, langid, merkle, mixing, pii, quality, repair, secrets, simhash, winnow
from tempera.session import materialise, shared_folder

TOKENIZER = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def number_of(kind: str) -> Column:
    """How many spans are of this kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as a Re-Pair archive and read back."""
    folder = shared_folder(spark)
    repair.write_archive(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), folder)
    rows = repair.read_archive(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of line-first cleaning for every document."""
    rows = quality.assess(documents(spark, sf_dir).select("doc_id", "text"), "quality")
    return rows.select("doc_id", "quality.*").drop("clean_text")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of near-duplicates of every document."""
    rows = simhash.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""
    rows = pii.find(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    return rows.select(
        "doc_id",
        *[number_of(k) for k in pii.KINDS],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return langid.identify(documents(spark, sf_dir))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, formatted, written, and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    mine = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    path = public_tokenizers.path(TOKENIZER)
    return chat.digest(materialise(chat.format_conversations(turns.unionByName(mine), path)), path)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    rows = bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of the secrets in every document."""
    rows = secrets.find(documents(spark, sf_dir), carry=["doc_id"])
    counts = [number_of(k) for k in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return rows.select(
        "row.doc_id",
        *counts,
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op9_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    rows = winnow.compare(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        winnow.listed(F.col("marks")).alias("fingerprint"),
        winnow.listed(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in the order of first training."""
    rows = mixing.assign(documents(spark, sf_dir), carry=["doc_id"])
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(1.0))
    taken = (F.col("size") * F.col("copies")).cast("bigint").alias("taken")
    ordered = rows.select("row.doc_id", "size", "source_size", "target", taken, first.alias("first"))
    return ordered.repartitionByRange("first", "doc_id").sortWithinPartitions("first", "doc_id").drop("first")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and witness of every document, and the root that follows where a text was lower-cased."""
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    text = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    rows = merkle.witnesses(merkle.leaves(docs, {"text": text})).withColumnRenamed("id", "doc_id")
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds, and how far it is from the centroid."""
    rows = centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digits = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digits.alias("centroid_sha256")
    )


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    rows = html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), carry=["page_id", "url"])
    return rows.select("row.page_id", "row.url", "text", F.length("text").cast("bigint").alias("n_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repair": op1_repair,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_langid": op5_langid,
    "op6_chat": op6_chat,
    "op7_bpe": op7_bpe,
    "op8_secrets": op8_secrets,
    "op9_winnow": op9_winnow,
    "op10_mixing": op10_mixing,
    "op11_merkle": op11_merkle,
    "op12_centroids": op12_centroids,
    "op13_html": op13_html,
}

SQL: dict[str, str] = {
    "op2_quality": quality.SQL,
    "op10_mixing": mixing.SQL,
    "op11_merkle": merkle.SQL,
    "op12_centroids": centroids.SQL,
}
