"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

1. Line-first cleaning removes failing lines and the documents that fail or lose too much.
2. SimHash: one document of each group of near-duplicates stays.
3. Secrets are replaced by a mask.
4. Sources are mixed to their target weights: documents are left out or repeated, in the order of training.
5. Texts become token ids.

All stages but the last return the columns of the documents they get; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempera.llm import bpe, mixing, quality, secrets, simhash
from tempera.llm.common import col, free_name
from tempera.session import materialise

TOKENIZER = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_text(row: dict[str, Column], text: Column) -> list[Column]:
    """The columns of a row with another text, and its length if they have one."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return [new.get(name, value).alias(name) for name, value in row.items()]


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = free_name(docs, "quality")
    rows = quality.assess(docs, found).filter(f"{found}.kept")
    return rows.select(with_text({c: col(c) for c in docs.columns}, F.col(found)["clean_text"]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = [c for c in docs.columns if c != "text"]
    rows = secrets.find(docs, mask=True, carry=rest)
    row = {c: F.col("row").getField(c) if c in rest else F.lit(None) for c in docs.columns}
    return rows.select(with_text(row, F.col("clean_text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.curriculum(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with a digest of what they decode to."""
    rows = bpe.round_trip(docs, public_tokenizers.path(TOKENIZER))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", clean_documents),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode_texts),
]

# Fingerprints and token ids cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
