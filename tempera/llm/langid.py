"""Language identification by string kernels.

Two texts are compared by the n-grams of one to three characters that both have, counted once each and
divided by the square root of the product of their numbers: the blended-spectrum presence kernel. Letters and marks of every
script stand for themselves, in lower case; white space, digits and all other characters each fold into one sign. An n-gram
is a 63-bit number of its code points.

Training is on a bounded sample: of each language at most ``PER_LANGUAGE`` labelled texts (the first by a
hash of their id and text), of each the first ``SAMPLE_CHARS`` characters. Every language is learned. ``LANDMARKS`` of the
texts, or ``PER_CLASS`` of each language if that is more, span the Nyström features, on which one ridge regression per
language against the rest is solved. Scoring multiplies a batch of presence rows with the landmarks and the result with
the weights; every text is scored whole. The product is dense over the ``DENSE`` n-grams that most landmarks have and
sums postings of the others, so memory is bounded whatever the script.

A text that is NULL, empty or without letters is ``und`` with score 0; so is every text if no label can be
learned from. Other texts get the language with the highest value, the smaller name on ties. The score is
the logistic function of four times the lead over the second language's value, and of four times the value
itself if there is one language. Rows are independent, so repeated rows give repeated results. Columns other
than the named ones are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera.llm.common import bytes_of, col, slices
from tempera.operators.lookup import Lookup

POINT_BITS = 21
PER_LANGUAGE = 400
SAMPLE_CHARS = 20_000
LANDMARKS = 256
PER_CLASS = 8
DENSE = 1 << 16
RIDGE = 1e-2
BATCH = 128
UNKNOWN = "und"


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """What every code point counts as, plus one."""
    table = np.full(0x110000, ord(".") + 1, np.int64)
    for p in range(len(table)):
        kind = unicodedata.category(chr(p))
        if kind[0] in "LM":
            table[p] = ord(chr(p).lower()[0]) + 1
        elif kind == "Nd":
            table[p] = ord("0") + 1
        elif chr(p).isspace():
            table[p] = ord(" ") + 1
    return table


def grams(text: str) -> np.ndarray:
    """Ascending numbers of the n-grams in the text."""
    one = folded()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    two = one[1:] << POINT_BITS | one[:-1]
    three = one[2:] << (2 * POINT_BITS) | two[:-1]
    return np.concatenate([np.unique(n) for n in (one, two, three)])


@dataclass(frozen=True)
class Model:
    """Landmarks as rows over the n-grams that any of them has, and the weights of the languages.

    Rows are ordered by the number of landmarks with the n-gram. The first are a matrix; each of the others has a list
    of its landmarks.
    """

    keys: np.ndarray  # n-grams, ascending
    row_of: np.ndarray  # the row of each
    dense: np.ndarray  # row x landmark
    starts: np.ndarray  # of the further rows: where their lists start
    postings: np.ndarray
    norms: np.ndarray  # square root of the number of n-grams of each landmark
    weights: np.ndarray  # landmark x language
    languages: list[str]

    def kernel(self, found: list[np.ndarray]) -> np.ndarray:
        """Kernel of texts, as their n-grams, with the landmarks."""
        present = np.zeros((len(found), len(self.dense)), np.float32)
        rest = np.zeros((len(found), len(self.norms)), np.float32)
        for i, f in enumerate(found if len(self.keys) else []):
            at = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
            rows = self.row_of[at[self.keys[at] == f]]
            present[i, rows[rows < len(self.dense)]] = 1
            rare = rows[rows >= len(self.dense)] - len(self.dense)
            sizes = self.starts[rare + 1] - self.starts[rare]
            where = np.repeat(self.starts[rare] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            rest[i] = np.bincount(self.postings[where], minlength=len(self.norms))
        sizes = np.sqrt(np.array([max(1, len(f)) for f in found], np.float32))
        return (present @ self.dense + rest) / sizes[:, None] / self.norms

    def values(self, found: list[np.ndarray]) -> np.ndarray:
        """Regression values: text x language."""
        return self.kernel(found) @ self.weights


def landmarks_of(found: list[np.ndarray]) -> Model:
    """A model of landmarks, yet without weights."""
    sizes = np.array([len(f) for f in found])
    all_, mark = np.concatenate(found), np.repeat(np.arange(len(found)), sizes)
    keys, which, counts = np.unique(all_, return_inverse=True, return_counts=True)
    row_of = np.empty(len(keys), np.int64)
    row_of[np.argsort(-counts, kind="stable")] = np.arange(len(keys))
    row = row_of[which]
    dense = np.zeros((min(DENSE, len(keys)), len(found)), np.float32)
    common = row < len(dense)
    dense[row[common], mark[common]] = 1
    order = np.argsort(row[~common], kind="stable")
    further = np.bincount(row[~common] - len(dense), minlength=len(keys) - len(dense))
    starts = np.concatenate(([0], np.cumsum(further)))
    norms = np.sqrt(np.maximum(sizes, 1)).astype(np.float32)
    return Model(keys, row_of, dense, starts, mark[~common][order], norms, np.eye(len(found), dtype=np.float32), [])


def learn(texts: list[str], labels: list[str]) -> Model:
    """Nyström features on evenly chosen landmarks, and ridge regression of each language against the
    rest."""
    found = [grams(t) for t in texts]
    languages = sorted(set(labels))
    # Landmarks take turns over the languages, in the order of the sample.
    place = {name: [i for i, x in enumerate(labels) if x == name] for name in languages}
    turns = [p[k] for k in range(max(map(len, place.values()))) for p in place.values() if k < len(p)]
    marks = sorted(turns[: max(LANDMARKS, PER_CLASS * len(languages))])
    raw = landmarks_of([found[i] for i in marks])
    kernel = np.concatenate([raw.kernel(found[i : i + BATCH]) for i in range(0, len(found), BATCH)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ root
    wanted = np.array([[1.0 if x == name else -1.0 for name in languages] for x in labels])
    # Languages weigh the same, however many texts each has.
    weight = np.array([1 / len(place[x]) for x in labels])[:, None]
    square = features.T @ (weight * features) + RIDGE * np.eye(features.shape[1]) / len(labels)
    solved = np.linalg.solve(square, features.T @ (weight * wanted))
    return replace(raw, weights=(root @ solved).astype(np.float32), languages=languages)


def sample(labelled: DataFrame, id: str, text: str, lang: str) -> tuple[list[str], list[str]]:
    """At most ``PER_LANGUAGE`` texts of each language, to the driver; a row per language comes there before."""
    rows = labelled.select(col(id).alias("id"), col(text).alias("text"), col(lang).cast("string").alias("lang"))
    rows = rows.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("id", "text").alias("order"))
    # A hash below this lets about twice the wanted number of a language pass; the window then has few rows.
    share = F.least(F.lit(1.0), F.lit(2.0 * (PER_LANGUAGE + 50)) / F.count("*"))
    top = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((share * float(1 << 64) - float(1 << 63)).cast("bigint"))
    passed = Lookup(rows.groupBy("lang").agg(top.alias("top"))).join(rows, {"lang": "lang"}, {"top": "top"}, "inner")
    passed = passed.filter("order <= top").select("lang", "order", F.left("text", F.lit(SAMPLE_CHARS)).alias("text"))
    first = W.partitionBy("lang").orderBy("order", "text")
    chosen = passed.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= PER_LANGUAGE)
    got = sorted(((r["lang"], r["n"], r["text"]) for r in chosen.select("lang", "n", "text").collect()))
    return [t for _, _, t in got], [name for name, _, _ in got]


def predict(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for b in slices(batches, "text"):
            names, scores = [], []
            texts = [t.decode("utf-8", "replace") for t in b.column("text").to_pylist()]
            for at in range(0, len(texts), BATCH):
                some = texts[at : at + BATCH]
                if model is None:
                    names += [UNKNOWN] * len(some)
                    scores += [0.0] * len(some)
                    continue
                values = model.values([grams(t) for t in some]).astype(np.float64)
                best = values.argmax(axis=1)
                ordered = np.sort(values, axis=1)
                lead = ordered[:, -1] - ordered[:, -2] if values.shape[1] > 1 else ordered[:, -1]
                sure = 1 / (1 + np.exp(-4 * np.clip(lead, -100, 100)))
                known = [any(map(str.isalpha, t)) for t in some]
                names += [model.languages[j] if k else UNKNOWN for j, k in zip(best, known, strict=True)]
                scores += [float(s) if k else 0.0 for s, k in zip(sure, known, strict=True)]
            columns = [b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    source = bytes_of(docs, id, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(id: Column) -> Column:
    """One fifth of the documents, by the crc32 of the id as text (NULL: empty)."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out, and predict all: ``doc_id``, ``held_out``,
    ``lang_pred``, ``score``."""
    texts, labels = sample(docs.filter(~held_out(col(id))), id, text, lang)
    rows = predict(docs, learn(texts, labels) if texts else None, id, text)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
