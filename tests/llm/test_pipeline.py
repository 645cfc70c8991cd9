"""The pipeline stage by stage, against plain versions."""

from collections import Counter

import brute
import public_tokenizers
from brute import SMALL
from oracle import connect
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tempera.llm import mixing, quality, secrets
from tempera.session import materialise

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    (_, clean), (_, dedup), (_, mask), (_, mix), (_, encode) = pipeline.STAGES

    kept = materialise(clean(spark, docs, SMALL))
    assert kept.columns == docs.columns
    verdict = {r[0]: r[1] for r in connect(SMALL).execute(f"SELECT doc_id, kept FROM ({quality.SQL})").fetchall()}
    assert {r.doc_id for r in kept.collect()} == {d for d, k in verdict.items() if k}
    whole = dict(texts(docs).keys())
    assert all(set(r.text.split("\n")) <= set(whole[r.doc_id].split("\n")) and r.n_chars == len(r.text) for r in kept.collect())

    ones = materialise(dedup(spark, kept, SMALL))
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    root = brute.classes([brute.simhash(t) for _, t in rows])
    assert texts(ones) == Counter(rows[i] for i in set(root))

    masked = materialise(mask(spark, ones, SMALL))
    assert texts(masked) == Counter((r.doc_id, secrets.masked(r.text.encode(), secrets.scan(r.text.encode()))) for r in ones.collect())

    mixed = materialise(mix(spark, masked, SMALL))
    masked.coalesce(1).write.parquet(f"{tmp_path}/d")
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    taken = con.execute(f"SELECT doc_id, taken // size FROM ({mixing.SQL})").fetchall()
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: int(n) for d, n in taken if n})

    last = encode(spark, mixed, SMALL).collect()
    want = Counter()
    for r in mixed.collect():
        ids = LIBRARY.encode(r.text, add_special_tokens=False).ids
        want[(r.doc_id, len(ids), ",".join(map(str, ids)), brute.sha(r.text))] += 1
    assert Counter(tuple(r) for r in last) == want
    assert Counter(tuple(r) for r in pipeline.run(spark, SMALL).collect()) == want


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SMALL)) if name != "quality_rules" else docs
        assert docs.columns == odd.columns
    assert pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
    assert pipeline.STAGES[0][1](spark, odd, SMALL).columns == odd.columns
