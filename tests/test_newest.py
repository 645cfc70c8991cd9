"""The live table of the newest row per key, against a plain fold."""

import random

import pytest
from test_stream import few_partitions  # noqa: F401

from tempera.session import shared_folder
from tempera.sources.commits import folders
from tempera.streaming import newest as module
from tempera.streaming.newest import NewestPerKey

SCHEMA = "user_id bigint, ts int, event_id bigint, text string"


def rows(seed=3, n=240):
    """Late and repeated rows; one user has a third of them, another is NULL."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        user = 7 if rnd.random() < 0.3 else None if rnd.random() < 0.1 else rnd.randrange(40)
        out.append((user, rnd.randrange(60) if i % 9 else None, i, f"t{i}"))
    return out + out[:20]


def fold(seen):
    best = {}
    for r in seen:
        place = (r[1] is not None, r[1] or 0, r[2])
        if r[0] not in best or place >= best[r[0]][0]:
            best[r[0]] = (place, r)
    return sorted((r for _, r in best.values()), key=str)


def got(spark, table):
    return sorted((tuple(r) for r in table.read(spark).collect()), key=str)


def test_batches_replays_and_stops(spark, monkeypatch):
    table = NewestPerKey(shared_folder(spark), SCHEMA, "user_id", ("ts", "event_id"), buckets=5)
    assert got(spark, table) == []
    all_ = rows()
    pieces = [all_[i : i + 65] for i in range(0, len(all_), 65)] + [[]]
    seen = []
    for batch, piece in enumerate(pieces):
        frame = spark.createDataFrame([(*r, "x") for r in piece], f"{SCHEMA}, more string")
        if batch == 2:  # stops before the manifest: nothing of the batch is seen
            with monkeypatch.context() as m:
                m.setattr(module, "MANIFEST", "broken")
                with pytest.raises(Exception):  # noqa: B017
                    table.upsert(frame, batch)
            assert got(spark, table) == fold(seen)
        table.upsert(frame, batch)
        if batch in (1, 3):
            table.upsert(frame, batch)
        seen += piece
        assert got(spark, table) == fold(seen)
        if batch > 1:
            table.expire(spark)
            table.upsert(frame, batch)  # a replay still finds the state before it
            assert got(spark, table) == fold(seen)


def test_untouched_buckets_are_not_written(spark):
    table = NewestPerKey(shared_folder(spark), SCHEMA, "user_id", ("ts", "event_id"), buckets=16)
    table.upsert(spark.createDataFrame([(u, 1, u, "a") for u in range(100)], SCHEMA), 0)
    table.upsert(spark.createDataFrame([(5, 2, 200, "b")], SCHEMA), 1)
    written = [f for f in folders(spark, f"{table.root}/rows/version=1")]
    assert len(written) == 1 and sum(v == 1 for v in table.versions(spark).values()) == 1
    assert ("b",) in [r[3:] for r in got(spark, table)] and len(got(spark, table)) == 100
