"""Every registered query with SQL must equal that SQL."""

import pytest
from oracle import assert_same, connect

import __spark_entry__ as driver

SQL = driver.oracle_sql()
QUERIES = driver.queries()
BATCH = [k for k in QUERIES if k in SQL and not k.startswith("stream_") and not k.startswith("op") and k != "pipeline"]
SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
PINNED = {
    "throttle_detections": 4754,
    "debounce_moods": 1381,
    "clean_requests": 9500,
    "asof_preferences": 2006,
    "playlist_payload": 9500,
}


# The smallest catalogue makes requests fall back to the later searches.
FALLBACK = ["fallback_stages", "playlist_topk", "playlist_payload", "log_interactions", "latest_playlist"]


@pytest.mark.parametrize("folder,name", [(MIDDLE, k) for k in BATCH] + [(SMALL, k) for k in FALLBACK])
def test_batch_equals_sql(spark, folder, name):
    rows = assert_same(QUERIES[name](spark, folder), connect(folder), SQL[name])
    assert rows > 0
    if folder == MIDDLE and name in PINNED:
        assert rows == PINNED[name]


@pytest.mark.parametrize("name", [k for k in SQL if k.startswith("stream_")])
def test_stream_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, MIDDLE), connect(MIDDLE), SQL[name])


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_log_is_anonymous(spark):
    assert "user_id" not in QUERIES["log_interactions"](spark, SMALL).columns


def test_stages_are_all_used(spark):
    """The smallest tables reach the third search, and some requests find nothing."""
    rows = QUERIES["fallback_stages"](spark, SMALL).collect()
    assert sum(r.n_3 > 0 for r in rows) > 0
    assert sum(r.n_1 + r.n_2 + r.n_3 == 0 for r in rows) == 46
