"""K-means by exact nearest-centroid search that skips most centroids (equal-average equal-variance search).

A component x becomes the integer floor(64 x). Centroids are sorted by the sum of their components, which orders them
by mean. The scan of a vector starts at the centroid next to its own sum and goes outward on both sides, the nearer
side first. With sums S and deviations V (the length of what is left when the mean is taken off), for n components

    distance >= (S - S')^2 / n                    a side ends where this exceeds the best so far,
    distance >= (S - S')^2 / n + (V - V')^2       a centroid is passed over where this does.

Bounds are floats and reject only what exceeds the best by more than their rounding; distances are exact integers, and of
equally near centroids the one with the smaller number wins. So the result is that of comparing all.

Every round is one pass over the vectors: each task sends the sums and counts of its clusters, and the driver gets k
centroids. New centroids are exact floors of means; one without vectors stays. Vectors of another length, NULL ones and
those with a NULL, NaN or infinite component are left out. Repeated rows are vectors of their own, with a NULL id too. With
fewer vectors than k there are as many clusters as vectors; an empty table gives no rows. A distance must fit a long, so
a component beyond ``LARGEST`` is an error that names its row, not a wrong number. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempera.llm.common import col
from tempera.session import materialise

SCALE = 64
DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
LARGEST = 2.0**27 / SCALE  # squares of 64 differences of twice this, scaled, add up to less than 2^63
BLOCK = 4096
SLACK = 1e-9  # relative rounding error that a bound may have, with much to spare


class Search:
    """Nearest of some centroids (rows of integers), for blocks of vectors."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.sums = centroids.sum(axis=1)
        self.order = np.lexsort((np.arange(len(centroids)), self.sums))
        self.sorted_sums = self.sums[self.order]
        self.deviations = deviation(centroids)[self.order]
        self.compared = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and its squared distance, for each vector."""
        n, dims, k = len(vectors), self.centroids.shape[1], len(self.centroids)
        sums, deviations = vectors.sum(axis=1), deviation(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k)
        up = np.searchsorted(self.sorted_sums, sums)
        down = up - 1
        live = np.arange(n)
        while len(live):
            gap_up, gap_down = self._gaps(sums[live], up[live], down[live])
            upward = gap_up <= gap_down
            gap = np.where(upward, gap_up, gap_down)
            # Beyond the nearer side the other one is farther still: the scan of this vector is over.
            by_mean = gap * gap / dims
            going = by_mean * (1 - SLACK) <= best[live]
            live, upward, by_mean = live[going], upward[going], by_mean[going]
            at = np.where(upward, up[live], down[live])
            up[live[upward]] += 1
            down[live[~upward]] -= 1
            apart = deviations[live] - self.deviations[at]
            # The deviations are rounded themselves, by far less than this share of the larger one.
            apart = np.maximum(np.abs(apart) - SLACK * (deviations[live] + self.deviations[at]), 0)
            maybe = (by_mean + apart * apart) * (1 - SLACK) <= best[live]
            row, at = live[maybe], self.order[at[maybe]]
            self.compared += len(row)
            step = vectors[row] - self.centroids[at]
            distance = np.einsum("ij,ij->i", step, step)
            nearer = (distance < best[row]) | ((distance == best[row]) & (at < number[row]))
            best[row[nearer]], number[row[nearer]] = distance[nearer], at[nearer]
        return number, best

    def _gaps(self, sums: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences of sums on both sides, infinite where a side has ended."""
        last = len(self.sums) - 1
        above = np.where(up <= last, self.sorted_sums[np.minimum(up, last)] - sums, np.inf)
        below = np.where(down >= 0, sums - self.sorted_sums[np.maximum(down, 0)], np.inf)
        return above, below


def deviation(rows: np.ndarray) -> np.ndarray:
    """Length of each row after its mean is taken off."""
    off = rows - rows.mean(axis=1, keepdims=True)
    return np.sqrt(np.einsum("ij,ij->i", off, off))


def usable(vectors: DataFrame, id: str, vector: str, dimensions: int) -> DataFrame:
    """``id`` and integer ``x`` of the vectors that are kept."""
    values = col(vector).cast("array<double>")
    finite = ~F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    too_large = F.exists("x", lambda v: F.abs(v) > LARGEST)
    said = F.concat(F.lit(f"vector with a component beyond {LARGEST:.0f}: "), F.coalesce(F.col("id").cast("string"), F.lit("NULL")))
    scaled = F.transform("x", lambda v: F.floor(v * SCALE).cast("bigint"))
    kept = vectors.filter(F.coalesce((F.size(values) == dimensions) & finite, F.lit(False)))
    kept = kept.select(col(id).alias("id"), values.alias("x"))
    return kept.select("id", F.when(too_large, F.raise_error(said).cast("array<bigint>")).otherwise(scaled).alias("x"))


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose id, after ``seed``, has the smallest SHA-256; equal ones ascend by vector, NULL ids come last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.select(key.alias("key"), "x").orderBy(F.asc_nulls_last("key"), "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Vectors of a batch as matrices of bounded size."""
    for start in range(0, batch.num_rows, BLOCK):
        piece = batch.column("x").slice(start, BLOCK)
        yield start, piece.flatten().to_numpy(zero_copy_only=False).reshape(len(piece), -1)


def _sums(centroids: np.ndarray):
    """Per cluster and component, the count and sum of the vectors of a task."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, counts, sums = Search(centroids), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, block in _blocks(batch):
                number, _ = search.nearest(block)
                order = np.argsort(number, kind="stable")
                of, starts, sizes = np.unique(number[order], return_index=True, return_counts=True)
                counts[of] += sizes
                if len(of):
                    sums[of] += np.add.reduceat(block[order], starts, axis=0)
        at = np.flatnonzero(counts)
        cluster, component = np.repeat(at, dims), np.tile(np.arange(dims), len(at))
        arrays = [cluster.astype(np.int32), component.astype(np.int32), np.repeat(counts[at], dims), sums[at].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["cluster", "component", "count", "sum"])

    return run


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. The driver gets a row per centroid and component."""
    parts = kept.select("x").mapInArrow(_sums(centroids), "cluster int, component int, count bigint, sum bigint")
    total = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "component").agg(total, F.sum("count").alias("count")).collect():
        out[r["cluster"], r["component"]] = int(r["sum"]) // r["count"]
    return out


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id``, ``cluster`` and ``distance`` of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            for start, block in _blocks(batch):
                number, distance = search.nearest(block)
                arrays = [batch.column("id").slice(start, len(block)), pa.array(number.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "cluster", "distance"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = 1,
) -> DataFrame:
    """``id``, ``cluster``, ``distance``, the ``cluster_inertia`` and ``inertia``, and the ``centroid`` of every kept vector."""
    kept = materialise(usable(vectors, id, vector, dimensions))
    centroids = first_centroids(kept, clusters, seed)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(kept, centroids)
        rows = materialise(assigned(kept, centroids))
    else:
        rows = kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).cast("bigint")
    inertia = {r["cluster"]: r["sum"] for r in rows.groupBy("cluster").agg(wide.alias("sum")).collect()}  # k rows at most
    known = [(c, inertia.get(c, 0), sum(inertia.values()), x.tolist()) for c, x in enumerate(centroids)]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    table = rows.sparkSession.createDataFrame(known, schema)
    return rows.join(F.broadcast(table), "cluster").select("id", *table.columns[:1], "distance", *table.columns[1:])


def _sql() -> str:
    """The same in the SQL of another engine, comparing all."""
    finite = "len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v::DOUBLE))) = 0"
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
            list_transform(embedding, lambda e: CAST(floor({SCALE} * e::DOUBLE) AS BIGINT)) AS x
            FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND {finite})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v
            ORDER BY sha256('1:' || vec_id), x LIMIT {CLUSTERS})""",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (SELECT v.r, c.c, CAST({square} AS BIGINT) AS d FROM v CROSS JOIN c{k} c) GROUP BY r)""")
        if k < ROUNDS:
            steps.append(f"""s{k} AS (SELECT c, i, sum(e) AS s, count(*) AS n FROM (SELECT a.c,
                unnest(v.x) AS e, unnest(range({DIMENSIONS})) AS i FROM a{k} a JOIN v USING (r)) GROUP BY c, i),
            m{k} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{k} GROUP BY c),
            c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m.x, o.x) AS x FROM c{k} o LEFT JOIN m{k} m USING (c))""")
    return f"""WITH {", ".join(steps)}
        SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
            CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM v JOIN a{ROUNDS} a USING (r) JOIN c{ROUNDS} c ON c.c = a.c"""


SQL = _sql()
