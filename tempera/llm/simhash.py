"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints are sorted by their
population count into strips and dealt over tiles of bounded size. Two fingerprints within the radius differ
by no more than the radius in population count, so only tiles of near strips meet; in a task, the same holds
for the population counts of the four quarters, and only pairs of cells that can be near are compared, by
exclusive-or and bit counts over whole arrays. Each pair of tiles returns a spanning forest of its links,
never all of them, and the components of these are those of all links.

NULL and empty texts, and those without words, have fingerprint zero, which is linked like any other. Equal
texts share a fingerprint and so a component; rows with the same ``doc_id`` are each returned, and a
fingerprint's smallest ``doc_id`` stands for it. A NULL ``doc_id`` gets the component of its fingerprint. An
empty table gives an empty result. Columns other than the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera.llm.common import bytes_of, col, slices
from tempera.llm.components import components
from tempera.operators.lookup import Lookup
from tempera.session import materialise

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 1 << 14  # fingerprints of a tile, where there are few
MOST_TILE = 1 << 18
TILES = 16  # of a strip, until tiles have their largest size
MOST_TASKS = 1_000_000
BLOCK = 1 << 19  # pairs compared at once, all of which may be links


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the shingles; A-Z in lower case, words split at ASCII white
    space."""
    said = text.lower().split()
    if not said:
        return 0
    line = b" ".join(said)
    sizes = np.fromiter(map(len, said), np.int64, len(said)) + 1
    ends = np.cumsum(sizes)
    k = min(shingle, len(said))
    starts = (ends - sizes)[: len(said) - k + 1].tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    hashes = [xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in zip(starts, stops, strict=True)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, its ``fingerprint`` as a signed 64-bit integer, and ``row_key``, a hash of id and
    text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            columns = [b.column("doc_id"), b.column("row_key"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "fingerprint"])

    source = bytes_of(docs, id, text).withColumn("row_key", F.xxhash64("doc_id", "text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, row_key bigint, fingerprint bigint")


class Forest:
    """Union-find over local positions that keeps the links which joined two trees."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            high, low = np.maximum(x, y), np.minimum(x, y)
            # One link for each root that is hooked; a root is hooked to a smaller one, so no circle arises.
            roots, at = np.unique(high, return_index=True)
            self.links += zip(a[at].tolist(), b[at].tolist(), strict=True)
            self.root[roots] = low[at]
            while not np.array_equal(deeper := self.root[self.root], self.root):
                self.root = deeper


def near_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or inside one (``right`` None), as fingerprints."""
    values = left if right is None else np.concatenate((left, right))
    quarters = np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    side = np.arange(len(values)) >= len(left)
    cells, member = np.unique(np.column_stack((side, quarters)), axis=0, return_inverse=True)
    order = np.argsort(member, kind="stable")
    edges = np.searchsorted(member[order], np.arange(len(cells) + 1))
    forest = Forest(len(values))
    n_left = int((cells[:, 0] == 0).sum())
    for i in range(n_left):
        others = np.arange(i, n_left) if right is None else np.arange(n_left, len(cells))
        near = others[np.abs(cells[others, 1:] - cells[i, 1:]).sum(axis=1) <= radius]
        if not len(near):
            continue
        mine = order[edges[i] : edges[i + 1]]
        theirs = np.concatenate([order[edges[j] : edges[j + 1]] for j in near])
        step = max(1, BLOCK // len(theirs))
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            a, b = np.nonzero(np.bitwise_count(values[some][:, None] ^ values[theirs][None, :]) <= radius)
            forest.add(some[a], theirs[b])
    pairs = np.array(forest.links, np.int64).reshape(-1, 2)
    return values[pairs[:, 0]], values[pairs[:, 1]]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` between the distinct values of column ``fingerprint``, enough to connect all near
    ones."""
    ones = F.bit_count("fingerprint")
    # At most 65 rows. Larger tables get larger tiles: each tile then travels to fewer others.
    counts = {r[0]: r[1] for r in distinct.groupBy(ones.alias("ones")).count().collect()}
    size = max(tile, min(MOST_TILE, -(-max(counts.values(), default=0) // TILES)))
    tiles = {p: -(-n // size) for p, n in counts.items()}
    if not tiles:
        return distinct.sparkSession.createDataFrame([], "a bigint, b bigint")
    number = F.create_map(*[F.lit(x) for p, n in tiles.items() for x in (p, n)])
    tile_of = F.pmod(F.xxhash64("fingerprint"), F.try_element_at(number, ones)).cast("int")
    dealt = distinct.select("fingerprint", ones.alias("strip"), tile_of.alias("tile"))
    packed = materialise(dealt.groupBy("strip", "tile").agg(F.sort_array(F.collect_list("fingerprint")).alias("values")))
    pairs = sum(n * (n + 1) // 2 + n * sum(tiles.get(p + d, 0) for d in range(1, radius + 1)) for p, n in tiles.items())
    return _compared(packed, number, pairs, radius)


def _compared(packed: DataFrame, number: Column, n_pairs: int, radius: int) -> DataFrame:
    spark = packed.sparkSession
    # Every tile goes to each pair that it is part of; ``number`` maps a population count to its number of tiles.
    near = F.explode(F.sequence(F.col("strip") - radius, F.col("strip") + radius))
    reach = packed.select("strip", "tile", near.alias("other"), "values")
    reach = reach.withColumn("n", F.try_element_at(number, F.col("other"))).filter("n is not null")
    each = reach.select("strip", "tile", "other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at"), "values")
    mine, theirs = F.struct("strip", "tile"), F.struct(F.col("other").alias("strip"), F.col("at").alias("tile"))
    pairs = each.select(
        F.least(mine, theirs).alias("first"), F.greatest(mine, theirs).alias("second"), (mine <= theirs).alias("leads"), "values"
    )
    # A task has a few pairs of tiles, one after the other; a pair holds two tiles of bounded size.
    key = F.xxhash64("first.strip", "first.tile", "second.strip", "second.tile")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.withColumn("pair", key).repartition(max(least, min(n_pairs // 4, MOST_TASKS)), "pair")
    ordered = dealt.sortWithinPartitions("pair", "first", "second", F.desc("leads"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                first, second = batch.column("first")[i].as_py(), batch.column("second")[i].as_py()
                values = batch.column("values")[i].values.to_numpy().view(np.uint64)
                if first == second:
                    a, b = near_links(values, None, radius)
                elif held is None:
                    held = values
                    continue
                else:
                    a, b = near_links(held, values, radius)
                held = None
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return ordered.select("first", "second", "values").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, the smallest ``doc_id`` that links reach.

    Also ``component``, which tells components apart even without ids, and ``row_key``, a hash of id and
    text.
    """
    marked = materialise(fingerprints(docs, id, text, shingle))
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    links = fingerprint_links(distinct, radius, tile)
    joined = components(links, "a", "b").withColumnRenamed("node", "fingerprint")
    grouped = distinct.join(joined, "fingerprint", "left")
    least = grouped.filter("component is not null").groupBy("component").agg(F.min("least_id").alias("least"))
    # A component may hold much of the table: a measured lookup, salted where it is not broadcast.
    named = Lookup(least).join(grouped, {"component": "component"}, {"least": "least"}).select(
        "fingerprint",
        F.coalesce("component", "fingerprint").alias("component"),
        F.coalesce("least", "least_id").alias("component_id"),
    )
    # A fingerprint may be that of much of the table, too.
    out = Lookup(named).join(marked, {"fingerprint": "fingerprint"}, {c: c for c in ("component_id", "component")})
    return out.select("doc_id", "fingerprint", "component_id", "component", "row_key")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` of which each stands for its component: that of the smallest id, then text hash.

    Of rows with the same id and text one stays, the smallest by all its columns.
    """
    classes = near_duplicates(docs, id, text, **options)
    first = classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = first.groupBy("component").agg(F.min("row_key").alias("key")).select("key")
    whole = F.coalesce(col(text), F.lit("")).cast("binary")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), F.xxhash64(col(id), whole).alias("key"))
    alike = W.partitionBy("key").orderBy(*[F.col("row").getField(c) for c in docs.columns])
    kept = rows.join(stay, "key").withColumn("n", F.row_number().over(alike)).filter("n = 1")
    return kept.select("row.*")
