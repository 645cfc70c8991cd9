"""A Merkle manifest of a dataset: a root per group, one root of all, and a witness for every row.

A row is a leaf, the SHA-256 of its fields. The leaves of a group ascend by id; as long as several nodes are left,
every 16 consecutive ones become the hash of their hexadecimal digests, the last run with fewer, even one. What
is left is the group's subroot. The subroots, ordered by group (NULL first, by UTF-8 bytes), become the root alike.

The tree grows by appends. A node that is appended gets a partial witness, the run of siblings that it is in; every
later sibling completes that run further, and a full run is appended as one node to the level above, which extends
the witnesses of all below it. A run is held once and shared by the nodes under it. Appends are aligned, so that
blocks of 256 leaves grow independently of each other, each in one task; their roots are then further appends,
block by block, until one node is left. The witnesses come back the same way: what stands above a block is one row,
joined to it once, however many leaves the block has.

Rows with equal ids ascend by leaf; equal rows have equal leaves, so their order does not matter, but each has a place.
NULL ids come first. A NULL field is written ``-``, an empty one ``0:``. Texts are hashed whole and by the JVM, and
only their digests are shuffled. An empty table has no rows and no root. Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera.llm.common import col, lean
from tempera.operators.lookup import Lookup
from tempera.session import materialise

FANOUT = 16
BLOCK_LEVELS = 2
BLOCK = FANOUT**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition
FOREST = "*"
PATH = "array<struct<run:binary,place:int>>"
PATH_ARROW = pa.list_(pa.struct([("run", pa.binary()), ("place", pa.int32())]))


# --- the tree of one block ------------------------------------------------------------------


def digest(hexes: str) -> str:
    return hashlib.sha256(hexes.encode()).hexdigest()


@dataclass
class Run:
    """Consecutive siblings. Once hashed, it knows the run that its hash stands in."""

    nodes: list[str] = field(default_factory=list)
    above: Run | None = None
    place: int = 0


class Tree:
    """Nodes appended one after the other. Each append returns the partial witness: a run and a place in it."""

    def __init__(self) -> None:
        self.open = [Run()]

    def append(self, node: str, level: int = 0) -> tuple[Run, int]:
        if level == len(self.open):
            self.open.append(Run())
        run = self.open[level]
        run.nodes.append(node)
        if len(run.nodes) == FANOUT:
            self._complete(level)
        return run, len(run.nodes) - 1

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], Run()
        run.above, run.place = self.append(digest("".join(run.nodes)), level + 1)

    def close(self, levels: int) -> str:
        """Hash the runs that are still open below ``levels``; the one node there is the root."""
        for level in range(levels):
            if self.open[level].nodes:
                self._complete(level)
        return self.open[levels].nodes[0]


def path(run: Run | None, place: int, levels: int) -> list[tuple[str, int]]:
    """The witness of a node: the runs it is in, as text, and its place in each."""
    out = []
    for _ in range(levels):
        out.append(("".join(run.nodes), place))
        run, place = run.above, run.place
    return out


def levels_of(nodes: int) -> int:
    """How often ``nodes`` are hashed until one is left, within one block."""
    levels = 0
    while nodes > 1 and levels < BLOCK_LEVELS:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def grow(nodes: list[bytes], total: int) -> tuple[str, list[list[tuple[str, int]]]]:
    """Root of a block of a tree with ``total`` nodes, and the witness of each node within the block."""
    tree, levels = Tree(), levels_of(total)
    places = [tree.append(n.hex()) for n in nodes]
    root = tree.close(levels)
    return root, [path(run, place, levels) for run, place in places]


def fold(node: str, witness: list[tuple[str, int]]) -> str:
    """The root that follows from a node and its siblings."""
    for run, place in witness:
        node = digest(run[: 64 * place] + node + run[64 * (place + 1) :])
    return node


def siblings(witness: list[tuple[str, int]]) -> str:
    return "".join(run[: 64 * place] + run[64 * (place + 1) :] for run, place in witness)


# --- leaves and their places ----------------------------------------------------------------


def leaf(values: list[Column]) -> Column:
    """SHA-256 of the values, each with its length in bytes."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*sized), 256))


def leaves(
    docs: DataFrame, claimed: dict[str, Column] | None = None, id: str = "doc_id", group: str = "source", fields=FIELDS
) -> DataFrame:
    """``id``, ``tree``, ``hash`` and ``claim`` of every row.

    ``claimed`` has other values of some fields: the claim is the leaf they make, NULL where it is the same.
    """
    own = leaf([col(f) for f in fields])
    other = leaf([(claimed or {}).get(f, col(f)) for f in fields])
    claim = F.nullif(other, own) if claimed else F.lit(None).cast("binary")
    tree = F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit("-"))
    return docs.select(col(id).alias("id"), tree.alias("tree"), own.alias("hash"), claim.alias("claim"))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``at``, the place of a row in its ``tree`` by ``order``, and ``n``, the rows of that tree.

    A range shuffle sorts all rows, whatever the size of a tree. A partition then has a stretch of each of its
    trees, and the stretches before it are counted in a table of a row for each.
    """
    keys = ["tree", *order, "_tie"]
    rows = nodes.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    # Written once: the cut points come from a sample, and all that follows must see the same ones.
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_row", ROW_BITS))
    stretches = rows.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_size"))
    before = W.partitionBy("tree").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = stretches.select(
        F.col("tree").alias("_tree"),
        F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_size").over(W.partitionBy("tree")).alias("_n"),
    )
    found = Lookup(starts).join(rows, {"tree": "_tree", "_part": "_of"}, {"_shift": "_shift", "_n": "n"}, "inner")
    return found.withColumn("at", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


# --- blocks, upwards and down again ----------------------------------------------------------


def blocks(nodes: DataFrame) -> DataFrame:
    """``tree``, ``n``, ``block`` and its ``members`` in order; a block is bounded."""
    rest = [c for c in nodes.columns if c not in ("tree", "n", "at")]
    grouped = nodes.groupBy("tree", "n", F.expr(f"at div {BLOCK}").alias("block"))
    return grouped.agg(F.sort_array(F.collect_list(F.struct("at", *rest))).alias("members"))


def _with_roots(table: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            totals, members = b.column("n").to_pylist(), b.column("members")
            nodes = pa.array([[m["hash"] for m in ms] for ms in members.to_pylist()], pa.list_(pa.binary())).to_pylist()
            roots = [bytes.fromhex(grow(hs, n)[0]) for hs, n in zip(nodes, totals, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(roots, pa.binary())], names=[*b.schema.names, "root"])

    return lean(table).mapInArrow(run, f"{_schema(table)}, root binary")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def rise(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of every round, with their roots, which are the nodes of the next one. The number of rounds grows
    with the logarithm of the largest tree."""
    rounds = []
    while True:
        rounds.append(materialise(_with_roots(blocks(nodes))))
        large = rounds[-1].filter(F.col("n") > BLOCK)
        if large.isEmpty():
            return rounds
        nodes = large.select(
            "tree", F.col("root").alias("hash"), F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n")
        )


def _above(table: DataFrame, carried: list[str]) -> DataFrame:
    """For every member of the blocks, as a block of the round below, what stands above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                inner = grow([m["hash"] for m in row["members"]], row["n"])[1]
                paths = [[*_stored(w), *row["path"]] for w in inner]
                same = [pa.array([row[c]] * len(inner), b.schema.field(c).type) for c in ["tree", *carried]]
                at = pa.array([m["at"] for m in row["members"]], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*same, at, pa.array(paths, PATH_ARROW)], names=["tree", *carried, "at", "path"]
                )

    kept = {f.name: f.dataType.simpleString() for f in table.schema}
    named = ", ".join(f"{c} {kept[c]}" for c in ["tree", *carried])
    return lean(table).mapInArrow(run, f"{named}, at bigint, path {PATH}")


def _stored(witness: list[tuple[str, int]]) -> list[dict]:
    return [{"run": bytes.fromhex(run), "place": place} for run, place in witness]


def _read(stored: list[dict]) -> list[tuple[str, int]]:
    return [(s["run"].hex(), s["place"]) for s in stored]


def descend(rounds: list[DataFrame], tops: DataFrame | None, carried: list[str]) -> DataFrame:
    """The lowest blocks with what stands above them.

    ``tops`` has the ``path`` above each whole ``tree`` and the columns ``carried`` down; without it nothing does.
    """
    above = None
    for number in range(len(rounds) - 1, -1, -1):
        table = rounds[number]
        top = table.filter(F.col("n") <= BLOCK)
        if tops is None:
            joined = top.withColumn("path", F.array().cast(PATH))
        else:
            joined = top.join(tops, "tree")
        if above is not None:
            below = above.withColumnRenamed("at", "block")
            joined = joined.unionByName(table.filter(F.col("n") > BLOCK).join(below, ["tree", "block"]))
        if number == 0:
            return joined
        above = materialise(_above(joined, carried))
    raise ValueError("no rounds")


def witnesses(nodes: DataFrame) -> DataFrame:
    """For rows of ``id``, ``tree``, ``hash`` and ``claim``: the leaf, its ``subroot`` and the ``root``, digest and
    bytes of its ``siblings``, and the root that follows from its claim (its own leaf without one) and them."""
    nodes = materialise(nodes)
    rounds = rise(placed(nodes, ["id", "hash"]))
    subroots = [r.filter(F.col("n") <= BLOCK).select("tree", F.col("root").alias("hash")) for r in rounds]
    subroots = materialise(_union(subroots))
    grove = rise(placed(subroots.select(F.lit(FOREST).alias("tree"), F.col("tree").alias("of"), "hash"), ["of"]))
    root = [r["root"] for r in grove[-1].filter(F.col("n") <= BLOCK).select("root").collect()]  # one row, or none
    rows = descend(grove, None, []).drop("tree")
    tops = materialise(_tops(rows))
    low = descend(rounds, tops, ["subroot"])
    return lean(low).mapInArrow(_proofs(bytes(root[0]).hex() if root else ""), _proof_schema(nodes))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _tops(table: DataFrame) -> DataFrame:
    """``tree``, its ``subroot`` and the ``path`` above it, for the members of the lowest blocks of the forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                inner = grow([m["hash"] for m in row["members"]], row["n"])[1]
                paths = [[*_stored(w), *row["path"]] for w in inner]
                trees = pa.array([m["of"] for m in row["members"]], pa.string())
                hashes = pa.array([m["hash"] for m in row["members"]], pa.binary())
                yield pa.RecordBatch.from_arrays([trees, hashes, pa.array(paths, PATH_ARROW)], names=["tree", "subroot", "path"])

    return lean(table).mapInArrow(run, f"tree string, subroot binary, path {PATH}")


def _proof_schema(nodes: DataFrame) -> str:
    return (
        f"id {nodes.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, "
        "proof_bytes bigint, proof_sha256 string, folded_root string"
    )


def _proofs(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.schema.field("members").type.value_type.field("id").type
            for row in b.to_pylist():
                members, above, subroot = row["members"], _read(row["path"]), row["subroot"].hex()
                out: list[tuple] = []
                beyond = siblings(above)
                for m, inner in zip(members, grow([m["hash"] for m in members], row["n"])[1], strict=True):
                    proof = siblings(inner) + beyond
                    claim = m["hash"] if m["claim"] is None else m["claim"]
                    folded = fold(claim.hex(), [*inner, *above])
                    out.append((m["id"], m["hash"].hex(), subroot, root, len(proof), digest(proof), folded))
                types = [ids, pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                names = ["id", "leaf", "subroot", "root", "proof_bytes", "proof_sha256", "folded_root"]
                columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


#: The same in the SQL of another engine: eight levels of a group and eight of groups, enough for 16^8 of each.
def _sql() -> str:
    def sized(name: str) -> str:
        return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"

    def tree(prefix: str, first: str, levels: int) -> list[str]:
        """Levels of nodes (g, i, h); ``n`` is how many of g are left. A single node goes on unchanged."""
        out = [f"{prefix}0 AS ({first})"]
        for k in range(levels):
            last = f"{prefix}{k}"
            out.append(f"""{last}n AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {last}),
            {prefix}{k + 1} AS MATERIALIZED (SELECT g, i // {FANOUT} AS i,
                CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
                FROM {last}n GROUP BY g, i // {FANOUT})""")
        return out

    def climb(prefix: str, start: str, levels: int) -> list[str]:
        """From rows (r, g, i, now, proof): fold them up the levels of ``prefix``."""
        out = [f"{prefix}up0 AS ({start})"]
        for k in range(levels):
            # The siblings of a row: the digests of its run before and behind it. A single node has none.
            out.append(f"""{prefix}up{k + 1} AS MATERIALIZED (SELECT u.r, u.g, u.i // {FANOUT} AS i,
                CASE WHEN any_value(s.n) = 1 THEN any_value(u.now) ELSE sha256(
                    coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < u.i), '') || any_value(u.now) ||
                    coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > u.i), '')) END AS now,
                any_value(u.proof) || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i <> u.i), '') AS proof
                FROM {prefix}up{k} u JOIN {prefix}{k}n s ON s.g = u.g AND s.i // {FANOUT} = u.i // {FANOUT}
                GROUP BY u.r, u.g, u.i)""")
        return out

    levels = 8
    byte = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN
        string_split(CAST(doc_id AS VARCHAR), '')]), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda c, j: {byte})))"""
    fields = " || ".join(sized(f) for f in FIELDS)
    tampered = " || ".join("coalesce(strlen(low) || ':' || low, '-')" if f == "text" else sized(f) for f in FIELDS)
    low = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
    steps = [
        f"""d AS (SELECT *, coalesce({crc} % 5 = 0, false) AS hit, {low} AS low,
            coalesce('=' || source, '-') AS g FROM documents)""",
        f"""l AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, g, sha256({fields}) AS leaf,
            CASE WHEN hit THEN sha256({tampered}) ELSE sha256({fields}) END AS claim FROM d)""",
        """p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i
            FROM l)""",
        *tree("a", "SELECT g, i, leaf AS h FROM p", levels),
        *tree("b", f"SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, g AS of FROM a{levels}", levels),
        *climb("a", "SELECT r, g, i, claim AS now, '' AS proof FROM p", levels),
        *climb("b", f"SELECT u.r, 0 AS g, b0.i, u.now, u.proof FROM aup{levels} u JOIN b0 ON b0.of = u.g", levels),
    ]
    return f"""WITH {", ".join(steps)}
        SELECT p.doc_id, p.leaf, a{levels}.h AS subroot, b{levels}.h AS root, sha256(u.proof) AS proof_sha256,
            u.now AS folded_root, u.now = b{levels}.h AS verified, strlen(u.proof) AS proof_bytes
        FROM p JOIN a{levels} USING (g) JOIN bup{levels} u USING (r) CROSS JOIN b{levels}"""


SQL = _sql()
