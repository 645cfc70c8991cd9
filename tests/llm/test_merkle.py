"""The Merkle manifest against a plain build of the tree, and its SQL."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from brute import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import assert_same, connect
from pyspark.sql import functions as F

from tempera.llm import merkle
from tempera.llm import queries as registered


def h(text):
    return sha256(text.encode()).hexdigest()


def levels(nodes):
    """All levels of a tree: 16 consecutive nodes become one."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def witness(tree, at):
    """(digests before, digests behind) of a node, level by level."""
    out = []
    for level in tree[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        out.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        at //= 16
    return out


def plain(rows):
    """Counter of result rows for (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0], leaf(row), row))
    trees, out = {}, Counter()
    for g, members in groups.items():
        members.sort(key=lambda m: m[:3])
        trees[g] = levels([m[2] for m in members])
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    forest = levels([trees[g][-1][0] for g in order])
    for g, members in groups.items():
        for at, (_, id, own, row) in enumerate(members):
            proof = witness(trees[g], at) + witness(forest, order.index(g))
            hit = id is not None and zlib.crc32(str(id).encode()) % 5 == 0
            low = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            now = leaf((*row[:4], low)) if hit else own
            for before, behind in proof:
                now = h(before + now + behind)
            out[id, own, trees[g][-1][0], forest[-1][0], h("".join(b + a for b, a in proof)), now, now == forest[-1][0]] += 1
    return out


def result(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = registered.op11_merkle(spark, str(tmp_path))
    columns = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return Counter(tuple(r) for r in rows.select(columns).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


def test_odd_rows(spark, odd, tmp_path):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    assert result(spark, tmp_path, odd) == plain(rows)


@pytest.mark.parametrize("sizes", [[1], [2], [16, 17], [256, 257, 1], [4097, 300]])
def test_sizes_around_the_blocks(spark, tmp_path, sizes):
    """One group far larger than the others, with a third of its ids equal or NULL."""
    rows = []
    for g, n in enumerate(sizes):
        ids = [None if i % 7 == 3 else 5 if i % 3 == 0 else i for i in range(n)]
        rows += [(d, [None, "é", "z\U0001f600"][g], "en", i % 2, f"Text {i // 2}") for i, d in enumerate(ids)]
    assert result(spark, tmp_path, table(spark, rows)) == plain(rows)


def test_many_groups(spark, tmp_path):
    """More groups than a block holds: the forest needs two rounds."""
    rows = [(i, f"s{i % 613}", None, None, f"T{i}") for i in range(1300)]
    assert result(spark, tmp_path, table(spark, rows)) == plain(rows)


def test_no_rows(spark, tmp_path):
    assert result(spark, tmp_path, table(spark, [])) == Counter()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_appended_nodes_have_the_witnesses_of_the_whole_tree(n):
    nodes = [sha256(str(i).encode()).digest() for i in range(n)]
    want = levels([x.hex() for x in nodes])
    if n <= merkle.BLOCK:
        root, found = merkle.grow(nodes, n)
        assert root == want[-1][0]
        for i, w in enumerate(found):
            assert [(r[: 64 * p], r[64 * (p + 1) :]) for r, p in w] == witness(want, i)
            assert merkle.fold(nodes[i].hex(), w) == root
    else:
        pieces = [nodes[i : i + merkle.BLOCK] for i in range(0, n, merkle.BLOCK)]
        assert [merkle.grow(p, n)[0] for p in pieces] == want[merkle.BLOCK_LEVELS]


def test_a_witness_grows_with_later_siblings():
    tree = merkle.Tree()
    run, place = tree.append("0" * 64)
    assert merkle.path(run, place, 1) == [("0" * 64, 0)]
    for i in range(1, 16):
        tree.append(str(i % 10) * 64)
        assert len(run.nodes) == i + 1
    assert run.above is tree.open[1] and run.above.nodes == [h("".join(run.nodes))]


def test_places_are_the_order(spark):
    """A tree with most rows is cut over many partitions, and equal rows have a place each."""
    rows = spark.range(5000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("tree"), (F.col("id") % 40).alias("k"))
    found = merkle.placed(rows.repartition(7), ["k"]).collect()
    for t, n in (("a", 4500), ("b", 500)):
        mine = sorted((r.at, r.k) for r in found if r.tree == t)
        assert [at for at, _ in mine] == list(range(n)) and [k for _, k in mine] == sorted(k for _, k in mine)
        assert {r.n for r in found if r.tree == t} == {n}


def test_sql(spark):
    assert assert_same(registered.op11_merkle(spark, SMALL), connect(SMALL), merkle.SQL) == 200
