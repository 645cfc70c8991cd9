"""Re-Pair archives of token ids.

Documents are sorted by id over range partitions (shards), encoded, and packed in blocks of about a million
ids. In a block, frequent pairs of neighbouring ids are replaced by new ids, round after round at a falling
threshold and then until no pair is frequent; no pair spans two documents. In a run of one id every other pair is
replaced, so a run and a passage that is copied often shrink to a few symbols. A block stores the rules in the order of their making, the length of
each rule's expansion and the remaining symbols, so any document or range of ids is decoded without the
rest.

The archive is a Parquet table with one row per block:

    shard, block     place of the block; shards and blocks ascend with doc_id
    start            ids of the shard before the block
    n_tokens         ids in the block
    doc_ids, n_ids   the documents in order, and how many ids each has
    n_symbols        symbols that each document takes
    first            the smallest new id; rule k makes the id first + k
    rules            left and right id of each rule, unsigned 32-bit little-endian
    lengths          ids that each rule expands to, likewise
    symbols          the compressed ids, likewise

NULL text is empty; every document ends with the end id, so an empty one has that alone. Rows with the same
``doc_id`` are kept, in the order of a hash of their text; a NULL id comes first. An empty table gives an
archive without blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempera.llm.bpe import encoder
from tempera.llm.common import bytes_of, slices

END = 2
BLOCK = 1 << 20
#: A pair must occur once in so many symbols to be replaced, round by round; the last goes on until no pair does.
ROUNDS = (1 << 10, 1 << 12, 1 << 14, 1 << 16, 1 << 17)
LEAST = 4
LEAST_USES = 3
SLOT_BITS = 18
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SPREADS = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
SCHEMA = (
    "shard int, block int, start bigint, n_tokens bigint, doc_ids array<bigint>, n_ids array<bigint>, "
    "n_symbols array<bigint>, first bigint, rules binary, lengths binary, symbols binary"
)


def compress(ids: np.ndarray, ends: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules and the mask of document ends among the symbols.

    The first rounds look at all pairs, at falling thresholds. From then on only pairs with a symbol of the round before,
    or that lost a place in it, can be frequent; rounds over these few go on until no pair is. They leave gaps in the
    sequence, which are closed at the end.
    """
    rules, seq, last = [np.zeros((0, 2), np.uint32)], ids.astype(np.uint32), ends.copy()
    made, places = first, np.zeros(0, np.int64)
    for share in ROUNDS:
        new, at, names, waits = chosen(seq[:-1], seq[1:], last[:-1], max(LEAST, len(seq) // share), made)
        rules.append(new)
        made += len(new)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq[at], last[at] = names, last[at + 1]
        # Taking by number is several times as fast as by a mask.
        kept = np.flatnonzero(keep)
        if share == ROUNDS[-1]:
            look = np.zeros(len(seq), bool)
            look[at] = look[waits] = True
            places = np.flatnonzero(look[kept])
        seq, last = seq[kept], last[kept]
    n = len(seq)
    live, following, before = np.ones(n, bool), np.arange(1, n + 1), np.arange(-1, n)
    while len(places):
        places = np.sort(np.concatenate((places, before[places])))
        places = places[np.flatnonzero(np.append(True, places[1:] != places[:-1]) & (places >= 0) & live[places])]
        places = places[np.flatnonzero(following[places] < len(seq))]
        next_ = following[places]
        new, at, names, waits = chosen(seq[places], seq[next_], last[places], max(LEAST, n // ROUNDS[-1]), made, next_[:-1] == places[1:])
        if not len(at):
            break
        at, waits = places[at], places[waits]
        rules.append(new)
        made += len(new)
        gone = following[at]
        seq[at], last[at] = names, last[gone]
        live[gone], n = False, n - len(gone)
        following[at] = following[gone]
        before[following[at]] = at
        places = np.concatenate((waits, at))
    return seq[live], np.ascontiguousarray(np.concatenate(rules)), last[live]


def chosen(
    left: np.ndarray, right: np.ndarray, closed: np.ndarray, least: int, made: int, meet: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """New rules, numbered from ``made``, for the frequent pairs of ``left`` and ``right`` symbols: where they apply,
    under which name, and where they had to wait. ``meet`` tells which neighbouring pairs share a symbol, by default all."""
    pairs, at, rank = frequent(left, right, closed, least, made)
    near = np.diff(at) == 1
    won = winners(near if meet is None else near & meet[at[:-1]] if len(meet) else near, rank)
    # A rule that few places use is longer than what it saves.
    uses = np.bincount(rank[np.flatnonzero(won)], minlength=len(pairs))
    names = np.zeros(len(pairs), np.uint32)
    used = np.flatnonzero(uses >= LEAST_USES)
    names[used] = made + np.arange(len(used))
    new = pairs[used].view("<u4").reshape(-1, 2)[:, ::-1]
    useful = (uses >= LEAST_USES)[rank]
    some, waits = np.flatnonzero(won & useful), np.flatnonzero(useful & ~won)
    return new, at[some], names[rank[some]], at[waits]


def winners(meet: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the ascending places are replaced, if neighbours ``meet``: the better pair where two overlap, every other
    place in a run of one pair. A loser may wait for a later round."""
    before, after = rank[:-1], rank[1:]
    won = np.ones(len(rank), bool)
    won[1:] &= ~(meet & (after > before))
    won[:-1] &= ~(meet & (after < before))
    runs = np.flatnonzero(meet & (after == before)) + 1
    if len(runs):
        number = np.arange(len(runs))
        begins = np.append(True, runs[1:] - runs[:-1] > 1)
        won[runs[(number - np.maximum.accumulate(np.where(begins, number, 0))) & 1 == 0]] = False
    return won


def frequent(
    left: np.ndarray, right: np.ndarray, closed: np.ndarray, least: int, made: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of symbols below ``made`` that occur ``least`` times or more, most frequent first; where they occur, and as
    which of them.

    Many pairs are counted by a hash first: only those whose slot is full enough need sorting.
    """
    looked = ~closed
    if len(left) > 1 << SLOT_BITS:
        slot = left * SPREADS[0]
        slot += right * SPREADS[1]
        slot >>= np.uint32(32 - SLOT_BITS)
        slot = slot.astype(np.intp)
        looked &= (np.bincount(slot, minlength=1 << SLOT_BITS) >= least)[slot]
    at = np.flatnonzero(looked)
    ordered, order = grouped(left[at], right[at], made)
    starts = np.flatnonzero(np.append(len(at) > 0, ordered[1:] != ordered[:-1])[: len(at)])
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(counts >= least)
    pairs = at[order[starts[often]]]
    pairs = (left[pairs].astype(np.uint64) << np.uint64(32)) | right[pairs]
    if not len(pairs):
        return pairs, at[:0], at[:0]
    # Equally frequent pairs are ranked by a hash: in a repeated passage a third of them then wins a round.
    best = np.lexsort((pairs * SPREAD, -counts[often]))
    rank = np.full(len(counts), -1)
    rank[often[best]] = np.arange(len(pairs))
    ranks = np.empty(len(at), np.int64)
    ranks[order] = np.repeat(rank, counts)
    some = np.flatnonzero(ranks >= 0)
    return pairs[best], at[some], ranks[some]


def grouped(left: np.ndarray, right: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each pair of symbols below ``made``, ascending, and the place of each; equal pairs in any order."""
    bits, place = int(made).bit_length(), len(left).bit_length()
    if 2 * bits + place > 64:
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        order = np.argsort(key)
        return key[order], order
    # The place in the lowest bits: one plain sort is several times as fast as sorting places by their pairs.
    key = left.astype(np.uint64) << np.uint64(bits)
    key |= right
    key <<= np.uint64(place)
    key |= np.arange(len(key), dtype=np.uint64)
    key.sort()
    return key >> np.uint64(place), (key & np.uint64((1 << place) - 1)).view(np.int64)


def levels(rules: np.ndarray, first: int) -> Iterator[np.ndarray]:
    """Places of all rules, each in a later step than the rules that it uses."""
    known, todo = np.arange(first + len(rules)) < first, np.arange(len(rules))
    while len(todo):
        ready = known[rules[todo]].all(axis=1)
        now, todo = todo[ready], todo[~ready]
        known[first + now] = True
        yield now


def rule_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule stands for; a rule uses only rules made before it."""
    out = np.ones(first + len(rules), np.uint32)
    for now in levels(rules, first):
        out[first + now] = out[rules[now, 0]] + out[rules[now, 1]]
    return out[first:]


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids of ``symbols``, level by level."""
    while (made := symbols >= first).any():
        at = np.cumsum(np.where(made, 2, 1))
        out = np.empty(at[-1], np.uint32)
        out[at - 1] = symbols
        pairs = rules[symbols[made] - first]
        out[at[made] - 2], out[at[made] - 1] = pairs[:, 0], pairs[:, 1]
        symbols = out
    return symbols


def expand_all(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """As ``expand``, for a whole block: every rule is spelled once and copied wherever it is used."""
    n = np.concatenate((np.ones(first, np.int64), lengths))
    starts = np.cumsum(n) - n
    spelled = np.empty(n.sum(), np.uint32)
    spelled[:first] = np.arange(first)
    for now in levels(rules, first):
        parts, made = rules[now].reshape(-1), first + now
        spelled[ranges(starts[made], n[made])] = spelled[ranges(starts[parts], n[parts])]
    return spelled[ranges(starts[symbols], n[symbols])]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length."""
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(len(at))
    return at


def ids_between(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, expanding only the symbols that touch them."""
    symbols, first = np.frombuffer(block["symbols"], "<u4"), block["first"]
    lengths = np.concatenate((np.frombuffer(block["lengths"], "<u4"), [1])).astype(np.int64)
    each = lengths[np.where(symbols >= first, symbols.astype(np.int64) - first, len(lengths) - 1)]
    ends = np.cumsum(each)
    i, j = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    begin = int(ends[i] - each[i]) if i < len(ends) else start
    rules = np.frombuffer(block["rules"], "<u4").reshape(-1, 2)
    return expand(symbols[i:j], rules, first)[start - begin : stop - begin]


def write_archive(docs: DataFrame, path: str, folder: str, id: str = "doc_id", text: str = "text") -> None:
    """Encode all documents with the tokenizer file ``path`` and write the archive to ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, shard = encoder(path), TaskContext.get().partitionId()
        end, docs, block, before = np.uint32(END).tobytes(), [], 0, 0

        def packed() -> pa.RecordBatch:
            n_ids = np.array([len(ids) // 4 for _, ids in docs], np.int64)
            ends = np.zeros(n_ids.sum(), bool)
            ends[np.cumsum(n_ids) - 1] = True
            ids = np.frombuffer(b"".join(ids for _, ids in docs), "<u4")
            symbols, rules, last = compress(ids, ends, e.size)
            row = {
                "shard": shard,
                "block": block,
                "start": before,
                "n_tokens": len(ids),
                "doc_ids": [d for d, _ in docs],
                "n_ids": n_ids,
                "n_symbols": np.diff(np.flatnonzero(last), prepend=-1),
                "first": e.size,
                "rules": rules.astype("<u4").tobytes(),
                "lengths": rule_lengths(rules, e.size).astype("<u4").tobytes(),
                "symbols": symbols.astype("<u4").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], SCHEMA_ARROW)

        size = 0
        for b in slices(batches, "text"):
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                docs.append((d, e.encode_whole(t) + end))
                size += len(docs[-1][1]) // 4
                if size >= BLOCK:
                    yield packed()
                    docs, block, before, size = [], block + 1, before + size, 0
        if docs:
            yield packed()

    source = bytes_of(docs, id, text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    order = ["doc_id", F.xxhash64("text")]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(folder)


LONGS = pa.list_(pa.int64())
SCHEMA_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64())]
    + [(c, LONGS) for c in ("doc_ids", "n_ids", "n_symbols")]
    + [("first", pa.int64()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())]
)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids``, packed as unsigned 32-bit little-endian integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
                symbols, lengths = (np.frombuffer(row[c], "<u4") for c in ("symbols", "lengths"))
                ids = expand_all(symbols, rules, lengths, row["first"]).astype("<u4")
                ends = np.cumsum(row["n_ids"])
                packed = [p.tobytes() for p in np.split(ids, ends[:-1])]
                columns = {
                    "shard": pa.array([row["shard"]] * len(packed), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "in_shard": pa.array(row["start"] + ends - row["n_ids"]),
                    "n_tokens": pa.array(row["n_ids"], pa.int64()),
                    "ids": pa.array(packed, pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    archive = spark.read.schema(SCHEMA).parquet(folder)
    docs = archive.mapInArrow(run, "shard int, doc_id bigint, in_shard bigint, n_tokens bigint, ids binary")
    return docs.join(F.broadcast(shard_starts(archive)), "shard").select(
        "doc_id", (F.col("before") + F.col("in_shard")).alias("start"), "n_tokens", "ids"
    )


def shard_starts(archive: DataFrame) -> DataFrame:
    """Ids before each shard. One row per shard, of which there are no more than shuffle partitions."""
    sums = archive.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
