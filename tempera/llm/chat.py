"""Chat formatting at the level of tokens.

A turn is ``<turn>`` role ``<says>`` text ``</turn>``, where the three marks are reserved ids above the
vocabulary. Role and text are escaped and encoded as segments of their own, in parallel before any shuffle,
and the reserved ids are spliced between them. Conversations are then put in order and laid out over chunks
of bounded size; where a segment begins and ends in its conversation follows from running sums of the
segments' lengths, and the loss mask is the prefix sum of steps +1 and -1 at the ends of the assistants'
texts.

Escaping: in a role or text, a backslash is doubled, and one goes behind the first character of each control
string (the marks and ``### Role:`` headers). So the formatted text has no control string but the
template's, and taking every backslash away but keeping what follows it gives the original. Special tokens
of the vocabulary that occur in a text are encoded as ordinary characters.

The output has one row per chunk: ``conv_id``, ``chunk``, ``start`` (ids of the conversation before it),
``ids`` and ``loss`` (0 or 1 per id). Chunks end with a turn, and only a turn longer than a chunk makes a
longer one.

Turns are ordered by number, a NULL number first, equal ones by role and then text, so the result does not
depend on the order of rows; repeated rows are turns of their own. NULL role and text are empty. Rows with a
NULL ``conv_id`` are one conversation. Extra columns are ignored. An empty table gives no conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempera.llm.bpe import encoder, id_lists
from tempera.llm.common import col, lean, slices

MARKS = ("<turn>", "<says>", "</turn>")
LEARNED = "assistant"
CHUNK = 1 << 16
CONTROL = re.compile(r"\\|" + "|".join(map(re.escape, MARKS)) + r"|### (?=\w+:)")
ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:] if len(m[0]) > 1 else "\\\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def segments(turns: DataFrame, path: str, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Encoded turns: ``conv_id``, ``turn``, ``role``, ``text``, ``ids`` (packed) and the ends of the loss
    in these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, False)
        turn_id, says, end = (np.uint32(e.size + i).tobytes() for i in range(3))
        for b in slices(batches, "text"):
            packed, first, last = [], [], []
            for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                head = turn_id + e.encode(escape(r).encode()) + says
                body = e.encode(escape(t).encode())
                packed.append(head + body + end)
                first.append(len(head) // 4)
                last.append((len(head) + len(body)) // 4 if r == LEARNED else len(head) // 4)
            new = [pa.array(packed, pa.binary()), pa.array(first, pa.int32()), pa.array(last, pa.int32())]
            columns = [b.column("conv_id"), b.column("turn"), b.column("order"), *new]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "order", "ids", "first", "last"])

    named = turns.select(
        col(conv).alias("conv_id"),
        col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    # Ties are rare, so their order travels as a digest; equal digests mean equal turns.
    source = lean(named).withColumn("order", F.sha2(F.concat("role", F.lit("\n"), "text"), 256))
    kinds = {c: named.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, order string, ids binary, first int, last int"
    return source.mapInArrow(run, schema)


def format_conversations(
    turns: DataFrame,
    path: str,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """``conv_id``, ``chunk``, ``start``, ``ids`` and ``loss`` of all conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "chunk", "start", "ids", "loss"]
        current, begun, held, steps, size, number, before = None, False, [], [], 0, 0, 0

        def full() -> pa.RecordBatch:
            change = np.zeros(size + 1, np.int8)
            for first, last in steps:
                change[first] += 1
                change[last] -= 1
            mask = np.cumsum(change[:-1], dtype=np.int8)
            columns = [
                pa.array([current], kind),
                pa.array([number], pa.int32()),
                pa.array([before], pa.int64()),
                id_lists([b"".join(held)]),
                pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(mask)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for b in slices(batches, "ids"):
            kind = b.column("conv_id").type
            rows = zip(*(b.column(c).to_pylist() for c in ("conv_id", "ids", "first", "last")), strict=True)
            for conv_id, ids, first, last in rows:
                other = not begun or conv_id != current
                if held and (other or size + len(ids) // 4 > chunk):
                    yield full()
                    number, before = number + 1, before + size
                    held, steps, size = [], [], 0
                if other:
                    current, begun, number, before = conv_id, True, 0, 0
                held.append(ids)
                steps.append((size + first, size + last))
                size += len(ids) // 4
        if held:
            yield full()

    encoded = segments(turns, path, conv, turn, role, text)
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "order")
    kind = encoded.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, chunk int, start bigint, ids array<int>, loss array<tinyint>"
    return ordered.select("conv_id", "ids", "first", "last").mapInArrow(run, schema)


def turns_of(ids: np.ndarray, loss: np.ndarray, decode, first_mark: int) -> Iterator[tuple[str, str, str, int]]:
    """Role, text and text under the loss mask of each turn, and the length of the turn's formatted text."""
    marks = np.flatnonzero(ids >= first_mark)
    for a, b, c in marks.reshape(-1, 3).tolist():
        role, text = decode(ids[a + 1 : b]), decode(ids[b + 1 : c])
        learned = decode(ids[b + 1 : c][loss[b + 1 : c] == 1])
        length = len(role) + len(text) + sum(map(len, MARKS))
        yield unescape(role), unescape(text), unescape(learned), length


def digest(formatted: DataFrame, path: str) -> DataFrame:
    """Per conversation, from the formatted chunks alone: what its turns and its loss say.

    A conversation's chunks pass one task in order, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, False)
        decode = lambda ids: e.decode(ids).decode("utf-8", "replace")
        current, state = None, None

        def done() -> pa.RecordBatch:
            row = [current, state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"]]
            arrays = [pa.array([v], t) for v, t in zip(row, [kind, *DIGEST_ARROW], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=DIGEST)

        for b in batches:
            kind = b.column("conv_id").type
            for i in range(b.num_rows):
                conv_id = b.column("conv_id")[i].as_py()
                if state is None or conv_id != current:
                    if state:
                        yield done()
                    current = conv_id
                    state = {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0}
                ids = b.column("ids")[i].values.to_numpy()
                loss = b.column("loss")[i].values.to_numpy()
                for role, text, learned, length in turns_of(ids, loss, decode, e.size):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    state["chars"] += len(learned)
                    state["loss"].update(learned.encode())
                    state["size"] += length
        if state:
            yield done()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    return ordered.select("conv_id", "ids", "loss").mapInArrow(run, schema)


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
DIGEST_ARROW = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
