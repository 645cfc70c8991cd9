"""Secret scans: fixed patterns, and novelty under a primed zstandard compressor.

Beside the fixed patterns, every long string that follows a sensitive word is a candidate, with digits or
without. Its novelty is what it adds to the compressed size of the text around it, with a dictionary of common
identifiers primed: names and repeated strings cost little, random ones as much as their alphabet allows.
Short texts are filled up with prose, since what one string adds to a few words says little.
Candidates near that limit are reported as kind ``novel``. A string directly after a reported one counts as
in the same context, as in a key over several lines.

Starts and ends are code points, the end exclusive. NULL and empty texts have no spans; repeated rows give
repeated results. Columns other than the named ones are carried untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempera.llm.common import col, lean, slices

KINDS = ("assign", "access", "hex", "novel")
BASE = KINDS[:3]
LEAST_HEX = 24
LEAST_ACCESS = 20
LEAST_ASSIGNED = 6
JOINS = "/+=._-"  # what may join a secret to a span of the fixed patterns
LEAST_NOVEL = 16
CONTEXT = 64  # characters before a candidate in which a sensitive word must stand
AROUND = 512  # characters on either side that prime the compressor
#: Least added size as a multiple of what a random string of the candidate's alphabet needs. Framing and a code made
#: for the text around add to the size of random strings; names joined from common parts mostly stay below 1.
NOVEL = 1.1
FILLED = 600  # characters that the text around a candidate is filled up to
MASK = "[SECRET]"

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}")
HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
HEX_BYTES = re.compile(HEX.pattern.encode())
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{LEAST_NOVEL},}}")
SENSITIVE = ("key", "token", "secret", "passw", "pwd", "auth", "bearer", "credential", "private", "signature")
SENSITIVE_WORD = re.compile("|".join(SENSITIVE), re.I | re.A)
SENSITIVE_BYTES = [w.encode() for w in SENSITIVE]
#: Parts of names in code and configuration, joined in the usual ways to prime the compressor.
PARTS = (
    "access account address admin api app array auth base bool buffer build byte cache call char class client code "
    "config connect const content context count data date debug default delete description dict document enable "
    "encode error event example export false field file filter float format function get group handler hash header host "
    "http https id image import index info init input int integer item json key label length level line list load local "
    "log main map max message method min model module name new next node none null number object option order output "
    "package page param parse password path port prefix private process property public query read request response "
    "result return root route run save schema secret self server service session set size source start state static "
    "status store stream string struct sum table task test text time title token true type update url user utf value "
    "version view void width window write www xml yaml 0123456789 2000 2010 2020 2024 2025 com org net"
).split()
#: Prose that shares few strings with ``PARTS``.
PROSE = (
    "Quiet mornings by the harbour bring fishermen, gulls and a faint smell of tar; nobody hurries before eight. Jackets "
    "hang beside wet ropes, while Mrs. Oxley weighs mackerel, haddock and crab (always fresh) on brass scales. Zinc buckets "
    "knock together, voices drift up from below, and Victor, who once sailed to Quebec, explains how fog swallows sound. By "
    "noon everything has changed: tourists arrive, buy ices, take pictures, ask whether dolphins ever visit. They do, "
    "rarely, in June. Afterwards we walk home along Kiln Street, past 12 gardens full of phlox."
)


@lru_cache(maxsize=1)
def compressor() -> zstandard.ZstdCompressor:
    pairs = zip(PARTS, PARTS[7:] + PARTS[:7], strict=True)
    joined = [f"{a}_{b} {a}{b.title()} {a}-{b} {a}.{b} {a.upper()}_{b.upper()}" for a, b in pairs]
    names = zstandard.ZstdCompressionDict(" ".join(joined).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=names, write_content_size=False, write_checksum=False)


def novelty(text: str, start: int, end: int) -> float:
    """Bytes that ``text[start:end]`` adds to the compressed text around it, per character."""
    near = text[max(0, start - AROUND) : start] + "\n" + text[end : end + AROUND]
    around = (PROSE[: max(0, FILLED - len(near))] + "\n" + near).encode("utf-8", "replace")
    size = compressor().compress
    return (len(size(around + b"\n" + text[start:end].encode())) - len(size(around + b"\n"))) / (end - start)


def alphabet_bytes(candidate: str) -> float:
    """Bytes per character of a random string over the smallest usual alphabet that holds the candidate."""
    if not candidate.strip("0123456789"):
        return 3.32 / 8
    if not candidate.lower().strip("0123456789abcdef"):
        return 4 / 8
    one_case = candidate in (candidate.lower(), candidate.upper())
    if candidate.isalpha():
        return (4.7 if one_case else 5.7) / 8
    return (5.17 if one_case else 6) / 8


def scan(raw: bytes) -> list[tuple[str, int, int, int, float | None]]:
    """Spans as (kind, start, end, start of the secret itself, novelty), by start and then kind."""
    low = raw.lower()
    sensitive = any(w in low for w in SENSITIVE_BYTES)
    if not (sensitive or b"AKIA" in raw or HEX_BYTES.search(raw)):
        return []
    text = raw.decode("utf-8", "replace")
    found = [("hex", m.start(), m.end(), m.start(), None) for m in HEX.finditer(text)]
    found += [("access", m.start(), m.end(), m.start(), None) for m in ACCESS.finditer(text)]
    if sensitive:
        matches = [m for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGNED]
        found += [("assign", m.start(), m.end(), m.start(1), None) for m in matches]
        found += novel(text, sorted((s, e) for _, s, e, _, _ in found))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def novel(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int, int, float]]:
    """Incompressible strings in a sensitive context. What spans of the fixed patterns cover is cut out first."""
    out, after, at, reach = [], -1, 0, -1
    for m in CANDIDATE.finditer(text):
        begin, stop = m.start(), m.start() + len(m[0].rstrip(".="))
        sensitive, left, pieces = None, begin, []
        covered = reach > begin
        while at < len(taken) and taken[at][0] < stop:
            if taken[at][0] > max(left, reach):
                pieces.append((max(left, reach), taken[at][0]))
            reach, covered = max(reach, taken[at][1]), covered or taken[at][1] > begin
            left = max(left, reach)
            at += 1
        if max(left, reach) < stop:
            pieces.append((max(left, reach), stop))
        for start, end in pieces:
            if covered:
                start, end = start + len(text[start:end]) - len(text[start:end].lstrip(JOINS)), start + len(text[start:end].rstrip(JOINS))
            if end - start < LEAST_NOVEL:
                continue
            if sensitive is None:
                sensitive = 0 <= begin - after <= 2 or SENSITIVE_WORD.search(text, max(0, begin - CONTEXT), begin) is not None
            if sensitive:
                added = novelty(text, start, end)
                if added >= NOVEL * alphabet_bytes(text[start:end]):
                    out.append(("novel", start, end, start, round(added, 4)))
                    after = m.end()
    return out


def masked(raw: bytes, spans: list) -> str:
    """The text with every secret replaced by ``MASK``; secrets that overlap become one."""
    text, out, at = raw.decode("utf-8", "replace"), [], 0
    for start, end in sorted((s[3], s[2]) for s in spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = "struct<kind:string,start:bigint,end:bigint,value_start:bigint,novelty:double>"
SPAN_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
        + [("value_start", pa.int64()), ("novelty", pa.float64())]
    )
)


def find(docs: DataFrame, text: str = "text", mask: bool = False, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns, all by default), ``spans`` and, if ``mask``, the ``clean_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = b.column("text").to_pylist()
            spans = [scan(t) for t in texts]
            names = [f.name for f in SPAN_ARROW.value_type]
            dicts = [[dict(zip(names, s, strict=True)) for s in found] for found in spans]
            out = [b.column("row"), pa.array(dicts, SPAN_ARROW)]
            if mask:
                clean = [masked(t, s) if s else t.decode("utf-8", "replace") for t, s in zip(texts, spans, strict=True)]
                out.append(pa.array(clean, pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=["row", "spans", "clean_text"][: len(out)])

    columns = docs.columns if carry is None else carry
    bytes_ = F.coalesce(col(text), F.lit("")).cast("binary").alias("text")
    source = lean(docs.select(F.struct(*[col(c) for c in columns]).alias("row"), bytes_))
    row = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {row}, spans array<{SPAN}>" + ", clean_text string" * mask)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
