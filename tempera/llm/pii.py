"""Personal data by fixed patterns and bootstrapped contexts, with DataFrame functions alone.

The fixed patterns find e-mail addresses, IP addresses, card and phone numbers; their finds are the seeds.
The seeds, and what every run of words with a digit or an at sign has beside them, are instances; the patterns
of one are the two words before it, and the word before with the word behind it. Patterns and instances form a graph: the confidence of a
pattern is the smoothed mean of its instances', that of an instance which is no seed is the noisy-or of its
patterns', less a decay. Identifiers found so support further patterns as seeds do. When the confidences have
settled, patterns with enough support and confidence report their other instances that look like identifiers,
as kind ``id``.

What a text costs grows little faster than its matches, also if all stand in one line: positions come from running sums, and one
pass over the sorted starts finds what lies between matches.

Starts and ends are code points, the end exclusive; a pattern's finds do not overlap. NULL and empty texts
have no spans. Each row is judged by itself, repeated rows alike; repetition of an instance adds nothing to
the graph. Columns other than the two named ones are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempera.llm.common import SPACES, text_of, words
from tempera.operators.lookup import Lookup
from tempera.session import materialise

# A match that starts inside a run of the first class would have started with the run, unless a match ended
# there. Starting only at these places and never giving characters back makes the search linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
MARKED = rf"[^{SPACES}0-9@]*+[0-9@][^{SPACES}]*+"
INSTANCE = rf"(?<![^{SPACES}]){MARKED}(?:\x20{MARKED})*+"
#: Kind, pattern, and what a text must have for the pattern to be worth trying.
PATTERNS = (
    ("email", EMAIL, r"@"),
    ("ip", IP, r"[0-9]\.[0-9]"),
    ("card", CARD, r"[0-9](?:[\x20-]?[0-9]){12}"),
    ("phone", PHONE, r"\+[0-9]"),
    ("instance", INSTANCE, r"[0-9@]"),
)
KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TRIM_START = r"""[("'\[<{]"""
TRIM_END = r"""[.,;:!?)"'\]>}]"""
BESIDE = rf"""[{SPACES}.,;:!?()"'\[\]<>{{}}|/=&-]"""  # at the ends of what stands beside a match
TOKENS = "array<struct<start:bigint,value:string,kind:string,first:string,last:array<string>>>"
INSTANCE_TYPE = "array<struct<start:bigint,end:bigint,value:string,seed:boolean,patterns:array<string>>>"
REACH = 80  # code points before an instance in which its words are sought
SETTLED = 0.01  # growth of a confidence below which no further round is needed
DECAY = 0.9  # of belief, from a pattern to what it finds
SMOOTHING = 1.0
LEAST_SEEDS = 3
CONFIDENCE = 0.6
CHUNK = 1024  # code points
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. A lambda computes what it captures anew for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """Running sums of an array, or what else ``join`` makes of all values up to each one.

    Appending copies, so it is done in blocks of about the square root of the length: the cost grows with the power 1.5, mostly of
    copying numbers.
    """
    none = F.array().cast("array<bigint>")
    last = lambda a: F.get(a, F.size(a) - 1)

    def short(part: Column) -> Column:
        add = lambda done, x: F.concat(done, F.array(F.coalesce(join(last(done), x), x)))
        return F.aggregate(part, none, lambda done, x: add(done, x.cast("bigint")))

    def blocked(all_: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_))).cast("int")
        count = F.ceil(F.size(all_) / size).cast("int")
        blocks = let(size, lambda n: F.transform(F.sequence(F.lit(1), count), lambda j: short(F.slice(all_, (j - 1) * n + 1, n))))
        before = lambda upto: F.concat(F.array(F.lit(None).cast("bigint")), F.slice(upto, 1, F.greatest(F.size(upto) - 1, F.lit(0))))
        whole = let(
            blocks,
            lambda b: F.zip_with(
                b,
                let(short(F.transform(b, last)), before),
                lambda block, old: F.transform(block, lambda x: F.coalesce(join(old, x), x)),
            ),
        )
        return F.flatten(whole)

    return let(values, lambda v: F.when(F.size(v) > 0, blocked(v)).otherwise(none))


def located(kind: str, values: Column, gaps: Column) -> Column:
    """Spans of ``values``, between which the text has ``gaps``."""
    n = F.size(values)
    steps = F.zip_with(F.slice(gaps, 1, n), values, lambda gap, v: F.length(gap) + F.length(v))
    spans = F.zip_with(
        values,
        running(steps),
        lambda v, end: F.struct(F.lit(kind).alias("kind"), (end - F.length(v)).alias("start"), end.alias("end"), v.alias("value")),
    )
    return F.when(n > 0, spans).otherwise(F.array().cast(SPAN))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    backwards = F.reverse(number)

    def add(sum_: Column, i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return sum_ + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the pattern of ``kind`` is one."""
    n = F.length(digits(value))
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def is_identifier(value: Column) -> Column:
    """At least six characters, four of them digits, or an address."""
    return (F.length(value) >= 6) & ((F.length(digits(value)) >= 4) | value.contains("@"))


def matched(docs: DataFrame) -> DataFrame:
    """``doc_id``, the spans ``base`` and the ``instances`` with the words around them, per row of
    ``doc_id``, ``text``."""
    nothing = F.array().cast("array<string>")
    out = docs.select(
        "doc_id",
        "text",
        *[
            F.when(F.col("text").rlike(sign), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(nothing).alias(k)
            for k, p, sign in PATTERNS
        ],
    )
    gaps = [F.when(F.size(k) > 0, F.split("text", p, -1)).otherwise(nothing).alias(f"{k}_gaps") for k, p, _ in PATTERNS]
    # Short strings that make up the text: a part is then found without reading the text from its start.
    chunks = F.when(F.size("instance") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).otherwise(nothing)
    out = out.select("doc_id", chunks.alias("chunks"), *[k for k, _, _ in PATTERNS], *gaps)
    spans = [located(k, F.col(k), F.col(f"{k}_gaps")).alias(f"{k}_spans") for k, _, _ in PATTERNS]
    out = out.select("doc_id", "chunks", "instance_gaps", *spans)
    base = F.concat(*[checked(k) for k in KINDS])
    out = out.select("doc_id", "chunks", "instance_gaps", "instance_spans", base.alias("base"))
    found = tokens(F.col("chunks"), F.col("base"), F.col("instance_spans"), F.col("instance_gaps"))
    some = F.size("instance_spans") > 0
    return out.select("doc_id", "base", F.when(some, instances(found)).otherwise(F.array().cast(INSTANCE_TYPE)).alias("instances"))


def checked(kind: str) -> Column:
    return F.filter(f"{kind}_spans", lambda s: valid(kind, s["value"]))


def token(start: Column, value: Column, kind: Column | None = None, first: Column | None = None, last: Column | None = None) -> Column:
    """A part of a run or, if it has ``last`` words, the words between two runs."""
    empty = {"kind": kind, "first": first, "last": last}
    kinds = {"kind": "string", "first": "string", "last": "array<string>"}
    rest = [F.lit(None).cast(kinds[n]).alias(n) if c is None else c.alias(n) for n, c in empty.items()]
    return F.struct(start.alias("start"), value.alias("value"), *rest)


def latest(said: Column) -> Column:
    """The last two words."""
    return F.slice(said, F.greatest(F.size(said) - 1, F.lit(1)), 2)


def tokens(chunks: Column, base: Column, runs: Column, gaps: Column) -> Column:
    """A text as matches of the fixed patterns, parts of runs beside them, and the words between runs, in order.

    Matches and gaps between runs cover parts of the text, and may overlap. In the order of their starts, a part is
    what lies between the farthest end so far and the next start; one pass finds all.
    """
    none = F.array().cast("array<string>")

    def gap(g: Column, k: Column) -> Column:
        start = F.coalesce(F.get(runs, k - 1)["end"], F.lit(0).cast("bigint"))
        before = latest(words(F.lower(F.right(g, F.lit(REACH)))))
        behind = F.get(words(F.lower(F.left(g, F.lit(REACH)))), F.lit(0))
        return cover(start, start + F.length(g), F.lit(""), F.lit(None).cast("string"), behind, before)

    def cover(start: Column, end: Column, value: Column, kind: Column, first: Column, last: Column) -> Column:
        names = {"start": start, "order": -end, "end": end, "value": value, "kind": kind, "first": first, "last": last}
        return F.struct(*[c.alias(n) for n, c in names.items()])

    matches = F.transform(
        base, lambda b: cover(b["start"], b["end"], b["value"], b["kind"], F.lit(None).cast("string"), none)
    )
    covers = F.sort_array(F.concat(matches, F.transform(gaps, gap)))

    def between(start: Column, end: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        some = F.slice(chunks, first + 1, (F.floor((end - 1) / CHUNK) + 1).cast("int") - first)
        return F.substring(F.array_join(some, ""), (start % CHUNK + 1).cast("int"), (end - start).cast("int"))

    def each(c: Column, far: Column) -> Column:
        nothing = F.array().cast(TOKENS)
        part = F.when(c["start"] > far, F.array(token(far, between(far, c["start"])))).otherwise(nothing)
        match = F.when(c["kind"].isNotNull(), F.array(token(c["start"], c["value"], c["kind"])))
        hidden = (c["end"] <= far) & (far > c["start"])  # a gap inside a match
        words_ = F.when(~hidden, F.array(token(c["start"], c["value"], None, c["first"], c["last"]))).otherwise(nothing)
        return F.concat(part, F.coalesce(match, words_))

    def passed(all_: Column) -> Column:
        ends = running(F.transform(all_, lambda c: c["end"]), F.greatest)
        far = F.concat(F.array(F.lit(0).cast("bigint")), ends)
        return F.flatten(F.zip_with(all_, let(far, lambda f: F.slice(f, 1, F.size(f) - 1)), each))

    return let(covers, passed)


def instances(found: Column) -> Column:
    """Instances without the punctuation at their ends, their patterns, and whether they are seeds.

    Matches of the fixed patterns are seeds, what remains of a run beside them are instances of their own. In
    contexts a match stands as its kind.
    """

    def trimmed(all_: Column, t: Column, k: Column) -> Column:
        alone = F.get(all_, k - 1)["last"].isNotNull() & F.get(all_, k + 1)["last"].isNotNull()
        ends = F.when(alone, F.array(F.lit(f"^{TRIM_START}+"), F.lit(f"{TRIM_END}+$"))).otherwise(
            F.array(F.lit(f"^{BESIDE}+"), F.lit(f"{BESIDE}+$"))
        )
        return F.when(t["last"].isNotNull(), part(t["start"], t["value"], None, t["first"], t["last"])).otherwise(
            F.when(t["kind"].isNotNull(), part(t["start"], t["value"], t["kind"])).otherwise(
                let(ends, lambda e: let(F.regexp_replace(t["value"], F.get(e, F.lit(0)), F.lit("")), lambda inner: part(
                    t["start"] + F.length(t["value"]) - F.length(inner), F.regexp_replace(inner, F.get(e, F.lit(1)), F.lit(""))
                )))
            )
        )

    def part(start: Column, value: Column, kind: Column | None = None, first: Column | None = None, last: Column | None = None) -> Column:
        if kind is not None:
            said = F.array(F.concat(F.lit("<"), kind, F.lit(">")))
        else:
            said = words(F.lower(value))
        tail = F.struct(F.get(said, F.lit(0)).alias("first"), latest(said).alias("last")) if last is None else None
        if last is None and kind is None:
            tail = let(said, lambda w: F.struct(F.get(w, F.lit(0)).alias("first"), latest(w).alias("last")))
        return F.struct(
            start.alias("start"),
            value.alias("value"),
            (F.lit(None).cast("string") if kind is None else kind).alias("kind"),
            F.lit(last is not None).alias("gap"),
            (F.struct(first.alias("first"), last.alias("last")) if tail is None else tail).alias("said"),
        )

    def instance(all_: Column, t: Column, k: Column) -> Column:
        before = F.get(all_, k - 1)
        mine = before["said"]["last"]
        last = F.when(before["gap"], mine).otherwise(F.concat(F.get(all_, k - 2)["said"]["last"], mine))
        behind = F.get(all_, k + 1)["said"]["first"]

        def around(last: Column) -> Column:
            w1, w2 = F.get(last, F.size(last) - 1), F.get(last, F.size(last) - 2)
            return F.array(F.concat(w2, F.lit(" "), w1, F.lit(" _")), F.concat(w1, F.lit(" _ "), behind))

        patterns = let(last, around)
        return F.struct(
            t["start"].alias("start"),
            (t["start"] + F.length(t["value"])).alias("end"),
            t["value"].alias("value"),
            t["kind"].isNotNull().alias("seed"),
            F.filter(patterns, lambda x: x.isNotNull()).alias("patterns"),
            (t["kind"].isNotNull() | ~t["gap"] & t["value"].rlike("[0-9@]")).alias("one"),
        )

    cores = let(found, lambda all_: F.transform(all_, lambda t, k: trimmed(all_, t, k)))
    cores = F.filter(cores, lambda t: t["gap"] | (t["value"] != ""))
    each = let(cores, lambda all_: F.transform(all_, lambda t, k: instance(all_, t, k)))
    named = ("start", "end", "value", "seed", "patterns")
    return F.transform(F.filter(each, lambda i: i["one"]), lambda i: F.struct(*[i[n].alias(n) for n in named]))


def scored_patterns(instances: DataFrame) -> DataFrame:
    """``pattern`` and ``confidence`` of the patterns with enough support, from rows of ``value``, ``seed`` and
    ``patterns``.

    Support is the number of instances believed to be personal data: seeds, and identifiers that a pattern of
    ``CONFIDENCE`` reaches. Beliefs start at nothing and only grow, so no patterns vouch for each other alone;
    each step away from the seeds costs a factor ``DECAY``. Rounds go on until no confidence grows by more than
    ``SETTLED``.
    """
    edges = instances.select(F.explode("patterns").alias("pattern"), "value", F.col("seed").cast("int").alias("seed"))
    edges = materialise(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    believed = edges.groupBy("value").agg(F.max("seed").cast("double").alias("belief"))
    belief = believed.withColumn("counts", F.col("belief").cast("int"))
    before = None
    while True:
        sums = edges.drop("seed").join(belief, "value").groupBy("pattern").agg(
            F.sum("belief").alias("sum"), F.count("*").alias("n"), F.sum("counts").alias("support")
        )
        # Rounded, so that the order of a sum does not decide. Without a floor, one find would vouch for a pattern.
        confidence = F.round(F.col("sum") / (F.col("n") + SMOOTHING), 9)
        scores = materialise(sums.filter(F.col("support") >= LEAST_SEEDS).select("pattern", confidence.alias("confidence")))
        grown = scores.withColumn("old", F.lit(0.0))
        if before is not None:
            old = before.withColumnRenamed("confidence", "old")
            grown = scores.join(old, "pattern", "left").fillna(0.0, ["old"])
        if grown.filter(F.col("confidence") > F.col("old") + SETTLED).isEmpty():
            return scores
        before = scores
        doubt = edges.join(scores, "pattern", "left")
        not_it = F.exp(F.sum(F.log(1 - F.coalesce("confidence", F.lit(0.0)))))
        noisy_or = F.round(DECAY * (1 - not_it), 9)
        agreed = doubt.groupBy("value").agg(F.max("seed").alias("s"), noisy_or.alias("b"), F.max("confidence").alias("best"))
        counts = is_identifier(F.col("value")) & (F.col("b") >= CONFIDENCE) & (F.col("best") >= CONFIDENCE)
        belief = materialise(
            agreed.select(
                "value",
                F.when(F.col("s") == 1, 1.0).otherwise(F.col("b")).alias("belief"),
                ((F.col("s") == 1) | F.coalesce(counts, F.lit(False))).cast("int").alias("counts"),
            )
        )


def find(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and its ``spans``, those of the fixed patterns by kind and then those found by context."""
    rows = matched(text_of(docs, id, text)).withColumn("row", F.monotonically_increasing_id())
    # Written once, without texts: row numbers then stay the same for all that follows.
    rows = materialise(rows)
    each = rows.select("row", F.explode("instances").alias("i")).select("row", "i.*")
    scores = scored_patterns(each.select("value", "seed", "patterns"))
    sure = scores.filter(F.col("confidence") >= CONFIDENCE).select("pattern")
    new = each.filter(~F.col("seed") & is_identifier(F.col("value")))
    reached = new.select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
    reached = Lookup(sure).join(reached, {"pattern": "pattern"}, {}, "left_semi")  # one pattern may reach most instances
    span = F.struct(F.lit(FOUND).alias("kind"), "start", "end", "value")
    added = reached.select("row", span.alias("span")).groupBy("row").agg(F.sort_array(F.collect_set("span")).alias("added"))
    whole = F.concat("base", F.coalesce("added", F.array().cast(SPAN)))
    return rows.select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", whole.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
