"""Line-first cleaning with DataFrame functions alone.

Every line is judged by itself: punctuation (marks for every other word), navigation (separators or a menu
word in a short line), boilerplate phrases, and one word said over and over. Failing lines are removed; a
document that loses more than ``MOST_LOST`` of its words so is rejected, as is one that fails the base
limits.

No rule depends on how a text is cut into lines or sentences: a phrase stands for ``PHRASE`` words of its
line, monotony is judged in windows of ``WINDOW`` words, and either fails a line that it fills by half. So a long line
with one such phrase stays, whatever its punctuation and script. The work grows with the length of a text. An empty table
gives an empty result.

NULL text has no words and is rejected like an empty one. Blank lines are kept. Repeated rows give repeated
results. All columns of the table are kept as they are; the result is one struct column, whose name replaces
a column of that name, so the caller picks a free one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempera.llm.common import col, words

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words in repeated windows
MOST_LOST = 30  # per cent of words in removed lines
WINDOW = 200  # words; a line of no more is one window
PHRASE = 20  # words for which a boilerplate phrase stands
SYMBOLS = "#*$%&|<>"
MARKS = "#*$%&|<>!{}=~^\\"
NAVIGATION = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|login|log in|sign in|sign up|register|search|next|previous|back|back to top|"
    r"skip to content|read more|share|contact us|about us|site map|sitemap|subscribe|startseite|anmelden|suche|weiterlesen|"
    r"kontakt|impressum|accueil|connexion|rechercher|lire la suite|nous contacter|inicio|buscar|contacto)\b"
)
BOILERPLATE = (
    r"(?i)(lorem ipsum|all rights reserved|terms of (use|service)|privacy policy|cookie policy|uses cookies|"
    r"enable javascript|powered by|click here|©|alle rechte vorbehalten|datenschutzerkl[äÄ]rung|verwendet cookies|"
    r"tous droits r[éÉ]serv[éÉ]s|politique de confidentialit[éÉ]|utilise des cookies|"
    r"todos los derechos reservados|pol[íÍ]tica de privacidad|utiliza cookies)"
)


def count_of(text: Column, characters: str) -> Column:
    """How many of ``characters`` the text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def judged_lines(text: Column) -> Column:
    """Lines with their words, the number of words and whether a rule removes the line."""
    split = F.transform(F.split(text, "\n", -1), lambda l: F.struct(l.alias("line"), words(l).alias("words")))
    counted = F.transform(
        split,
        lambda l: F.struct(
            l["line"].alias("line"),
            l["words"].alias("words"),
            F.size(l["words"]).alias("n"),
            count_of(l["line"], MARKS).alias("marks"),
            count_of(l["line"], "|»›·•").alias("separators"),
        ),
    )
    return F.transform(
        counted,
        lambda l: F.struct(l["line"].alias("line"), l["words"].alias("words"), l["n"].alias("n"), fails(l).alias("fails")),
    )


def monotone_words(said: Column) -> Column:
    """Words in the windows in which a few are said over and over."""
    starts = F.sequence(F.lit(1), F.size(said), F.lit(WINDOW))
    windows = F.transform(starts, lambda i: F.slice(said, i, F.lit(WINDOW)))
    sizes = F.transform(windows, lambda w: F.when((F.size(w) >= 10) & (4 * F.size(F.array_distinct(w)) <= F.size(w)), F.size(w)).otherwise(0))
    return F.aggregate(sizes, F.lit(0), lambda a, n: a + n)


def fails(l: Column) -> Column:
    n = l["n"]
    punctuation = (l["marks"] >= 3) & (2 * l["marks"] >= n)
    navigation = (l["separators"] >= 2) & (3 * l["separators"] >= n) | (n <= 4) & l["line"].rlike(NAVIGATION)
    monotone = F.when(n < 10, False).otherwise(2 * monotone_words(l["words"]) >= n)
    phrases = F.when(l["line"].rlike(BOILERPLATE), F.size(F.regexp_extract_all(l["line"], F.lit(BOILERPLATE), F.lit(0)))).otherwise(0)
    boilerplate = (phrases > 0) & (2 * PHRASE * phrases >= n)
    return (n > 0) & (punctuation | navigation | boilerplate | monotone)


def repeated_words(said: Column) -> Column:
    """Array of the first positions of the three-word windows that occur twice or more, ascending.

    Windows are compared by their 64-bit hash inside one text.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(said) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(said, i), F.get(said, i + 1), F.get(said, i + 2)).alias("hash"), i.alias("at")
        ),
    )
    return F.sort_array(F.when(F.size(said) >= 3, windows).otherwise(F.array().cast("array<struct<hash:bigint,at:int>>")))


def twins(ordered: Column) -> Column:
    """Positions whose window equals a neighbour in the sorted array, ascending."""
    same = F.filter(
        ordered,
        lambda w, i: F.coalesce(w["hash"] == F.get(ordered, i - 1)["hash"], F.lit(False))
        | F.coalesce(w["hash"] == F.get(ordered, i + 1)["hash"], F.lit(False)),
    )
    return F.sort_array(F.transform(same, lambda w: w["at"]))


def covered(positions: Column) -> Column:
    """Words that the three-word windows at ``positions`` cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        positions,
        start,
        lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end")),
        lambda a: a["n"].cast("bigint"),
    )


def assess(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``into``: the counts, the verdict ``kept`` and the ``clean_text``."""
    rest = [col(c) for c in docs.columns if c.lower() != into.lower()]

    def step(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(*[col(c) for c in df.columns if c not in columns], *[v.alias(k) for k, v in columns.items()])

    # The row travels in one struct, so that no name of the steps can clash with a column.
    out = docs.select(F.struct(*rest).alias("row"), F.coalesce(col(text), F.lit("")).alias("text"))
    out = step(out, lines=judged_lines(F.col("text")))
    out = step(out, said=F.flatten(F.transform("lines", lambda l: l["words"])))
    out = step(out, windows=repeated_words(F.col("said")))
    out = step(out, twins=twins(F.col("windows")))
    spoken = F.filter("lines", lambda l: l["n"] > 0)
    total = lambda kept: F.aggregate(kept, F.lit(0).cast("bigint"), lambda a, l: a + l["n"])
    out = step(
        out,
        n_words=F.size("said").cast("bigint"),
        word_chars=F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("bigint"),
        n_symbols=count_of(F.col("text"), SYMBOLS).cast("bigint"),
        n_dup_lines=(F.size(spoken) - F.size(F.array_distinct(F.transform(spoken, lambda l: l["line"])))).cast("bigint"),
        n_repeat_words=covered(F.col("twins")),
        n_lines_removed=F.size(F.filter("lines", lambda l: l["fails"])).cast("bigint"),
        n_words_removed=total(F.filter("lines", lambda l: l["fails"])),
        clean_text=F.array_join(F.transform(F.filter("lines", lambda l: ~l["fails"]), lambda l: l["line"]), "\n"),
    )
    out = step(
        out, base_failed=(F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    )
    kept = ~F.col("base_failed") & (100 * F.col("n_words_removed") <= MOST_LOST * F.col("n_words"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "n_words_removed"]
    found = F.struct(*counts, "base_failed", kept.alias("kept"), "clean_text")
    # A generator, because a filter on the verdict would else be pushed below every step and repeat them all.
    return out.select("row", F.explode(F.array(found)).alias("found")).select("row.*", F.col("found").alias(into))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS key
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, key) AS n FROM windows),
said_twice AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words
    FROM twice, (VALUES (0), (1), (2)) AS offsets(o) WHERE n > 1 GROUP BY rid),
split AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
counted AS (SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws,
    length(line) - length(translate(line, '#*$%&|<>!{{}}=~^\', '')) AS marks,
    length(line) - length(translate(line, '|»›·•', '')) AS separators FROM split),
lines AS (SELECT rid, line, len(ws) AS n, len(ws) > 0 AND (
    (marks >= 3 AND 2 * marks >= len(ws)) OR (separators >= 2 AND 3 * separators >= len(ws))
    OR (len(ws) <= 4 AND regexp_matches(line, '{NAVIGATION}'))
    OR (regexp_matches(line, '{BOILERPLATE}') AND {2 * PHRASE} * len(regexp_extract_all(line, '{BOILERPLATE}')) >= len(ws))
    OR (len(ws) >= 10 AND 2 * list_sum(list_transform(range(0, len(ws), {WINDOW}), lambda i: CASE
        WHEN len(ws[i + 1 : i + {WINDOW}]) >= 10 AND 4 * len(list_distinct(ws[i + 1 : i + {WINDOW}])) <= len(ws[i + 1 : i + {WINDOW}])
        THEN len(ws[i + 1 : i + {WINDOW}]) ELSE 0 END)) >= len(ws))) AS fails FROM counted),
by_line AS (SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
    count(*) FILTER (fails) AS n_lines_removed, coalesce(sum(n) FILTER (fails), 0)::BIGINT AS n_words_removed
    FROM lines GROUP BY rid),
counts AS (SELECT doc_id, len(ws) AS n_words, length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines_removed, n_words_removed,
    len(ws) < {LEAST_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MOST_REPEATED} * len(ws) AS base_failed
    FROM d JOIN w USING (rid) JOIN by_line USING (rid) LEFT JOIN said_twice USING (rid))
SELECT *, NOT base_failed AND 100 * n_words_removed <= {MOST_LOST} * n_words AS kept FROM counts
"""
