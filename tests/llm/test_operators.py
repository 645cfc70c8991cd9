"""Every operator against a plain version, on documents and on rows that are odd."""

import hashlib
import random
import time
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from brute import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import assert_same, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from tempera.llm import bpe, chat, components, langid, mixing, pii, quality, repair, secrets, simhash, winnow
from tempera.llm import queries as registered

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def pairs(df):
    return sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda p: (p[0] is not None, p))


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(params=["odd", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


# --- encoding -------------------------------------------------------------------------------


def test_ids_equal_the_library(docs):
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.round_trip(docs, PATH).collect())
    assert got == Counter((d, tuple(ids(t)), t) for d, t in pairs(docs))
    encoded = bpe.encode(docs, PATH)
    assert Counter(bpe.decode(encoded, PATH).select("text").collect()) == Counter(
        bpe.round_trip(docs, PATH).select(F.col("decoded").alias("text")).collect()
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \t\n\r\u00a0\u3000\u00e0\u00e9ab's!.,1<|endoftx>qxTL\u4f60\U0001f600")), max_size=60))
def test_cuts_are_certain(text):
    e = bpe.encoder(PATH)
    assert np.frombuffer(e.encode(text.encode()), "<u4").tolist() == ids(text)
    assert np.frombuffer(e.encode_whole(text.encode()), "<u4").tolist() == ids(text)


def test_special_tokens_may_be_plain():
    plain = bpe.encoder(PATH, False)
    got = np.frombuffer(plain.encode(b"a<|endoftext|> b"), "<u4")
    assert 50256 not in got and plain.decode(got) == b"a<|endoftext|> b"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=200), min_size=1, max_size=5))
def test_repair_round_trip(documents):
    packed = np.concatenate([np.array(d, np.uint32) for d in documents])
    ends = np.zeros(len(packed), bool)
    ends[np.cumsum([len(d) for d in documents]) - 1] = True
    symbols, rules, last = repair.compress(packed, ends, 10)
    lengths = repair.rule_lengths(rules, 10)
    assert last.sum() == len(documents)
    assert repair.expand(symbols, rules, 10).tolist() == packed.tolist()
    assert repair.expand_all(symbols, rules, lengths, 10).tolist() == packed.tolist()
    block = {"symbols": symbols.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(), "first": 10}
    block["lengths"] = lengths.astype("<u4").tobytes()
    for start in range(0, len(packed), 7):
        assert repair.ids_between(block, start, start + 11).tolist() == packed[start : start + 11].tolist()


def test_repair_compresses():
    block = np.tile(np.arange(100, dtype=np.uint32), 1000)
    symbols, rules, _ = repair.compress(block, np.zeros(len(block), bool), 1000)
    assert len(symbols) < len(block) / 4 and len(rules) > 50


def test_runs_and_copies_shrink_to_little():
    run = np.full(1 << 20, 7, np.uint32)
    passage = np.tile(np.random.default_rng(1).integers(0, 50_000, 5000).astype(np.uint32), 200)
    ends = np.zeros(len(passage), bool)
    ends[4999::5000] = True
    for ids_, last, most in ((run, np.zeros(len(run), bool), 100), (passage, ends, 0.03 * len(passage))):
        symbols, rules, marks = repair.compress(ids_, last, 60_000)
        assert len(symbols) + 2 * len(rules) < most
        assert np.array_equal(repair.expand(symbols.copy(), rules, 60_000), ids_) and marks.sum() == last.sum()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=400), st.lists(st.booleans(), min_size=400, max_size=400))
def test_no_pair_stays_frequent(ids_, flags):
    ids_, last = np.array(ids_, np.uint32), np.array(flags[: len(ids_)], bool) & (np.arange(len(ids_)) % 9 == 8)
    symbols, rules, marks = repair.compress(ids_, last, 10)
    assert np.array_equal(repair.expand(symbols.copy(), rules, 10), ids_)
    left = Counter()
    at = -2
    for i in range(len(symbols) - 1):  # places of a pair that do not overlap
        if not marks[i]:
            left[int(symbols[i]), int(symbols[i + 1])] += 1
    runs = {p: n for p, n in left.items() if p[0] != p[1]}
    assert max(runs.values(), default=0) < 2 * repair.LEAST and at == -2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(1, 6), st.sampled_from([6, 1 << 20, 1 << 30]), st.sampled_from([3, 18]))
def test_frequent_pairs(ids_, least, made, bits):  # the last ``made`` is too wide for a pair and its place in one number
    ids_ = np.array([*ids_, 0, 0], np.uint32)
    with pytest.MonkeyPatch.context() as patch:  # with slots and without
        patch.setattr(repair, "SLOT_BITS", bits)
        check_frequent_pairs(ids_, least, made)


def check_frequent_pairs(ids_, least, made):
    closed = np.arange(len(ids_) - 1) % 7 == 6
    pairs_, at, rank = repair.frequent(ids_[:-1], ids_[1:], closed, least, made)
    each = [(int(a) << 32) | int(b) for a, b in zip(ids_, ids_[1:], strict=False)]
    counts = Counter(p for p, c in zip(each, closed, strict=True) if not c)
    often = {p: n for p, n in counts.items() if n >= least}
    assert sorted(pairs_.tolist()) == sorted(often)
    assert [often[p] for p in pairs_.tolist()] == sorted(often.values(), reverse=True)
    assert at.tolist() == [i for i, p in enumerate(each) if p in often and not closed[i]]
    assert pairs_[rank].tolist() == [each[i] for i in at]


def test_compressing_takes_no_more_than_some_sorts():
    """CPU time of a block against plain sorts of its pairs: about 50 sorts before, 25 since."""
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 50_000, n).astype(np.uint32) for n in rng.integers(1, 6, 30_000)]
    block = np.concatenate([words[w % len(words)] for w in rng.zipf(1.2, 500_000)])[: repair.BLOCK]
    ends = np.arange(len(block)) % 1000 == 999

    def seconds(work):
        start = time.process_time()
        work()
        return time.process_time() - start

    key = (block[:-1].astype(np.uint64) << np.uint64(32)) | block[1:]
    one = min(seconds(lambda: np.sort(key)) for _ in range(5))
    assert min(seconds(lambda: repair.compress(block, ends, 60_000)) for _ in range(3)) < 37 * one


def test_whole_texts_are_split_as_the_library_does():
    parts = ["a", "be", "the", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\u00a0", "\u2028", "\u3000", "'", "'s", "'S", "'re", "'ll", "\u2019s"]
    parts += ["1", "\u0663", "\u00bd", "!", "...", "e\u0301", "\u4f60", "\U0001f600", "<|endoftext|>", "<|end", "\x00", "\ufeff", "_"]
    rng, e = random.Random(1), bpe.encoder(PATH)
    for text in ("".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)):
        assert np.frombuffer(e.encode_whole(text.encode()), "<u4").tolist() == ids(text)
    # A line of white space that ends a text was too long for the pattern before.
    assert len(e.encode_whole(b"\n" * 1_000_000)) == 4 * len(ids("\n" * 1_000_000))


def test_archive(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 20_000)
    repair.write_archive(docs, PATH, f"{tmp_path}/archive")
    rows = repair.read_archive(spark, f"{tmp_path}/archive").collect()
    want, start = Counter(), 0
    texts = sorted(rows, key=lambda r: r.start)
    for r in texts:
        assert r.start == start
        start += r.n_tokens
        want[(r.doc_id, r.ids)] += 1
    assert want == Counter((d, np.array([*ids(t), 2], "<u4").tobytes()) for d, t in pairs(docs))
    known = [r.doc_id for r in texts]
    assert known == sorted(known, key=lambda d: (d is not None, d))


def test_op1_and_op7(spark):
    texts, start = pairs(spark.read.parquet(f"{SMALL}/documents.parquet")), 0
    first = {r.doc_id: r for r in registered.op1_repair(spark, SMALL).collect()}
    seventh = {r.doc_id: r for r in registered.op7_bpe(spark, SMALL).collect()}
    for d, t in texts:
        e = np.array([*ids(t), 2], "<u4")
        assert tuple(first[d]) == (d, start, len(e), zlib.crc32(e.tobytes()))
        start += len(e)
        assert tuple(seventh[d]) == (d, len(e) - 1, brute.sha(",".join(map(str, ids(t)))), brute.sha(LIBRARY.decode(ids(t), skip_special_tokens=False)))


# --- quality --------------------------------------------------------------------------------


def test_quality_counts_of_odd_rows(odd, tmp_path):
    odd.select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rows = quality.assess(odd, "verdict").select("doc_id", "verdict.*").drop("clean_text")
    assert assert_same(rows, con, quality.SQL) == odd.count()


def test_lines_are_judged_by_themselves(spark):
    lines = [" ".join(f"Word{i}x{j}" for j in range(14)) + "." for i in range(12)]
    junk = ["Home | About | Contact | Login", "BUY!! NOW!! CHEAP!!", "word ### word $$$ word ***", "© 2020 All rights reserved", "Sign in", "go " * 12]
    some = "\n".join([*lines[:6], *junk, *lines[6:]])
    mostly = "\n".join([*lines[:5], *(j for i in range(9) for j in (f"a{i} | b{i} | c{i} | d{i} | e{i} | f{i} |",))])
    rows = spark.createDataFrame([(1, some), (2, "\n".join(lines)), (3, mostly)], "doc_id long, text string")
    got = {r.doc_id: r.quality for r in quality.assess(rows, "quality").collect()}
    assert got[1].kept and got[1].clean_text == "\n".join(lines) and got[1].n_lines_removed == len(junk)
    assert got[2].kept and got[2].n_lines_removed == 0 and got[2].clean_text == "\n".join(lines)
    assert not got[3].kept and not got[3].base_failed


def test_long_lines_are_judged_by_their_parts(spark):
    prose = " ".join(f"w{(i * i) % 4801} v{(i * 7919) % 3001}" + ". " * (i % 9 == 0) for i in range(20_000))
    short = " ".join(f"Word{i}x." for i in range(400))
    policy = f"{short} Our privacy policy is powered by reason. {short.replace('Word', 'Term')}"
    junk = "All rights reserved by the owner of this page and of all that it shows or links to. " * 20
    again = "go on and on " * 200
    no_stop = " ".join(f"w{(i * i) % 4801} v{(i * 7919) % 3001}" for i in range(2000)) + " privacy policy again"
    far_stop = "。".join(f"字{i} 词{i * 7 % 331}" for i in range(900)) + " © 。"
    texts = [prose, policy, f"{short}\n{junk}", f"{short}\n{again}", no_stop, far_stop]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cleaned = {r.doc_id: r.q for r in quality.assess(rows, "q").collect()}
    assert cleaned[0].kept and cleaned[0].n_lines_removed == 0 and cleaned[0].clean_text == prose
    assert cleaned[1].kept and cleaned[1].clean_text == policy
    assert cleaned[2].n_lines_removed == cleaned[3].n_lines_removed == 1 and cleaned[2].clean_text == short
    staged = {r.doc_id for r in corpus_pipeline.clean_documents(spark, rows, "").collect()}
    assert {0, 1, 4, 5} <= staged
    assert cleaned[4].n_words == 4003 and cleaned[4].n_lines_removed == cleaned[5].n_lines_removed == 0


def test_filter_is_not_pushed_into_the_steps(documents):
    kept = quality.assess(documents, "q").filter("q.kept")
    assert kept.count() > 0 and kept.columns == [*documents.columns, "q"]


# --- near duplicates ------------------------------------------------------------------------


def test_near_duplicates(docs):
    rows = pairs(docs)
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.classes(prints)
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    want = Counter((d, f, least[r]) for (d, _), f, r in zip(rows, prints, root, strict=True))
    for tile in (simhash.TILE, 16):
        got = simhash.near_duplicates(docs, tile=tile).collect()
        assert Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got) == want


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60))
def test_tiles_lose_no_link(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, 5, np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (n, 3)).astype(np.uint64)) * rng.integers(0, 2, (n, 3)).astype(np.uint64)
    values = np.unique(centres[rng.integers(0, 5, n)] ^ np.bitwise_or.reduce(flips, axis=1))
    cut = len(values) // 2
    links = [simhash.near_links(v, None, 4) for v in (values[:cut], values[cut:]) if len(v)]
    if cut:
        links.append(simhash.near_links(values[:cut], values[cut:], 4))
    position = {int(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))
    for a, b in links:
        assert (np.bitwise_count(a ^ b) <= 4).all() and len(a) < max(2, len(values))
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            old, new = sorted((root[position[x]], root[position[y]]), reverse=True)
            root = [new if r == old else r for r in root]
    assert root == brute.classes(values.tolist())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5), (None, 3), (7, 6)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(51)} | {1000 + i: 1000 for i in range(60)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_of_each(odd):
    rows = simhash.one_of_each(odd)
    assert rows.columns == odd.columns
    got = sorted((r.doc_id or 0, len(r.text or "")) for r in rows.collect())
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect() if r.doc_id}
    assert found[2] == 1 and found[3] == 1 and found[8] == 7
    assert len(got) == len({g for g in got}) and (8, len(odd.filter("doc_id = 8").first().text)) not in got
    assert [d for d, _ in got].count(9) == 2  # the long word, and the other text with this id


# --- personal data and secrets --------------------------------------------------------------


def test_personal_data(docs):
    got = Counter()
    for r in pii.find(docs).collect():
        got[(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in pii.KINDS))] += 1
    assert got == Counter((d, tuple(brute.personal(t))) for d, t in pairs(docs))


def test_patterns_find_unseen_identifiers(spark):
    seeds = [f"please call me on +1 (274) 555-{1000 + i} today, thing {i}." for i in range(8)]
    texts = [*seeds, "please call me on 0274/5559629 today.", "the bill was 12345678 in all.", "version 3 of it"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [s for s in r.spans if s.kind == pii.FOUND] for r in pii.find(rows).collect()}
    assert [texts[8][s.start : s.end] for s in found[8]] == ["0274/5559629"]
    assert not any(found[i] for i in range(11) if i != 8)


def test_found_identifiers_support_further_patterns(spark):
    """Seeds, a pattern, new identifiers, a pattern none of whose instances is a seed, further identifiers."""
    texts = [f"please call me on +1 (274) 555-{1000 + i} today, thing {i}." for i in range(8)]
    texts += [f"please call me on 0274/{5559000 + i} today." for i in range(4)]
    texts += [f"the member number 0274/{5559000 + i} has expired again." for i in range(4)]
    texts += ["the member number KX-88271 has expired again."]
    texts += [f"a lot of part no {70000000 + i} was sold." for i in range(9)]  # a context that no find supports
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == pii.FOUND] for r in pii.find(rows).collect()}
    assert found[16] == ["KX-88271"]
    assert all(found[i] == [f"0274/{5559000 + i % 4}"] for i in range(8, 16))
    assert not any(found[i] for i in [*range(8), *range(17, len(texts))])


def test_identifiers_beside_seeds_are_found(spark):
    texts = [f"please call me on +1 (274) 555-{1000 + i} today, thing {i}." for i in range(8)]
    texts += ["please call me on 0274/5559629 a@b.org", "please call me on 0274/5559630; 4111 1111 1111 1111; 10.0.0.1 today."]
    texts += [f"seen 10.0.0.{i} u{i}@b.org +1 (274) 555-{2000 + i} end" for i in range(8)]
    texts += ["seen 10.0.0.9 KX-88271 +1 (274) 555-2009 end", "mailto:a@b.org, only"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == pii.FOUND] for r in pii.find(rows).collect()}
    want = {8: ["0274/5559629"], 9: ["0274/5559630"], 18: ["KX-88271"]}
    assert {k: v for k, v in found.items() if v} == want
    instances = {r.doc_id: [(i.value, i.seed) for i in r.instances] for r in pii.matched(rows).collect()}
    assert instances[9] == [("0274/5559630", False), ("4111 1111 1111 1111", True), ("10.0.0.1", True)]
    assert instances[19] == [("a@b.org", True)]


def test_a_text_of_many_matches(spark):
    """Five thousand addresses and cards, without a line break, and the same without any space."""
    words = [
        (f"10.{i % 200}.{i // 200}.{i % 7}" if i % 3 else "4111 1111 1111 1111") if i % 5 else f"call \U0001f600 u{i}@x.org KX-{88000 + i} and"
        for i in range(5000)
    ]
    texts = {1: " ".join(words), 2: ",".join(words).replace(" ", ";"), 3: "7" * 30_000 + " a@b.co" * 300}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.matched(rows).collect():
        text = texts[r.doc_id]
        assert [(b.kind, b.start, b.end) for b in r.base] == brute.personal(text)
        assert all(text[i.start : i.end] == i.value for i in r.instances)
        seeds = [(i.start, i.end) for i in r.instances if i.seed]
        assert sorted(seeds) == sorted((b.start, b.end) for b in r.base)
        if r.doc_id == 1:
            beside = [i for i in r.instances if i.value.startswith("KX")]
            assert [i.value for i in beside] == [f"KX-{88000 + i}" for i in range(0, 5000, 5)]
            assert all(i.patterns[0].endswith("<email> _") for i in beside[1:])


def test_running_sums(spark):
    numbers = list(range(1, 400))
    row = spark.createDataFrame([(numbers,)], "x array<int>").select(
        pii.running(F.col("x")).alias("s"), pii.running(F.reverse("x"), F.greatest).alias("m")
    ).first()
    assert row.m == [399] * 399
    assert row.s == np.cumsum(numbers).tolist()


def test_secrets(docs):
    got = Counter()
    for r in secrets.find(docs, carry=["doc_id"]).collect():
        got[(r.row.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in secrets.BASE))] += 1
    assert got == Counter((d, tuple(brute.secret(t))) for d, t in pairs(docs))


def test_novel_strings_are_reported(spark):
    random, code = "q7Zr2Lx9Kd4Vb8Nw3Tm6Yc", "request_response_2024_status_2010"
    text = f"The signing key is {random} and\nthe config key is {code}; see page {random[::-1]} for more prose"
    rows = spark.createDataFrame([(1, text), (2, "no such words here " + random)], "doc_id long, text string")
    got = {r.row.doc_id: r for r in secrets.find(rows, mask=True).collect()}
    assert [text[s.start : s.end] for s in got[1].spans if s.kind == "novel"][0] == random
    assert code not in [text[s.start : s.end] for s in got[1].spans]
    assert got[1].clean_text.startswith("The signing key is [SECRET] and") and got[2].spans == []


@pytest.mark.parametrize(
    "key",
    [
        "qZxLrKdVbNwTmYcPfGhJ",  # letters only
        "QZXLRKDVBNWTMYCPFGHJ",
        "83920174650918273645",  # digits only
        "qZxLrKd4827VbNwTmYcP",  # one run of digits
    ],
)
@pytest.mark.parametrize("rest", [" and more prose follows.", "\nPlease keep it safe. " + "It was made for the machine in the cellar. " * 20])
def test_secrets_need_no_mixture_of_digits(key, rest):
    text = f"The signing key is {key}{rest}"
    found = [(k, text[s:e]) for k, s, e, _, _ in secrets.scan(text.encode())]
    assert found == [("novel", key)]
    for name in ("request_response_status", "get_default_session_token", "some.package.name.here"):
        assert secrets.scan(f"The signing key is {name}{rest}".encode()) == []


@pytest.mark.parametrize("join", ["/", ".", "=", "+", "_", "-", ""])
def test_secrets_beside_base_spans_are_found(join):
    """A random key that a hex run adjoins is measured without it, before and behind."""
    key, run = "qZ8vT1xLr0YbW5nKfU3mJ7sHdP9cG2eXtA6iOyRk", "4283fefc63f0cd0e873a0000"
    for text in (f"the private credential is {run}{join}{key} so", f"the private credential is {key}{join}{run} so"):
        found = [(k, text[s:e]) for k, s, e, _, _ in secrets.scan(text.encode())]
        assert sorted(found) == [("hex", run), ("novel", key)]
        assert secrets.masked(text.encode(), secrets.scan(text.encode())).count(secrets.MASK) == 2
    assert [k for k, *_ in secrets.scan(f"nothing about {run}/{key}".encode())] == ["hex"]


def test_overlapping_secrets_are_masked_once():
    raw = b'x token = "0123456789abcdef0123456789abcdef" y'
    assert secrets.masked(raw, secrets.scan(raw)) == 'x token = "[SECRET]" y'


# --- language -------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = registered.op5_langid(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd, spark):
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows} == {"en", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    unlabelled = langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=6), st.sampled_from([1, 7, 1 << 16]))
def test_kernel_equals_sets_of_grams(texts, dense):
    """Whatever share of the n-grams the matrix holds and the lists of the others."""
    before, langid.DENSE = langid.DENSE, dense
    try:
        got = langid.landmarks_of([langid.grams(t) for t in texts]).kernel([langid.grams(t) for t in texts])
    finally:
        langid.DENSE = before
    want = [[brute.kernel(a, b) for b in texts] for a in texts]
    assert np.allclose(got, want, atol=1e-5)


def test_values_equal_plain_ridge():
    rnd = np.random.default_rng(3)
    letters = {"a": "abcde", "b": "cdefg", "c": "\u0e01\u0e02\u0e31\u0e34"}
    texts = ["".join(rnd.choice(list(letters[x]), 14)) for x in "aabbccabc"]
    labels = list("aabbccabc")
    model = langid.learn(texts, labels)
    asked = [*texts[:3], "abg", "\u0e01x"]
    want = brute.ridge(texts, labels, range(len(texts)), langid.RIDGE, asked)
    assert np.allclose(model.values([langid.grams(t) for t in asked]), want, atol=2e-3)


SCRIPTS = {  # first letter and how many follow
    "latin": (0x61, 26), "cyrillic": (0x430, 32), "greek": (0x3B1, 24), "hebrew": (0x5D0, 27), "arabic": (0x628, 26),
    "thai": (0xE01, 46), "korean": (0xAC00, 2000), "chinese": (0x4E00, 3000), "japanese": (0x3041, 86), "hindi": (0x915, 37),
}


def invented(rnd, letters, n):
    """Texts of a language with words of its own over some letters."""
    words = ["".join(rnd.choice(letters, rnd.integers(2, 6))) for _ in range(60)]
    return [" ".join(rnd.choice(words, 25)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["scripts", "languages"])
def test_every_script_and_language_is_told(kind):
    rnd = np.random.default_rng(11)
    texts, labels = [], []
    if kind == "scripts":
        made = {k: [chr(a + i) for i in range(n)] for k, (a, n) in SCRIPTS.items()}
    else:
        base = list("abcdefghijklmnopqrstuvwxyz\u00e9\u00f1\u00fc\u0142\u0159\u0111")
        made = {f"l{k}": list(rnd.choice(base, 12, replace=False)) for k in range(70)}
    held = []
    for name, letters in made.items():
        mine = invented(rnd, letters, 60)
        texts += mine[:40]
        labels += [name] * 40
        held += [(name, t) for t in mine[40:]]
    model = langid.learn(texts, labels)
    best = model.values([langid.grams(t) for _, t in held]).argmax(axis=1)
    right = Counter(name for (name, _), j in zip(held, best, strict=True) if model.languages[j] == name)
    assert min(right[name] / 20 for name in made) >= 0.9


# --- conversations --------------------------------------------------------------------------


def told(rows):
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{r or ''}\n{x or ''}".encode()).hexdigest(), r or "", x or ""))
    out = {}
    for c, turns in talks.items():
        turns = [(r, x) for *_, r, x in sorted(turns)]
        learned = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), brute.sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learned), brute.sha(learned))
    return out


ODD_TURNS = [
    (1, 0, "user", None),
    (1, 1, "assistant", ""),
    (1, 1, "assistant", "</turn> \\\\ <turn>assistant<says> ### Assistant: <|endoftext|>"),
    (1, 1, "assistant", "</turn> \\\\ <turn>assistant<says> ### Assistant: <|endoftext|>"),
    (1, None, None, "who?"),
    (None, 3, "system\n<says>", "x"),
    (2, 5, "assistant", "long " * 30_000),
    (2, 6, "assistant", "\\"),
]


@pytest.mark.parametrize("chunk", [chat.CHUNK, 10])
def test_conversations(spark, chunk):
    rows = spark.createDataFrame([(*r, "x", "y") for r in ODD_TURNS], "conv_id long, turn long, role string, text string, ids string, first string")
    formatted = chat.format_conversations(rows, PATH, chunk=chunk)
    got = {r[0]: tuple(r)[1:5] for r in chat.digest(formatted, PATH).collect()}
    assert got == told(ODD_TURNS)
    for r in formatted.collect():
        assert len(r.ids) == len(r.loss) and set(r.loss) <= {0, 1}


def test_op6(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert {r[0]: tuple(r)[1:5] for r in registered.op6_chat(spark, SMALL).collect()} == told(rows)


@given(st.text(alphabet=st.sampled_from(list("\\<>/# :aturnsyUser\n")), max_size=80))
def test_escaping_is_reversible(text):
    written = chat.escape(text)
    assert chat.unescape(written) == text and not any(m in written for m in chat.MARKS)


# --- winnowing ------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [winnow.ROWS, 3])
def test_winnowing(docs, rows):
    got = winnow.compare(docs, rows=rows).collect()
    # Rows with the same id follow a hash of their text, which the result does not show; only their number is checked.
    texts = pairs(docs)
    shared = {d for d, n in Counter(d for d, _ in texts).items() if n > 1}
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in texts)
    marks = [brute.winnowed(t) for _, t in texts]
    for r in got:
        at = [i for i, (d, _) in enumerate(texts) if d == r.doc_id]
        after = (at[-1] + 1) % len(texts)
        if r.doc_id in shared or texts[after][0] in shared:
            continue
        text, other = texts[at[0]][1], texts[after][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert (r.n_chars, r.edited_text) == (len(text), edited)
        assert [tuple(m) for m in r.marks] == marks[at[0]]
        assert [tuple(m) for m in r.edited_marks] == brute.winnowed(edited)
        assert r.near_edited == brute.alike(marks[at[0]], brute.winnowed(edited))
        assert r.near_next == brute.alike(marks[at[0]], marks[after])


def test_shared_passages_share_a_mark():
    words = [f"w{i}" for i in range(200)]
    passage = words[50 : 50 + winnow.GRAM + winnow.WINDOW - 1]
    a = brute.winnowed(" ".join(words))
    b = brute.winnowed(" ".join(["other"] + passage + ["end"] * 40))
    assert {h for h, _ in a} & {h for h, _ in b}


def test_buckets(spark):
    edges = [3, 10, 10_000_000_000]
    rows = spark.createDataFrame([(i,) for i in (None, 0, 2, 3, 9, 10, 11, 10**10, 10**12)], "i long")
    got = [r.b for r in rows.select(winnow.bucket_of(F.col("i"), edges).alias("b")).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3]


# --- mixing ---------------------------------------------------------------------------------


def test_targets_are_held_to_two_passes(spark):
    rows = spark.createDataFrame([("=a", 10), ("=b", 1000), ("=c", 1000), ("=d", 100), ("", 7)], "source_key string, size long")
    got = {r.source_key: r for r in mixing.targets(rows).collect()}
    total = sum(r.target for r in got.values())
    assert abs(total - 1.5 * 2117) < 1e-6 and all(r.target <= 2 * r.source_size for r in got.values())
    assert got["=a"].target == 20 and got["=d"].target == 200 and got[""].kind == 1
    assert got["=b"].target == 2 * got["=c"].target == 1961
    nothing = spark.createDataFrame([("=a", 0), ("=b", 0)], "source_key string, size long")
    assert {r.target for r in mixing.targets(nothing).collect()} == {0.0}


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 12))
def test_targets_share_by_weight(seed, n):
    """The level found by sorting equals repeated resharing."""
    rng = np.random.default_rng(seed)
    size = rng.integers(1, 10 ** rng.integers(1, 5, n))
    weight = np.array([(5, 2, 1)[i % 3] for i in range(n)], float)
    held, target = np.zeros(n, bool), np.zeros(n)
    while True:
        left = 1.5 * size.sum() - 2 * size[held].sum()
        target = np.where(held, 2 * size, left * weight / weight[~held].sum() if (~held).any() else 0)
        over = target > 2 * size
        if not over.any():
            break
        held |= over
    order = np.argsort(size / weight, kind="stable")
    left, rest, expected = 150 * int(size.sum()), weight.sum(), np.zeros(n)
    for k, i in enumerate(order):
        if left * weight[i] < 200 * size[i] * rest:
            expected[order[k:]] = left * weight[order[k:]] / (100 * rest)
            break
        expected[i] = 2 * size[i]
        left, rest = left - 200 * int(size[i]), rest - weight[i]
    assert np.allclose(target, expected)


def test_positions_invert_the_schedule(spark):
    knots = ((0.0, 2.0), (0.25, 1.0), (0.5, 1.0), (1.0, 0.0))
    times = np.linspace(0, 1, 101)
    weight = np.interp(times, *zip(*knots, strict=True))
    area = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2 * 0.01)))
    rows = spark.createDataFrame([(float(a / area[-1]), 0) for a in area], "d double, kind int")
    got = [r.t for r in rows.select(mixing.position(F.col("d"), F.col("kind"), (knots,)).alias("t")).collect()]
    assert np.allclose(got, times, atol=1e-6)


@pytest.mark.parametrize("bucket", [mixing.BUCKET, 4])
def test_mixing(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    rows = registered.op10_mixing(spark, SMALL)
    assert_same(rows, connect(SMALL), mixing.SQL)
    by_source = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source").join(rows, "doc_id")
    for r in by_source.groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t"), F.max("size").alias("m")).collect():
        assert abs(r.n - r.t) <= r.m
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows.collect())


def test_curriculum(odd):
    rows = mixing.curriculum(odd)
    assert rows.columns == odd.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, mixing.curriculum(odd.repartition(3)).collect()))


# --- whole ----------------------------------------------------------------------------------


def test_empty_tables(spark, odd, tmp_path):
    none = odd.limit(0)
    repair.write_archive(none, PATH, f"{tmp_path}/archive")
    tables = [
        repair.read_archive(spark, f"{tmp_path}/archive"),
        quality.assess(none, "verdict"),
        simhash.near_duplicates(none),
        simhash.one_of_each(none),
        pii.find(none),
        langid.identify(none),
        bpe.round_trip(none, PATH),
        secrets.find(none, mask=True),
        winnow.compare(none),
        mixing.curriculum(none),
        chat.digest(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), PATH), PATH),
    ]
    assert [t.count() for t in tables] == [0] * len(tables)


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_sql(spark, name):
    assert assert_same(driver.queries()[name](spark, "/root/testdata/sf0.01"), connect("/root/testdata/sf0.01"), registered.SQL[name]) > 0
