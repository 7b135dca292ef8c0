"""Operators for training data against brute force, round trips, oracles and edge cases."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import compare
from vellumine.llm import encoding, languages, leakage, nearduplicates, quality, queries, splitting, vectors
from vellumine.llm.chars import Block, blocks, range_hashes, window_hashes

SF = "/root/testdata/sf0.001"
Q, SQL = queries.queries(), queries.oracle_sql()
WORD = regex.compile(r"[\p{L}\p{N}]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    compare(spark, SF, Q[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(Q) - set(SQL)))
def test_runs(spark, name):
    assert Q[name](spark, SF).count() > 0


# Shared scanning -------------------------------------------------------------

TEXTS = st.lists(st.text(alphabet="ab é1_-. \n\t　 漢字かなЖ²Ⅷ́😀", max_size=40), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_of_blocks(texts):
    b = Block(texts)
    s, e = b.words()
    got = [(int(o), "".join(map(chr, b.codes[x:y]))) for o, x, y in zip(b.owner(s), s, e)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t)]
    if len(b.codes) > 4:
        i = np.arange(len(b.codes) - 3)
        assert (window_hashes(b.codes, 3)[: len(i)] == range_hashes(b.codes, i, i + 3)[: len(i)]).all()


def test_hashes_depend_on_content_alone():
    b = Block(["abc", "xxabcx", "abd"])
    h = range_hashes(b.codes, np.array([0, 5, 9]), np.array([3, 8, 12]))
    assert h[0] == h[1] != h[2]
    assert list(blocks(["a" * 5, "b" * 5, "c"], 6)) == [(0, 1), (1, 3)] and list(blocks([])) == []


# 1: splitting ------------------------------------------------------------------

PARTS = st.lists(st.sampled_from(["word ", "Sentence one. ", "\n\n", "# Head\n", "| a | b |\n", "x" * 300, "　", "漢字。", " ", " y"]), max_size=150)


@settings(max_examples=80, deadline=None)
@given(PARTS, st.integers(5, 60), st.integers(60, 400), st.integers(0, 4))
def test_pieces(parts, max_tokens, max_chars, overlap):
    text = "".join(parts)
    got = splitting.split_text(text, max_tokens, max_chars, overlap)
    spans = [m.span() for m in splitting.TOKEN.finditer(text)]
    small = len(spans) <= max_tokens and len(text) <= max_chars
    if small:
        assert len(got) <= 1
        return
    covered = bytearray(len(text))
    for a, b, n, _ in got:
        assert 0 <= a < b <= len(text) and b - a <= max_chars and n <= max_tokens
        assert n == len(splitting.TOKEN.findall(text[a:b]))
        covered[a:b] = b"\1" * (b - a)
    assert all(all(covered[a:b]) for a, b in spans)
    for (a, b, _, _), (c, d, _, _) in zip(got, got[1:]):
        assert a < c and b < d and len(splitting.TOKEN.findall(text[c:b])) <= max(overlap, 1)


def test_split_edge_cases(spark):
    rows = [("a", "w " * 900, 1), ("a", "w " * 900, 1), ("b", None, 2), ("c", "", 3), ("d", " " * 6001, 4), ("e", "z" * 13000, 5), ("f", "w " * 800, 6), (None, "v " * 801, 7), ("g", "fine.", 8)]
    df = spark.createDataFrame(rows, "chunk_id string, text_md string, piece int")
    got = splitting.split_oversized(df).collect()
    keys = [r["key"] for r in got]
    assert set(keys) == {"a", "d", "e", None} and keys.count("a") == 2 and keys.count("e") == 3
    assert splitting.split_oversized(df.limit(0)).count() == 0
    assert {r[0] for r in splitting.found(df).collect()} == {"a", "d", "e", None}


def test_cuts_prefer_boundaries():
    text = "# A\n\n" + "word " * 500 + "\n\n# B\n\n" + "word " * 500
    got = splitting.split_text(text)
    assert got[0][3] == "heading" and text[got[1][0] : got[1][1]].lstrip("word ").startswith("\n\n# B") or text[got[1][0] :].startswith("# B")
    assert splitting.split_text("s one two. " * 400)[0][3] == "sentence"
    assert splitting.split_text("w " * 2000)[0][3] == "token-window"


# 2: quality ----------------------------------------------------------------------

PROSE = "The team asked whether the service could archive the page before the audit. Nobody could explain why the report was late, and so the plan has been moved to the next week."
KINDS = {
    PROSE: "prose",
    "\n".join(f"- Close the ticket {n}" for n in range(8)): "list",
    "Intro to the items below, as agreed by the team.\n\n" + "\n".join(f"{n}. The page tree (Room {n})" for n in range(1, 12)): "list",
    "\n".join(f"Count the pages in room {n}\nThe page tree {n}" for n in range(6)): "list",
    "\n".join(f"| {n} | the page | x{n} |" for n in range(8)): "table",
    "\n".join(f"{n};{n * 7};the page;yes" for n in range(8)): "table",
    "\n".join(f"alpha{n}\tbeta\t{n}" for n in range(8)): "table",
    "<table>" + "".join(f"<tr><td>{n}</td><td>yes</td></tr>\n" for n in range(8)) + "</table>": "table",
    "qwrtz plkmn qwrtz plkmn " * 20: "junk",
    "The rule checker starts late and stops early. " * 12: "junk",
    "Home > Next > Prev | Login » Search · Menu / Share > Copy » Edit · Home / Next > Print · Move » Hide": "junk",
    "".join(random.Random(5).choice("ABCDEFabcdefghijk0123456789+/") for _ in range(300)): "junk",
    "zexdr uxwrlpafwt;y bcw fpk scin zsqzqjbthkuus koeo,ay;wxldm wos ukx,yz ;z,ebtdaopk hifyxr;bmt ppwuwefwvura uafbndwtnhnidp r;dnrpmv;, omlz adodkbwx": "junk",
    "];]#;!@[=~: {.?{ =@\\=;\\]\\[? %?_]^;=&?@:{ \\>[ [~|.-[+/}{ -^ ~.|?=:+ =+\\%<{%**]%~ :={>$*}* ~[.;?:>!!{ ].+.$": "junk",
    "def scan(path):\n    rows = load(path, mode='r')\n    for row in rows.items():\n        print(row[0])\n    return len(rows)": None,
    PROSE + "\n\n```sh\n" + "cp a_b /srv/x\n" * 20 + "```": "prose",
    "See also the related pages.": None,
    "```py\nx = 1\n" + "y = 2\n" * 20 + "```": None,
    "": None,
    " \n ": None,
}


@pytest.mark.parametrize("text", list(KINDS))
def test_kinds(text):
    assert quality.judge([text])["kind"][0] == KINDS[text]


def test_kinds_do_not_depend_on_neighbours():
    alone = [quality.judge([t])["kind"][0] for t in KINDS]
    assert list(quality.judge(list(KINDS))["kind"]) == alone


def test_statistics_and_edge_cases(spark):
    df = spark.createDataFrame([("a", "The cat sat.\n\nOn it!\nend", "x"), ("n", None, "x"), ("e", "", "x"), ("a", "The cat sat.\n\nOn it!\nend", "x"), (None, "x" * 50000, "x")], "chunk_id string, text_md string, kind string")
    got = {r["key"]: r for r in quality.text_quality(df).collect()}
    a = got["a"]
    assert (a["word_count"], round(a["mean_word_length"], 4)) == (6, round(16 / 6, 4)) and a["punct_line_share"] == pytest.approx(2 / 3) and a["symbol_ratio"] == pytest.approx(2 / 18) and a["common_word_share"] == pytest.approx(3 / 6)
    assert got["n"]["word_count"] is None and got["e"]["word_count"] == 0 and got["e"]["kind"] is None and got["n"]["kind"] is None
    assert quality.text_quality(df).count() == 5 and quality.text_quality(df.limit(0)).count() == 0


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(3)
    sym = rng.integers(0, 11, 6)
    best = max(np.ndindex(4, 4, 4, 4, 4, 4), key=lambda p: quality.START[p[0]] * quality.EMIT[p[0], sym[0]] * np.prod([quality.MOVE[p[i - 1], p[i]] * quality.EMIT[p[i], sym[i]] for i in range(1, 6)]))
    assert tuple(quality.viterbi(sym, np.zeros(6, int))) == best
    e, m, s = quality.fit(sym, np.zeros(6, int))
    assert quality.fit(np.zeros(0, int), np.zeros(0, int))[2].sum() == pytest.approx(1)
    assert np.allclose(e.sum(1), 1) and np.allclose(m.sum(1), 1) and np.isclose(s.sum(), 1)


# 3: near-duplicates ----------------------------------------------------------------


def corpus(n_groups: int, n_noise: int, seed: int = 1) -> list[tuple[str, str]]:
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(n_groups):
        base = rng.choices(vocab, k=rng.randint(40, 120))
        for v in range(rng.randint(1, 4)):
            words = list(base)
            for _ in range(rng.randint(0, 9)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((f"g{g}v{v}", " ".join(words)))
    rows += [(f"n{i}", " ".join(rng.choices(vocab, k=60))) for i in range(n_noise)]
    return rows


def brute_pairs(rows, n, threshold, least):
    sets = []
    for k, t in {r for r in rows if r[0] is not None and r[1] is not None}:
        w = [x.lower() for x in WORD.findall(t)]
        if len(w) >= max(n, least):
            sets.append((k, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}))
    return {(min(a, b), max(a, b)) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if a != b and len(x & y) >= threshold * len(x | y)}


@pytest.mark.parametrize(("n", "threshold", "least"), [(3, 0.6, 30), (5, 0.8, 0)])
def test_pairs_against_brute_force(spark, n, threshold, least):
    rows = corpus(60, 100)
    rows += [rows[0], (None, rows[0][1]), ("nul", None), ("empty", ""), ("short", "a b"), ("copy1", rows[5][1].upper()), ("copy2", rows[5][1].replace(" ", ", "))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "chunk_id string, text_md string, a int")
    want = brute_pairs(rows, n, threshold, least)
    got = {tuple(r) for r in nearduplicates.near_duplicate_pairs(df, n=n, threshold=threshold, min_words=least).collect()}
    assert got <= want and len(got) >= 0.97 * len(want)
    links = nearduplicates.near_duplicate_links(df, n=n, threshold=threshold, min_words=least).collect()
    cls = {r["key"]: r["cls"] for r in links}
    assert cls["copy1"] == cls["copy2"] == cls[rows[5][0]] and "nul" not in cls
    assert nearduplicates.near_duplicate_pairs(df.limit(0)).count() == 0


def test_hot_group_of_copies_and_variants(spark):
    """A third of the rows are copies, a third small variants of one text: no link is lost."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(80)]
    rows = [(f"c{i}", " ".join(base)) for i in range(150)]
    for i in range(150):
        w = list(base)
        w[rng.randrange(80)] = f"v{i}"
        rows.append((f"v{i}", " ".join(w)))
    rows += corpus(0, 150)
    df = spark.createDataFrame(rows, "chunk_id string, text_md string")
    want = brute_pairs(rows, 3, 0.6, 30)
    got = {tuple(r) for r in nearduplicates.near_duplicate_pairs(df, n=3, threshold=0.6, min_words=30).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_dense_region_loses_no_link(spark, monkeypatch):
    """Variants of one text, all alike: regions of several blocks, verified in place. The same whatever the batches and partitions."""
    monkeypatch.setattr(nearduplicates, "BLOCK", 400)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(1500):
        w = list(base)
        w[rng.randrange(200)] = f"v{i}"
        rows.append((f"v{i}", " ".join(w)))
    df = spark.createDataFrame(rows + corpus(10, 20), "chunk_id string, text_md string").repartition(8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    seen = []
    try:
        for partitions, batch in (("1", "100"), ("40", "10000")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            seen.append({r["key"]: (r["cls"], r["links"]) for r in nearduplicates.near_duplicate_links(df).collect()})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen[0] == seen[1] and all(seen[0][f"v{i}"][1] == 1499 for i in range(1500))
    some = df.where("chunk_id like 'v1%'")  # 611 rows, as pairs
    assert nearduplicates.near_duplicate_pairs(some).count() == some.count() * (some.count() - 1) // 2


def test_common_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.choice(np.concatenate([np.arange(60), rng.integers(100, 5000, 40)]), 50)).astype(np.uint64) for _ in range(90)]
    got = nearduplicates.common_counts(sets[:30], sets[30:])
    assert (got == [[len(np.intersect1d(x, y)) for y in sets[30:]] for x in sets[:30]]).all()
    assert nearduplicates.common_counts([np.zeros(0, np.uint64)], sets[:2]).sum() == 0


def test_all_pairs_of_a_large_region_meet(spark):
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 256, (20000, nearduplicates.WIDTH), dtype=np.uint8)
    sig[:, :3] = 7  # one region of the first tree holds all rows
    a, b = np.arange(0, 10000, 100), np.arange(0, 10000, 100) + 9999
    for k in range(4, nearduplicates.WIDTH):  # each two are alike, but in no other tree, nor in the component after the region's
        sig[b, k] = sig[a, k] if k % 3 else sig[a, k] + 1
    sig[b, 3] = sig[a, 3] + 1
    got = {tuple(r) for r in nearduplicates.forest(spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sig)], "cls long, sig binary"), 0.6).collect()}
    assert got == set(zip(a.tolist(), b.tolist()))


def test_a_region_is_not_cut_at_a_border_of_partitions(spark):
    rng = np.random.default_rng(6)
    sig = rng.integers(0, 256, (256, nearduplicates.WIDTH), dtype=np.uint8)
    sig[:, :3], sig[:, 4::3], sig[:, 5::3] = 1, 2, 3  # all pairs are alike, and meet in the first tree alone
    sig[:, 3::3] = np.arange(256)[:, None]
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert nearduplicates.forest(spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sig)], "cls long, sig binary"), 0.6).count() == 256 * 255 // 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_signatures_estimate_similarity():
    a, b = " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(100, 500))
    h, o, _, _ = nearduplicates.shingles([a, b], 3)
    s = nearduplicates.signatures(h, o, 2)
    assert abs((s[0] == s[1]).mean() - 298 / 498) < 0.22
    perms = nearduplicates.orders()
    assert all(sorted(p) == list(range(nearduplicates.WIDTH)) for p in perms) and len({tuple(p[:3]) for p in perms.tolist()}) == nearduplicates.TREES


# 5: vectors --------------------------------------------------------------------------


def clusters(seed=4, n=3000, dim=32):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n // 3, 5):
        x[i + 1 : i + 5] = x[i] + 0.15 * rng.normal(size=(4, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_exact_search_is_exact_and_relaxed_one_finds_most():
    x = clusters()
    q = np.arange(0, len(x), 10)
    want = vectors.brute_force(x, x[q], q, 5)
    for relax, least in ((1.0, 1.0), (1.5, 0.9)):
        a, b, _ = vectors.search(x, x[q], 5, -1.0, relax, q)
        found = {(int(i), int(j)) for i, j in zip(a, b)}
        assert sum((i, int(j)) in found for i, row in enumerate(want) for j in row) / want.size >= least
    a, b, s = vectors.search(x, x[q], 5, 0.9, vectors.BOUNDED[1], q)
    near = {(i, int(j)) for i, row in enumerate(want) for j in row if x[q[i]].astype(float) @ x[j].astype(float) >= 0.9}
    got = {(int(i), int(j)) for i, j in zip(a, b)}
    assert got <= near and len(got) >= 0.97 * len(near)


def test_shards_and_edge_cases(spark):
    x = clusters(n=1500)
    rows = [(f"c{i:04d}", "p", 32, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [rows[0], ("scaled", "p", 32, [float(v) * 7 for v in x[0]]), ("nul", "p", 32, None), ("zero", "p", 32, [0.0] * 32), ("nan", "p", 32, [float("nan")] + [1.0] * 31), ("short", "p", 32, [1.0]), ("dim", "p", 31, [1.0] * 32), ("nodim", "p", None, [1.0] * 32), ("inner", "p", 32, [None] + [1.0] * 31), ("other", "q", 32, [float(v) for v in x[0]]), (None, "p", 32, [1.0] * 32)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "chunk_id string, provider string, dim int, embedding array<float>, cls string")
    got = vectors.similar_vectors(df, 5, across=1.0, within=1.0, shard=200).collect()
    best = {(r["key"], r["neighbour"]) for r in got}
    want = vectors.brute_force(x, x, np.arange(len(x)), 4)
    assert all((f"c{i:04d}", f"c{j:04d}") in best for i, row in enumerate(want) for j in row)
    assert ("c0000", "scaled") in best and {r["provider"] for r in got} == {"p"} and not {"nul", "zero", "nan", "short", "dim", "nodim", "inner"} & {r["key"] for r in got}
    pairs = {(r["chunk_id_a"], r["chunk_id_b"]) for r in vectors.found(df).collect()}
    near = {(f"c{min(i, j):04d}", f"c{max(i, j):04d}") for i, row in enumerate(vectors.brute_force(x, x, np.arange(len(x)), 5)) for j in row if x[i].astype(float) @ x[j].astype(float) >= 0.9}
    assert len(near & pairs) >= 0.97 * len(near)
    assert vectors.similar_vectors(df.limit(0)).count() == 0


def test_large_shards_are_divided_again(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MAX_SHARDS", 4)  # the first trees tell 4 shards apart: of 100 vectors each they'd hold 750
    monkeypatch.setattr(vectors, "SAMPLE", 200)
    x = clusters()
    df = spark.createDataFrame([(f"{i}", "a|b", 32, [float(v) for v in r]) for i, r in enumerate(x)], "chunk_id string, provider string, dim int, embedding array<float>")
    q = np.arange(0, len(x), 30)
    asks = spark.createDataFrame([(str(i),) for i in q], "key string")
    want = {(str(i), str(j)) for i, row in zip(q, vectors.brute_force(x, x[q], q, 5)) for j in row}
    got = {(r["key"], r["neighbour"]) for r in vectors.similar_vectors(df, 5, across=1.0, within=1.0, queries=asks, shard=100).collect()}
    assert got == want
    r = vectors.recall(df, asks, shard=100).first()
    assert r["enough"] and (r["queries"], r["expected"]) == (100, 500)


def test_vectors_that_are_all_alike_are_dealt_out(spark):
    rng = np.random.default_rng(8)
    x = np.ones((2000, 16)) + 1e-5 * rng.normal(size=(2000, 16))
    x = np.concatenate([x, rng.normal(size=(1000, 16))])
    u = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    r = vectors.Router.fit(u, 30)
    assert sum(n.parts for n in r.nodes if n.point is None) >= 25 and max(n.parts for n in r.nodes if n.point is None) > 10
    ids, yes = np.arange(len(u)), np.ones(len(u), bool)
    lives = np.concatenate([who[here] for _, who, here in r.visits(u, ids, yes, yes, np.full(len(u), 0.1), 1.0, 5)])
    assert sorted(lives.tolist()) == ids.tolist()
    parts = {name: int(here.sum()) for name, _, here in r.visits(u, ids, yes, ~yes, np.full(len(u), 0.1), 1.0, 5)}
    assert max(parts.values()) < 400


def test_hot_group_of_equal_vectors(spark):
    rows = [(f"h{i:03d}", "p", 3, [1.0, 2.0, 3.0]) for i in range(300)] + [("a", "p", 3, [1.0, 2.0, 3.1]), ("b", "p", 3, [-1.0, 0.0, 0.0])]
    got = vectors.similar_vectors(spark.createDataFrame(rows, "chunk_id string, provider string, dim int, embedding array<float>"), 5).collect()
    own = {}
    for r in got:
        own.setdefault(r["key"], []).append(r["neighbour"])
    assert all(len(v) == 5 for v in own.values()) and own["h007"] == ["h000", "h001", "h002", "h003", "h004"] and own["h000"] == ["h001", "h002", "h003", "h004", "h005"]
    assert own["a"] == ["h000", "h001", "h002", "h003", "h004"] and len(own) == 302


# 6: encoding -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aeiortn \n'sdlmve ²Ⅷ漢か́é\x1c<|>", max_size=60))
def test_encoding_is_exact(reference, text):
    enc = encoding.encoder(encoding.read_vocabulary())
    ids = enc.encode(text)
    assert ids == reference([text])[0]
    assert enc.decode(np.array(ids, int)).decode() == text
    assert encoding.cut_words(text) == encoding.WORDS.findall(text)


def test_encoding_of_long_and_odd_texts(spark, reference):
    texts = ["a" * 20000, " " * 9000, "ab" * 9000 + "x", "<|endoftext|> is text", "don't I'LL", "\r\n\t x", "é ﬁ ½"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(90, None, "c"), (91, "", "c"), (0, texts[0], "clash"), (None, "x", "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = encoding.encode_corpus(df)
    out = {r["doc_id"]: r["ids"] for r in got.collect()}
    assert got.count() == len(rows) and [out[i] for i in range(len(texts))] == reference(texts) and out[90] == out[91] == []
    back = {r["doc_id"]: r["text"] for r in encoding.decode_corpus(got).collect()}
    assert [back[i] for i in range(len(texts))] == texts and back[90] == ""
    assert encoding.encode_corpus(df.limit(0)).count() == 0


# 7: leakage --------------------------------------------------------------------------


def test_leaks_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("l", "m", "nt", "rst", "")]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(12, 40)))) for i in range(40)] + [(98, "too short"), (99, None)]
    docs = []
    for d in range(300):
        words = rng.choices(vocab, k=rng.randint(10, 200))
        if d % 3 == 0:
            w = items[rng.randrange(40)][1].split()
            n = rng.choice([9, 11, 12, 12, 14])
            at = rng.randrange(max(1, len(w) - n))
            words[5:5] = w[at : at + n]
        docs.append((d, rng.choice([" ", ", ", "\n- "]).join(words).title(), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (0, docs[0][1], "x"), (None, items[0][1], "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    it = spark.createDataFrame(items, "item_id bigint, text string")
    grams = lambda t: {tuple(w[i : i + 12]) for w in [[x.lower() for x in WORD.findall(t or "")]] for i in range(len(w) - 11)}
    index = {i: grams(t) for i, t in items}
    want = {(d, i) for d, t, _ in docs if d is not None for i, g in index.items() if g & grams(t)}
    assert {tuple(r) for r in leakage.found(df, it).collect()} == want
    assert {tuple(r) for r in leakage.leaked_items(df, it, item_block=300).where("exact").select("key", "item").collect()} == want
    assert leakage.found(df.limit(0), it).count() == 0 and leakage.found(df, it.limit(0)).count() == 0


def test_one_edit_is_found():
    passage = "the quiet archive keeps twelve careful copies of every single page until nobody remembers why it started"
    items = leakage.Items([passage], 8, 1, 12)
    doc = "before " + passage.replace("careful", "carefull") + " after"
    assert len(leakage.leaks([doc], items)[0]) == 1
    assert len(leakage.leaks(["nothing of that kind is in here at all, whatever one may think of it"], items)[0]) == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab", min_size=3, max_size=14), st.text(alphabet="ab", min_size=3, max_size=18))
def test_banded_alignment(x, y):
    """At least the edits of the best alignment of x with a part of y that begins at its start, give or take two letters."""

    def dist(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)  # y may go on

    a, b = (np.array([ord(c) for c in s], np.uint32) for s in (x, y))
    got = leakage.banded_distances(a, np.array([0]), np.array([len(a)]), b, np.array([0]), np.array([len(b)]), 2)[0]
    assert got >= min(3, dist(x, y)) or got == min(3, dist(x, y))


# 8: languages ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def profiles(spark):
    return languages.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark, profiles):
    """On documents of another table, of which some labels are wrong, nine in ten of the labels are met."""
    d = languages.document_languages(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), profiles).where("label is not null and languages = 1")
    assert d.where("label = lang").count() / d.count() > 0.9


SAMPLES = {
    "de": "Diese Seite beschreibt, wie der neue Verwalter die alten Weiterleitungen prüfen kann, falls das Archiv am Monatsende zu langsam ist und niemand eine Nachricht bekommt, weil die Warteschlange steht.",
    "en": "This page explains how the new administrator can check the old redirects when the archive is too slow at the end of the month, and nobody gets a message because the queue has stopped.",
    "fr": "Cette page explique comment la nouvelle administratrice peut vérifier les anciens renvois lorsque le service est trop lent à la fin du mois et que personne ne reçoit de message, car la file est bloquée.",
    "ja": "このページでは、月末に保存庫が遅くなったときに、新しい担当者が古い用語集を確認する方法を説明します。待ち行列が止まった場合、誰にも通知は届きませんので、注意してください。",
}


@pytest.mark.parametrize("lang", list(SAMPLES))
def test_single_language(profiles, lang):
    _, k, _ = languages.languages_of(languages.analyse([SAMPLES[lang]], profiles))
    assert [languages.LANGUAGES[x] for x in k] == [lang]


def test_mixed_and_neutral_texts(profiles):
    mixed = SAMPLES["de"] + "\n\n" + SAMPLES["en"]
    quote = SAMPLES["fr"] + ' "In the past it failed." ' + SAMPLES["fr"]
    code = "```py\n" + "return the value of the queue\n" * 20 + "```"
    junk = "".join(random.Random(1).choice("bcdfgklmnpqrstvwxyz ;,") for _ in range(400))
    texts = [mixed, quote, code, junk, "", "1 2 3 " * 40, "Too short.", SAMPLES["ja"] + "\n\n" + SAMPLES["en"]]
    t, k, c = languages.languages_of(languages.analyse(texts, profiles))
    got = {}
    for i, x in zip(t, k):
        got.setdefault(int(i), set()).add(languages.LANGUAGES[x])
    assert got == {0: {"de", "en"}, 1: {"fr"}, 7: {"en", "ja"}} and (c > 0).all()
    r = languages.analyse([mixed], profiles)
    spans = sorted(zip(r["start"].tolist(), r["end"].tolist()))
    assert len(spans) == 2 and abs(spans[1][0] - len(SAMPLES["de"])) < 5


def test_labels_and_edge_cases(spark, profiles):
    labels = {"en": "en", "EN-us": "en", "English": "en", " eng ": "en", "pt_BR": "pt", "ger": "de", "und": None, "Unknown": None, "": None, "  ": None, None: None, "sv": "sv", "Klingon": "klingon"}
    df = spark.createDataFrame([(k,) for k in labels], "l string")
    assert [r[0] for r in df.select(languages.label_language(F.col("l"))).collect()] == list(labels.values())
    rows = [(1, SAMPLES["de"], "en", 1), (2, SAMPLES["de"], "de-AT", 1), (3, None, "en", 1), (4, "", None, 1), (5, SAMPLES["en"], None, 1), (5, SAMPLES["en"], None, 1), (6, SAMPLES["fr"] + "\n\n" + SAMPLES["en"], "fr", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, label int")
    got = languages.document_languages(docs, profiles).where("label is null or label <> lang or languages > 1").select("key", "lang").distinct()
    assert {tuple(r) for r in got.collect()} == {(1, "de"), (5, "en"), (6, "fr"), (6, "en")}
    assert languages.passages(docs.limit(0), profiles).count() == 0


def test_copies_do_not_crowd_out_the_sample(spark):
    rows = [("en", f"text number {i} " + "with words " * 30) for i in range(400)] + [("de", f"text nummer {i} " + "mit worten " * 30) for i in range(400)]
    df = spark.createDataFrame(rows, "lang string, text string")
    # the copies have the least chance of all, so that they come first
    hot = df.orderBy(F.pmod(F.xxhash64("text"), F.lit(1_000_000_000))).first()
    copies = spark.range(2000).select(F.lit(hot["lang"]).alias("lang"), F.lit(hot["text"]).alias("text"))
    got = [sorted(map(tuple, languages.labelled_sample(d, sample=50).collect())) for d in (df, df.unionByName(copies))]
    assert got[0] == got[1] and len({t for _, _, t in got[0]}) == 100 and sum(k == "de" for k, _, _ in got[0]) == 50


def test_training_on_nothing(spark):
    p = languages.train(spark.createDataFrame([(None, "en"), ("short", None)], "text string, lang string"))
    assert not len(languages.languages_of(languages.analyse([SAMPLES["en"]], p))[0].tolist()) or languages.analyse([SAMPLES["en"]], p)["lang"].size == 0


OTHERS = {
    "pl": "Ta strona opisuje, jak nowy administrator może sprawdzić stare przekierowania, gdy archiwum jest zbyt wolne pod koniec miesiąca i nikt nie otrzymuje wiadomości, ponieważ kolejka się zatrzymała i trzeba czekać.",
    "zh": "本页说明当存档在月底变得太慢时，新的管理员如何检查旧的重定向，因为队列已经停止，没有人会收到消息，所以请注意这一点并及时处理所有的问题和请求。",
    "el": "Αυτή η σελίδα περιγράφει πώς ο νέος διαχειριστής μπορεί να ελέγξει τις παλιές ανακατευθύνσεις όταν το αρχείο είναι πολύ αργό στο τέλος του μήνα και κανείς δεν λαμβάνει μήνυμα.",
}


def test_languages_without_a_profile(spark, profiles):
    rows = [(k, t, "en") for k, t in OTHERS.items()] + [("junk", "qxz kjw vbn pqr zzt wrt mnb vcx lkj hgf dsq wert zxcv bnml kjhg fdsa poiu ytre wqas zxdc mnq", "en")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    assert {(r["key"], r["lang"], r["confidence"]) for r in languages.document_languages(df, profiles).collect()} == {(k, "und", 0.0) for k in OTHERS}
    assert languages.passages(df, profiles).count() == 0


def test_repeated_triples_do_not_raise_the_cosine(profiles):
    b = Block(["abc " * 50, "the quick brown fox jumps over a lazy dog"])
    g = languages.triples(languages.letters()[b.codes])
    sq = languages.squares(g, b.offsets[:-1], 2)
    for k in range(2):  # against the bundled vectors themselves
        mine = g[b.offsets[k] : b.offsets[k + 1]]
        v = languages.gram_vectors(mine[mine >= 0]).astype(float).sum(0)
        assert sq[k] == pytest.approx((v @ v) / languages.DIM, rel=0.25)


def test_table_equals_vectors(profiles):
    """The tabled dot products are those of the bundled vectors."""
    g = languages.triples(languages.letters()[Block([SAMPLES["en"]]).codes])
    g = g[g >= 0]
    g = g[profiles.index[g] > 0]
    doc = languages.gram_vectors(g).astype(float).sum(0)
    assert np.allclose(doc @ profiles.proto.T / np.sqrt(languages.DIM), profiles.table[profiles.index[g]].sum(0), atol=1e-2)


def test_pattern_classes_agree():
    assert re.fullmatch(r".*", "x")
    assert all(splitting.TOKEN.fullmatch(chr(c)) is None for c in splitting.WHITE_SPACE) and splitting.TOKEN.fullmatch("\x1c​")
