from __future__ import annotations

import hashlib
import math
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from vellumine.functions import hashes as H
from vellumine.functions import text as T
from vellumine.functions import urls as U
from vellumine.functions import vectors as V
from vellumine.operators import statistics as S


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("url", "want"), [
    ("https://example.com/page?utm_source=test&utm_medium=email&real_param=value", "https://example.com/page?real_param=value"), ("https://example.com/page?utm_source=test#section1", "https://example.com/page#section1"),
    ("https://e.com/p?x=1&x=2&y=&_ga=3#f", "https://e.com/p?x=1&y#f"), ("plain", "plain"), ("", ""), (None, None), ("https://e.com/p?a=b%20c", "https://e.com/p?a=b c"), ("https://e.com/?a=%ZZ", "https://e.com/?a=%ZZ"),
])
def test_normalize_url(spark, url, want):
    assert one(spark, url, "string", U.normalize_url) == want


@pytest.mark.parametrize(("url", "kind", "page"), [
    ("/spaces/DEV/pages/123456/Test", "confluence", "123456"), ("/download/attachments/123456/file.pdf", "attachment", None), ("https://google.com", "external", None), ("", "external", None), (None, "external", None),
    ("/pages/viewpage.action?pageId=345678&spaceKey=DEV", "confluence", "345678"), ("https://W.example:80/wiki/x", "external", None), ("https://w.example/wiki/x", "confluence", None), ("#top", "external", None),
])
def test_links(spark, url, kind, page):
    assert one(spark, url, "string", lambda c: U.link_type(c, "https://w.example/wiki")) == kind
    assert one(spark, url, "string", U.page_id) == page


def test_dummy_embedding_matches_its_formula(spark):
    for text in ("Hello", "  HELLO \n", "", "Ünïcode 漢字"):
        d = hashlib.sha256(text.strip().lower().encode()).digest()
        eight = [struct.unpack("f", struct.pack("f", x / 2**32))[0] for x in struct.unpack("<8I", d)]
        for dim in (1, 10, 100):
            assert one(spark, text, "string", lambda c, dim=dim: H.dummy_embedding(c, dim)) == (eight * 13)[:dim]


def test_boosts(spark):
    titles = {"Methodology": 0.20, "Playbook": 0.15, "Runbook": 0.10, "January 2024": -0.10, "2023 Annual": -0.10, "other": 0.0, None: 0.0, "Mayor": 0.0}
    for t, b in titles.items():
        assert one(spark, t, "string", V.boost) == pytest.approx(b)


def test_slugs_and_stems(spark):
    df = spark.createDataFrame([("https://w/pages/12345/DEV+-+Prepare+Discovery+Workshops", "x"), ("https://git/a/b/read-me.md", None), (None, "Été — à_venir!"), (None, None)], "u string, t string")
    assert [r[0] for r in df.select(T.doc_slug(F.col("u"), F.col("t"))).collect()] == ["dev prepare discovery workshops", "read me", "ete a venir", ""]
    for w, s in {"testing": "test", "ring": "ring", "king": "king", "tested": "test", "red": "red", "aed": "aed", "": ""}.items():
        assert one(spark, w, "string", T.stem_word) == s
    assert one(spark, "a//b  c__d!", "string", T.query_slug) == "a_b_c_d"


def test_text_edge_cases(spark):
    for t in (None, "", "  \n"):
        assert one(spark, t, "string", T.word_count) == 0
        assert one(spark, t, "string", lambda c: T.quality_flags(c, F.lit(0))) == ["empty_body", "too_short"]
        assert one(spark, t, "string", T.normalize_text) == ""
    assert one(spark, "a\r\n\r\n\r\n\rb ", "string", T.normalize_text) == "a\n\nb"
    assert one(spark, "x" * 400 + ". y", "string", T.summary) == "x" * 297 + "..."
    assert one(spark, "cat", "string", T.trigrams) == ["  c", " ca", "cat", "at "]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([3.0, 4.0], [3.0, 4.0]), ([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 0 and got[1] == pytest.approx(1) and got[2] is None
    assert [r[0] for r in df.select(V.cosine_distance(F.col("a"), F.col("b"))).collect()][0] is None


@pytest.mark.parametrize("values", [[5], [1, 2], list(range(30)), [1, 1, 1, 7, 9, 2.5, 3, 3, 8, 10, 4], [0.5] * 12])
def test_quantiles(spark, values):
    h = S.histogram(spark.createDataFrame([(float(v),) for v in values], "v double"), F.col("v"))
    x, n = sorted(values), len(values)
    got = h.agg(S.index_quantile(0.5), S.index_quantile(0.9), S.median(), S.exclusive_quantile(9, 10)).first()
    assert got[0] == x[min(int(0.5 * n), n - 1)] and got[1] == x[min(int(0.9 * n), n - 1)] and got[2] == statistics.median(x)
    if n >= 2:
        assert got[3] == pytest.approx(statistics.quantiles(x, n=10)[8])


def test_coverage(spark):
    spans = spark.createDataFrame([("a", 0, 5), ("a", 3, 8), ("a", 10, 12), ("a", None, 3), ("a", 9, 9), ("b", 2, 99), ("a", 0, 5)], "k string, start int, end int")
    lengths = spark.createDataFrame([("a", 15), ("b", 10), ("c", 4), ("d", 0)], "k string, length int")
    assert {tuple(r) for r in S.coverage(spans, lengths, "k").collect()} == {("a", 15, 10, 2), ("b", 10, 8, 1), ("c", 4, 0, 1), ("d", 0, 0, 0)}


def test_reciprocal_rank_is_symmetric(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, None), (None, 4)], "a int, b int")
    got = [r[0] for r in df.select(V.reciprocal_rank(F.col("a"), F.col("b"))).collect()]
    assert got[0] == got[1] == pytest.approx(1 / 61 + 1 / 62) and got[2] == pytest.approx(1 / 63) and math.isclose(got[3], 1 / 64)
