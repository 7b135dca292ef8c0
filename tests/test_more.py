"""Raw pages, references, labels, embedding loads, manifests and question classes."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from vellumine.functions import queries as Q
from vellumine.functions import urls as U
from vellumine.operators import embedding as B
from vellumine.operators import ingest as I


def test_raw_pages(spark):
    rows = [
        {"id": 1, "title": "T", "spaceId": "9", "version": {"number": 3, "createdAt": "2024-01-02"}, "createdAt": "2024-01-01", "author": {"accountId": "a1", "displayName": "Ann"}, "_links": {"webui": "/spaces/D/pages/1"}, "body": {"storage": {"value": "<p>x</p>"}}, "attachments": [{"id": "f", "title": "a.png", "mediaType": "image/png", "fileSize": 5, "_links": {"download": "/d/a.png"}}]},
        {"id": "2", "authorId": "a2", "body": {"atlas_doc_format": {"value": "{\"type\":\"doc\"}"}}, "attachments": [{"filename": "b.pdf", "type": "pdf", "size": 7}]},
        {"id": "3", "author": "a3"},
    ]
    raw = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("broken",), (None,)], "raw string")
    got = {r["id"]: r for r in I.map_raw_pages(raw, "https://w.example/").collect()}
    a, b, c = got["1"], got["2"], got["3"]
    assert (a["version"], a["updated_at"], a["url"], a["body_repr"], a["body_storage"]) == (3, "2024-01-02", "https://w.example/spaces/D/pages/1", "storage", "<p>x</p>")
    assert a["created_by"]["account_id"] == "a1" and a["created_by"]["display_name"] == "Ann"
    assert a["attachments"][0]["filename"] == "a.png" and a["attachments"][0]["file_size"] == 5 and a["attachments"][0]["download_url"] == "https://w.example/d/a.png"
    assert b["body_repr"] == "adf" and b["created_by"]["account_id"] == "a2" and b["attachments"][0]["media_type"] == "pdf" and b["attachments"][0]["file_size"] == 7
    assert c["created_by"]["account_id"] == "a3" and c["attachments"] == [] and c["body_repr"] is None and None in got


def test_attachments_spaces_references_labels(spark):
    df = spark.createDataFrame([(["a.png"], [("b.pdf", "u")], None, "https://w/spaces/DEV/pages/1")], "n array<string>, o array<struct<filename:string,download_url:string>>, k string, u string")
    r = df.select(I.normal_attachments(F.col("n"), F.col("o")).alias("x"), I.space_key(F.col("k"), F.col("u")).alias("s"), I.space_key(F.lit("K"), F.col("u")).alias("s2"), I.space_key(F.col("k"), F.lit("no")).alias("s3")).first()
    assert [tuple(x) for x in r["x"]] == [("a.png", None), ("b.pdf", "u")] and (r["s"], r["s2"], r["s3"]) == ("DEV", "K", "__unknown__")
    refs = {"b.dita": "topic:guides/b", "../ref/C.dita#x": "topic:ref/c", "m.ditamap": "map:guides/m", "https://x.y/z": None, "#here": "topic:guides/a", "": None}
    d = spark.createDataFrame([(k,) for k in refs], "t string")
    assert [x[0] for x in d.select(I.resolve_reference(F.lit("guides/A.dita"), F.col("t"))).collect()] == list(refs.values())
    labels = spark.range(1).select(I.aggregate_labels(F.array(F.lit("z"), F.lit("a")), F.array(F.lit("a")), F.lit("guides"), F.create_map(F.lit("audience"), F.lit("beginner")), F.array(F.lit("User Guide!"))).alias("l")).first()["l"]
    assert labels == ["a", "audience:beginner", "guides", "map:user-guide", "z"]
    u = spark.createDataFrame([("https://a/b?x=1 2&msclkid=3",)], "u string").select(U.normalize_url(F.col("u"), U.TRACKING_XML, encode=True)).first()[0]
    assert u == "https://a/b?x=1+2"
    kinds = spark.createDataFrame([("a.dita",), ("m.ditamap#x",), ("mailto:x",), (None,), ("img.png",)], "u string").select(U.xml_link_type(F.col("u"))).collect()
    assert [k[0] for k in kinds] == ["topic", "map", "external", "other", "other"]


def test_title_mentions(spark):
    df = spark.createDataFrame([("a", "Known Limits", "see the Retention-Table!"), ("b", "Retention table", "nothing"), ("c", "One", "known limits. one"), ("d", None, None), ("e", "Known limits of all", "")], "doc_id string, title string, text string")
    assert {(r["src"], r["dst"]) for r in I.title_mentions(df).collect()} == {("a", "b"), ("c", "a")}


def test_embedding_loads(spark):
    def provider():  # within the test, so that it travels by value
        def call(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("bad")
            return [[float(len(t)), 1.0] for t in texts]

        return call

    B.register("lengths", provider)
    chunks = spark.createDataFrame([("c1", "d1", "abc"), ("c2", "d1", "bad"), ("c3", "d2", None), ("c1", "d1", "abc"), (None, "d3", "x")], "chunk_id string, doc_id string, text_md string")
    got = {r["chunk_id"]: (r["embedding"], r["failed"]) for r in B.embed(chunks, "lengths", 2, 10).collect()}
    assert got["c1"] == ([3.0, 1.0], False) and got["c2"] == ([0.0, 0.0], True) and got["c3"] == ([0.0, 1.0], False)
    none = spark.createDataFrame([], "chunk_id string, provider string, dim int, content_hash string, embedding array<float>")
    once = B.load(chunks, none, "lengths", 2).cache()
    assert {r["chunk_id"] for r in once.collect()} == {"c1", "c3"}
    rows = chunks.withColumn("content_hash", B.H.content_hash(F.col("text_md")))
    assert {r["chunk_id"] for r in B.to_embed(rows, once, "lengths").collect()} == {"c2"}
    assert B.to_embed(rows, once, "lengths", spark.createDataFrame([("d1",)], "doc_id string")).count() == 0
    assert sorted(map(str, B.load(chunks, once, "lengths", 2).collect())) == sorted(map(str, once.collect()))
    with pytest.raises(ValueError):
        B.check_dimension(once, 3)


def test_manifests(spark):
    fields = "run_id string, provider string, model string, dimension int, tokenizer string, chunker string, chunk_count int, set_hash string"
    before = spark.createDataFrame([("r1", "p", "m", 2, "t", "c", 5, "h"), ("r2", "p", None, 2, "t", "c", 5, "h")], fields)
    now = spark.createDataFrame([("r1", "p", "m", 2, "t", "c", 5, "h"), ("r2", "q", None, 3, "t", "c", 5, "x"), ("r3", "p", "m", 2, "t", "c", 5, "h")], fields)
    assert {tuple(r) for r in B.manifest_changes(before, now).collect()} == {("r2", "provider,dimension,set_hash"), ("r3", "new")}


def test_questions(spark):
    df = spark.createDataFrame([("What is the N2S lifecycle?",), ("rebuild",), (None,), ("Sprint  0 plan",)], "q string")
    assert [r[0] for r in df.select(Q.is_process(F.col("q"))).collect()] == [True, False, False, True]
    assert Q.expand("other") == ["other"] and Q.expand("N2S governance")[1:] == ["N2S", "Navigate to SaaS", "governance checkpoints", "entry criteria", "exit criteria"]
    h = spark.createDataFrame([(["The go-live Plan"],), ([],)], "h array<string>")
    assert [r[0] for r in h.select(Q.has_phrase(F.col("h"), ["launch"], {"launch": ["Go live"]})).collect()] == [True, False]
    d = spark.createDataFrame([("Team Playbook", None), ("x", '{"k": "methodology"}'), ("x", None)], "t string, m string")
    assert [r[0] for r in d.select(Q.process_documents(F.col("t"), F.col("m"))).collect()] == [True, True, False]
