"""Markup, chunking, retrieval, lifecycle, sources and streams on small inputs."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumine.functions import markup as M
from vellumine.operators import chunking as C
from vellumine.operators import ingest as I
from vellumine.operators import lifecycle as L
from vellumine.operators import retrieval as R
from vellumine.operators import sections as S
from vellumine.sources import paged, readers, writers
from vellumine.streaming import events as E

ADF = json.dumps({"type": "doc", "content": [
    {"type": "heading", "attrs": {"level": 2}, "content": [{"type": "text", "text": "Title"}]},
    {"type": "paragraph", "content": [{"type": "text", "text": "link", "marks": [{"type": "link", "attrs": {"href": "https://x.y/z"}}]}]},
    {"type": "orderedList", "attrs": {"order": 3}, "content": [{"type": "listItem", "content": [{"type": "paragraph", "content": [{"type": "text", "text": "a"}]}]}]},
    {"type": "mediaSingle", "content": [{"type": "media", "attrs": {"id": "media123", "type": "file", "alt": "image.png", "url": "https://x/image.png"}}]},
]})


def test_markdown():
    assert "## Title" in M.adf_markdown(ADF) and "[link](https://x.y/z)" in M.adf_markdown(ADF) and "3. a" in M.adf_markdown(ADF)
    assert M.adf_markdown(None) == M.adf_markdown("no json") == M.adf_markdown("[]") == ""
    assert M.adf_links(ADF) == ["https://x.y/z"]
    assert M.adf_media(ADF) == [{"ord": 0, "filename": "image.png", "url": "https://x/image.png", "media_type": "image"}]
    html = "<h1>Title</h1><p>A <a href='https://x.y/z'>link</a></p><script>no</script><table><tr><th>a</th></tr><tr><td>1</td></tr></table><ul><li>x<li>y"
    md = M.html_markdown(html)
    assert md.startswith("# Title\n\nA [link](https://x.y/z)") and "no" not in md and "| a |\n| --- |\n| 1 |" in md and "* x\n* y" in md
    assert M.html_links(html) == ["https://x.y/z"] and M.html_markdown(None) == ""
    assert M.html_media('<ac:image><ri:attachment ri:filename="a.pdf"/></ac:image>')[0]["media_type"] == "document"
    xml = "<concept id='c'><title>Intro</title><prolog><metadata><keywords><keyword>k1</keyword></keywords><othermeta name='audience' content='beginner'/></metadata></prolog><conbody><p>See <xref href='b.dita'>B</xref></p><image href='i.png'/></conbody></concept>"
    assert "# Intro" in M.xml_markdown(xml) and "[B](b.dita)" in M.xml_markdown(xml) and M.xml_markdown("<a>broken") == "broken"
    assert M.xml_topic(xml) == {"title": "Intro", "keywords": ["k1"], "othermeta": ["audience:beginner"], "images": ["i.png"]}
    assert [x["target"] for x in M.xml_links(xml)] == ["b.dita"]
    nested = "<map><topicref href='a.dita' navtitle='A'><topicref href='b.dita'/></topicref></map>"
    assert [(e["depth"], e["target"]) for e in M.xml_map(nested)] == [(0, "a.dita"), (1, "b.dita")]


PIECES = st.lists(st.sampled_from(["word ", "Sentence one. ", "\n\n", "# Head\n", "| a | b |\n", "```py\nx = 1\n```\n", "x" * 90 + " ", "\n", "é漢"]), max_size=120)


@settings(max_examples=60, deadline=None)
@given(PIECES, st.integers(20, 200))
def test_chunks_keep_the_cap_and_cover_the_text(parts, hard):
    limits = C.Limits(hard=hard, overlap=20, soft=hard // 4, least=hard // 8)
    text = "".join(parts)
    got = C.chunk_text(text, "", limits)
    body = C.re.sub(r"\n{3,}", "\n\n", text).strip()
    covered = bytearray(len(body))
    for _, p in got:
        assert C.tokens(p.text) <= hard
        covered[p.start : p.end] = b"\1" * (p.end - p.start)
    lost = [c for c, x in zip(body, covered) if not x and not c.isspace() and c not in "`pyab|-" ]
    assert not lost, lost[:5]
    assert [n for n, _ in got] == sorted({n for n, _ in got})


def test_long_word_is_not_dropped():
    got = C.chunk_text("x" * 10000)
    assert sum(len(p.text) for _, p in got) == 10000 and all(C.tokens(p.text) <= 800 for _, p in got)


def test_lines_between_tables_are_kept(spark):
    text = "| h |\n| - |\n\nA paragraph between the tables.\n\n" + "\n".join(f"| row {i} of the table |" for i in range(400)) + "\r\n\n\n\nend\n "
    got = C.chunk_text(text, "", C.Limits())
    assert any("A paragraph between" in p.text for _, p in got)
    covered = {k for _, p in got for k in range(p.start, p.end)}
    df = spark.createDataFrame([(text,)], "t string")
    n = df.select(C.body_length(F.col("t"))).first()[0]
    assert n == max(p.end for _, p in got) and len(covered) > 0.995 * n


def test_glue_and_title(spark):
    text = "# A\n\n" + "word " * 900 + "\n\n# B\n\nshort"
    got = C.chunk_text(text, "Doc", C.Limits())
    assert got[0][1].text.startswith("# Doc") and any(p.strategy.endswith("+glue") for _, p in got)
    df = spark.createDataFrame([("1", text, 1), ("2", None, 2), ("3", "", 3)], "doc_id string, text string, ord int")
    rows = C.chunk_documents(df).collect()
    assert {r["doc_id"] for r in rows} == {"1"} and rows[0]["chunk_id"] == "1:0000"


def test_top_k_ties(spark):
    chunks = spark.createDataFrame([("chunk1", "doc1"), ("chunk2", "doc1"), ("chunk3", "doc2"), ("chunk4", "doc2")], "chunk_id string, doc_id string")
    emb = spark.createDataFrame([("chunk1", "p", 3, [0.1, 0.2, 0.3]), ("chunk2", "p", 3, [0.2, 0.3, 0.4]), ("chunk3", "p", 3, [0.1, 0.2, 0.3]), ("chunk4", "p", 3, None), ("chunk1", "q", 3, [9.0, 0.0, 0.0])], "chunk_id string, provider string, dim int, embedding array<float>")
    got = R.dense_search(chunks, emb, [0.15, 0.25, 0.35], "p", 3, 5).collect()
    assert [r["chunk_id"] for r in got] == ["chunk2", "chunk1", "chunk3"] and [r["rank"] for r in got] == [1, 2, 3]


def test_fusion(spark):
    d = spark.createDataFrame([("1", "a", 1), ("2", "a", 2), ("3", "b", 3)], "chunk_id string, doc_id string, rank int")
    x = spark.createDataFrame([("2", "a", 1), ("1", "a", 2), ("4", "c", 3)], "chunk_id string, doc_id string, rank int")
    got = {r["chunk_id"]: r for r in R.fuse(d, x).collect()}
    assert set(got) == {"1", "2", "3", "4"} and got["1"]["rrf"] == got["2"]["rrf"] > got["3"]["rrf"] and got["4"]["dense_rank"] is None


def test_caps_and_context(spark):
    hits = spark.createDataFrame([(i, f"c{i}", d, 0.9, "T", "u", "x" * 100) for i, d in enumerate("12121", 1)], "rank int, chunk_id string, doc_id string, score double, title string, url string, text_md string")
    assert [r["rank"] for r in R.cap_per_document(hits, 2).orderBy("rank").collect()] == [1, 2, 3, 4]
    full = R.context(hits, 10000).first()[0]
    assert full.count("--- Chunk") == 5 and "Chunk 1 (score: 0.900)" in full and "Title: T\nURL: u\n\n" in full
    cut = R.context(hits, 260).first()[0]
    assert cut.count("--- Chunk") == 2 and cut.endswith("[... truncated]")
    assert R.context(hits.limit(0), 100).first()[0] == ""


def test_hit_quality(spark):
    hits = spark.createDataFrame([("q", "doc1", "c1", 0.9, "a", "u"), ("q", "doc1", "c2", 0.8, "a", "u"), ("q", "doc2", "c3", 0.7, " ", "u"), ("q", "doc3", "c4", 0.7, "a", None)], "query_id string, doc_id string, chunk_id string, score double, title string, url string")
    r = R.hit_quality(hits, "query_id").first()
    assert (r["hits"], r["unique_docs"], r["entropy"], r["tie_rate"], r["missing_title"], r["missing_url"], r["complete_hits"]) == (4, 3, 1.5, 0.5, 1, 1, 2)


def test_expectations(spark):
    items = spark.createDataFrame([("q1", "https://w/pages/1/Prepare-Plan", "t", "none"), ("q2", "u", "Data migrations", "testing it"), ("q3", None, None, None)], "query_id string, url string, title string, snippet string")
    got = {r["query_id"]: r for r in R.expectations(items, {"q1": ["prepare-plan"]}, {"g": ["testing"], "h": ["zzz"]}, {"q1": ["g", "h"], "q2": ["g"]}).collect()}
    assert got["q1"]["score"] == 0.6 and not got["q1"]["passed"] and got["q2"]["score"] == 0.4 and got["q3"]["score"] == 0.4


def test_lifecycle(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, "c", 6)], "k int, v string, n int")
    s = spark.createDataFrame([(2, "B", None), (4, "d", 7)], "k int, v string, n int")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(L.upsert(t, s, "k")) == [(1, "a", None), (2, "B", None), (3, "c", 6), (4, "d", 7)]
    assert rows(L.insert_missing(t, s, "k")) == [(1, "a", None), (2, "b", 5), (3, "c", 6), (4, "d", 7)]
    assert rows(L.upsert_filled(t, s, "k"))[1] == (2, "B", 5)
    assert rows(L.changed(s, t, "k", "v")) == [(2, "changed"), (4, "new")]
    assert rows(L.missing_keys(t, s, "k")) == [(1,), (3,)]
    assert L.set_hash(t, "k", "v").first() == L.set_hash(t.orderBy(F.desc("k")).unionByName(t.limit(1)), "k", "v").first() != L.set_hash(s, "k", "v").first()
    assert L.set_hash(t.limit(0), "k").first()["rows"] == 0
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "id string")
    assert rows(L.missing_keys(ids(["123", "456", "789", "999"]), ids(["123", "789"]), "id")) == [("456",), ("999",)]
    assert rows(L.chain({"a": ids(["1", "2"]), "b": ids(["2", "3"])}, "id")) == [("a->b", 1, 1, 1)]


def test_related(spark):
    df = spark.createDataFrame([("a", "alpha beta gamma"), ("b", "Beta, alpha delta gamma"), ("c", "alpha only"), ("d", None)], "k string, t string")
    got = S.related(df, "k", "t", least=3).collect()
    assert [(r["src"], r["dst"], r["evidence"]) for r in got] == [("a", "b", "alpha,beta,gamma")]


def test_related_whole_texts(spark):
    import random

    rng = random.Random(3)
    rows = [(f"d{i:02d}", " ".join(["that", *rng.choices([f"word{k}" for k in range(60)] + ["été", "漢字かなも"], k=rng.randint(0, 40))])) for i in range(50)] + [("n", None), (None, "that word1 word2"), ("e", "")]
    sets = {k: {w for w in (t or "").split() if len(w) >= 4} for k, t in rows if k}
    want = {(a, b, round(min(0.7, len(x & y) / 20), 6), ",".join(sorted(x & y)[:5])) for a, x in sets.items() for b, y in sets.items() if a < b and len(x & y) >= 3}
    got = S.related_texts(spark.createDataFrame(rows, "k string, t string"), "k", "t", block=8).collect()
    assert len(got) == len(want) > 100 and {(r["src"], r["dst"], r["confidence"], r["evidence"]) for r in got} == want


def test_related_texts_lie_on_disk_once(spark):
    import random
    from pathlib import Path

    rng = random.Random(5)
    rows = [(k, " ".join(f"{rng.getrandbits(40):010x}" for _ in range(40)) + " that with then") for k in range(800)]
    folders = [Path(str(f)) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p: p.stat().st_size for f in folders for p in f.rglob("shuffle_*.data")}
    before = files()
    df = S.related_texts(spark.createDataFrame(rows, "k long, t string"), "k", "t", block=16)
    assert df.count() == 800 * 799 // 2
    written = sum(n for p, n in files().items() if p not in before)
    assert 0 < written < 4 * sum(len(t) for _, t in rows)  # 50 blocks


def test_related_texts_take_few_bytes_on_disk(spark):
    import random
    from pathlib import Path

    rng = random.Random(7)
    words = [f"{rng.getrandbits(32):08x}" for _ in range(3000)]
    rows = [(k, " ".join(dict.fromkeys(words[int(3000 * rng.random() ** 4)] for _ in range(120)))) for k in range(2000)]
    folders = [Path(str(f)) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p: p.stat().st_size for f in folders for p in f.rglob("shuffle_*.data")}
    before = files()
    edges = S.related_texts(spark.createDataFrame(rows, "k long, t string"), "k", "t").count()
    written = sum(n for p, n in files().items() if p not in before)
    sets = [set(t.split()) for _, t in rows]
    assert edges == sum(len(a & b) >= 3 for i, a in enumerate(sets) for b in sets[:i])
    assert 0 < written < 4 * sum(map(len, sets))  # bytes a word, both shuffles; 9 were written of whole words


def test_texts_are_packed_and_cut_whole(monkeypatch):
    import random

    import pyarrow as pa

    class Context:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(S, "TaskContext", Context)
    rng = random.Random(11)
    rows = [(k % 5, k, rng.sample([f"w{i}" for i in range(40)], rng.randint(0, 12))) for k in rng.choices(range(60), k=150)]
    want = {}
    for _, k, w in rows:
        want.setdefault(k, set()).update(w)
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part]), pa.array([r[2] for r in part], pa.list_(pa.string()))], ["k", "id", "w"])
    seen = []
    for size in (10, 150):
        packs = pa.Table.from_batches(S._packs((batch(rows[i : i + size]) for i in range(0, 150, size)), most=60)).sort_by("k")
        blocks = list(S._blocks(iter(packs.to_batches(max_chunksize=4)), block=7, most=50))
        got = {}
        for x, body in ((x, body) for b in blocks for x, body in zip(b.column(0).to_pylist(), b.column(1))):
            ids, words, cell = S._opened(body)
            assert len(ids) <= 7 and (len(ids) == 1 or len(cell) <= 50) and words.to_pylist() == sorted(set(words.to_pylist()))
            for k in ids.to_pylist():
                assert k not in got
                got[k] = set()
            for c in cell.tolist():
                got[ids[c % len(ids)].as_py()].add(words[c // len(ids)].as_py())
        assert got == {k: w for k, w in want.items() if w} and len({b.column(0)[0].as_py() for b in blocks}) == len(blocks) > 8
        seen.append([b.column(1).to_pylist() for b in blocks])
    # a task that is run again makes the same blocks, in whatever order the packs come
    turned = packs.take(pa.array(range(len(packs) - 1, -1, -1))).sort_by("k")
    assert [b.column(1).to_pylist() for b in S._blocks(iter(turned.to_batches()), block=7, most=50)] == seen[1]


def test_related_texts_of_one_key_are_one_text(spark):
    rows = [("d", "alpha beta"), ("d", "gamma alpha"), ("d", None), ("d", "beta"), ("e", "gamma beta alpha"), ("f", "alpha beta"), (None, "alpha beta gamma"), ("g", "a b")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
        got = S.related_texts(spark.createDataFrame(rows, "k string, t string"), "k", "t", block=1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [tuple(r) for r in got] == [("d", "e", "RELATES_TO", 0.15, "alpha,beta,gamma")]


def test_titles_of_any_length_are_mentioned(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [("a", "Roadmap", f"see {long}, then"), ("b", long.title(), "the roadmap of it"), ("c", "Two words", "Roadmaps; two words"), ("d", None, "roadmap"), ("e", "...", None)]
    got = I.title_mentions(spark.createDataFrame(rows, "doc_id string, title string, text string")).collect()
    assert sorted((r["src"], r["dst"]) for r in got) == [("a", "b"), ("b", "a"), ("d", "a")]


def test_long_documents_in_lines(spark):
    text = "\n".join(["# h"] + ["line"] * 1000)
    got = S.lines(spark.createDataFrame([("a", text), ("b", "x\n"), ("c", None)], "k string, t string"), "k", "t").orderBy("k", "n").collect()
    assert len(got) == 1003 and got[1000]["at"] == len(text) - 4 and sum(r["size"] for r in got[:1001]) == len(text)


def test_pages(spark, tmp_path):
    page = {"id": "1", "title": "T", "space_key": "DEV", "space_name": "Dev", "url": "https://w.example/spaces/DEV/pages/1", "body_storage": "<p>Hi <a href='/spaces/X/pages/22/Y#a'>l</a></p><img src='d/a.png' alt='a.png'>", "labels": ["x"], "ancestors": [{"id": "0", "title": "Up"}], "attachments": [{"id": "att", "filename": "a.png"}]}
    (tmp_path / "runs/r1").mkdir(parents=True)
    (tmp_path / "runs/r1/p.ndjson").write_text(json.dumps(page) + "\n\n{broken\n" + json.dumps({"id": "2", "body_adf": ADF}) + "\n")
    rows, bad = readers.read_ndjson(spark, str(tmp_path / "runs/r1/p.ndjson"), readers.PAGE)
    assert bad.count() == 1 and {r["run_id"] for r in rows.collect()} == {"r1"}
    docs = {r["id"]: r for r in I.normalize_pages(rows).collect()}
    assert docs["1"]["breadcrumbs"] == ["Dev", "Up", "T"] and "Hi [l](/spaces/X/pages/22/Y#a)" in docs["1"]["text_md"] and docs["2"]["body_repr"] == "adf" and "## Title" in docs["2"]["text_md"]
    link = next(r for r in I.page_links(rows, "https://w.example").collect() if r["from_page_id"] == "1")
    assert (link["target_page_id"], link["target_type"], link["anchor"]) == ("22", "confluence", "a")
    assert {(r["page_id"], r["attachment_id"]) for r in I.page_media(rows).collect()} == {("1", "att"), ("2", None)}
    assert {tuple(r) for r in I.edges(rows).collect()} == {("CONTAINS", "space:DEV", "1"), ("LABELED_AS", "1", "label:x"), ("PARENT_OF", "0", "1")}
    assert rows.select(I.content_sha256(rows).alias("h")).where("h is not null").count() == 2
    writers.write_ndjson(rows, str(tmp_path / "out"))
    assert spark.read.schema(readers.PAGE).json(str(tmp_path / "out")).count() == 2
    assert "| id |" in writers.markdown_table(rows.select("id")) and json.loads(writers.json_report(rows.agg(F.count(F.lit(1)).alias("n")))) == {"n": 2}


def test_topics_and_maps(spark, tmp_path):
    for p, x in {"concepts/introduction.dita": "<concept id='i'><title>I</title></concept>", "tasks/setup.dita": "<task><title>S</title></task>", "maps/user-guide.ditamap": "<map><topicref href='../concepts/introduction.dita' navtitle='Intro'/><topicref href='../tasks/setup.dita#x'/></map>", "skip/x.xml": "<other/>", "tasks/old.dita": "<task/>"}.items():
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text(x)
    t = readers.read_topics(spark, str(tmp_path), exclude=["**/old.*"])
    assert {r["id"] for r in t.collect()} == {"topic:concepts/introduction", "topic:tasks/setup", "map:maps/user-guide"}
    assert {(r["topic_id"], r["title"]) for r in I.map_edges(t).collect()} == {("topic:concepts/introduction", "Intro"), ("topic:tasks/setup", "")}
    got = spark.createDataFrame([("guides/user-help/the_api/x.dita",), ("x.dita",)], "p string").select(*I.directory_context(F.col("p"))).collect()
    assert tuple(got[0]) == ("guides", ["api", "guides", "help", "user"]) and tuple(got[1]) == (None, [])


def test_paged_source(spark, tmp_path):
    from urllib.parse import quote

    def put(url, data):
        (tmp_path / (quote(url, safe="") + ".json")).write_text(json.dumps(data))

    page = lambda n, at: {"id": n, "title": f"t{n}", "version": {"number": 1, "createdAt": at}, "body": {"storage": {"value": "<p>x</p>"}}}
    put("/pages?space-id=A&limit=100", {"results": [page(1, "2024-01-01"), page(2, "2024-02-01")], "_links": {"next": "https://w.example/pages?cursor=2"}})
    put("/pages?cursor=2", {"results": [page(3, "2024-03-01")], "_links": {"next": "/pages?cursor=2"}})
    put("/pages?space-id=B&limit=100", {"results": [page(4, "2024-04-01")]})
    paged.register(spark)
    df = spark.read.format("paged").option("folder", str(tmp_path)).option("spaces", "A,B").load()
    assert {r["id"] for r in df.collect()} == {"1", "2", "3", "4"}
    assert {r["id"] for r in df.where("space_id = 'A' and updated_at > '2024-01-15'").collect()} == {"2", "3"}


def test_plans_queries_settings(spark, tmp_path, monkeypatch):
    (tmp_path / "plan.txt").write_text("# head\nrun-1:12\nvar/runs/run-2 # note\nbad line\n\n")
    assert [(r["run_id"], r["documents"], r["valid"]) for r in readers.read_plan(spark, str(tmp_path / "plan.txt")).collect()] == [("run-1", 12, True), ("run-2", None, True), (None, None, False)]
    (tmp_path / "q.json").write_text(json.dumps({"queries": [{"id": 1, "text": "x"}]}))
    assert readers.read_queries(spark, str(tmp_path / "q.json")).collect()[0]["id"] == "1"
    (tmp_path / "bad.json").write_text('[{"id": "1"}]')
    with pytest.raises(ValueError):
        readers.read_queries(spark, str(tmp_path / "bad.json"))
    (tmp_path / "c.json").write_text('{"top_k": 3, "name": "f"}')
    monkeypatch.setenv("VELLUMINE_TOP_K", "4")
    assert readers.settings({"top_k": 2, "name": "d", "on": False}, str(tmp_path / "c.json"), given={"name": "g", "on": None}) == {"top_k": 4, "name": "g", "on": False}


def test_streams(spark, tmp_path):
    ev = spark.createDataFrame([(1, "2024-01-01 00:10:00", 7, "a", 2.0), (2, "2024-01-01 00:20:00", 7, "a", 4.0), (3, "2024-01-01 05:00:00", 8, "b", 1.0)], "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    ev.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = E.file_stream(spark, str(tmp_path / "in"), "event_id long, ts timestamp, user_id long, event_type string, value double")
    closed = E.run_to_end(E.windowed_counts(s)).collect()
    assert [(r["event_type"], r["n"], r["total"]) for r in closed] == [("a", 2, 6.0)]  # the last window isn't past its lateness
    got = {r["user_id"]: (r["n"], r["ema"]) for r in E.run_to_end(E.stateful_ema(s, 0.5), "update").collect()}
    assert got == {7: (2, 3.0), 8: (1, 1.0)}
    q = E.upsert_stream(s, str(tmp_path / "table"), "user_id", "ts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["user_id"]: r["event_id"] for r in E.read_latest(spark, str(tmp_path / "table")).collect()} == {7: 2, 8: 3}
    log = spark.createDataFrame([("[2024-01-01T00:00:00Z] INFO done docs=3 chunks=9",), ("noise",)], "value string")
    rows = E.parse_log(log).collect()
    assert (rows[0]["level"], rows[0]["docs"], rows[0]["chunks"]) == ("INFO", 3, 9) and rows[1]["level"] is None


def test_stream_reads_all_files_of_a_table(spark, tmp_path):
    from vellumine.plans import catalog

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = catalog.queries()["stream_event_windows"](spark, str(tmp_path)).agg(F.sum("n")).first()[0]
    assert got == ev.count() > 0


def test_embedding_load_skips_known_chunks(spark, monkeypatch):
    from vellumine.plans import catalog, ingest_queries

    seen = []
    monkeypatch.setattr(ingest_queries.B, "check_dimension", lambda e, dim: seen.append(e.where("embedding is not null").count()))
    todo = ingest_queries.B.to_embed
    monkeypatch.setattr(ingest_queries.B, "to_embed", lambda rows, *a: seen.append((rows.where("chunk_id is not null").count(), todo(rows, *a).count())) or todo(rows, *a))
    catalog.queries()["embedding_load"](spark, "/root/testdata/sf0.001")
    stored, (chunks, made) = seen
    assert stored > 0 and 0 < made < chunks


def test_ema_matches_the_stream_rule(spark):
    df = spark.createDataFrame([("u", i, float(v)) for i, v in enumerate([3, 1, 4, 1, 5])], "u string, i int, v double")
    want, m = [], None
    for v in [3, 1, 4, 1, 5]:
        m = v if m is None else 0.9 * m + 0.1 * v
        want.append(m)
    assert [r["ema"] for r in L.ema(df, "v", "u", ["i"], 0.1).orderBy("i").collect()] == pytest.approx(want)
