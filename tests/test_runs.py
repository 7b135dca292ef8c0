"""Runs, plans, retrieval quality, quantiles and places in the source on small inputs."""

from __future__ import annotations

import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumine import session
from vellumine.functions import text as T
from vellumine.operators import chunking as C
from vellumine.operators import embedding as B
from vellumine.operators import qa as A
from vellumine.operators import retrieval as R
from vellumine.operators import runs as N
from vellumine.operators import statistics as S

D = lambda n: datetime(2024, 1, n)
RUN = "run_id string, status string, at timestamp, claimed_at timestamp, clash string"
NOW = lambda: F.lit("2024-01-20").cast("timestamp")


def states(df):
    return {r["run_id"]: (r["status"], r["claimed_at"]) for r in df.collect()}


def test_queue(spark):
    rows = [("a", "normalized", D(3), None, "x"), ("b", "normalized", D(1), None, "x"), ("c", "normalized", D(1), None, None), ("d", "normalized", None, None, None), ("e", "chunking", D(1), D(2), None), ("f", "embedding", D(1), None, None), ("g", None, None, None, None)]
    runs = spark.createDataFrame(rows, RUN)
    got = states(N.claim(runs, "normalized", NOW(), 2))
    assert {k for k, v in got.items() if v == ("chunking", D(20))} == {"b", "c"} and len(got) == 7 and N.claim(runs, "normalized", NOW()).columns == runs.columns
    back = states(N.recover_stale(runs, NOW()))
    assert back["e"] == ("normalized", None) and back["f"] == ("chunked", None) and back["g"] == (None, None)
    assert states(N.recover_stale(runs, F.lit("2024-01-02 00:30:00").cast("timestamp")))["e"] == ("chunking", D(2))
    done = states(N.finish(runs, spark.createDataFrame([("e",), ("e",), ("a",), (None,)], "run_id string")))
    assert done["e"] == ("chunked", None) and done["a"] == ("normalized", None)
    assert {v[0] for v in states(N.reset(runs, "normalized")).values()} == {"normalized", None}
    assert N.claim(runs.limit(0), "normalized", NOW()).count() == 0


def test_needs_and_overview(spark):
    f = lambda *x: spark.createDataFrame([(i,) for i in x], "run_id string")
    got = N.needs({"ingest": f("a", "a", "b", "c", None), "enrich": f("b", "c"), "chunk": f("c")}).collect()
    assert {tuple(r) for r in got} == {("a", "enrich"), ("b", "chunk")}
    runs = spark.createDataFrame([("a", D(1), "x"), ("b", D(2), "y"), ("c", D(3), "y"), ("d", None, "x")], "run_id string, at timestamp, source string")
    assert {tuple(r) for r in N.overview(runs, 2, "source").collect()} == {("y", 2, D(3))}


def test_plan(spark):
    plan = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",), (None,)], "run_id string")
    docs = spark.createDataFrame([("a", 0.9), ("a", None), ("b", 0.1), ("c", 0.9)], "run_id string, quality_score double")
    chunks = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", " "), ("c", None)], "run_id string, text_md string")
    checked = N.plan_preflight(plan, docs, chunks)
    assert {r["run_id"]: r["reasons"] for r in checked.collect()} == {"a": "", "b": "LOW_QUALITY", "c": "BLANK_CHUNKS", "d": "NO_DOCUMENTS,NO_CHUNKS"}
    assert tuple(N.plan_totals(checked).first()) == (4, 1, 3, 2, 1) and tuple(N.plan_totals(checked.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_evaluation(spark):
    hits = spark.createDataFrame([("q1", f"c{i}", f"d{i % 4}", 1.0 - i / 10, i, "T", "u", "x" * 100) for i in range(1, 7)] + [("q2", "c1", "d1", 0.5, 1, "T", None, "x" * 900)], "query_id string, chunk_id string, doc_id string, score double, rank int, title string, url string, text_md string")
    queries = spark.createDataFrame([("q1",), ("q1",), ("q2",), ("q3",)], "query_id string")
    e = A.evaluate(hits, queries, [250, 1000])
    got = {(r["query_id"], r["budget"]): (r["hits"], r["used"], r["reasons"]) for r in e.collect()}
    assert got == {("q1", 250): (2, 200, "unique_docs"), ("q1", 1000): (6, 600, ""), ("q2", 250): (0, 0, "no_hits"), ("q2", 1000): (1, 900, "unique_docs,missing_url"), ("q3", 250): (0, 0, "no_hits"), ("q3", 1000): (0, 0, "no_hits")}
    assert tuple(A.readiness(e).first()) == (3, 0, 0.0, False) and tuple(A.readiness(e.limit(0)).first()) == (0, 0, 0.0, False)
    assert {r["query_id"]: r["reasons"] for r in A.query_gates(e).collect()} == {"q1": "unique_docs", "q2": "missing_url,no_hits,unique_docs", "q3": "no_hits"}
    assert A.trace(hits.where("query_id = 'q2'"), "query_id").first()["trace"] == '[{"rank":1,"chunk_id":"c1","doc_id":"d1","score":0.5}]'


def test_search_within_documents(spark):
    chunks = spark.createDataFrame([("c1", "a", "red fox"), ("c2", "b", "red hen"), ("c3", None, "red"), ("c4", "b", None)], "chunk_id string, doc_id string, text_md string")
    emb = spark.createDataFrame([(f"c{i}", "p", 2, [1.0, float(i)]) for i in range(1, 9)], "chunk_id string, provider string, dim int, embedding array<float>")
    docs = spark.createDataFrame([("a", "S", "Runbook", None), ("b", "T", "x", None), ("c", None, None, '{"k": "n2s"}')], "doc_id string, space_key string, title string, meta string")
    ids = lambda df: [r["chunk_id"] for r in df.orderBy("rank").collect()]
    only = R.allowed_documents(docs, ["T"])
    assert ids(R.lexical_search(chunks, "red", 5, allowed=only)) == ["c2"] and ids(R.dense_search(chunks, emb, [1.0, 9.0], "p", 2, 5, only)) == ["c4", "c2"]
    assert {r[0] for r in R.allowed_documents(docs, process=True).collect()} == {"a", "c"} and R.allowed_documents(docs, []).count() == 0
    # most of the best vectors have no chunk: more are taken until there are enough
    many = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("chunk_id"), F.lit("p").alias("provider"), F.lit(2).alias("dim"), F.array(F.lit(1.0).cast("float"), F.lit(9.0).cast("float")).alias("embedding"))
    assert ids(R.dense_search(chunks, emb.unionByName(many), [1.0, 9.0], "p", 2, 3)) == ["c4", "c3", "c2"]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 25, 1000])
def test_quantiles_from_ranges(spark, n):
    import statistics

    x = [((i * 7919) % 997) / 7 for i in range(n)] + [None]
    r = S.describe(spark.createDataFrame([(v,) for v in x], "v double"), F.col("v")).first()
    x = sorted(v for v in x if v is not None)
    assert r["n"] == n
    if n:
        assert (r["min"], r["max"], r["median"]) == pytest.approx((x[0], x[-1], statistics.median(x)))
        assert r["upper"] == pytest.approx(statistics.quantiles(x, n=10)[8] if n >= 10 else x[-1])


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab \n\r\t　é", max_size=60))
def test_places_in_the_source(text):
    body = C.re.sub(r"\n{3,}", "\n\n", C.re.sub(r"\r\n?", "\n", text)).strip()
    place = C.source_places(text)
    places = [place(i) for i in range(len(body))]
    assert all(c == ("\n" if text[p] == "\r" else text[p]) for c, p in zip(body, places)) and places == sorted(set(places))
    titled = C.source_places(text, "T")
    assert [titled(i + len("# T\n\n")) for i in range(len(body))] == places and titled(0) == 0


def test_spans_of_chunks_fit_the_source(spark):
    text = "\n\n" + "\r\n\r\n\r\n".join(f"Paragraph {i} " + "word " * 200 for i in range(9)) + "  \n"
    rows = C.chunk_documents(spark.createDataFrame([("1", text)], "doc_id string, text string")).collect()
    assert len(rows) > 2
    for r in rows:
        assert text[r["source_start"] : r["source_end"]].split() == r["text_md"].split()


def test_maps_digests_and_failures(spark):
    row = spark.sql("select map('a', '1', 'b', '2') as x, map('b', '3', 'c', '4') as y, cast(null as map<string,string>) as z")
    assert row.select(N.merged(F.col("x"), F.col("z"), F.col("y")).alias("m")).first()["m"] == {"a": "1", "b": "3", "c": "4"}
    d = spark.createDataFrame([("|h|\n|-|\n" + "|r|\n" * 7,), ("```py\ndef f(x):\n  a\n  b\n  c\n```",), (None,), ("",)], "t string").select(T.table_digest(F.col("t")), T.code_digest(F.col("t"))).collect()
    assert d[0][0].endswith("|r|\n... (2 more rows)") and d[1][1] == "Code (py): f\ndef f(x):\n  a\n  b" and d[2][0] is d[2][1] is d[3][0] is None

    def bad():
        def call(texts):
            raise RuntimeError

        return call

    B.register("bad", bad)
    none = spark.createDataFrame([], "chunk_id string, provider string, dim int, content_hash string, embedding array<float>")
    chunks = spark.createDataFrame([("c", "d", "x")], "chunk_id string, doc_id string, text_md string")
    assert B.load(chunks, none, "bad", 2).count() == 0 and B.load(chunks, none, "bad", 2, keep_failed=True).first()["embedding"] == [0.0, 0.0]


def test_checkpoints_need_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())


def test_entry_without_llm(tmp_path):
    """Without that subpackage the entry imports and gives the core's queries; a missing library is no silent loss."""
    root = Path(session.__file__).parents[1]
    code = "import sys, shutil, importlib; sys.path.insert(0, {0!r}); import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    import shutil

    shutil.copytree(root / "vellumine", tmp_path / "vellumine", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code.format(str(tmp_path))], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=120)
    from vellumine.plans import catalog

    assert out.stdout.split() == [str(len(catalog.queries())), str(len(catalog.oracle_sql()))], out.stderr
