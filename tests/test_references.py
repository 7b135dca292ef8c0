from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vellumine.operators import references as R

D = lambda n: datetime(2024, 1, n)
KB, DEL, CH, EMB, LINK = "doc_id string, loaded_at timestamp, title string", "page_id string, deleted_at timestamp, run_id string", "chunk_id string, doc_id string, emitted_at timestamp, k string, t int", "chunk_id string, provider string, created_at timestamp", "link_id bigint, target_page_id string, seen_at timestamp"


def run(spark, kb=(), gone=(), chunks=(), emb=(), links=()):
    f = lambda rows, s: spark.createDataFrame(list(rows), s)
    out = R.orphan_references(f(kb, KB), f(gone, DEL), f(chunks, CH), f(emb, EMB), f(links, LINK))
    return {tuple(r) for r in out.collect()}


def test_presence_at_time(spark):
    kb = [(" A ", D(5), "x"), ("a", D(5), "x"), ("a", D(20), None), (None, D(1), "x"), ("b", None, "x")]
    gone = [("A", D(10), None), ("A", D(10), None), (None, D(3), None), ("zz", D(3), None)]
    links = [(n, t, D(d)) for n, t, d in [(1, "a", 4), (2, "A", 5), (3, "a ", 9), (4, "a", 10), (5, "a", 19), (6, "a", 20), (7, "b", 9), (8, "  ", 9), (9, None, 9), (10, "none", 9)]]
    got = run(spark, kb, gone, [], [], [*links, links[0]])
    assert got == {("link_refs", str(n), "2024-01") for n in (1, 4, 5, 7, 10)}


def test_load_and_deletion_at_one_time(spark):
    assert run(spark, [("a", D(5), "x")], [("a", D(5), None)], [], [], [(1, "a", D(5)), (2, "a", D(6))]) == {("link_refs", "1", "2024-01"), ("link_refs", "2", "2024-01")}


def test_chunks_and_vectors(spark):
    chunks = [("c1", "a", D(6), "clash", 1), ("c1", "a", D(6), "clash", 1), ("c2", "gone", D(6), None, None), ("c3", None, D(6), None, None), ("c4", "a", None, None, None)]
    emb = [("c1", "p", D(6)), ("C1 ", "q", D(5)), ("c9", "p", D(9)), (None, "p", D(9)), ("c4", "p", D(9)), ("c1", "r", None), ("c9", "r", None)]
    got = run(spark, [("a", D(5), "x")], [], chunks, emb, [])
    assert got == {("chunks", "c2", "2024-01"), ("chunk_embeddings", "C1 |q", "2024-01"), ("chunk_embeddings", "c9|p", "2024-01"), ("chunk_embeddings", "c4|p", "2024-01"), ("chunk_embeddings", "c9|r", None)}


def test_empty_tables(spark):
    assert run(spark) == set()
    assert run(spark, links=[(1, "a", D(1))]) == {("link_refs", "1", "2024-01")}


def test_hot_parent(spark):
    """A third of all references on one parent gives the same as brute force."""
    refs = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), (F.lit(D(1)).cast("timestamp") + F.make_dt_interval(F.col("id") % 20)).alias("t"), F.col("id"))
    loads = spark.createDataFrame([("hot", D(5))] + [(f"k{n}", D(n % 25 + 1)) for n in range(0, 50, 2)], "k string, t timestamp")
    gone = spark.createDataFrame([("hot", D(9))], "k string, t timestamp")
    got = {r["id"] for r in R.orphans(refs, R.presence(loads, gone)).collect()}
    first = {"hot": 5} | {f"k{n}": n % 25 + 1 for n in range(0, 50, 2)}
    want = set()
    for n in range(6000):
        k, day = "hot" if n % 3 == 0 else f"k{n % 50}", 1 + n % 20
        if k not in first or day < first[k] or (k == "hot" and day >= 9):
            want.add(n)
    assert got == want


def test_refuted_references_are_not_joined(spark):
    refs = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(D(2)).cast("timestamp").alias("t"), F.col("id"))
    out = R.orphans(refs, R.presence(spark.createDataFrame([("k1", D(1)), ("k2", D(5))], "k string, t timestamp"), None))
    assert {r["id"] for r in out.collect()} == set(range(3000)) - {1}
    union = out._jdf.queryExecution().optimizedPlan()
    assert union.nodeName() == "Union" and "Join" not in union.children().head().toString()
    joined = union.children().last().toString()
    assert "LeftAnti" in joined and "Filter (" in joined.split("LeftAnti")[1] and "may_contain" in joined


def test_bloom_filter_has_no_false_negatives(spark):
    h = spark.range(20000).select(F.xxhash64("id").alias("h"))
    b = R.BloomFilter(h.where("h % 2 = 0"), 10000)
    rows = h.toPandas()["h"].to_numpy()
    hit = b.contains(rows)
    assert hit[rows % 2 == 0].all() and hit[rows % 2 != 0].mean() < 0.05
    assert R.BloomFilter(h, 10**12).bits == R.MAX_BITS
