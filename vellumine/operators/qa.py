"""Retrieval quality end to end: stated queries against budgets, gates with reasons, statistics per budget, readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.operators.retrieval import hit_quality, pack

#: What a query must hold at each budget: different documents at least, share of tied scores at most.
MIN_DOCS, MAX_TIES = 3, 0.35
#: Share of the queries that must pass.
READY = 0.8


def evaluate(hits: DataFrame, queries: DataFrame, budgets: list[int], min_docs: int = MIN_DOCS, max_ties: float = MAX_TIES) -> DataFrame:
    """query_id, budget, hits, used, unique_docs, entropy, tie_rate, reasons, passed of every query(query_id) at every budget.

    hits: query_id, chunk_id, doc_id, score, rank, title, url, text_md. They are packed in rank order as far as the budget
    of characters allows. A query without hits, or whose first hit is beyond the budget, fails for 'no_hits'. The stated
    queries and budgets make a small product.
    """
    each = F.explode(F.array(*[F.lit(b) for b in budgets])).alias("budget")
    packed = pack(hits.select("*", each), F.col("budget"), "query_id", "budget")
    used = packed.groupBy("query_id", "budget").agg(F.max("used").alias("used"))
    quality = hit_quality(packed, "query_id", "budget").join(used, ["query_id", "budget"])
    rows = queries.select("query_id").distinct().select("query_id", each).join(quality, ["query_id", "budget"], "left")
    none = F.col("hits").isNull()
    reasons = F.array_compact(F.array(
        F.when(none, "no_hits"), F.when(F.col("unique_docs") < min_docs, "unique_docs"), F.when(F.col("tie_rate") > max_ties, "tie_rate"),
        F.when(F.col("missing_title") > 0, "missing_title"), F.when(F.col("missing_url") > 0, "missing_url"),
    ))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("query_id", "budget", zero("hits"), zero("used"), zero("unique_docs"), "entropy", "tie_rate", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("passed"))


def pack_statistics(evaluated: DataFrame) -> DataFrame:
    """budget, queries, mean_hits, mean_used, mean_docs, untied (mean of 1 - tie_rate of those with hits), pass_rate."""
    mean = lambda c: F.round(F.avg(c), 6)
    return evaluated.groupBy("budget").agg(
        F.count(F.lit(1)).alias("queries"), mean("hits").alias("mean_hits"), mean("used").alias("mean_used"), mean("unique_docs").alias("mean_docs"),
        mean(1 - F.col("tie_rate")).alias("untied"), mean(F.col("passed").cast("int")).alias("pass_rate"),
    )


def query_gates(evaluated: DataFrame) -> DataFrame:
    """query_id, passed (at every budget), failed_budgets, reasons (all of them, sorted)."""
    split = F.filter(F.split("reasons", ","), lambda x: x != "")
    return evaluated.groupBy("query_id").agg(F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed_budgets"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(split)))), ",").alias("reasons"))


def readiness(evaluated: DataFrame, least: float = READY) -> DataFrame:
    """One row: queries, passed, pass_rate, ready. Without queries nothing is ready."""
    g = query_gates(evaluated).agg(F.count(F.lit(1)).alias("queries"), F.count_if("passed").alias("passed"))
    rate = F.when(F.col("queries") > 0, F.col("passed") / F.col("queries")).otherwise(0.0)
    return g.select("queries", "passed", F.round(rate, 6).alias("pass_rate"), (rate >= least).alias("ready"))


def tie_multiplicity(hits: DataFrame, *by: str, most: float = 0.3) -> DataFrame:
    """Of each group of hits(score): the share of the most frequent score, and whether it is at most `most`."""
    per = hits.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("n"))
    share = F.max("n") / F.sum("n")
    return per.groupBy(*by).agg(F.round(share, 6).alias("tie_share"), (share <= most).alias("fine"))


def trace(hits: DataFrame, *by: str) -> DataFrame:
    """by, trace: the hits of each query as one JSON line, in rank order. Groups are bounded by their top-k."""
    one = F.struct("rank", "chunk_id", "doc_id", "score")
    return hits.groupBy(*by).agg(F.to_json(F.array_sort(F.collect_list(one))).alias("trace"))
