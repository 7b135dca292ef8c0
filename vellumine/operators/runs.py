"""Runs of the pipeline as rows of a table: the queue of work, what each needs, and the checks of a plan. Pure transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed order of the states of a run, and what a claim leads to.
STATES = ("normalized", "chunking", "chunked", "embedding", "embedded")
CLAIMS = {"normalized": "chunking", "chunked": "embedding"}
DONE = {"chunking": "chunked", "embedding": "embedded"}


def recover_stale(runs: DataFrame, now: Column, minutes: int = 45) -> DataFrame:
    """The runs(run_id, status, at, claimed_at) with claims older than the time to live given back; a claim without a time is stale."""
    back = F.create_map(*[F.lit(x) for k, v in CLAIMS.items() for x in (v, k)])[F.col("status")]
    stale = back.isNotNull() & (F.col("claimed_at").isNull() | (F.col("claimed_at") < now - F.make_dt_interval(mins=F.lit(minutes))))
    return runs.withColumns({"status": F.when(stale, back).otherwise(F.col("status")), "claimed_at": F.when(~stale, F.col("claimed_at"))})


def claim(runs: DataFrame, status: str, now: Column, n: int = 1) -> DataFrame:
    """The runs with the first `n` of a state claimed, oldest first (at, then run_id; nulls last). A top-k, met again by key."""
    first = runs.where(F.col("status") == status).orderBy(F.asc_nulls_last("at"), "run_id").limit(n).select("run_id", F.lit(True).alias("mine"))
    j = runs.join(F.broadcast(first) if n <= 10000 else first, "run_id", "left")
    return j.select(*[F.when(F.col("mine"), F.lit(CLAIMS[status])).otherwise(F.col(c)).alias(c) if c == "status" else F.when(F.col("mine"), now).otherwise(F.col(c)).alias(c) if c == "claimed_at" else F.col(c) for c in runs.columns])


def finish(runs: DataFrame, ids: DataFrame) -> DataFrame:
    """The runs with those claimed of ids(run_id) moved to the state that their claim led to; others stay."""
    after = F.create_map(*[F.lit(x) for p in DONE.items() for x in p])[F.col("status")]
    j = runs.join(ids.select("run_id").distinct().withColumn("done", F.lit(True)), "run_id", "left")
    moved = F.col("done") & after.isNotNull()
    return j.select(*[F.when(moved, after).otherwise(F.col(c)).alias(c) if c == "status" else F.when(~F.coalesce(moved, F.lit(False)), F.col(c)).alias(c) if c == "claimed_at" else F.col(c) for c in runs.columns])


def reset(runs: DataFrame, status: str) -> DataFrame:
    """All runs beyond a state back in it, without claims."""
    later = F.col("status").isin(*STATES[STATES.index(status) + 1 :])
    return runs.withColumns({"status": F.when(later, status).otherwise(F.col("status")), "claimed_at": F.when(~later, F.col("claimed_at"))})


def needs(phases: dict[str, DataFrame], key: str = "run_id") -> DataFrame:
    """key, phase: the first phase that each run lacks although it has the one before it; runs with all phases aren't listed."""
    names = list(phases)
    out = None
    for a, b in zip(names, names[1:]):
        lack = phases[a].select(key).where(F.col(key).isNotNull()).distinct().join(phases[b].select(key), key, "left_anti").withColumn("phase", F.lit(b))
        out = lack if out is None else out.unionByName(lack)
    first = F.min_by("phase", F.array_position(F.array(*[F.lit(x) for x in names]), F.col("phase")))
    return out.groupBy(key).agg(first.alias("phase"))


def overview(runs: DataFrame, last: int, *by: str) -> DataFrame:
    """by, runs, newest: counts of the newest `last` runs(run_id, at) by their columns; the newest come from a top-k."""
    return runs.orderBy(F.desc_nulls_last("at"), "run_id").limit(last).groupBy(*by).agg(F.count(F.lit(1)).alias("runs"), F.max("at").alias("newest"))


def plan_preflight(plan: DataFrame, documents: DataFrame, chunks: DataFrame, least_chunks: int = 1, least_quality: float = 0.6, most_below: float = 0.2) -> DataFrame:
    """run_id, documents, chunks, below, status, reasons of every run of a plan(run_id), once.

    documents: run_id, quality_score (null counts as 1); chunks: run_id, text_md. A run is BLOCKED for NO_DOCUMENTS,
    NO_CHUNKS, BLANK_CHUNKS (all of them are) or LOW_QUALITY (too many documents below the score), in that order, else READY.
    """
    d = documents.groupBy("run_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.coalesce("quality_score", F.lit(1.0)) < least_quality).alias("below"))
    c = chunks.groupBy("run_id").agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.length(F.trim("text_md")) > 0).alias("filled"))
    j = plan.select("run_id").where("run_id is not null").distinct().join(d, "run_id", "left").join(c, "run_id", "left")
    n = {x: F.coalesce(x, F.lit(0)) for x in ("documents", "chunks", "below", "filled")}
    reasons = F.array_compact(F.array(
        F.when(n["documents"] == 0, "NO_DOCUMENTS"), F.when(n["chunks"] < least_chunks, "NO_CHUNKS"), F.when((n["chunks"] > 0) & (n["filled"] == 0), "BLANK_CHUNKS"), F.when(n["below"] > most_below * n["documents"], "LOW_QUALITY"),
    ))
    return j.select("run_id", n["documents"].alias("documents"), n["chunks"].alias("chunks"), n["below"].alias("below"), F.when(F.size(reasons) == 0, "READY").otherwise("BLOCKED").alias("status"), F.array_join(reasons, ",").alias("reasons"))


def plan_totals(checked: DataFrame) -> DataFrame:
    """One row: runs, ready, blocked, documents and chunks of the ready ones."""
    ready = F.col("status") == "READY"
    some = lambda c: F.coalesce(F.sum(F.when(ready, F.col(c))), F.lit(0)).alias(c)
    return checked.agg(F.count(F.lit(1)).alias("runs"), F.count_if(ready).alias("ready"), F.count_if(~ready).alias("blocked"), some("documents"), some("chunks"))


def log_index(files: DataFrame) -> DataFrame:
    """run_id, segments, bytes, newest of log files(path, length, modificationTime), as a binaryFile scan without content gives them; folders .../run/file."""
    run = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return files.groupBy(run.alias("run_id")).agg(F.count(F.lit(1)).alias("segments"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))


def first_rows(rows: DataFrame, most: int | None, *order: str) -> DataFrame:
    """The first rows in an order, for a stated limit; all if there is none."""
    return rows if most is None else rows.orderBy(*order).limit(most)


def _without(m: Column, keys: Column) -> Column:
    return F.map_filter(m, lambda k, _: ~F.map_contains_key(keys, k))


def merged(*maps: Column) -> Column:
    """Maps of strings as one; of equal keys the later map's value stays. Null maps count as empty."""
    out = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    for m in maps:
        new = F.coalesce(m, F.create_map().cast("map<string,string>"))
        out = F.map_concat(_without(out, new), new)
    return out
