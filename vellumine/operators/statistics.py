"""Statistics that need no gathering: quantiles from histograms, coverage by islands, shares and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Ranges of values that histogram() sums on their own.
BUCKETS = 1024


def histogram(rows: DataFrame, value: Column) -> DataFrame:
    """v, n, upto (rows up to and with v), total, of numbers. Its size is that of the distinct values, not of the rows.

    Running sums are taken within BUCKETS ranges of values, each on its own, and shifted by the sums of the ranges before:
    only those, BUCKETS rows at most, meet in one task.
    """
    h = rows.select(value.alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ends = h.agg(F.min("v").cast("double").alias("lo"), F.max("v").cast("double").alias("hi"), F.sum("n").alias("total"))
    place = F.floor((F.col("v").cast("double") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS)
    placed = h.crossJoin(F.broadcast(ends)).withColumn("bucket", F.when(F.col("hi") > F.col("lo"), F.least(F.coalesce(place, F.lit(BUCKETS)), F.lit(BUCKETS))).otherwise(0)).drop("lo", "hi")  # ends is one row
    sums = placed.groupBy("bucket").agg(F.sum("n").alias("inside"))
    before = sums.select("bucket", (F.sum("inside").over(Window.orderBy("bucket")) - F.col("inside")).alias("before"))
    w = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("upto", F.sum("n").over(w)).join(F.broadcast(before), "bucket").select("v", "n", (F.col("upto") + F.col("before")).alias("upto"), "total")


def _at(index: Column) -> Column:
    """The value of the row at a 0-based index, from a histogram."""
    return F.min(F.when(F.col("upto") > index, F.col("v")))


def index_quantile(q: float) -> Column:
    """x[min(int(q n), n - 1)] of the ascending values, over histogram()."""
    return _at(F.least(F.floor(F.lit(q) * F.col("total")), F.col("total") - 1))


def exclusive_quantile(i: int, k: int) -> Column:
    """The i-th of the k - 1 cut points that part the values into k, by the exclusive method."""
    m = F.col("total") + 1
    j = F.greatest(F.lit(1), F.least(F.floor(m * i / k), F.col("total") - 1))
    d = m * i - j * k
    lo, hi = _at(j - 1), _at(j)
    # j and d are the same on all rows
    return (lo * (k - F.max(d)) + hi * F.max(d)) / k


def median() -> Column:
    lo, hi = _at(F.floor((F.col("total") - 1) / 2)), _at(F.floor(F.col("total") / 2))
    return (lo + hi) / 2


def describe(rows: DataFrame, value: Column, cut: tuple[int, int] = (9, 10), least: int = 10) -> DataFrame:
    """One row: n, min, median, upper (the exclusive quantile, the maximum below `least` rows), max, mean."""
    h = histogram(rows, value)
    total = F.max("total")
    return h.agg(
        F.coalesce(total, F.lit(0)).alias("n"), F.min("v").alias("min"), median().alias("median"),
        F.when(total >= least, exclusive_quantile(*cut)).otherwise(F.max("v")).alias("upper"), F.max("v").alias("max"), (F.sum(F.col("v") * F.col("n")) / total).alias("mean"),
    )


def coverage(spans: DataFrame, lengths: DataFrame, key: str) -> DataFrame:
    """key, length, covered, gaps: how much of each text the spans(key, start, end) cover, and the number of gaps.

    Gaps and islands: a span begins an island if it starts beyond the end of all before it. Null, reversed and
    repeated spans don't count; spans are cut to the text. Texts without spans are one gap.
    """
    s = spans.join(lengths, key).where("start is not null and end is not null").select(key, "length", F.greatest("start", F.lit(0)).alias("s"), F.least("end", "length").alias("e")).where("s < e").distinct()
    w = Window.partitionBy(key).orderBy("s", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = s.withColumn("before", F.coalesce(before, F.lit(0)))
    part = fresh.groupBy(key).agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", "before"))).alias("covered"), F.count_if(F.col("s") > F.col("before")).alias("inner"), F.max("e").alias("last"))
    j = lengths.join(part, key, "left")
    gaps = F.when(F.col("last").isNull(), F.when(F.col("length") > 0, 1).otherwise(0)).otherwise(F.col("inner") + F.when(F.col("last") < F.col("length"), 1).otherwise(0))
    return j.select(key, "length", F.coalesce("covered", F.lit(0)).alias("covered"), gaps.alias("gaps"))


def with_zeros(counts: DataFrame, key: str, names: list[str], value: str) -> DataFrame:
    """The counts of the stated names, 0 where there is none."""
    spark = counts.sparkSession
    dim = spark.createDataFrame([(n,) for n in names], f"{key} string")
    return dim.join(counts, key, "left").select(key, F.coalesce(value, F.lit(0)).alias(value))


def top(rows: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values and their counts; ties by value."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(k)
