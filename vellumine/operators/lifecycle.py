"""Incremental loads: latest versions, upserts, differences, change detection, audits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """The target with the rows of the source put in or in place of those of the same keys. The source must hold each key once."""
    return target.join(source, list(keys), "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """The target and the rows of the source whose keys it lacks."""
    return target.unionByName(source.join(target, list(keys), "left_anti").select(*target.columns))


def upsert_filled(target: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """As upsert(), but a null of the source keeps the target's value."""
    t, s = target.alias("t"), source.alias("s")
    cols = [F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) for c in target.columns if c not in keys]
    return t.join(s, list(keys), "full_outer").select(*keys, *cols).select(*target.columns)


def skip(rows: DataFrame, skiplist: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't on the list; a null key stays."""
    return rows.join(skiplist.select(key).distinct(), key, "left_anti")


def changed(current: DataFrame, previous: DataFrame, key: str, value: str) -> DataFrame:
    """key, change ('new' or 'changed') of the current rows that the previous state lacks or has with another value."""
    p = previous.select(F.col(key), F.col(value).alias("before"), F.lit(1).alias("there"))
    j = current.select(key, value).join(p, key, "left")
    return j.where(F.col("there").isNull() | ~F.col(value).eqNullSafe(F.col("before"))).select(key, F.when(F.col("there").isNull(), "new").otherwise("changed").alias("change"))


def missing_keys(baseline: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Keys of the baseline that the current state lacks, once each."""
    return baseline.select(key).where(F.col(key).isNotNull()).distinct().join(current.select(key).distinct(), key, "left_anti")


def shared_content(documents: DataFrame, key: str, content: str) -> DataFrame:
    """content, copies, first key of every content that several keys have; null content doesn't count."""
    return documents.where(F.col(content).isNotNull()).groupBy(content).agg(F.countDistinct(key).alias("copies"), F.min(key).alias("first_key")).where("copies > 1")


def newest(runs: DataFrame, keep: int, by: str, key: str) -> DataFrame:
    """Rows beyond the newest `keep`, which may be pruned; ties by key. The newest come from a top-k, not a sort of all."""
    top = runs.orderBy(F.desc(by), F.asc(key)).limit(keep)
    return runs.join(top.select(key), key, "left_anti")


def chain(stages: dict[str, DataFrame], key: str) -> DataFrame:
    """For each stage but the first: keys kept from the stage before, lost, and new. One row per step."""
    names = list(stages)
    out = None
    for a, b in zip(names, names[1:]):
        x, y = stages[a].select(key).distinct().withColumn("in_a", F.lit(1)), stages[b].select(key).distinct().withColumn("in_b", F.lit(1))
        j = x.join(y, key, "full_outer")
        row = j.agg(F.lit(f"{a}->{b}").alias("step"), F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("kept"), F.count_if(F.col("in_b").isNull()).alias("lost"), F.count_if(F.col("in_a").isNull()).alias("added"))
        out = row if out is None else out.unionByName(row)
    return out


def field_retention(stages: dict[str, DataFrame], fields: list[str]) -> DataFrame:
    """stage, field, filled, rows: how many rows of each stage have each field."""
    out = None
    for name, df in stages.items():
        cols = [f for f in fields if f in df.columns]
        row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in cols])
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in cols])).alias("x")
        part = row.select(F.lit(name).alias("stage"), "rows", pairs).select("stage", "x.field", "x.filled", "rows")
        out = part if out is None else out.unionByName(part)
    return out


def set_hash(rows: DataFrame, *cols: str) -> DataFrame:
    """One row, set_hash and rows: the same whatever the order of the rows; repeated rows count once.

    Row hashes are added up, so nothing is sorted or gathered: two sums of 64-bit halves make the hash.
    """
    h = F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]), 256)
    half = lambda at: F.sum(F.conv(F.substring("h", at, 12), 16, 10).cast("decimal(38,0)"))
    total = rows.select(h.alias("h")).distinct().agg(F.count(F.lit(1)).alias("rows"), half(1).alias("a"), half(13).alias("b"))
    return total.select("rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), F.coalesce(F.col("a"), F.lit(0)).cast("string"), F.coalesce(F.col("b"), F.lit(0)).cast("string")), 256).alias("set_hash"))


def since(rows: DataFrame, marks: DataFrame, time: str, by: str) -> DataFrame:
    """Rows at or after their group's high-water mark(by, mark); groups without a mark are whole. Equal times come again: deduplicate by key."""
    return rows.join(marks, by, "left").where(F.col("mark").isNull() | (F.col(time) >= F.col("mark"))).drop("mark")


def high_water(rows: DataFrame, time: str, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.max(time).alias("mark"))


def ema(rows: DataFrame, value: str, by: str, order: list[str], alpha: float) -> DataFrame:
    """Exponential moving average along each group, without Python and without gathering groups.

    The first value starts the average; each further one counts alpha. A row folds over a frame of bounded length:
    rows further back would weigh less than double precision can show.
    """
    reach = math.ceil(40 / -math.log10(1 - alpha) / 2.5)
    w = Window.partitionBy(by).orderBy(*order)
    frame = w.rowsBetween(-reach, 0)
    numbered = rows.withColumn("n", F.row_number().over(w))
    items = F.collect_list(F.struct(F.col("n").alias("i"), F.col(value).alias("x"))).over(frame)
    fold = F.aggregate(F.col("items"), F.lit(0.0), lambda s, p: F.when(p["i"] == 1, p["x"]).otherwise(s * (1 - alpha) + alpha * p["x"]))
    return numbered.withColumn("items", items).withColumn("ema", fold).drop("items", "n")
