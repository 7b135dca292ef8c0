"""Event streams: windows with late data, averages with state, increments, upserts and log lines."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vellumine.operators.lifecycle import upsert
from vellumine.operators.retrieval import latest
from vellumine.session import ensure_checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_a_batch: int = 100, glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch)
    return (r.option("pathGlobFilter", glob) if glob else r).format(fmt).load(path)


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """event_type, start, n, total by window of ts; rows later than `late` after the newest are dropped with their windows' state."""
    w = events.withWatermark("ts", late).groupBy("event_type", F.window("ts", size).alias("w"))
    return w.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.col("w.start").alias("start"), "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """user_id, start, stop, n: runs of a user's events no further apart than the gap."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def run_to_end(df: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now and gives what it wrote. Output and checkpoint lie in the shared folder."""
    spark = df.sparkSession
    at = f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4()}"
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    else:
        q = df.writeStream.outputMode(mode).foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(f"{at}/out")).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{at}/out")


def upsert_stream(df: DataFrame, path: str, key: str, order: str):
    """A stream of records kept as the latest row of each key in a Parquet table; each batch writes a new version of it.

    The version written last is named by _latest; readers follow it, so a failed batch leaves the old one.
    """
    spark = df.sparkSession

    def put(batch: DataFrame, n: int) -> None:
        rows = latest(batch.where(F.col(key).isNotNull()), key, order).select(*batch.columns)
        now = read_latest(spark, path)
        if now is not None:
            older = now.join(rows.select(key, F.col(order).alias("_new")), key, "left")
            rows = upsert(now, rows.join(older.where(F.col(order) > F.col("_new")).select(key), key, "left_anti"), key)
        rows.write.mode("overwrite").parquet(f"{path}/v{n}")
        spark.createDataFrame([(n,)], "version bigint").coalesce(1).write.mode("overwrite").json(f"{path}/_latest")

    return df.writeStream.foreachBatch(put)


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        n = spark.read.schema("version bigint").json(f"{path}/_latest").first()
    except Exception as e:  # the table isn't there yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return None if n is None else spark.read.parquet(f"{path}/v{n[0]}")


def stateful_ema(events: DataFrame, alpha: float = 0.1) -> DataFrame:
    """user_id, n, ema after each batch: an average with one number of state per user; a user's rows of a batch come in order of ts."""

    def step(k: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, mean = state.get if state.exists else (0, 0.0)
        values = pd.concat(list(rows)).sort_values(["ts", "event_id"])["value"].dropna()
        for v in values:
            mean = v if n == 0 else mean + alpha * (v - mean)
            n += 1
        state.update((n, float(mean)))
        yield pd.DataFrame({"user_id": [k[0]], "n": [n], "ema": [mean]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, n long, ema double", "n long, ema double", "update", GroupStateTimeout.NoTimeout)


def parse_log(lines: DataFrame) -> DataFrame:
    """ts, level, message, docs, chunks of log lines '[time] LEVEL message (docs=1 chunks=2)'; other lines give nulls. Batch or stream."""
    v = F.col("value")
    num = lambda k: F.expr(f"try_cast(nullif(regexp_extract(value, '{k}=(\\\\d+)', 1), '') as int)")
    return lines.select(F.try_to_timestamp(F.regexp_extract(v, r"^\[([^\]]+)\]", 1)).alias("ts"), F.nullif(F.regexp_extract(v, r"^\[[^\]]+\]\s+([A-Z]+)", 1), F.lit("")).alias("level"), F.nullif(F.regexp_extract(v, r"^\[[^\]]+\]\s+[A-Z]+\s+(.*)$", 1), F.lit("")).alias("message"), num("docs").alias("docs"), num("chunks").alias("chunks"))
