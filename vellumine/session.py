"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that the operators rely on; none of them sizes the job to a machine.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "vellumine", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = DEFAULTS | {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | extra
    spark = b.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_shipped(spark: SparkSession) -> None:
    """Sends this package to the executors of a cluster, once per application."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_vellumine_shipped", False):
        return
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="vellumine-")) / "vellumine.zip"  # read by the driver's file server only
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("vellumine") / p.relative_to(root))
    sc.addPyFile(str(at))
    sc._vellumine_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; on one machine a folder of our own where it is unset."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if at and not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    if not at:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = os.path.join(tempfile.gettempdir(), "vellumine-checkpoints")
        sc.setCheckpointDir(at)
    return at


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialises df in the shared folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
