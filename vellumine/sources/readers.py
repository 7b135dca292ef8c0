"""Sources: NDJSON records, XML topic files, plan files, query files, settings."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTACHMENT = "struct<id:string,filename:string,media_type:string,file_size:bigint,download_url:string>"
USER = "struct<account_id:string,display_name:string>"
#: An ingested page, with its raw body in one of three forms.
PAGE = f"""id string, title string, space_key string, space_id string, space_name string, url string, version int, created_at string, updated_at string,
body_repr string, body_storage string, body_adf string, body_dita_xml string, attachments array<{ATTACHMENT}>, ancestors array<struct<id:string,title:string,url:string>>,
labels array<string>, created_by {USER}, updated_by {USER}, source_system string"""
EVENT = "ts string, level string, stage string, rid string, op string, status string, duration_ms int, counts struct<docs:int,chunks:int,tokens:int>, doc_id string, chunk_id string, provider string, model string, dimension int, reason string"


def read_ndjson(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their run_id, malformed lines with their file). Blank lines are skipped. No inference: the schema is stated."""
    full = T.StructType(list(_struct(schema).fields) + [T.StructField("_corrupt", T.StringType())])
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = lines.withColumn("r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    rows = parsed.where("r._corrupt is null").select("r.*", F.regexp_extract("file", r"/runs/([^/]+)/", 1).alias("run_id")).drop("_corrupt")
    return rows, parsed.where("r._corrupt is not null").select("file", "value")


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def glob_to_regex(glob: str) -> str:
    """A glob over relative paths as a regular expression; ** stands for any folders."""
    out = re.escape(glob.removeprefix("**/")).replace(r"\*\*/", "(?:.*/)?").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return f"(?i)(?:^|/){out}$"


def included(path: Column, include: list[str], exclude: list[str]) -> Column:
    """Excluded first, then included."""
    any_of = lambda globs: "|".join(glob_to_regex(g) for g in globs) or "(?!)"
    return ~path.rlike(any_of(exclude)) & path.rlike(any_of(include))


def read_topics(spark: SparkSession, root: str, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """id, kind (topic or map), path, xml, sha256 of the XML topic files below a folder; other .xml files are told by their root element."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{dita,ditamap,xml}").load(root)
    rel = F.regexp_replace(F.col("path"), f"^.*?{re.escape(str(root).rstrip('/'))}/", "")
    rows = df.select(rel.alias("path"), F.decode("content", "UTF-8").alias("xml"), F.sha2("content", 256).alias("sha256"))
    rows = rows.where(included(F.col("path"), include or ["*.dita", "*.xml", "*.ditamap"], exclude or []))
    is_map = F.lower("path").endswith(".ditamap") | F.col("xml").rlike(r"(?s)<(?:book)?map[\s>]") & ~F.lower("path").endswith(".dita")
    kind = F.when(is_map, "map").when(F.col("xml").rlike(r"(?s)<(?:topic|concept|task|reference|glossentry)[\s>]"), "topic")
    stem = F.regexp_replace(F.lower("path"), r"\.[^./]+$", "")
    return rows.withColumn("kind", kind).where("kind is not null").select(F.concat("kind", F.lit(":"), stem).alias("id"), "kind", "path", "xml", "sha256")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """run_id, documents, valid of the lines of a plan, 'run:count' or '.../runs/run'; comments and blank lines are skipped."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    rows = spark.read.text(path).select(line.alias("line")).where("line <> ''")
    run = F.coalesce(F.nullif(F.regexp_extract("line", r"(?:^|/)runs/([^/:\s]+)/?$", 1), F.lit("")), F.nullif(F.regexp_extract("line", r"^([^/:\s]+):\d+$", 1), F.lit("")))
    return rows.select(run.alias("run_id"), F.expr("try_cast(nullif(regexp_extract(line, ':(\\\\d+)$', 1), '') as int)").alias("documents"), run.isNotNull().alias("valid"), "line")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """id, text of the stated queries in a JSON file, or a YAML one where a parser is installed: a list, or one under 'queries'."""
    raw = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("a YAML parser isn't installed; give the queries as JSON") from e
        data = yaml.safe_load(raw)
    else:
        data = json.loads(raw)
    rows = data.get("queries", []) if isinstance(data, dict) else data
    for r in rows:
        if not r.get("id") or not r.get("text"):
            raise ValueError(f"a query needs an id and a text: {r}")
    return spark.createDataFrame([(str(r["id"]), str(r["text"])) for r in rows], "id string, text string")


def settings(defaults: dict, path: str | None = None, prefix: str = "VELLUMINE_", given: dict | None = None) -> dict:
    """Defaults, then the file's, then the environment's, then the given values; the later ones win."""
    out = dict(defaults)
    if path and os.path.exists(path):
        out |= json.loads(Path(path).read_text())
    for k, v in defaults.items():
        if (e := os.environ.get(prefix + k.upper())) is not None:
            out[k] = type(v)(e) if v is not None and not isinstance(v, bool) else e.lower() in ("1", "true", "yes") if isinstance(v, bool) else e
    return out | {k: v for k, v in (given or {}).items() if v is not None}


def first_existing(*paths: str) -> str | None:
    return next((p for p in paths if os.path.exists(p)), None)
