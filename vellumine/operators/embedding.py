"""Embedding of chunks: pluggable providers, incremental loads, manifests and the checks before a load."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.functions import hashes as H
from vellumine.operators.lifecycle import upsert

#: A provider makes, once per task, a function from a list of texts to a list of vectors.
Provider = Callable[[], Callable[[list[str]], list[list[float]]]]
PROVIDERS: dict[str, Provider] = {}


def register(name: str, provider: Provider) -> None:
    PROVIDERS[name] = provider


def embed(chunks: DataFrame, provider: str, dim: int, batch: int = 128) -> DataFrame:
    """chunk_id, provider, dim, embedding, failed of every chunk(chunk_id, text_md).

    'dummy' is an expression and stays in the JVM. Other providers are called with batches of `batch` texts; if a batch
    fails, its texts are tried alone, and one that fails gives a zero vector marked as failed. A vector of another
    length is an error. A null text is embedded as an empty one.
    """
    if provider == "dummy":
        return chunks.select("chunk_id", F.lit("dummy").alias("provider"), F.lit(dim).alias("dim"), H.dummy_embedding(F.col("text_md"), dim).alias("embedding"), F.lit(False).alias("failed"))
    make = PROVIDERS[provider]

    def run(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for page in pages:
            for lo in range(0, len(page), batch):
                part = page.iloc[lo : lo + batch]
                texts = [t or "" for t in part["text_md"]]
                try:
                    vectors, failed = call(texts), [False] * len(texts)
                except Exception:
                    vectors, failed = [], []
                    for t in texts:
                        try:
                            vectors.append(call([t])[0])
                            failed.append(False)
                        except Exception:
                            vectors.append([0.0] * dim)
                            failed.append(True)
                if any(len(v) != dim for v in vectors):
                    raise ValueError(f"{provider} gives vectors of another length than {dim}")
                yield pd.DataFrame({"chunk_id": part["chunk_id"].to_numpy(), "provider": provider, "dim": dim, "embedding": vectors, "failed": failed})

    return chunks.select("chunk_id", "text_md").mapInPandas(run, "chunk_id string, provider string, dim int, embedding array<float>, failed boolean")


def to_embed(chunks: DataFrame, embeddings: DataFrame, provider: str, skip: DataFrame | None = None) -> DataFrame:
    """Chunks(chunk_id, doc_id, content_hash, ...) that have no vector of the provider, or one of another content_hash, and aren't on the skip list (doc_id)."""
    have = embeddings.where(F.col("provider") == provider).select("chunk_id", "content_hash").distinct()
    todo = chunks.where("chunk_id is not null").join(have, (chunks["chunk_id"] == have["chunk_id"]) & chunks["content_hash"].eqNullSafe(have["content_hash"]), "left_anti")
    return todo if skip is None else todo.join(skip.select("doc_id").distinct(), "doc_id", "left_anti")


def load(chunks: DataFrame, embeddings: DataFrame, provider: str, dim: int, skip: DataFrame | None = None, keep_failed: bool = False) -> DataFrame:
    """The embeddings(chunk_id, provider, dim, content_hash, embedding) after a load; a second load changes nothing.

    A text that the provider fails on is tried again by the next load; with keep_failed its zero vector is stored instead.
    """
    check_dimension(embeddings.where(F.col("provider") == provider), dim)
    rows = chunks.withColumn("content_hash", H.content_hash(F.col("text_md"))).dropDuplicates(["chunk_id"])
    fresh = embed(to_embed(rows, embeddings, provider, skip), provider, dim).where("true" if keep_failed else "not failed")
    fresh = fresh.join(rows.select("chunk_id", "content_hash"), "chunk_id").select("chunk_id", "provider", "dim", "content_hash", "embedding")
    return upsert(embeddings, fresh, "chunk_id", "provider")


def check_dimension(embeddings: DataFrame, dim: int) -> None:
    """Raises if vectors of other lengths are stored. One value per length comes to the driver."""
    other = [r[0] for r in embeddings.where("embedding is not null").select(F.size("embedding").alias("n")).where(F.col("n") != dim).distinct().limit(5).collect()]
    if other:
        raise ValueError(f"stored vectors have lengths {sorted(other)}, not {dim}")


#: Fixed order of the reasons for which a set of chunks must be embedded anew.
REASONS = ("provider", "model", "dimension", "tokenizer", "chunker", "chunk_count", "set_hash")


def manifest_changes(before: DataFrame, now: DataFrame, key: str = "run_id") -> DataFrame:
    """key, reasons ('new', or the fields of REASONS that differ, in order) of every run that must be embedded anew."""
    b = before.select(F.col(key), F.struct(*REASONS).alias("b"))
    j = now.join(b, key, "left")
    diff = F.array_compact(F.array(*[F.when(~F.col(r).eqNullSafe(F.col(f"b.{r}")), F.lit(r)) for r in REASONS]))
    reasons = F.when(F.col("b").isNull(), F.array(F.lit("new"))).otherwise(diff)
    return j.select(key, F.array_join(reasons, ",").alias("reasons")).where("reasons <> ''")


def preflight(documents: DataFrame, least: float = 0.6, most_below: float = 0.2) -> DataFrame:
    """run_id, documents, below, ready: which runs have few enough documents below the quality score; a missing score counts as 1."""
    low = F.coalesce("quality_score", F.lit(1.0)) < least
    g = documents.groupBy("run_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if(low).alias("below"))
    return g.withColumn("ready", F.col("below") <= most_below * F.col("documents"))
