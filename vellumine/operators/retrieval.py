"""Dense, lexical and hybrid retrieval, packing of the hits, and their quality."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumine.functions import text as T
from vellumine.functions import vectors as V
from vellumine.functions.queries import process_documents

#: Rows of (chunk_id, score) that may be broadcast.
BROADCAST_ROWS = 1 << 17


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the given columns; repeated rows count once."""
    names = [c for c in df.columns if c != key]
    most = F.max_by(F.struct(*names), F.struct(*[F.col(o) for o in order])).alias("last")
    return df.groupBy(key).agg(most).select(key, *[F.col(f"last.{n}").alias(n) for n in names])


def rank_top(df: DataFrame, k: int, *order: Column, name: str = "rank") -> DataFrame:
    """The first k rows and their rank. The limit runs as a top-k, so the one-partition window sees k rows only."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def allowed_documents(documents: DataFrame, spaces: list[str] | None = None, process: bool = False) -> DataFrame:
    """doc_id of the documents(doc_id, space_key, title, meta) in one of the spaces and, if `process`, about the process.
    A list of spaces that is empty allows none; a null space is in none."""
    rows = documents if spaces is None else documents.where(F.col("space_key").isin(*spaces) if spaces else F.lit(False))
    return (rows.where(process_documents(F.col("title"), F.col("meta"))) if process else rows).select("doc_id").where("doc_id is not null").distinct()


def dense_search(chunks: DataFrame, embeddings: DataFrame, query: list[float] | Column, provider: str, dim: int, top_k: int = 8, allowed: DataFrame | None = None) -> DataFrame:
    """The top_k chunks by cosine with the query vector: chunk_id, doc_id, score, rank; ties by doc_id, chunk_id.

    Scores are rounded to nine digits before they are ranked. Only vectors of the provider and dimension count; a
    vector of nulls, NaN or another length is left out. Repeated rows count once; vectors without a chunk don't count.
    allowed: the documents (doc_id) to search in, all if None.

    The scan reads four columns and scores in the JVM. The few best scores, a bounded number, come to the driver in one
    job and are broadcast to the scan of the chunks, so no table is shuffled. If too few of them have a chunk, or the last
    place is tied with rows left out, more are taken. With `allowed`, or where more would be needed than may be broadcast,
    the scores meet the chunks in a join of (chunk_id, score) rows.
    """
    q = query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])
    e = embeddings.where((F.col("provider") == provider) & (F.col("dim") == dim) & (F.size("embedding") == dim)).where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)))
    scored = e.select("chunk_id", F.round(V.cosine(F.col("embedding"), q), 9).alias("score")).where("chunk_id is not null")
    owner = chunks.select("chunk_id", "doc_id")
    by = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc_nulls_last("chunk_id"))
    meet = lambda rows, own: rank_top(rows.join(own, "chunk_id").select("chunk_id", "doc_id", "score").distinct(), top_k, *by)
    if allowed is not None:
        return meet(scored, owner.join(allowed, "doc_id", "left_semi"))
    take = 2 * top_k + 100
    while take <= BROADCAST_ROWS:
        best = scored.orderBy(F.desc("score")).limit(take).collect()
        few = scored.sparkSession.createDataFrame(pa.table({c: [r[c] for r in sorted(set(best))] for c in ("chunk_id", "score")}, pa.schema([("chunk_id", pa.string()), ("score", pa.float64())])))
        hits = meet(F.broadcast(few), owner)
        if len(best) < take or hits.where(F.col("score") > best[-1]["score"]).count() >= top_k:
            return hits
        take *= 16
    return meet(scored, owner)


def lexical_search(chunks: DataFrame, query: str, top_k: int = 200, match: str = "any", k1: float = 1.2, b: float = 0.75, allowed: DataFrame | None = None) -> DataFrame:
    """The top_k chunks by BM25: chunk_id, doc_id, score, rank; ties by doc_id, chunk_id. match 'all' wants every term.

    Terms are runs of letters and digits in lower case. allowed: the documents (doc_id) to search in, all if None; the
    statistics are those of all chunks. Each text is cut into words once; what goes on is its ids, its length and its
    counts of the terms. One exchange of these narrow rows drops repeated ones and serves both the statistics (one row)
    and the scores.
    """
    terms = list(dict.fromkeys(t for t in re.findall(r"[^\W_]+", query.lower())))
    if not terms:
        return chunks.select("chunk_id", "doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("rank")).limit(0)
    # the generator keeps the words from being written out once for each use
    cut = F.inline(F.transform(F.array(T.words(F.col("text_md"))), lambda w: F.struct(F.size(w).alias("n"), F.filter(w, lambda x: x.isin(*terms)).alias("of"))))
    times = lambda term: F.size(F.filter("of", lambda x: x == term))
    counted = chunks.select("chunk_id", "doc_id", cut).where("n > 0").select("chunk_id", "doc_id", "n", F.array(*[times(t) for t in terms]).alias("tf")).distinct()
    tf = [F.col("tf")[i] for i in range(len(terms))]
    stats = counted.agg(F.count(F.lit(1)).alias("rows"), F.avg("n").alias("mean"), *[F.count_if(f > 0).alias(f"df{i}") for i, f in enumerate(tf)])
    hit = functools.reduce(lambda x, y: x & y if match == "all" else x | y, [f > 0 for f in tf])
    score = F.lit(0.0)
    for i, f in enumerate(tf):
        idf = F.log(1 + (F.col("rows") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        score = score + idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("n") / F.col("mean")))
    # stats is one row; the condition names it so that it isn't pushed below the exchange, which both sides share
    scored = counted.crossJoin(F.broadcast(stats)).where(F.when(F.col("rows") > 0, hit)).select("chunk_id", "doc_id", F.round(score, 9).alias("score"))
    if allowed is not None:
        scored = scored.join(allowed, "doc_id", "left_semi").select("chunk_id", "doc_id", "score")
    return rank_top(scored, top_k, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc_nulls_last("chunk_id"))


def trigram_search(chunks: DataFrame, query: str, top_k: int = 8, least: float = 0.1, allowed: DataFrame | None = None) -> DataFrame:
    """The top_k chunks, of the allowed documents, whose trigrams resemble those of the query by more than `least`."""
    own = T.trigrams(F.lit(query))
    rows = chunks if allowed is None else chunks.join(allowed, "doc_id", "left_semi")
    scored = rows.select("chunk_id", "doc_id", F.round(T.trigram_similarity(T.trigrams(F.col("text_md")), own), 9).alias("score")).where(F.col("score") > least).distinct()
    return rank_top(scored, top_k, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc_nulls_last("chunk_id"))


def fuse(dense: DataFrame, lexical: DataFrame, k: int = 60) -> DataFrame:
    """chunk_id, doc_id, dense_rank, lexical_rank, rrf: reciprocal rank fusion of two ranked lists."""
    d = dense.select("chunk_id", F.col("doc_id").alias("d1"), F.col("rank").alias("dense_rank"))
    x = lexical.select("chunk_id", F.col("doc_id").alias("d2"), F.col("rank").alias("lexical_rank"))
    both = d.join(x, "chunk_id", "full_outer")
    return both.select("chunk_id", F.coalesce("d1", "d2").alias("doc_id"), "dense_rank", "lexical_rank", F.round(V.reciprocal_rank(F.col("dense_rank"), F.col("lexical_rank"), k=k), 9).alias("rrf"))


def hybrid_search(chunks: DataFrame, embeddings: DataFrame, documents: DataFrame, query: str, vector: list[float] | Column, provider: str, dim: int, top_k: int = 8, pool: int = 200, k: int = 60, allowed: DataFrame | None = None) -> DataFrame:
    """Dense and lexical pools fused, boosted by title, best first: chunk_id, doc_id, title, dense_rank, lexical_rank, score, rank."""
    fused = fuse(dense_search(chunks, embeddings, vector, provider, dim, pool, allowed), lexical_search(chunks, query, pool, allowed=allowed), k)
    titles = documents.select("doc_id", "title")
    scored = fused.join(titles, "doc_id", "left").withColumn("score", F.round(F.col("rrf") + V.boost(F.col("title")), 9))
    return rank_top(scored.select("chunk_id", "doc_id", "title", "dense_rank", "lexical_rank", "score"), top_k, F.desc("score"), F.asc_nulls_last("chunk_id"))


def search_or_fallback(chunks: DataFrame, query: str, top_k: int = 8, allowed: DataFrame | None = None) -> DataFrame:
    """Lexical hits with all terms; trigram hits where there are none. One plan: the fallback is dropped by an anti-join."""
    first = lexical_search(chunks, query, top_k, match="all", allowed=allowed).withColumn("search_type", F.lit("lexical"))
    second = trigram_search(chunks, query, top_k, allowed=allowed).withColumn("search_type", F.lit("trigram"))
    has = first.select(F.lit(1).alias("one")).limit(1)
    return first.unionByName(second.withColumn("one", F.lit(1)).join(has, "one", "left_anti").drop("one"))


def merge_variants(hits: list[DataFrame], top_k: int) -> DataFrame:
    """Hits of several wordings of a query as one list: the best score of each chunk, ranked again."""
    all_hits = hits[0]
    for h in hits[1:]:
        all_hits = all_hits.unionByName(h)
    best = all_hits.groupBy("chunk_id").agg(F.max("score").alias("score"), F.min("doc_id").alias("doc_id"))
    return rank_top(best, top_k, F.desc("score"), F.asc_nulls_last("chunk_id"))


def batch_dense(queries: DataFrame, embeddings: DataFrame, top_k: int, block: int = 4096) -> DataFrame:
    """For each of a stated set of queries(query_id, q) the top_k vectors(chunk_id, embedding): query_id, chunk_id, score, rank.

    The queries go to all tasks in blocks of bounded size, each one pass over the vectors. A task scores its rows by
    matrix products and passes on what may be among the top_k of a query, ties included; only that is shuffled.
    Scores are rounded to nine digits. Vectors of another length than a query, of nulls or NaN are left out for it,
    null ids too; repeated rows count once.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where("chunk_id is not null and embedding is not null").select(F.col("chunk_id").cast("string").alias("chunk_id"), "embedding")
    found, held = None, []

    def scan(part: list[tuple[str, list[float]]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_dim: dict[int, tuple[list[str], np.ndarray]] = {}
            for dim in {len(q) for _, q in shared.value}:
                mine = [(k, q) for k, q in shared.value if len(q) == dim]
                m = np.array([q for _, q in mine], np.float64)
                by_dim[dim] = [k for k, _ in mine], m / (np.sqrt((m * m).sum(1, keepdims=True)) + 1e-8)
            for b in batches:
                n = np.array([len(v) if v is not None else -1 for v in b.column(1)])
                for dim, (names, m) in by_dim.items():
                    at = np.flatnonzero(n == dim)
                    x = np.array([[np.nan if y is None else y for y in v] for v in b.column(1).take(pa.array(at)).to_pylist()], np.float64).reshape(-1, dim)
                    fine = np.isfinite(x).all(1)
                    at, x = at[fine], x[fine]
                    if not len(at):
                        continue
                    s = np.round(m @ (x / (np.sqrt((x * x).sum(1, keepdims=True)) + 1e-8)).T, 9)
                    cut = np.partition(s, -top_k, axis=1)[:, -top_k] if len(at) > top_k else np.full(len(names), -np.inf)
                    i, j = np.nonzero(s >= cut[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in i], pa.string()), b.column(0).take(pa.array(at[j])), pa.array(s[i, j])], names=["query_id", "chunk_id", "score"])

        return rows.mapInArrow(run, "query_id string, chunk_id string, score double")

    stated = queries.select(F.col("query_id").cast("string"), "q").distinct().orderBy("query_id")
    for q in stated.toLocalIterator():
        held.append((q[0], [float(v) for v in q[1]]))
        if len(held) == block:
            found = scan(held) if found is None else found.unionByName(scan(held))
            held = []
    if held or found is None:
        found = scan(held) if found is None else found.unionByName(scan(held))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("chunk_id"))
    return found.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_k)


def cap_per_document(hits: DataFrame, most: int, *by: str) -> DataFrame:
    """The first `most` hits of each document, and of each query if `by` names its column, by rank."""
    w = Window.partitionBy(*by, "doc_id").orderBy("rank")
    return hits.withColumn("in_doc", F.row_number().over(w)).where(F.col("in_doc") <= most).drop("in_doc")


def pack(hits: DataFrame, budget: Column, *by: str, text: str = "text_md") -> DataFrame:
    """The hits, in rank order, that fit the budget of characters; those from the first that doesn't fit are left out. Adds used."""
    w = Window.partitionBy(*by).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length(F.coalesce(text, F.lit("")))
    return hits.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


def context(hits: DataFrame, max_chars: int, text: str = "text_md") -> DataFrame:
    """One row, context: the hits(rank, score, title, url, text) with a header each, within max_chars.

    The first hit that doesn't fit is cut outside of fenced code and marked as truncated, if enough of it is left.
    A result of top-k size; the string is built on one executor.
    """
    head = F.concat(
        F.format_string("\n\n--- Chunk %d (score: %.3f) ---\n", F.col("rank"), F.col("score")),
        F.when(F.length("title") > 0, F.concat(F.lit("Title: "), F.col("title"), F.lit("\n"))).otherwise(""),
        F.when(F.length("url") > 0, F.concat(F.lit("URL: "), F.col("url"), F.lit("\n"))).otherwise(""), F.lit("\n"),
    )
    w = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    body = F.coalesce(F.col(text), F.lit(""))
    sized = hits.select("rank", head.alias("head"), body.alias("body")).withColumn("size", F.length("head") + F.length("body"))
    placed = sized.withColumn("before", F.coalesce(F.sum("size").over(w), F.lit(0)))
    left = F.lit(max_chars) - F.col("before") - F.length("head")
    closed = F.substring("body", F.lit(1), F.greatest(left - 1, F.lit(0)).cast("int"))
    fences = F.regexp_count(closed, F.lit("```"))
    outside = F.when(fences % 2 == 1, F.regexp_extract(closed, r"(?s)^(.*)```", 1)).otherwise(closed)
    part = F.when(F.col("before") + F.col("size") <= max_chars, F.concat("head", "body")).when(
        (left > 50) & (F.col("before") <= max_chars) & (F.length(F.trim(outside)) > 20), F.concat("head", outside, F.lit("\n[... truncated]"))
    )
    first_over = F.when(F.col("before") + F.col("size") > max_chars, F.col("rank"))
    cut = placed.withColumn("part", part).withColumn("stop", F.min(first_over).over(Window.partitionBy()))
    kept = cut.where(F.col("stop").isNull() | (F.col("rank") <= F.col("stop")))
    return kept.agg(F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "part"))), lambda x: F.coalesce(x["part"], F.lit(""))), ""), F.lit("")).alias("context"))


def hit_quality(hits: DataFrame, *by: str) -> DataFrame:
    """For each group of hits(chunk_id, doc_id, score[, title, url]): hits, unique_docs, entropy, tie_rate, duplication_rate,
    missing_title, missing_url, complete_hits. Tables of hits are bounded by the queries; groups by their top-k."""
    blank = lambda c: F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) == 0
    w = Window.partitionBy(*by)
    rows = hits.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("per_doc", F.count(F.lit(1)).over(Window.partitionBy(*by, "doc_id"))).withColumn("tied", (F.count(F.lit(1)).over(Window.partitionBy(*by, "score")) > 1) & (F.col("n") > 1))
    entropy = F.abs(F.sum(-F.log2(F.col("per_doc") / F.col("n")) / F.col("n")))  # each hit carries its document's share
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct("doc_id").alias("unique_docs"), F.round(entropy, 6).alias("entropy"), F.round(F.avg(F.col("tied").cast("int")), 6).alias("tie_rate"),
        F.round(1 - F.countDistinct("chunk_id", "doc_id") / F.count(F.lit(1)), 6).alias("duplication_rate"), F.count_if(blank("title")).alias("missing_title"), F.count_if(blank("url")).alias("missing_url"), F.count_if(~blank("title") & ~blank("url")).alias("complete_hits"),
    )


def query_health(quality: DataFrame, min_docs: int = 3, max_ties: float = 0.35) -> DataFrame:
    """Adds passed and reasons to hit_quality()."""
    reasons = F.array_compact(F.array(F.when(F.col("unique_docs") < min_docs, "unique_docs"), F.when(F.col("tie_rate") > max_ties, "tie_rate"), F.when(F.col("missing_title") > 0, "missing_title"), F.when(F.col("missing_url") > 0, "missing_url")))
    return quality.withColumn("reasons", F.array_join(reasons, ",")).withColumn("passed", F.size(reasons) == 0)


def expectations(items: DataFrame, anchors: dict[str, list[str]], groups: dict[str, list[str]], required: dict[str, list[str]], threshold: float = 0.7, n_of_m: bool = False) -> DataFrame:
    """For each query of items(query_id, url, title, snippet): anchors_score, concepts_score, score, passed.

    An anchor is met if the slug of some item is among those stated (both canonical); a concept group if one of its
    terms, or its stem, stands in a title or snippet. 0.6 of the score is the anchor's, 0.4 the concepts': the share
    of groups met or, with n_of_m, whether max(2, half) are. Queries without required groups have all concepts.
    The expectations are configuration and become literals.
    """
    slug = T.doc_slug(F.col("url"), F.col("title"))
    words = T.canon(F.concat_ws(" ", "title", "snippet"))
    names = sorted({g for gs in required.values() for g in gs if g in groups})
    has = {}
    for g in names:
        hit = F.lit(False)
        for term in groups[g]:
            hit = hit | T.contains_term(words, T.canon(F.lit(term)))
        has[g] = hit
    anchored = F.lit(False)
    for q, slugs in anchors.items():
        for s in slugs:
            anchored = anchored | ((F.col("query_id") == q) & (slug == T.canon(F.lit(s))))
    per = items.groupBy("query_id").agg(F.bool_or(anchored).alias("anchor"), *[F.bool_or(h).alias(f"g_{g}") for g, h in has.items()])
    concept = F.lit(1.0)
    for q, gs in required.items():
        if gs:
            met = sum((F.col(f"g_{g}").cast("int") if g in has else F.lit(0) for g in gs), F.lit(0))
            concept = F.when(F.col("query_id") == q, F.when(met >= max(2, len(gs) // 2), 1.0).otherwise(0.0) if n_of_m else met / float(len(gs))).otherwise(concept)
    scored = per.select("query_id", F.when(F.col("anchor"), 1.0).otherwise(0.0).alias("anchors_score"), concept.alias("concepts_score"))
    total = F.round(0.6 * F.col("anchors_score") + 0.4 * F.col("concepts_score"), 9)
    return scored.withColumn("score", total).withColumn("passed", F.col("score") >= threshold)
