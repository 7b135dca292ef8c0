"""Queries on retrieval, packing and its quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumine.functions import text as T
from vellumine.operators import retrieval as R
from vellumine.plans.registry import query

QUERY = "archive page before the retention table"
TERMS = ["archive", "page", "before", "the", "retention", "table"]
PROVIDER, DIM = "dummy", 64
# The vector that asks: that of the smallest chunk of the provider.
_VEC = "v as (select distinct chunk_id, cast(embedding as double[]) as e from chunk_embeddings where provider = 'dummy' and dim = 64 and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x))) = 0),"
_QV = "qv as (select e from v where chunk_id like '2%' and list_inner_product(e, e) > 0 order by chunk_id limit 1),"
_COS = "round(list_inner_product(v.e, qv.e) / ((sqrt(list_inner_product(v.e, v.e)) + 1e-8) * (sqrt(list_inner_product(qv.e, qv.e)) + 1e-8)), 9)"
DENSE = f"{_VEC} {_QV} c as (select distinct chunk_id, doc_id from chunks), ds as (select distinct v.chunk_id, c.doc_id, {_COS} as score from v join c using (chunk_id), qv),"
_TF = ", ".join(f"len(list_filter(w, lambda x: x = '{x}')) as tf{i}" for i, x in enumerate(TERMS))
_DF = ", ".join(f"count(*) filter (tf{i} > 0) as df{i}" for i in range(len(TERMS)))
_BM = " + ".join(f"ln(1 + (cnt - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * n / mean))" for i in range(len(TERMS)))
LEX = rf"""tw as (select distinct chunk_id, doc_id, len(w) as n, {_TF} from (select chunk_id, doc_id, regexp_extract_all(lower(coalesce(text_md, '')), '[\p{{L}}\p{{N}}]+') as w from chunks) where len(w) > 0),
st as (select count(*) as cnt, avg(n) as mean, {_DF} from tw), ls as (select chunk_id, doc_id, round({_BM}, 9) as score from tw, st where @),"""
ANY = " or ".join(f"tf{i} > 0" for i in range(len(TERMS)))
ALL = " and ".join(f"tf{i} > 0" for i in range(len(TERMS)))


def vector(t):
    """One row, q: the vector that asks. A lookup of one row that the driver makes a literal."""
    e = t("chunk_embeddings").where(f"provider = '{PROVIDER}' and dim = {DIM} and size(embedding) = {DIM} and chunk_id like '2%'")
    e = e.where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)) & F.exists("embedding", lambda x: x != 0))
    return [float(x) for x in e.orderBy("chunk_id").select("embedding").first()[0]]


def dense(t, k):
    return R.dense_search(t("chunks"), t("chunk_embeddings"), vector(t), PROVIDER, DIM, k)


@query("dense_topk_cosine", f"with {DENSE} r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ds) select * from r where rank <= 20")
def dense_topk_cosine(t):
    return dense(t, 20)


@query("lexical_topk_bm25", "with " + LEX.replace("@", ANY) + " r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ls) select * from r where rank <= 50")
def lexical_topk_bm25(t):
    return R.lexical_search(t("chunks"), QUERY, 50)


@query("lexical_topk_and", "with " + LEX.replace("@", ALL) + " r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ls) select * from r where rank <= 50")
def lexical_topk_and(t):
    return R.lexical_search(t("chunks"), QUERY, 50, match="all")


_TRI = r"list_distinct(flatten(list_transform(regexp_extract_all(lower(coalesce(@, '')), '[\p{L}\p{N}]+'), lambda w: list_transform(range(1, length(w) + 2), lambda i: ('  ' || w || ' ')[i:i+2]))))"


@query("trigram_fallback", f"with x as (select distinct chunk_id, doc_id, {_TRI.replace('@', 'text_md')} as a, {_TRI.replace('@', chr(39) + QUERY + chr(39))} as b from chunks), s as (select chunk_id, doc_id, round(len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))), 9) as score from x), r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from s where score > 0.1) select * from r where rank <= 20")
def trigram_fallback(t):
    return R.trigram_search(t("chunks"), QUERY, 20)


HYBRID = f"""with {DENSE} {LEX.replace('@', ANY)} dr as (select * from (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ds) where rank <= 200),
lr as (select * from (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ls) where rank <= 200),
kt as (select doc_id, max_by(title, (version, loaded_at)) as title, max_by(url, (version, loaded_at)) as url from (select * replace (coalesce(title, '') as title, coalesce(url, '') as url) from kb_documents) group by doc_id),
fu as (select coalesce(dr.chunk_id, lr.chunk_id) as chunk_id, coalesce(dr.doc_id, lr.doc_id) as doc_id, dr.rank as dense_rank, lr.rank as lexical_rank, round(coalesce(1.0 / (60 + dr.rank), 0) + coalesce(1.0 / (60 + lr.rank), 0), 9) as rrf from dr full outer join lr on dr.chunk_id = lr.chunk_id),
sc as (select chunk_id, doc_id, nullif(title, '') as title, nullif(url, '') as url, dense_rank, lexical_rank, round(rrf + case when contains(lower(coalesce(title, '')), 'methodology') then 0.2 when contains(lower(coalesce(title, '')), 'playbook') then 0.15 when contains(lower(coalesce(title, '')), 'runbook') then 0.1 else 0 end - case when regexp_matches(lower(coalesce(title, '')), '\\b(january|february|march|april|may|june|july|august|september|october|november|december)\\b|\\b20\\d\\d\\b') then 0.1 else 0 end, 9) as score from fu left join kt using (doc_id)),
hy as (select * from (select *, row_number() over (order by score desc, chunk_id) as rank from sc) where rank <= @k)"""


def titles(t):
    return R.latest(t("kb_documents").select("doc_id", "title", "url", "version", "loaded_at"), "doc_id", "version", "loaded_at").select("doc_id", "title", "url")


def hybrid(t, k):
    return R.hybrid_search(t("chunks"), t("chunk_embeddings"), titles(t), QUERY, vector(t), PROVIDER, DIM, k)


@query("hybrid_rrf_boosted", HYBRID.replace("@k", "12") + " select chunk_id, doc_id, title, dense_rank, lexical_rank, score, rank from hy")
def hybrid_rrf_boosted(t):
    return hybrid(t, 12)


def hits(t, k=40):
    """Hybrid hits with the fields that packing and its checks read."""
    texts = t("chunks").select("chunk_id", "text_md").distinct()
    urls = titles(t).select("doc_id", "url")
    h = hybrid(t, k)
    return h.join(texts, "chunk_id").join(urls, "doc_id", "left")


HITS = HYBRID.replace("@k", "40") + ", tx as (select distinct chunk_id, text_md from chunks), hi as (select hy.*, text_md from hy join tx using (chunk_id))"


@query("cap_per_doc", HITS + " select chunk_id, doc_id, rank from (select *, row_number() over (partition by doc_id order by rank) as n from hi) where n <= 2")
def cap_per_doc(t):
    return R.cap_per_document(hits(t), 2).select("chunk_id", "doc_id", "rank")


@query("pack_budget_prefix", HITS + ", b as (select unnest([1500, 4000, 6000]) as budget), u as (select budget, chunk_id, rank, sum(length(coalesce(text_md, ''))) over (partition by budget order by rank) as used from hi, b) select budget, chunk_id, rank, cast(used as bigint) as used from u where used <= budget")
def pack_budget_prefix(t):
    """The stated budgets against the hits of one query: a small bounded product."""
    h = hits(t).select("chunk_id", "rank", "text_md", F.explode(F.array(*[F.lit(b) for b in (1500, 4000, 6000)])).alias("budget"))
    return R.pack(h, F.col("budget"), "budget").select("budget", "chunk_id", "rank", "used")


@query("context_summary", HITS + " select count(*) as hits, count(distinct doc_id) as documents, cast(sum(length(coalesce(text_md, ''))) as bigint) as characters, min(score) as least, max(score) as most, round(avg(score), 9) as mean from hi")
def context_summary(t):
    return hits(t).agg(F.count(F.lit(1)).alias("hits"), F.countDistinct("doc_id").alias("documents"), F.sum(F.length(T.text_of(F.col("text_md")))).alias("characters"), F.min("score").alias("least"), F.max("score").alias("most"), F.round(F.avg("score"), 9).alias("mean"))


_HEAD = "chr(10) || chr(10) || '--- Chunk ' || rank || ' (score: ' || printf('%.3f', score) || ') ---' || chr(10) || case when length(title) > 0 then 'Title: ' || title || chr(10) else '' end || case when length(url) > 0 then 'URL: ' || url || chr(10) else '' end || chr(10)"
_PACKED = f"""{HITS}, hd as (select rank, {_HEAD} as head, coalesce(text_md, '') as body from (select hi.*, nullif(kt.url, '') as url from hi left join kt using (doc_id))), bf as (select *, length(head) + length(body) as size, coalesce(sum(length(head) + length(body)) over (order by rank rows between unbounded preceding and 1 preceding), 0) as before from hd),
ct as (select *, case when before + size <= 6000 then head || body when 6000 - before - length(head) > 50 and before <= 6000 and length(trim(outside)) > 20 then head || outside || chr(10) || '[... truncated]' else '' end as part, min(case when before + size > 6000 then rank end) over () as stop
  from (select *, case when len(regexp_extract_all(closed, '```')) % 2 = 1 then regexp_extract(closed, '(?s)^(.*)```', 1) else closed end as outside from (select *, body[1:greatest(6000 - before - length(head) - 1, 0)] as closed from bf)))"""


@query("packed_context", _PACKED + " select coalesce(string_agg(part, '' order by rank), '') as context from ct where stop is null or rank <= stop")
def packed_context(t):
    return R.context(hits(t), 6000)


@query("fetch_candidates", "with c as (select distinct chunk_id, doc_id, ord from chunks), e as (select distinct chunk_id, provider, dim from chunk_embeddings where provider = 'lumen-small' and dim = 96) select chunk_id, doc_id, ord, dim from c join e using (chunk_id) order by doc_id, ord, chunk_id limit 100")
def fetch_candidates(t):
    e = t("chunk_embeddings").where("provider = 'lumen-small' and dim = 96").select("chunk_id", "dim").distinct()
    return t("chunks").select("chunk_id", "doc_id", "ord").distinct().join(e, "chunk_id").orderBy(F.asc_nulls_last("doc_id"), F.asc_nulls_last("ord"), "chunk_id").limit(100).select("chunk_id", "doc_id", "ord", "dim")


_LOST = ["zzqq", "retention", "tabel"]


@query("search_with_fallback", f"with x as (select distinct chunk_id, doc_id, {_TRI.replace('@', 'text_md')} as a, {_TRI.replace('@', chr(39) + ' '.join(_LOST) + chr(39))} as b, list_has_all(regexp_extract_all(lower(coalesce(text_md, '')), '[\\p{{L}}\\p{{N}}]+'), {_LOST}) as hit from chunks), s as (select chunk_id, doc_id, round(len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))), 9) as score from x where not exists (select 1 from x y where y.hit)), r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from s where score > 0.1) select chunk_id, doc_id, score, rank, 'trigram' as search_type from r where rank <= 8")
def search_with_fallback(t):
    return R.search_or_fallback(t("chunks"), "zzqq retention tabel", 8)


# The vectors of pages whose id is divisible by 100 ask.
_QS = "q as (select chunk_id as query_id, e from v where try_cast(split_part(chunk_id, ':', 1) as bigint) % 100 = 0 and list_inner_product(e, e) > 0),"
BATCH = f"with {_VEC} {_QS} bs as (select distinct query_id, v.chunk_id, round(list_inner_product(v.e, q.e) / ((sqrt(list_inner_product(v.e, v.e)) + 1e-8) * (sqrt(list_inner_product(q.e, q.e)) + 1e-8)), 9) as score from v, q), br as (select * from (select *, row_number() over (partition by query_id order by score desc, chunk_id) as rank from bs) where rank <= 8)"


def stored(t):
    return t("chunk_embeddings").where(f"provider = '{PROVIDER}' and dim = {DIM} and size(embedding) = {DIM}").where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))).select("chunk_id", "embedding").distinct()


def asking(t):
    """query_id, q: the vectors of pages whose id is divisible by 100."""
    return stored(t).where("try_cast(split_part(chunk_id, ':', 1) as bigint) % 100 = 0").where(F.exists("embedding", lambda x: x != 0)).select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("q"))


def batch(t):
    return R.batch_dense(asking(t), stored(t), 8)


@query("batch_retrieval", BATCH + " select * from br")
def batch_retrieval(t):
    """All stated queries in one job, against all vectors."""
    return batch(t)


@query("embeddings_topk", "with e as (select vec_id, label, cast(embedding as double[]) as e from embeddings), s as (select q.vec_id as query_id, x.vec_id, q.label = x.label as same, round(list_inner_product(q.e, x.e) / ((sqrt(list_inner_product(q.e, q.e)) + 1e-8) * (sqrt(list_inner_product(x.e, x.e)) + 1e-8)), 9) as score from e q, e x where q.vec_id % 100 = 0), r as (select *, row_number() over (partition by query_id order by score desc, cast(vec_id as varchar)) as rank from s) select query_id, count(*) as hits, count(*) filter (same) as same_label, max(score) as best from r where rank <= 10 group by query_id")
def embeddings_topk(t):
    """The ten nearest of every hundredth vector, and how many have its label."""
    e = t("embeddings")
    near = R.batch_dense(e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), e.select(F.col("vec_id").alias("chunk_id"), "embedding"), 10)
    ids = near.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("chunk_id").cast("bigint").alias("vec_id"), "score")
    a, b = e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("l1")), e.select("vec_id", F.col("label").alias("l2"))
    return ids.join(a, "query_id").join(b, "vec_id").groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"), F.count_if(F.col("l1") == F.col("l2")).alias("same_label"), F.max("score").alias("best"))


_BH = BATCH + ", ch as (select distinct chunk_id, doc_id from chunks), kt as (select doc_id, max_by(title, (version, loaded_at)) as title, max_by(url, (version, loaded_at)) as url from (select * replace (coalesce(title, '') as title, coalesce(url, '') as url) from kb_documents) group by doc_id), bh as (select br.*, doc_id, title, url from br join ch using (chunk_id) left join kt using (doc_id))"
_QUAL = _BH + """, n as (select *, count(*) over (partition by query_id) as n, count(*) over (partition by query_id, doc_id) as pd, count(*) over (partition by query_id, score) as ties from bh),
hq as (select query_id, count(*) as hits, count(distinct doc_id) as unique_docs, round(abs(sum(-log2(pd / n) / n)), 6) as entropy, round(avg(case when ties > 1 and n > 1 then 1.0 else 0 end), 6) as tie_rate, round(1 - count(distinct chunk_id || '|' || doc_id) / count(*), 6) as duplication_rate,
  count(*) filter (coalesce(trim(title), '') = '') as missing_title, count(*) filter (coalesce(trim(url), '') = '') as missing_url, count(*) filter (coalesce(trim(title), '') <> '' and coalesce(trim(url), '') <> '') as complete_hits from n group by query_id)"""


def batch_hits(t):
    return batch(t).join(t("chunks").select("chunk_id", "doc_id").distinct(), "chunk_id").join(titles(t), "doc_id", "left")


@query("retrieval_quality", _QUAL + " select * from hq")
def retrieval_quality(t):
    return R.hit_quality(batch_hits(t), "query_id")


@query("query_health", _QUAL + ", h as (select *, list_filter([case when unique_docs < 3 then 'unique_docs' end, case when tie_rate > 0.35 then 'tie_rate' end, case when missing_title > 0 then 'missing_title' end, case when missing_url > 0 then 'missing_url' end], lambda x: x is not null) as r from hq) select query_id, hits, unique_docs, array_to_string(r, ',') as reasons, len(r) = 0 as passed from h")
def query_health(t):
    return R.query_health(R.hit_quality(batch_hits(t), "query_id")).select("query_id", "hits", "unique_docs", "reasons", "passed")


@query("retrieval_overview", _QUAL + " select count(*) as queries, round(avg(entropy), 6) as mean_entropy, round(avg(1 - tie_rate), 6) as untied, max(unique_docs) as most_docs from hq")
def retrieval_overview(t):
    q = R.hit_quality(batch_hits(t), "query_id")
    return q.agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("entropy"), 6).alias("mean_entropy"), F.round(F.avg(1 - F.col("tie_rate")), 6).alias("untied"), F.max("unique_docs").alias("most_docs"))


@query("merged_variants", "with " + LEX.replace("@", ALL) + " la as (select chunk_id, doc_id, score from (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ls) where rank <= 30), lo as (select chunk_id, doc_id, score from (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from (select chunk_id, doc_id, round(" + _BM + ", 9) as score from tw, st where " + ANY + ")) where rank <= 30), u as (select * from la union all select * from lo), m as (select chunk_id, max(score) as score, min(doc_id) as doc_id from u group by chunk_id) select * from (select *, row_number() over (order by score desc, chunk_id) as rank from m) where rank <= 20")
def merged_variants(t):
    return R.merge_variants([R.lexical_search(t("chunks"), QUERY, 30, "all"), R.lexical_search(t("chunks"), QUERY, 30, "any")], 20)


ANCHORS = {"q1": ["OPSHUB pages", "1400000003"], "q2": ["no such page"]}
GROUPS = {"hub": ["operations", "hub"], "steps": ["steps", "stepping"], "limits": ["known limits"], "never": ["zzz"]}
REQUIRED = {"q1": ["hub", "steps"], "q2": ["limits", "never", "steps"], "q3": []}


@query("expectation_scores", rf"""with k as (select distinct doc_id, url, coalesce(title, '') as title, case when version % 3 = 0 then 'q1' when version % 3 = 1 then 'q2' else 'q3' end as query_id from kb_documents),
c as (select *, ' ' || trim(regexp_replace(translate(lower(title), '{T.ACCENTED}', '{T.PLAIN}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ') || ' ' as w, trim(regexp_replace(translate(lower(coalesce(nullif(regexp_extract(coalesce(url, ''), '/pages/[0-9]+/([^/?]+)', 1), ''), nullif(regexp_extract(coalesce(url, ''), '/([^/]+?)(?:\.(?:md|txt|rst))?/?$', 1), ''), title)), '{T.ACCENTED}', '{T.PLAIN}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ') as slug from k),
g as (select query_id, bool_or(query_id = 'q1' and slug in ('opshub pages', '1400000003') or query_id = 'q2' and slug = 'no such page') as a, bool_or(contains(w, ' operations ') or contains(w, ' hub ')) as hub, bool_or(contains(w, ' steps ') or contains(w, ' stepping ') or contains(w, ' stepp ')) as steps, bool_or(contains(w, ' known limits ')) as limits from c group by query_id),
s as (select query_id, case when a then 1.0 else 0.0 end as x, case query_id when 'q1' then (hub::int + steps::int) / 2.0 when 'q2' then (limits::int + steps::int) / 3.0 else 1.0 end as y from g)
select query_id, cast(x as double) as anchors_score, cast(y as double) as concepts_score, round(cast(0.6 * x + 0.4 * y as double), 9) as score, round(cast(0.6 * x + 0.4 * y as double), 9) >= 0.7 as passed from s""")
def expectation_scores(t):
    v = F.col("version") % 3
    k = t("kb_documents").select("doc_id", "url", "title", F.when(v == 0, "q1").when(v == 1, "q2").otherwise("q3").alias("query_id")).distinct()
    return R.expectations(k.withColumn("snippet", F.lit("")), ANCHORS, GROUPS, REQUIRED)
