"""Queries on aggregates, quantiles, coverage and event logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumine.operators import statistics as S
from vellumine.plans.registry import query
from vellumine.plans.text_queries import ENRICHED, enriched


@query("quality_distribution", f"with {ENRICHED}, s as (select list_sort(list(quality_score)) as x, count(*) as n, avg(case when quality_score < 0.6 then 1.0 else 0 end) as below from e) select cast(x[1 + least(n - 1, floor(0.5 * n))::int] as double) as p50, cast(x[1 + least(n - 1, floor(0.9 * n))::int] as double) as p90, round(below, 6) as below_share, n from s")
def quality_distribution(t):
    """Index quantiles from a histogram of the scores, of which there are a thousand at most."""
    h = S.histogram(enriched(t), F.col("quality_score"))
    return h.agg(S.index_quantile(0.5).alias("p50"), S.index_quantile(0.9).alias("p90"), F.round(F.sum(F.when(F.col("v") < 0.6, F.col("n")).otherwise(0)) / F.max("total"), 6).alias("below_share"), F.max("total").alias("n"))


def _describe_sql(source: str, i: int, k: int, least: int) -> str:
    j = f"least(greatest(((n + 1) * {i}) // {k}, 1), n - 1)"
    d = f"((n + 1) * {i} - {j} * {k})"
    return f"s as ({source}), g as (select list_sort(list(v)) as x, count(*) as n, avg(v) as mean from s where v is not null) select n, x[1] as min, (x[(n - 1) // 2 + 1] + x[n // 2 + 1]) / 2.0 as median, cast(case when n >= {least} then (x[{j}] * ({k} - {d}) + x[{j} + 1] * {d}) / {k}.0 else x[n] end as double) as upper, x[n] as max, round(mean, 6) as mean from g"


def _described(rows, value, cut, least):
    d = S.describe(rows, value, cut, least)
    return d.select("n", "min", "median", F.col("upper").cast("double").alias("upper"), "max", F.round("mean", 6).alias("mean"))


@query("preflight_quality", f"with {ENRICHED}, " + _describe_sql("select cast(quality_score as double) as v from e", 9, 10, 10))
def preflight_quality(t):
    return _described(enriched(t), F.col("quality_score"), (9, 10), 10)


@query("chunk_token_stats", "with " + _describe_sql("select token_count as v from (select distinct chunk_id, token_count from chunks)", 19, 20, 21))
def chunk_token_stats(t):
    return _described(t("chunks").select("chunk_id", "token_count").distinct(), F.col("token_count"), (19, 20), 21)


@query("chunk_char_stats", "with " + _describe_sql("select length(text_md) as v from (select distinct chunk_id, text_md from chunks)", 19, 20, 21))
def chunk_char_stats(t):
    return _described(t("chunks").select("chunk_id", "text_md").distinct(), F.length("text_md"), (19, 20), 21)


STRATEGIES = ["no-split", "heading", "paragraph", "sentence", "token-window", "table-rows", "code-fence-lines", "force-truncate", "digest"]
_LIST = ", ".join(f"'{s}'" for s in STRATEGIES)


@query("split_strategies", f"with c as (select distinct chunk_id, split_strategy from chunks), n as (select split_strategy, count(*) as n from c group by split_strategy) select strategy, coalesce(n, 0) as chunks from (select unnest([{_LIST}]) as strategy) left join n on strategy = split_strategy")
def split_strategies(t):
    c = t("chunks").select("chunk_id", F.col("split_strategy").alias("strategy")).distinct().groupBy("strategy").agg(F.count(F.lit(1)).alias("chunks"))
    return S.with_zeros(c, "strategy", STRATEGIES, "chunks")


@query("small_chunk_reasons", "with c as (select distinct chunk_id, doc_id, ord, coalesce(text_md, '') as x from chunks), m as (select *, max(ord) over (partition by doc_id) as last, sum(length(x)) over (partition by doc_id) as total from c), r as (select chunk_id, case when ord = last then 'tail_small' when total < 50 then 'tiny_doc' when contains(x, '```') then 'fence' when contains(x, '|') then 'table' else 'unknown' end as reason from m where length(x) // 4 < 80) select reason, count(*) as chunks, min(chunk_id) as example from r group by reason")
def small_chunk_reasons(t):
    c = t("chunks").select("chunk_id", "doc_id", "ord", F.coalesce("text_md", F.lit("")).alias("x")).distinct()
    per = c.groupBy("doc_id").agg(F.max("ord").alias("last"), F.sum(F.length("x")).alias("total"))  # no window: a page may hold a third of all rows
    m = c.alias("c").join(per.alias("p"), F.col("c.doc_id").eqNullSafe(F.col("p.doc_id"))).where(F.floor(F.length("x") / 4) < 80)
    reason = F.when(F.col("ord") == F.col("last"), "tail_small").when(F.col("total") < 50, "tiny_doc").when(F.col("x").contains("```"), "fence").when(F.col("x").contains("|"), "table").otherwise("unknown")
    return m.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("chunks"), F.min("chunk_id").alias("example"))


_COV = """with sp as (select distinct doc_id, char_start as s, char_end as e from chunks where trim(doc_id) <> '' and char_start is not null and char_end is not null and char_start < char_end), ln as (select doc_id, max(char_end) as length from chunks where trim(doc_id) <> '' group by doc_id having max(char_end) is not null),
b as (select sp.*, length, coalesce(max(e) over (partition by sp.doc_id order by s, e rows between unbounded preceding and 1 preceding), 0) as before from sp join ln using (doc_id)),
g as (select doc_id, sum(greatest(0, e - greatest(s, before))) as covered, count(*) filter (s > before) as inner_gaps, max(e) as last from b group by doc_id),
cv as (select doc_id, length, coalesce(covered, 0) as covered, case when last is null then case when length > 0 then 1 else 0 end else inner_gaps + case when last < length then 1 else 0 end end as gaps from ln left join g using (doc_id))"""


def covered(t):
    c = t("chunks").where("trim(doc_id) <> ''")
    lengths = c.groupBy("doc_id").agg(F.max("char_end").alias("length")).where("length is not null")
    return S.coverage(c.select("doc_id", F.col("char_start").alias("start"), F.col("char_end").alias("end")), lengths, "doc_id")


@query("chunk_coverage", _COV + " select doc_id, length, cast(covered as bigint) as covered, cast(gaps as bigint) as gaps from cv")
def chunk_coverage(t):
    return covered(t)


@query("coverage_stats", _COV + " select count(*) as documents, round(avg(covered / length), 6) as mean, round(min(covered / length), 6) as least, count(*) filter (gaps > 0) as with_gaps, count(*) filter (covered >= 0.995 * length) as good from cv where length > 0")
def coverage_stats(t):
    share = F.col("covered") / F.col("length")
    return covered(t).where("length > 0").agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg(share), 6).alias("mean"), F.round(F.min(share), 6).alias("least"), F.count_if(F.col("gaps") > 0).alias("with_gaps"), F.count_if(F.col("covered") >= 0.995 * F.col("length")).alias("good"))


@query("traceability_counts", "with k as (select distinct doc_id, version, title, url, source_system from kb_documents) select count(*) as rows, count(*) filter (coalesce(trim(title), '') = '') as missing_title, count(*) filter (coalesce(trim(url), '') = '') as missing_url, count(*) filter (coalesce(trim(source_system), '') = '') as missing_source, count(*) filter (coalesce(trim(source_system), '') = '' or (coalesce(trim(title), '') = '' and coalesce(trim(url), '') = '')) as untraceable from k")
def traceability_counts(t):
    k = t("kb_documents").select("doc_id", "version", "title", "url", "source_system").distinct()
    blank = lambda c: F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) == 0
    return k.agg(F.count(F.lit(1)).alias("rows"), F.count_if(blank("title")).alias("missing_title"), F.count_if(blank("url")).alias("missing_url"), F.count_if(blank("source_system")).alias("missing_source"), F.count_if(blank("source_system") | (blank("title") & blank("url"))).alias("untraceable"))


@query("space_stats", "with k as (select distinct doc_id, version, space_key from kb_documents), d as (select distinct doc_id, text, space_key from documents) select coalesce(space_key, '__unknown__') as space, count(*) as documents, cast(sum(length(coalesce(text, ''))) as bigint) as characters, count(*) filter (coalesce(text, '') = '') as empty, round(avg(length(coalesce(text, ''))), 6) as mean_characters from d group by 1")
def space_stats(t):
    n = F.length(F.coalesce("text", F.lit("")))
    return t("documents").select("doc_id", "text", "space_key").distinct().groupBy(F.coalesce("space_key", F.lit("__unknown__")).alias("space")).agg(F.count(F.lit(1)).alias("documents"), F.sum(n).alias("characters"), F.count_if(n == 0).alias("empty"), F.round(F.avg(n), 6).alias("mean_characters"))


@query("normalize_metrics", "select count(*) as pages, count(*) filter (coalesce(text, '') = '') as empty, cast(sum(length(coalesce(text, ''))) // count(*) as bigint) as mean_chars, count(*) filter (length(text) > 3000) as large from (select distinct doc_id, text from documents)")
def normalize_metrics(t):
    n = F.length(F.coalesce("text", F.lit("")))
    return t("documents").select("doc_id", "text").distinct().agg(F.count(F.lit(1)).alias("pages"), F.count_if(n == 0).alias("empty"), F.floor(F.sum(n) / F.count(F.lit(1))).alias("mean_chars"), F.count_if(n > 3000).alias("large"))


@query("largest_pages", "select doc_id, length(text) as chars from (select distinct doc_id, text from documents where text is not null) order by chars desc, doc_id limit 10")
def largest_pages(t):
    return t("documents").where("text is not null").select("doc_id", F.length("text").alias("chars")).distinct().orderBy(F.desc("chars"), "doc_id").limit(10)


@query("provider_dim_counts", "select provider, dim, count(*) as vectors, count(distinct chunk_id) as chunks, max(created_at) as newest, count(*) filter (embedding is null or len(embedding) <> dim) as bad from (select distinct * from chunk_embeddings) group by provider, dim")
def provider_dim_counts(t):
    bad = F.col("embedding").isNull() | (F.size("embedding") != F.col("dim"))
    return t("chunk_embeddings").distinct().groupBy("provider", "dim").agg(F.count(F.lit(1)).alias("vectors"), F.countDistinct("chunk_id").alias("chunks"), F.max("created_at").alias("newest"), F.count_if(bad).alias("bad"))


@query("dimension_guard", "select provider, count(distinct len(embedding)) as lengths, min(len(embedding)) as least, max(len(embedding)) as most from chunk_embeddings where embedding is not null group by provider")
def dimension_guard(t):
    n = F.size("embedding")
    return t("chunk_embeddings").where("embedding is not null").groupBy("provider").agg(F.countDistinct(n).alias("lengths"), F.min(n).alias("least"), F.max(n).alias("most"))


@query("chunk_assurance", "with c as (select distinct chunk_id, doc_id, token_count from chunks), k as (select distinct doc_id from kb_documents), m as (select avg(token_count) as a from c) select count(*) as chunks, count(distinct doc_id) as documents, count(*) filter (doc_id is null or doc_id not in (select doc_id from k)) as orphans, count(*) filter (token_count > 10 * a) as outliers, round(count(*) / count(distinct doc_id), 6) as per_document from c, m")
def chunk_assurance(t):
    c = t("chunks").select("chunk_id", "doc_id", "token_count").distinct()
    k = t("kb_documents").select("doc_id").distinct().withColumn("there", F.lit(1))
    mean = c.agg(F.avg("token_count").alias("a"))
    j = c.join(k, "doc_id", "left").crossJoin(F.broadcast(mean))  # one row
    return j.agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct("doc_id").alias("documents"), F.count_if(F.col("there").isNull()).alias("orphans"), F.count_if(F.col("token_count") > 10 * F.col("a")).alias("outliers"), F.round(F.count(F.lit(1)) / F.countDistinct("doc_id"), 6).alias("per_document"))


@query("top_labels", "with k as (select distinct doc_id, version, meta from kb_documents where meta is not null), l as (select doc_id, version, unnest(from_json(json_extract(meta, '$.labels'), '[\"VARCHAR\"]')) as label from k) select label, count(*) as n from l group by label order by n desc, label limit 10")
def top_labels(t):
    k = t("kb_documents").where("meta is not null").select("doc_id", "version", "meta").distinct()
    return S.top(k.select(F.explode(F.from_json("meta", "labels array<string>")["labels"]).alias("label")), "label", 10)


@query("meta_fields", "select distinct chunk_id, json_extract_string(meta, '$.lang') as lang, json_extract_string(meta, '$.run') as run from chunks")
def meta_fields(t):
    m = F.try_parse_json("meta")
    return t("chunks").select("chunk_id", F.try_variant_get(m, "$.lang", "string").alias("lang"), F.try_variant_get(m, "$.run", "string").alias("run")).distinct()


@query("status_counts", "select o_orderstatus as status, count(*) as n, min(o_orderdate) as first, max(o_orderdate) as last from orders group by 1")
def status_counts(t):
    return t("orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


@query("event_summary", "select event_type, count(*) as events, count(distinct user_id) as users, round(sum(value), 4) as total, cast(max(cast(json_extract(props, '$.k') as int)) as int) as most_k from events group by event_type")
def event_summary(t):
    return t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"), F.max(F.get_json_object("props", "$.k").cast("int")).alias("most_k"))


@query("slowest_users", "select user_id, round(sum(value) / count(*), 6) as rate, count(*) as events from events group by user_id order by rate desc, user_id limit 5")
def slowest_users(t):
    return t("events").groupBy("user_id").agg(F.round(F.sum("value") / F.count(F.lit(1)), 6).alias("rate"), F.count(F.lit(1)).alias("events")).orderBy(F.desc("rate"), "user_id").limit(5)


@query("event_errors", "select event_type, strftime(ts, '%Y-%m-%d') as day, count(*) as errors, max(value) as worst from events where event_type = 'error' group by all")
def event_errors(t):
    return t("events").where("event_type = 'error'").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("errors"), F.max("value").alias("worst"))


@query("run_eta", "with r as (select user_id, count(*) as done, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 as secs from events group by user_id) select user_id, done, round(done / secs, 6) as rate, printf('%02d:%02d:%02d', (1000 * secs // done) // 3600, ((1000 * secs // done) % 3600) // 60, (1000 * secs // done) % 60) as eta from r where secs > 0")
def run_eta(t):
    """Time that a thousand more events of each user would take, at the rate so far."""
    r = t("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("done"), F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("secs")).where("secs > 0")
    left = F.floor(1000 * F.col("secs") / F.col("done"))
    return r.select("user_id", "done", F.round(F.col("done") / F.col("secs"), 6).alias("rate"), F.format_string("%02d:%02d:%02d", F.floor(left / 3600), F.floor(left % 3600 / 60), left % 60).alias("eta"))


@query("log_retention", "select count(*) filter (ts >= m - interval 7 day) as kept, count(*) filter (ts < m - interval 7 day) as expired from events, (select max(ts) as m from events)")
def log_retention(t):
    e = t("events")
    return e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("m")))).agg(F.count_if(F.col("ts") >= F.col("m") - F.expr("interval 7 days")).alias("kept"), F.count_if(F.col("ts") < F.col("m") - F.expr("interval 7 days")).alias("expired"))


@query("reason_histogram", "with f as (select distinct id, lower(unnest(quality_flags)) as flag from enriched_docs where quality_flags is not null) select split_part(flag, '_', 1) as reason, count(*) as n, min(id) as example from f where flag is not null group by 1")
def reason_histogram(t):
    f = t("enriched_docs").select("id", F.explode("quality_flags").alias("flag")).where("flag is not null").select("id", F.lower("flag").alias("flag")).distinct()
    return f.groupBy(F.split_part("flag", F.lit("_"), F.lit(1)).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("example"))


@query("windowed_events", "select event_type, time_bucket(interval 1 hour, ts) as start, count(*) as n, round(sum(value), 4) as total from events group by all")
def windowed_events(t):
    return t("events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.col("w.start").alias("start"), "n", "total")


@query("space_rollup", "select space_key, source, count(*) as n from (select distinct doc_id, space_key, lower(source) as source from documents) group by rollup(space_key, source)")
def space_rollup(t):
    return t("documents").select("doc_id", "space_key", F.lower("source").alias("source")).distinct().rollup("space_key", "source").agg(F.count(F.lit(1)).alias("n"))
