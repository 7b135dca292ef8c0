"""Queries on pages, chunks of documents, graph edges and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumine.functions import hashes as H
from vellumine.functions import markup as M
from vellumine.functions import queries as Q
from vellumine.functions.text import WS
from vellumine.operators import chunking as C
from vellumine.operators import embedding as B
from vellumine.operators import ingest as I
from vellumine.operators import statistics as S
from vellumine.operators.retrieval import latest
from vellumine.plans.registry import query
from vellumine.streaming import events as E


def pages(t):
    """The latest load of each page with labels."""
    k = latest(t("kb_documents").select("doc_id", "space_key", "title", "url", "meta", "version", "loaded_at"), "doc_id", "version", "loaded_at")
    return k.withColumn("labels", F.from_json("meta", "labels array<string>")["labels"])


_PAGES = "k as (select doc_id, max_by({'space_key': space_key, 'meta': meta}, (version, loaded_at)) as x from kb_documents group by doc_id), p as (select doc_id, x.space_key as space_key, x.meta as meta from k)"


@query("graph_edges", f"with {_PAGES}, l as (select distinct from_page_id, target_page_id from link_refs where from_page_id is not null and target_page_id is not null) select 'CONTAINS' as type, 'space:' || space_key as src, doc_id as dst from p where length(space_key) > 0 union select 'LABELED_AS', doc_id, 'label:' || unnest(from_json(json_extract(meta, '$.labels'), '[\"VARCHAR\"]')) from p where meta is not null union select 'LINKS_TO', from_page_id, target_page_id from l")
def graph_edges(t):
    return I.edges(pages(t), t("link_refs"), "doc_id")


@query("edge_counts", f"with {_PAGES}, l as (select distinct from_page_id, target_page_id from link_refs where from_page_id is not null and target_page_id is not null), e as (select 'CONTAINS' as type, 'space:' || space_key as src, doc_id as dst from p where length(space_key) > 0 union select 'LINKS_TO', from_page_id, target_page_id from l) select type, count(*) as edges, count(distinct src) as sources, count(distinct dst) as targets from e group by type")
def edge_counts(t):
    return I.edges(pages(t).drop("labels"), t("link_refs"), "doc_id").groupBy("type").agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("src").alias("sources"), F.countDistinct("dst").alias("targets"))


@query("chunk_documents")
def chunk_documents(t):
    return C.chunk_documents(t("documents").select("doc_id", "text").distinct())


_BODY = "regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^[@\\x1c-\\x1f]+|[@\\x1c-\\x1f]+$', '', 'g')".replace("@", WS)


@query("chunk_documents_check", f"with d as (select distinct cast(doc_id as varchar) as doc_id, cast(length({_BODY}) as int) as length from documents where text is not null) select doc_id, length, true as covered, 0 as bad_chunks from d where length > 0")
def chunk_documents_check(t):
    """Every document with a body: its length, whether its chunks cover 99.5 % of it, and how many of them are blank or beyond the cap."""
    c = chunk_documents(t)
    lengths = t("documents").select(F.col("doc_id").cast("string").alias("doc_id"), C.body_length(F.col("text")).alias("length")).distinct().where("length > 0")
    bad = (F.col("token_count") > 800) | (F.length(F.trim("text_md")) == 0)
    marked = c.select("doc_id", F.col("char_start").alias("start"), F.col("char_end").alias("end"), bad.cast("int").alias("bad")).distinct()
    cover = S.coverage(marked, lengths, "doc_id").select("doc_id", (F.col("covered") >= 0.995 * F.col("length")).alias("covered"))
    counts = marked.groupBy("doc_id").agg(F.sum("bad").cast("int").alias("bad_chunks"))
    return lengths.join(cover, "doc_id").join(counts, "doc_id", "left").select("doc_id", "length", "covered", "bad_chunks")


@query("markdown_round_trip", "with d as (select distinct chunk_id, text_md from chunks where contains(text_md, '<tr><td>') and not contains(text_md, '```')) select chunk_id, len(regexp_extract_all(text_md, '<tr>')) as rows from d")
def markdown_round_trip(t):
    """HTML tables within chunks as Markdown: as many rows come out as went in."""
    d = t("chunks").where(F.col("text_md").contains("<tr><td>") & ~F.col("text_md").contains("```")).select("chunk_id", "text_md").distinct()
    table = F.regexp_count(M.html_to_markdown(F.concat(F.lit("<div>"), F.array_join(F.regexp_extract_all("text_md", F.lit(r"(<tr>.*?</tr>)"), F.lit(1)), ""), F.lit("</div>"))), F.lit(r"(?m)^\|(?! ---)"))
    return d.select("chunk_id", table.alias("rows"))


@query("stream_event_windows", "select event_type, time_bucket(interval 1 hour, ts) as start, count(*) as n, round(sum(value), 4) as total from events group by all")
def stream_event_windows(t):
    """The event table, a file or a folder of them, as a stream, hourly windows, complete results."""
    batch = t("events")
    at = batch.inputFiles()  # of a table in one file the file itself, else the table's folder
    folder, name = at[0].rsplit("/", 1)
    s = E.file_stream(batch.sparkSession, folder, batch.schema.simpleString()[7:-1].replace(":", " "), glob=None if folder.endswith("/events.parquet") else name).withColumn("ts", F.col("ts").cast("timestamp"))
    return E.run_to_end(E.windowed_counts(s), "complete")


@query("stream_sessions", "with e as (select user_id, ts, case when ts - lag(ts) over w < interval 30 minute then 0 else 1 end as fresh from events window w as (partition by user_id order by ts)), g as (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as s from e) select user_id, min(ts) as start, max(ts) + interval 30 minute as stop, count(*) as n from g group by user_id, s")
def stream_sessions(t):
    return E.sessions(t("events").withColumn("ts", F.col("ts").cast("timestamp")))


_W = r"list_transform(regexp_extract_all(coalesce(@, ''), '[\p{L}\p{N}]+'), lambda x: lower(x))"


@query("suggested_edges_title", f"with {_PAGES}, kt as (select doc_id, max_by(title, (version, loaded_at)) as title from (select * replace (coalesce(title, '') as title) from kb_documents) group by doc_id), t as (select doc_id as dst, ' ' || array_to_string(w, ' ') || ' ' as name from (select doc_id, {_W.replace('@', 'title')} as w from kt) where len(w) between 2 and 8), c as (select distinct doc_id as src, ' ' || array_to_string({_W.replace('@', 'text_md')}, ' ') || ' ' as body from chunks where length(text_md) > 0 and doc_id is not null) select distinct src, dst, 'REFERENCES' as type, 0.8::double as confidence from c join t on contains(body, name) and src <> dst")
def suggested_edges_title(t):
    """Chunks that name the title of a page."""
    titles = pages(t).select("doc_id", "title", F.lit("").alias("text"))
    bodies = t("chunks").where("length(text_md) > 0 and doc_id is not null").select("doc_id", F.lit("").alias("title"), F.col("text_md").alias("text")).distinct()
    return I.title_mentions(titles.unionByName(bodies))


@query("space_keys", "select distinct doc_id, version, coalesce(nullif(space_key, ''), nullif(regexp_extract(coalesce(url, ''), '/spaces/([A-Z0-9]+)/pages/', 1), ''), '__unknown__') as space from kb_documents")
def space_keys(t):
    return t("kb_documents").select("doc_id", "version", I.space_key(F.col("space_key"), F.col("url")).alias("space")).distinct()


@query("link_targets", "select coalesce(target_type, 'unknown') as kind, count(*) as links, count(distinct lower(trim(target_page_id))) as targets, count(*) filter (anchor is not null) as anchored from (select distinct link_id, target_type, target_page_id, anchor from link_refs) group by 1")
def link_targets(t):
    r = t("link_refs").select("link_id", "target_type", "target_page_id", "anchor").distinct()
    return r.groupBy(F.coalesce("target_type", F.lit("unknown")).alias("kind")).agg(F.count(F.lit(1)).alias("links"), F.countDistinct(F.lower(F.trim("target_page_id"))).alias("targets"), F.count("anchor").alias("anchored"))


@query("embedding_load", "with e as (select distinct chunk_id, provider from chunk_embeddings where provider = 'dummy' and chunk_id is not null), c as (select distinct chunk_id from chunks where chunk_id is not null) select count(*) as vectors, count(*) filter (fresh) as fresh from (select chunk_id, true as fresh from c union all select chunk_id, false from e where chunk_id not in (select chunk_id from c))")
def embedding_load(t):
    """A load of all chunks beside stored vectors: of every other chunk of known text, which is skipped; of others, made anew; and of none that is there, which stay."""
    known = t("chunks").where("chunk_id is not null").select("chunk_id", H.content_hash(F.col("text_md")).alias("content_hash")).dropDuplicates(["chunk_id"]).where(F.pmod(F.xxhash64("chunk_id"), F.lit(2)) == 0)
    old = t("chunk_embeddings").where("provider = 'dummy' and chunk_id is not null").groupBy("chunk_id", "provider").agg(F.max(F.slice("embedding", 1, 8)).alias("e")).join(known, "chunk_id", "left")
    vector = F.when(F.col("content_hash").isNotNull() & (F.size("e") == 8), F.col("e").cast("array<float>"))
    old = old.select("chunk_id", "provider", F.lit(8).alias("dim"), F.when(vector.isNotNull(), F.col("content_hash")).alias("content_hash"), vector.alias("embedding"))
    out = B.load(t("chunks").select("chunk_id", "doc_id", "text_md").distinct(), old, "dummy", 8)
    return out.agg(F.count(F.lit(1)).alias("vectors"), F.count("embedding").alias("fresh"))


@query("query_classes", "select distinct doc_id, version, regexp_matches(lower(coalesce(title, '')), '\\b(n2s|navigate\\s+to\\s+saas|navigate-to-saas|lifecycle|methodology|sprint\\s+0|sprint\\s+zero|discovery|build|optimize)\\b') as process from kb_documents")
def query_classes(t):
    return t("kb_documents").select("doc_id", "version", Q.is_process(F.col("title")).alias("process")).distinct()


@query("run_preflight", "with c as (select distinct chunk_id, json_extract_string(meta, '$.run') as run_id, token_count from chunks) select run_id, count(*) as documents, count(*) filter (coalesce(token_count / 100.0, 1.0) < 0.6) as below, count(*) filter (coalesce(token_count / 100.0, 1.0) < 0.6) <= 0.2 * count(*) as ready from c group by run_id")
def run_preflight(t):
    c = t("chunks").select("chunk_id", F.get_json_object("meta", "$.run").alias("run_id"), (F.col("token_count") / 100.0).alias("quality_score")).distinct()
    return B.preflight(c)
