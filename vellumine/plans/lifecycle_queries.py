"""Queries on incremental loads, differences and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumine.operators import lifecycle as L
from vellumine.operators.retrieval import latest
from vellumine.plans.registry import query

# Time that parts the loads into a state before and one after.
CUT = "2024-09-01 00:00:00"
_KB = "kb as (select distinct doc_id, version, title, space_key, content_sha256, updated_at, loaded_at from kb_documents),"
_OLD = f"prev as (select * exclude (rn) from (select *, row_number() over (partition by doc_id order by version desc, loaded_at desc) as rn from kb where loaded_at < timestamp '{CUT}') where rn = 1),"
_NEW = "cur as (select * exclude (rn) from (select *, row_number() over (partition by doc_id order by version desc, loaded_at desc) as rn from kb) where rn = 1),"


def loads(t):
    return t("kb_documents").select("doc_id", "version", "title", "space_key", "content_sha256", "updated_at", "loaded_at")


def previous(t):
    return latest(loads(t).where(F.col("loaded_at") < F.lit(CUT).cast("timestamp")), "doc_id", "version", "loaded_at")


def current(t):
    return latest(loads(t), "doc_id", "version", "loaded_at")


@query("latest_documents", f"with {_KB} {_NEW} z as (select 1) select doc_id, version, title, space_key, content_sha256 from cur")
def latest_documents(t):
    return current(t).select("doc_id", "version", "title", "space_key", "content_sha256")


@query("changed_documents", f"with {_KB} {_OLD} {_NEW} z as (select 1) select c.doc_id, case when p.doc_id is null then 'new' else 'changed' end as change from cur c left join prev p using (doc_id) where p.doc_id is null or c.content_sha256 is distinct from p.content_sha256")
def changed_documents(t):
    return L.changed(current(t), previous(t), "doc_id", "content_sha256")


@query("changed_only_chunks", f"with {_KB} {_OLD} {_NEW} ch as (select c.doc_id from cur c left join prev p using (doc_id) where p.doc_id is null or c.content_sha256 is distinct from p.content_sha256) select distinct chunk_id from chunks where doc_id in (select doc_id from ch)")
def changed_only_chunks(t):
    ids = L.changed(current(t), previous(t), "doc_id", "content_sha256")
    return t("chunks").select("chunk_id", "doc_id").join(ids, "doc_id", "left_semi").select("chunk_id").distinct()


@query("upsert_documents", f"with {_KB} {_OLD} {_NEW} s as (select * from cur where loaded_at >= timestamp '{CUT}') select doc_id, version, title from prev where doc_id not in (select doc_id from s) union all select doc_id, version, title from s")
def upsert_documents(t):
    fresh = current(t).where(F.col("loaded_at") >= F.lit(CUT).cast("timestamp"))
    return L.upsert(previous(t), fresh, "doc_id").select("doc_id", "version", "title")


@query("insert_missing_documents", f"with {_KB} {_OLD} {_NEW} z as (select 1) select doc_id, version, title from prev union all select doc_id, version, title from cur where doc_id not in (select doc_id from prev)")
def insert_missing_documents(t):
    return L.insert_missing(previous(t), current(t), "doc_id").select("doc_id", "version", "title")


@query("upsert_filled_titles", f"with {_KB} {_OLD} {_NEW} z as (select 1) select coalesce(c.doc_id, p.doc_id) as doc_id, coalesce(c.title, p.title) as title, coalesce(c.space_key, p.space_key) as space_key from prev p full outer join cur c using (doc_id)")
def upsert_filled_titles(t):
    return L.upsert_filled(previous(t), current(t), "doc_id").select("doc_id", "title", "space_key")


@query("upsert_embeddings", "with e as (select distinct chunk_id, provider, dim, created_at from chunk_embeddings), old as (select * from e where provider = 'dummy'), src as (select chunk_id, 'dummy' as provider, max(dim) as dim, max(created_at) as created_at from e where provider = 'lumen-small' group by chunk_id) select o.* from old o where not exists (select 1 from src s where s.chunk_id = o.chunk_id) union all select * from src")
def upsert_embeddings(t):
    e = t("chunk_embeddings").select("chunk_id", "provider", "dim", "created_at").distinct()
    src = e.where("provider = 'lumen-small'").groupBy("chunk_id").agg(F.max("dim").alias("dim"), F.max("created_at").alias("created_at")).withColumn("provider", F.lit("dummy"))
    return L.upsert(e.where("provider = 'dummy'"), src, "chunk_id", "provider")


@query("skiplist_chunks", "with s as (select distinct id from enriched_docs where list_contains(list_transform(quality_flags, lambda x: lower(x)), 'too_short')) select distinct chunk_id, doc_id from chunks where doc_id is null or doc_id not in (select id from s where id is not null)")
def skiplist_chunks(t):
    s = t("enriched_docs").where(F.exists("quality_flags", lambda x: F.lower(x) == "too_short")).select(F.col("id").alias("doc_id"))
    return L.skip(t("chunks").select("chunk_id", "doc_id"), s, "doc_id").select("chunk_id", "doc_id").distinct()


@query("shared_content", "with k as (select distinct doc_id, content_sha256 from kb_documents where content_sha256 is not null) select content_sha256, count(distinct doc_id) as copies, min(doc_id) as first_key from k group by content_sha256 having count(distinct doc_id) > 1")
def shared_content(t):
    return L.shared_content(t("kb_documents"), "doc_id", "content_sha256")


@query("diff_deletions", f"with {_KB} a as (select distinct doc_id from kb where loaded_at < timestamp '{CUT}'), b as (select distinct doc_id from kb where loaded_at >= timestamp '{CUT}') select doc_id from a where doc_id not in (select doc_id from b)")
def diff_deletions(t):
    at = F.lit(CUT).cast("timestamp")
    return L.missing_keys(loads(t).where(F.col("loaded_at") < at), loads(t).where(F.col("loaded_at") >= at), "doc_id")


@query("completeness_audit", "with c as (select distinct chunk_id, split_part(doc_id, ':', 1) as kind from chunks), e as (select distinct chunk_id from chunk_embeddings) select case when kind = 'topic' then 'topic' else 'page' end as kind, count(*) as chunks, count(*) filter (chunk_id not in (select chunk_id from e where chunk_id is not null)) as unembedded from c group by 1")
def completeness_audit(t):
    c = t("chunks").select("chunk_id", F.when(F.col("doc_id").startswith("topic:") | (F.col("doc_id") == "topic"), "topic").otherwise("page").alias("kind")).distinct()
    e = t("chunk_embeddings").select("chunk_id").distinct().withColumn("there", F.lit(1))
    return c.join(e, "chunk_id", "left").groupBy("kind").agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("there").isNull()).alias("unembedded"))


@query("unchanged_chunks", "with c as (select distinct chunk_id, text_md from chunks), e as (select chunk_id, max(created_at) as at from chunk_embeddings group by chunk_id), m as (select distinct chunk_id, emitted_at from chunks) select chunk_id, e.at >= m.emitted_at as current from m join e using (chunk_id)")
def unchanged_chunks(t):
    """Chunks that have an embedding, and whether it is as new as the chunk."""
    e = t("chunk_embeddings").groupBy("chunk_id").agg(F.max("created_at").alias("at"))
    return t("chunks").select("chunk_id", "emitted_at").distinct().join(e, "chunk_id").select("chunk_id", (F.col("at") >= F.col("emitted_at")).alias("current"))


@query("metadata_lookup", f"with {_KB} {_NEW} e as (select distinct id, title, collection from enriched_docs), m as (select id, max(title) as t2, max(collection) as collection from e group by id) select doc_id, coalesce(title, t2) as title, coalesce(collection, lower(space_key), 'unknown') as collection from cur left join m on id = doc_id")
def metadata_lookup(t):
    """Left join of the enriched fields, one row each; titles and collections fall back along a chain."""
    m = t("enriched_docs").groupBy(F.col("id").alias("doc_id")).agg(F.max("title").alias("t2"), F.max("collection").alias("collection"))
    return current(t).join(m, "doc_id", "left").select("doc_id", F.coalesce("title", "t2").alias("title"), F.coalesce("collection", F.lower("space_key"), F.lit("unknown")).alias("collection"))


@query("traceability_chain", "with a as (select distinct doc_id as k from kb_documents), b as (select distinct id as k from enriched_docs), c as (select distinct doc_id as k from chunks where trim(doc_id) <> '') select 'ingest->enrich' as step, count(*) filter (a.k is not null and b.k is not null) as kept, count(*) filter (b.k is null) as lost, count(*) filter (a.k is null) as added from a full outer join b on a.k = b.k union all select 'enrich->chunk', count(*) filter (b.k is not null and c.k is not null), count(*) filter (c.k is null), count(*) filter (b.k is null) from b full outer join c on b.k = c.k")
def traceability_chain(t):
    return L.chain({"ingest": t("kb_documents").select("doc_id"), "enrich": t("enriched_docs").select(F.col("id").alias("doc_id")), "chunk": t("chunks").where("trim(doc_id) <> ''").select("doc_id")}, "doc_id")


@query("field_retention", "with k as (select distinct * from kb_documents), c as (select distinct * from chunks) " + " union all ".join([f"select 'ingest' as stage, '{f}' as field, count({f}) as filled, count(*) as rows from k" for f in ("title", "url", "space_key", "content_sha256")] + [f"select 'chunk', '{f}', count({f}), count(*) from c" for f in ("doc_id", "text_md", "token_count", "char_start")]))
def field_retention(t):
    k, c = t("kb_documents").distinct(), t("chunks").distinct()
    fields = ["title", "url", "space_key", "content_sha256", "text_md", "token_count", "char_start"]
    return L.field_retention({"ingest": k.select(*fields[:4]), "chunk": c.select("doc_id", *fields[4:])}, ["doc_id", *fields])


_HALF = "sum(cast(('0x' || substr(h, @, 12)) as bigint)::hugeint)"


@query("chunk_set_hash", "with r as (select distinct sha256(coalesce(chunk_id, chr(0)) || chr(31) || coalesce(cast(token_count as varchar), chr(0)) || chr(31) || coalesce(text_md, chr(0))) as h from chunks) select count(*) as rows, sha256(count(*) || '|' || " + _HALF.replace("@", "1") + " || '|' || " + _HALF.replace("@", "13") + ") as set_hash from r")
def chunk_set_hash(t):
    """Order-free: the hashes of the rows are added up."""
    return L.set_hash(t("chunks"), "chunk_id", "token_count", "text_md")


@query("highwater_marks", "select space_key, max(updated_at) as mark from kb_documents group by space_key")
def highwater_marks(t):
    return L.high_water(t("kb_documents"), "updated_at", "space_key")


@query("highwater_increment", f"with {_KB} m as (select space_key, max(updated_at) as mark from kb where loaded_at < timestamp '{CUT}' and space_key is not null group by space_key) select doc_id, version, updated_at from kb left join m using (space_key) where mark is null or updated_at >= mark")
def highwater_increment(t):
    m = L.high_water(loads(t).where((F.col("loaded_at") < F.lit(CUT).cast("timestamp")) & F.col("space_key").isNotNull()), "updated_at", "space_key")
    return L.since(loads(t).distinct(), m, "updated_at", "space_key").select("doc_id", "version", "updated_at")


@query("seen_ids", "select distinct space_key, doc_id from kb_documents")
def seen_ids(t):
    """The ids seen in each space, one row each: a space that holds a third of all ids is no group in one task. Written out
    by writers.write_partitioned() they are a file per space."""
    return t("kb_documents").select("space_key", "doc_id").distinct()


@query("seen_id_counts", "select space_key, count(distinct doc_id) as ids from kb_documents group by space_key")
def seen_id_counts(t):
    return seen_ids(t).groupBy("space_key").agg(F.count("doc_id").alias("ids"))


@query("prunable_runs", "with r as (select run_id, max(deleted_at) as last from deleted_pages where run_id is not null group by run_id), n as (select run_id, last, row_number() over (order by last desc, run_id) as k from r) select run_id, last from n where k > 5")
def prunable_runs(t):
    runs = t("deleted_pages").where("run_id is not null").groupBy("run_id").agg(F.max("deleted_at").alias("last"))
    return L.newest(runs, 5, "last", "run_id")


@query("event_rate_ema", "with recursive e as (select user_id, event_id, value, row_number() over (partition by user_id order by ts, event_id) as n from events where value is not null), r as (select user_id, event_id, n, value, value as ema from e where n = 1 union all select e.user_id, e.event_id, e.n, e.value, r.ema * 0.9 + 0.1 * e.value from r join e on e.user_id = r.user_id and e.n = r.n + 1) select event_id, round(ema, 6) as ema from r")
def event_rate_ema(t):
    e = t("events").where("value is not null").select("user_id", "event_id", "ts", "value")
    return L.ema(e, "value", "user_id", ["ts", "event_id"], 0.1).select("event_id", F.round("ema", 6).alias("ema"))
