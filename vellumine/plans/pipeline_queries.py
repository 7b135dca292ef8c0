"""Queries on retrieval quality end to end, filters, runs and plans, and bodies of pages in each of their forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vellumine.functions import markup as M
from vellumine.functions import text as T
from vellumine.functions import urls as U
from vellumine.operators import embedding as B
from vellumine.operators import ingest as I
from vellumine.operators import qa as A
from vellumine.operators import retrieval as R
from vellumine.operators import runs as N
from vellumine.plans import retrieval_queries as Q
from vellumine.plans.ingest_queries import _PAGES, pages
from vellumine.plans.registry import query
from vellumine.plans.text_queries import ENRICHED, enriched
from vellumine.session import ensure_checkpoint_dir
from vellumine.sources.readers import ATTACHMENT, read_ndjson
from vellumine.sources.writers import write_ndjson

BUDGETS = [1500, 4000, 6000]
_B = f"(select unnest({BUDGETS}) as budget) b"
_EV = Q._BH + f""", hx as (select bh.*, text_md from bh join (select distinct chunk_id, text_md from chunks) using (chunk_id)),
pk as (select *, sum(length(coalesce(text_md, ''))) over (partition by query_id, budget order by rank) as used from hx, {_B}), pu as (select * from pk where used <= budget),
pn as (select *, count(*) over (partition by query_id, budget) as n, count(*) over (partition by query_id, budget, doc_id) as pd, count(*) over (partition by query_id, budget, score) as ties from pu),
hq as (select query_id, budget, count(*) as hits, cast(max(used) as bigint) as used, count(distinct doc_id) as unique_docs, round(abs(sum(-log2(pd / n) / n)), 6) as entropy, round(avg(case when ties > 1 and n > 1 then 1.0 else 0 end), 6) as tie_rate,
  count(*) filter (coalesce(trim(title), '') = '') as missing_title, count(*) filter (coalesce(trim(url), '') = '') as missing_url from pn group by query_id, budget),
qs as (select query_id, budget from (select distinct query_id from q), {_B}),
er as (select *, list_filter([case when hits is null then 'no_hits' end, case when unique_docs < 3 then 'unique_docs' end, case when tie_rate > 0.35 then 'tie_rate' end, case when missing_title > 0 then 'missing_title' end, case when missing_url > 0 then 'missing_url' end], lambda x: x is not null) as r from qs left join hq using (query_id, budget)),
ev as (select query_id, budget, coalesce(hits, 0) as hits, coalesce(used, 0) as used, coalesce(unique_docs, 0) as unique_docs, entropy, tie_rate, r, array_to_string(r, ',') as reasons, len(r) = 0 as passed from er)"""


def evaluated(t):
    texts = t("chunks").select("chunk_id", "text_md").distinct()
    return A.evaluate(Q.batch_hits(t).join(texts, "chunk_id"), Q.asking(t), BUDGETS)


@query("qa_evaluation", _EV + " select query_id, budget, hits, used, unique_docs, entropy, tie_rate, reasons, passed from ev")
def qa_evaluation(t):
    return evaluated(t)


@query("qa_pack_statistics", _EV + " select budget, count(*) as queries, round(avg(hits), 6) as mean_hits, round(avg(used), 6) as mean_used, round(avg(unique_docs), 6) as mean_docs, round(avg(1 - tie_rate), 6) as untied, round(avg(passed::int), 6) as pass_rate from ev group by budget")
def qa_pack_statistics(t):
    return A.pack_statistics(evaluated(t))


@query("qa_gates", _EV + " select query_id, bool_and(passed) as passed, count(*) filter (not passed) as failed_budgets, array_to_string(list_sort(list_distinct(flatten(list(r)))), ',') as reasons from ev group by query_id")
def qa_gates(t):
    return A.query_gates(evaluated(t))


@query("qa_readiness", _EV + " select count(*) as queries, count(*) filter (p) as passed, case when count(*) > 0 then round(count(*) filter (p) / count(*), 6) else 0.0 end as pass_rate, count(*) > 0 and count(*) filter (p) / greatest(count(*), 1) >= 0.8 as ready from (select bool_and(passed) as p from ev group by query_id)")
def qa_readiness(t):
    return A.readiness(evaluated(t))


@query("qa_ties", Q.BATCH + " select query_id, round(max(n) / sum(n), 6) as tie_share, max(n) / sum(n) <= 0.3 as fine from (select query_id, score, count(*) as n from br group by query_id, score) group by query_id")
def qa_ties(t):
    return A.tie_multiplicity(Q.batch(t), "query_id")


@query("qa_trace", Q._BH + """ select query_id, '[' || string_agg('{"rank":' || rank || ',"chunk_id":"' || chunk_id || '"' || coalesce(',"doc_id":"' || doc_id || '"', '') || '}', ',' order by rank) || ']' as trace from bh group by query_id""")
def qa_trace(t):
    """The hits of each query as a line; scores are left to the JSON sink, whose digits differ from the database's."""
    return A.trace(Q.batch_hits(t).withColumn("score", F.lit(None).cast("double")), "query_id")


SPACES = ["OPSHUB", "DOCS"]
_ALLOWED = f"{_PAGES}, al as (select doc_id from p where space_key in ('OPSHUB', 'DOCS'))"


def allowed(t):
    return R.allowed_documents(pages(t), SPACES)


@query("lexical_in_spaces", f"with {_ALLOWED}, " + Q.LEX.replace("@", Q.ANY) + " r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ls where doc_id in (select doc_id from al)) select * from r where rank <= 30")
def lexical_in_spaces(t):
    return R.lexical_search(t("chunks"), Q.QUERY, 30, allowed=allowed(t))


@query("dense_in_spaces", f"with {_ALLOWED}, " + Q.DENSE + " r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ds where doc_id in (select doc_id from al)) select * from r where rank <= 20")
def dense_in_spaces(t):
    return R.dense_search(t("chunks"), t("chunk_embeddings"), Q.vector(t), Q.PROVIDER, Q.DIM, 20, allowed(t))


_PROC = " or ".join(f"contains(lower(coalesce(title, '')), '{x}')" for x in ("n2s", "navigate to saas", "methodology", "playbook", "runbook")) + " or " + " or ".join(f"contains(lower(coalesce(meta, '')), '{x}')" for x in ("n2s", "navigate to saas", "methodology"))


@query("lexical_about_process", f"with lp as (select doc_id, max_by({{'title': title, 'meta': meta}}, (version, loaded_at)) as x from kb_documents group by doc_id), al as (select doc_id from (select doc_id, x.title as title, x.meta as meta from lp) where {_PROC}), " + Q.LEX.replace("@", Q.ANY) + " r as (select *, row_number() over (order by score desc, doc_id, chunk_id) as rank from ls where doc_id in (select doc_id from al)) select * from r where rank <= 30")
def lexical_about_process(t):
    return R.lexical_search(t("chunks"), Q.QUERY, 30, allowed=R.allowed_documents(pages(t), process=True))


# Runs: the loads of a page are a run here, the orders a queue of them.
_RUNS = "rs as (select o_orderkey as run_id, case o_orderstatus when 'O' then 'normalized' when 'F' then 'chunking' else 'chunked' end as status, cast(o_orderdate as timestamp) as at, case when o_orderstatus = 'F' and o_orderkey % 3 > 0 then cast(o_orderdate as timestamp) end as claimed_at from orders)"
NOW = "1996-01-01 00:00:00"


def work(t):
    o, at = t("orders"), F.col("o_orderdate").cast("timestamp")
    status = F.when(F.col("o_orderstatus") == "O", "normalized").when(F.col("o_orderstatus") == "F", "chunking").otherwise("chunked")
    return o.select(F.col("o_orderkey").alias("run_id"), status.alias("status"), at.alias("at"), F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 > 0), at).alias("claimed_at"))


@query("stale_claims", f"with {_RUNS} select run_id, case when status = 'chunking' and (claimed_at is null or claimed_at < timestamp '{NOW}' - interval 45 minute) then 'normalized' else status end as status from rs")
def stale_claims(t):
    return N.recover_stale(work(t), F.lit(NOW).cast("timestamp")).select("run_id", "status")


@query("fifo_claim", f"with {_RUNS}, f as (select run_id from rs where status = 'chunked' order by rs.at, run_id limit 25) select run_id, case when run_id in (select run_id from f) then 'embedding' else status end as status, case when run_id in (select run_id from f) then timestamp '{NOW}' else claimed_at end as claimed_at from rs")
def fifo_claim(t):
    return N.claim(work(t), "chunked", F.lit(NOW).cast("timestamp"), 25).select("run_id", "status", "claimed_at")


@query("finished_claims", f"with {_RUNS} select run_id, case when status = 'chunking' and run_id % 2 = 0 then 'chunked' else status end as status, case when status = 'chunking' and run_id % 2 = 0 then null else claimed_at end as claimed_at from rs")
def finished_claims(t):
    w = work(t)
    return N.finish(w, w.where("run_id % 2 = 0")).select("run_id", "status", "claimed_at")


@query("reset_runs", f"with {_RUNS} select status, count(*) as runs, count(claimed_at) as claimed from (select case when status = 'chunked' then 'chunking' else status end as status, case when status = 'chunked' then null else claimed_at end as claimed_at from rs) group by status")
def reset_runs(t):
    return N.reset(work(t), "chunking").groupBy("status").agg(F.count(F.lit(1)).alias("runs"), F.count("claimed_at").alias("claimed"))


@query("run_overview", f"with {_RUNS}, l as (select * from rs order by rs.at desc, run_id limit 100) select status, count(*) as runs, max(l.at) as newest from l group by status")
def run_overview(t):
    return N.overview(work(t), 100, "status")


@query("run_needs", "with k as (select distinct doc_id from kb_documents where doc_id is not null), e as (select distinct id from enriched_docs where id is not null), c as (select distinct doc_id from chunks where doc_id is not null), n as (select doc_id, 1 as o, 'enrich' as phase from k where doc_id not in (select id from e) union all select id, 2, 'chunk' from e where id not in (select doc_id from c)) select doc_id, min_by(phase, o) as phase from n group by doc_id")
def run_needs(t):
    return N.needs({"ingest": t("kb_documents").select("doc_id"), "enrich": t("enriched_docs").select(F.col("id").alias("doc_id")), "chunk": t("chunks").select("doc_id")}, "doc_id")


# A plan: each space is a run, whose documents are scored; chunks of the loads' pages are its chunks.
_PLAN = f"""{ENRICHED}, dd as (select space_key as run_id, count(*) as documents, count(*) filter (quality_score < 0.6) as below from e where space_key is not null group by space_key),
{_PAGES}, cc as (select p.space_key as run_id, count(*) as chunks, count(*) filter (length(trim(text_md)) > 0) as filled from (select distinct chunk_id, doc_id, text_md from chunks) c join p using (doc_id) where p.space_key is not null group by p.space_key),
pl as (select distinct space_key as run_id from kb_documents where space_key is not null union select 'NOSUCHRUN'),
pj as (select run_id, coalesce(documents, 0) as documents, coalesce(chunks, 0) as chunks, coalesce(below, 0) as below, coalesce(filled, 0) as filled from pl left join dd using (run_id) left join cc using (run_id)),
pr as (select *, list_filter([case when documents = 0 then 'NO_DOCUMENTS' end, case when chunks < 1 then 'NO_CHUNKS' end, case when chunks > 0 and filled = 0 then 'BLANK_CHUNKS' end, case when below > 0.2 * documents then 'LOW_QUALITY' end], lambda x: x is not null) as r from pj),
ps as (select run_id, documents, chunks, below, case when len(r) = 0 then 'READY' else 'BLOCKED' end as status, array_to_string(r, ',') as reasons from pr)"""


def plan(t):
    d = enriched(t).select(F.col("space_key").alias("run_id"), "quality_score")
    spaces = pages(t).select("doc_id", F.col("space_key").alias("run_id")).where("run_id is not null")
    c = t("chunks").select("chunk_id", "doc_id", "text_md").distinct().join(spaces, "doc_id").select("run_id", "text_md")
    runs = t("kb_documents").select(F.explode(F.array("space_key", F.lit("NOSUCHRUN"))).alias("run_id"))
    return N.plan_preflight(runs, d, c)


@query("plan_preflight", f"with {_PLAN} select * from ps")
def plan_preflight(t):
    return plan(t)


@query("plan_totals", f"with {_PLAN} select count(*) as runs, count(*) filter (status = 'READY') as ready, count(*) filter (status <> 'READY') as blocked, cast(coalesce(sum(documents) filter (status = 'READY'), 0) as bigint) as documents, cast(coalesce(sum(chunks) filter (status = 'READY'), 0) as bigint) as chunks from ps")
def plan_totals(t):
    return N.plan_totals(plan(t))


@query("blocked_reasons", f"with {_PLAN} select reason, count(*) as runs from (select unnest(string_split(reasons, ',')) as reason from ps where status = 'BLOCKED') group by reason")
def blocked_reasons(t):
    return plan(t).where("status = 'BLOCKED'").select(F.explode(F.split("reasons", ",")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("runs"))


@query("below_soft_minimum", "with c as (select distinct chunk_id, length(coalesce(text_md, '')) // 4 as n from chunks where chunk_id is not null), f as (select chunk_id from c where n < 200 order by chunk_id limit 10) select count(*) as chunks, count(*) filter (n < 200) as below, round(100.0 * count(*) filter (n < 200) / count(*), 4) as percent, (select string_agg(chunk_id, ',' order by chunk_id) from f) as examples from c")
def below_soft_minimum(t):
    """Share of the chunks below the soft minimum of 200 tokens, and the first ten of them, from a top-k."""
    c = t("chunks").where("chunk_id is not null").select("chunk_id", F.floor(F.length(F.coalesce("text_md", F.lit(""))) / 4).alias("n")).distinct()
    low = F.col("n") < 200
    some = N.first_rows(c.where(low).select("chunk_id"), 10, "chunk_id").agg(F.array_join(F.array_sort(F.collect_list("chunk_id")), ",").alias("examples"))
    return c.agg(F.count(F.lit(1)).alias("chunks"), F.count_if(low).alias("below"), F.round(100.0 * F.count_if(low) / F.count(F.lit(1)), 4).alias("percent")).crossJoin(some)  # one row each


@query("limited_documents", "select distinct doc_id, updated_at from documents order by updated_at, doc_id limit 100")
def limited_documents(t):
    """The first hundred documents by time: a stated limit, which is the feature."""
    return N.first_rows(t("documents").select("doc_id", "updated_at").distinct(), 100, F.asc_nulls_last("updated_at"), "doc_id")


@query("merged_fields", "select distinct doc_id, version, coalesce(title, 'none') as title, 'load' as stage, coalesce(space_key, 'none') as space from kb_documents")
def merged_fields(t):
    """Two maps of fields as one; the later one's stage wins."""
    pair = lambda *kv: F.create_map(*[F.lit(x) if i % 2 == 0 else x for i, x in enumerate(kv)])
    none = F.lit("none")
    m = N.merged(pair("title", F.coalesce("title", none), "stage", F.lit("ingest")), F.lit(None).cast("map<string,string>"), pair("stage", F.lit("load"), "space", F.coalesce("space_key", none)))
    return t("kb_documents").select("doc_id", "version", m.alias("m")).select("doc_id", "version", *[F.col("m")[k].alias(k) for k in ("title", "stage", "space")]).distinct()


@query("urls_of_topics", "with u as (select distinct link_id, link_id % 3 as k from link_refs) select link_id, 'https://h.example.invalid/p' || case k when 0 then '?a=1+2&a=3' when 1 then '' else '?b=' end || '#f' as url from u")
def urls_of_topics(t):
    """Links of XML topics: more tracking parameters than those of pages, repeated ones kept, values encoded again."""
    k = F.col("link_id") % 3
    raw = F.concat(F.lit("https://h.example.invalid/p"), F.when(k == 0, "?a=1%202&msclkid=x&a=3&_gac=y#f").when(k == 1, "?utm_source=z#f").otherwise("?b#f"))
    return t("link_refs").select("link_id", U.normalize_url(raw, U.TRACKING_XML, encode=True).alias("url")).distinct()


# Bodies in each form, made of the fields of every page.
_CLEAN = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]+", " ")
_MADE = "with k as (select doc_id, max_by({'title': title, 'space': space_key}, (version, loaded_at)) as x from kb_documents where doc_id is not null group by doc_id), m as (select doc_id, 'T ' || trim(regexp_replace(coalesce(x.title, ''), '[^A-Za-z0-9]+', ' ', 'g'), ' ') || '.' as t, regexp_replace(doc_id, '[^A-Za-z0-9]+', '-', 'g') as n, coalesce(nullif(regexp_replace(coalesce(x.space, ''), '[^A-Za-z0-9]+', '', 'g'), ''), 'NONE') as s from k)"


def made(t):
    """doc_id, t (title), n (name), s (space), html, adf, xml."""
    k = pages(t).where("doc_id is not null")
    m = k.select("doc_id", F.concat(F.lit("T "), F.trim(_CLEAN(F.col("title"))), F.lit(".")).alias("t"), F.regexp_replace("doc_id", "[^A-Za-z0-9]+", "-").alias("n"), F.coalesce(F.nullif(F.regexp_replace(F.coalesce("space_key", F.lit("")), "[^A-Za-z0-9]+", ""), F.lit("")), F.lit("NONE")).alias("s"))
    say = lambda form: F.expr("concat('" + form.replace("@t", "', t, '").replace("@n", "', n, '").replace("@s", "', s, '") + "')")
    html = '<h2>@t</h2><p>In <strong>@s</strong> see <a href="/spaces/@s/pages/12/@n#part">the page</a>.</p><script>no</script><table><tr><th>id</th><th>at</th></tr><tr><td>@n</td><td>x</td></tr></table><ol><li>one</li><li><em>two</em></li></ol><img src="d/@n.png" alt="@n.png">'
    adf = '{"type":"doc","content":[{"type":"heading","attrs":{"level":3},"content":[{"type":"text","text":"@t"}]},{"type":"paragraph","content":[{"type":"text","text":"see ","marks":[]},{"type":"text","text":"@n","marks":[{"type":"link","attrs":{"href":"https://wiki.example.invalid/spaces/@s/pages/34"}}]}]},{"type":"bulletList","content":[{"type":"listItem","content":[{"type":"paragraph","content":[{"type":"text","text":"@s","marks":[{"type":"strong"}]}]}]}]},{"type":"codeBlock","attrs":{"language":"sh"},"content":[{"type":"text","text":"ls @n"}]},{"type":"mediaSingle","content":[{"type":"media","attrs":{"id":"m","type":"file","alt":"@n.pdf","url":"https://f.example.invalid/@n.pdf"}}]}]}'
    xml = '<concept id="c"><title>@t</title><prolog><metadata><keywords><keyword>@s</keyword></keywords><othermeta name="name" content="@n"/></metadata></prolog><conbody><p>See <xref href="@n.dita">the <b>topic</b></xref></p><ul><li>@s</li></ul><image href="@n.svg"/></conbody></concept>'
    return m.select("*", say(html).alias("html"), say(adf).alias("adf"), say(xml).alias("xml"))


def body_pages(t):
    """The same as pages: bodies in HTML, editor JSON and XML by turns of the name's length."""
    m, turn = made(t), F.length("n") % 3
    none = F.lit(None).cast("string")
    files = F.array(F.struct(F.concat(F.lit("f-"), "n").alias("id"), F.concat("n", F.when(turn == 0, ".png").otherwise(".pdf")).alias("filename"), none.alias("media_type"), F.lit(None).cast("bigint").alias("file_size"), none.alias("download_url")))
    return m.select(
        F.col("doc_id").alias("id"), F.col("t").alias("title"), F.col("s").alias("space_key"), F.lower("s").alias("space_name"), F.concat(F.lit("https://wiki.example.invalid/confluence/"), "n").alias("url"), F.lit(1).alias("version"), none.alias("created_at"), none.alias("updated_at"), none.alias("body_repr"), none.alias("source_system"),
        F.when(turn == 0, F.col("html")).alias("body_storage"), F.when(turn == 1, F.col("adf")).alias("body_adf"), F.when(turn == 2, F.col("xml")).alias("body_dita_xml"), files.cast(f"array<{ATTACHMENT}>").alias("attachments"),
        F.array(F.struct(F.lit("0").alias("id"), F.lit("Up").alias("title"), none.alias("url"))).alias("ancestors"), F.array("s").alias("labels"),
    )


_HTML_MD = "'## ' || t || chr(10) || chr(10) || 'In **' || s || '** see [the page](/spaces/' || s || '/pages/12/' || n || '#part).' || chr(10) || chr(10) || '| id | at |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n || ' | x |' || chr(10) || chr(10) || '1. one' || chr(10) || '2. *two*' || chr(10) || chr(10) || '![' || n || '.png](d/' || n || '.png)'"
_ADF_MD = "'### ' || t || chr(10) || chr(10) || 'see [' || n || '](https://wiki.example.invalid/spaces/' || s || '/pages/34)' || chr(10) || chr(10) || '- **' || s || '**' || chr(10) || chr(10) || '```sh' || chr(10) || 'ls ' || n || chr(10) || '```'"
_XML_MD = "'# ' || t || chr(10) || chr(10) || 'See [the **topic**](' || n || '.dita)' || chr(10) || chr(10) || '- ' || s || chr(10) || chr(10) || '![](' || n || '.svg)'"


@query("markup_forms", f"{_MADE} select doc_id, {_HTML_MD} as html_md, {_ADF_MD} as adf_md, {_XML_MD} as xml_md from m")
def markup_forms(t):
    """HTML, editor JSON and XML of every page as Markdown."""
    return made(t).select("doc_id", M.html_to_markdown(F.col("html")).alias("html_md"), M.adf_to_markdown(F.col("adf")).alias("adf_md"), M.xml_to_markdown(F.col("xml")).alias("xml_md"))


@query("normalized_pages", f"{_MADE}, b as (select *, length(n) % 3 as turn from m) select doc_id as id, case turn when 0 then 'storage' when 1 then 'adf' else 'dita' end as body_repr, case turn when 0 then {_HTML_MD} when 1 then {_ADF_MD} else {_XML_MD} end as text_md, case turn when 2 then 'dita' else 'confluence' end as source_system, lower(s) || ' > Up > ' || t as crumbs from b")
def normalized_pages(t):
    return I.normalize_pages(body_pages(t)).select("id", "body_repr", "text_md", "source_system", F.array_join("breadcrumbs", " > ").alias("crumbs"))


@query("body_links", f"{_MADE}, b as (select *, length(n) % 3 as turn from m) select doc_id as from_page_id, case turn when 0 then 'https://wiki.example.invalid/spaces/' || s || '/pages/12/' || n || '#part' else 'https://wiki.example.invalid/spaces/' || s || '/pages/34' end as target_url, 'confluence' as target_type, case turn when 0 then '12' else '34' end as target_page_id, case turn when 0 then 'part' end as anchor from b where turn < 2")
def body_links(t):
    return I.page_links(body_pages(t), "https://wiki.example.invalid")


@query("body_media", f"{_MADE}, b as (select *, length(n) % 3 as turn from m) select doc_id as page_id, 0 as ord, case turn when 0 then n || '.png' else n || '.pdf' end as filename, case turn when 0 then 'd/' || n || '.png' else 'https://f.example.invalid/' || n || '.pdf' end as url, case turn when 0 then 'image' else 'document' end as media_type, 'f-' || n as attachment_id from b where turn < 2")
def body_media(t):
    return I.page_media(body_pages(t))


@query("topic_fields", f"{_MADE} select doc_id, t as title, s as keywords, 'name:' || n as othermeta, n || '.svg' as images, 'xref ' || n || '.dita the topic' as links from m")
def topic_fields(t):
    """Fields and links of every page as an XML topic."""
    m = made(t).select("doc_id", M.xml_topic_of(F.col("xml")).alias("x"), M.xml_links_of(F.col("xml")).alias("l"))
    return m.select("doc_id", "x.title", *[F.array_join(f"x.{c}", ",").alias(c) for c in ("keywords", "othermeta", "images")], F.array_join(F.transform("l", lambda e: F.concat_ws(" ", e["kind"], e["target"], e["text"])), ";").alias("links"))


@query("map_entries", f"{_MADE} select distinct 'map:guides/' || lower(n) || '/m' as map_id, 'topic:guides/' || lower(n) || '/t' as topic_id, o as ord, case o when 0 then t else '' end as title from m, (select unnest([0, 1]) as o)")
def map_entries(t):
    """A map beside every topic names it twice, once below itself; references are resolved by path."""
    m = made(t)
    topic = m.select(F.concat(F.lit("topic:guides/"), F.lower("n"), F.lit("/t")).alias("id"), F.lit("topic").alias("kind"), F.concat(F.lit("guides/"), F.lower("n"), F.lit("/t.dita")).alias("path"), "xml")
    entry = F.format_string('<map><topicref href="./T.dita" navtitle="%s"><topicref href="../%s/t.dita#x"/></topicref><topicref href="gone.dita"/></map>', F.col("t"), F.col("n"))
    maps = m.select(F.concat(F.lit("map:guides/"), F.lower("n"), F.lit("/m")).alias("id"), F.lit("map").alias("kind"), F.concat(F.lit("guides/"), F.lower("n"), F.lit("/m.ditamap")).alias("path"), entry.alias("xml"))
    return I.map_edges(topic.unionByName(maps)).distinct()


@query("body_hashes", f"{_MADE}, b as (select *, length(n) % 3 as turn from m) select doc_id as id, turn < 2 as hashed from b")
def body_hashes(t):
    """The hash of a body is that of its canonical JSON, whatever the order of its keys and its blanks, or of its HTML."""
    p = body_pages(t)
    loose = p.withColumn("body_adf", F.regexp_replace(F.regexp_replace("body_adf", r'^\{"type":"doc",(.*)\}$', r'{ $1, "type" : "doc" }'), '"level":3', '"level" : 3'))
    h = lambda df, n: df.select("id", I.content_sha256(df).alias(n))
    return h(p, "a").join(h(loose, "b"), "id").select("id", F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("hashed"))


_LINES = "list_filter(string_split(coalesce(text_md, ''), chr(10)), lambda x: contains(x, '|'))"


@query("table_digests", f"select distinct chunk_id, array_to_string(l[1:7], chr(10)) || case when len(l) > 7 then chr(10) || '... (' || (len(l) - 7) || ' more rows)' else '' end as digest from (select chunk_id, {_LINES} as l from chunks) where len(l) >= 2")
def table_digests(t):
    return t("chunks").select("chunk_id", T.table_digest(F.col("text_md")).alias("digest")).where("digest is not null").distinct()


@query("code_digests", r"""with c as (select distinct chunk_id, regexp_extract(text_md, '(?s)```\w*\n(.*?)\n?```', 1) as body, regexp_extract(text_md, '```(\w*)\n', 1) as lang from chunks where regexp_matches(text_md, '(?s)```\w*\n.*?```')),
n as (select *, regexp_extract_all(body, '(?:def|class|function|export)[ \t]+(\w+)', 1) as l from c)
select chunk_id, 'Code (' || case when lang <> '' then lang else 'text' end || '): ' || array_to_string(list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, 8), ', ') || chr(10) || array_to_string(string_split(body, chr(10))[1:3], chr(10)) as digest from n""")
def code_digests(t):
    return t("chunks").select("chunk_id", T.code_digest(F.col("text_md")).alias("digest")).where("digest is not null").distinct()


def _picky():
    """A provider that fails on texts with cells, and with them on the whole batch."""

    def call(texts: list[str]) -> list[list[float]]:
        if any("|" in t for t in texts):
            raise RuntimeError("cells")
        return [[float(len(t) % 97), 1.0] for t in texts]

    return call


@query("embedding_failures", "with c as (select chunk_id, min(text_md) as x from chunks where chunk_id is not null group by chunk_id) select chunk_id, contains(coalesce(x, ''), '|') as failed, cast(case when contains(coalesce(x, ''), '|') then 0 else length(coalesce(x, '')) % 97 end as double) as first, cast(case when contains(coalesce(x, ''), '|') then 0 else 1 end as double) as second from c")
def embedding_failures(t):
    """A provider that fails on some texts: the others of their batches are embedded alone, the failed ones get zero vectors."""
    B.register("picky", _picky)
    c = t("chunks").where("chunk_id is not null").groupBy("chunk_id").agg(F.min("text_md").alias("text_md"))
    e = B.embed(c, "picky", 2, 64)
    return e.select("chunk_id", "failed", F.col("embedding")[0].cast("double").alias("first"), F.col("embedding")[1].cast("double").alias("second"))


_CUT = "2024-09-01 00:00:00"


@query("manifest_changes", f"with e as (select distinct chunk_id, provider, dim, created_at from chunk_embeddings where provider is not null), b as (select provider, max(dim) as dimension, count(*) as n from e where created_at < timestamp '{_CUT}' group by provider), a as (select provider, max(dim) as dimension, count(*) as n from e group by provider) select a.provider as run_id, case when b.provider is null then 'new' else array_to_string(list_filter([case when a.dimension is distinct from b.dimension then 'dimension' end, case when a.n <> b.n then 'chunk_count' end], lambda x: x is not null), ',') end as reasons from a left join b using (provider) where b.provider is null or a.dimension is distinct from b.dimension or a.n <> b.n")
def manifest_changes(t):
    """Providers whose vectors have changed in kind or number since a day: these must be embedded anew."""
    e = t("chunk_embeddings").where("provider is not null").select("chunk_id", "provider", "dim", "created_at").distinct()
    none = F.lit(None).cast("string")
    manifest = lambda rows: rows.groupBy(F.col("provider").alias("run_id")).agg(F.max("dim").alias("dimension"), F.count(F.lit(1)).alias("chunk_count")).select("run_id", F.col("run_id").alias("provider"), none.alias("model"), "dimension", F.lit("four characters").alias("tokenizer"), F.lit("layers").alias("chunker"), "chunk_count", none.alias("set_hash"))
    return B.manifest_changes(manifest(e.where(F.col("created_at") < F.lit(_CUT).cast("timestamp"))), manifest(e))


@query("ndjson_records", "select doc_id, version, title, 'r7' as run_id, 0 as malformed from kb_documents union all select null, null, null, null, 2")
def ndjson_records(t):
    """The loads written as NDJSON and read again with the run of their folder, beside two malformed lines, which are counted."""
    k = t("kb_documents").select("doc_id", "version", "title")
    at = f"{ensure_checkpoint_dir(k.sparkSession)}/ndjson/{uuid.uuid4()}/runs/r7"
    write_ndjson(k, f"{at}/pages")
    k.sparkSession.createDataFrame([("{broken",), ("  ",), ("[1",)], "value string").coalesce(1).write.text(f"{at}/odd")
    rows, bad = read_ndjson(k.sparkSession, [f"{at}/pages", f"{at}/odd"], "doc_id string, version int, title string")
    none = [F.lit(None).cast(x).alias(n) for n, x in (("doc_id", "string"), ("version", "int"), ("title", "string"), ("run_id", "string"))]
    return rows.select("doc_id", "version", "title", "run_id", F.lit(0).cast("bigint").alias("malformed")).unionByName(bad.agg(F.count(F.lit(1)).alias("malformed")).select(*none, "malformed"))
