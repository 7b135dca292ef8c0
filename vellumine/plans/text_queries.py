"""Queries on texts, URLs and hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumine.functions import hashes as H
from vellumine.functions import text as T
from vellumine.functions import urls as U
from vellumine.functions import vectors as V
from vellumine.operators import sections as S
from vellumine.operators.retrieval import latest
from vellumine.plans.registry import query

W = T.WS
BASE = "https://wiki.example.invalid"
# The statistics of documents.text in SQL, which several queries use.
ENRICHED = rf"""
d as (select distinct doc_id, coalesce(text, '') as t, space_key, source from documents),
m as (select doc_id, t, space_key, source,
  len(regexp_extract_all(t, '[^{W}]+')) as word_count, length(t) as char_count,
  len(regexp_extract_all(t, '(?m)^#+[ \t]')) as heading_count, len(regexp_extract_all(t, '(?m)^[ \t]*[-*+][ \t]+')) as list_count,
  len(regexp_extract_all(t, '\[[^\]\n]*\]\([^)\n]*\)')) as link_count, len(regexp_extract_all(t, '```')) // 2 as code_blocks,
  len(regexp_extract_all(t, '\|[^\n]*\|')) as tables, len(regexp_extract_all(t, '!\[[^\]\n]*\]')) as images,
  len(regexp_extract_all(t, '\[[^\]\n]*\]\((?:[ \t]*|#)\)')) as broken,
  regexp_replace(t, '[#*`\[\]()_]', '', 'g') as clean from d),
f as (select *, list_filter([case when word_count = 0 then 'empty_body' end, case when word_count < 10 then 'too_short' when word_count > 10000 then 'too_long' end,
  case when word_count > 200 and heading_count = 0 then 'no_structure' end, case when broken > 0 then 'broken_links' end], lambda x: x is not null) as flags,
  least(1.0, heading_count / greatest(1.0, word_count / 200.0)) as structure_score from m),
q as (select *, greatest(0.0, 1.0
    - case when list_contains(flags, 'empty_body') then 1.0 else 0 end) as s1 from f),
q2 as (select *, greatest(0.0, s1 - case when list_contains(flags, 'too_short') then 0.6 when list_contains(flags, 'too_long') then 0.2 else 0 end) as s2 from q),
q3 as (select *, greatest(0.0, s2 - case when list_contains(flags, 'no_structure') then 0.3 else 0 end) as s3 from q2),
q4 as (select *, greatest(0.0, s3 - case when list_contains(flags, 'broken_links') then 0.1 else 0 end) as s4 from q3),
q5 as (select *, case when structure_score > 0.1 then least(1.0, s4 + 0.1) else s4 end as s5 from q4),
e as (select *, round(case when word_count between 50 and 2000 then least(1.0, s5 + 0.1) else s5 end, 3) as quality_score from q5)
"""


def enriched(t):
    """Statistics, flags and score of every document; stored counts aren't read."""
    c, col = F.col("text"), F.col
    d = t("documents").select("doc_id", "text", "space_key", "source").distinct()
    # each pattern runs once per text; what follows is arithmetic on its counts
    d = d.select("*", T.word_count(c).alias("word_count"), F.length(T.text_of(c)).alias("char_count"), T.count(c, T.HEADING).alias("heading_count"), T.count(c, T.IMAGE).alias("image_count"), T.count(c, T.BROKEN_LINK).alias("broken_count"))
    d = d.select("*", T.flags_of(col("word_count"), col("heading_count"), col("image_count"), col("broken_count"), F.lit(0)).alias("flags"), T.structure_of(col("word_count"), col("heading_count")).alias("structure"))
    return d.withColumn("quality_score", T.quality_score(col("flags"), col("structure"), col("word_count")))


@query("doc_quality_enrich", f"with {ENRICHED} select doc_id, word_count, char_count, heading_count, list_count, link_count, code_blocks, tables, round(structure_score, 6) as structure_score, array_to_string(flags, ',') as quality_flags, cast(quality_score as double) as quality_score from e")
def doc_quality_enrich(t):
    return enriched(t).select("doc_id", "word_count", "char_count", "heading_count", T.count(F.col("text"), T.LIST_ITEM).alias("list_count"), T.count(F.col("text"), T.LINK).alias("link_count"), F.floor(T.count(F.col("text"), "```") / 2).alias("code_blocks"), T.count(F.col("text"), T.TABLE_LINE).alias("tables"), F.round("structure", 6).alias("structure_score"), F.array_join("flags", ",").alias("quality_flags"), "quality_score")


@query("doc_readability", rf"""with {ENRICHED}, p as (select doc_id, clean, t, heading_count, len(regexp_extract_all(clean, '[^{W}]+')) as w, length(regexp_replace(clean, '[{W}]+', '', 'g')) as c,
  len(list_filter(regexp_split_to_array(t, '\n[ \t\r\f]*\n[ \t\r\n\f]*|^#'), lambda x: regexp_matches(x, '[^{W}]'))) as p, images, link_count from e)
select doc_id, round(case when w > 0 then c / w else 0 end, 6) as chars_per_word, round(case when p > 0 then w / p else 0 end, 6) as words_per_paragraph, round(case when p > 0 then heading_count / p else 0 end, 6) as heading_ratio,
  round(case when length(t) > 0 then images * 1000.0 / length(t) else 0 end, 6) as media_density, round(case when length(t) > 0 then link_count * 1000.0 / length(t) else 0 end, 6) as link_density from p""")
def doc_readability(t):
    d = t("documents").select("doc_id", "text", "space_key", "source").distinct()
    r = T.readability(F.col("text"))
    return d.select("doc_id", *[F.round(c, 6).alias(n) for n, c in r.items()], F.round(T.media_density(F.col("text"), F.lit(0)), 6).alias("media_density"), F.round(T.link_density(F.col("text"), F.lit(0)), 6).alias("link_density"))


@query("quality_flag_counts", f"with {ENRICHED}, x as (select unnest(flags) as flag from e) select flag, count(*) as documents from x group by flag")
def quality_flag_counts(t):
    return enriched(t).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("documents"))


@query("normalized_text", rf"select distinct doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', '\n', 'g'), '\n{{3,}}', '\n\n', 'g'), '^[{W}]+|[{W}]+$', '', 'g') as text, length(coalesce(text, '')) // 4 as tokens from documents".replace("'\\n'", "chr(10)").replace("'\\n\\n'", "chr(10) || chr(10)"))
def normalized_text(t):
    return t("documents").select("doc_id", T.normalize_text(F.col("text")).alias("text"), T.count_tokens(F.col("text")).alias("tokens")).distinct()


@query("doc_summary", r"""select distinct doc_id, case when length(s) > 300 then s[1:297] || '...' else s end as summary from (
  select doc_id, regexp_replace(regexp_split_to_array(coalesce(text, ''), '[.!?][ \t\r\n\f]+')[1], '^[@]+|[@]+$', '', 'g') as s from documents)""".replace("@", W))
def doc_summary(t):
    return t("documents").select("doc_id", T.summary(F.col("text")).alias("summary")).distinct()


@query("doc_keywords", rf"""select distinct doc_id, array_to_string(list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, 8), ',') as keywords from (
  select doc_id, list_concat(list_filter(w, lambda x: regexp_matches(x, '^[A-Z][a-z]+$')), list_filter(w, lambda x: regexp_matches(x, '^(?i:{T.TECH_TERMS})$'))) as l from (select doc_id, regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}_]+') as w from documents))""")
def doc_keywords(t):
    return t("documents").select("doc_id", F.array_join(T.keywords(F.col("text")), ",").alias("keywords")).distinct()


_TAX = ", ".join("case when " + " or ".join(f"contains(l, '{x}')" for x in terms) + f" then '{label}' end" for label, terms in T.TAXONOMY.items())


@query("doc_taxonomy", f"select distinct doc_id, array_to_string(list_slice(list_filter([{_TAX}, case when length(source) > 0 then 'source-' || source end], lambda x: x is not null), 1, 5), ',') as labels from (select doc_id, source, lower(coalesce(text, '')) as l from documents)")
def doc_taxonomy(t):
    return t("documents").select("doc_id", F.array_join(T.taxonomy(F.col("text"), F.col("source")), ",").alias("labels")).distinct()


@query("doc_collections", r"""with k as (select distinct doc_id, title, space_key, url, source_system from kb_documents)
select distinct doc_id, coalesce(lower(nullif(space_key, '')), source_system, 'unknown') as collection, array_to_string(list_filter([lower(nullif(regexp_extract(coalesce(url, ''), '/spaces/([^/]*)/pages/[^/]*', 1), ''))], lambda x: x is not null), ',') as path_tags,
  case when contains(lower(coalesce(url, '')), 'confluence') then 'confluence' when contains(lower(coalesce(url, '')), 'dita') or contains(lower(coalesce(url, '')), '.xml') then 'dita' else 'unknown' end as inferred from k""")
def doc_collections(t):
    k = t("kb_documents").select("doc_id", "title", "space_key", "url", "source_system").distinct()
    return k.select("doc_id", T.collection(F.lit(None).cast("string"), F.col("space_key"), F.col("source_system")).alias("collection"), F.array_join(T.path_tags(F.array(F.col("title")), F.col("url"), F.lit("")), ",").alias("path_tags"), U.source_system(F.col("url")).alias("inferred")).distinct()


@query("content_types", rf"""select chunk_id, case when regexp_matches(s, '\|[^\n]*\|[^\n]*\|') or regexp_matches(s, '(?is)<table.*?</table>') or structured then 'table' when regexp_matches(s, '(?m)^```\w*\n(?:[^`]|`[^`]|``[^`])*?\n?^```$') then 'code'
  when len(regexp_extract_all(s, '\{{[^}}]+\}}')) + len(regexp_extract_all(s, '(?i)<ac:[^>]+[/>]')) + len(regexp_extract_all(s, '\[\w+:[^\]]+\]')) + len(regexp_extract_all(s, '<!-- [^\n]* -->')) > 3 then 'macro' else 'text' end as content_type
from (select chunk_id, s, len(string_split(s, chr(10))) > 10 and len(l) > 20 and len(list_filter(list_distinct(o), lambda y: len(list_filter(o, lambda z: z = y)) > 2)) > 3 as structured
  from (select *, list_filter(l[1:50], lambda x: not regexp_matches(x, '[{W}]') and not starts_with(x, '#')) as o from (select *, list_filter(list_transform(string_split(s, chr(10)), lambda x: regexp_replace(x, '^[{W}]+|[{W}]+$', '', 'g')), lambda x: x <> '') as l
  from (select distinct chunk_id, regexp_replace(coalesce(text_md, ''), '^[{W}]+|[{W}]+$', '', 'g') as s from chunks))))""")
def content_types(t):
    return t("chunks").select("chunk_id", "text_md").distinct().select("chunk_id", T.content_type(F.col("text_md")).alias("content_type")).distinct()


@query("doc_fingerprints", rf"""select distinct doc_id, sha256(array_to_string([regexp_replace(regexp_replace(coalesce(text, ''), '^[{W}]+|[{W}]+$', '', 'g'), '[{W}]+', ' ', 'g'), coalesce(source, chr(0)), coalesce(space_key, chr(0))], chr(31))) as fingerprint,
  sha256(coalesce(text, '') || '|' || coalesce(source, '') || '|' || coalesce(space_key, '')) as content_hash from documents""")
def doc_fingerprints(t):
    return t("documents").select("doc_id", H.fingerprint(F.col("text"), F.col("source"), F.col("space_key")).alias("fingerprint"), H.content_hash(F.col("text"), F.col("source"), F.col("space_key")).alias("content_hash")).distinct()


@query("dummy_embedding", rf"""with h as (select distinct chunk_id, sha256(lower(regexp_replace(coalesce(text_md, ''), '^[{W}]+|[{W}]+$', '', 'g'))) as x from chunks),
v as (select chunk_id, list_transform(range(0, 8), lambda i: (('0x' || x[8*i+7:8*i+8] || x[8*i+5:8*i+6] || x[8*i+3:8*i+4] || x[8*i+1:8*i+2])::UBIGINT / 4294967296.0)::FLOAT) as e from h)
select chunk_id, list_concat(e, e[1:4]) as embedding from v""")
def dummy_embedding(t):
    return t("chunks").select("chunk_id", H.dummy_embedding(F.col("text_md"), 12).alias("embedding")).distinct()


@query("section_map", r"""with d as (select distinct doc_id, text from documents where length(text) > 0), l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n, len(string_split(text, chr(10))) as last from d),
p as (select *, length(line) + case when n < last then 1 else 0 end as size, coalesce(sum(length(line) + 1) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0) as pos from l)
select doc_id, cast(pos as bigint) as start_char, cast(pos + size as bigint) as end_char, length(regexp_extract(trim(line, E' \t\r\f'), '^(#{1,6})[ \t]+[^ \t]', 1)) as level, trim(regexp_extract(trim(line, E' \t\r\f'), '^#{1,6}[ \t]+(.*)$', 1), E' \t\r\f') as heading, cast(pos // 4 as bigint) as token_start, cast(pos // 4 + greatest(1, size // 4) as bigint) as token_end
from p where regexp_matches(trim(line, E' \t\r\f'), '^#{1,6}[ \t]+[^ \t]')""")
def section_map(t):
    return S.section_map(t("documents").select("doc_id", "text").distinct(), "doc_id", "text")


@query("soft_boundaries", r"""with d as (select distinct doc_id, text from documents where length(text) > 0), l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n, len(string_split(text, chr(10))) as last from d),
p as (select *, trim(line, E' \t\r\f') as s, lag(trim(line, E' \t\r\f')) over w as b, lead(trim(line, E' \t\r\f')) over w as a, coalesce(sum(length(line) + 1) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0) as pos from l window w as (partition by doc_id order by n))
select doc_id, cast(pos as bigint) as place, case when regexp_matches(s, '^#{1,6}[ \t]+') then 'heading' when s = '' then 'paragraph' else 'item' end as kind from p
where regexp_matches(s, '^#{1,6}[ \t]+') or (s = '' and b <> '' and a <> '') or regexp_matches(line, '^[ \t]*([-*+]|[0-9]+\.)[ \t]+')""")
def soft_boundaries(t):
    return S.soft_boundaries(t("documents").select("doc_id", "text").distinct(), "doc_id", "text")


@query("heading_split", r"""with d as (select distinct doc_id, regexp_replace(text, '(\n)(#+[ \t])', E'\\1\x01\\2', 'g') as x from documents where length(text) > 0), l as (select doc_id, unnest(string_split(x, E'\n\x01')) as piece, generate_subscripts(string_split(x, E'\n\x01'), 1) as part from d)
select doc_id, part, md5(piece) as piece_md5, length(piece) as size from l where regexp_matches(piece, '[^@]')""".replace("@", W))
def heading_split(t):
    return S.split_rows(t("documents").select("doc_id", "text").distinct(), "doc_id", "text", "\n(?=#+[ \t])")


@query("paragraph_split", r"""with d as (select distinct doc_id, text as x from documents where length(text) > 0), l as (select doc_id, unnest(regexp_split_to_array(x, '\n[ \t\r\f]*\n[ \t\r\n\f]*')) as piece, generate_subscripts(regexp_split_to_array(x, '\n[ \t\r\f]*\n[ \t\r\n\f]*'), 1) as part from d)
select doc_id, part, md5(piece) as piece_md5, length(piece) as size from l where regexp_matches(piece, '[^@]')""".replace("@", W))
def paragraph_split(t):
    return S.split_rows(t("documents").select("doc_id", "text").distinct(), "doc_id", "text", r"\n[ \t\r\f]*\n[ \t\r\n\f]*")


@query("sentence_split", r"""with d as (select distinct doc_id, regexp_replace(text, '([.!?])[ \t\r\n\f]+', E'\\1\x01', 'g') as x from documents where length(text) > 0), l as (select doc_id, unnest(string_split(x, E'\x01')) as piece, generate_subscripts(string_split(x, E'\x01'), 1) as part from d)
select doc_id, part, md5(piece) as piece_md5, length(piece) as size from l where regexp_matches(piece, '[^@]')""".replace("@", W))
def sentence_split(t):
    return S.split_rows(t("documents").select("doc_id", "text").distinct(), "doc_id", "text", r"(?<=[.!?])[ \t\r\n\f]+")


@query("canon_slugs", rf"""with k as (select distinct doc_id, title, url, coalesce(nullif(regexp_extract(coalesce(url, ''), '/pages/[0-9]+/([^/?]+)', 1), ''), nullif(regexp_extract(coalesce(url, ''), '/([^/]+?)(?:\.(?:md|txt|rst))?/?$', 1), '')) as tail from kb_documents),
c as (select doc_id, trim(regexp_replace(translate(lower(coalesce(title, '')), '{T.ACCENTED}', '{T.PLAIN}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ') as canon, trim(regexp_replace(translate(lower(coalesce(tail, title, '')), '{T.ACCENTED}', '{T.PLAIN}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ') as slug,
  regexp_replace(regexp_replace(regexp_replace(coalesce(title, ''), '[^A-Za-z0-9_\-]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') as query_slug from k) select distinct * from c""")
def canon_slugs(t):
    k = t("kb_documents").select("doc_id", "title", "url").distinct()
    return k.select("doc_id", T.canon(F.col("title")).alias("canon"), T.doc_slug(F.col("url"), F.col("title")).alias("slug"), T.query_slug(F.col("title")).alias("query_slug")).distinct()


@query("urls_normalized", r"""with u as (select distinct link_id, coalesce(target_url, 'https://h.example.invalid/p') || case link_id % 4 when 0 then '?utm_source=a&x=1' when 1 then '?x=1&x=2&fbclid=z&y=' when 2 then '?gclid=q#part' else '' end as raw, target_url from link_refs),
p as (select *, regexp_extract(raw, '^([^?#]*)', 1) as base, regexp_extract(raw, '^[^?#]*\?([^#]*)', 1) as q, regexp_extract(raw, '(#.*)$', 1) as frag from u),
k as (select *, list_filter(string_split(q, '&'), lambda x: x <> '' and not list_contains(['utm_source','utm_medium','utm_campaign','utm_term','utm_content','fbclid','gclid','mc_cid','mc_eid','_ga','_gl'], split_part(x, '=', 1))) as kept from p),
f as (select *, list_transform(list_filter(kept, lambda x, i: list_position(list_transform(kept, lambda z: split_part(z, '=', 1)), split_part(x, '=', 1)) = i), lambda x: regexp_replace(x, '=$', '')) as once from k)
select link_id, case when q = '' then raw else base || case when len(once) > 0 then '?' || array_to_string(once, '&') else '' end || frag end as url,
  case when target_url is null or target_url = '' then 'external' when starts_with(target_url, '/') then 'other' when lower(regexp_extract(target_url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) <> 'wiki.example.invalid' then 'external'
    when regexp_matches(lower(target_url), '/download/attachments/') then 'attachment' when regexp_matches(lower(target_url), '/(spaces|pages|wiki)/') then 'confluence' else 'external' end as kind,
  coalesce(nullif(regexp_extract(coalesce(target_url, ''), '/spaces/[^/]+/pages/([0-9]+)', 1), ''), nullif(regexp_extract(coalesce(target_url, ''), '[?&]pageId=([0-9]+)', 1), '')) as page_id from f""")
def urls_normalized(t):
    r = t("link_refs").select("link_id", "target_url").distinct()
    tail = F.when(F.col("link_id") % 4 == 0, "?utm_source=a&x=1").when(F.col("link_id") % 4 == 1, "?x=1&x=2&fbclid=z&y=").when(F.col("link_id") % 4 == 2, "?gclid=q#part").otherwise("")
    raw = F.concat(F.coalesce("target_url", F.lit("https://h.example.invalid/p")), tail)
    return r.select("link_id", U.normalize_url(raw).alias("url"), U.link_type(F.col("target_url"), BASE).alias("kind"), U.page_id(F.col("target_url")).alias("page_id"))


@query("link_class_stats", r"""with l as (select distinct link_id, from_page_id, target_type, target_page_id from link_refs)
select target_type, count(*) as links, count(distinct from_page_id) as pages, cast(sum(case when length(trim(target_page_id)) > 0 then 1 else 0 end) as bigint) as resolved, cast(sum(case when target_type = 'confluence' and coalesce(length(trim(target_page_id)), 0) = 0 then 1 else 0 end) as bigint) as unresolved from l group by target_type""")
def link_class_stats(t):
    links = t("link_refs").select("link_id", "from_page_id", "target_type", "target_page_id").distinct()
    empty = F.coalesce(F.length(F.trim("target_page_id")), F.lit(0)) == 0
    return links.groupBy("target_type").agg(F.count(F.lit(1)).alias("links"), F.countDistinct("from_page_id").alias("pages"), F.count_if(~empty).alias("resolved"), F.count_if(empty & (F.col("target_type") == "confluence")).alias("unresolved"))


@query("title_boosts", rf"""with k as (select doc_id, max_by(title, (version, loaded_at)) as title from kb_documents where title is not null group by doc_id)
select doc_id, round(case when contains(lower(title), 'methodology') then 0.2 when contains(lower(title), 'playbook') then 0.15 when contains(lower(title), 'runbook') then 0.1 else 0 end - case when regexp_matches(lower(title), '\b({V.MONTHS})\b|\b20\d\d\b') then 0.1 else 0 end, 6) as boost,
  regexp_matches(lower(title), '\b(overview|steps|background)\b') as process from k""")
def title_boosts(t):
    k = latest(t("kb_documents").where("title is not null").select("doc_id", "title", "version", "loaded_at"), "doc_id", "version", "loaded_at")
    return k.select("doc_id", F.round(V.boost(F.col("title")), 6).alias("boost"), F.lower("title").rlike(r"\b(overview|steps|background)\b").alias("process"))


@query("token_truncation", "select distinct chunk_id, case when length(text_md) <= 403 then text_md else text_md[1:400] || '...' end as text_md from chunks where text_md is not null")
def token_truncation(t):
    return t("chunks").where("text_md is not null").select("chunk_id", T.truncate_tokens(F.col("text_md"), 100, "...").alias("text_md")).distinct()


@query("orphan_headings", rf"""select distinct chunk_id from (select chunk_id, list_filter(string_split(coalesce(text_md, ''), chr(10)), lambda x: regexp_matches(x, '[^{W}]')) as l from chunks) where len(l) = 0 or len(l) = 1 and regexp_matches(l[1], '^[ \t]*#')""")
def orphan_headings(t):
    return t("chunks").where(T.orphan_heading(F.col("text_md"))).select("chunk_id").distinct()


@query("suggested_edges", r"""with k as (select doc_id, max_by(title, (version, loaded_at)) as title from kb_documents where title is not null group by doc_id),
w as (select distinct doc_id, unnest(list_filter(regexp_extract_all(lower(title), '[\p{L}\p{N}_]+'), lambda x: length(x) >= 4)) as word from k),
p as (select a.doc_id as src, b.doc_id as dst, count(*) as shared, array_to_string(list_slice(list_sort(list(a.word)), 1, 5), ',') as evidence from w a join w b on a.word = b.word and a.doc_id < b.doc_id group by all)
select src, dst, 'RELATES_TO' as type, round(least(0.7, shared / 20.0), 6) as confidence, evidence from p where shared >= 2""")
def suggested_edges(t):
    """Titles that share words; the whole table, joined on the word."""
    k = latest(t("kb_documents").where("title is not null").select("doc_id", "title", "version", "loaded_at"), "doc_id", "version", "loaded_at")
    return S.related(k, "doc_id", "title", least=2)


@query("suggested_edges_text", r"""with w as (select distinct doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda x: length(x) >= 4)) as word from documents where doc_id is not null),
p as (select a.doc_id as src, b.doc_id as dst, count(*) as shared, array_to_string(list_slice(list_sort(list(a.word)), 1, 5), ',') as evidence from w a join w b on a.word = b.word and a.doc_id < b.doc_id group by all)
select src, dst, 'RELATES_TO' as type, round(least(0.7, shared / 20.0), 6) as confidence, evidence from p where shared >= 3""")
def suggested_edges_text(t):
    """Whole texts that share words; block against block."""
    return S.related_texts(t("documents"), "doc_id", "text")
