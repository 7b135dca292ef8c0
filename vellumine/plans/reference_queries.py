"""Queries on references."""

from __future__ import annotations

from vellumine.operators import references
from vellumine.plans.registry import query

_WS = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _key(c: str) -> str:
    return f"nullif(lower(regexp_replace({c}, '^{_WS}|{_WS}$', '', 'g')), '')"


P4_SQL = f"""
with loads as (select distinct {_key('doc_id')} as k, loaded_at as t from kb_documents where loaded_at is not null),
gone as (select distinct {_key('page_id')} as k, deleted_at as t from deleted_pages where deleted_at is not null),
made as (select {_key('chunk_id')} as k, min(emitted_at) as t from chunks group by 1),
refs as (
  select distinct 'chunks' as ref_table, chunk_id as ref_key, {_key('doc_id')} as k, emitted_at as t from chunks
  union all select distinct 'link_refs', cast(link_id as varchar), {_key('target_page_id')}, seen_at from link_refs),
seen as (select ref_table, ref_key, r.k, r.t, max(l.t) as last from (select * from refs where k is not null) r left join loads l on l.k = r.k and (r.t is null or l.t <= r.t) group by all),
lost as (
  select ref_table, ref_key, t from seen s where last is null
     or t is not null and exists (select 1 from gone g where g.k = s.k and g.t >= s.last and g.t <= s.t)
  union all
  select 'chunk_embeddings', e.chunk_id || '|' || e.provider, e.created_at from chunk_embeddings e left join made m on m.k = {_key('e.chunk_id')}
  where {_key('e.chunk_id')} is not null and not coalesce(m.t <= e.created_at or (e.created_at is null and m.t is not null), false))
"""


@query("p4_found", P4_SQL + "select distinct ref_table, ref_key, strftime(t, '%Y-%m') as period from lost")
def p4_found(t):
    return references.orphan_references(*(t(x) for x in ("kb_documents", "deleted_pages", "chunks", "chunk_embeddings", "link_refs")))


@query("p4_counts", P4_SQL + "select ref_table, period, count(*) as orphans from (select distinct ref_table, ref_key, strftime(t, '%Y-%m') as period from lost) group by all")
def p4_counts(t):
    return references.orphan_counts(p4_found(t))
