"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumine.llm import encoding, languages, leakage, nearduplicates, quality, splitting, vectors
from vellumine.session import ensure_shipped, table

WHITE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_shipped(spark)
            return f(lambda t: table(spark, sf_dir, t))

        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("p1_found", f"select distinct chunk_id from chunks where length(text_md) > 6000 or len(regexp_extract_all(text_md, '[^{WHITE}]+')) > 800")
def p1_found(t):
    return splitting.found(t("chunks"))


@query("p1_pieces")
def p1_pieces(t):
    return splitting.split_oversized(t("chunks")).withColumnRenamed("key", "chunk_id")


@query("p1_check", f"with c as (select distinct chunk_id, text_md from chunks where length(text_md) > 6000 or len(regexp_extract_all(text_md, '[^{WHITE}]+')) > 800) select chunk_id, len(regexp_extract_all(text_md, '[^{WHITE}]+')) as tokens, true as within, true as exact, true as whole from c")
def p1_check(t):
    """Every oversized chunk: its tokens; are its pieces within the limits, exact slices of it, and do they cover it with overlaps of at most 60 tokens?"""
    texts = t("chunks").select("chunk_id", "text_md").distinct()
    p = splitting.split_oversized(texts).join(texts.withColumnsRenamed({"chunk_id": "key", "text_md": "full"}), "key")
    w = Window.partitionBy("key").orderBy("char_start")
    count = lambda c: F.regexp_count(c, F.lit(f"[^{WHITE}]+"))
    end, before = F.col("char_start") + F.length("text_md"), F.coalesce(F.lag("end").over(w), F.lit(0))
    p = p.withColumn("end", end).withColumn("before", before).withColumn("next", F.lead("char_start").over(w))
    part = lambda a, b: F.substring("full", a + 1, F.greatest(b - a, F.lit(0)))
    gap, shared = count(part(F.col("before"), F.col("char_start"))), count(part(F.col("char_start"), F.least("before", "end")))
    tail = F.when(F.col("next").isNull(), count(part(F.col("end"), F.length("full")))).otherwise(0)
    within = (F.length("text_md") <= splitting.MAX_CHARS) & (F.col("token_count") <= splitting.MAX_TOKENS) & (F.col("token_count") == count(F.col("text_md")))
    return p.groupBy(F.col("key").alias("chunk_id"), count(F.col("full")).alias("tokens")).agg(F.bool_and(within).alias("within"), F.bool_and(part(F.col("char_start"), F.col("end")) == F.col("text_md")).alias("exact"), F.bool_and((gap == 0) & (shared <= 60) & (tail == 0)).alias("whole"))


@query("p2_found")
def p2_found(t):
    return quality.found(t("chunks"))


_COMMON = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.COMMON))
_BREAKS = r"[\n\x0b\x0c\r\x{85}\x{2028}\x{2029}]+"
_STATS_SQL = rf"""
with c as (select chunk_id, text_md as x, regexp_extract_all(text_md, '[\p{{L}}\p{{N}}]+') as w, list_filter(regexp_split_to_array(text_md, '{_BREAKS}'), lambda l: regexp_matches(l, '[^{WHITE}]')) as lines,
  length(regexp_replace(text_md, '[{WHITE}]+', '', 'g')) as visible, length(regexp_replace(text_md, '[{WHITE}\p{{L}}\p{{N}}]+', '', 'g')) as symbols from chunks)
select chunk_id, len(w) as word_count, round(case when x is null then null else coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) / greatest(1, len(w)) end, 6) as mean_word_length, round(symbols / greatest(1, visible), 6) as symbol_ratio,
  round(len(list_filter(lines, lambda l: regexp_matches(l, '[.!?。！？…:;"''”’»)\]」』][{WHITE}]*$'))) / greatest(1, len(lines)), 6) as punct_line_share,
  round(len(list_filter(w, lambda y: list_contains([{_COMMON}], lower(y)))) / greatest(1, len(w)), 6) as common_word_share from c"""


@query("p2_statistics", _STATS_SQL)
def p2_statistics(t):
    """The statistics of every chunk; the kinds that the model makes of its lines are p2_found's and p2_kind_counts'."""
    q = quality.text_quality(t("chunks").select("chunk_id", "text_md"))
    return q.select(F.col("key").alias("chunk_id"), "word_count", *[F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "punct_line_share", "common_word_share")])


@query("p2_kind_counts")
def p2_kind_counts(t):
    return quality.text_quality(t("chunks")).groupBy("kind").agg(F.count(F.lit(1)).alias("chunks"), F.round(F.avg("word_count"), 4).alias("avg_words"))


_SHINGLE_SQL = r"""
with w as (select distinct chunk_id, text_md, list_transform(regexp_extract_all(text_md, '[\p{L}\p{N}]+'), lambda x: lower(x)) as words from chunks where text_md is not null and chunk_id is not null),
k as (select chunk_id, row_number() over () as rid, words from w where len(words) >= greatest(@m, @n)),
s as (select distinct rid, chunk_id, array_to_string(list_slice(words, i, i + @n - 1), ' ') as g from (select rid, chunk_id, words, unnest(range(1, len(words) - @n + 2)) as i from k)),
c as (select rid, count(*) as n from s group by rid),
p as (select a.rid as ra, b.rid as rb, a.chunk_id as ca, b.chunk_id as cb, count(*) as shared from s a join s b on a.g = b.g and a.rid < b.rid group by all),
j as (select ra, rb, ca, cb, shared / (x.n + y.n - shared) as similarity from p join c x on x.rid = ra join c y on y.rid = rb)
"""


def _shingle_sql(n: int, m: int) -> str:
    return _SHINGLE_SQL.replace("@n", str(n)).replace("@m", str(m))


@query("p3_found", _shingle_sql(3, 30) + "select distinct least(ca, cb) as chunk_id_a, greatest(ca, cb) as chunk_id_b from j where ca <> cb and similarity >= 0.6")
def p3_found(t):
    return nearduplicates.found(t("chunks"))


_LINKS_SQL = r"""
with w as (select distinct chunk_id, list_transform(regexp_extract_all(text_md, '[\p{L}\p{N}]+'), lambda x: lower(x)) as words from chunks where text_md is not null and chunk_id is not null),
m as (select chunk_id, array_to_string(words, ' ') as cls from w where len(words) >= 5),
k as (select cls, min(chunk_id) as rep, string_split(cls, ' ') as words from m group by cls),
s as (select distinct rep, array_to_string(list_slice(words, i, i + 4), ' ') as g from (select rep, words, unnest(range(1, len(words) - 3)) as i from k)),
c as (select rep, count(*) as n from s group by rep),
p as (select a.rep as ra, b.rep as rb, count(*) as shared from s a join s b on a.g = b.g and a.rep <> b.rep group by all),
d as (select ra as rep, count(*) as links from p join c x on x.rep = ra join c y on y.rep = rb where shared / (x.n + y.n - shared) >= 0.8 group by ra)
select chunk_id, k.rep as class, coalesce(links, 0) as links from m join k using (cls) left join d on d.rep = k.rep
"""


@query("p3_links", _LINKS_SQL)
def p3_links(t):
    """Five words and a similarity of 0.8: one row per chunk with its class, named by its smallest chunk, and the number of other classes linked to it."""
    rows = nearduplicates.near_duplicate_links(t("chunks"))
    names = rows.groupBy("cls").agg(F.min("key").alias("class"))
    return rows.join(names, "cls").select(F.col("key").alias("chunk_id"), "class", "links")


_VEC_SQL = """
with v as (select distinct provider, chunk_id, cast(embedding as double[]) as e from chunk_embeddings
  where chunk_id is not null and provider is not null and len(embedding) = dim and dim > 0
  and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select a.provider, a.chunk_id as a, b.chunk_id as b, list_cosine_similarity(a.e, b.e) as c from v a join v b on a.provider = b.provider and len(a.e) = len(b.e) and a.chunk_id <> b.chunk_id @where),
r as (select *, row_number() over (partition by provider, a order by c desc, b) as rank from s)
"""


@query("p5_found", _VEC_SQL.replace("@where", "") + "select distinct provider, least(a, b) as chunk_id_a, greatest(a, b) as chunk_id_b from r where rank <= 5 and c >= 0.9")
def p5_found(t):
    return vectors.found(t("chunk_embeddings"))


# The vectors of chunks whose page has a number divisible by 100 ask, against all.
_ASK_SQL = _VEC_SQL.replace("@where", "where try_cast(split_part(a.chunk_id, ':', 1) as bigint) % 100 = 0")


def _asking(e: DataFrame) -> DataFrame:
    return e.where("try_cast(split_part(chunk_id, ':', 1) as bigint) % 100 = 0").select(F.col("chunk_id").alias("key")).distinct()


@query("p5_neighbours", _ASK_SQL + "select provider, a as chunk_id, b as neighbour, rank from r where rank <= 5")
def p5_neighbours(t):
    """The five most similar of every vector of every hundredth page, exactly (factor one), against all."""
    e = t("chunk_embeddings")
    near = vectors.similar_vectors(e, k=5, across=1.0, within=1.0, queries=_asking(e))
    return near.select("provider", F.col("key").alias("chunk_id"), "neighbour", "rank")


@query("p5_recall", _ASK_SQL + "select provider, count(distinct a) as queries, count(distinct (a, b)) as expected, true as enough from r where rank <= 5 group by provider")
def p5_recall(t):
    """As p5_neighbours, with the relaxed factors that hold where no least cosine is given, in shards of 200 vectors so that
    there are several: enough says that the recall is 0.9 or more."""
    e = t("chunk_embeddings")
    return vectors.recall(e, _asking(e), shard=200)


@query("p6_ids")
def p6_ids(t):
    return encoding.encode_corpus(t("documents"))


@query("p6_round_trip", "select doc_id, coalesce(text, '') as text from documents")
def p6_round_trip(t):
    """Encoded and decoded again: the texts themselves."""
    return encoding.decode_corpus(encoding.encode_corpus(t("documents")))


_LEAK_SQL = r"""
with d as (select doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) as w from documents where text is not null),
i as (select item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) as w from eval_items where text is not null),
dg as (select distinct doc_id, array_to_string(list_slice(w, k, k + 11), ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d where len(w) >= 12)),
ig as (select distinct item_id, array_to_string(list_slice(w, k, k + 11), ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i where len(w) >= 12))
"""


@query("p7_found", _LEAK_SQL + "select distinct doc_id, item_id from dg join ig using (g)")
def p7_found(t):
    return leakage.found(t("documents"), t("eval_items"))


@query("p7_regions")
def p7_regions(t):
    """Looser than p7_found: regions within one edit, exact or not."""
    return leakage.leaked_items(t("documents"), t("eval_items")).withColumnsRenamed({"key": "doc_id", "item": "item_id"})


@query("p8_found")
def p8_found(t):
    return languages.found(t("documents"))


@query("p8_passages")
def p8_passages(t):
    d = t("documents")
    return languages.passages(d, languages.train(d)).withColumnRenamed("key", "doc_id")
