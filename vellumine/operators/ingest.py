"""Pages to documents, links, media and graph edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.functions import markup as M
from vellumine.functions import urls as U
from vellumine.operators.references import BloomFilter


def body_kind(df: DataFrame) -> Column:
    """The stated form of the body, else the first that is there."""
    return F.coalesce(F.nullif(F.col("body_repr"), F.lit("")), F.when(F.length("body_adf") > 0, "adf").when(F.length("body_storage") > 0, "storage").when(F.length("body_dita_xml") > 0, "dita"))


def normalize_pages(pages: DataFrame) -> DataFrame:
    """Documents of pages (schema PAGE): text_md by the form of the body, links, breadcrumbs, attachments as given.

    A page without a body has an empty text. Each body runs through the one parser of its form; bodies of the other
    forms reach the UDFs as nulls.
    """
    kind = body_kind(pages)
    p = pages.withColumn("kind", kind)
    only = lambda k, c: F.when(F.col("kind") == k, F.col(c))
    p = p.withColumn("md_html", M.html_to_markdown(only("storage", "body_storage"))).withColumn("md_adf", M.adf_to_markdown(only("adf", "body_adf"))).withColumn("md_xml", M.xml_to_markdown(only("dita", "body_dita_xml")))
    p = p.withColumn("l_html", M.links_of(only("storage", "body_storage"), "storage")).withColumn("l_adf", M.links_of(only("adf", "body_adf"), "adf"))
    by_kind = lambda a, b, c: F.when(F.col("kind") == "storage", F.col(a)).when(F.col("kind") == "adf", F.col(b)).when(F.col("kind") == "dita", c)
    crumbs = F.array_compact(F.concat(F.array("space_name"), F.coalesce(F.transform("ancestors", lambda a: a["title"]), F.array().cast("array<string>")), F.array("title")))
    return p.select(
        "id", "title", "space_key", "url", "version", "created_at", "updated_at", F.coalesce("source_system", F.when(F.col("kind") == "dita", "dita"), U.source_system(F.col("url"))).alias("source_system"), F.col("kind").alias("body_repr"),
        F.coalesce(by_kind("md_html", "md_adf", F.col("md_xml")), F.lit("")).alias("text_md"), F.coalesce(by_kind("l_html", "l_adf", F.array().cast("array<string>")), F.array().cast("array<string>")).alias("links"), crumbs.alias("breadcrumbs"), "labels", "attachments",
    )


def content_sha256(pages: DataFrame) -> Column:
    """Hash of the body: of the editor JSON in canonical form, else of the storage text; null without a body."""
    return F.sha2(F.coalesce(M.canonical_json_of(F.nullif(F.col("body_adf"), F.lit(""))), F.nullif(F.col("body_storage"), F.lit(""))), 256)


def page_links(pages: DataFrame, base_url: str) -> DataFrame:
    """from_page_id, target_url (normal form), target_type, target_page_id, anchor of every link of the bodies."""
    docs = normalize_pages(pages).select(F.col("id").alias("from_page_id"), F.explode("links").alias("raw"))
    full = U.absolute(base_url, F.col("raw"))
    return docs.select("from_page_id", U.normalize_url(full).alias("target_url"), U.link_type(F.col("raw"), base_url).alias("target_type"), U.page_id(F.col("raw")).alias("target_page_id"), F.nullif(F.regexp_extract("raw", "#(.*)$", 1), F.lit("")).alias("anchor"))


def page_media(pages: DataFrame) -> DataFrame:
    """page_id, ord, filename, url, media_type, attachment_id: media of the bodies, met with the page's attachments by file name."""
    kind = body_kind(pages)
    p = pages.withColumn("m", F.coalesce(M.media_of(F.when(kind == "storage", F.col("body_storage")), "storage"), F.array().cast(M.MEDIA))).withColumn("n", F.coalesce(M.media_of(F.when(kind == "adf", F.col("body_adf")), "adf"), F.array().cast(M.MEDIA)))
    own = F.map_from_entries(F.array_distinct(F.transform(F.coalesce("attachments", F.array().cast("array<struct<id:string,filename:string,media_type:string,file_size:bigint,download_url:string>>")), lambda a: F.struct(F.coalesce(a["filename"], F.lit("")), a["id"]))))
    rows = p.select(F.col("id").alias("page_id"), F.explode(F.when(kind == "adf", F.col("n")).otherwise(F.col("m"))).alias("x"), own.alias("own"))
    return rows.select("page_id", "x.ord", "x.filename", "x.url", "x.media_type", F.try_element_at("own", F.coalesce("x.filename", F.lit(""))).alias("attachment_id"))


def edges(documents: DataFrame, links: DataFrame | None = None, key: str = "id") -> DataFrame:
    """type, src, dst: CONTAINS from the space, LABELED_AS to labels, PARENT_OF from each ancestor, LINKS_TO of links; once each.

    Columns space_key, labels and ancestors may be missing or null.
    """
    have = set(documents.columns)
    parts = []
    if "space_key" in have:
        parts.append(documents.where(F.length("space_key") > 0).select(F.lit("CONTAINS").alias("type"), F.concat(F.lit("space:"), "space_key").alias("src"), F.col(key).alias("dst")))
    if "labels" in have:
        parts.append(documents.select(F.lit("LABELED_AS").alias("type"), F.col(key).alias("src"), F.explode(F.transform("labels", lambda x: F.concat(F.lit("label:"), x))).alias("dst")))
    if "ancestors" in have:
        parts.append(documents.select(F.lit("PARENT_OF").alias("type"), F.explode("ancestors.id").alias("src"), F.col(key).alias("dst")))
    if links is not None:
        parts.append(links.where("target_page_id is not null and from_page_id is not null").select(F.lit("LINKS_TO").alias("type"), F.col("from_page_id").alias("src"), F.col("target_page_id").alias("dst")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("src is not null and dst is not null").distinct()


def map_edges(topics: DataFrame) -> DataFrame:
    """map_id, topic_id, ord, title: which topic files a map names, met by path. topics as readers.read_topics() gives them."""
    entries = topics.where("kind = 'map'").select(F.col("id").alias("map_id"), F.regexp_replace("path", "[^/]*$", "").alias("dir"), F.posexplode(M.xml_map_of(F.col("xml"))).alias("ord", "e"))
    path = F.lower(F.regexp_replace(F.concat("dir", F.regexp_replace("e.target", "#.*$", "")), r"\.[^./]+$", ""))
    flat = F.regexp_replace(F.regexp_replace(path, r"(^|/)\./", "$1"), r"[^/]+/\.\./", "")
    named = entries.where("e.target <> ''").select("map_id", "ord", F.col("e.title").alias("title"), F.concat(F.lit("topic:"), flat).alias("topic_id"))
    return named.join(topics.where("kind = 'topic'").select(F.col("id").alias("topic_id")), "topic_id")


def directory_context(path: Column) -> tuple[Column, Column]:
    """(collection, path tags): the first folder, and the sorted different folder words of more than two letters."""
    folders = F.slice(F.split(F.lower(path), "/"), F.lit(1), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    words = F.filter(F.flatten(F.transform(folders, lambda f: F.split(f, "[-_ ]"))), lambda w: (F.length(w) > 2) & ~w.isin("the", "and", "for", "src", "dita", "topics", "content", "docs"))
    return F.try_element_at(folders, F.lit(1)), F.array_sort(F.array_distinct(words))


def map_raw_pages(raw: DataFrame, base_url: str) -> DataFrame:
    """Pages of raw service records (column raw, JSON): authors given as a text or an object, bodies and attachments under either name.

    Fields are read from the parsed record (variant) where they are used; what isn't there is null.
    """
    v = F.try_parse_json("raw")
    get = lambda *paths: F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])
    user = lambda f: F.struct(get(f"$.{f}.accountId", f"$.{f}Id", f"$.{f}").alias("account_id"), get(f"$.{f}.displayName").alias("display_name"))
    files = F.from_json(F.coalesce(F.get_json_object("raw", "$.attachments"), F.lit("[]")), "array<struct<id:string,title:string,filename:string,mediaType:string,type:string,fileSize:bigint,size:bigint,_links:struct<download:string>>>")
    attachments = F.transform(files, lambda a: F.struct(a["id"].alias("id"), F.coalesce(a["title"], a["filename"]).alias("filename"), F.coalesce(a["mediaType"], a["type"]).alias("media_type"), F.coalesce(a["fileSize"], a["size"]).alias("file_size"), U.absolute(base_url, a["_links"]["download"]).alias("download_url")))
    storage, adf = get("$.body.storage.value"), F.coalesce(get("$.body.atlas_doc_format.value"), F.get_json_object("raw", "$.body.atlas_doc_format.value"))
    return raw.select(
        get("$.id").alias("id"), get("$.title").alias("title"), get("$.spaceId").alias("space_id"), F.try_variant_get(v, "$.version.number", "int").alias("version"), get("$.createdAt").alias("created_at"), get("$.version.createdAt", "$.updatedAt").alias("updated_at"),
        U.absolute(base_url, get("$._links.webui")).alias("url"), F.when(adf.isNotNull(), "adf").when(storage.isNotNull(), "storage").alias("body_repr"), storage.alias("body_storage"), adf.alias("body_adf"), attachments.alias("attachments"), user("author").alias("created_by"),
    )


def normal_attachments(names: Column, objects: Column) -> Column:
    """Attachments given as names or as objects, as objects."""
    plain = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.struct(n.alias("filename"), F.lit(None).cast("string").alias("download_url")))
    return F.concat(plain, F.transform(F.coalesce(objects, F.array().cast("array<struct<filename:string,download_url:string>>")), lambda o: F.struct(o["filename"].alias("filename"), o["download_url"].alias("download_url"))))


def space_key(known: Column, url: Column) -> Column:
    """The known key, else that in the URL, else __unknown__."""
    return F.coalesce(F.nullif(known, F.lit("")), F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), "/spaces/([A-Z0-9]+)/pages/", 1), F.lit("")), F.lit("__unknown__"))


def resolve_reference(path: Column, target: Column) -> Column:
    """The id of a topic or map that a reference in a file at `path` names; null for external ones."""
    t = F.regexp_replace(F.lower(target), "#.*$", "")
    folder = F.regexp_replace(F.lower(path), "[^/]*$", "")
    full = F.regexp_replace(F.regexp_replace(F.concat(folder, t), r"(^|/)\./", "$1"), r"[^/]+/\.\./", "")
    kind = F.when(t.endswith(".ditamap"), "map:").otherwise("topic:")
    return F.when(target.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:") | (F.length(target) == 0), None).when(t == "", F.concat(F.lit("topic:"), F.regexp_replace(F.lower(path), r"\.[^./]+$", ""))).otherwise(F.concat(kind, F.regexp_replace(full, r"\.[^./]+$", "")))


def aggregate_labels(labels: Column, tags: Column, collection: Column, meta: Column, maps: Column) -> Column:
    """All labels of a topic: its own, path tags, collection, 'name:value' of a map of metadata, and the maps that hold it; sorted, once each."""
    strings = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    pairs = F.transform(F.map_entries(F.coalesce(meta, F.create_map().cast("map<string,string>"))), lambda e: F.concat_ws(":", e["key"], e["value"]))
    slugs = F.transform(strings(maps), lambda m: F.concat(F.lit("map:"), F.regexp_replace(F.regexp_replace(F.lower(m), "[^a-z0-9]+", "-"), "^-|-$", "")))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(strings(labels), strings(tags), F.array(collection), pairs, slugs))))


def title_mentions(documents: DataFrame, key: str = "doc_id", title: str = "title", text: str = "text") -> DataFrame:
    """REFERENCES edges src -> dst: the text of src names the title of dst, word by word. Titles without words name nothing.

    No pair of documents is compared: runs of words of the texts that begin and end as some title does are met with
    the titles on their hash. A run goes along only if a Bloom filter of bounded size passes its first two words, or
    its first, as the beginning of a title; it is as long as the longest title.
    """
    words = lambda c: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    named = documents.select(F.col(key).alias("dst"), words(F.col(title)).alias("w")).where(F.size("w") > 0)
    named = named.select("dst", F.size("w").alias("n"), F.array_join(F.slice("w", 1, 2), " ").alias("head"), F.array_join("w", " ").alias("name")).distinct()
    lengths = named.select("head", "n").distinct()
    known = lengths.agg(F.count(F.lit(1)).alias("heads"), F.max("n").alias("longest")).first()
    longest = known["longest"] or 0
    bloom = BloomFilter(lengths.select(F.xxhash64("head").alias("h")), known["heads"])
    shared = documents.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, h = b.column(1), [b.column(i).flatten().to_numpy() for i in (2, 3)]
            if not len(h[0]):
                continue
            place = np.flatnonzero(shared.value.contains(h[0]) | shared.value.contains(h[1]))
            ends = np.cumsum(pc.list_value_length(w).to_numpy())
            row = np.searchsorted(ends, place, side="right")
            flat = w.flatten()
            s = [flat.slice(p, min(longest, e - p)).to_pylist() for p, e in zip(place.tolist(), ends[row].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(s, pa.list_(pa.string()))], names=["src", "s"])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("src"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    hashed = rows.select("src", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h1"), F.transform("w", lambda x, i: F.xxhash64(F.array_join(F.slice("w", i + 1, F.lit(2)), " "))).alias("h2"))
    runs = hashed.mapInArrow(run, f"src {kind}, s array<string>").withColumn("head", F.explode(F.array_distinct(F.array(F.element_at("s", 1), F.array_join(F.slice("s", 1, 2), " ")))))
    met = runs.join(lengths, "head").where(F.size("s") >= F.col("n")).select("src", F.array_join(F.slice("s", F.lit(1), F.col("n")), " ").alias("name")).distinct()
    return met.join(named.select("dst", "name"), "name").where("src <> dst").select("src", "dst", F.lit("REFERENCES").alias("type"), F.lit(0.8).alias("confidence")).distinct()
