"""URL expressions: normal forms, kinds of links, page ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track visits.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "mc_cid", "mc_eid", "_ga", "_gl")
#: The same for links in XML topics.
TRACKING_XML = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "msclkid", "mc_cid", "mc_eid", "_ga", "_gac")


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def normalize_url(url: Column, tracking: tuple[str, ...] = TRACKING, encode: bool = False) -> Column:
    """The URL without tracking parameters; the fragment stays.

    Of a repeated parameter the first value is kept, all of them if `encode`; values are decoded and, if `encode`,
    encoded again; a parameter without a value stays bare. Null stays null.
    """
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda x: x != "")
    parsed = F.transform(pairs, lambda x: F.struct(_decode(F.substring_index(x, "=", 1)).alias("k"), F.when(x.contains("="), _decode(F.regexp_extract(x, "=(.*)$", 1))).otherwise("").alias("v")))
    kept = F.filter(parsed, lambda p: ~p["k"].isin(*tracking))
    if not encode:
        names = F.array_distinct(F.transform(kept, lambda p: p["k"]))
        kept = F.transform(names, lambda n: F.struct(n.alias("k"), F.element_at(F.filter(kept, lambda p: p["k"] == n), 1)["v"].alias("v")))
        text = F.transform(kept, lambda p: F.when(p["v"] != "", F.concat(p["k"], F.lit("="), p["v"])).otherwise(p["k"]))
    else:
        text = F.transform(kept, lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"])))
    rebuilt = F.array_join(text, "&")
    return F.when(query == "", url).otherwise(F.concat(base, F.when(rebuilt != "", F.concat(F.lit("?"), rebuilt)).otherwise(""), fragment))


def host(url: Column) -> Column:
    """Host and port in lower case; empty for a relative URL."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)


def link_type(url: Column, base_url: str) -> Column:
    """attachment, confluence or external, for a wiki at base_url; null and empty URLs are external."""
    u = F.coalesce(url, F.lit(""))
    p = F.lower(path(url))
    own = host(url) == F.lit(base_url.split("://", 1)[-1].split("/", 1)[0].lower())
    page = p.contains("/spaces/") | p.contains("/pages/")
    attachment = p.contains("/download/attachments/")
    relative = F.when(u.contains("/download/attachments/"), "attachment").when(u.contains("/spaces/") | u.contains("/pages/"), "confluence").otherwise("external")
    return F.when(u.startswith("/"), relative).when(~own, "external").when(attachment, "attachment").when(page | p.contains("/wiki/"), "confluence").otherwise("external")


def xml_link_type(url: Column) -> Column:
    """The kind of a link in an XML topic: external (with a scheme), topic, map or reference by its ending, else other."""
    u = F.lower(F.coalesce(url, F.lit("")))
    p = F.substring_index(F.substring_index(u, "#", 1), "?", 1)
    return F.when(u.rlike(r"^[a-z][a-z0-9+.\-]*:"), "external").when(p.endswith(".ditamap"), "map").when(p.endswith(".dita") | p.endswith(".xml"), "topic").otherwise("other")


def page_id(url: Column) -> Column:
    """The page id in a wiki URL, null if there is none."""
    part = lambda p: F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), p, 1), F.lit(""))
    return F.coalesce(part(r"/spaces/[^/]+/pages/(\d+)"), part(r"[?&]pageId=(\d+)"))


def source_system(url: Column) -> Column:
    u = F.lower(F.coalesce(url, F.lit("")))
    return F.when(u.contains("confluence"), "confluence").when(u.contains("dita") | u.contains(".xml"), "dita").otherwise("unknown")


def absolute(base_url: str, url: Column) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(base_url.rstrip("/")), url)).otherwise(url)
