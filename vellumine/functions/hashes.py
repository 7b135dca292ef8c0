"""Hash expressions: content hashes, fingerprints, and the embedder that needs no model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumine.functions.text import WS, strip, text_of


def content_hash(*fields: Column) -> Column:
    """SHA-256 of the fields joined by |; null fields count as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(f, F.lit("")) for f in fields]), 256)


def fingerprint(text: Column, *fields: Column) -> Column:
    """SHA-256 of the fields and the text with all white space collapsed, so that layout doesn't change it."""
    return F.sha2(F.concat_ws("\u001f", F.regexp_replace(strip(text_of(text)), f"[{WS}]+", " "), *[F.coalesce(f, F.lit("\u0000")) for f in fields]), 256)


def dummy_embedding(text: Column, dim: int) -> Column:
    """A vector that depends on the text alone: eight numbers in [0, 1) from its SHA-256, repeated up to `dim`.

    Case and white space around the text don't matter. Each number is four bytes, the last one the highest, over 2^32.
    """
    digest = F.sha2(F.lower(strip(text_of(text))), 256)
    part = lambda i: F.concat(*[F.substring(digest, 8 * i + 1 + 2 * j, 2) for j in (3, 2, 1, 0)])
    eight = F.array(*[(F.conv(part(i), 16, 10).cast("double") / F.lit(4294967296.0)).cast("float") for i in range(8)])
    return F.slice(F.flatten(F.array_repeat(eight, -(-dim // 8))), 1, dim)
