"""Vector and score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a document's kind, as named in its title, adds to a score; and what a dated title takes off.
BOOSTS = {"methodology": 0.20, "playbook": 0.15, "runbook": 0.10}
DATED = 0.10
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, epsilon: float = 1e-8) -> Column:
    """Cosine similarity; epsilon is added to both lengths, so a zero vector gives 0. Null where lengths differ."""
    return F.when(F.size(a) == F.size(b), dot(a, b) / ((norm(a) + epsilon) * (norm(b) + epsilon)))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine without epsilon; null for a zero vector."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (n > 0), 1 - dot(a, b) / n)


def pad(a: Column, dim: int) -> Column:
    """The vector cut or filled up with zeros to `dim` parts."""
    return F.slice(F.concat(a, F.array_repeat(F.lit(0.0).cast("float"), dim)), 1, dim)


def reciprocal_rank(*ranks: Column, k: int = 60) -> Column:
    """Sum of 1 / (k + rank) over the ranks that there are."""
    total = F.lit(0.0)
    for r in ranks:
        total = total + F.coalesce(1.0 / (k + r), F.lit(0.0))
    return total


def boost(title: Column) -> Column:
    """What a title adds to a score: the first kind it names, less a little if it names a month or a year from 2000 on."""
    t = F.lower(F.coalesce(title, F.lit("")))
    kind = None
    for word, b in BOOSTS.items():
        kind = F.when(t.contains(word), b) if kind is None else kind.when(t.contains(word), b)
    return kind.otherwise(0.0) - F.when(t.rlike(rf"\b({MONTHS})\b|\b20\d\d\b"), DATED).otherwise(0.0)
