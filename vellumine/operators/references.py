"""References to records that were not there at the time: Bloom filter, then an exact join of what passes it."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Proven bound of what is broadcast: 2^27 bits are 16 MB. Beyond some 13 million parents the filter only lets more through.
MIN_BITS, MAX_BITS, PROBES, BITS_A_KEY = 1 << 13, 1 << 27, 4, 10
SALTS = 16
WHITE = r"\p{IsWhite_Space}"


def clean_key(key: Column) -> Column:
    """Trimmed of white space and in lower case; blank becomes null."""
    trimmed = F.lower(F.regexp_replace(key.cast("string"), f"^{WHITE}+|{WHITE}+$", ""))
    return F.when(trimmed != "", trimmed)


def _places(h: Column, bits: int) -> Column:
    """The probes of a 64-bit hash, by double hashing; bits is a power of two."""
    a, b = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return F.array(*[(a + b * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)])


class BloomFilter:
    """Bits of the hashes of a key column, built on the executors; at most MAX_BITS of them."""

    def __init__(self, hashes: DataFrame, expected: int):
        """hashes: one bigint column h. Nulls are left out."""
        self.bits = min(MAX_BITS, max(MIN_BITS, 1 << math.ceil(math.log2(max(1, expected) * BITS_A_KEY))))
        words = (
            hashes.where("h is not null").select(F.explode(_places(F.col("h"), self.bits)).alias("p"))
            .groupBy(F.shiftright("p", 6).cast("int").alias("w"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
        )
        got = words.toPandas()  # at most MAX_BITS / 64 rows
        self.words = np.zeros(self.bits // 64, np.int64)
        self.words[got["w"].to_numpy()] = got["b"].to_numpy()

    def contains(self, h: np.ndarray) -> np.ndarray:
        a = h & np.int64(0x7FFFFFFF)
        b = (h.view(np.uint64) >> np.uint64(32)).astype(np.int64) | np.int64(1)
        hit = np.ones(len(h), bool)
        for i in range(PROBES):
            p = (a + b * np.int64(i)) & np.int64(self.bits - 1)
            hit &= ((self.words[p >> 6] >> (p & 63)) & 1).astype(bool)
        return hit

    def probe(self, spark):
        """A pandas UDF: may the hash be among the keys? False is certain, null gives False."""
        shared = spark.sparkContext.broadcast((self.bits, self.words))

        @F.pandas_udf("boolean")
        def may_contain(h: pd.Series) -> pd.Series:
            f = BloomFilter.__new__(BloomFilter)
            f.bits, f.words = shared.value
            known = h.notna().to_numpy()
            return pd.Series(f.contains(h.fillna(0).to_numpy(np.int64)) & known)

        return may_contain.asNondeterministic()  # else the optimizer runs it on the parents too


def presence(loads: DataFrame, deletions: DataFrame | None) -> DataFrame:
    """Spans [since, until) in which a key is there; until is null when it has not ended.

    loads(k, t) and deletions(k, t) may hold repeated rows; null keys and times are left out. At time t a key is
    there if it has a load at or before t and no deletion from the latest such load up to t, both ends included.
    One sort per key: the events of a key stream through the window, they are never gathered.
    """
    clean = "k is not null and t is not null"
    events = loads.where(clean).select("k", "t", F.lit(1).alias("load")).distinct()
    if deletions is not None:
        events = events.unionByName(deletions.where(clean).select("k", "t", F.lit(0).alias("load")).distinct())
    else:
        return events.groupBy("k").agg(F.min("t").alias("since")).withColumn("until", F.lit(None).cast("timestamp"))
    # At one time a load comes before a deletion, which then ends it at once. Only changes of state matter.
    w = Window.partitionBy("k").orderBy("t", F.desc("load"))
    changes = events.withColumn("before", F.coalesce(F.lag("load").over(w), F.lit(0))).where("load <> before")
    spans = changes.withColumn("until", F.lead("t").over(w)).where("load = 1 and (until is null or until > t)")
    return spans.select("k", F.col("t").alias("since"), "until")


def orphans(refs: DataFrame, spans: DataFrame, keys: DataFrame | None = None, expected: int | None = None, salts: int = SALTS) -> DataFrame:
    """The rows of refs(k, t, ...) whose key was not there at t; spans as presence() gives them.

    A Bloom filter of the parents' keys proves most orphans at once, which go to the result as they are. Only what passes
    it is joined exactly, on the key and a salt of the reference: a parent that holds a third of all references is met by
    `salts` tasks, for which the spans, far fewer than the references, are repeated. Null keys are no references. A
    reference without a time is an orphan if its key was never there. Rows are kept as they come, repeated ones too.

    keys: where the filter's keys (k) are read, if that is cheaper than the spans; it may hold more than they do.
    expected: a bound of the number of keys; counted if None.
    """
    spark = refs.sparkSession
    keyed = refs.where("k is not null").withColumn("h", F.xxhash64("k"))
    keys = spans if keys is None else keys
    if expected is None:
        expected = keys.select(F.approx_count_distinct("k", 0.05)).first()[0]
    bloom = BloomFilter(keys.where("k is not null").select(F.xxhash64("k").alias("h")), expected)
    probed = keyed.withColumn("maybe", bloom.probe(spark)("h"))
    refuted = probed.where(~F.col("maybe")).select(*refs.columns)  # orphans for certain: they are neither shuffled nor joined
    salt = F.pmod(F.xxhash64(*[c for c in refs.columns if c != "k"]), F.lit(salts)).cast("int")
    rest = probed.where("maybe").select(*refs.columns, salt.alias("salt"))
    wide = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    r, s = rest.alias("r"), wide.alias("s")
    there = (F.col("r.k") == F.col("s.k")) & (F.col("r.salt") == F.col("s.salt")) & (
        F.col("r.t").isNull() | ((F.col("r.t") >= F.col("s.since")) & (F.col("s.until").isNull() | (F.col("r.t") < F.col("s.until"))))
    )
    return refuted.unionByName(r.join(s, there, "left_anti").select(*refs.columns))


def _refs(df: DataFrame, name: str, target: Column, time: str, key: Column) -> DataFrame:
    return df.select(target.alias("k"), F.col(time).cast("timestamp").alias("t"), F.lit(name).alias("ref_table"), key.alias("ref_key"))


def orphan_references(kb_documents: DataFrame, deleted_pages: DataFrame, chunks: DataFrame, chunk_embeddings: DataFrame, link_refs: DataFrame) -> DataFrame:
    """ref_table, ref_key, period (yyyy-MM) of every reference whose target was not there at its time; one row per case.

    Keys are compared trimmed and in lower case; null and blank ones are no references. A null reference time
    gives a null period. Rows without any ref_key keep a null one.
    """
    # one filter and one join serve both kinds of parents: the kind is a part of the key
    page, chunk = (lambda c: F.concat(F.lit("p:"), clean_key(F.col(c)))), (lambda c: F.concat(F.lit("c:"), clean_key(F.col(c))))
    loads = kb_documents.select(page("doc_id").alias("k"), F.col("loaded_at").alias("t"))
    made = chunks.select(chunk("chunk_id").alias("k"), F.col("emitted_at").alias("t"))
    spans = presence(loads, deleted_pages.select(page("page_id").alias("k"), F.col("deleted_at").alias("t"))).unionByName(presence(made, None))
    refs = _refs(chunks, "chunks", page("doc_id"), "emitted_at", F.col("chunk_id"))
    refs = refs.unionByName(_refs(link_refs, "link_refs", page("target_page_id"), "seen_at", F.col("link_id").cast("string")))
    refs = refs.unionByName(_refs(chunk_embeddings, "chunk_embeddings", chunk("chunk_id"), "created_at", F.concat("chunk_id", F.lit("|"), "provider")))
    bound = kb_documents.count() + chunks.count()  # of the files' footers: no column is read
    lost = orphans(refs, spans, loads.select("k").unionByName(made.select("k")), bound)
    return lost.select("ref_table", "ref_key", F.date_format("t", "yyyy-MM").alias("period")).distinct()


def orphan_counts(found: DataFrame) -> DataFrame:
    """Orphans per table and period."""
    return found.groupBy("ref_table", "period").agg(F.count(F.lit(1)).alias("orphans"))
