"""Problem 7: evaluation texts that appear in a corpus, by the q-gram lemma, banded alignment and an exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm.chars import DIGIT, LETTER, Block, blocks, mix, range_hashes, spread, window_hashes

#: Length of the q-grams, edits a region may hold, consecutive words that count as a leak.
Q, EDITS, WORDS = 20, 1, 12
#: Items are taken in blocks of so many characters, each of which is one pass over the corpus. That bounds what is broadcast.
ITEM_BLOCK = 8_000_000
FILTER_BITS = 22


class Normal:
    """Texts as their words in lower case, one blank between them: codes, offsets of texts, places and hashes of words."""

    def __init__(self, texts: list[str]):
        b = Block([t.lower() for t in texts])
        word = (b.cls & (LETTER | DIGIT)) != 0
        s, e = b.words()
        owner = b.owner(s)
        size = e - s
        self.n = b.n
        self.counts = np.bincount(owner, minlength=b.n) if len(s) else np.zeros(b.n, np.int64)
        # one blank after each word, the last of a text too
        at = np.cumsum(size + 1) - (size + 1)
        codes = np.full(int(size.sum()) + len(s), 32, np.uint32)
        place = np.ones(len(codes), bool)
        place[at + size] = False
        codes[place] = b.codes[word]
        self.codes, self.word_at, self.word_end = codes, at, at + size
        self.first_word = np.concatenate([[0], np.cumsum(self.counts)])
        ends = np.concatenate([at, [len(codes)]])
        self.offsets = ends[self.first_word]
        self.owner = owner
        self.hashes = range_hashes(codes, at, at + size)

    def grams(self, q: int) -> np.ndarray:
        """A hash of codes[i : i + q] for each i; the last q - 1 are 0."""
        n = len(self.codes)
        out = np.zeros(n, np.uint64)
        if n >= q:
            out[: n - q + 1] = window_hashes(self.codes, q)
        return out

    def word_grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of n words, and the text of each."""
        if len(self.hashes) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        g = np.zeros(len(self.hashes) - n + 1, np.uint64)
        for k in range(n):
            g = g * np.uint64(0xA0761D6478BD642F) + self.hashes[k : len(self.hashes) - n + 1 + k]
        ok = self.owner[: len(g)] == self.owner[n - 1 :]
        return mix(g[ok]), self.owner[: len(g)][ok]

    def shortest(self, n: int) -> int:
        """Characters of the shortest run of n words; 0 if there is none."""
        if len(self.hashes) < n:
            return 0
        ok = self.owner[: len(self.owner) - n + 1] == self.owner[n - 1 :]
        return int((self.word_end[n - 1 :] - self.word_at[: len(self.word_at) - n + 1])[ok].min(initial=1 << 30)) % (1 << 30)


class Items:
    """The index of the test items that is broadcast."""

    def __init__(self, texts: list[str], q: int, edits: int, words: int):
        self.text = Normal(texts)
        t = self.text
        self.length = t.shortest(words)
        # A run of `length` characters, within `edits` of one in an item, shares at least this many q-grams with it.
        while q > 4 and self.length - q + 1 - q * edits < max(4, self.length // 12):
            q -= 1
        self.q, self.edits, self.words = q, edits, words
        self.need = max(1, self.length - q + 1 - q * edits)
        g = t.grams(q)
        at = np.concatenate([np.arange(a, max(a, z - q)) for a, z in zip(t.offsets[:-1], t.offsets[1:])] or [np.zeros(0)]).astype(np.int64)
        order = np.argsort(g[at], kind="stable")
        self.at = at[order]
        self.grams, self.start = np.unique(g[self.at], return_index=True)
        self.start = np.append(self.start, len(self.at))
        self.item = np.searchsorted(t.offsets, self.at, side="right") - 1
        self.bits = np.zeros(1 << FILTER_BITS, bool)
        self.bits[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        h, owner = t.word_grams(words)
        order = np.lexsort((owner, h))
        self.word_hash, self.word_item = h[order], owner[order]


def banded_distances(x: np.ndarray, x_at: np.ndarray, x_len: np.ndarray, y: np.ndarray, y_at: np.ndarray, y_end: np.ndarray, edits: int) -> np.ndarray:
    """For each k the least edits between x[x_at : x_at + x_len] and a part of y that begins at y_at, counted up to edits + 1.

    The alignment keeps to the diagonals within `edits` of the first; all pairs advance together, and those with
    too many edits leave.
    """
    best = np.full(len(x_at), edits + 1, np.int64)
    alive = np.arange(len(x_at))
    width = 2 * edits + 1
    off = np.arange(width) - edits
    # before any letter: the part of y may begin a few letters late or early for the edits it takes
    rows = np.tile(np.abs(off), (len(alive), 1))
    for i in range(int(x_len.max(initial=0)) + 1):
        ended = x_len[alive] == i
        if ended.any():
            best[alive[ended]] = rows[ended].min(1)
        keep = ~ended & (rows.min(1) <= edits)
        alive, rows = alive[keep], rows[keep]
        if not len(alive):
            break
        j = y_at[alive][:, None] + i + off
        inside = (j >= 0) & (j < y_end[alive][:, None])
        same = y[np.clip(j, 0, len(y) - 1)] == x[x_at[alive] + i][:, None]
        new = np.where(inside & same, rows, rows + 1)
        new[:, :-1] = np.minimum(new[:, :-1], rows[:, 1:] + 1)  # a letter of x that y lacks
        new = np.minimum.accumulate(new - off, axis=1) + off  # letters of y that x lacks
        rows = new
    return best


def regions(doc: Normal, items: Items) -> tuple[np.ndarray, ...]:
    """(text, item, place in the texts, place in the items, length) of diagonal bands with q-grams enough for a leak.

    First the places of the texts whose q-gram is in some item are counted in windows of the region's length: the
    lemma's bound must be met whatever the item. What is left is expanded to items and diagonals, and counted in
    bands of diagonals that overlap by the number of edits.
    """
    none = (np.zeros(0, np.int64),) * 5
    span = items.length - items.q + 1
    if items.length <= 0 or span <= 0 or len(doc.codes) < items.q:
        return none
    g = doc.grams(items.q)
    hit = items.bits[g >> np.uint64(64 - FILTER_BITS)]
    sums = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
    n = len(hit)
    window = span + items.edits  # an inserted letter makes the region that much longer
    ahead = np.full(n, sums[-1], np.int32)
    ahead[: max(0, n - window + 1)] = sums[window:]
    dense = ahead - sums[:-1] >= items.need
    if not dense.any():
        return none
    # a place counts if some dense window covers it
    cover = np.concatenate([np.zeros(window, np.int32), np.cumsum(dense, dtype=np.int32)])
    at = np.flatnonzero(hit & (cover[window:] > cover[:-window]))
    k = np.searchsorted(items.grams, g[at])
    k[k == len(items.grams)] = 0
    real = items.grams[k] == g[at]
    at, k = at[real], k[real]
    text = np.searchsorted(doc.offsets, at, side="right") - 1
    ok = at + items.q < doc.offsets[text + 1]
    at, k, text = at[ok], k[ok], text[ok]
    times = items.start[k + 1] - items.start[k]
    idx = np.repeat(items.start[k], times) + spread(times)
    at, text = np.repeat(at, times), np.repeat(text, times)
    place, item = items.at[idx], items.item[idx]
    diagonal = at - place + len(items.text.codes)
    step = max(1, items.edits)
    group = text * items.text.n + item
    found = []
    for half in (0, 1) if items.edits else (0,):
        band = (diagonal + half * step) // (2 * step)
        order = np.argsort(group * (int(band.max()) + 1) + band, kind="stable")  # places already ascend
        a, b, i, t = at[order], band[order], item[order], text[order]
        last = np.arange(len(a)) + items.need - 1
        fit = last < len(a)
        last = np.minimum(last, len(a) - 1)
        # `need` hits of one band within a region's length
        full = fit & (b[last] == b) & (i[last] == i) & (t[last] == t) & (a[last] - a < window)
        # of hits that follow one another on a diagonal the first stands for all: its region holds no more edits
        d = diagonal[order]
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == a[:-1] + 1) & (d[1:] == d[:-1]) & (i[1:] == i[:-1]) & (t[1:] == t[:-1])
        f = np.flatnonzero(full & ~again)
        found.append(np.stack([t[f], i[f], a[f], place[order][f], a[last[f]] - a[f] + items.q]))
    return tuple(np.concatenate(found, axis=1))


def leaks(texts: list[str], items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, words): pairs with a verified region, and whether they have `words` consecutive words in common."""
    doc = Normal(texts)
    t, i, a, p, size = regions(doc, items)
    if len(t):
        ok = banded_distances(doc.codes, a, size, items.text.codes, p, items.text.offsets[i + 1], items.edits) <= items.edits
        t, i = t[ok], i[ok]
    if not len(t):
        return t, i, np.zeros(0, bool)
    pairs = np.unique(t * items.text.n + i)
    pt, pi = pairs // items.text.n, pairs % items.text.n
    # exact check: a run of words of the text that the item has too
    h, owner = doc.word_grams(items.words)
    if not len(items.word_hash):
        return pt, pi, np.zeros(len(pt), bool)
    lo, hi = np.searchsorted(items.word_hash, h), np.searchsorted(items.word_hash, h, side="right")
    m = hi > lo
    times = (hi - lo)[m]
    who = np.repeat(owner[m], times) * items.text.n + items.word_item[np.repeat(lo[m], times) + spread(times)]
    return pt, pi, np.isin(pairs, np.unique(who))


def leaked_items(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", q: int = Q, edits: int = EDITS, words: int = WORDS, item_block: int = ITEM_BLOCK) -> DataFrame:
    """key, item, exact: texts of df that hold a region within `edits` edits of one in an item, as long as the shortest
    run of `words` words of the items; exact tells whether they have `words` consecutive words in common.

    Words are runs of letters and digits in lower case. Null and empty texts and null keys give nothing, repeated
    rows one row; an item of fewer words than `words` can't be found. Items are a stated set and go to all
    executors in blocks of bounded size; the corpus is read once per block and not shuffled but for distinct().
    """
    spark = df.sparkSession
    kinds = dict(df.dtypes)[key], dict(items.dtypes)[item_key]
    rows = df.where(F.col(key).isNotNull() & (F.length(text) >= 2 * words - 1)).select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = None
    held: list[tuple] = []
    size = 0

    def scan(part: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(([k for k, _ in part], [t for _, t in part]))
        schema = f"key {kinds[0]}, item {kinds[1]}, exact boolean"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, texts = shared.value
            index = Items(texts, q, edits, words)
            for b in batches:
                own, docs = b.column(0), b.column(1).to_pylist()
                for lo, hi in blocks(docs, 1 << 17):  # arrays that stay in the cache
                    t, i, exact = leaks(docs[lo:hi], index)
                    yield pa.RecordBatch.from_arrays([own.slice(lo, hi - lo).take(pa.array(t, pa.int64())), pa.array([keys[x] for x in i], to_arrow(kinds[1])), pa.array(exact)], names=["key", "item", "exact"])

        return rows.mapInArrow(run, schema)

    stated = items.where(F.col(item_key).isNotNull() & (F.length(item_text) > 0)).select(item_key, item_text).distinct().orderBy(item_key)
    for k, t in stated.toLocalIterator():
        held.append((k, t))
        size += len(t)
        if size > item_block:
            found = scan(held) if found is None else found.unionByName(scan(held))
            held, size = [], 0
    if held or found is None:
        found = scan(held) if found is None else found.unionByName(scan(held))
    return found.groupBy("key", "item").agg(F.max("exact").alias("exact"))


def to_arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def found(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """doc_id and item_id with at least 12 consecutive words in common."""
    return leaked_items(documents, eval_items).where("exact").select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"))
