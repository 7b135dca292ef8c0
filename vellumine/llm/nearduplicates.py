"""Problem 3: near-duplicate records by an LSH forest over MinHash signatures, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm.chars import Block, blocks, mix, range_hashes
from vellumine.operators.references import BloomFilter
from vellumine.session import cut_lineage

#: Components of a signature (one byte each), trees, and the components that a tree's regions have in common.
WIDTH, TREES, DEPTH = 48, 16, 3
#: Rows of a region that one task compares. A larger region is cut into blocks of so many rows, and every two of its
#: blocks are compared, each two on their own; so all pairs of a region meet, however large it is.
BLOCK = 4096
#: A region with more candidates than DENSE for each of its rows, or of more than BLOCK rows, is dense: its pairs aren't
#: written out as candidates, but verified block against block, with one copy of each row's shingles for each other block.
DENSE = 64
#: Shingles that more rows of two blocks have are counted by matrix products, rarer ones pair by pair.
_RARE = 16
#: Rows of a tile, whose counts of equal components stay in the cache, and of regions small enough to be done together.
_TILE, _FEW = 512, 32
_SEEDS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def orders() -> np.ndarray:
    """The orders of the components, one per tree: it starts with DEPTH components that no other tree starts with."""
    out = []
    for t in range(TREES):
        first = [(t * DEPTH + k) % WIDTH for k in range(DEPTH)]
        rest = [(t * DEPTH + k * (2 * t + 1)) % WIDTH for k in range(WIDTH)]
        seen = list(dict.fromkeys(first + rest))
        out.append(seen + [c for c in range(WIDTH) if c not in set(seen)])
    return np.array(out)


def shingles(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of n words, the text each belongs to, the words of each text, and a hash of all its words."""
    b = Block([t.lower() for t in texts])
    s, e = b.words()
    owner = b.owner(s)
    h = range_hashes(b.codes, s, e)
    words = np.bincount(owner, minlength=b.n) if len(s) else np.zeros(b.n, np.int64)
    whole = np.zeros(b.n, np.uint64)
    if len(h):
        place = (np.arange(len(h)) - np.repeat(np.cumsum(words) - words, words)).astype(np.uint64)
        first = np.flatnonzero(words)
        whole[first] = np.add.reduceat(mix(h + place * np.uint64(0xD6E8FEB86659FD93)), (np.cumsum(words) - words)[first])
        whole = mix(whole + words.astype(np.uint64))
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), words, whole
    g = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        g = g * np.uint64(0xA0761D6478BD642F) + h[k : len(h) - n + 1 + k]
    ok = owner[: len(g)] == owner[n - 1 :]
    return mix(g[ok]), owner[: len(g)][ok], words, whole


def signatures(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x WIDTH bytes: the low byte of the least of each of WIDTH hashes of a text's shingles; zeros where there are none."""
    out = np.zeros((n, WIDTH), np.uint8)
    if len(h):
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for k in range(WIDTH):
            x = (h ^ (h >> np.uint64(29))) * _SEEDS[k]
            out[owner[at], k] = (mix(np.minimum.reduceat(x, at)) >> np.uint64(13)).astype(np.uint8)
    return out


def _clean(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")


def text_classes(df: DataFrame, n: int, min_words: int) -> DataFrame:
    """key, cls (hash of the sequence of words), sig: every distinct key and word sequence of at least min_words words."""
    schema = pa.schema([("key", pa.string()), ("cls", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in blocks(texts):
                h, owner, words, whole = shingles(texts[lo:hi], n)
                sig = signatures(h, owner, hi - lo)
                keep = np.flatnonzero(words >= max(min_words, n))
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo).take(pa.array(keep)), pa.array(whole[keep].view(np.int64)), pa.array([r.tobytes() for r in sig[keep]], pa.binary())], schema=schema)

    return df.where(F.length("text") >= 2 * min_words - 1).mapInArrow(run, "key string, cls bigint, sig binary")


_MET = "a bigint, b bigint, region bigint, block int, sig binary"


def _search(reps: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Rows of reps(cls, sig) that meet, checkpointed: candidate pairs a < b (each once), and the rows of dense regions with
    their block (class in a).

    A tree has DEPTH components of its own; records equal in all of them are a region, and all pairs of a region meet.
    Pairs whose whole signatures agree too little for the threshold are dropped at once, and a pair comes from the first
    tree that it shares. Rows are streamed; a task holds one block. Expected recall at similarity s is
    1 - (1 - s^DEPTH)^TREES, whatever the size of the regions.
    """
    own = orders()[:, :DEPTH]
    least = least_equal(threshold)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("region", pa.int64()), ("sig", pa.binary()), ("cls", pa.int64())])
        for b in batches:
            if not b.num_rows:
                continue
            sig = _matrix(b.column(1))
            region = np.broadcast_to(np.arange(TREES, dtype=np.int64), (len(sig), TREES))
            for k in range(DEPTH):
                region = region << 8 | sig[:, own[:, k]]
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays([pa.array(region[:, t]), b.column(1), b.column(0)], schema=schema)

    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("region", pa.int64()), ("block", pa.int32()), ("sig", pa.binary())])

    def pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(x), f.type) for f in list(out)[2:]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), *none], schema=out)

    def dense(r: int, s: np.ndarray, c: np.ndarray, sent: int) -> pa.RecordBatch:
        blocks_of = ((sent + np.arange(len(c))) // block).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(c), pa.nulls(len(c), pa.int64()), pa.array(np.full(len(c), r)), pa.array(blocks_of), _binary(s)], schema=out)

    def whole_regions(r: np.ndarray, s: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i, j in neighbours(r, s, least):
            yield pairs(c[i], c[j]) if j is not None else dense(r[i[0]], s[i], c[i], 0)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of the regions of up to a block that aren't dense; the rows of the others, numbered by blocks."""
        held, large, sent = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            r, s, c = b.column(0).to_numpy(), _matrix(b.column(1)), b.column(2).to_numpy()
            if held is not None:
                r, s, c = np.concatenate([held[0], r]), np.concatenate([held[1], s]), np.concatenate([held[2], c])
            at = np.concatenate([[0], np.flatnonzero(r[1:] != r[:-1]) + 1, [len(r)]])
            whole = np.ones(len(r), bool)
            for g in np.flatnonzero((np.diff(at) > block) | (r[at[:-1]] == (-1 if large is None else large))):
                lo, hi = at[g], at[g + 1]
                if r[lo] != large:
                    large, sent = r[lo], 0
                yield dense(r[lo], s[lo:hi], c[lo:hi], sent)
                sent += hi - lo
                whole[lo:hi] = False
            whole[at[-2] :] = False
            held = None if r[-1] == large else (r[at[-2] :], s[at[-2] :], c[at[-2] :])  # the last region may go on
            yield from whole_regions(r[whole], s[whole], c[whole])
        if held is not None:
            yield from whole_regions(*held)

    rows = reps.select("cls", "sig").mapInArrow(plant, "region bigint, sig binary, cls bigint")
    # rows of a region come in order of their class, so blocks don't depend on batches or partitions
    return cut_lineage(rows.repartition("region").sortWithinPartitions("region", "cls").mapInArrow(search, _MET))


def least_equal(threshold: float) -> int:
    """Components that must be equal: the share of equal bytes at similarity s is s + (1 - s) / 256; 3.5 standard deviations below the threshold are kept."""
    return int(np.floor(WIDTH * (threshold - 3.5 * np.sqrt(threshold * (1 - threshold) / WIDTH))))


def _block_pairs(met: DataFrame, more: DataFrame | None, *columns: str) -> DataFrame:
    """The rows of dense regions once for each other block of their region (x <= y), sorted so that the two blocks come together.
    more: columns by class that go along."""
    large = met.where("block is not null").select("region", "block", "sig", F.col("a").alias("cls"))
    last = large.groupBy("region").agg(F.max("block").alias("last"))  # one row per dense region
    large = large if more is None else large.join(more, "cls")
    sides = large.join(last, "region").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    sides = sides.select("region", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "sig", "cls", *columns)
    # a stated number of partitions isn't coalesced: these rows are few, but each two blocks are work
    tasks = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sides.repartition(tasks, "region", "x", "y").sortWithinPartitions("region", "x", "y", "block", "cls")


def _pairs_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int, int]]:
    """(rows, tree, rows of the first block) of every two blocks; 0 if there is one block, to be compared with itself."""
    held: list[pa.RecordBatch] = []

    def done() -> tuple[pa.Table, int, int]:
        rows = pa.Table.from_batches(held).combine_chunks()
        part = rows["block"].to_numpy()
        return rows, rows["region"][0].as_py() >> 8 * DEPTH, int(np.searchsorted(part, part[-1]))

    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy() for i in range(3)])
        at = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1), b.num_rows]
        for lo, hi in zip(at, at[1:]):
            if held and any(held[0].column(i)[0] != b.column(i)[lo] for i in range(3)):
                yield done()
                held.clear()
            held.append(b.slice(lo, hi - lo))
    if held:
        yield done()


def _alone(rows: pa.Table, m: int) -> bool:
    """Is it one block that was to meet another, which is empty?"""
    return not m and rows["x"][0] != rows["y"][0]


def forest(reps: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Candidate pairs (a < b) of reps(cls, sig), each once: classes that share a region of some tree, and agree enough. Those
    of dense regions are told by their signatures too, block against block."""
    least = least_equal(threshold)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, tree, m in _pairs_of_blocks(batches):
            if _alone(rows, m):
                continue
            s, c = _matrix(rows["sig"]), rows["cls"].to_numpy()
            x, y = (s[:m], s[m:]) if m else (s, s)
            for i, j in agreeing(x, y, least, not m):
                new = first_tree(x[i], y[j]) == tree
                a, b = c[i[new]], c[m + j[new]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    met = _search(reps, threshold, block)
    return met.where("block is null").select("a", "b").unionByName(_block_pairs(met, None).mapInArrow(meet, "a bigint, b bigint"))


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many shingles each x has in common with each y: sets of hashes. Frequent ones by products of 0/1 matrices, in
    strips of bounded size; rare ones pair by pair; those of one row alone not at all."""
    rows = np.repeat(np.arange(len(x) + len(y)), [len(g) for g in x + y])
    h, code = np.unique(np.concatenate(x + y) if rows.size else np.zeros(0, np.uint64), return_inverse=True)
    order = np.argsort(code, kind="stable")
    rows, ends = rows[order], np.cumsum(np.bincount(code, minlength=len(h)))
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    split = np.add.reduceat((rows < len(x)).astype(np.int64), begins) if len(h) else begins  # rows of x come first
    other = ends - begins - split
    out = np.zeros((len(x), len(y)), np.float32)
    meet = (split > 0) & (other > 0)
    few = np.flatnonzero(meet & (split <= _RARE) & (other <= _RARE))
    for lo in range(0, len(few), 65536):
        k = few[lo : lo + 65536]
        i, j = (np.stack(np.unravel_index(np.arange(_RARE * _RARE), (_RARE, _RARE))))
        i, j = np.broadcast_to(i, (len(k), len(i))), np.broadcast_to(j, (len(k), len(j)))
        ok = (i < split[k][:, None]) & (j < other[k][:, None])
        p, q = (begins[k][:, None] + i)[ok], (begins[k][:, None] + split[k][:, None] + j)[ok]
        np.add.at(out, (rows[p], rows[q] - len(x)), 1)
    many = np.flatnonzero(meet & ((split > _RARE) | (other > _RARE)))
    for lo in range(0, len(many), 1024):
        k = many[lo : lo + 1024]
        a, b = np.zeros((len(x), len(k)), np.float32), np.zeros((len(y), len(k)), np.float32)
        for n, c in enumerate(k):
            a[rows[begins[c] : begins[c] + split[c]], n] = 1
            b[rows[begins[c] + split[c] : ends[c]] - len(x), n] = 1
        out += a @ b.T
    return out


def _verified(threshold: float, degrees: bool):
    """mapInArrow over _block_pairs() with grams: the links (a, b, similarity) of two blocks or, if degrees, how many each class has (cls, links)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, tree, m in _pairs_of_blocks(batches):
            if _alone(rows, m):
                continue
            c, codes = rows["cls"].to_numpy(), region_codes(_matrix(rows["sig"]))[:tree]
            grams = [np.frombuffer(g, np.uint64) for g in rows["grams"].to_pylist()]
            size = np.array([len(g) for g in grams], np.float64)
            links = np.zeros(len(c), np.int64)
            for lo in range(0, m or len(c), _TILE):  # strips of the first block, so that few arrays of a block squared are held
                hi = min(m or len(c), lo + _TILE)
                new = np.ones((hi - lo, len(c) - m), bool) if m else np.arange(lo, hi)[:, None] < np.arange(len(c))
                for k in codes:  # pairs that an earlier tree has brought together
                    new &= k[lo:hi, None] != k[m:]
                i, j = np.flatnonzero(new.any(1)), np.flatnonzero(new.any(0))
                if not len(i):
                    continue
                common = common_counts([grams[lo + r] for r in i], [grams[m + r] for r in j]).astype(np.float64)
                sim = common / np.maximum(1, size[lo + i][:, None] + size[m + j] - common)
                near = new[np.ix_(i, j)] & (sim >= threshold)
                if degrees:
                    links[lo + i] += near.sum(1)
                    links[m + j] += near.sum(0)
                    continue
                x, y = np.nonzero(near)
                a, b = c[lo + i[x]], c[m + j[y]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(sim[x, y])], names=["a", "b", "similarity"])
            if degrees:
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(links[some])], names=["cls", "links"])

    return run


def _grams(n: int):
    """mapInArrow over (cls, text): the sorted different hashes of each text's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in blocks(texts):
                h, owner, _, _ = shingles(texts[lo:hi], n)
                sets = [np.unique(h[a:z]).tobytes() for a, z in zip(np.searchsorted(owner, np.arange(hi - lo)), np.searchsorted(owner, np.arange(hi - lo), side="right"))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["cls", "grams"])

    return run


def _matrix(sig: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(sig.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _binary(sigs: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(sigs), [None, pa.py_buffer(sigs.tobytes())]).cast(pa.binary())


def region_codes(sigs: np.ndarray) -> np.ndarray:
    """For each tree the components that its regions have in common, as one number."""
    out = np.zeros((TREES, len(sigs)), np.int32)
    for k in range(DEPTH):
        out = out << 8 | sigs[:, orders()[:, k]].T
    return out


def first_tree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first tree whose components are equal in both signatures of each row."""
    return (x == y)[:, orders()[:, :DEPTH]].all(2).argmax(1)


def agreeing(x: np.ndarray, y: np.ndarray, least: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i of x, j of y) with at least so many equal components, i < j where both are the same."""
    xs, ys = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    for lo in range(0, len(x), _TILE):
        for at in range(lo if same else 0, len(y), _TILE):
            a, b = xs[:, lo : lo + _TILE], ys[:, at : at + _TILE]
            count = np.zeros((a.shape[1], b.shape[1]), np.uint8)
            for k in range(WIDTH):
                count += (a[k][:, None] == b[k]).view(np.uint8)
            i, j = np.nonzero(count >= least)
            i, j = i + lo, j + at
            if same and at == lo:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j


def neighbours(regions: np.ndarray, sigs: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Pairs (i, j) of rows in one region, where it is the first they share; rows are in order of the regions. Of a dense region
    all rows (i, None), instead of its pairs."""
    if not len(regions):
        return
    at = np.concatenate([[0], np.flatnonzero(regions[1:] != regions[:-1]) + 1, [len(regions)]])
    size = np.repeat(np.diff(at), np.diff(at))
    tree = regions >> 8 * DEPTH
    few = np.flatnonzero((size > 1) & (size <= _FEW))
    for k in range(1, min(len(few), _FEW)):
        near = np.flatnonzero(regions[few[k:]] == regions[few[:-k]])
        if not len(near):
            break
        i, j = few[near], few[near + k]
        ok = ((sigs[i] == sigs[j]).sum(1) >= least) & (first_tree(sigs[i], sigs[j]) == tree[i])
        yield i[ok], j[ok]
    for g in np.flatnonzero(np.diff(at) > _FEW):
        s, found, n = sigs[at[g] : at[g + 1]], [], 0
        for i, j in agreeing(s, s, least, True):
            n += len(i)
            if n > DENSE * len(s):
                break
            new = first_tree(s[i], s[j]) == tree[at[g]]
            found.append((at[g] + i[new], at[g] + j[new]))
        if n > DENSE * len(s):
            yield np.arange(at[g], at[g + 1]), None
        else:
            yield from found


def _jaccard(n: int, threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, z, ta, tz = (b.column(i) for i in range(4))
            xs, ys = ta.to_pylist(), tz.to_pylist()
            for lo, hi in blocks([x + y for x, y in zip(xs, ys)]):
                m = hi - lo
                h, owner, _, _ = shingles(xs[lo:hi] + ys[lo:hi], n)
                key = np.unique(np.stack([(owner % m).astype(np.uint64), h, (owner // m).astype(np.uint64)]), axis=1) if len(h) else np.zeros((3, 0), np.uint64)
                both = (key[0, 1:] == key[0, :-1]) & (key[1, 1:] == key[1, :-1])
                union = np.bincount(key[0].astype(np.int64), minlength=m)
                common = np.bincount(key[0, 1:][both].astype(np.int64), minlength=m)
                sim = common / np.maximum(1, union - common)
                ok = np.flatnonzero(sim >= threshold)
                yield pa.RecordBatch.from_arrays([a.slice(lo, m).take(pa.array(ok)), z.slice(lo, m).take(pa.array(ok)), pa.array(sim[ok])], schema=schema)

    return run


def _links(df: DataFrame, key: str, text: str, n: int, threshold: float, min_words: int, degrees: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: key, cls; links: a, b, similarity between classes; those of dense regions: the same or, if degrees, cls, links)"""
    spark = df.sparkSession
    rows = _clean(df, key, text)
    made = cut_lineage(text_classes(rows, n, min_words).groupBy("key", "cls").agg(F.first("sig").alias("sig")))
    reps = made.groupBy("cls").agg(F.first("sig").alias("sig"))
    met = _search(reps, threshold)
    pairs = met.where("block is null").select("a", "b")
    # Only the representatives of candidates are read again: a Bloom filter of bounded size lets the others go.
    ids = met.select(F.explode(F.array_compact(F.array("a", "b"))).alias("cls")).distinct()
    wanted = made.join(ids, "cls", "left_semi").groupBy("cls").agg(F.min("key").alias("key"))
    expected = wanted.count()
    bloom = BloomFilter(wanted.select(F.xxhash64("key").alias("h")), expected)
    few = rows.where(bloom.probe(spark)(F.xxhash64("key")))
    texts = wanted.join(few, "key").groupBy("cls").agg(F.first("text").alias("text"))
    t1, t2 = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    links = pairs.join(t1, "a").join(t2, "b").select("a", "b", "ta", "tb").mapInArrow(_jaccard(n, threshold), "a bigint, b bigint, similarity double")
    dense = met.where("block is not null").select(F.col("a").alias("cls")).distinct()
    grams = texts.join(dense, "cls", "left_semi").select("cls", "text").mapInArrow(_grams(n), "cls bigint, grams binary")
    schema = "cls bigint, links bigint" if degrees else "a bigint, b bigint, similarity double"
    more = _block_pairs(met, grams, "grams").mapInArrow(_verified(threshold, degrees), schema)
    if met.where("block is not null").limit(1).count() == 0:
        more = spark.createDataFrame([], schema)  # as a rule: the branch over nothing needs no exchanges
    return made.select("key", "cls"), links, more


def near_duplicate_links(df: DataFrame, key: str = "chunk_id", text: str = "text_md", n: int = 5, threshold: float = 0.8, min_words: int = 0) -> DataFrame:
    """key, cls and links of every record with words enough: its class of equal word sequences, and the number of
    other classes whose shingles of n words are similar by at least the threshold.

    Null keys and texts, and texts of fewer than max(n, min_words) words, are left out; repeated rows count once; a
    key with several texts has a row for each. Copies share a class and aren't paired. Links of dense regions are
    counted where they are found and never written out. Other columns are ignored.
    """
    members, links, dense = _links(df, key, text, n, threshold, min_words, degrees=True)
    degree = links.select(F.explode(F.array("a", "b")).alias("cls"), F.lit(1).cast("bigint").alias("links")).unionByName(dense).groupBy("cls").agg(F.sum("links").alias("links"))
    return members.join(degree, "cls", "left").select("key", "cls", F.coalesce("links", F.lit(0)).alias("links"))


def near_duplicate_pairs(df: DataFrame, key: str = "chunk_id", text: str = "text_md", n: int = 5, threshold: float = 0.8, min_words: int = 0) -> DataFrame:
    """key_a < key_b: all pairs of different keys with similar texts, equal ones too. Nulls and rows as in near_duplicate_links().

    Its size is that of the true result: classes of equal texts come out as all their pairs, by joins on the class.
    """
    members, links, dense = _links(df, key, text, n, threshold, min_words)
    m1, m2 = members.select(F.col("key").alias("x"), F.col("cls").alias("a")), members.select(F.col("key").alias("y"), F.col("cls").alias("b"))
    near = links.unionByName(dense).select("a", "b").join(m1, "a").join(m2, "b").select("x", "y")
    equal = m1.join(m2.withColumnRenamed("b", "a"), "a").where("x < y").select("x", "y")
    return near.unionByName(equal).where("x <> y").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()


def found(df: DataFrame) -> DataFrame:
    """Pairs of chunks of at least 30 words whose runs of three words are similar by 0.6."""
    p = near_duplicate_pairs(df, n=3, threshold=0.6, min_words=30)
    return p.select(F.col("key_a").alias("chunk_id_a"), F.col("key_b").alias("chunk_id_b"))
