"""Problem 5: the most similar vectors of every vector, by vantage-point trees per shard."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumine.llm.chars import mix

#: Vectors a shard should hold, vectors of a leaf, shards that one tree tells apart at most, and rows of the sample that a
#: tree's borders are fitted on: SAMPLE, or 8 for each shard. So a tree brings at most 12,000 vectors along. A shard that
#: comes out larger than LARGE times its size gets a tree of its own, fitted and applied on the executors.
SHARD, LEAF, MAX_SHARDS, SAMPLE, LARGE = 12_000, 96, 1_500, 6_000, 2.0
#: How much the triangle inequality is relaxed between shards and within one, where a least cosine bounds the search and
#: where nothing does; 1 is exact. p5_recall measures the latter.
BOUNDED, OPEN = (10.0, 5.0), (3.0, 2.0)
EPS = 1e-6
#: Distances that differ by less can't be told apart: a cosine of single precision has an error of about 1e-7.
FLAT = 1e-3
SALTS = 16


@dataclass
class Node:
    point: np.ndarray | None = None  # vantage point; None at a leaf
    radius: float = 0.0
    inner: int = -1
    outer: int = -1
    rows: np.ndarray | None = None  # of a leaf
    parts: int = 1  # of a leaf whose vectors are all alike: they are dealt out by hash, and all parts are searched


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ p)))


def build(x: np.ndarray, leaf: int, seed: int = 7, most: int | None = None) -> list[Node]:
    """A tree over unit vectors. Of a few candidates the vantage point is the one with the widest spread of distances.

    Where all distances are equal (copies), the rows are halved as they are: both sides hold points at the radius.
    most: number of leaves after which no node is divided further; the largest node is divided first, and one whose
    vectors are too much alike for that stays a leaf of several parts.
    """
    rng = np.random.default_rng(seed)
    nodes = [Node(rows=np.arange(len(x)))]
    queue = [0]
    leaves = 1
    while queue:
        at = max(queue, key=lambda i: len(nodes[i].rows)) if most else queue[-1]
        queue.remove(at)
        rows = nodes[at].rows
        if len(rows) <= leaf or (most and leaves >= most):
            continue
        trial = x[rows[rng.integers(0, len(rows), 5)]]
        probe = x[rows[rng.integers(0, len(rows), min(len(rows), 200))]]
        best = trial[int(np.argmax(np.std(2 - 2 * (probe @ trial.T), axis=0)))]
        d = _distances(x[rows], best)
        if most and float(np.ptp(d)) < FLAT:
            nodes[at].parts = max(1, min(most - leaves + 1, round(len(rows) * most / len(x))))
            leaves += nodes[at].parts - 1
            continue
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        nodes[at].point, nodes[at].radius, nodes[at].rows = best, float(d[order[half - 1]] + d[order[half]]) / 2, None
        nodes[at].inner, nodes[at].outer = len(nodes), len(nodes) + 1
        nodes += [Node(rows=rows[order[:half]]), Node(rows=rows[order[half:]])]
        queue += [len(nodes) - 2, len(nodes) - 1]
        leaves += 1
    return nodes


def descend(nodes: list[Node], q: np.ndarray, margin: np.ndarray | float | None) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, queries that reach it): every node is met once, by all queries whose ball of radius `margin` isn't
    wholly on the other side; None: each query takes its own side only."""
    stack = [(0, np.arange(len(q)))]
    while stack:
        at, who = stack.pop()
        node = nodes[at]
        if node.point is None:
            yield at, who
            continue
        d = _distances(q[who], node.point)
        if margin is None:
            go_in = d <= node.radius
            sides = (go_in, ~go_in)
        else:
            m = margin if np.isscalar(margin) else margin[who]
            sides = (d - m <= node.radius + EPS, d + m >= node.radius - EPS)
        for child, go in zip((node.inner, node.outer), sides):
            if go.any():
                stack.append((child, who[go]))


def cosines(q: np.ndarray, x: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Cosines of rows a of q and b of x, in double precision."""
    nq, nx = (np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64)) for m in (q, x))
    return lambda a, b: np.einsum("ij,ij->i", q[a].astype(np.float64), x[b].astype(np.float64)) / (nq[a] * nx[b])


def search(x: np.ndarray, q: np.ndarray, k: int, least: float, relax: float, own: np.ndarray | None = None, fine: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row of x, cosine): for each query the k most similar rows with a cosine of at least `least`, and ties
    of the last of them. own: the row of x that is the query itself, or -1. fine(a, b): cosines of double precision of
    query a and row b, by which the candidates are ranked.

    A first descent to each query's own leaf bounds its search radius; the second visits what the triangle
    inequality can't rule out, with the radius divided by `relax`. relax 1 is exact.
    """
    if not len(x) or not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    nodes = build(x, LEAF)
    cut = np.full(len(q), least, np.float32)
    own = np.full(len(q), -1) if own is None else own
    for at, who in descend(nodes, q, None):
        rows = nodes[at].rows
        if len(rows) > k:
            for lo in range(0, len(who), 4096):
                part = who[lo : lo + 4096]
                s = q[part] @ x[rows].T
                s[own[part][:, None] == rows[None]] = -2
                cut[part] = np.maximum(cut[part], np.partition(s, -k, axis=1)[:, -k] - EPS)
    margin = np.sqrt(np.maximum(0, 2 - 2 * cut.astype(np.float64))) / relax
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at, who in descend(nodes, q, margin):
        rows = nodes[at].rows
        leaf = x[rows]
        for lo in range(0, len(who), 4096):
            part = who[lo : lo + 4096]
            s = q[part] @ leaf.T
            i, j = np.nonzero(s >= cut[part][:, None] - EPS)
            if len(i):
                a, b = part[i], rows[j]
                ok = own[a] != b
                out.append((a[ok], b[ok], s[i, j][ok]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, s = (np.concatenate(c) for c in zip(*out))
    if not len(a):
        return a, b, np.zeros(0)
    s = np.concatenate([(fine or cosines(q, x))(a[i : i + 65536], b[i : i + 65536]) for i in range(0, len(a), 65536)])
    near = s >= least
    a, b, s = a[near], b[near], s[near]
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    size = np.diff(np.append(start, len(a)))
    kth = s[start + np.minimum(size, k) - 1]
    keep = s >= np.repeat(kth, size)
    return a[keep], b[keep], s[keep]


def usable(df: DataFrame, key: str, provider: str, dim: str, embedding: str) -> DataFrame:
    """provider, key, e: one row per vector that isn't null, empty, zero, or of NaN or infinite parts, and is as long as `dim` says."""
    e = F.col(embedding)
    fine = (F.size(e) == F.col(dim)) & (F.size(e) > 0) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = df.select(F.col(provider).alias("provider"), F.col(key).cast("string").alias("key"), e.alias("e"), fine.alias("fine"))
    return rows.where("fine and key is not null and provider is not null").select("provider", "key", "e")


def vector_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: cls, provider, key; reps: cls, provider, vec): equal vectors share a class. vec holds the float32 bytes of the
    vector times a power of two, so single precision is kept as it is and double precision neither overflows nor vanishes."""
    hashed = rows.withColumn("cls", F.xxhash64("provider", "e"))
    members = hashed.select("cls", "provider", "key").distinct()

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task passes each class on once; a hot one arrives once a task
        for b in batches:
            cls = b.column(0).to_pylist()
            new = [i for i, c in enumerate(cls) if c not in seen and not seen.add(c)]
            b = b.take(pa.array(new, pa.int64()))
            lists = b.column(2)
            flat, n = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(n)])
            out = [b""] * len(n)
            for size in np.unique(n):
                i = np.flatnonzero(n == size)
                m = flat[at[i][:, None] + np.arange(size)]
                m = np.ldexp(m, -np.frexp(np.abs(m).max(1, keepdims=True))[1]).astype("<f4")
                for row, k in zip(m, i):
                    out[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["cls", "provider", "vec"])

    reps = hashed.select("cls", "provider", "e").mapInArrow(scaled, "cls bigint, provider string, vec binary")
    return members, reps


def _unit(raw: np.ndarray) -> np.ndarray:
    """Unit vectors of single precision, for search."""
    return (raw / np.sqrt(np.einsum("ij,ij->i", raw, raw, dtype=np.float64))[:, None]).astype(np.float32)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, dim)


@dataclass
class Router:
    """A tree whose leaves are shards, and the sample it is fitted on."""

    nodes: list[Node]
    sample: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, shards: int) -> Router:
        return cls(build(x, 1, most=shards), x)

    def visits(self, x: np.ndarray, ids: np.ndarray, lives: np.ndarray, asks: np.ndarray, reach: np.ndarray, across: float, k: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(shard, rows that go there, which of them live there). `reach`, the search radius, is narrowed where the row lives:
        the k-th nearest of the sample in its shard can't be nearer than the true one."""
        home = np.full(len(x), -1)
        for leaf, who in descend(self.nodes, x, None):
            home[who] = leaf
            who, near = who[lives[who]], self.sample[self.nodes[leaf].rows]
            if len(near) > k + 1 and len(who):  # the vector itself may be among them
                kth = np.partition(x[who] @ near.T, -(k + 1), axis=1)[:, -(k + 1)]
                reach[who] = np.minimum(reach[who], np.sqrt(np.maximum(0, 2 - 2 * kth.astype(np.float64))) + EPS)
        for leaf, who in descend(self.nodes, x, np.where(asks, reach / across, 0.0)):
            parts = self.nodes[leaf].parts
            for part in range(parts):
                here = lives[who] & (home[who] == leaf) & (ids[who] % parts == part)
                go = here | asks[who]
                if go.any():
                    yield f"{leaf}.{part}", who[go], here[go]


_PLACED = pa.schema([("shard", pa.string()), ("cls", pa.int64()), ("vec", pa.binary()), ("asks", pa.bool_()), ("lives", pa.bool_()), ("reach", pa.float64())])
PLACED = "shard string, cls bigint, vec binary, asks boolean, lives boolean, reach double"


def _placed(name: str, cls: pa.Array, vec: pa.Array, asks: pa.Array, rows: np.ndarray, here: np.ndarray, reach: np.ndarray) -> pa.RecordBatch:
    at = pa.array(rows)
    return pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), cls.take(at), vec.take(at), asks.take(at), pa.array(here), pa.array(reach[rows])], schema=_PLACED)


def _shards(n: int, shard: int) -> int:
    return min(MAX_SHARDS, math.ceil(n / shard))


def _sample_size(shards: int) -> int:
    return max(SAMPLE, 8 * shards)


def _routes(reps: DataFrame, shard: int) -> dict[tuple[str, int], Router]:
    """The router of each provider and length; one scan counts, one takes the samples of all."""
    size = F.octet_length("vec")
    groups = {(g["provider"], g["bytes"]): g["n"] for g in reps.groupBy("provider", size.alias("bytes")).agg(F.count(F.lit(1)).alias("n")).collect()}
    many = {k: n for k, n in groups.items() if _shards(n, shard) > 1}
    drawn: dict[tuple[str, int], list] = {k: [] for k in many}
    if many:
        chance, wanted = F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(1_000_000_000)), F.lit(False)
        for (p, b), n in many.items():
            wanted = wanted | ((F.col("provider") == p) & (size == b) & (chance < int(min(1.0, 1.2 * _sample_size(_shards(n, shard)) / n) * 1_000_000_000)))
        for r in reps.where(wanted).groupBy("cls").agg(F.first("provider").alias("provider"), F.first("vec").alias("vec")).select("provider", "vec", chance.alias("c"), "cls").collect():
            drawn[r["provider"], len(r["vec"])].append((r["c"], r["cls"], bytes(r["vec"])))
    out = {}
    for (p, b), n in groups.items():
        if (p, b) in many:
            rows = sorted(drawn[p, b])[: _sample_size(_shards(n, shard))]  # the same sample in every run
            out[p, b // 4] = Router.fit(_unit(np.frombuffer(b"".join(v for _, _, v in rows), "<f4").reshape(-1, b // 4)), _shards(n, shard))
        else:
            out[p, b // 4] = Router([Node(rows=np.zeros(0, np.int64))], np.zeros((0, b // 4), np.float32))
    return out


def _route_on(placed: DataFrame, large: dict[str, int], shard: int, across: float, k: int) -> DataFrame:
    """The rows of the large shards, placed in shards of theirs: each gets a router of its own, fitted in one task on a
    bounded sample of the vectors that live there. Rows meet their shard's router in sorted partitions, salted, and are streamed."""
    mine = placed.where(F.col("shard").isin(*large))
    share = {s: 1.2 * _sample_size(_shards(n, shard)) / n for s, n in large.items()}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chance = mix(b.column(1).to_numpy().view(np.uint64) + np.uint64(2)) / 2.0**64
            yield b.filter(pa.array(chance < np.array([share[s] for s in b.column(0).to_pylist()])))

    def fit(table: pa.Table) -> pa.Table:
        name = table.column("shard")[0].as_py()
        ids, first = np.unique(table.column("cls").to_numpy(), return_index=True)
        at = first[np.argsort(mix(ids.view(np.uint64) + np.uint64(2)), kind="stable")][: _sample_size(_shards(large[name], shard))]
        x = _unit(_matrix(table.column("vec").take(pa.array(at)), int(name.rsplit("|", 2)[1])))
        return pa.table({"shard": [name], "router": pa.array([pickle.dumps(Router.fit(x, _shards(large[name], shard)))], pa.binary())})

    routers = mine.where("lives").select("shard", "cls", "vec").mapInArrow(pick, "shard string, cls bigint, vec binary").groupBy("shard").applyInArrow(fit, "shard string, router binary")
    names = [f.name for f in _PLACED]
    sent = routers.select("shard", *[F.lit(None).cast(t).alias(n) for n, t in zip(names[1:], ("bigint", "binary", "boolean", "boolean", "double"))], "router", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = mine.select(*names, F.lit(None).cast("binary").alias("router"), F.pmod("cls", F.lit(SALTS)).cast("int").alias("salt"))
    ordered = rows.unionByName(sent).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("router").isNull())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = None
        for b in batches:
            if not b.num_rows:
                continue
            shards, heads = b.column(0).to_pylist(), b.column(6)
            cuts = [0, *(i for i in range(1, b.num_rows) if shards[i] != shards[i - 1] or heads[i].is_valid), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if heads[lo].is_valid:
                    router = pickle.loads(heads[lo].as_py())
                    lo += 1
                if lo == hi:
                    continue
                c = [b.column(i).slice(lo, hi - lo) for i in range(6)]
                x, reach = _unit(_matrix(c[2], int(shards[lo].rsplit("|", 2)[1]))), c[5].to_numpy(zero_copy_only=False).copy()
                for name, who, here in router.visits(x, c[1].to_numpy(), *(c[i].to_numpy(zero_copy_only=False) for i in (4, 3)), reach, across, k):
                    yield _placed(f"{shards[lo]}/{name}", c[1], c[2], c[3], who, here, reach)

    return ordered.mapInArrow(route, PLACED)


def nearest(reps: DataFrame, k: int, least: float = -1.0, across: float | None = None, within: float | None = None, queries: DataFrame | None = None, shard: int = SHARD) -> DataFrame:
    """a, b, cosine: classes b among the k most similar of class a with a cosine of at least `least`; ties of the last may come too.

    Each vector lives in one shard, a leaf of a tree fitted on a bounded sample; it also visits the shards that its
    search radius (divided by `across`) reaches past a border: that of the cosine `least`, or the distance of the
    k-th nearest of the sample in its shard, which the true one can't exceed. Shards that come out too large are
    divided once more in the same way. In a shard a tree is built over the vectors that live there and searched by all
    that are there. queries: the classes (cls) that ask; all if None. across and within are BOUNDED if a least cosine
    of 0.8 or more is given, else OPEN; 1 is exact.
    """
    spark = reps.sparkSession
    usual = BOUNDED if least >= 0.8 else OPEN
    across, within = usual[0] if across is None else across, usual[1] if within is None else within
    fitted = _routes(reps, shard)
    routes = spark.sparkContext.broadcast(fitted)
    asked = reps.withColumn("asks", F.lit(True)) if queries is None else reps.join(queries.select("cls").distinct().withColumn("asks", F.lit(True)), "cls", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            providers, sizes = b.column(1).to_pylist(), pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False)
            groups: dict[tuple[str, int], list[int]] = {}
            for i, (p, s) in enumerate(zip(providers, sizes)):
                groups.setdefault((p, int(s) // 4), []).append(i)
            for (p, dim), rows in groups.items():
                part = b.take(pa.array(rows))
                x, asks = _unit(_matrix(part.column(2), dim)), part.column(3)
                reach = np.full(len(x), math.sqrt(max(0.0, 2 - 2 * least)))
                for name, who, here in routes.value[p, dim].visits(x, part.column(0).to_numpy(), np.ones(len(x), bool), asks.to_numpy(zero_copy_only=False), reach, across, k):
                    yield _placed(f"{p}|{dim}|{name}", part.column(0), part.column(2), asks, who, here, reach)

    def look(table: pa.Table) -> pa.Table:
        raw = _matrix(table.column("vec"), int(table.column("shard")[0].as_py().rsplit("|", 2)[1]))
        # the same class may come from several rows: copies of one vector count once
        cls, first = np.unique(table.column("cls").to_numpy(), return_index=True)
        raw = raw[first]
        x = _unit(raw)
        lives, asks = table.column("lives").to_numpy()[first], table.column("asks").to_numpy()[first]
        data, who = np.flatnonzero(lives), np.flatnonzero(asks)
        own = np.full(len(x), -1)
        own[data] = np.arange(len(data))
        a, r, s = search(x[data], x[who], k, least, within, own[who], cosines(raw[who], raw[data]))
        return pa.table({"a": cls[who[a]], "b": cls[data[r]], "cosine": np.asarray(s, np.float64)})

    columns = ["cls", "provider", "vec", "asks"]
    placed = asked.select(*columns).mapInArrow(route, PLACED)
    if any(len(r.sample) for r in fitted.values()):
        # Who lives where, before anybody visits: at most MAX_SHARDS counts of a provider and length.
        homes = reps.withColumn("asks", F.lit(False)).select(*columns).mapInArrow(route, PLACED).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        large = {r["shard"]: r["n"] for r in homes.where(F.col("n") > LARGE * shard).collect()}
        if large:
            placed = placed.where(~F.col("shard").isin(*large)).unionByName(_route_on(placed, large, shard, across, k))
    return placed.select("shard", "cls", "vec", "asks", "lives").groupBy("shard").applyInArrow(look, "a bigint, b bigint, cosine double")


def _first_keys(members: DataFrame, k: int) -> DataFrame:
    """cls, firsts: the k + 1 smallest keys of each class. A limit by rank runs before the shuffle, so a hot class stays small."""
    w = Window.partitionBy("cls").orderBy("key")
    least = members.select("cls", "key").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    return least.groupBy("cls").agg(F.array_sort(F.collect_list("key")).alias("firsts"))


def similar_vectors(df: DataFrame, k: int = 5, least: float = -1.0, key: str = "chunk_id", provider: str = "provider", dim: str = "dim", embedding: str = "embedding", across: float | None = None, within: float | None = None, queries: DataFrame | None = None, shard: int = SHARD) -> DataFrame:
    """provider, key, neighbour, cosine, rank: for each usable vector the k most similar others of its provider and length.

    queries: the keys (column key) that ask; all if None. Vectors that are null, empty, zero, hold nulls, NaN or
    infinity or have another length than `dim` are left out, as are null keys and providers; repeated rows count
    once; a key with several vectors asks with each. Of equally similar ones the smaller keys are taken. Equal
    vectors are searched for once, and the k smallest keys of a class stand for it in the results.
    """
    rows = usable(df, key, provider, dim, embedding)
    members, reps = vector_classes(rows)
    asking = None
    if queries is not None:
        members_asking = members.join(queries.select(F.col("key").cast("string").alias("key")).distinct(), "key", "left_semi")
        asking = members_asking.select("cls").distinct()
    else:
        members_asking = members
    near = nearest(reps, k, least, across, within, asking, shard)
    best = near.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    firsts = _first_keys(members, k)
    # each class offers its first keys; itself with cosine 1
    others = best.join(firsts.withColumnRenamed("cls", "b"), "b").select("a", F.explode("firsts").alias("neighbour"), "cosine")
    several = firsts.where(F.size("firsts") > 1).select(F.col("cls").alias("a"), F.explode("firsts").alias("neighbour"), F.lit(1.0).alias("cosine"))
    several = several if queries is None else several.join(asking.withColumnRenamed("cls", "a"), "a", "left_semi")
    offers = others.unionByName(several).groupBy("a").agg(F.expr(f"slice(array_sort(collect_list(struct(-cosine as d, neighbour))), 1, {2 * k + 2})").alias("offers"))
    asks = members_asking.withColumnRenamed("cls", "a").join(offers, "a")
    ranked = asks.select("provider", "key", F.expr(f"slice(filter(offers, o -> o.neighbour <> key), 1, {k})").alias("o"))
    return ranked.select("provider", "key", F.posexplode("o").alias("rank", "o")).select("provider", "key", F.col("o.neighbour").alias("neighbour"), (-F.col("o.d")).alias("cosine"), (F.col("rank") + 1).alias("rank"))


def found(df: DataFrame) -> DataFrame:
    """provider, chunk_id_a < chunk_id_b: pairs with a cosine of at least 0.9, one among the five most similar of the other."""
    s = similar_vectors(df, k=5, least=0.9)
    return s.select("provider", F.least("key", "neighbour").alias("chunk_id_a"), F.greatest("key", "neighbour").alias("chunk_id_b")).distinct()


def recall(df: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, enough: float = 0.9) -> DataFrame:
    """provider, queries, expected, enough: how many keys ask, how many neighbours they have, and whether the search without a
    least cosine, relaxed as OPEN says, finds at least that share of them. The exact search tells what there is to find."""
    exact = similar_vectors(df, k, across=1.0, within=1.0, queries=queries, shard=shard).select("provider", "key", "neighbour").distinct()
    relaxed = similar_vectors(df, k, queries=queries, shard=shard).select("provider", "key", "neighbour").distinct().withColumn("there", F.lit(1))
    both = exact.join(relaxed, ["provider", "key", "neighbour"], "left")
    return both.groupBy("provider").agg(F.countDistinct("key").alias("queries"), F.count(F.lit(1)).alias("expected"), (F.count("there") >= enough * F.count(F.lit(1))).alias("enough"))


def brute_force(x: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k most similar of each query, for measuring recall."""
    s = q @ x.T
    s[np.arange(len(q)), own] = -2
    return np.argsort(-s, axis=1, kind="stable")[:, :k]
