"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged.

Vectors are dealt by hash over shards of about ``SHARD_ROWS``, so the number of shards grows with the data and
a shard's size doesn't. Each shard's graph is built in one task and stored as one row of flat arrays: the
vectors (single precision where that holds them exactly), and per level the neighbours of each node
(``n x links``, -1: none). Nodes enter a graph in the order of their ids; each is linked with diverse ones of the nearest of those
before it, found exactly by products of blocks, for a shard is small. Queries are packed into blocks.
``SHARDS_A_TASK`` graphs and ``QUERIES_A_TASK`` queries meet in one task: there a graph is unpacked once and
all the queries descend its levels together, greedily, and widen the search on the lowest. The nearest of each
shard are scored exactly, in double precision on the original vectors, and the best over all shards are kept.
Every query meets every shard, so the work grows with queries x shards.

Vectors that are equal are one node of the graph; it stands for those of their rows with the smallest
vec_id, as many as one answer can hold (``K`` and the query itself). Rows beyond these lose every tie, so no
answer can miss them. Null vectors, zero vectors and vectors with null or non-finite parts take no part,
neither as queries nor as candidates; nor do vectors whose length isn't that of most. Rows with a null vec_id take no part.
Repeated rows (same vec_id and vector) count once.

Nearness is the cosine; ties go to the smaller vec_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.llm.common import ship_package, written

K = 5
QUERY_STEP = 50
SHARD_ROWS = 4096     # nodes of a graph, about
BLOCK = 256           # queries of a block
SHARDS_A_TASK, QUERIES_A_TASK = 4, 16384   # that meet, about; graphs are sent once to each part of the queries, queries once to each group of shards
AT_ONCE = 256         # queries that search a graph together
OPENED = 8            # nodes that a query opens before its found ones are put in order again
LINKS = 12            # links of a node on the upper levels; twice as many on the lowest
BUILD_WIDTH, SEARCH_WIDTH = 48, 48


class Graph:
    """A hierarchical navigable small-world graph over unit vectors; distances are 1 - cosine."""

    def __init__(self, vectors: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = len(vectors)
        self.vectors = vectors.astype(np.float32)
        self.level = np.minimum((-np.log(1.0 - rng.random(n)) / math.log(LINKS)).astype(np.int64), 8)
        top = int(self.level.max()) if n else 0
        self.entry = int(self.level.argmax()) if n else 0
        self.links = [self._linked(np.flatnonzero(self.level >= k), 2 * LINKS if k == 0 else LINKS) for k in range(top + 1)]

    @classmethod
    def stored(cls, vectors: np.ndarray, level: np.ndarray, links: list[np.ndarray], entry: int) -> Graph:
        g = cls.__new__(cls)
        g.vectors, g.level, g.links, g.entry = vectors, level, links, entry
        return g

    def _earlier(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of a level's nodes the ``BUILD_WIDTH`` nearest of those before it, nearest first (-1: none), and their cosines."""
        v, width = self.vectors[nodes], min(BUILD_WIDTH, len(nodes))
        near, close = np.full((len(nodes), width), -1, np.int64), np.full((len(nodes), width), -np.inf, np.float32)
        for at in range(0, len(nodes), 512):
            end = min(at + 512, len(nodes))
            c = v[at:end] @ v[:end].T
            c[np.arange(end)[None, :] >= np.arange(at, end)[:, None]] = -np.inf
            best = np.argpartition(-c, width - 1, axis=1)[:, :width] if width < end else np.broadcast_to(np.arange(end), (end - at, end))
            found = np.take_along_axis(c, best, 1)
            order = np.argsort(-found, axis=1, kind="stable")
            best, found = np.take_along_axis(best, order, 1)[:, :width], np.take_along_axis(found, order, 1)[:, :width]
            near[at:end, :best.shape[1]] = np.where(np.isfinite(found), nodes[best], -1)
            close[at:end, :best.shape[1]] = found
        return near, close

    def _diverse(self, near: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (nearest first, -1: none) ``most``: those nearer to the node than to each other, filled up with the nearest of the rest."""
        n, width = near.shape
        chosen = np.full((n, most), -1, np.int64)
        step = max(1, 2_000_000 // (width * width))
        for at in range(0, n, step):
            some, c = near[at:at + step], close[at:at + step]
            there = some >= 0
            v = self.vectors[some]
            between = v @ v.transpose(0, 2, 1)
            kept, held, nearest = np.zeros(some.shape, bool), np.zeros(len(some), np.int64), np.full(some.shape, -np.inf, np.float32)
            for a in range(width):
                take = np.flatnonzero(there[:, a] & (held < most) & (nearest[:, a] < c[:, a]))
                kept[take, a] = True
                held[take] += 1
                nearest[take] = np.maximum(nearest[take], between[take, a])
            place = np.arange(width)[None, :] + np.where(kept, 0, width) + np.where(there, 0, 2 * width)
            order = np.argsort(place, axis=1, kind="stable")[:, :most]
            chosen[at:at + step, :order.shape[1]] = np.take_along_axis(some, order, 1)
        return chosen

    def _linked(self, nodes: np.ndarray, most: int) -> np.ndarray:
        """The links of a level: those that nodes choose as they enter, and the way back, of which a node keeps ``most``."""
        links = np.full((len(self.vectors), most), -1, np.int64)
        ahead = self._diverse(*self._earlier(nodes), LINKS)
        a, b = np.repeat(nodes, ahead.shape[1]), ahead.ravel()
        a, b = a[b >= 0], b[b >= 0]
        node, other = np.concatenate([a, b]), np.concatenate([b, a])
        close = np.concatenate([np.einsum("ij,ij->i", self.vectors[a[i:i + 8192]], self.vectors[b[i:i + 8192]]) for i in range(0, len(a), 8192)] or [np.empty(0, np.float32)])
        close = np.concatenate([close, close])
        order = np.lexsort((other, -close, node))
        node, other, close = node[order], other[order], close[order]
        held = np.bincount(node, minlength=len(links))
        place = np.arange(len(node)) - (np.cumsum(held) - held)[node]
        few = held[node] <= most
        links[node[few], place[few]] = other[few]
        width = most
        while width < held.max(initial=0):
            many = np.flatnonzero((held > width) & (held <= 2 * width))
            width *= 2
            if not len(many):
                continue
            row = np.full(len(links), -1, np.int64)
            row[many] = np.arange(len(many))
            own = row[node] >= 0
            near, far = np.full((len(many), width), -1, np.int64), np.full((len(many), width), -np.inf, np.float32)
            near[row[node[own]], place[own]], far[row[node[own]], place[own]] = other[own], close[own]
            links[many] = self._diverse(near, far, most)
        return links

    def _greedy(self, q: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
        """For each query the node of a level from which no link leads nearer."""
        node, best = node.copy(), np.einsum("ij,ij->i", self.vectors[node], q)
        go = np.arange(len(q))
        while len(go):
            near = self.links[k][node[go]]
            close = np.matmul(self.vectors[near], q[go, :, None])[:, :, 0]
            close[near < 0] = -np.inf
            i = close.argmax(axis=1)
            c, to = close[np.arange(len(go)), i], near[np.arange(len(go)), i]
            on = c > best[go]
            go = go[on]
            node[go], best[go] = to[on], c[on]
        return node

    def _wide(self, q: np.ndarray, node: np.ndarray, k: int, width: int) -> np.ndarray:
        """For each query the ``width`` nearest nodes found on a level, nearest first (-1: none)."""
        n, links, vectors = len(self.vectors), self.links[k], self.vectors
        out = np.full((len(q), width), -1, np.int64)
        own = np.arange(len(q))                                     # the queries that still search
        found, close, ahead = np.full((len(q), width), -1, np.int64), np.full((len(q), width), -np.inf, np.float32), np.zeros((len(q), width), bool)
        found[:, 0], close[:, 0], ahead[:, 0] = node, np.einsum("ij,ij->i", vectors[node], q), True
        seen, stamp = np.zeros(len(q) * n, bool), np.empty(len(q) * n, np.int32)
        seen[own * n + node] = True
        while True:
            going = ahead.any(axis=1)
            if not going.all():
                out[own[~going]] = found[~going]
                own, found, close, ahead = own[going], found[going], close[going], ahead[going]
            if not len(own):
                return out
            opened = ahead & (np.cumsum(ahead, axis=1) <= OPENED)
            ahead &= ~opened
            row, at = np.nonzero(opened)
            near = links[found[row, at]]
            row = np.repeat(row, near.shape[1])
            near = near.ravel()
            new = near >= 0
            row, near = row[new], near[new]
            key = own[row] * n + near
            new = ~seen[key]
            row, near, key = row[new], near[new], key[new]
            number = np.arange(len(key), dtype=np.int32)            # two of the opened nodes may lead to the same
            stamp[key] = number
            new = stamp[key] == number
            row, near = row[new], near[new]
            seen[key] = True
            c = np.einsum("ij,ij->i", vectors[near], q[own[row]])
            new = c > close[row, -1]
            row, near, c = row[new], near[new], c[new]
            if not len(row):
                continue
            held = np.bincount(row, minlength=len(own))
            place = np.arange(len(row)) - (np.cumsum(held) - held)[row] + width
            most = width + int(held.max())
            all_f, all_c, all_a = np.full((len(own), most), -1, np.int64), np.full((len(own), most), -np.inf, np.float32), np.zeros((len(own), most), bool)
            all_f[:, :width], all_c[:, :width], all_a[:, :width] = found, close, ahead
            all_f[row, place], all_c[row, place], all_a[row, place] = near, c, True
            order = np.argsort(-all_c, axis=1, kind="stable")[:, :width]
            found, close, ahead = np.take_along_axis(all_f, order, 1), np.take_along_axis(all_c, order, 1), np.take_along_axis(all_a, order, 1)

    def nearest(self, q: np.ndarray, width: int) -> np.ndarray:
        """For each of the unit vectors ``q`` the ``width`` nearest nodes found, nearest first (-1: none)."""
        node = np.full(len(q), self.entry, np.int64)
        for k in range(len(self.links) - 1, 0, -1):
            node = self._greedy(q, node, k)
        return self._wide(q, node, 0, width)


_DEALT = "shard int, vec_id long, dim int, v binary"
_INDEX = "shard int, dim int, ids array<array<bigint>>, original binary, level binary, links array<binary>, entry int"


def _unit(rows: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _bytes(rows: np.ndarray) -> list[bytes]:
    """Each vector's bytes, in single precision where that is exact; equal vectors have equal bytes."""
    with np.errstate(over="ignore"):
        short = rows.astype(np.float32)
    exact = (short == rows).all(axis=1).tolist()
    return [(a if e else b).tobytes() for a, b, e in zip(short, rows, exact, strict=True)]


def _doubles(vectors: list[bytes], dim: int) -> np.ndarray:
    if all(len(x) == 4 * dim for x in vectors):
        return np.frombuffer(b"".join(vectors), np.float32).reshape(-1, dim).astype(np.float64)
    return np.array([np.frombuffer(x, np.float32 if len(x) == 4 * dim else np.float64) for x in vectors], np.float64).reshape(-1, dim)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _first(shards: int, k: int):
    """A task's rows, sorted by hash and number: of equal vectors those of the first ``k + 1`` numbers, dealt over shards by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, hashes = _matrix(batch.column("v")), batch.column("h").to_pylist()
            out: list[tuple[int, int, bytes]] = []
            for h, i, x in zip(hashes, batch.column("vec_id").to_pylist(), _bytes(rows), strict=True):
                if h != last:
                    last, held = h, {}
                ids = held.setdefault(x, [])
                if len(ids) <= k and (not ids or ids[-1] != i):
                    ids.append(i)
                    out.append((h % shards, i, x))
            a, b, c = zip(*out, strict=True) if out else ((), (), ())
            yield pa.record_batch([pa.array(a, pa.int32()), pa.array(b, pa.int64()), pa.array([rows.shape[1]] * len(a), pa.int32()), pa.array(c, pa.binary())],
                                  names=["shard", "vec_id", "dim", "v"])
    return run


def _build(k: int):
    """One row per shard; rows come sorted by shard and number."""
    def row(shard: int, dim: int, held: dict[bytes, list[int]]) -> pa.RecordBatch:
        original = _doubles(list(held), dim)
        g = Graph(_unit(original))
        short = all(len(x) == 4 * dim for x in held)
        number = np.int16 if len(original) < 2 ** 15 else np.int32
        schema = ["shard", "dim", "ids", "original", "level", "links", "entry"]
        return pa.record_batch([pa.array([shard], pa.int32()), pa.array([dim], pa.int32()), pa.array([list(held.values())], pa.list_(pa.list_(pa.int64()))),
                                pa.array([original.astype(np.float32 if short else np.float64).tobytes()]), pa.array([g.level.astype(np.int8).tobytes()]),
                                pa.array([[x.astype(number).tobytes() for x in g.links]], pa.list_(pa.binary())), pa.array([g.entry], pa.int32())], names=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, dim, held = None, 0, {}
        for batch in batches:
            for s, i, d, x in zip(*(batch.column(c).to_pylist() for c in ("shard", "vec_id", "dim", "v")), strict=True):
                if s != shard:
                    if held:
                        yield row(shard, dim, held)
                    shard, dim, held = s, d, {}
                ids = held.setdefault(x, [])
                if len(ids) <= k and (not ids or ids[-1] != i):
                    ids.append(i)
        if held:
            yield row(shard, dim, held)
    return run


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null").filter(sound)
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["dim"] if sizes else 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))


def index(spark: SparkSession, rows: DataFrame, k: int = K) -> DataFrame:
    """The shards' graphs over all of ``rows`` (vec_id, v), one row per shard."""
    ship_package(spark)
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("h"))
    shards = max(1, math.ceil(rows.agg(F.count_distinct("h")).first()[0] / SHARD_ROWS))
    # equal vectors have one hash and so one shard; their smallest numbers stand for all, in each task before the shuffle and after it
    dealt = rows.sortWithinPartitions("h", "vec_id").mapInArrow(_first(shards, k), _DEALT)
    built = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "vec_id").mapInArrow(_build(k), _INDEX)
    return written(spark, built, "vectors-index")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of queries."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            v = _matrix(part.column("v"))
            yield pa.record_batch([pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([_bytes(v)], pa.list_(pa.binary()))], names=["queries", "q"])


def _in_graph(row: dict, queries: np.ndarray, q: np.ndarray, unit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, vec_id and score of the nearest in one shard: at least ``k`` for each query, if there are as many."""
    dim, n = row["dim"], len(row["ids"])
    original = np.frombuffer(row["original"], np.float32 if len(row["original"]) == 4 * dim * n else np.float64).reshape(n, dim).astype(np.float64)
    links = [np.frombuffer(x, np.int16 if n < 2 ** 15 else np.int32).reshape(n, -1).astype(np.int64) for x in row["links"]]
    g = Graph.stored(_unit(original).astype(np.float32), np.frombuffer(row["level"], np.int8), links, row["entry"])
    norms = np.sqrt((original * original).sum(axis=1))
    many = max(map(len, row["ids"]))
    ids, there = np.zeros((n, many), np.int64), np.zeros((n, many), bool)
    for i, x in enumerate(row["ids"]):
        ids[i, :len(x)], there[i, :len(x)] = x, True
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), AT_ONCE):
        number, x = queries[at:at + AT_ONCE], q[at:at + AT_ONCE]
        found = g.nearest(unit[at:at + AT_ONCE], SEARCH_WIDTH)
        scores = (original[found] * x[:, None, :]).sum(axis=2) / (norms[found] * np.sqrt((x * x).sum(axis=1))[:, None])
        # k + 1 nodes, as one number may be the query's own
        order = np.lexsort((ids[found, 0], -scores, found < 0), axis=1)[:, :k + 1]
        found, scores = np.take_along_axis(found, order, 1), np.take_along_axis(scores, order, 1)
        good = (there[found] & (found >= 0)[:, :, None] & (ids[found] != number[:, None, None])).reshape(len(x), -1)
        a, _ = np.nonzero(good)
        out.append((number[a], ids[found].reshape(len(x), -1)[good], np.repeat(scores, many, axis=1)[good]))
    a, b, c = zip(*out, strict=True)
    return np.concatenate(a), np.concatenate(b), np.concatenate(c)


def _search(k: int):
    """The graphs of a group of shards, and a part of the queries: query_id, vec_id and score of the ``k`` nearest."""
    def run(graphs: pa.Table, blocks: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        if not graphs.num_rows or not blocks.num_rows:
            return none
        queries = np.array([i for x in blocks.column("queries").to_pylist() for i in x], np.int64)
        q = _doubles([v for x in blocks.column("q").to_pylist() for v in x], graphs.column("dim")[0].as_py())
        unit, best = _unit(q).astype(np.float32), (queries[:0], queries[:0], q[:0, 0])
        for at in range(graphs.num_rows):
            row = graphs.slice(at, 1).to_pylist()[0]
            a, b, c = (np.concatenate(x) for x in zip(best, _in_graph(row, queries, q, unit, k), strict=True))
            order = np.lexsort((b, -c, a))
            a, b, c = a[order], b[order], c[order]
            start = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
            rank = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
            best = a[rank < k], b[rank < k], c[rank < k]
        return pa.table([pa.array(best[0]), pa.array(best[1]), pa.array(best[2])], names=names)
    return run


def search(spark: SparkSession, graphs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each of ``queries`` (vec_id, v), itself apart.

    Every query meets every shard: groups of shards and parts of the queries meet by their numbers, each pair in a task of its own.
    """
    last = graphs.agg(F.max("shard")).first()[0]
    groups = 1 if last is None else last // SHARDS_A_TASK + 1
    blocks = written(spark, queries.dropDuplicates(["vec_id"]).mapInArrow(_pack, "queries array<bigint>, q array<binary>"), "vectors-queries")
    parts = max(1, math.ceil((blocks.agg(F.sum(F.size("queries"))).first()[0] or 0) / QUERIES_A_TASK))
    keys, tasks = ["group", "part"], max(1, 2 * groups * parts)     # twice the pairs, so that few share a task

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = graphs.withColumn("group", F.floor(F.col("shard") / SHARDS_A_TASK).cast("int")).withColumn("part", every(parts)).repartition(tasks, *keys)
    right = blocks.withColumn("part", F.pmod(F.xxhash64("queries"), F.lit(parts)).cast("int")).withColumn("group", every(groups)).repartition(tasks, *keys)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def stated_queries(rows: DataFrame, step: int = QUERY_STEP) -> DataFrame:
    return rows.filter(F.col("vec_id") % step == 0)
