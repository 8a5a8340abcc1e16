"""Hard-negative mining with STR-packed R-trees.

Entries become whole numbers, floor(256 x); a score is the integer inner product of two vectors. Equal vectors of
one label are one *class*, which stands for its rows with the smallest vec_id, as many as an answer
can hold; rows beyond lose every tie, so no answer can miss them.

Packing: classes are cut into slabs by label, slabs into tiles by the coordinate of the largest spread (approximate
quantiles of all rows; results don't depend on them), and tiles that hold more than ``TREE_ROWS`` are split by a hash, so no
tile is larger, however many rows share a label or a coordinate. Each tile is one R-tree, packed by sorting and
cutting along one coordinate after another, and stored as one row of flat arrays. A node's bounding box covers
its labels and every coordinate.

Search: a block of anchors is kept in memory while the trees of a lane pass by. A box bounds the inner product per
coordinate from below and above; a best-first queue, highest bound first, drops boxes that lie outside every
score window asked for, hold no label that counts, or can't reach the k-th best score found so far. A box that can
just reach it is opened, as ties go to the smaller vec_id. The first search finds each anchor's positives, the second the negatives in
the windows that the positives' scores set. Lanes' results are merged. Anchors that are equal are searched once.

Rows with a null label, vector or entry, a non-finite entry or a null vec_id take no part. Vectors of
different lengths never meet. Entries beyond 2^53 / 256 count as that bound; a score beyond a long is returned as null. Repeated
rows (same vec_id, label and vector) count once. An anchor without positives, or a positive without negatives in
its window, gives no row. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.llm.common import join_small, ship_package, written

SCALE = 256.0
LARGEST = float(1 << 53)
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90         # a negative's score, in percent of the positive's
ANCHOR_STEP, SHIFT_STEP, LABELS = 100, 7, 10
TREE_ROWS = 1024           # classes of a tree, about
LEAF, FANOUT = 16, 8
BLOCK = 4096               # anchors that a task holds at a time
LANE_TREES = 64            # trees that pass a block of anchors in one task, about
CUTS = 64                  # slabs of a level at most
HOT_ANCHORS = 4096         # equal anchors that one task joins with their results
EXACT = float(1 << 53)     # inner products below are exact in doubles

_TREE = "struct<n:int,vectors:binary,kind:string,labels:binary,ids:binary,counts:binary,first:binary,last:binary,low:binary,high:binary>"
_ANCHOR = "struct<rep:bigint,h:bigint,label:bigint,vector:array<double>,asked:array<decimal(38,0)>>"


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, q (whole numbers as doubles) of the rows that take part; some labels are shifted."""
    y = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), y.alias("v"))
    rows = rows.filter("vec_id is not null and label is not null and v is not null")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    held = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("double") + F.lit(0.0))
    shifted = F.when(F.col("vec_id") % SHIFT_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.select("vec_id", shifted.alias("label"), held.alias("q"))


# ------------------------------------------------------------------ packing
def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length and coordinate: number, sum and sum of squares."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        by_length: dict[int, list] = {}
        for q in batch.column("q").to_pylist():
            by_length.setdefault(len(q), []).append(q)
        for d, rows in by_length.items():
            x = np.array(rows, np.float64).reshape(len(rows), d)
            held[d] = held.get(d, 0.0) + np.array([np.full(d, len(rows)), x.sum(axis=0), (x * x).sum(axis=0)])
    for d, (n, s, ss) in held.items():
        if d:
            yield pa.record_batch([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(n), pa.array(s), pa.array(ss)],
                                  names=["dim", "i", "n", "s", "ss"])


def _place(cuts: Column, value: Column, slabs: Column) -> Column:
    """The slab of a value among ``slabs``, by the cut points below it."""
    return F.floor(F.size(F.filter(cuts, lambda c: c <= value)) * slabs / CUTS).cast("int")


def tiles(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """label, q, ids of every class, with the tile (dim, slab, tile, part) that it is dealt to."""
    keep = max(POSITIVES + 1, NEGATIVES)
    first = Window.partitionBy("label", "q").orderBy("vec_id")
    classes = (rows.withColumn("place", F.dense_rank().over(first)).filter(F.col("place") <= keep)
               .groupBy("label", "q").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("dim", F.size("q")))
    classes = written(spark, classes, "negatives-classes")
    variance = F.sum("ss") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), F.lit(2))
    lead = (classes.select("q").mapInArrow(_spread, "dim int, i int, n double, s double, ss double")
            .groupBy("dim", "i").agg(variance.alias("spread")).groupBy("dim").agg(F.max_by("i", F.struct("spread", "i")).alias("lead")))
    cut = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    by_length = classes.groupBy("dim").agg(F.count("*").alias("classes"), F.percentile_approx("label", cut, 1000).alias("cuts"))
    slabs = F.least(F.ceil(F.sqrt(F.col("classes") / TREE_ROWS)), F.lit(CUTS)).cast("int").alias("slabs")
    by_length = written(spark, by_length.join(lead, "dim", "left").select("dim", "cuts", slabs, F.coalesce("lead", F.lit(0)).alias("lead")), "negatives-lengths")
    dealt = join_small(classes, by_length, "dim", by_length.count(), "inner")
    dealt = dealt.withColumn("slab", _place(F.col("cuts"), F.col("label"), F.col("slabs"))).drop("cuts")
    dealt = dealt.withColumn("value", F.get("q", F.col("lead"))).withColumn("key", F.concat_ws("/", "dim", "slab"))
    second = written(spark, dealt.groupBy("key").agg(F.percentile_approx("value", cut, 1000).alias("cuts")), "negatives-slabs")
    dealt = join_small(dealt, second, "key", second.count(), "inner")
    dealt = dealt.withColumn("tile", F.coalesce(_place(F.col("cuts"), F.col("value"), F.col("slabs")), F.lit(0))).withColumn("key", F.concat_ws("/", "key", "tile"))
    dealt = written(spark, dealt.select("label", "q", "ids", "dim", "key"), "negatives-dealt")
    parts = written(spark, dealt.groupBy("key").agg(F.ceil(F.count("*") / TREE_ROWS).cast("int").alias("parts")), "negatives-tiles")
    dealt = join_small(dealt, parts, "key", parts.count(), "inner")
    part = F.pmod(F.xxhash64("q", "label"), "parts").cast("int")
    return dealt.select("label", "q", "ids", "dim", F.concat_ws("/", "key", part.cast("string")).alias("tile"))


class Tree:
    """An R-tree over the rows of a tile. Boxes have a coordinate more than the vectors: the label, last."""

    def __init__(self, vectors, labels, ids, counts, first, last, low, high):
        self.vectors, self.labels, self.ids, self.counts = vectors, labels, ids, counts
        self.starts = np.cumsum(counts) - counts
        self.first, self.last, self.low, self.high = first, last, low, high   # children, or rows as -1 - row

    @classmethod
    def packed(cls, vectors: np.ndarray, labels: np.ndarray, ids: list[list[int]]) -> Tree:
        points = np.hstack([vectors, labels[:, None].astype(np.float64)])
        nodes = [np.arange(len(points))]
        first, last, order, at, done = [], [], [], 0, 0
        while at < len(nodes):
            mine = nodes[at]
            if len(mine) <= LEAF:
                first.append(-1 - done)
                last.append(-1 - done - len(mine))
                order.append(mine)
                done += len(mine)
            else:  # sort by one coordinate, cut into equal runs: labels first, then the one that spreads most
                box = points[mine]
                spread = box.max(axis=0) - box.min(axis=0)
                by = len(spread) - 1 if spread[-1] and not at else int(spread[:-1].argmax()) if len(spread) > 1 else 0
                mine = mine[np.argsort(box[:, by], kind="stable")]
                first.append(len(nodes))
                nodes += np.array_split(mine, min(FANOUT, -(-len(mine) // LEAF)))
                last.append(len(nodes))
            at += 1
        low = np.array([points[m].min(axis=0) for m in nodes])
        high = np.array([points[m].max(axis=0) for m in nodes])
        order = np.concatenate(order)
        some = [ids[i] for i in order]
        return cls(vectors[order], labels[order], np.array([x for i in some for x in i], np.int64), np.array([len(i) for i in some], np.int32),
                   np.array(first, np.int32), np.array(last, np.int32), low, high)

    def row(self) -> dict:
        size = np.abs(self.vectors).max() if self.vectors.size else 0
        kind = "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<f8"
        return {"n": len(self.labels), "vectors": self.vectors.astype(kind).tobytes(), "kind": kind, "labels": self.labels.tobytes(), "ids": self.ids.tobytes(),
                "counts": self.counts.tobytes(), "first": self.first.tobytes(), "last": self.last.tobytes(), "low": self.low.tobytes(), "high": self.high.tobytes()}

    @classmethod
    def stored(cls, row: dict, dim: int) -> Tree:
        first = np.frombuffer(row["first"], np.int32)
        return cls(np.frombuffer(row["vectors"], row["kind"]).astype(np.float64).reshape(row["n"], dim), np.frombuffer(row["labels"], np.int64),
                   np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int32), first, np.frombuffer(row["last"], np.int32),
                   np.frombuffer(row["low"]).reshape(len(first), dim + 1), np.frombuffer(row["high"]).reshape(len(first), dim + 1))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tile; rows come sorted by tile."""
    kind = pa.schema([("tile", pa.string()), ("dim", pa.int32()), ("tree", pa.struct([
        ("n", pa.int32()), ("vectors", pa.binary()), ("kind", pa.string()), *[(c, pa.binary()) for c in ("labels", "ids", "counts", "first", "last", "low", "high")]]))])
    tile, held = None, []

    def row() -> pa.RecordBatch:
        dim = len(held[0][0])
        tree = Tree.packed(np.array([q for q, _, _ in held], np.float64).reshape(len(held), dim), np.array([x for _, x, _ in held], np.int64), [i for _, _, i in held])
        return pa.RecordBatch.from_pylist([{"tile": tile, "dim": dim, "tree": tree.row()}], schema=kind)

    for batch in batches:
        for t, q, label, ids in zip(*(batch.column(c).to_pylist() for c in ("tile", "q", "label", "ids")), strict=True):
            if t != tile and held:
                yield row()
                held = []
            tile = t
            held.append((q, label, ids))
    if held:
        yield row()


def trees(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The R-trees over all of ``rows`` (vec_id, label, q): tile, dim, tree."""
    ship_package(spark)
    dealt = tiles(spark, rows).repartition("tile").sortWithinPartitions("tile", F.col("ids")[0])
    return written(spark, dealt.select("tile", "q", "label", "ids").mapInArrow(_build, f"tile string, dim int, tree {_TREE}"), "negatives-trees")


# ------------------------------------------------------------------ search
class Ask:
    """What one anchor asks for: the ``k`` highest scores from ``low`` to ``high``; kept as (score, -vec_id)."""

    __slots__ = ("key", "low", "high", "k", "best")

    def __init__(self, key, low, high, k: int):
        self.key, self.low, self.high, self.k, self.best = key, low, high, k, []

    def least(self):
        """A score below this is of no use."""
        return max(self.low, self.best[0][0]) if len(self.best) == self.k else self.low

    def offer(self, score, ids) -> None:
        for i in ids:
            if len(self.best) < self.k:
                heapq.heappush(self.best, (score, -i))
            elif (score, -i) > self.best[0]:
                heapq.heapreplace(self.best, (score, -i))


def _searched(tree: Tree, anchors: np.ndarray, labels: list[int], asks: list[list[Ask]], same: bool) -> None:
    """Let every anchor's asks see a tree. ``same``: rows of the anchor's label count, else the others."""
    low, high, vectors = tree.low[:, :-1], tree.high[:, :-1], tree.vectors
    size = max((np.abs(x).max() for x in (low, high) if x.size), default=0.0)
    if np.abs(anchors).max(initial=0.0) * size * max(1, anchors.shape[1]) >= EXACT:
        low, high, vectors, anchors = (np.array([[int(v) for v in r] for r in m], object).reshape(m.shape) for m in (low, high, vectors, anchors))
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    most, fewest = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    label_low, label_high = tree.low[:, -1].tolist(), tree.high[:, -1].tolist()
    first, last = tree.first.tolist(), tree.last.tolist()
    for a, mine in enumerate(asks):
        label, upper, lower = labels[a], most[a].tolist(), fewest[a].tolist()
        queue = [(-upper[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            bound = -bound
            least, greatest = min(x.least() for x in mine), max(x.high for x in mine)
            if bound < least:
                break  # nor can any box after it
            if lower[node] > greatest or not any(bound >= x.least() and lower[node] <= x.high for x in mine):
                continue
            if not label_low[node] <= label <= label_high[node] if same else label_low[node] == label == label_high[node]:
                continue
            if first[node] >= 0:
                for child in range(first[node], last[node]):
                    if upper[child] >= least and lower[child] <= greatest:
                        heapq.heappush(queue, (-upper[child], child))
                continue
            start, stop = -1 - first[node], -1 - last[node]
            scores = vectors[start:stop] @ anchors[a]
            counts = ((tree.labels[start:stop] == label) == same) & (scores >= least) & (scores <= greatest)
            for i in np.flatnonzero(counts).tolist():
                score, at = int(scores[i]), start + i
                ids = tree.ids[tree.starts[at]:tree.starts[at] + tree.counts[at]].tolist()
                for x in mine:
                    if x.least() <= score <= x.high:
                        x.offer(score, ids)


def window(positive: int) -> tuple[int, int]:
    """The scores that a negative may have."""
    return -((-LOW * positive) // 100), (HIGH * positive) // 100


def _lane(same: bool, k: int):
    """Blocks of anchors, each followed by the trees of its lane."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, anchors, matrix, asks = None, [], None, []

        def found() -> pa.RecordBatch:
            out = [(r["rep"], r["h"], x.key, -i, str(s)) for r, mine in zip(anchors, asks, strict=True) for x in mine for s, i in x.best]
            rep, h, asked, vec, score = zip(*out, strict=True) if out else ((),) * 5
            return pa.record_batch([pa.array(rep, pa.int64()), pa.array(h, pa.int64()), pa.array(asked, pa.string()), pa.array(vec, pa.int64()), pa.array(score, pa.string())],
                                   names=["rep", "h", "asked", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                key = row["dim"], row["block"], row["lane"]
                if key != at:
                    if anchors:
                        yield found()
                    at, anchors, matrix, asks = key, [], None, []
                if row["anchor"] is not None:
                    anchors.append(row["anchor"])
                    asks.append([Ask(None, float("-inf"), float("inf"), k)] if same else [Ask(str(p), *window(int(p)), k) for p in row["anchor"]["asked"]])
                elif anchors:
                    if matrix is None:
                        matrix = np.array([r.pop("vector") for r in anchors], np.float64).reshape(len(anchors), row["dim"])
                        labels = [r["label"] for r in anchors]
                    _searched(Tree.stored(row["tree"], row["dim"]), matrix, labels, asks, same)
        if anchors:
            yield found()
    return run


def search(spark: SparkSession, forest: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """rep, h, asked, place, vec_id, score: the ``k`` best for each anchor (rep, h, label, q, asked) and score asked for.

    Trees are dealt to lanes, anchors to blocks; each pair of a block and a lane (of vectors of one length) is a unit of work.
    """
    by_length = (anchors.groupBy(F.size("q").alias("dim")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
                 .join(forest.groupBy("dim").agg(F.count("*").alias("trees")), "dim"))
    cores = spark.sparkContext.defaultParallelism
    lanes = F.greatest(F.ceil(F.col("trees") / LANE_TREES), F.least("trees", F.ceil(2 * cores / F.col("blocks")))).cast("int")
    by_length = written(spark, by_length.select("dim", "blocks", lanes.alias("lanes")), "negatives-plan")
    n = by_length.count()
    a = join_small(anchors.withColumn("dim", F.size("q")), by_length, "dim", n, "inner")
    a = a.select("dim", F.pmod(F.xxhash64("rep", "h"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"),
                 F.lit("").alias("tile"), F.struct("rep", "h", "label", F.col("q").alias("vector"), "asked").alias("anchor"), F.lit(None).cast(_TREE).alias("tree"))
    t = join_small(forest, by_length, "dim", n, "inner")
    t = t.select("dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("tile"), "lanes").cast("int").alias("lane"),
                 "tile", F.lit(None).cast(_ANCHOR).alias("anchor"), "tree")
    met = a.unionByName(t).repartition("dim", "block", "lane").sortWithinPartitions("dim", "block", "lane", "tile")
    found = met.mapInArrow(_lane(same, k), "rep long, h long, asked string, vec_id long, score string")
    found = found.withColumn("score", F.col("score").cast("decimal(38,0)")).withColumn("asked", F.col("asked").cast("decimal(38,0)"))
    best = Window.partitionBy("rep", "h", "asked").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def mined(spark: SparkSession, embeddings: DataFrame, step: int = ANCHOR_STEP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every anchor, a vec_id divisible by ``step``."""
    rows = prepared(embeddings)
    forest = trees(spark, rows)
    anchors = rows.filter(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("anchor_id"), "label", "q", F.xxhash64("label", "q").alias("h"))
    equal = anchors.groupBy("label", "q", "h").agg(F.min("anchor_id").alias("rep"), F.count("*").alias("many"))
    equal = written(spark, equal, "negatives-anchors")
    positives = search(spark, forest, equal.withColumn("asked", F.lit(None).cast("array<decimal(38,0)>")), True, POSITIVES + 1)
    positives = positives.groupBy("rep", "h").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("pos"))
    positives = written(spark, positives, "negatives-positives")
    asked = F.filter(F.array_distinct(F.transform("pos", lambda p: p.score)), lambda s: s >= 0).alias("asked")   # below zero the window is empty
    asking = equal.join(positives.select("rep", "h", asked), ["rep", "h"]).filter(F.size("asked") > 0)
    negatives = search(spark, forest, asking, False, NEGATIVES).groupBy("rep", "h").agg(
        F.collect_list(F.struct("asked", "place", "vec_id", "score")).alias("neg"))
    packed = equal.select("rep", "h", "label", "q", F.ceil(F.col("many") / HOT_ANCHORS).cast("int").alias("salts")).join(positives, ["rep", "h"]).join(negatives, ["rep", "h"])
    packed = written(spark, packed, "negatives-packed")
    # equal anchors share their results; many of them are dealt over salts
    by_vector = packed.select("label", "q", "pos", "neg", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hot = packed.filter("salts > 1").select("label", "q", "salts")
    mine = anchors.distinct()
    mine = join_small(mine.withColumn("key", F.struct("label", "q")), hot.select(F.struct("label", "q").alias("key"), "salts"), "key", hot.count())
    mine = mine.select("anchor_id", "label", "q", F.pmod(F.xxhash64("anchor_id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    met = mine.join(by_vector, ["label", "q", "salt"])
    pos = F.slice(F.filter("pos", lambda p: p.vec_id != F.col("anchor_id")), 1, POSITIVES)
    met = met.select("anchor_id", F.explode(pos).alias("p"), "neg")
    met = met.select("anchor_id", "p", F.explode(F.filter("neg", lambda x: x.asked == F.col("p.score"))).alias("x"))
    return met.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("x.place").alias("rank"), F.col("x.vec_id").alias("negative_id"),
                      F.col("p.score").try_cast("long").alias("positive_score"), F.col("x.score").try_cast("long").alias("negative_score"))


def oracle() -> str:
    return """
with r as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), a as (select vec_id as anchor_id, label, q from r where vec_id % 100 = 0),
s as (select a.anchor_id, r.vec_id, a.label = r.label as same, cast(list_dot_product(a.q, r.q) as bigint) as score
      from a join r on r.vec_id <> a.anchor_id and len(r.q) = len(a.q)),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) <= 10"""
