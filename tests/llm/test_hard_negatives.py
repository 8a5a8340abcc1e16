import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import hard_negatives as H
from paddock.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, step):
    """Exact, over Python integers."""
    use = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        use.setdefault((i, tuple(math.floor(max(min(256 * c, 2.0 ** 53), -(2.0 ** 53))) for c in v), int(label)))
    out = set()
    for i, a, label in use:
        if i % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), j, other == label) for j, b, other in use if j != i and len(b) == len(a))
        positives = [(-s, j) for s, j, same in scored if same][:5]
        for p, j in positives:
            fit = [(-s, k) for s, k, same in scored if not same and 30 * p <= 100 * -s <= 90 * p][:10]
            small = lambda x: x if -(2 ** 63) <= x < 2 ** 63 else None
            out |= {(i, j, r, k, small(p), small(s)) for r, (s, k) in enumerate(fit, 1)}
    return out


def check(spark, rows, step, at_least=1):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in H.mined(spark, df, step).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    want = brute(rows, step)
    assert len(got) == len(set(got)) and set(got) == want and len(want) >= at_least


@pytest.fixture
def small_trees(monkeypatch):
    for name, value in {"TREE_ROWS": 40, "BLOCK": 3, "LANE_TREES": 2, "LEAF": 4, "FANOUT": 3, "HOT_ANCHORS": 4}.items():
        monkeypatch.setattr(H, name, value)


def test_table(spark, sf):
    df = table(spark, sf.replace("0.001", "0.01"), "embeddings")
    check(spark, [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()], 20, 500)


def test_many_small_trees(spark, small_trees):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 5)) + 1
    check(spark, [(i, x, int(rng.integers(0, 4))) for i, x in enumerate(v.tolist())], 10, 500)


def test_ties_equal_vectors_and_hot_anchors(spark, small_trees):
    rng = np.random.default_rng(3)
    some = rng.integers(0, 2, size=(120, 3)) / 2.0
    rows = [(i, x, i % 3) for i, x in enumerate(some.tolist())] + [(1000 + i, [1.0, 1.0, 1.0], 1) for i in range(150)]
    check(spark, rows, 5, 1000)


def test_rows_that_take_no_part_lengths_repeats_and_extremes(spark, small_trees):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4 if i % 3 else 6).tolist(), i % 2) for i in range(60)]
    rows += [(100, None, 1), (110, [1.0, None, 1.0, 1.0], 1), (120, [math.nan] * 4, 0), (130, [math.inf, 0.0, 0.0, 0.0], 0), (140, [1.0] * 4, None),
             (None, [1.0] * 4, 1), (150, [], 1), (160, [], 0), (170, [-0.0, 0.0, 1e-300, -1e-300], -3)]
    rows += rows[:7]                                                     # repeated rows
    rows += [(200, [1e18, 0.0, 0.0, 0.0], 0), (210, [1e300, 0.0, 1.0, 0.0], 0), (203, [4e17, 1.0, 0.0, 0.0], 1), (211, [1e12, 1.0, 0.0, 0.0], 1),
             (220, [1e15, 1.0, 0.0, 0.0], 0)]
    check(spark, rows, 10, 100)


def test_nothing_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.mined(spark, empty).collect() == []
    rows = [(i * 10, [1.0, i / 10], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("q", "v", "dim", "tile", "rep", "h", "ids", "tree", "anchor_id")})
    assert {tuple(r) for r in H.mined(spark, df).collect()} == brute(rows, 100)
    one_label = [(i * 100, [1.0], 1) for i in range(1, 5)]                # no negatives
    assert H.mined(spark, spark.createDataFrame(one_label, SCHEMA)).collect() == []


def test_boxes_bound_every_score():
    rng = np.random.default_rng(5)
    v = rng.integers(-50, 50, size=(200, 4)).astype(float)
    tree = H.Tree.packed(v, rng.integers(0, 3, 200), [[i] for i in range(200)])
    a = rng.integers(-50, 50, 4).astype(float)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    for node in range(len(tree.first)):
        below = [node]
        while any(tree.first[x] >= 0 for x in below):
            below = [c for x in below for c in (range(tree.first[x], tree.last[x]) if tree.first[x] >= 0 else [x])]
        inside = np.concatenate([tree.vectors[-1 - tree.first[x]:-1 - tree.last[x]] for x in below]) @ a
        assert inside.max() <= up @ tree.high[node, :-1] + down @ tree.low[node, :-1]
        assert inside.min() >= up @ tree.low[node, :-1] + down @ tree.high[node, :-1]
