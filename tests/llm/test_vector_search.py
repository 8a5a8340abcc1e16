import numpy as np
from pyspark.sql import functions as F

from paddock.llm import vector_search as V
from paddock.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v):
            usable[i] = np.asarray(v, float)
    ids = np.array(sorted(usable))
    x = np.array([usable[i] for i in ids])
    norms = np.sqrt((x * x).sum(1))
    out = {}
    for i in ids[ids % step == 0]:
        c = (x * usable[i]).sum(1) / (norms * np.sqrt((usable[i] ** 2).sum()))
        c[ids == i] = -9
        out[int(i)] = [(int(ids[j]), float(c[j])) for j in np.lexsort((ids, -c))[:min(k, len(ids) - 1)]]
    return out


def run(spark, df, step):
    rows = V.valid(df)
    got = {}
    for r in V.search(spark, V.index(spark, rows), V.stated_queries(rows, step)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def recall(got, want):
    assert set(got) == set(want)
    for q, found in got.items():
        assert len(found) == len(want[q]) and all(a[1] >= b[1] - 1e-12 for a, b in zip(found, found[1:], strict=False))
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


def test_recall_over_several_shards(spark, sf, monkeypatch):
    monkeypatch.setattr(V, "SHARD_ROWS", 300)
    df = table(spark, sf.replace("0.001", "0.1"), "embeddings")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 50)
    got = run(spark, df, 50)
    assert recall(got, want) >= 0.95
    exact = {(q, i): s for q, x in want.items() for i, s in x}
    assert all(abs(s - exact[q, i]) < 1e-12 for q, x in got.items() for i, s in x if (q, i) in exact)


def test_one_shard(spark, sf):
    df = table(spark, sf.replace("0.001", "0.1"), "embeddings")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 50)
    assert recall(run(spark, df, 50), want) >= 0.9


def test_ties_repeats_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400, 2)]                      # one vector that many rows have
    rows += [(i, [float(x) for x in rng.normal(size=3).astype(np.float32)]) for i in range(1, 200, 2)]
    rows += [(500, None), (600, [0.0, 0.0, 0.0]), (700, [1.0, None, 1.0]), (800, [float("nan"), 1.0, 1.0]), (900, [float("inf"), 1.0, 1.0]), (1000, []), (None, [1.0, 1.0, 1.0])]
    rows += [(50, [1.0, 2.0, 3.0])] * 3 + [(1001, [-0.0, 0.0, 1.0]), (1003, [0.0, -0.0, 1.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).withColumns({c: F.lit("x") for c in ("v", "ids", "shard", "n", "query_id")}).repartition(4)
    want = brute(rows, 50)
    got = run(spark, df, 50)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert got[0] == [(i, got[0][0][1]) for i in (2, 4, 6, 8, 10)]


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0)], SCHEMA)
    assert run(spark, df, 50) == {0: [(1, 0.0)]}
    assert run(spark, df.filter("vec_id = 0"), 50) == {}
    assert run(spark, df.limit(0), 50) == {}


def to_python(plan):
    """Bytes that a plan that has run sent to Python, query stages and all."""
    kind, sent = plan.getClass().getSimpleName(), plan.metrics().get("pythonDataSent")
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    below += [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
    return (sent.get().value() if sent.isDefined() else 0) + sum(map(to_python, below))


def test_a_graph_is_sent_once_for_many_blocks_of_queries(spark):
    df = spark.range(240).selectExpr("id as vec_id", "transform(sequence(1, 512), x -> sin(x * x * 0.37 + id * id * 1.3)) as embedding").repartition(3)
    rows = V.valid(df)
    graphs = V.index(spark, rows)
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")       # over a hundred blocks
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = V.search(spark, graphs, V.stated_queries(rows, 1))
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert len(got) == 240 and all(len(x) == 5 for x in got.values())
    x = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()])
    x /= np.sqrt((x * x).sum(1))[:, None]
    c = x @ x.T - 9 * np.eye(240)
    assert np.mean([set(got[q]) == set(np.argsort(-c[q])[:5].tolist()) for q in got]) >= 0.9
    assert all(abs(s - c[q, i]) < 1e-12 for q in got for i, s in got[q].items())
    assert 1e6 < to_python(found._jdf.queryExecution().executedPlan()) < 10e6     # a graph and its queries have 1 MB each


def test_vectors_that_single_precision_holds_and_others_meet(spark):
    x = [[1.0, 2.0, 0.5]] * 9 + [[0.1, 0.2, 0.3]] * 9 + [[1e200, 2e200, 3e200], [3.0, 2.0, 1.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>").repartition(5)
    got = run(spark, df, 9)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[9]][:2] == [10, 11]
    assert [s for _, s in got[0]] == [got[0][0][1]] * 5 and abs(got[0][0][1] - 1) < 1e-12


def test_graph_finds_near_vectors_and_links_are_bounded():
    rng = np.random.default_rng(6)
    centres = np.repeat(rng.normal(size=(40, 24)), 30, axis=0)
    x = V._unit(np.concatenate([rng.normal(size=(800, 24)), centres + 0.02 * rng.normal(size=centres.shape)])[rng.permutation(2000)]).astype(np.float32)
    g = V.Graph(x)
    assert [a.shape for a in g.links[:2]] == [(2000, 24), (2000, 12)]
    for k, a in enumerate(g.links):
        own = np.flatnonzero(g.level >= k)
        assert set(a[a >= 0].tolist()) <= set(own.tolist()) and (a[g.level < k] == -1).all()
        assert all(i not in r and len(set(r[r >= 0].tolist())) == (r >= 0).sum() for i, r in enumerate(a))
    found = g.nearest(x[::7], V.SEARCH_WIDTH)
    best = np.argsort(-(x[::7] @ x.T), axis=1)[:, :6]
    assert (found[:, 0] >= 0).all() and np.mean([len({*a[:6].tolist()} & {*b.tolist()}) / 6 for a, b in zip(found, best, strict=True)]) >= 0.95
