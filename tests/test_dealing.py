"""Exact samples, balanced task groups, dense ids, radix quantiles, checked appends, blocked joins."""

import math
import os

import pytest
from pyspark.sql import functions as F

from helpers import same
from paddock.operators import quantiles as Q
from paddock.operators.dealing import exact_sample, task_groups, with_ids
from paddock.operators.joins import blocked_join
from paddock.plans.timing import LOG_SCHEMA, append_runs
from paddock.sources.append import append_once, checked


def test_sample_is_exact_and_reruns_agree(spark):
    df = spark.range(3000).withColumn("v", F.col("id") % 7)
    for fraction in (0.05, 0.333, 0.0, 1.0, 0.0001):
        got = exact_sample(df, fraction, ["id"])
        assert got.count() == round(3000 * fraction)
        assert same(got, exact_sample(df.repartition(7), fraction, ["id"]))
    assert not same(exact_sample(df, 0.05, ["id"]), exact_sample(df, 0.05, ["id"], seed=1))
    assert exact_sample(df.where("false"), 0.5, ["id"]).count() == 0


def test_sample_of_equal_rows(spark):
    """A third of all rows are equal, others have equal hashes or nulls."""
    df = spark.createDataFrame([(None, "a")] * 400 + [(i % 50, None) for i in range(400)] + [(i, "b") for i in range(400)], "id long, t string")
    for fraction in (0.05, 0.5, 0.9):
        got = exact_sample(df, fraction, ["id"])
        assert got.count() == round(1200 * fraction)
        assert got.exceptAll(df).count() == 0


def test_task_groups_are_even(spark):
    keys = [(None if i < 30 else 1 if i < 4000 else i % 40, i) for i in range(6000)]      # one key with two thirds of all rows
    df = spark.createDataFrame(keys, "k int, id long")
    got = task_groups(df, "k", 10, ["id"])
    sizes = [r["count"] for r in got.groupBy("task_group").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 6000 and max(sizes) <= 1.2 * 600
    assert got.where("k is null").select("task_group").distinct().count() == 1
    assert got.groupBy("k").agg(F.countDistinct("task_group").alias("g")).where("k <> 1").agg(F.max("g")).first()[0] <= 2
    assert task_groups(df.where("false"), "k", 3, ["id"]).count() == 0


def test_ids_are_dense(spark):
    df = spark.range(1000).repartition(6).withColumnRenamed("id", "x")
    got = with_ids(spark, df, 5, "id")
    assert sorted(r.id for r in got.collect()) == list(range(5, 1005)) and same(got.select("x"), df)
    log = append_runs(spark, None, [(1, "a", "d", 0.5), (1, "a", "d", 0.75)])
    runs = spark.createDataFrame([(2, "b", "e", float(i)) for i in range(50)], "queryid int, index_type string, description string, seconds double")
    whole = append_runs(spark, log, runs)
    assert sorted(r.statid for r in whole.collect()) == list(range(1, 53)) and whole.schema == LOG_SCHEMA


def _values(spark):
    rows = [(g, v) for g, values in {
        "a": [1.5, 2.25, -3.0, 1.5, 1e-300, -1e300, 0.0, -0.0], "b": [float("nan"), 1.0, float("inf"), float("-inf"), 2.0], "c": [None, None],
        None: [7.0, None, 9.0], "hot": [5.0] * 500 + [i / 7 for i in range(300)], "one": [42.0]}.items() for v in values]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.mark.parametrize("few", [100_000, 0])
def test_radix_quantiles_equal_percentile(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "BROADCAST_TARGETS", few)
    df, ps = _values(spark), [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: list(r)[1:] for r in Q.radix_quantiles(df, ["g"], "v", ps).collect()}
    want = {r.g: r.q or [None] * 5 for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q")).collect()}
    assert got.keys() == want.keys()
    for g in want:
        for a, b in zip(got[g], want[g], strict=True):
            assert a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or a == pytest.approx(b, rel=1e-15))), (g, got[g], want[g])
    assert Q.radix_quantiles(df.where("false"), ["g"], "v", ps).count() == 0


def test_checked_rows(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "b", 10), (2, "c", 99), (3, "d", None), (None, "e", 10), (4, "f", 10)], "k int, v string, p int")
    there = spark.createDataFrame([(4, "old", 10)], "k int, v string, p int")
    parents = spark.createDataFrame([(10,), (11,)], "pk int")
    good, bad = checked(df, there, ["k"], [(["p"], parents, ["pk"])])
    assert sorted(tuple(r) for r in good.select("k", "v").collect()) == [(1, "a"), (3, "d")]
    assert {(r.v, r._reason) for r in bad.collect()} == {("b", "repeated key"), ("c", "no parent"), ("e", "null key"), ("f", "key exists")}


def test_a_batch_run_twice_adds_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    batch = spark.createDataFrame([(i, i * 2) for i in range(20)], "k int, v int")
    assert append_once(spark, batch, path, ["k"], 1).count() == 0
    assert append_once(spark, batch, path, ["k"], 1).count() == 0               # in the ledger
    assert append_once(spark, batch, path, ["k"], 2).count() == 20              # as if it had ended before the ledger
    assert append_once(spark, spark.createDataFrame([(100, 1), (3, 1)], "k int, v int"), path, ["k"], 3).count() == 1
    assert spark.read.parquet(path).count() == 21


def test_blocked_join_equals_join(spark):
    a = spark.createDataFrame([(None if i % 11 == 0 else i % 3, i) for i in range(200)] + [(0, 5)], "k int, a int")
    b = spark.createDataFrame([(i % 4 if i % 7 else None, i) for i in range(90)], "k int, b int")
    assert same(blocked_join(a, b, ["k"], rows=10), a.join(b, "k"))
    assert blocked_join(a.where("false"), b, ["k"]).count() == 0


def test_blocked_join_spreads_small_sides(spark):
    a, b = spark.range(1500).selectExpr("1 as k", "id as a"), spark.range(2000).selectExpr("1 as k", "id as b")
    made = blocked_join(a, b, ["k"], rows=100).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in made) == 3_000_000
    assert len(made) >= 4 and max(r["n"] for r in made) <= 1_500_000     # one task made all pairs before


def test_blocked_join_numbers_its_blocks(spark):
    a = spark.createDataFrame([(i % 3 if i % 5 else None, i % 9, i) for i in range(80)], "k int, g int, a int")
    b = spark.createDataFrame([(i % 4 if i % 7 else None, i // 4, i) for i in range(90)], "k int, h int, b int")
    out = blocked_join(a, b, ["k"], rows=10, pairs_a_task=300, left_by=[F.col("g")], right_by=[F.col("h")], block="_block")
    assert same(out.drop("_block"), a.join(b, "k"))
    assert out.schema["_block"].metadata["tasks"] > 1
    together = out.withColumn("p", F.spark_partition_id()).groupBy("k", "g", "h").agg(F.count_distinct("_block").alias("n"), F.count_distinct("p").alias("p"))
    assert together.agg(F.max("n"), F.max("p")).first() == (1, 1)
    assert out.groupBy("_block").agg(F.count_distinct("k").alias("n")).agg(F.max("n"), F.count("*")).first()[0] == 1
    assert blocked_join(a.where("false"), b, ["k"], block="_block").count() == 0
