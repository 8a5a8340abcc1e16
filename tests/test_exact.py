from decimal import Decimal

from pyspark.sql import functions as F

from paddock.functions.exact import half_up_2dp, mean_2dp, quantile_2dp, scaled_int


def test_rounding_ties(spark):
    df = spark.createDataFrame([(46.095,), (0.005,), (2.675,), (-2.675,)], "x double")
    got = [r[0] for r in df.select(half_up_2dp(scaled_int("x"), F.lit(1))).collect()]
    assert got == [Decimal("46.10"), Decimal("0.01"), Decimal("2.68"), Decimal("-2.68")]


def test_mean_2dp_exact_and_order_free(spark):
    vals = [(1, 0.005), (1, 0.005), (1, 0.0), (2, 10.0), (2, None)]
    df = spark.createDataFrame(vals, "g int, x double")
    got = dict(tuple(r) for r in df.groupBy("g").agg(mean_2dp("x")).collect())
    # (0.005+0.005+0)/3 = 0.00333 -> 0.00 ; 10 -> 10.00 (null ignored)
    assert got == {1: Decimal("0.00"), 2: Decimal("10.00")}
    half = spark.createDataFrame([(0.01,), (0.0,)], "x double").agg(mean_2dp("x")).first()[0]
    assert half == Decimal("0.01")  # 0.005 rounds half away from zero


def test_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5.005)], "x double")
    r = df.agg(quantile_2dp("x", 0.25), quantile_2dp("x", 0.5), quantile_2dp("x", 0.75)).first()
    assert tuple(r) == (Decimal("2.00"), Decimal("3.00"), Decimal("4.00"))
    df = spark.createDataFrame([(0.0,), (0.01,)], "x double")
    assert df.agg(quantile_2dp("x", 0.5)).first()[0] == Decimal("0.01")  # 0.005 -> 0.01


def test_mean_2dp_of_all_null_group_is_null(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"  # a zero count must not reach the division
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.5)], "g int, x double")
    got = dict(tuple(r) for r in df.groupBy("g").agg(mean_2dp("x")).collect())
    assert got == {1: None, 2: Decimal("1.50")}


def test_more_than_four_decimals_and_nan(spark):
    """Six-decimal seconds keep all their digits; a NaN makes the mean NaN and stops nothing."""
    import math
    import statistics
    from paddock.plans.timing import timing_population, timing_summary
    seconds = [0.121342, 0.126441, 0.148003, 0.118201, 0.121990, 0.163712, 0.124216, 0.138809, 0.120077, 0.112987]
    rows = [(i, 1, "a", "x", v) for i, v in enumerate(seconds)] + [(90, 2, "a", "x", 0.004996), (91, 3, "a", "x", float("nan")), (92, 3, "a", "x", 1.0)]
    log = spark.createDataFrame(rows, "statid long, queryid long, index_type string, description string, elapsedtime double")
    got = {r["queryid"]: r for r in timing_population(log).collect()}
    assert got[1]["mean"] == float(sum(Decimal(str(v)) for v in seconds) / len(seconds))
    assert math.isclose(got[1]["median"], statistics.median(seconds), rel_tol=1e-15)
    assert math.isclose(got[1]["std"], statistics.pstdev(seconds), rel_tol=1e-12)
    assert math.isnan(got[3]["mean"])
    two = {r["queryid"]: r for r in timing_summary(log).collect()}
    assert two[2]["mean_time"] == two[2]["median_time"] == Decimal("0.00") and two[3]["mean_time"] is None


def test_sums_take_every_value_as_it_is(spark):
    from paddock.functions.exact import exact_mean, exact_sums
    groups = {1: [1.00004], 2: [0.1, 0.20001, 1e-9], 3: [1.0, 1 / 3], 4: [1e300, 1.0], 5: [float("inf"), 2.0], 6: [-0.00005, -2.5]}
    df = spark.createDataFrame([(g, v) for g, x in groups.items() for v in x], "g int, x double").repartition(3)
    got = dict(tuple(r) for r in df.groupBy("g").agg(*exact_sums("x", "x")).select("g", exact_mean("x")).collect())
    assert got == {1: 1.00004, 2: float(Decimal("0.300010001") / 3), 3: (1.0 + 1 / 3) / 2, 4: 5e299, 5: float("inf"), 6: -1.250025}


def test_weighted_sums_stand_for_repeated_rows(spark):
    from paddock.functions.exact import exact_mean, exact_sums, weighted_sums
    df = spark.createDataFrame([(1, 0.123456, 2), (1, 5.0, 2), (2, 1 / 7, 3), (2, -1.0, 3)], "g int, x double, w long")
    per = df.groupBy("g", "w").agg(*exact_sums("x", "p")).agg(*weighted_sums("p", "w", "t")).select(exact_mean("t")).first()[0]
    assert abs(per - (2 * 5.123456 + 3 * (1 / 7 - 1)) / 10) < 1e-15
