"""Plan properties the scale design relies on, checked with broadcasts off (as on large data)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)


def _final_plan(df) -> list[str]:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)  # expression ids
    return re.split(r"\n\+- == Initial Plan ==", text)[0].splitlines()   # at the margin: subqueries have their own, indented


def _indent(line: str) -> int:
    m = re.search(r"[A-Za-z*]", line)
    return m.start() if m else 0


def _ancestors(lines: list[str], i: int) -> list[str]:
    out, level = [], _indent(lines[i])
    for j in range(i - 1, -1, -1):
        if _indent(lines[j]) < level:
            out.append(lines[j].strip(" :+-|"))
            level = _indent(lines[j])
    return out


def _window_on_bucket_join(lines: list[str]) -> bool:
    """Some bucketed sort-merge join feeds a Window with no Exchange in between."""
    for i, line in enumerate(lines):
        if "SortMergeJoin [session_key, driver_number, _tb]" in line:
            for a in _ancestors(lines, i):
                if a.startswith("Exchange") or "ShuffleQueryStage" in a:
                    break
                if a.startswith("Window"):
                    return True
    return False


def _cut(spark):
    """The stand-in tables and ranges for every driver with more than a row."""
    from paddock.operators.ranges import quantile_ranges
    from paddock.sources.standin import standin_tables
    t = standin_tables(spark, SF)
    ranges = quantile_ranges(t.telemetrys, ["session_key", "driver_number"], "date", rows=1)
    assert ranges is not None and ranges.n_cuts > 0
    return t, ranges


def test_r4_windows_reuse_join_partitioning_and_input_shuffle(no_broadcast):
    from paddock.plans import reports as R
    t, ranges = _cut(no_broadcast)
    lines = _final_plan(R.drs_runs(t, buckets=ranges))
    assert _window_on_bucket_join(lines)
    assert any("ReusedExchange [session_key, driver_number, date, speed" in x for x in lines)


def test_r2_interval_join_reuses_lag_partitioning(no_broadcast):
    from paddock.plans import reports as R
    t, ranges = _cut(no_broadcast)
    lines = _final_plan(R.sector_acceleration(t, 9992, buckets=ranges))
    for i, line in enumerate(lines):
        if "SortMergeJoin [session_key, driver_number, _tb]" in line:
            # Pre-order printing: the sample side comes first. Its first shuffle-or-join below the
            # interval join must be the lag's stitch join on (keys, bucket), not a new shuffle.
            below = next(x for x in lines[i + 1:]
                         if "Exchange" in x or "ShuffleQueryStage" in x or "SortMergeJoin" in x)
            assert "SortMergeJoin [session_key, driver_number, _b]" in below
            break
    else:
        pytest.fail("no bucketed interval join in the plan")


def test_best_lap_is_a_group_limit(no_broadcast):
    # row_number() = 1 is planned as a WindowGroupLimit; when an exchange separates it from
    # its input, a Partial one runs before the exchange (here the laps already arrive
    # partitioned by (session, driver) from the existence join, so only the Final one is needed).
    lines = _final_plan(E.queries()["r1a_sector_speed"](no_broadcast, SF))
    assert any("WindowGroupLimit" in x for x in lines)


def test_hot_driver_is_spread_over_partitions(spark):
    """One driver with a third of the rows: the plain window puts all of them in one partition,
    the bucketed one spreads them (AQE coalescing off so the partitioning is visible)."""
    from pyspark.sql import functions as F

    from helpers import at
    from paddock.operators.windows import with_previous
    hot = [(1, 7, at(s * 36), float(s)) for s in range(3000)]          # 30 hours of one driver
    cold = [(1, d, at(s * 600), 1.0) for d in range(20, 320) for s in range(20)]
    df = spark.createDataFrame(hot + cold, "session_key int, driver_number int, date timestamp_ntz, speed double")
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        def parts(out):
            # prev_speed is used so the optimizer keeps the window in the plan
            hot_rows = out.where(F.col("driver_number") == 7).select(F.spark_partition_id().alias("p"), "prev_speed")
            return len(hot_rows.groupBy("p").agg(F.count("prev_speed").alias("n")).collect())
        plain = with_previous(df, ["session_key", "driver_number"], "date", ["speed"])
        bucketed = with_previous(df, ["session_key", "driver_number"], "date", ["speed"], buckets=3600)
        assert parts(plain) == 1
        assert parts(bucketed) >= 3
    finally:
        spark.conf.set(key, old)


def test_hot_driver_interval_join_spread(spark):
    """The interval join keyed on (session, driver, bucket) spreads a hot driver's samples too."""
    from pyspark.sql import functions as F

    from helpers import at
    from paddock.operators.joins import interval_join
    from paddock.operators.ranges import quantile_ranges
    samples = spark.createDataFrame([(1, 7, at(s * 36)) for s in range(3000)] +
                                    [(1, d, at(0)) for d in range(20, 120)],
                                    "session_key int, driver_number int, date timestamp_ntz")
    laps = spark.createDataFrame([(1, 7, at(h * 3600), float(h)) for h in range(30)],
                                 "session_key int, driver_number int, start timestamp_ntz, lap double")
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def parts(bucket):
            j = interval_join(samples, laps, ["session_key", "driver_number"], "date", F.col("start"),
                              F.col("start") + F.expr("INTERVAL 3599 SECONDS"), bucket)
            rows = j.select(F.spark_partition_id().alias("p"), "lap").groupBy("p").agg(F.count("lap").alias("n"))
            got = rows.collect()
            assert sum(r.n for r in got) == 3000
            return len(got)
        assert parts(None) == 1
        assert parts(3600) >= 3
        assert parts(quantile_ranges(samples, ["session_key", "driver_number"], "date", rows=200)) >= 3
    finally:
        spark.conf.set(key, old)


def test_reports_scan_telemetry_once_on_loaded_tables(no_broadcast):
    from paddock.catalog import reports_on_tables
    from paddock.sources.load import materialize_tables
    from paddock.sources.standin import standin_tables
    spark = no_broadcast
    loaded = materialize_tables(spark, standin_tables(spark, SF))
    on = reports_on_tables()
    for name in ("r1a_sector_speed", "r2a_sector_accel", "r4_drs_runs", "r5_temp_speed", "r6_sector_samples"):
        lines = _final_plan(on[name](loaded))
        scans = [x for x in lines if "FileScan" in x and "/tables/telemetrys/" in x]
        assert len(scans) == 1, (name, len(scans))
