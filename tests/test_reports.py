from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import literal_forms
from helpers import at, laps, rows, same, telemetry
from paddock.operators.ranges import quantile_ranges
from paddock.plans import point_reports as P
from paddock.plans import reports as R
from paddock.sources.tables import Tables


def _tables(spark, tel, lap_rows, drivers=None, stints=None, weather=None):
    t = telemetry(spark, tel)
    lp = laps(spark, lap_rows)
    sessions = spark.createDataFrame([(1, "Race", "Monza"), (2, "Practice", "Spa")],
                                     "session_key int, session_name string, circuit_short_name string")
    tl = lp.select("session_key", "driver_number").distinct()
    drv = spark.createDataFrame(drivers or [(1, 10, "Ann"), (1, 11, "Ann"), (1, 12, "Bob")],
                                "session_key int, driver_number int, full_name string")
    st = spark.createDataFrame(stints or [(1, 10, 1, 1, 5, "SOFT")],
                               "session_key int, driver_number int, stint_number int, lap_start int, lap_end int, "
                               "compound string")
    wc = spark.createDataFrame(weather or [(1, at(0), 30.0)], "session_key int, date timestamp_ntz, "
                                                              "track_temperature double")
    return Tables(telemetrys=t, laps=lp, sessions=sessions, telemetrys_laps=tl, drivers=drv, tyre_stints=st,
                  weather_conditions=wc)


def test_r1_null_sector_and_duration(spark):
    tel = [(1, 10, s, 100 + s, 0, 0, 0) for s in (5, 15, 45)] + [(1, 11, s, 50, 0, 0, 0) for s in (5, 15)]
    lap_rows = [(1, 10, 1, 0, 10.0, 20.0, None, 60.0),   # null sector 3 -> no R1 rows for that lap
                (1, 11, 1, 0, 10.0, 20.0, 30.0, None)]   # null lap_duration -> absent from R1a, present in R1c
    t = _tables(spark, tel, lap_rows)
    assert R.sector_speed(t).count() == 0
    c = rows(R.sector_speed_best_lap(t), "driver_number", "sector")
    assert c == [(1, 11, None, "SECTOR 1", 50.0), (1, 11, None, "SECTOR 2", 50.0)]


def test_r1b_equal_durations_merge(spark):
    tel = [(1, 10, s, 100.0, 0, 0, 0) for s in (5, 105)]
    lap_rows = [(1, 10, 1, 0, 10.0, 20.0, 30.0, 60.0), (1, 10, 2, 100, 10.0, 20.0, 30.0, 60.0)]
    t = _tables(spark, tel, lap_rows)
    assert rows(R.sector_speed(t, all_laps=True)) == [(1, 10, 60.0, "SECTOR 1", 100.0)]
    # best lap = the smaller lap number
    assert rows(R.best_laps(t.laps).select("lap_number")) == [(1,)]


def test_r2_preagg_equals_fanout_and_null_group(spark):
    tel = [(1, 10, s, 10.0 * i, 0, 0, 0) for i, s in enumerate((0, 3, 12, 25, 40, 70, 90, 95))] + \
          [(1, 11, s, 5.0 * i, 0, 0, 0) for i, s in enumerate((1, 2, 2.5, 50))]
    lap_rows = [(1, 10, 1, 0, 10.0, 20.0, 30.0, 60.0), (1, 10, 2, 60, 10.0, 5.0, 30.0, 60.0),
                (1, 11, 1, 0, 10.0, 20.0, None, 60.0)]
    t = _tables(spark, tel, lap_rows)
    a = literal_forms.acceleration_pairs(t, 1)
    b = R.sector_acceleration(t, 1, buckets=20)
    assert same(a, b)
    assert a.where(F.col("sector").isNull()).count() == 2


def test_r2_nan_and_infinity_are_kept(spark):
    import math
    speeds = [100.0, 110.0, float("nan"), 131.0, 140.0, 150.0, 155.0, float("inf"), 170.0, 160.0]
    tel = [(1, 10, s * 3, v, 0, 0, 0) for s, v in enumerate(speeds)] + [(1, 11, s, 5.0 * s * s, 0, 0, 0) for s in range(30)]
    tel += [(1, 12, s, float("nan"), 0, 0, 0) for s in range(8)] + [(1, 13, 0, 0.0, 0, 0, 0), (1, 13, 1e-3, 1e12, 0, 0, 0), (1, 13, 2, 1.0, 0, 0, 0)]
    lap_rows = [(1, d, 1, 0, 2.0, 14.0, 20.0, 36.0) for d in (10, 11, 12, 13)] + [(1, 11, 2, 18, 2.0, 5.0, 20.0, 27.0)]
    t = _tables(spark, tel, lap_rows)
    got = {(r.driver_number, r.sector): r.mean_acceleration for r in R.sector_acceleration(t, 1).collect()}
    pairs = {}
    for r in R.accelerations(t.telemetrys).collect():
        for lap in t.laps.where(F.col("driver_number") == r.driver_number).collect():
            sec, start = (r.date - lap.date_start).total_seconds(), 0
            label = None
            for k, (lo, hi) in enumerate([(0, lap[4]), (1 + lap[4], lap[5]), (1 + lap[5], lap[6])], 1):
                if label is None and lo <= sec <= hi:
                    label = f"SECTOR {k}"
            pairs.setdefault((r.driver_number, label), []).append(r.acceleration)
    assert got.keys() == pairs.keys()
    for key, values in pairs.items():
        values = [v for v in values if v is not None]
        if not values:
            assert got[key] is None
            continue
        mean = sum(values) / len(values)
        assert (math.isnan(mean) and math.isnan(got[key])) or got[key] == pytest.approx(mean, rel=1e-12), key
    assert any(v is not None and math.isnan(v) for v in got.values()) and got[(11, None)] is not None
    for buckets in (None, 20, quantile_ranges(t.telemetrys, R.SD, "date", rows=3)):
        again = R.sector_acceleration(t, 1, buckets=buckets).collect()
        assert sorted(repr((r.driver_number, r.sector, r.mean_acceleration)) for r in again) == sorted(repr((*k, v)) for k, v in got.items())


def test_r2_zero_dt_sample(spark):
    s = spark.createDataFrame([(1, 10, at(0), 10.0), (1, 10, at(0), 10.0)],
                              "session_key int, driver_number int, date timestamp_ntz, speed double")
    got = sorted(R.accelerations(s).select("acceleration").collect(), key=lambda r: r[0] is not None)
    assert [r[0] for r in got] == [None, 0.0]  # first sample: no previous one; same time: 0


def test_r3a_preagg_equals_fanout_and_negative_stint(spark):
    stints = [(1, 10, 1, 1, 5, "SOFT"), (1, 11, 1, 8, 3, "HARD"), (1, 12, 1, 2, 9, None), (2, 10, 1, 1, 2, "SOFT")]
    weather = [(1, at(0), 30.005), (1, at(60), 31.0), (2, at(0), 20.0), (2, at(60), None)]
    t = _tables(spark, [(1, 10, 0, 1, 0, 0, 0)], [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)], stints=stints,
                weather=weather)
    a = literal_forms.tyre_pairs(t)
    b = R.tyre_temperature(t)
    assert same(a, b)
    got = {r[0]: (r[1], r[2]) for r in a.collect()}
    assert got["HARD"] == (Decimal("30.50"), -5)
    # weighted by fan-out: SOFT pairs = 2 (session 1) + 1 non-null (session 2)
    assert got["SOFT"] == (Decimal("27.00"), 4)
    # points form floors the longest stint at 0.0
    p = {r[0]: r[2] for r in R.tyre_temperature_points(t.tyre_stints.where(F.col("compound").isNotNull()),
                                                       t.weather_conditions.na.drop()).collect()}
    assert p["HARD"] == 0.0


def test_r5_same_name_merges(spark):
    tel = [(1, 10, 0, 100.0, 0, 0, 50.0), (1, 11, 1, 200.0, 0, 0, 60.0), (1, 12, 2, 10.0, 0, 0, 1.0)]
    t = _tables(spark, tel, [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)], weather=[(1, at(0), 30.0), (1, at(1), 40.0)])
    a = rows(R.temperature_speed(t, 1), "full_name")
    assert a == [("Monza", "Ann", Decimal("150.00"), Decimal("55.00"), Decimal("35.00")),
                 ("Monza", "Bob", Decimal("10.00"), Decimal("1.00"), Decimal("35.00"))]
    assert same(R.temperature_speed(t, 1), literal_forms.temperature_pairs(t, 1))


def test_r4_runs_bucketed_equal(spark):
    tel = [(1, 10, s, float(s), 100 if 20 <= s < 40 else 0, 8 if s < 30 else 0, 0) for s in range(0, 80, 2)]
    tel += [(1, 11, s + 1, float(s), 0, 0, 0) for s in range(0, 80, 4)]
    lap_rows = [(1, 10, 1, 0, 25.0, 50.0, 75.0, 75.0), (1, 11, 1, 0, 25.0, 50.0, 75.0, 75.0)]
    t = _tables(spark, tel, lap_rows)
    a = R.drs_runs(t, buckets=None)
    b = R.drs_runs(t, buckets=7)
    assert same(a, b)
    assert same(a, literal_forms.runs_by_windows(t))  # J9 literal form = G9
    ann = rows(a.where(F.col("full_name") == "Ann").select("start_speed", "end_speed", "drs", "sector",
                                                            "brake_state"), "start_time")
    assert ann[0] == (0.0, 18.0, "ATIVO", "SETOR 1", "NORMAL")


def test_r3c_preagg_equals_points_with_collisions(spark):
    stints = [(1, 10, 1, 1, 5, "SOFT"), (1, 10, 2, 6, 20, "SOFT"), (1, 11, 1, 1, 3, "SOFT"),
              (1, 11, 2, 4, 9, "HARD")]
    weather = [(1, at(0), 30.0), (1, at(60), 31.5)]
    t = _tables(spark, [(1, 10, 0, 1, 0, 0, 0)], [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)], stints=stints,
                weather=weather)
    plain = P.stint_weather_points(t)
    lww = P.stint_weather_points(t, on_conflict="last")
    assert plain.count() > lww.count()
    a = P.tyre_temperature_denormalised(lww)
    b = P.tyre_temperature_denormalised_preagg(t)
    assert same(a, b)
    assert {r[0]: r[2] for r in a.collect()}["SOFT"] == 14.0  # the later stint of driver 10 won


def test_r2_order_nulls_first_then_driver(spark):
    tel = [(1, 10, s, float(s), 0, 0, 0) for s in (0, 5)] + [(1, 11, s, 2.0 * s, 0, 0, 0) for s in (0, 5)] + \
          [(1, 12, 0, 1.0, 0, 0, 0)]
    lap_rows = [(1, d, 1, 0, 10.0, 20.0, 30.0, 60.0) for d in (10, 11, 12)]
    t = _tables(spark, tel, lap_rows)
    got = [(r.driver_number, r.sector, r.mean_acceleration) for r in R.sector_acceleration(t, 1).collect()]
    # driver 12 has one sample (no acceleration): its S1 mean is null and sorts first
    assert got[0] == (12, "SECTOR 1", None)
    means = [m for _, _, m in got[1:]]
    assert means == sorted(means, reverse=True)


def test_reports_on_empty_tables(spark):
    from paddock.plans import point_reports as P
    t = _tables(spark, [(1, 10, 0, 1.0, 0, 0, 0)], [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)])
    empty = t.with_(**{n: getattr(t, n).limit(0) for n in t.names()})
    drivers = spark.createDataFrame([], "driver_number int, full_name string, country_code string, team_name string")
    assert R.all_drivers(empty.with_(drivers=drivers)).count() == 0
    for df in (R.sector_speed(empty), R.sector_speed(empty, all_laps=True),
               R.sector_speed_best_lap(empty), R.sector_acceleration(empty, 1), R.tyre_temperature(empty),
               R.drs_runs(empty), R.temperature_speed(empty, 1), P.tyre_temperature_denormalised_preagg(empty),
               R.sector_samples(empty.telemetrys, empty.laps)):
        assert df.count() == 0


def test_r1c_equals_r1a_on_their_common_ground(spark):
    from paddock.sources.standin import standin_tables
    t = standin_tables(spark, "/root/testdata/sf0.001")
    a = R.sector_speed(t)
    c = (R.sector_speed_best_lap(t).where(F.col("best_lap_duration").isNotNull())
         .join(t.telemetrys_laps, ["session_key", "driver_number"], "left_semi")
         .withColumnRenamed("best_lap_duration", "lap_duration"))
    assert a.count() > 0 and same(a, c)


def test_r3b_equals_r3c_on_key_unique_stints(spark):
    from paddock.sources.standin import standin_tables
    t = standin_tables(spark, "/root/testdata/sf0.001")
    b = P.tyre_temperature_from_points(P.load_points(t, measurements=["tyre_stints", "weather_conditions"]))
    c = P.tyre_temperature_denormalised_preagg(t)
    assert b.count() > 0 and same(b, c)


def test_auto_bucket_width_gives_same_results(spark):
    from paddock.sources.standin import standin_tables
    t = standin_tables(spark, "/root/testdata/sf0.001")
    assert same(R.drs_runs(t, buckets="auto"), R.drs_runs(t))
    assert same(R.sector_acceleration(t, 9992, buckets="auto"), R.sector_acceleration(t, 9992))


def test_denormalised_measure_layouts(spark):
    from paddock.plans import point_reports as P
    t = _tables(spark, [(1, 10, 0, 1.0, 0, 0, 0)], [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)],
                stints=[(1, 10, 1, 1, 5, "SOFT")], weather=[(1, at(0), 30.0), (1, at(60), 31.0)])
    a = P.stint_weather_points(t)
    b = P.stint_weather_points(t, lead="compound")
    assert a.columns[:4] == ["_measurement", "session_key", "compound", "driver_number"]
    assert b.columns[:4] == ["_measurement", "compound", "session_key", "driver_number"]
    assert rows(a.select("_measurement").distinct()) == [("query3",)]
    assert rows(b.select("_measurement").distinct()) == [("query3_compund",)]
    assert same(P.tyre_temperature_denormalised(a), P.tyre_temperature_denormalised(b, "query3_compund"))


def test_written_measure_is_not_shuffled_after_the_write(spark, monkeypatch):
    from paddock import catalog
    compounds = ["SOFT", "HARD", "MEDIUM", None, "SOFT"]                    # the second SOFT of a driver is written last
    stints = [(s, d, n + 1, 1 + n, 3 + 2 * n + d % 7, c) for s in (1, 2) for d in range(200) for n, c in enumerate(compounds)]
    weather = [(s, at(20 * i), 20.0 + (7 * i + s) % 31) for s in (1, 2, 3) for i in range(700)] + [(1, at(0), None), (2, at(0), 99.0)]
    t = _tables(spark, [(1, 10, 0, 1, 0, 0, 0)], [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)], stints=stints, weather=weather)
    monkeypatch.setattr(catalog, "_t", lambda s, d: t)
    out = catalog.all_queries()["s12_written_measure"](spark, "")
    assert same(out, P.tyre_temperature_denormalised_preagg(t).selectExpr("compound", "round(mean_track_temperature, 9) as mean_track_temperature", "max_lap_duration"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(compound" in plan
    t = t.with_(weather_conditions=t.weather_conditions.where("false"))
    assert catalog.all_queries()["s12_written_measure"](spark, "").collect() == []


def test_blocks_of_the_measure_are_stored_in_buckets(spark, tmp_path):
    from paddock.operators.points import write_blocks
    stints = [(1, d, n, n, n + d, "SOFT" if n % 2 else "HARD") for d in range(120) for n in range(1, 6)]
    t = _tables(spark, [(1, 10, 0, 1, 0, 0, 0)], [(1, 10, 1, 0, 1.0, 1.0, 1.0, 3.0)], stints=stints, weather=[(1, at(i), 30.0 + i % 9) for i in range(900)])
    p = P.stint_weather_points(t, only=["lap_start", "track_temperature"], keep_order=True, in_blocks=True)
    back = write_blocks(p, str(tmp_path / "p"), "session_key", P.BLOCK)
    assert back.count() == 600 * 900 * 2
    series = back.groupBy("session_key", "compound", "driver_number", "_time").agg(F.count_distinct(P.BLOCK).alias("n"))
    assert series.agg(F.max("n")).first()[0] == 1 and back.select(P.BLOCK).distinct().count() == 6       # 2 blocks of stints x 3 of weather
    plain = P.stint_weather_points(t, only=["lap_start", "track_temperature"])
    cols = [c for c in plain.columns]
    assert back.groupBy(*cols).count().exceptAll(plain.groupBy(*cols).count()).count() == 0
    files = back.select("_time", "compound", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    w = Window.partitionBy("f").orderBy("i")
    assert files.withColumn("before", F.lag("_time").over(w)).where("before > _time").count() == 0          # in the order of time
