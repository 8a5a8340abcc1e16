import datetime as dt

from pyspark.sql import functions as F

from helpers import at, rows
from paddock.functions.timefn import parse_iso_utc
from paddock.operators import clean as C
from paddock.operators.points import last_write_wins, pivot_points, to_points


def _wide(spark):
    return spark.createDataFrame([(9998, 30, at(0), 301.7, 99.9, 8), (9998, 30, at(1), -2.5, None, 0),
                                  (9998, None, at(2), 10.0, 1.0, 1)],
                                 "session_key int, driver_number int, date timestamp_ntz, speed double, "
                                 "throttle double, drs int")


def test_points_round_trip_truncates_ints(spark):
    p = to_points(_wide(spark), "telemetry", ["session_key", "driver_number"],
                  {"speed": "int", "throttle": "float", "drs": "int"}, "date")
    assert p.columns == ["_measurement", "session_key", "driver_number", "_field", "_value", "_time"]
    assert p.count() == 8  # one null field is not written
    assert p.where(F.col("driver_number") == "None").count() == 3  # null tag kept as text
    back = pivot_points(p, ["_time", "session_key", "driver_number"], ["speed", "throttle", "drs"])
    got = rows(back.select("speed", "throttle", "drs"), "_time")
    assert got == [(301.0, 99.9, 8.0), (-2.0, None, 0.0), (10.0, 1.0, 1.0)]


def test_single_field_pivot_is_a_filter(spark):
    p = to_points(_wide(spark), "telemetry", ["session_key"], {"speed": "float"}, "date")
    plan = pivot_points(p, ["_time", "session_key"], ["speed"])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_string_fields(spark):
    df = spark.createDataFrame([(1, at(0), "+02:00", 2024)], "meeting_key int, date timestamp_ntz, gmt string, y int")
    p = to_points(df, "meetings", ["meeting_key"], {"gmt": "string", "y": "int"}, "date")
    back = pivot_points(p, ["_time", "meeting_key"], {"gmt": "string", "y": "double"})
    assert rows(back.select("gmt", "y")) == [("+02:00", 2024.0)]


def test_last_write_wins_collision(spark):
    df = spark.createDataFrame([(1, "SOFT", 10, 1, at(0), 5), (1, "SOFT", 11, 1, at(0), 7)],
                               "s int, c string, d int, n int, date timestamp_ntz, lap_end int")
    p = to_points(df.withColumn("_seq", F.struct("d", "n")), "q", ["s", "c"], {"lap_end": "int"}, "date",
                  carry=["_seq"])
    assert p.count() == 2
    w = last_write_wins(p, ["s", "c"], [F.col("_seq")])
    assert rows(w.select("_value")) == [(7.0,)]


def test_dedup_first_and_drop_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (1, 1.0, "a"), (2, float("nan"), "c"), (3, None, "d")],
                               "k int, v double, s string")
    assert rows(C.dedup_first(df, ["k"], [F.col("v")]).select("k", "s"), "k")[0] == (1, "a")
    assert rows(C.drop_nulls(df).select("k"), "k") == [(1,), (1,)]


def test_to_bool_like_pandas(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(C.to_bool("x")).collect()] == [False, True, True, True]


def test_audits(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, parent int")
    parent = spark.createDataFrame([(1,)], "pid int")
    assert rows(C.fk_orphans(child, parent, ["parent"], ["pid"])) == [(2, 9)]  # null FK exempt
    dup = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert rows(C.pk_violations(dup, ["a", "b"])) == [(1, 1, 2)]


def test_quarantine_reasons(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (3, -1.0)], "k int, v double")
    good, bad = C.quarantine(df, {"null key": F.col("k").isNull(), "negative": F.col("v") < 0})
    assert rows(good) == [(1, 5.0)]
    assert rows(bad.select("_reason"), "_reason") == [("negative",), ("null key",)]


def test_modulus_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "event_id")
    assert C.modulus_sample(df, "event_id", 20).count() == 5


def test_parse_iso_utc(spark):
    df = spark.createDataFrame([("2023-09-17T13:00:01.500000+02:00",), ("2023-09-17T11:00:01Z",),
                                ("2023-09-17T11:00:01",), ("2023-09-17 11:00:01.25",), ("junk",)], "t string")
    got = [r[0] for r in df.select(parse_iso_utc("t")).collect()]
    assert got == [dt.datetime(2023, 9, 17, 11, 0, 1, 500000), dt.datetime(2023, 9, 17, 11, 0, 1),
                   dt.datetime(2023, 9, 17, 11, 0, 1), dt.datetime(2023, 9, 17, 11, 0, 1, 250000), None]


def test_label_means_and_split(spark):
    from paddock.plans.timing import label_means
    df = spark.createDataFrame([("BTREE", 1.0), ("BTREE", 3.0), ("BRIN", 5.0)], "index_type string, t double")
    assert rows(label_means(df, "index_type", "t"), "index_type") == [("BRIN", 5.0), ("BTREE", 2.0)]
    assert rows(C.split_by(df, "index_type"), "index_type") == [("BRIN",), ("BTREE",)]


def test_write_time_is_distinct_per_row(spark):
    df = spark.range(500).selectExpr("CAST(id % 3 AS INT) AS session_key", "CAST(id AS INT) AS lap_end") \
        .repartition(4)
    p = to_points(df, "tyre_stints", ["session_key"], {"lap_end": "int"}, None)
    assert p.select("_time").distinct().count() == 500  # stints with equal tags never collide
    # the same rows get the same times, however they are dealt
    day = p.select(F.date_format("_time", "HH:mm:ss.SSSSSS").alias("t"), "_value")
    again = to_points(df.repartition(7), "tyre_stints", ["session_key"], {"lap_end": "int"}, None)
    assert set(day.collect()) == set(again.select(F.date_format("_time", "HH:mm:ss.SSSSSS").alias("t"), "_value").collect())


def test_a_hot_tag_is_written_by_several_tasks(spark, tmp_dir, request):
    import os
    from paddock.operators.points import read_points, write_points
    from paddock.sources.files import write_layout
    df = spark.range(4000).selectExpr("CAST(if(id < 3900, 1, id % 5) AS INT) AS session_key", "CAST(id % 7 AS INT) AS driver_number",
                                      "CAST(id * 7919 % 4000 AS INT) AS speed", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 31 % 4000) AS date")
    out = os.path.join(tmp_dir, "layout")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows here are few
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    write_layout(df, out)
    files = os.listdir(os.path.join(out, "session_key=1"))
    assert sum(f.endswith(".parquet") for f in files) > 1
    for f in files:
        if f.endswith(".parquet"):
            part = [tuple(r) for r in spark.read.parquet(os.path.join(out, "session_key=1", f)).select("driver_number", "date").collect()]
            assert part == sorted(part)
    assert spark.read.parquet(out).count() == 4000
    points = os.path.join(tmp_dir, "points")
    write_points(to_points(df, "telemetry", ["session_key", "driver_number"], {"speed": "int"}, "date"), points, "session_key")
    assert len([f for f in os.listdir(os.path.join(points, "_measurement=telemetry", "session_key=1")) if f.endswith(".parquet")]) > 1
    assert read_points(spark, points, ["telemetry"], {"session_key": [1]}).count() == df.filter("session_key = 1").count()


def test_small_cleaning_wrappers(spark):
    df = spark.createDataFrame([(1, 9998, "x"), (2, 9999, "y")], "driver_number int, session_key int, meeting_key string")
    assert C.drop_columns(df, "meeting_key", "segments_sector_1").columns == ["driver_number", "session_key"]
    assert C.project(df, ["session_key"], {"session_key": "s"}).columns == ["s"]
    keys = spark.createDataFrame([(1, 9998)], "driver_number int, session_key int")
    assert rows(C.keep_keys_in(df, keys, ["driver_number", "session_key"]).select("meeting_key")) == [("x",)]
    big = spark.range(20000)
    n = C.bernoulli_sample(big, 0.05).count()
    assert 700 < n < 1300  # about 5 %, not exact


def test_last_write_wins_and_pivot_shuffle_once(spark):
    df = spark.createDataFrame([(1, "SOFT", at(0), 1, 5, 2), (1, "SOFT", at(0), 2, 7, 3), (1, "SOFT", at(0), None, 9, 4), (1, "HARD", at(0), None, 4, 5),
                                (2, None, at(1), -3, 6, None)], "s int, c string, date timestamp_ntz, _seq long, a int, b int")
    p = to_points(df, "q", ["s", "c"], {"a": "int", "b": "int"}, "date", carry=["_seq"])
    last = last_write_wins(p, ["s", "c"], [F.col("_seq")])
    assert last.columns == p.columns
    wanted = [("1", "HARD", 4.0, 5.0), ("1", "SOFT", 7.0, 3.0), ("2", "None", 6.0, None)]
    wide = pivot_points(last, ["_time", "s", "c"], ["a", "b"]).select("s", "c", "a", "b")
    assert sorted(rows(wide)) == wanted
    plan = wide._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "Window" not in final
    three = last_write_wins(p, ["s", "c"], [F.col("_seq")], tasks=3)
    assert sorted(rows(pivot_points(three, ["_time", "s", "c"], ["a", "b"]).select("s", "c", "a", "b"))) == wanted


def test_written_where_made(spark, tmp_path):
    from paddock.operators.points import read_points, write_points
    df = spark.range(300).selectExpr("cast(id % 3 as int) as s", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) as date", "cast(id as int) as v")
    p = to_points(df, "q", ["s"], {"v": "int"}, "date")
    write_points(p.repartition(4), str(tmp_path / "p"), "s", dealt=True)
    back = read_points(spark, str(tmp_path / "p"), ["q"])
    assert rows(back.groupBy("s").agg(F.count("*"), F.sum("_value")).orderBy("s")) == rows(p.groupBy("s").agg(F.count("*"), F.sum("_value")).orderBy("s"))
