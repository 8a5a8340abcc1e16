import json
import os

from pyspark.sql import functions as F

from helpers import at, rows
from paddock import schemas
from paddock.plans.timing import append_runs, timing_population, timing_summary
from paddock.sources.files import (conform, land_json, read_table, read_with_path_keys, run_sql, write_csv,
                                   write_layout)


def _tel(spark):
    return spark.createDataFrame(
        [(9998, 30, at(i), 100.0 + i, 0, 0, 1, 1, 50.0) for i in range(20)] +
        [(9999, 44, at(i), 90.0, 0, 0, 1, 1, 50.0) for i in range(5)],
        "session_key int, driver_number int, date timestamp_ntz, speed double, brake int, drs int, n_gear int, "
        "rpm int, throttle double")


def test_layout_prunes_partitions(spark, tmp_dir):
    out = os.path.join(tmp_dir, "tel")
    write_layout(_tel(spark), out)
    df = spark.read.parquet(out).where((F.col("session_key") == 9998) & (F.col("driver_number") == 30))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_key" in plan and "PushedFilters: [IsNotNull(driver_number)" in plan
    assert df.count() == 20


def test_path_keys_from_file_names(spark, tmp_dir):
    d = os.path.join(tmp_dir, "telemetrys")
    for s, drv in ((9998, 30), (9998, 44)):
        (_tel(spark).where(F.col("driver_number") == 30).drop("session_key", "driver_number")
         .coalesce(1).write.parquet(os.path.join(tmp_dir, f"tmp{drv}")))
        f = [x for x in os.listdir(os.path.join(tmp_dir, f"tmp{drv}")) if x.endswith(".parquet")][0]
        os.makedirs(d, exist_ok=True)
        os.rename(os.path.join(tmp_dir, f"tmp{drv}", f), os.path.join(d, f"session_key={s}&driver_number={drv}.parquet"))
    df = read_with_path_keys(spark, d)
    assert sorted(rows(df.groupBy("session_key", "driver_number").count())) == [(9998, 30, 20), (9998, 44, 20)]


def test_conform_dedups_and_quarantines(spark):
    raw = spark.createDataFrame([("9998", "30", "2024-01-01 00:00:00", "1.5"), ("9998", "30", "2024-01-01 00:00:00",
                                 "0.5"), (None, "30", "2024-01-01 00:00:01", "2"), ("9998", "x", "2024-01-01", "3")],
                                "session_key string, driver_number string, date string, speed string")
    good, bad = conform(raw, "telemetrys")
    assert good.columns == schemas.TELEMETRYS.fieldNames()
    assert rows(good.select("speed")) == [(0.5,)]
    assert rows(bad.select("_reason"), "_reason") == [("bad driver_number",), ("null session_key",)]


def test_json_landing_and_csv(spark, tmp_dir):
    src = os.path.join(tmp_dir, "pits.json")
    with open(src, "w") as fh:
        json.dump([{"session_key": 9998, "driver_number": 30, "lap_number": 12, "date": "2024-01-01T00:00:00",
                    "pit_duration": 22.4, "meeting_key": 1}], fh)
    out = os.path.join(tmp_dir, "pits")
    land_json(spark, src, schemas.PITS, out)
    df = read_table(spark, out, schemas.PITS)
    assert rows(df.select("lap_number", "pit_duration")) == [(12, 22.4)]
    write_csv(df, os.path.join(tmp_dir, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv"))
    assert back.count() == 1 and "pit_duration" in back.columns


def test_timing_log_and_summaries(spark):
    log = append_runs(spark, None, [(1, "BTREE", "q1", s) for s in (1.0, 2.0, 3.0, 4.0)])
    log = append_runs(spark, log, [(1, "BRIN", "q1", 5.0)])
    assert rows(log.select("statid"), "statid") == [(i,) for i in range(1, 6)]
    s = rows(timing_summary(log, index_type="BTREE").drop("queryid", "index_type"))
    assert [str(v) for v in s[0]] == ["2.50", "1.00", "1.75", "2.50", "3.25", "4.00", "1.29"]
    p = rows(timing_population(log.where(F.col("index_type") == "BTREE")).select("mean", "median", "std"))
    assert p == [(2.5, 2.5, 1.25 ** 0.5)]


def test_reports_prune_session_partitions(spark, tmp_dir):
    from paddock.plans import reports as R
    from paddock.sources.standin import standin_tables
    t = standin_tables(spark, "/root/testdata/sf0.001")
    write_layout(t.telemetrys, os.path.join(tmp_dir, "tel"))
    t2 = t.with_(telemetrys=spark.read.parquet(os.path.join(tmp_dir, "tel")))
    r1 = R.sector_speed(t2, all_laps=True)
    r1.collect()
    assert "dynamicpruningexpression(session_key" in r1._jdf.queryExecution().executedPlan().toString()
    r5 = R.temperature_speed(t2, 9992)
    r5.collect()
    assert "PartitionFilters: [isnotnull(session_key" in r5._jdf.queryExecution().executedPlan().toString()


def test_corrupt_file_skipped_on_request(spark, tmp_dir):
    d = os.path.join(tmp_dir, "tel")
    _tel(spark).coalesce(1).write.parquet(d)
    with open(os.path.join(d, "broken.parquet"), "wb") as fh:
        fh.write(b"not a parquet file")
    assert read_table(spark, d, schemas.TELEMETRYS, skip_corrupt_files=True).count() == 25


def test_tables_register_for_sql(spark):
    from paddock.sources.standin import standin_tables
    t = standin_tables(spark, "/root/testdata/sf0.001")
    t.register("sf_")
    got = run_sql(spark, "SELECT count(*) FROM sf_laps l JOIN sf_sessions s USING (session_key) "
                         "WHERE s.session_name = 'Race'").first()[0]
    assert got == R_laps_in_races(t)


def R_laps_in_races(t):
    from paddock.plans.reports import race_laps
    return race_laps(t).count()


def test_json_lines_landing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "pits.jsonl")
    with open(src, "w") as fh:
        for lap in (3, 4):
            fh.write(json.dumps({"session_key": 9998, "driver_number": 30, "lap_number": lap,
                                 "date": "2024-01-01T00:00:00", "pit_duration": 20.0 + lap}) + "\n")
    out = os.path.join(tmp_dir, "pits")
    land_json(spark, src, schemas.PITS, out, json_lines=True)
    assert rows(read_table(spark, out).select("lap_number"), "lap_number") == [(3,), (4,)]


def test_landed_records(spark, tmp_dir):
    """A bad record costs one row, a landed file isn't landed again; lines and documents."""
    import json
    import os

    from pyspark.sql import types as T

    from paddock.sources.records import land_records
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for lines in (True, False):
        source, out = os.path.join(tmp_dir, f"in{lines}"), os.path.join(tmp_dir, f"out{lines}")
        os.makedirs(source)
        rows = [{"a": 1, "b": "x"}, {"a": "no number", "b": "y"}, {"a": 3, "c": [1]}, {"b": None}]
        with open(os.path.join(source, "one.json"), "w") as f:
            f.write("\n".join(map(json.dumps, rows)) + "\n\n" if lines else json.dumps(rows))
        with open(os.path.join(source, "two.json"), "w") as f:
            f.write('{"a": 9' if lines else "no json")
        rejected, unknown = land_records(spark, source, schema, out, lines)
        got = spark.read.parquet(out)
        assert sorted(map(tuple, got.collect()), key=str) == [(1, "x"), (3, None), (None, None)]
        assert rejected.count() == 2 and [(r.field, r.n) for r in unknown.collect()] == [("c", 1)]
        assert land_records(spark, source, schema, out, lines)[0].count() == 0 and spark.read.parquet(out).count() == 3
        with open(os.path.join(source, "three.json"), "w") as f:
            f.write('{"a": 5}' if lines else '[{"a": 5}]')
        land_records(spark, source, schema, out, lines)
        assert spark.read.parquet(out).count() == 4
