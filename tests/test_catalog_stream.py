import os

from pyspark.sql import functions as F

from helpers import at, rows
from paddock import api, schemas
from paddock.operators.points import read_points, to_points, write_points
from paddock.sources.files import append_table, create_tables, run_sql
from paddock.streaming.landing import load_stream


def _tel_rows(spark, session, driver, secs, speed=100.0):
    return spark.createDataFrame([(session, driver, at(s), 0, 8, 3, 9000, speed + s, 50.0) for s in secs],
                                 schemas.TELEMETRYS)


def test_catalog_tables_and_reference_api(spark, tmp_dir):
    create_tables(spark, "paddock_t", location=os.path.join(tmp_dir, "wh"))
    assert {t.name for t in spark.catalog.listTables("paddock_t")} == set(schemas.SCHEMAS)
    append_table(spark.createDataFrame([(30, 9998, None, "NED", None, "Max One", None, None, None, None, "Team")],
                                       schemas.DRIVERS), "drivers", "paddock_t")
    append_table(spark.createDataFrame([(30, 9998, None, None, None, None, None, None, None, None, None)],
                                       schemas.DRIVERS), "drivers", "paddock_t")
    assert rows(api.get_all_drivers(spark, "paddock_t")) == [(30, "Max One", "NED", "Team")]
    # SQL text over the catalog tables
    got = run_sql(spark, "SELECT count(*) FROM paddock_t.drivers WHERE full_name IS NULL").first()[0]
    assert got == 1
    from paddock.sources.files import analyze_tables
    analyze_tables(spark, "paddock_t", ["drivers"])
    stats = spark.sql("DESCRIBE TABLE EXTENDED paddock_t.drivers").where("col_name = 'Statistics'").first()
    assert stats is not None and "2 rows" in stats[1]
    spark.sql("DROP DATABASE paddock_t CASCADE")


def test_points_write_read_prunes(spark, tmp_dir):
    df = _tel_rows(spark, 9998, 30, range(10)).unionByName(_tel_rows(spark, 9999, 44, range(5)))
    p = to_points(df, "telemetry", ["session_key", "driver_number"], {"speed": "int", "rpm": "int"}, "date")
    path = os.path.join(tmp_dir, "bucket")
    write_points(p, path, "session_key")
    r = read_points(spark, path, ["telemetry"], {"session_key": [9998]}, ["speed"], start="2024-01-01 00:00:05")
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "session_key" in plan.split("PartitionFilters")[1][:200]
    assert r.count() == 5


def test_stream_load_enforces_key_across_batches(spark, tmp_dir):
    src, target, bad = (os.path.join(tmp_dir, x) for x in ("landing", "telemetrys", "bad"))
    _tel_rows(spark, 9998, 30, range(5)).coalesce(1).write.parquet(os.path.join(src, "a"))
    q = load_stream(spark, os.path.join(src, "*"), "telemetrys", target, bad,
                    checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    assert spark.read.parquet(target).count() == 5
    # second file: 3 keys already loaded (other speeds), 2 new keys, a duplicate within the file
    more = _tel_rows(spark, 9998, 30, [3, 4, 5, 6], speed=1.0).unionByName(_tel_rows(spark, 9998, 30, [6], 2.0))
    more.coalesce(1).write.parquet(os.path.join(src, "b"))
    q = load_stream(spark, os.path.join(src, "*"), "telemetrys", target, bad,
                    checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    t = spark.read.parquet(target)
    assert t.count() == 7
    assert t.groupBy("session_key", "driver_number", "date").count().where(F.col("count") > 1).count() == 0
    assert rows(t.where(F.col("date") == at(3)).select("speed")) == [(103.0,)]  # first load kept


def test_stream_load_replay_after_lost_checkpoint_appends_nothing(spark, tmp_dir):
    src, target = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "telemetrys")
    _tel_rows(spark, 9998, 30, range(6)).coalesce(1).write.parquet(os.path.join(src, "a"))
    load_stream(spark, os.path.join(src, "*"), "telemetrys", target,
                checkpoint=os.path.join(tmp_dir, "ckpt1")).awaitTermination()
    # The checkpoint is gone (say, a failed driver with a lost folder): every file is replayed.
    load_stream(spark, os.path.join(src, "*"), "telemetrys", target,
                checkpoint=os.path.join(tmp_dir, "ckpt2")).awaitTermination()
    assert spark.read.parquet(target).count() == 6


def test_reference_api_over_catalog_tables(spark, tmp_dir):
    from paddock.plans import reports as R
    from paddock.sources.files import conform
    from paddock.sources.load import write_tables
    from paddock.sources.standin import standin_tables
    from paddock.sources.tables import Tables
    from helpers import same

    raw = standin_tables(spark, "/root/testdata/sf0.001")
    clean = Tables(**{n: conform(getattr(raw, n), n)[0] for n in raw.names()})
    create_tables(spark, "paddock_api", location=os.path.join(tmp_dir, "wh"))
    write_tables(clean, "paddock_api")
    t = api.tables_from_catalog(spark, "paddock_api")
    assert same(api.first_query(spark, "paddock_api"), R.sector_speed(clean))
    assert same(api.second_query(spark, "paddock_api", 9992), R.sector_acceleration(clean, 9992))
    assert same(api.third_query(spark, "paddock_api"), R.tyre_temperature(clean))
    assert same(api.fourth_query(spark, "paddock_api", 9992, None), R.drs_runs(clean, 9992))
    assert same(api.fifth_query(spark, "paddock_api", 9992), R.temperature_speed(clean, 9992))
    assert t.telemetrys.count() == raw.telemetrys.count()
    spark.sql("DROP DATABASE paddock_api CASCADE")


def test_cli_runs_a_report_and_writes_csv(spark, tmp_dir, capsys):
    from paddock import cli
    out = os.path.join(tmp_dir, "fifth")
    cli.main(["fifth", "--standin", "/root/testdata/sf0.001", "--csv", out, "--show", "3"])
    printed = capsys.readouterr().out
    assert printed.startswith("rows: 15  columns: 5")
    assert spark.read.option("header", True).csv(out).count() == 15
