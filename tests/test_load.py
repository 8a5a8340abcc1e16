import os


from helpers import at, rows
from paddock.sources.load import load_reference_layout


def _write(df, path):
    df.coalesce(1).write.mode("overwrite").parquet(path)


def test_reference_load(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data")
    _write(spark.createDataFrame([(9998, 1, "Race"), (9999, 1, "Practice")],
                                 "session_key long, meeting_key long, session_name string"),
           os.path.join(root, "sessions/sessions.parquet"))
    _write(spark.createDataFrame([(1, 9998, 30, 1, at(0), 10.0, 20.0, 30.0, 60.0, "[1]", "[2]", "[3]"),
                                  (1, 9998, 30, 1, at(5), 10.0, 20.0, 30.0, 61.0, "[1]", "[2]", "[3]"),
                                  (1, 9998, 44, 1, at(0), 10.0, 20.0, 30.0, 62.0, "[1]", "[2]", "[3]")],
                                 "meeting_key long, session_key long, driver_number long, lap_number long, "
                                 "date_start timestamp_ntz, duration_sector_1 double, duration_sector_2 double, "
                                 "duration_sector_3 double, lap_duration double, segments_sector_1 string, "
                                 "segments_sector_2 string, segments_sector_3 string"),
           os.path.join(root, "laps/laps.parquet"))
    _write(spark.createDataFrame([(1, 9998, at(0), 1.0, 30.0), (1, 9998, at(0), 0.0, 31.0),
                                  (1, 9998, at(60), float("nan"), 32.0), (1, 1234, at(0), 0.0, 33.0)],
                                 "meeting_key long, session_key long, date timestamp_ntz, rainfall double, "
                                 "track_temperature double"),
           os.path.join(root, "weather_conditions/weather_conditions.parquet"))
    tel = os.path.join(root, "telemetrys")
    for name, speeds in (("session_key=9998&driver_number=30.parquet", (1.0, 2.0)),
                         ("session_key=9998&driver_number=44.parquet", (3.0,))):
        drv = 30 if "30" in name else 44
        _write(spark.createDataFrame([(9998, drv, at(0), s) for s in speeds],
                                     "session_key int, driver_number int, date timestamp_ntz, speed double"),
               os.path.join(tmp_dir, "t" + name))
        f = [x for x in os.listdir(os.path.join(tmp_dir, "t" + name)) if x.endswith(".parquet")][0]
        os.makedirs(tel, exist_ok=True)
        os.rename(os.path.join(tmp_dir, "t" + name, f), os.path.join(tel, name))

    t, bad = load_reference_layout(spark, root)
    assert "meeting_key" not in t.laps.columns and "segments_sector_1" not in t.laps.columns
    # laps: repeated key quarantined, not dropped silently
    assert rows(t.laps.select("driver_number", "lap_duration"), "driver_number") == [(30, 60.0), (44, 62.0)]
    assert rows(bad["laps"].select("_reason")) == [("duplicate key",)]
    assert rows(t.telemetrys_laps, "driver_number") == [(30, 9998), (44, 9998)]
    # weather: first row per key in file order, foreign session dropped, NaN rainfall is true
    assert rows(t.weather_conditions.select("date", "rainfall", "track_temperature"), "date") == \
        [(at(0), True, 30.0), (at(60), True, 32.0)]
    # telemetry: first row per key in file order
    assert rows(t.telemetrys.select("driver_number", "speed"), "driver_number") == [(30, 1.0), (44, 3.0)]
    assert t.telemetrys.schema["session_key"].dataType.simpleString() == "int"


def test_materialized_load_reads_from_shared_folder(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data")
    _write(spark.createDataFrame([(9998, 30, at(0), 1.0), (9998, 30, at(0), 2.0)],
                                 "session_key int, driver_number int, date timestamp_ntz, speed double"),
           os.path.join(root, "telemetrys"))
    t, _ = load_reference_layout(spark, root, materialized=True)
    ckpt = spark.conf.get("spark.checkpoint.dir")
    assert all(ckpt.rstrip("/") + "/tables/telemetrys/" in f for f in t.telemetrys.inputFiles())
    assert rows(t.telemetrys.select("speed")) == [(1.0,)]


def test_reports_on_loaded_tables_equal_registered_queries(spark):
    """The benchmark times the reports on tables loaded once; they must compute the same thing."""
    import __spark_entry__ as E
    from helpers import same
    from paddock.catalog import reports_on_tables
    from paddock.sources.load import materialize_tables
    from paddock.sources.standin import standin_tables
    sf = "/root/testdata/sf0.001"
    loaded = materialize_tables(spark, standin_tables(spark, sf))
    qs = E.queries()
    for name, fn in reports_on_tables().items():
        assert same(fn(loaded), qs[name](spark, sf)), name


def test_load_tables_from_explicit_paths(spark, tmp_dir):
    from paddock.sources.files import load_tables
    p = os.path.join(tmp_dir, "pos")
    _write(spark.createDataFrame([(1, 9998, 30, at(0), 2), (1, 9998, 30, at(0), 1), (1, None, 30, at(1), 3)],
                                 "meeting_key long, session_key long, driver_number long, date timestamp_ntz, "
                                 "position long"), p)
    t, bad = load_tables(spark, {"positions": p})
    assert rows(t.positions.select("position")) == [(1,)]  # first by the other columns: date, then position
    assert rows(bad["positions"].select("_reason")) == [("null session_key",)]


def test_measurement_layouts():
    from paddock.plans.point_reports import measurement_spec
    tags, fields, time = measurement_spec("laps", "driver_first")
    assert tags == ("driver_number", "session_key") and "is_pit_out_lap" in fields and time == "date_start"
    tags, fields, _ = measurement_spec("laps", "session_first")
    assert tags == ("session_key", "driver_number", "is_pit_out_lap") and "is_pit_out_lap" not in fields
    assert measurement_spec("tyre_stints", "session_first")[2] is None  # written at load time


def _all_files(spark, root):
    """One small file for each of the nine tables, times as text with an offset."""
    iso = "2024-01-01T02:00:0{}+02:00"
    tables = {
        "meetings/meetings.parquet": ([(1200, "GP", "2024-01-01T02:00:00+02:00", 2024)], "meeting_key long, meeting_name string, date_start string, year long"),
        "sessions/sessions.parquet": ([(9998, 1200, "Race", iso.format(0))], "session_key long, meeting_key long, session_name string, date_start string"),
        "drivers/drivers.parquet": ([(30, 9998, 1200, "A B")], "driver_number long, session_key long, meeting_key long, full_name string"),
        "telemetrys": ([(9998, 30, iso.format(1), 100.5, 1200)], "session_key long, driver_number long, date string, speed double, meeting_key long"),
        "laps/laps.parquet": ([(1200, 9998, 30, 1, iso.format(0), 1.5, "[1]")], "meeting_key long, session_key long, driver_number long, lap_number long, "
                              "date_start string, lap_duration double, segments_sector_1 string"),
        "pits/pits.parquet": ([(9998, 30, 1, iso.format(3), 20.5, 1200)], "session_key long, driver_number long, lap_number long, date string, pit_duration double, meeting_key long"),
        "positions/positions.parquet": ([(9998, 30, iso.format(4), 2, 1200)], "session_key long, driver_number long, date string, position long, meeting_key long"),
        "stints/stints.parquet": ([(9998, 30, 1, 1, 9, "SOFT", 1200), (9998, 30, 2, 10, None, "HARD", 1200), (9998, 30, 2, 10, 12, "HARD", 1200)],
                                  "session_key long, driver_number long, stint_number long, lap_start long, lap_end long, compound string, meeting_key long"),
        "weather_conditions/weather_conditions.parquet": ([(9998, iso.format(5), 1.0, 30.25, 1200)], "session_key long, date string, rainfall double, track_temperature double, meeting_key long"),
    }
    for path, (data, schema) in tables.items():
        _write(spark.createDataFrame(data, schema), os.path.join(root, path))


def test_all_nine_tables_from_a_uri(spark, tmp_dir):
    _all_files(spark, tmp_dir)
    t, bad = load_reference_layout(spark, "file://" + tmp_dir)
    assert set(t.names()) == {"meetings", "sessions", "drivers", "telemetrys", "telemetrys_laps", "laps", "pits", "positions", "tyre_stints", "weather_conditions"}
    assert rows(t.sessions.select("meeting_key", "date_start")) == [(1200, at(0))] and rows(t.meetings.select("meeting_key")) == [(1200,)]
    assert all("meeting_key" not in getattr(t, n).columns for n in t.names() if n not in ("meetings", "sessions"))
    assert rows(t.telemetrys.select("date", "speed")) == [(at(1), 100.5)] and rows(t.weather_conditions.select("date")) == [(at(5),)]
    assert all(b.count() == 0 for b in bad.values())


def test_missing_tables_are_named_and_none_is_an_error(spark, tmp_dir):
    import pytest
    _all_files(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        load_reference_layout(spark, "file://" + os.path.join(tmp_dir, "nowhere"))
    part = os.path.join(tmp_dir, "part")
    _write(spark.createDataFrame([(9998, 1200)], "session_key long, meeting_key long"), os.path.join(part, "sessions/sessions.parquet"))
    with pytest.warns(UserWarning, match="meetings.*weather_conditions"):
        t, _ = load_reference_layout(spark, part)
    assert t.names() == ["sessions"]


def test_points_load_drops_nulls_before_repeats(spark, tmp_dir):
    """An incomplete first row doesn't hide a complete second one; columns that no file has don't count as null."""
    from paddock.plans.point_reports import load_points, points_of
    from paddock.sources.load import load_for_points
    _all_files(spark, tmp_dir)
    t, _ = load_for_points(spark, tmp_dir)
    assert rows(t.tyre_stints.select("stint_number", "lap_end"), "stint_number") == [(1, 9), (2, 12)]
    assert points_of(t.tyre_stints, "tyre_stints").select("_field").distinct().count() == 3
    assert points_of(t.tyre_stints, "tyre_stints").count() == 6
    assert load_points(t).select("_measurement").distinct().count() == 7  # the sessions file has no field
    # the relational load of the same files still has points, too
    assert points_of(load_reference_layout(spark, tmp_dir)[0].telemetrys, "telemetry").count() == 1


def test_values_that_do_not_fit_are_rejected(spark):
    from paddock.sources.files import conform
    df = spark.createDataFrame([(1, 30, 1.0, "2024-01-01T00:00:00Z"), (1, 31, 2.5, "2024-01-01T00:00:00"), (1, 32, 3.0, "no time")],
                               "session_key long, driver_number long, position double, date string")
    good, bad = conform(df, "positions")
    assert rows(good.select("driver_number", "position", "date"), "driver_number") == [(30, 1, at(0))]
    assert rows(bad.select("driver_number", "_reason"), "driver_number") == [(31, "bad position"), (32, "bad date")]


def test_unread_files_are_named(spark, tmp_dir):
    from paddock.sources.files import read_table, unread_files
    _write(spark.createDataFrame([(1,)], "x int"), tmp_dir)
    broken = os.path.join(tmp_dir, "broken.parquet")
    with open(broken, "wb") as f:
        f.write(b"PAR1 nothing PAR1")
    df = read_table(spark, tmp_dir, spark.createDataFrame([], "x int").schema, skip_corrupt_files=True)
    assert [os.path.basename(r[0]) for r in unread_files(spark, tmp_dir, df).collect()] == ["broken.parquet"]


def test_files_that_differ(spark, tmp_dir):
    """Whole numbers, doubles with a gap, text, a missing column, a column of its own and a broken file in one directory."""
    root = os.path.join(tmp_dir, "data")
    tel = os.path.join(root, "telemetrys")
    base = "session_key int, driver_number int, date timestamp_ntz"
    for schema, data in ((f"{base}, drs long, speed double", [(1, 10, at(0), 8, 1.0), (1, 10, at(1), 10, 2.0)]),
                         (f"{base}, drs double, speed double", [(1, 11, at(0), 8.0, 3.0), (1, 11, at(1), float("nan"), 4.0), (1, 11, at(2), 1.5, 5.0)]),
                         (f"{base}, drs string, speed float, extra int", [(1, 12, at(0), "12", 6.0, 1), (1, 12, at(1), "open", 7.0, 1)]),
                         (f"{base}, speed double, extra string", [(1, 13, at(0), 8.0, "x")])):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(tel)
    spark.createDataFrame([("broken",)], "value string").coalesce(1).write.mode("append").text(tel)
    with open(os.path.join(tel, "cut off.parquet"), "w") as f:
        f.write("PAR1")
    clean, bad = load_reference_layout(spark, root)
    got = rows(clean.telemetrys.select("driver_number", "date", "drs", "speed"), "driver_number", "date")
    assert got == [(10, at(0), 8, 1.0), (10, at(1), 10, 2.0), (11, at(0), 8, 3.0), (11, at(1), None, 4.0), (12, at(0), 12, 6.0), (13, at(0), None, 8.0)]
    reasons = sorted(r["_reason"] for r in bad["telemetrys"].collect())
    assert [r.split(" ")[0:2] for r in reasons] == [["bad", "drs"], ["bad", "drs"], ["unreadable", "file"], ["unreadable", "file"]]
    assert any("cut off.parquet" in r for r in reasons)
    again, _ = load_reference_layout(spark, root, materialized=True)
    assert again.telemetrys.count() == 6


def test_only_broken_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data")
    spark.createDataFrame([("broken",)], "value string").write.text(os.path.join(root, "laps/laps.parquet"))
    clean, bad = load_reference_layout(spark, root)
    assert clean.laps.count() == 0 and bad["laps"].where("_reason like 'unreadable file%'").count() >= 1


def test_paths_that_tasks_cannot_open_are_read_as_bytes(spark, tmp_dir, monkeypatch):
    from paddock.sources import differing as D
    path = os.path.join(tmp_dir, "t")
    spark.range(3).coalesce(1).write.parquet(path)
    with open(os.path.join(path, "x.parquet"), "w") as f:
        f.write("no")
    want = sorted((r.path, r.types, r.error is None) for r in D.footers(spark, path))

    def closed(batches):
        import pyarrow as pa
        for b in batches:
            none = pa.nulls(b.num_rows, pa.string())
            yield pa.record_batch([b.column("path"), none, none], names=["path", "types", "error"])
    monkeypatch.setattr(D, "_footers", closed)
    assert sorted((r.path, r.types, r.error is None) for r in D.footers(spark, path)) == want and len(want) == 2
