"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each builds the stand-in telemetry tables from the parquet tables in ``sf_dir``
and runs one report or operator over all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock.plans import reports as R
from paddock.sources.standin import RACE_SESSION, standin_tables

Query = Callable[[SparkSession, str], DataFrame]


_TABLES: dict = {}


def _t(spark: SparkSession, sf_dir: str):
    """The stand-in tables of ``sf_dir``, defined once per session and reused.

    They are lazy plans (no data is cached): defining them reads parquet footers
    and builds seven views, which is worth doing once, as an application would.
    """
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # a Spark Connect session has no SparkContext
        app = None
    key = (app, id(spark), sf_dir)
    if key not in _TABLES:
        _TABLES[key] = standin_tables(spark, sf_dir)
    return _TABLES[key]


def _nine(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles that engines sum in different ways, to nine places for the comparison; the reports don't round."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(c, 9) for c in columns})


ONE_DRIVER = 30


def odd_speeds(s: SparkSession, d: str) -> DataFrame:
    """R2 on telemetry in which some speeds are NaN or infinite; means that are no finite number are named in ``kind``."""
    from pyspark.sql import functions as F
    t = _t(s, d)
    speed = (F.when(F.hour("date") == 3, float("nan")).when(F.minute("date") == 7, float("inf")).when(F.minute("date") == 11, float("-inf"))
             .otherwise(F.col("speed")))
    t = t.with_(telemetrys=t.telemetrys.withColumn("speed", speed))
    mean = F.col("mean_acceleration")
    kind = F.when(mean.isNull(), None).when(F.isnan(mean), "NaN").when(mean == float("inf"), "Infinity").when(mean == float("-inf"), "-Infinity").otherwise("finite")
    out = R.sector_acceleration(t, None, require_telemetry_laps=False).withColumn("kind", kind)
    return out.withColumn("mean_acceleration", F.when(F.col("kind") == "finite", F.round("mean_acceleration", 9)))


def report_queries() -> dict[str, Query]:
    return {
        "r0_drivers": lambda s, d: R.all_drivers(_t(s, d)),
        "r1a_sector_speed": lambda s, d: R.sector_speed(_t(s, d)),
        "r1b_sector_speed_all_laps": lambda s, d: R.sector_speed(_t(s, d), all_laps=True),
        "r1c_sector_speed_best_lap": lambda s, d: R.sector_speed_best_lap(_t(s, d)),
        "r2a_sector_accel": lambda s, d: _nine(R.sector_acceleration(_t(s, d), RACE_SESSION), "mean_acceleration"),
        "r2b_sector_accel_nojoin": lambda s, d: _nine(R.sector_acceleration(
            _t(s, d), RACE_SESSION, require_telemetry_laps=False), "mean_acceleration"),
        "r2a_all_sessions": lambda s, d: _nine(R.sector_acceleration(_t(s, d), None), "mean_acceleration"),
        "r2_odd_speeds": odd_speeds,
        "r3a_tyre_temp": lambda s, d: R.tyre_temperature(_t(s, d)),
        "r4_drs_runs": lambda s, d: R.drs_runs(_t(s, d)),
        "r4_drs_runs_nojoin": lambda s, d: R.drs_runs(_t(s, d), require_telemetry_laps=False),
        "r4_one_driver": lambda s, d: R.drs_runs(_t(s, d), session_key=RACE_SESSION, driver_number=ONE_DRIVER),
        "r5_temp_speed": lambda s, d: R.temperature_speed(_t(s, d), RACE_SESSION),
        "r5_all_sessions": lambda s, d: R.temperature_speed(_t(s, d), None),
    }


def all_queries() -> dict[str, Query]:
    return {**report_queries(), **operator_queries()}


# ----------------------------------------------------------------- operators
def _events(s, d):
    from paddock.sources.standin import read
    return read(s, d, "events")


def operator_queries() -> dict[str, Query]:
    import warnings

    from pyspark.sql import functions as F

    from paddock.functions.labels import brake_state, drs_state
    from paddock.functions.timefn import parse_iso_utc
    from paddock.operators import clean as C
    from paddock.operators.joins import semi
    from paddock.operators.dealing import exact_sample, task_groups
    from paddock.operators.points import last_write_wins, pivot_points, read_points, to_points, write_blocks, write_points
    from paddock.operators.quantiles import radix_quantiles
    from paddock.operators.windows import islands, run_summary
    from paddock.plans import point_reports as P
    from paddock.plans import timing as TM
    from paddock.sources.files import keys_from_path
    from paddock.sources.standin import read

    def timing_log(s, d):
        return _events(s, d).select(F.col("event_id").alias("statid"), F.col("user_id").alias("queryid"),
                                    F.col("event_type").alias("index_type"), F.col("value").alias("elapsedtime"))

    def lineitem_dedup(s, d):
        li = read(s, d, "lineitem")
        keys = ["l_orderkey", "l_linenumber"]
        return C.dedup_first(li, keys, [F.col(c).asc_nulls_last() for c in li.columns if c not in keys])

    def iso_round_trip(s, d):
        e = _events(s, d)
        text = F.concat(F.date_format(e.ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                        F.lit("+02:00"))
        return e.select("event_id", parse_iso_utc(text).alias("ts_utc"))

    def lap_quarantine(s, d):
        laps = _t(s, d).laps
        _, bad = C.quarantine(laps, {
            "null key": F.col("session_key").isNull() | F.col("driver_number").isNull()
            | F.col("lap_number").isNull(),
            "null lap_duration": F.col("lap_duration").isNull(),
            "non-positive sector": (F.col("duration_sector_1") <= 0) | (F.col("duration_sector_2") <= 0)
            | (F.col("duration_sector_3") <= 0),
        })
        return bad.select("session_key", "driver_number", "lap_number", F.col("_reason").alias("reason"))

    def telemetry_runs(s, d):
        tel = _t(s, d).telemetrys.select(R.SD[0], R.SD[1], "date", "speed", drs_state("drs").alias("drs"),
                                         brake_state("brake").alias("brake_state"))
        runs = islands(tel, R.SD, "date", ["drs", "brake_state"], "run_id", buckets=_t(s, d).time_ranges())
        return run_summary(runs, R.SD, "run_id", "date", "speed", ["drs", "brake_state"])

    def telemetry_points(s, d):
        return P.points_of(_t(s, d).telemetrys, "telemetry", "session_first")

    def new_folder(s, name):
        """A new folder in the shared one; a temporary one only where none is set in a single-process session."""
        import tempfile
        import uuid

        from paddock.session import checkpoint_dir
        local = s.sparkContext.master.split("[")[0] == "local"
        return f"{checkpoint_dir(s, tempfile.mkdtemp(prefix='paddock-') if local else None)}/{name}/{uuid.uuid4().hex}"

    def loaded(s, d):
        """The tables written in the loaders' folders, with the columns that the load drops, and loaded from there."""
        from paddock.sources.load import SOURCE_FILES, load_reference_layout
        root, t = new_folder(s, "raw"), _t(s, d)
        for name, path in SOURCE_FILES.items():
            df = getattr(t, name)
            if df is not None:
                if "meeting_key" not in df.columns:
                    df = df.withColumn("meeting_key", F.lit(0).cast("long"))
                if name == "laps":
                    df = df.withColumn("segments_sector_1", F.lit("[]"))
                df.write.parquet(f"{root}/{path}")
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # the stand-in has no files for some tables
            return load_reference_layout(s, root)[0]

    def differing(s, d):
        """Telemetry in files that differ: whole numbers, doubles (some with a fraction), a column less; and a file that isn't parquet."""
        from paddock.sources.load import SOURCE_FILES, load_reference_layout
        root, t = new_folder(s, "differing"), _t(s, d)
        path = f"{root}/{SOURCE_FILES['telemetrys']}"
        tel, part = t.telemetrys, F.col("driver_number") % 3
        tel.where(part == 0).write.parquet(path)
        half = F.when(F.floor("speed") % 50 == 7, 0.5).otherwise(0.0)
        tel.where(part == 1).withColumn("drs", F.col("drs") + half).write.mode("append").parquet(path)
        tel.where(part == 2).drop("throttle").write.mode("append").parquet(path)
        s.createDataFrame([("no parquet",)], "value string").coalesce(1).write.mode("append").text(path)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return load_reference_layout(s, root)

    def differing_files(s, d):
        return differing(s, d)[0].telemetrys.select(*R.SD, "date", "drs", "throttle")

    def rejected_rows(s, d):
        bad = differing(s, d)[1]["telemetrys"]
        return bad.select(*R.SD, "date", F.regexp_extract("_reason", r"^(unreadable file|.*$)", 1).alias("reason"))

    def loaded_sessions(s, d):
        return loaded(s, d).sessions.select("session_key", "meeting_key", "session_name", "circuit_short_name")

    def stored(s, points):
        """The points written to the shared folder and read back."""
        path = new_folder(s, "points")
        write_points(points, path, "session_key")
        return path

    def points_read_back(s, d):
        path = stored(s, P.load_points(_t(s, d), measurements=["telemetry"]))
        return read_points(s, path, ["telemetry"], {"session_key": [RACE_SESSION]}, ["speed", "drs"])

    def tyre_temperature_stored(s, d):
        path = stored(s, P.load_points(_t(s, d), measurements=["tyre_stints", "weather_conditions"]))
        points = read_points(s, path, ["tyre_stints", "weather_conditions"])
        return _nine(P.tyre_temperature_from_points(points), "mean_track_temperature")

    def written_measure(s, d):
        """The denormalised measure written as points, read back, the last write of a point kept, and reduced."""
        points = P.stint_weather_points(_t(s, d), only=["lap_start", "lap_end", "track_temperature"], keep_order=True, in_blocks=True)
        back = write_blocks(points, new_folder(s, "query3"), "session_key", P.BLOCK)
        points = last_write_wins(back, ["session_key", "compound", "driver_number"], [F.col(P.WRITE_ORDER)], block=P.BLOCK)
        return _nine(P.tyre_temperature_denormalised(points, block=P.BLOCK), "mean_track_temperature")

    def radix_quartiles(s, d):
        log = timing_log(s, d)
        q = radix_quantiles(log, ["index_type"], "elapsedtime", [0.25, 0.5, 0.75, 0.999])
        return _nine(q, "q_0", "q_1", "q_2", "q_3")

    def sampled_events(s, d):
        return exact_sample(_events(s, d), 0.05, ["event_id"])

    def dealt_events(s, d):
        return task_groups(_events(s, d).select("event_id", "event_type"), "event_type", 7, ["event_id"])

    def numbered_runs(s, d):
        """A log of one part of the runs, and the rest appended: the ids that the whole log has, and how often each."""
        log = timing_log(s, d).withColumn("description", F.lit("run"))
        old = log.where("statid % 4 = 0")
        rest = log.where("statid % 4 <> 0").select("queryid", "index_type", "description", F.col("elapsedtime").alias("seconds"))
        last = old.agg(F.max("statid")).first()[0] or 0
        whole = TM.append_runs(s, old.select(*[F.col(f.name).cast(f.dataType) for f in TM.LOG_SCHEMA.fields]), rest)
        return whole.where(F.col("statid") > last).groupBy("statid").agg(F.count("*").alias("n"))

    def appended_laps(s, d):
        """Laps appended in overlapping batches, one of them run twice; what is there in the end, and why rows were rejected."""
        from paddock.sources.append import append_once
        t, path = _t(s, d), new_folder(s, "appended")
        laps = t.laps.select(*R.SD, "lap_number", "lap_duration")
        parents = [(["session_key"], t.sessions.where("session_name = 'Race'"), ["session_key"])]
        batches = [(1, laps.where("lap_number % 2 = 1")), (2, laps), (2, laps), (3, laps.where("lap_number % 3 = 0").unionByName(laps.where("lap_number % 3 = 0")))]
        rejected = None
        for number, rows in batches:
            bad = append_once(s, rows, path, [*R.SD, "lap_number"], number, parents).withColumn("batch", F.lit(number))
            rejected = bad if rejected is None else rejected.unionByName(bad)
        there = s.read.parquet(path).select(F.lit("there").alias("state"), F.lit(0).alias("batch"), *R.SD)
        out = there.unionByName(rejected.select(F.col("_reason").alias("state"), "batch", *R.SD))
        return out.groupBy("state", "batch", "session_key").agg(F.count("*").alias("n"))

    def landed_records(s, d):
        """Events written as lines of JSON, every 101st cut off and every 7th with a field more; landed twice."""
        from pyspark.sql import types as T

        from paddock.sources.records import land_records
        source, out = new_folder(s, "lines"), new_folder(s, "landed")
        k, n = F.get_json_object("props", "$.k").cast("int"), F.col("event_id")
        line = F.to_json(F.struct("event_id", k.alias("k"), F.when(n % 7 == 0, F.lit("x")).alias("more")))
        _events(s, d).select(F.when(n % 101 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(source)
        schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.IntegerType())])
        rejected, unknown = land_records(s, source, schema, out)
        again, _ = land_records(s, source, schema, out)
        told = rejected.unionByName(again).select(F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("int").alias("k"), F.lit("rejected").alias("state"))
        fields = unknown.groupBy("field").agg(F.sum("n").alias("event_id")).select("event_id", F.lit(None).cast("int").alias("k"), F.col("field").alias("state"))
        return s.read.parquet(out).withColumn("state", F.lit("landed")).unionByName(told).unionByName(fields)

    def second_precision_points(s, d):
        # Written at one-second precision, samples of a driver in the same second land on
        # the same point; the later sample (write order = sample time) wins.
        tel = _t(s, d).telemetrys.withColumn("_seq", F.col("date"))
        p = to_points(tel, "telemetry", ["session_key", "driver_number"], {"speed": "int", "drs": "int"},
                      F.date_trunc("second", F.col("date")).cast("timestamp_ntz"), carry=["_seq"])
        return last_write_wins(p, ["session_key", "driver_number"], [F.col("_seq")]).drop("_seq")

    def union_laps_stints(s, d):
        t = _t(s, d)
        return (t.laps.select(*R.SD, "lap_number", "lap_duration")
                .unionByName(t.tyre_stints.select(*R.SD, "stint_number", "compound"), allowMissingColumns=True))

    return {
        "r3b_tyre_temp_points": lambda s, d: _nine(P.tyre_temperature_from_points(
            P.load_points(_t(s, d), measurements=["tyre_stints", "weather_conditions"])), "mean_track_temperature"),
        "r3c_tyre_temp_denorm": lambda s, d: _nine(P.tyre_temperature_denormalised_preagg(_t(s, d)), "mean_track_temperature"),
        "r6_sector_samples": lambda s, d: P.sector_sample_points(_t(s, d)),
        "j5_left_label": lambda s, d: R.sector_samples(_t(s, d).telemetrys, _t(s, d).laps),
        "r7_timing_summary": lambda s, d: TM.timing_summary(timing_log(s, d)),
        "r8_timing_population": lambda s, d: _nine(TM.timing_population(timing_log(s, d)), "mean", "median", "std"),
        "a7_filtered_summary": lambda s, d: TM.timing_summary(timing_log(s, d), index_type="purchase"),
        "a18_label_means": lambda s, d: _nine(TM.label_means(timing_log(s, d), "index_type", "elapsedtime"), "mean_elapsedtime"),
        "s9_points_unpivot": telemetry_points,
        "s1_loaded_sessions": loaded_sessions,
        "s2_loaded_sector_speed": lambda s, d: R.sector_speed(loaded(s, d)),
        "s2_differing_files": differing_files,
        "c15_rejected_rows": rejected_rows,
        "s10_points_read_back": points_read_back,
        "r3b_stored_points": tyre_temperature_stored,
        "a15_points_pivot": lambda s, d: pivot_points(telemetry_points(s, d),
                                                      ["_time", "session_key", "driver_number"],
                                                      ["speed", "throttle", "brake", "drs"]),
        "a17_last_write_wins": second_precision_points,
        "c5_dedup_first": lineitem_dedup,
        "c6_drop_nulls": lambda s, d: C.drop_nulls(_t(s, d).drivers),
        "c7_semi_filter": lambda s, d: C.keep_keys_in(
            read(s, d, "orders"), read(s, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]),
        "c8_composite_semi": lambda s, d: semi(_t(s, d).telemetrys, _t(s, d).telemetrys_laps, R.SD),
        "c10_bool_cast": lambda s, d: read(s, d, "labels").select(
            "doc_id", C.to_bool("quality").alias("is_quality"), C.to_bool("toxic").alias("is_toxic")),
        "c12_iso_timestamp": iso_round_trip,
        "c13_pk_audit": lambda s, d: C.pk_violations(read(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "c14_fk_audit": lambda s, d: C.fk_orphans(read(s, d, "documents").select("doc_id", "lang", "source"),
                                                  read(s, d, "labels"), ["doc_id"]),
        "c15_quarantine": lap_quarantine,
        "c16_modulus_sample": lambda s, d: C.modulus_sample(_events(s, d), "event_id", 20),
        "c16_exact_sample": sampled_events,
        "c9_task_groups": dealt_events,
        "a19_numbered_runs": numbered_runs,
        "a10_radix_quantiles": radix_quartiles,
        "s5_appended_laps": appended_laps,
        "s12_written_measure": written_measure,
        "s3_landed_records": landed_records,
        "c17_distinct_pairs": lambda s, d: C.distinct_pairs(_t(s, d).laps),
        "s4_path_keys": lambda s, d: read(s, d, "pages").select(
            "page_id", *keys_from_path(F.col("url"), r"/([a-z]{2})/(\d+)", ["lang", "page_no"], ["string", "int"])),
        "o4_topk": lambda s, d: _t(s, d).laps.orderBy(
            F.col("lap_duration").asc_nulls_last(), *[F.col(c).asc() for c in (*R.SD, "lap_number")]).limit(10),
        "u1_union_by_name": union_laps_stints,
        "f11_json_field": lambda s, d: _events(s, d).select(
            "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")),
        "w2_best_lap": lambda s, d: R.best_laps(_t(s, d).laps),
        "w6_islands": telemetry_runs,
    }


def reports_on_tables() -> dict[str, Callable]:
    """The headline reports as functions of loaded ``Tables`` (used by the benchmark)."""
    from paddock.plans import point_reports as P
    return {
        "r0_drivers": R.all_drivers,
        "r1a_sector_speed": R.sector_speed,
        "r1b_sector_speed_all_laps": lambda t: R.sector_speed(t, all_laps=True),
        "r1c_sector_speed_best_lap": R.sector_speed_best_lap,
        "r2a_sector_accel": lambda t: _nine(R.sector_acceleration(t, RACE_SESSION), "mean_acceleration"),
        "r2b_sector_accel_nojoin": lambda t: _nine(R.sector_acceleration(t, RACE_SESSION, require_telemetry_laps=False),
                                                   "mean_acceleration"),
        "r3a_tyre_temp": R.tyre_temperature,
        "r3b_tyre_temp_points": lambda t: _nine(P.tyre_temperature_from_points(
            P.load_points(t, measurements=["tyre_stints", "weather_conditions"])), "mean_track_temperature"),
        "r3c_tyre_temp_denorm": lambda t: _nine(P.tyre_temperature_denormalised_preagg(t), "mean_track_temperature"),
        "r4_drs_runs": R.drs_runs,
        "r5_temp_speed": lambda t: R.temperature_speed(t, RACE_SESSION),
        "r6_sector_samples": P.sector_sample_points,
    }
