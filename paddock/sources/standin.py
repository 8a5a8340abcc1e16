"""Telemetry tables derived from the driver's synthetic tables.

The repository has no real race data; these lazy views turn ``events``,
``customer`` and ``nation`` into the seven tables the reports read. Every view
is a plain DataFrame plan over the given parquet tables, so its size grows with
them. Six sessions of five days each (keys 9990-9995, even ones are races); a
lap is one day of a driver's samples, starting at midnight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.functions.timefn import day_start
from paddock.sources.tables import Tables

# Fixed values of the stand-in data model.
FIRST_SESSION = 9990
DAYS_PER_SESSION = 5
RACE_SESSION = 9992  # plays the part of the reference's fixed race session
DRS_CODE = {"view": 0, "click": 1, "signup": 8, "purchase": 12}  # anything else: 14
COMPOUND_BY_DRS = {0: "SOFT", 1: "MEDIUM", 8: "HARD", 12: "INTERMEDIATE"}  # 14: null


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _session_index(ts) -> F.Column:
    return F.floor((F.dayofmonth(ts) - 1) / DAYS_PER_SESSION).cast("int")


def telemetrys(events: DataFrame) -> DataFrame:
    drs = F.lit(14)
    for name, code in reversed(DRS_CODE.items()):
        drs = F.when(F.col("event_type") == name, code).otherwise(drs)
    return events.select(
        (F.lit(FIRST_SESSION) + _session_index(F.col("ts"))).cast("int").alias("session_key"),
        F.col("user_id").cast("int").alias("driver_number"),
        F.col("ts").alias("date"),
        F.col("value").alias("speed"),
        F.when(F.col("event_type") == "error", 100).otherwise(0).alias("brake"),
        drs.alias("drs"),
        (F.col("event_id") % 101).cast("double").alias("throttle"),
    )


def sessions(events: DataFrame, nation: DataFrame) -> DataFrame:
    k = events.select(_session_index(F.col("ts")).alias("k")).distinct()
    return (k.join(nation, F.col("n_nationkey") == F.col("k"))
            .select((F.lit(FIRST_SESSION) + F.col("k")).cast("int").alias("session_key"),
                    (F.lit(1200) + F.col("k")).cast("int").alias("meeting_key"),
                    F.when(F.col("k") % 2 == 0, "Race").otherwise("Practice").alias("session_name"),
                    F.col("n_name").alias("circuit_short_name")))


def telemetrys_laps(tel: DataFrame) -> DataFrame:
    # A tenth of the drivers is left out so the existence join has work to do.
    return (tel.where(F.col("driver_number") % 10 != 9)
            .select("session_key", "driver_number").distinct())


def laps(tel: DataFrame) -> DataFrame:
    day = F.dayofmonth("date")
    g = (tel.groupBy("session_key", "driver_number", day.alias("lap_number"))
         .agg(day_start(F.min("date")).alias("date_start")))
    d1 = (F.lit(15000.25) + 1000 * (F.col("driver_number") % 7)).cast("double")
    d2 = (F.lit(22000.5) + 500 * (F.col("lap_number") % 5)).cast("double")
    d3 = (F.lit(38000.125) + 10 * (F.col("driver_number") % 13)).cast("double")
    return g.select(
        "session_key", "driver_number", F.col("lap_number").cast("int").alias("lap_number"), "date_start",
        d1.alias("duration_sector_1"), d2.alias("duration_sector_2"), d3.alias("duration_sector_3"),
        F.when((F.col("driver_number") + F.col("lap_number")) % 11 == 0, F.lit(None).cast("double"))
        .otherwise(d1 + d2 + d3).alias("lap_duration"),
    )


def drivers(customer: DataFrame, nation: DataFrame, tel: DataFrame) -> DataFrame:
    pairs = tel.select("session_key", "driver_number").distinct()
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(pairs, pairs.driver_number == customer.c_custkey)
            .select(F.col("c_custkey").cast("int").alias("driver_number"), "session_key",
                    F.col("c_name").alias("full_name"),
                    F.when(F.col("c_custkey") % 17 == 0, F.lit(None)).otherwise(F.col("n_name"))
                    .alias("country_code"),
                    F.col("c_mktsegment").alias("team_name")))


def weather_conditions(tel: DataFrame) -> DataFrame:
    return (tel.where((F.col("drs") == 0) & (F.col("driver_number") % 5 == 0))
            .select("session_key", "date", (F.lit(20.0) + F.col("speed") / 10).alias("track_temperature")))


def tyre_stints(tel: DataFrame) -> DataFrame:
    compound = F.lit(None).cast("string")
    for code, name in reversed(COMPOUND_BY_DRS.items()):
        compound = F.when(F.col("drs") == code, name).otherwise(compound)
    day = F.dayofmonth("date")
    g = tel.groupBy("session_key", "driver_number", "drs").agg(
        F.min(day).cast("int").alias("lap_start"), F.max(day).cast("int").alias("lap_end"))
    w = Window.partitionBy("session_key", "driver_number").orderBy("drs")
    return g.select("session_key", "driver_number",
                    F.row_number().over(w).cast("int").alias("stint_number"),
                    "lap_start", "lap_end", compound.alias("compound"))


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    events = read(spark, sf_dir, "events")
    nation = read(spark, sf_dir, "nation")
    customer = read(spark, sf_dir, "customer")
    tel = telemetrys(events)
    return Tables(
        telemetrys=tel,
        sessions=sessions(events, nation),
        telemetrys_laps=telemetrys_laps(tel),
        laps=laps(tel),
        drivers=drivers(customer, nation, tel),
        weather_conditions=weather_conditions(tel),
        tyre_stints=tyre_stints(tel),
    )
