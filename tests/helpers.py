import datetime as dt

from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def telemetry(spark, data):
    """data: (session, driver, seconds, speed, brake, drs, throttle)"""
    return spark.createDataFrame(
        [(s, d, at(t), float(v), b, r, float(th)) for s, d, t, v, b, r, th in data],
        "session_key int, driver_number int, date timestamp_ntz, speed double, brake int, drs int, throttle double")


def laps(spark, data):
    """data: (session, driver, lap_number, start_seconds, d1, d2, d3, lap_duration)"""
    return spark.createDataFrame(
        [(s, d, n, at(st), d1, d2, d3, ld) for s, d, n, st, d1, d2, d3, ld in data],
        "session_key int, driver_number int, lap_number int, date_start timestamp_ntz, duration_sector_1 double, "
        "duration_sector_2 double, duration_sector_3 double, lap_duration double")


def _sortable(r):
    return tuple((v is None, "" if v is None else str(v)) for v in r)


def same(a, b):
    key = sorted(a.columns)
    ra = sorted(map(tuple, a.select(*key).collect()), key=_sortable)
    rb = sorted(map(tuple, b.select(*key).collect()), key=_sortable)
    return ra == rb


__all__ = ["F", "T0", "at", "rows", "telemetry", "laps", "same"]
