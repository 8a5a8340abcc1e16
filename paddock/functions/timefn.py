"""Time arithmetic on ``timestamp_ntz`` columns.

Everything stays independent of the session time zone: intervals are added to
wall-clock timestamps and differences are taken between wall-clock values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds(c) -> Column:
    """``INTERVAL '1 second' * c``: a day-time interval, rounded to microseconds; null in, null out."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(c).cast("decimal(18,6)"))


def plus_seconds(ts, secs) -> Column:
    """``ts + INTERVAL '1 second' * secs`` keeping ``timestamp_ntz``."""
    return _c(ts) + seconds(secs)


def seconds_between(a, b) -> Column:
    """``EXTRACT(EPOCH FROM b - a)`` as a double, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b)) / F.lit(1e6)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp (no zone applied)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts))


def time_bucket(ts, bucket_seconds: int) -> Column:
    """Integer bucket of width ``bucket_seconds`` a timestamp falls in."""
    return F.floor(epoch_micros(ts) / F.lit(bucket_seconds * 1_000_000))


def day_start(ts) -> Column:
    """``date_trunc('day', ts)`` returned as ``timestamp_ntz`` (no zone round trip)."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def parse_iso_utc(text) -> Column:
    """ISO-8601 text, with or without fraction and offset, to a UTC ``timestamp_ntz``.

    Text with an offset is moved to UTC; text without one is taken as UTC.
    Unparseable text gives null (use with the quarantine operator).
    """
    t = _c(text)
    has_zone = t.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    instant = F.try_to_timestamp(t)  # naive text is read as wall clock of the session zone
    # Zoned text: the instant's UTC wall clock; naive text: its own wall clock.
    return (F.when(has_zone, F.to_utc_timestamp(instant, F.current_timezone()))
            .otherwise(instant).cast("timestamp_ntz"))
