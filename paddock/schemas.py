"""Fixed schemas of the eleven telemetry tables and their keys."""

from __future__ import annotations

from pyspark.sql import types as T

I, D, S, B, TS = T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


MEETINGS = _struct(("meeting_key", I), ("meeting_name", S), ("meeting_official_name", S), ("circuit_key", I),
                   ("circuit_short_name", S), ("country_key", I), ("country_code", S), ("country_name", S),
                   ("date_start", TS), ("gmt_offset", S), ("location", S), ("year", I), ("meeting_code", S))
SESSIONS = _struct(("session_key", I), ("meeting_key", I), ("session_name", S), ("session_type", S),
                   ("date_start", TS), ("date_end", TS), ("circuit_key", I), ("circuit_short_name", S),
                   ("country_key", I), ("country_code", S), ("country_name", S), ("location", S),
                   ("gmt_offset", S), ("year", I))
DRIVERS = _struct(("driver_number", I), ("session_key", I), ("broadcast_name", S), ("country_code", S),
                  ("first_name", S), ("full_name", S), ("headshot_url", S), ("last_name", S),
                  ("name_acronym", S), ("team_colour", S), ("team_name", S))
TELEMETRYS_LAPS = _struct(("driver_number", I), ("session_key", I))
TELEMETRYS = _struct(("session_key", I), ("driver_number", I), ("date", TS), ("brake", I), ("drs", I),
                     ("n_gear", I), ("rpm", I), ("speed", D), ("throttle", D))
LAPS = _struct(("session_key", I), ("driver_number", I), ("lap_number", I), ("date_start", TS),
               ("duration_sector_1", D), ("duration_sector_2", D), ("duration_sector_3", D),
               ("i1_speed", D), ("i2_speed", D), ("is_pit_out_lap", B), ("lap_duration", D), ("st_speed", D))
PITS = _struct(("session_key", I), ("driver_number", I), ("lap_number", I), ("date", TS), ("pit_duration", D))
POSITIONS = _struct(("session_key", I), ("driver_number", I), ("date", TS), ("position", I))
TYRE_STINTS = _struct(("session_key", I), ("driver_number", I), ("stint_number", I), ("lap_start", I),
                      ("lap_end", I), ("compound", S), ("tyre_age_at_start", I))
WEATHER_CONDITIONS = _struct(("session_key", I), ("date", TS), ("air_temperature", D), ("humidity", D),
                             ("pressure", D), ("rainfall", B), ("track_temperature", D),
                             ("wind_direction", D), ("wind_speed", D))
RACE_CONTROLS = _struct(("session_key", I), ("driver_number", I), ("category", S), ("date", TS), ("flag", S),
                        ("lap_number", I), ("message", S), ("scope", S), ("sector", I))

SCHEMAS: dict[str, T.StructType] = {
    "meetings": MEETINGS, "sessions": SESSIONS, "drivers": DRIVERS, "telemetrys_laps": TELEMETRYS_LAPS,
    "telemetrys": TELEMETRYS, "laps": LAPS, "pits": PITS, "positions": POSITIONS, "tyre_stints": TYRE_STINTS,
    "weather_conditions": WEATHER_CONDITIONS, "race_controls": RACE_CONTROLS,
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "meetings": ("meeting_key",),
    "sessions": ("session_key",),
    "drivers": ("driver_number", "session_key"),
    "telemetrys_laps": ("driver_number", "session_key"),
    "telemetrys": ("session_key", "driver_number", "date"),
    "laps": ("session_key", "driver_number", "lap_number"),
    "pits": ("session_key", "driver_number", "lap_number"),
    "positions": ("session_key", "driver_number", "date"),
    "tyre_stints": ("session_key", "driver_number", "stint_number"),
    "weather_conditions": ("session_key", "date"),
    "race_controls": ("session_key", "driver_number", "date"),
}

# (child, child columns, parent, parent columns)
FOREIGN_KEYS: list[tuple[str, tuple[str, ...], str, tuple[str, ...]]] = [
    ("sessions", ("meeting_key",), "meetings", ("meeting_key",)),
    ("telemetrys", ("session_key",), "sessions", ("session_key",)),
    ("telemetrys", ("driver_number", "session_key"), "drivers", ("driver_number", "session_key")),
    ("telemetrys", ("driver_number", "session_key"), "telemetrys_laps", ("driver_number", "session_key")),
    ("laps", ("session_key",), "sessions", ("session_key",)),
    ("laps", ("driver_number", "session_key"), "telemetrys_laps", ("driver_number", "session_key")),
    ("laps", ("driver_number", "session_key"), "drivers", ("driver_number", "session_key")),
    ("pits", ("session_key",), "sessions", ("session_key",)),
    ("pits", ("driver_number", "session_key"), "drivers", ("driver_number", "session_key")),
    ("pits", ("driver_number", "session_key", "lap_number"), "laps", ("driver_number", "session_key", "lap_number")),
    ("positions", ("session_key",), "sessions", ("session_key",)),
    ("positions", ("driver_number", "session_key"), "drivers", ("driver_number", "session_key")),
    ("tyre_stints", ("session_key",), "sessions", ("session_key",)),
    ("tyre_stints", ("driver_number", "session_key"), "drivers", ("driver_number", "session_key")),
    ("weather_conditions", ("session_key",), "sessions", ("session_key",)),
    ("race_controls", ("session_key",), "sessions", ("session_key",)),
    ("race_controls", ("driver_number", "session_key"), "drivers", ("driver_number", "session_key")),
]

# Columns the loaders drop on the way in (C1): the meeting's key, which only meetings and sessions keep, and
# the segment arrays of laps.
DROPPED_ON_LOAD = ("meeting_key", "segments_sector_1", "segments_sector_2", "segments_sector_3")
KEEP_MEETING_KEY = ("meetings", "sessions")


def dropped_on_load(table: str) -> tuple[str, ...]:
    """The columns that the load of ``table`` drops."""
    return tuple(c for c in DROPPED_ON_LOAD if not (c == "meeting_key" and table in KEEP_MEETING_KEY))
