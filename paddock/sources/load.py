"""The table load of the reference, as one Spark job per table.

Order and per-table steps follow the loaders: parents first; ``meeting_key`` (but from meetings
and sessions) and the segment arrays dropped; positions, weather, stints and telemetry reduced to the
first row per key in file order (``_metadata.file_path``, ``_metadata.row_index``,
the pandas ``drop_duplicates`` rule); weather restricted to known sessions with
``rainfall`` made boolean; ``telemetrys_laps`` derived from laps. Every table is
then conformed to its schema. Files of a directory may differ; what can't be read is among the rejected rows. Where the reference relied on the key constraint to
reject a whole insert, repeated keys are quarantined instead and the load goes on.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schemas
from paddock.operators.clean import dedup_first, distinct_pairs, drop_nulls, to_bool
from paddock.operators.joins import semi
from paddock.sources.differing import read_differing
from paddock.sources.files import BAD, append_table, conform, materialize, ranged
from paddock.sources.tables import Tables

# Where the loaders find each table under the data folder, in load order.
SOURCE_FILES = {
    "meetings": "meetings/meetings.parquet",
    "sessions": "sessions/sessions.parquet",
    "drivers": "drivers/drivers.parquet",
    "telemetrys": "telemetrys",  # a directory, one file per (session, driver)
    "laps": "laps/laps.parquet",
    "pits": "pits/pits.parquet",
    "positions": "positions/positions.parquet",
    "tyre_stints": "stints/stints.parquet",
    "weather_conditions": "weather_conditions/weather_conditions.parquet",
}
# Tables the loaders reduce to the first row per key (the others kept every row).
DEDUP_ON_LOAD = {
    "positions": ("session_key", "driver_number", "date"),
    "weather_conditions": ("session_key", "date"),
    "tyre_stints": ("session_key", "stint_number", "driver_number"),
    "telemetrys": ("session_key", "driver_number", "date"),
}


def file_order() -> list:
    return [F.col("_file"), F.col("_row")]


def read_in_file_order(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """All rows of a file or directory, with their file and row position, load-time columns dropped; and
    the files that can't be read (path, error). Files may differ in their columns and types."""
    df, unreadable = read_differing(spark, path, schemas.SCHEMAS[table])
    return df.drop(*schemas.dropped_on_load(table)), unreadable


def read_layout(spark: SparkSession, root: str, tables: tuple[str, ...] = tuple(SOURCE_FILES)) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The raw rows of every table found under ``root``, any path that Spark reads, and its unreadable files. Tables without files are
    named in a warning; if there is none at all that is an error."""
    raw, unreadable, missing = {}, {}, []
    for name in tables:
        try:
            raw[name], unreadable[name] = read_in_file_order(spark, f"{root.rstrip('/')}/{SOURCE_FILES[name]}", name)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    if not raw:
        raise FileNotFoundError(f"none of the tables {', '.join(missing)} is under {root}")
    if missing:
        warnings.warn(f"no files under {root} for {', '.join(missing)}", stacklevel=2)
    return raw, unreadable


def _with_files(rejected: DataFrame, unreadable: DataFrame) -> DataFrame:
    """Rejected rows, and a row for each file that can't be read."""
    files = unreadable.select(F.concat(F.lit("unreadable file "), "path", F.lit(": "), "error").alias("_reason"))
    return rejected.drop("_file", "_row", BAD).unionByName(files, allowMissingColumns=True)


def load_for_points(spark: SparkSession, root: str) -> tuple[Tables, dict[str, DataFrame]]:
    """The tables as the point loaders read them: rows with any null in the files' own columns go first, then
    repeated keys (in file order), then the values are converted. Returns the clean tables and the rejected rows."""
    clean, bad = {}, {}
    raw, unreadable = read_layout(spark, root)
    for name, df in raw.items():
        df = drop_nulls(df, [c for c in df.columns if c != BAD])
        if name == "weather_conditions" and "rainfall" in df.columns:
            df = df.withColumn("rainfall", to_bool("rainfall"))
        if name in DEDUP_ON_LOAD:
            df = dedup_first(df, list(DEDUP_ON_LOAD[name]), file_order())
        clean[name], rejected = conform(df, name, order=file_order(), on_duplicate="quarantine")
        bad[name] = _with_files(rejected, unreadable[name])
    if "weather_conditions" in clean and "sessions" in clean:
        clean["weather_conditions"] = semi(clean["weather_conditions"], clean["sessions"], ["session_key"])
    return Tables(**clean), bad


def load_reference_layout(spark: SparkSession, root: str,
                          materialized: bool = False) -> tuple[Tables, dict[str, DataFrame]]:
    """Load every table found under ``root``; returns the clean tables and the rejected rows.

    With ``materialized`` the clean tables are written once under ``spark.checkpoint.dir``
    (telemetry partitioned by session) and returned as reads of those files, so the
    reports that follow neither recompute the load nor depend on its lineage.
    """
    raw, unreadable = read_layout(spark, root)
    if "laps" in raw:
        raw["telemetrys_laps"] = distinct_pairs(raw["laps"], ["driver_number", "session_key"]) \
            .withColumn("_file", F.lit("")).withColumn("_row", F.lit(0).cast("long"))
    if "weather_conditions" in raw:
        wc = raw["weather_conditions"]
        if "sessions" in raw:
            wc = semi(wc, raw["sessions"], ["session_key"])
        if "rainfall" in wc.columns:
            wc = wc.withColumn("rainfall", to_bool("rainfall"))
        raw["weather_conditions"] = wc
    clean, bad = {}, {}
    for name, df in raw.items():
        if name in DEDUP_ON_LOAD:
            df = dedup_first(df, list(DEDUP_ON_LOAD[name]), file_order())
        good, rejected = conform(df, name, order=file_order(), on_duplicate="quarantine")
        if materialized:
            good = materialize(spark, good, name, ["session_key"] if name == "telemetrys" else ())
        clean[name], bad[name] = good, _with_files(rejected, unreadable[name]) if name in unreadable else rejected.drop("_file", "_row")
    t = Tables(**clean)
    return (_with_ranges(t) if materialized else t), bad


def _with_ranges(t: Tables) -> Tables:
    """The ranges of drivers with very many samples are counted at load time, not while a report is built."""
    if t.telemetrys is not None:
        t.time_ranges()
    return t


def write_tables(t: Tables, database: str) -> None:
    """Append the loaded tables to the catalog tables of ``database`` (parents first)."""
    for name in schemas.SCHEMAS:
        df = getattr(t, name, None)
        if df is not None:
            append_table(df.select(*schemas.SCHEMAS[name].fieldNames()), name, database)


def materialize_tables(spark: SparkSession, t: Tables) -> Tables:
    """Write every table once under ``spark.checkpoint.dir``, as it is (``load_reference_layout``
    has already conformed loaded tables; adding absent columns as nulls here would change
    what the null-dropping point loader keeps): telemetry partitioned by session and
    time-ordered per driver inside files (the S13 layout), the rest as plain parquet.
    Returns the tables as reads of those files, the state a loaded warehouse is in
    when reports run."""
    out = {}
    for name in t.names():
        good = getattr(t, name)
        if name == "telemetrys":
            good = ranged(good, ["session_key", "driver_number", "date"])
            out[name] = materialize(spark, good, name, ["session_key"])
        else:
            out[name] = materialize(spark, good, name)
    return _with_ranges(Tables(**out))
