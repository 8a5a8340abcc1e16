"""Report entry points under the names the reference's users call, over catalog tables.

``fn(spark, schema_name, ...) -> DataFrame`` reads the eleven tables from the
catalog database ``schema_name`` (created by ``create_tables`` and filled by
the loaders) and returns the lazy report. The fixed session and driver of the
reference are defaults here, not constants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock import schemas
from paddock.plans import reports as R
from paddock.sources.tables import Tables

# The session and driver the reference's reports are pinned to.
DEFAULT_SESSION = 9998
DEFAULT_DRIVER = 30


def tables_from_catalog(spark: SparkSession, schema_name: str) -> Tables:
    present = {t.name for t in spark.catalog.listTables(schema_name)}
    return Tables(**{n: spark.table(f"{schema_name}.{n}") for n in schemas.SCHEMAS if n in present})


def get_all_drivers(spark: SparkSession, schema_name: str) -> DataFrame:
    return R.all_drivers(tables_from_catalog(spark, schema_name))


def first_query(spark: SparkSession, schema_name: str) -> DataFrame:
    return R.sector_speed(tables_from_catalog(spark, schema_name))


def second_query(spark: SparkSession, schema_name: str, session_key: int = DEFAULT_SESSION) -> DataFrame:
    return R.sector_acceleration(tables_from_catalog(spark, schema_name), session_key)


def third_query(spark: SparkSession, schema_name: str) -> DataFrame:
    return R.tyre_temperature(tables_from_catalog(spark, schema_name))


def fourth_query(spark: SparkSession, schema_name: str, session_key: int | None = DEFAULT_SESSION,
                 driver_number: int | None = DEFAULT_DRIVER) -> DataFrame:
    return R.drs_runs(tables_from_catalog(spark, schema_name), session_key, driver_number)


def fifth_query(spark: SparkSession, schema_name: str, session_key: int = DEFAULT_SESSION) -> DataFrame:
    return R.temperature_speed(tables_from_catalog(spark, schema_name), session_key)


COMMANDS: dict[str, Callable[..., DataFrame]] = {
    "drivers": get_all_drivers,
    "first": first_query,
    "second": second_query,
    "third": third_query,
    "fourth": fourth_query,
    "fifth": fifth_query,
}
