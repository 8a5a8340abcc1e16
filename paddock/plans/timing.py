"""Timing log and summaries.

A timing log has one row per run: ``statid, queryid, index_type, description,
elapsedtime`` (seconds). Queries are timed by running them to Spark's ``noop``
sink, which executes the whole plan and discards the rows.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions.exact import SCALE, all_coarse, cast_2dp, exact_mean, exact_mean_2dp, exact_sums, quantiles_2dp, scaled_int
from paddock.operators.dealing import with_ids

LOG_SCHEMA = T.StructType([
    T.StructField("statid", T.LongType()), T.StructField("queryid", T.LongType()),
    T.StructField("index_type", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("elapsedtime", T.DoubleType()),
])


def run_seconds(df: DataFrame) -> float:
    """Run a plan to the noop sink; wall-clock seconds."""
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def append_runs(spark: SparkSession, log: DataFrame | None, runs: DataFrame | list[tuple[int, str, str, float]]) -> DataFrame:
    """Append runs ``(queryid, index_type, description, seconds)`` with dense ids from ``COALESCE(MAX(statid), 0) + 1`` (A19). ``runs`` is
    a DataFrame of any size with these columns, or a list of runs timed on the driver."""
    start = 0
    if log is not None:
        start = log.agg(F.max("statid")).first()[0] or 0
    if isinstance(runs, DataFrame):
        new = with_ids(spark, runs.select("queryid", "index_type", "description", F.col("seconds").alias("elapsedtime")), start + 1, "statid")
        new = new.select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA.fields])
    else:
        new = spark.createDataFrame([(start + k + 1, q, i, d, float(sec)) for k, (q, i, d, sec) in enumerate(runs)], LOG_SCHEMA)
    return new if log is None else log.unionByName(new)


def timing_summary(log: DataFrame, queryid: int | None = None, index_type: str | None = None,
                   value: str = "elapsedtime") -> DataFrame:
    """Per (queryid, index_type): mean, min, quartiles, median, max, sample stddev,
    each ``NUMERIC(8,2)``."""
    if queryid is not None:
        log = log.where(F.col("queryid") == queryid)
    if index_type is not None:
        log = log.where(F.col("index_type") == index_type)
    v = F.col(value)
    s = scaled_int(v).cast("decimal(38,0)")
    n = F.count(s).cast("decimal(38,0)")
    sx, sxx = F.sum(s), F.sum(s * s)
    var_scaled = (n * sxx - sx * sx).cast("double") / (n * (n - 1)).cast("double")
    stddev = F.when(n > 1, F.sqrt(var_scaled) / F.lit(float(SCALE)))
    stddev = F.when(all_coarse(v), stddev).otherwise(F.when(~F.isnan(F.stddev_samp(v)), F.stddev_samp(v)))
    q1, q2, q3 = quantiles_2dp(v, (0.25, 0.5, 0.75))
    g = log.groupBy("queryid", "index_type").agg(
        *exact_sums(v, "t"), cast_2dp(F.min(v)).alias("min_time"), q1.alias("q1_time"), q2.alias("median_time"),
        q3.alias("q3_time"), cast_2dp(F.max(v)).alias("max_time"), cast_2dp(stddev).alias("stddev_time"))
    return g.select("queryid", "index_type", exact_mean_2dp("t").alias("mean_time"), "min_time", "q1_time", "median_time",
                    "q3_time", "max_time", "stddev_time")


def timing_population(log: DataFrame, keys=("queryid", "index_type"), value: str = "elapsedtime") -> DataFrame:
    """Numpy-style statistics per key: mean, median, population std, min, max, none of them rounded."""
    v = F.col(value)
    s = scaled_int(v).cast("decimal(38,0)")
    n = F.count(s).cast("decimal(38,0)")
    sx, sxx = F.sum(s), F.sum(s * s)
    var_scaled = (n * sxx - sx * sx).cast("double") / (n * n).cast("double")
    exact = all_coarse(v)
    g = log.groupBy(*keys).agg(
        *exact_sums(v, "t"),
        F.when(exact, F.percentile(scaled_int(v), F.lit(0.5)) / F.lit(float(SCALE))).otherwise(F.percentile(v, F.lit(0.5))).alias("median"),
        F.when(exact, F.sqrt(var_scaled) / F.lit(float(SCALE))).otherwise(F.stddev_pop(v)).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    return g.select(*keys, exact_mean("t").alias("mean"), "median", "std", "min", "max")


def label_means(df: DataFrame, label: str, value: str) -> DataFrame:
    """Mean per label (the numbers behind the reference's bar charts)."""
    return df.groupBy(label).agg(F.avg(value).alias(f"mean_{value}"))
