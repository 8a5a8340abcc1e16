"""Ordered-window operators (W1-W8, O6, G9) that also hold up on hot keys.

A window partitioned by (session, driver) sends every sample of a driver to one
task; if one driver holds a third of the data that task holds a third of the
data. With ``buckets`` the windows here partition by (keys, bucket) instead and stitch the buckets
back together from a small per-bucket summary (last row of the previous bucket, running totals), which is
exact: the result equals the unbucketed window. Buckets are ``TimeRanges``, cut at quantiles of the keys that have
too many rows, so bursts are cut as well; or a fixed number of seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions.timefn import time_bucket
from paddock.operators.ranges import TimeRanges


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Top-1 row per key by ``order`` (W2 + O6; stands in for ``DISTINCT ON``).

    Spark plans ``row_number() = 1`` with a partial ``WindowGroupLimit`` before the
    shuffle, so a hot key is cut to one row per map task before it moves.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _bucketed(df: DataFrame, order_col: str, buckets: int | TimeRanges, bucket_col: str | None = None) -> DataFrame:
    """``df`` with the bucket ``_b``. The explicit not-null filter matches the one Spark infers for the stitch join, so both
    branches read the same input and its shuffle is reused (times are never null here)."""
    if bucket_col:
        out = df.withColumn("_b", F.col(bucket_col))
    elif isinstance(buckets, TimeRanges):
        out = buckets.numbered(df, F.col(order_col), "_b")
    else:
        out = df.select("*", time_bucket(F.col(order_col), buckets).alias("_b"))
    return out.where(F.col("_b").isNotNull())


def with_previous(df: DataFrame, keys: Sequence[str], order_col: str, cols: Sequence[str],
                  buckets: int | TimeRanges | None = None, prefix: str = "prev_",
                  keep_bucket: str | None = None) -> DataFrame:
    """Add ``prev_<c>`` = ``LAG(c, 1)`` within ``keys`` ordered by ``order_col``.

    Rows are assumed unique on (keys, order_col), with no nulls there (the telemetry
    primary key); the bucketed form relies on it. ``keep_bucket`` keeps the
    bucket under that name for a later bucketed join.
    """
    keys = list(keys)
    cols = list(cols)
    if not buckets:
        w = Window.partitionBy(*keys).orderBy(order_col)
        return df.select("*", *[F.lag(c, 1).over(w).alias(prefix + c) for c in cols])

    # One pass per (keys, bucket): the in-bucket lag, and the values of the bucket's last row on that row alone.
    # The stitch reads the same input columns as the main branch, so Spark reuses the input's shuffle.
    wb = Window.partitionBy(*keys, "_b").orderBy(order_col)
    last = F.lead(order_col, 1).over(wb).isNull()
    b = _bucketed(df, order_col, buckets).select(
        "*", F.lag(order_col, 1).over(wb).alias("_po"), *[F.lag(c, 1).over(wb).alias("_in_" + c) for c in cols], last.alias("_is_last"))
    wk = Window.partitionBy(*keys).orderBy("_b")
    per = (b.where("_is_last").select(*keys, "_b", *[F.lag(c, 1).over(wk).alias("_pl_" + c) for c in cols]))
    out = b.join(per, keys + ["_b"], "inner")
    first_in_bucket = F.col("_po").isNull()
    kept = [F.col("_b").alias(keep_bucket)] if keep_bucket else []
    return out.select(*[F.col(c) for c in df.columns],
                      *[F.when(first_in_bucket, F.col("_pl_" + c)).otherwise(F.col("_in_" + c)).alias(prefix + c)
                        for c in cols], *kept)


def change_flag(states: Sequence[str], prefix: str = "prev_") -> Column:
    """0 when every state equals the previous row's, else 1 (first row, any change,
    or any null comparison, as in ``CASE WHEN LAG(a)=a AND ... THEN 0 ELSE 1``)."""
    same = None
    for s in states:
        e = F.col(prefix + s) == F.col(s)
        same = e if same is None else same & e
    return F.when(same, 0).otherwise(1)


def islands(df: DataFrame, keys: Sequence[str], order_col: str, states: Sequence[str],
            run_col: str = "run_id", buckets: int | TimeRanges | None = None,
            bucket_col: str | None = None) -> DataFrame:
    """Gaps-and-islands (W6 -> W3 -> W8): number the runs of equal ``states``.

    ``run_col`` = running ``SUM(change_flag)`` per ``keys`` ordered by ``order_col``
    (a run restarts at every change and at every null state). Run ids restart at
    1 for every key. ``bucket_col`` names an existing column that already holds
    the bucket (e.g. kept by ``interval_join``). Keys and
    ``order_col`` must not be null (primary-key columns); states may be.
    """
    keys = list(keys)
    states = list(states)
    if not buckets:
        w = Window.partitionBy(*keys).orderBy(order_col)
        flagged = df.select("*", *[F.lag(s, 1).over(w).alias("prev_" + s) for s in states])
        flagged = flagged.withColumn("_chg", change_flag(states))
        return (flagged.withColumn(run_col, F.sum("_chg").over(w).cast("long"))
                .drop("_chg", *["prev_" + s for s in states]))

    # 1. One window pass per (keys, bucket): changes between consecutive rows and their running sum.
    wb = Window.partitionBy(*keys, "_b").orderBy(order_col)
    b = _bucketed(df, order_col, buckets, bucket_col)
    first_in_bucket = F.lag(order_col, 1).over(wb).isNull()
    same_as_prev = None
    for s in states:
        e = F.lag(s, 1).over(wb) == F.col(s)
        same_as_prev = e if same_as_prev is None else same_as_prev & e
    b = b.select("*", first_in_bucket.alias("_is_first"), F.lead(order_col, 1).over(wb).isNull().alias("_is_last"),
                 F.when(first_in_bucket | same_as_prev, 0).otherwise(1).alias("_ichg"))
    b = b.select("*", F.sum("_ichg").over(wb).alias("_irun"))
    # 2. One row per bucket (small), from its first and last rows alone. Stitch: does the first row change against
    #    the previous bucket's last row? Offsets = changes in all earlier buckets. The last row travels
    #    whole: the stitch then reads the same input columns as the main branch, so Spark reuses the input's shuffle.
    st = F.struct(*[F.col(s).alias(s) for s in states])
    last_row = F.struct(*[F.col(c).alias(c) for c in df.columns])
    ends = (b.where(F.col("_is_first") | F.col("_is_last")).groupBy(*keys, "_b")
            .agg(F.first(F.when(F.col("_is_first"), st), ignorenulls=True).alias("_first"),
                 F.first(F.when(F.col("_is_last"), last_row), ignorenulls=True).alias("_last"), F.max("_irun").alias("_n")))
    wk = Window.partitionBy(*keys).orderBy("_b")
    prev_last = F.lag("_last", 1).over(wk)
    same = None
    for s in states:
        e = prev_last.getField(s) == F.col("_first." + s)
        same = e if same is None else same & e
    per = ends.select(*keys, "_b", "_n", F.when(same, 0).otherwise(1).alias("_fchg"))
    per = per.select(*keys, "_b", "_fchg", F.coalesce(
        F.sum(F.col("_fchg") + F.col("_n")).over(wk.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    # 3. Join the small per-bucket table back; the big side keeps its (keys, bucket) partitioning.
    out = b.join(per, keys + ["_b"], "inner")
    run = (F.col("_off") + F.col("_fchg") + F.col("_irun")).cast("long")
    return out.select(*[F.col(c) for c in df.columns], run.alias(run_col))


def run_summary(df: DataFrame, keys: Sequence[str], run_col: str, order_col: str, value_col: str,
                states: Sequence[str]) -> DataFrame:
    """One row per run (G9): first/last time and the value at the first and the last time.

    Replaces the reference's two window results joined on seven columns with one
    aggregate; ``min_by``/``max_by`` assume unique times within a run (the key).
    """
    return (df.groupBy(*keys, run_col, *states)
            .agg(F.min(order_col).alias("start_time"), F.max(order_col).alias("end_time"),
                 F.min_by(value_col, F.col(order_col)).alias("start_value"),
                 F.max_by(value_col, F.col(order_col)).alias("end_value"),
                 F.count(F.lit(1)).alias("n_samples")))


def suggest_bucket_seconds(df: DataFrame, keys: Sequence[str], order_col: str,
                           rows_per_bucket: int | None = None, floor_seconds: int = 1,
                           sample_fraction: float | None = None) -> int:
    """A bucket width for the bucketed windows and joins, from the data (runs one small job).

    Takes the key with the most rows (n) and its time span, and returns the width that
    gives it about ``rows_per_bucket`` rows per bucket (default sqrt(n)): then neither a
    bucket nor the per-bucket stitch table of that key holds more than ~sqrt(n) rows.
    Only one aggregated row reaches the driver. ``sample_fraction`` estimates n and the
    span from a Bernoulli sample (the width is only a tuning parameter; results never
    depend on it).
    """
    from paddock.functions.timefn import epoch_micros
    scale = 1.0
    if sample_fraction:
        df = df.sample(withReplacement=False, fraction=sample_fraction, seed=7)
        scale = 1.0 / sample_fraction
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    (F.max(epoch_micros(F.col(order_col)))
                                     - F.min(epoch_micros(F.col(order_col)))).alias("span_us"))
    top = per_key.orderBy(F.col("n").desc()).select("n", "span_us").first()
    if top is None or not top["n"]:
        return floor_seconds
    n, span_s = top["n"] * scale, (top["span_us"] or 0) / 1e6
    target = rows_per_bucket or max(1, int(n ** 0.5))
    return max(floor_seconds, int(span_s * target / n))
