"""Joins (J1-J10): existence joins, audits, and the interval-containment join.

The interval join is an equi join on the entity keys plus a cell or range of time, with the exact range test as a
residual predicate. Intervals make a bounded number of rows however long they are, and no single
(session, driver) key ends up in a single task however hot it is. Whether a side is broadcast is left to AQE,
which measures the side at run time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions.timefn import epoch_micros, time_bucket
from paddock.operators.ranges import TimeRanges

DEFAULT_BUCKET_SECONDS = 3600


def semi(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (IN-subquery, ``isin``, composite membership)."""
    return df.join(other.select(*on), list(on), "left_semi").select(*df.columns)


def anti(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(*on), list(on), "left_anti").select(*df.columns)


def interval_join(samples: DataFrame, intervals: DataFrame, on: Sequence[str], ts: str, lo: Column, hi: Column,
                  buckets: int | TimeRanges | None = DEFAULT_BUCKET_SECONDS,
                  keep_bucket: str | None = None, sample_bucket: str | None = None) -> DataFrame:
    """Inner join: equal ``on`` keys and ``lo <= samples[ts] <= hi`` (SQL ``BETWEEN``).

    ``lo``/``hi`` are expressions over ``intervals``; intervals with a null bound match nothing, as in SQL.
    Output: every column of both sides (keys once). ``buckets`` chooses the equi key besides ``on``; the result
    doesn't depend on it:

    * seconds: dyadic cells. An interval belongs to the level whose cells are as long as it, or longer, at least that many
      seconds, and touches two cells there, however long it is; a sample looks up one cell of each level in use.
    * ``TimeRanges``: the sample's range; an interval goes to the ranges of its key that it touches, all of which have
      samples. The rows stay partitioned by (keys, range), which ``keep_bucket`` keeps under that name for a later
      window; ``sample_bucket`` names a sample column that holds the range already.
    * None: no other key.
    """
    on = list(on)
    iv = intervals.select("*", lo.alias("_lo"), hi.alias("_hi"))
    inside = F.col(ts).between(F.col("_lo"), F.col("_hi"))
    if isinstance(buckets, TimeRanges):
        iv = buckets.numbered(buckets.numbered(iv.where("_lo <= _hi"), F.col("_lo"), "_first"), F.col("_hi"), "_final")
        iv = iv.select("*", F.explode(F.sequence("_first", "_final")).alias("_tb")).drop("_first", "_final")
        smp = samples.withColumn("_tb", F.col(sample_bucket)) if sample_bucket else buckets.numbered(samples, F.col(ts), "_tb")
        out = smp.join(iv, [*on, "_tb"], "inner").where(inside)
    elif buckets:
        out = _cell_join(samples, iv, on, ts, buckets).where(inside)
    else:
        out = samples.join(iv, on, "inner").where(inside)
    kept = []
    if keep_bucket and buckets:
        kept = [(F.col("_tb") if isinstance(buckets, TimeRanges) else time_bucket(F.col(ts), buckets)).alias(keep_bucket)]
    return out.select(*[F.col(c) for c in out.columns if c not in ("_lo", "_hi", "_tb", "_level", "_cell")], *kept)


def _cell_join(samples: DataFrame, iv: DataFrame, on: list[str], ts: str, least_seconds: int) -> DataFrame:
    """Samples with the intervals that touch the same dyadic cell."""
    unit = least_seconds * 1e6

    def cell(micros: Column) -> Column:
        return F.floor(micros / (F.pow(F.lit(2.0), F.col("_level")) * F.lit(unit)))

    a, b = epoch_micros(F.col("_lo")), epoch_micros(F.col("_hi"))
    level = F.greatest(F.ceil(F.log2(F.greatest(b - a, F.lit(1)) / F.lit(unit))), F.lit(0)).cast("int")
    iv = iv.where("_lo <= _hi").withColumn("_level", level)
    levels = iv.agg(F.collect_set("_level")).scalar()   # a few numbers, found while the query runs
    iv = iv.select("*", F.explode(F.sequence(cell(a), cell(b))).alias("_cell"))
    smp = samples.select("*", F.explode(levels).alias("_level")).withColumn("_cell", cell(epoch_micros(F.col(ts))))
    return smp.join(iv, [*on, "_level", "_cell"], "inner")


def blocked_join(left: DataFrame, right: DataFrame, on: Sequence[str], rows: int = 1000, seed: int = 7,
                 pairs_a_task: int = 500_000, left_by: Sequence[Column] | None = None, right_by: Sequence[Column] | None = None,
                 block: str | None = None) -> DataFrame:
    """Many-to-many inner join in blocks: every key's rows on both sides are dealt over blocks of about ``rows`` by their hash, and
    each pair of blocks is joined apart, so that no unit of work makes more than about ``rows`` squared pairs, however many
    rows share a key. A side's rows are repeated once per block of the other side, never more. The blocks are
    counted first and dealt over as many tasks as their pairs need (``pairs_a_task``, or one block pair if that is more): the sides are
    small beside their pairs, and dealt by their own size they would end in one task. Sides that are costly should be stored.

    Rows with equal ``left_by`` (``right_by``; default: equal rows) share a block. ``block`` names a column with the number of the
    pair of blocks, one for each key and pair, by which the result is dealt; its metadata has the number of ``tasks``."""
    on = list(on)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*on).agg(F.ceil(F.count("*") / rows).cast("int").alias(name))

    plan = blocks(left, "_nl").join(blocks(right, "_nr"), on)
    pairs = (plan.agg(F.sum(F.col("_nl").cast("long") * F.col("_nr"))).first()[0] or 0) * rows * rows
    tasks = max(1, math.ceil(pairs / max(pairs_a_task, rows * rows)))
    if block:  # one row a key, whose pairs are numbered on from those of the keys before it
        before = F.sum(F.col("_nl").cast("long") * F.col("_nr")).over(Window.orderBy(*on).rowsBetween(Window.unboundedPreceding, -1))
        plan = plan.withColumn("_from", F.coalesce(before, F.lit(0)))
    a = left.join(plan, on).withColumn("_bl", F.pmod(F.xxhash64(F.lit(seed), *(left_by or left.columns)), "_nl").cast("int"))
    b = right.join(plan, on).withColumn("_br", F.pmod(F.xxhash64(F.lit(seed), *(right_by or right.columns)), "_nr").cast("int"))
    a = a.withColumn("_br", F.explode(F.sequence(F.lit(0), F.col("_nr") - 1)))
    b = b.withColumn("_bl", F.explode(F.sequence(F.lit(0), F.col("_nl") - 1)))
    if block:
        number = F.col("_from") + F.col("_bl").cast("long") * F.col("_nr") + F.col("_br")
        a = a.select(*left.columns, number.alias(block)).repartition(tasks, block)
        b = b.select(*[c for c in right.columns if c not in on], number.alias(block)).repartition(tasks, block)
        # each right row meets the left ones in turn, so that the result comes in the order of ``right_by`` and is soon sorted by it
        out = b.sortWithinPartitions(block, *(right_by or [])).join(a, block)
        return out.select(*left.columns, *[c for c in right.columns if c not in on], F.col(block).alias(block, metadata={"tasks": tasks}))
    keys = [*on, "_bl", "_br"]
    a, b = a.select(*left.columns, "_bl", "_br"), b.select(*right.columns, "_br", "_bl")
    return a.repartition(tasks, *keys).join(b.repartition(tasks, *keys), keys).drop("_bl", "_br")
