"""Ranges of an ordered column per key, from the data's quantiles.

An ordered window or an interval join per key sends all rows of a key to one task. Cutting time into
equal widths helps little where rows come in bursts. Here only keys with more rows than a
bound are cut, at quantiles of their own rows, so every range holds about the same number of rows, whether
they spread over a week or fall into one second. A key's ranges are numbered in the column's order, and a value's
range number grows with the value, so an interval of values is an interval of numbers, never more than the key has ranges.

The cuts are a small table (one row per hot key), worked out once, when the rows are loaded or at the first use.
Results never depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions.timefn import epoch_micros

ROWS = 250_000          # rows of a range, about
FAN = 256               # ranges of a key on each of two levels
BROADCAST_CUTS = 4_000_000   # cuts that are broadcast at most (32 MB); beyond, the table is joined over salts
SALTS = 32


@dataclass(frozen=True)
class TimeRanges:
    """``cuts``: keys, ``_outer`` (cuts between a key's blocks), ``_inner`` (cuts within each), ``_base`` (ranges before each block)."""

    cuts: DataFrame
    keys: tuple[str, ...]
    n_cuts: int

    def numbered(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        """``df`` with the range number of ``value`` (a timestamp) within its key; 0 for keys that aren't cut, null for null values."""
        t = epoch_micros(value)
        rows = df.withColumn("_at", t)
        if self.n_cuts <= BROADCAST_CUTS:
            met = rows.join(F.broadcast(self.cuts), list(self.keys), "left")
        else:
            salted = self.cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = rows.withColumn("_salt", F.pmod(F.xxhash64("_at"), F.lit(SALTS)).cast("int")).join(salted, [*self.keys, "_salt"], "left")
        block = F.size(F.filter("_outer", lambda c: c <= F.col("_at")))
        within = F.size(F.filter(F.get("_inner", block), lambda c: c <= F.col("_at")))
        number = F.when(F.col("_at").isNotNull(), F.when(F.col("_outer").isNull(), F.lit(0)).otherwise(F.get("_base", block) + within)).cast("long")
        return met.select(*[F.col(c) for c in df.columns], number.alias(name))


def _spaced(cuts: str, ranges: Column) -> Column:
    """Of ``FAN - 1`` cuts those that leave ``ranges`` ranges, without repeats."""
    wanted = F.transform(F.sequence(F.lit(1), F.greatest(ranges - 1, F.lit(1))), lambda i: F.get(cuts, F.floor(i * FAN / ranges).cast("int") - 1))
    return F.when(ranges > 1, F.array_distinct(wanted)).otherwise(F.array().cast("array<bigint>"))


def quantile_ranges(df: DataFrame, keys: Sequence[str], order_col: str, rows: int | None = None) -> TimeRanges | None:
    """Ranges of about ``rows`` rows for every key that has more; None where no key has.

    One count by key; only the rows of keys beyond the bound are read again for their quantiles (partial sketches
    before the shuffle), twice: between blocks, and within each. One row reaches the driver.
    """
    from paddock.sources.files import kept
    rows = rows or ROWS
    keys = list(keys)
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(order_col).alias("_n")).where(F.col("_n") > rows)
    if counts.limit(1).count() == 0:
        return None
    counts = kept(spark, counts, "ranges-counts")
    at = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    hot = df.select(*keys, epoch_micros(F.col(order_col)).alias("_at")).where(F.col("_at").isNotNull()).join(counts, keys)
    ranges = F.least(F.ceil(F.sqrt(F.col("_n") / rows)), F.lit(FAN)).cast("int")   # blocks, each cut again
    outer = (hot.groupBy(*keys, "_n").agg(F.percentile_approx("_at", at, 10_000).alias("_cuts"))
             .select(*keys, _spaced("_cuts", ranges).alias("_outer")))
    outer = kept(spark, outer, "ranges-outer")
    salted = outer.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = (hot.withColumn("_salt", F.pmod(F.xxhash64("_at"), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"])
              .withColumn("_block", F.size(F.filter("_outer", lambda c: c <= F.col("_at")))))
    inner = (placed.groupBy(*keys, "_block").agg(F.percentile_approx("_at", at, 10_000).alias("_cuts"), F.count("*").alias("_m"))
             .select(*keys, "_block", _spaced("_cuts", F.least(F.ceil(F.col("_m") / rows), F.lit(FAN)).cast("int")).alias("_within")))
    per_key = inner.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_block", "_within"))).alias("_by_block"))
    blocks = F.sequence(F.lit(0), F.size("_outer"))
    cuts = outer.join(per_key, keys).withColumn(
        "_inner", F.transform(blocks, lambda b: F.coalesce(F.try_element_at("_by_block", b), F.array().cast("array<bigint>"))))
    before = F.transform(blocks, lambda b: F.aggregate(F.slice("_inner", 1, b), F.lit(0), lambda s, x: s + F.size(x) + 1))
    cuts = kept(spark, cuts.select(*keys, "_outer", "_inner", before.alias("_base")), "ranges-cuts")
    n = cuts.agg(F.sum(F.size("_outer") + F.size(F.flatten("_inner")))).first()[0]
    return TimeRanges(cuts, tuple(keys), n or 0)
