"""Rows dealt, sampled and numbered without sorting them or gathering them in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HASH_BITS = 60
LEVEL_BITS = 12      # bits of a histogram level: 4096 counts reach the driver
PLACE_BITS = 33      # of a monotonically increasing id: the place within the partition


def row_hash(cols: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of ``seed`` and the columns as text; the same in every engine."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_sample(df: DataFrame, fraction: float, cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows, those of the smallest hashes of ``cols``; reruns agree.

    The threshold is found by histograms: counts by the hash's next bits, of the one bucket that the wanted number ends in.
    Rows with one hash are ordered by their columns; equal rows are counted, and as many copies come as are wanted.
    """
    hashed = df.withColumn("_h", row_hash(cols, seed))
    n = df.count()
    wanted = round(fraction * n)
    if wanted <= 0:
        return df.limit(0)
    if wanted >= n:
        return df
    low, left = 0, wanted          # all hashes below ``low`` are taken; ``left`` more are wanted
    inside = hashed
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        counts = inside.groupBy(F.shiftright("_h", bits).alias("b")).count().orderBy("b").collect()
        for r in counts:
            if r["count"] >= left:
                low = r["b"] << bits
                inside = hashed.where(F.shiftright("_h", bits) == r["b"])
                break
            left -= r["count"]
    taken = hashed.where(F.col("_h") < low).drop("_h")
    ties = hashed.where(F.col("_h") == low).drop("_h").groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    before = F.coalesce(F.sum("_copies").over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    copies = F.least(F.col("_copies"), F.lit(left) - F.col("_before"))
    last = (ties.withColumn("_before", before).where(F.col("_before") < left)
            .select(*[F.col(c) for c in df.columns], F.explode(F.sequence(F.lit(1), copies)).alias("_i")).drop("_i"))
    return taken.unionByName(last)


def running_total(df: DataFrame, order: str, value: str, name: str, ranges: int = 32) -> DataFrame:
    """``df`` (one row per ``order``) with the sum of ``value`` over all rows before. Ranges are summed apart and shifted by what
    precedes them: one row per range is all that meets in one task."""
    from paddock.sources.files import kept
    parts = kept(df.sparkSession, df.repartitionByRange(ranges, order).withColumn("_part", F.spark_partition_id()), "totals", must=True)
    prior = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.groupBy("_part").agg(F.sum(value).alias("_s")).select("_part", F.coalesce(F.sum("_s").over(prior), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    total = (F.col("_shift") + F.coalesce(F.sum(value).over(within), F.lit(0))).cast("long")
    return parts.join(shift, "_part").select(*[F.col(c) for c in df.columns], total.alias(name))


def task_groups(df: DataFrame, key: str, groups: int, cols: Sequence[str], name: str = "task_group", seed: int = 42) -> DataFrame:
    """Every row with one of ``groups`` task groups of near-equal size, rows of a key in as few of them as possible.

    Keys are laid end to end, each as long as its rows; the line is cut into equal groups. A key that lies across cuts is split by the
    hash of ``cols``, in the shares that the cuts give. Rows of a null key are a key of their own, first in the line.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n")).withColumn("_key", F.concat(F.when(F.col(key).isNull(), "0").otherwise("1"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    line = running_total(counts.select("_key", "_n"), "_key", "_n", "_start")
    total = df.count()
    size = max(1, -(-total // groups))
    rows = df.withColumn("_key", F.concat(F.when(F.col(key).isNull(), "0").otherwise("1"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    spot = F.col("_start") + F.floor(F.col("_n") * (row_hash(cols, seed) / F.lit(float(1 << HASH_BITS))))
    return rows.join(line, "_key").withColumn(name, F.floor(spot / size).cast("int")).select(*df.columns, name)


def with_ids(spark: SparkSession, df: DataFrame, start: int, name: str) -> DataFrame:
    """``df`` with dense ids ``start``, ``start + 1``, ... Rows are counted per partition; an id is the partition's
    offset and the row's place in it."""
    from paddock.sources.files import kept
    whole = F.monotonically_increasing_id()
    placed = kept(spark, df.select("*", F.shiftright(whole, PLACE_BITS).alias("_part"), whole.bitwiseAND((1 << PLACE_BITS) - 1).alias("_place")), "numbered", must=True)
    prior = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_offset"))
    number = (F.lit(start) + F.col("_offset") + F.col("_place")).cast("long")
    return placed.join(offset, "_part").select(number.alias(name), *df.columns)
