"""Exact quantiles of groups of any size by radix selection.

``percentile`` keeps a count for every distinct value of a group in one task. Here values become longs in the same order, and the
two ranks that a quantile lies between are found digit by digit: counts by the next 16 bits, of the
values that share the bits found so far. A task holds counts of 65,536 digits at most, however many values a group has, and counts are
combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.sources.files import kept

DIGIT = 16
SIGN = 1 << 63
BROADCAST_TARGETS = 100_000


def _ordered(x: Column) -> Column:
    """A long in the order of the doubles (NaN last, as ``percentile`` has it)."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(x.cast("double"), F.lit(0.0)) + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(SIGN - 1)))


def _double(k: Column) -> Column:
    bits = F.when(k >= 0, k).otherwise(k.bitwiseXOR(F.lit(SIGN - 1)))
    return F.reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def radix_quantiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float]) -> DataFrame:
    """keys, then ``q_0``, ``q_1``, ...: for each group the quantiles ``ps`` of ``value`` with linear interpolation, as
    ``percentile`` gives them. Nulls don't count; a group without values has null quantiles."""
    keys, spark = list(keys), df.sparkSession
    named = {k: f"_k{i}" for i, k in enumerate(keys)}           # keys that may be null, as a struct
    rows = df.select(F.struct(*[F.col(k).alias(named[k]) for k in keys]).alias("_g"), _ordered(F.col(value)).alias("_v"), F.col(value).isNotNull().alias("_is"))
    rows = kept(spark, rows, "radix-values")
    groups = rows.groupBy("_g").agg(F.count_if("_is").alias("_n"))
    rows = rows.where("_is").select("_g", "_v")
    h = F.transform(F.array(*[F.lit(float(p)) for p in ps]), lambda p: (F.col("_n") - 1) * p)
    ranks = F.array_distinct(F.concat(F.transform(h, lambda x: F.floor(x).cast("long")), F.transform(h, lambda x: F.ceil(x).cast("long"))))
    few = groups.count() * 2 * len(ps) <= BROADCAST_TARGETS
    # rank: place among the values that share the bits found so far
    targets = groups.where("_n > 0").select("_g", F.explode(ranks).alias("_rank")).select("_g", F.col("_rank"), F.col("_rank").alias("_left"), F.lit(0).cast("long").alias("_found"))
    for shift in range(64 - DIGIT, -1, -DIGIT):
        digit = F.shiftright("_v", shift) if shift == 64 - DIGIT else F.shiftright("_v", shift).bitwiseAND((1 << DIGIT) - 1)
        above = F.lit(0).cast("long") if shift == 64 - DIGIT else F.shiftright("_v", shift + DIGIT)
        wanted = targets.select("_g", "_found").distinct()
        digits = rows.select("_g", above.alias("_found"), digit.alias("_d"))
        if few:
            digits = digits.join(F.broadcast(wanted), ["_g", "_found"], "left_semi")
        counts = digits.groupBy("_g", "_found", "_d").agg(F.count("*").alias("_c"))
        if not few:  # after the counts are combined, so that no group is joined row by row
            counts = counts.join(wanted, ["_g", "_found"], "left_semi")
        upto = F.sum("_c").over(Window.partitionBy("_g", "_found").orderBy("_d"))
        counts = counts.select("_g", "_found", "_d", "_c", upto.alias("_upto"))
        met = targets.join(counts, ["_g", "_found"]).where((F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_c")))
        found = F.col("_d") if shift == 64 - DIGIT else F.shiftleft("_found", DIGIT).bitwiseOR(F.col("_d"))
        targets = kept(spark, met.select("_g", "_rank", (F.col("_left") - F.col("_upto") + F.col("_c")).alias("_left"), found.alias("_found")), "radix-targets")
    at = targets.select("_g", "_rank", _double(F.col("_found")).alias("_x")).groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))
    out = groups.join(at, "_g", "left")
    quantiles = []
    for i, p in enumerate(ps):
        place = (F.col("_n") - 1) * F.lit(float(p))
        a, b = F.try_element_at("_at", F.floor(place).cast("long")), F.try_element_at("_at", F.ceil(place).cast("long"))
        part = place - F.floor(place)
        quantiles.append(F.when(part == 0, a).otherwise((F.ceil(place) - place) * a + part * b).alias(f"q_{i}"))
    return out.select(*[F.col("_g")[named[k]].alias(k) for k in keys], *quantiles)
