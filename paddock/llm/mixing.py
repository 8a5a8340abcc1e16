"""Mixing sources to target weights by hash-threshold histograms. DataFrame operations only.

A document's size is its number of words. Sources, ordered by code point with null last, get weights
from a repeating cycle. All targets together are all sizes; a target stops at ``MAX_REPEATS`` times
its source's size and the excess is shared again by weight until no target is above its stop.

Within a source every document is taken the whole number of times its target holds the source's
size, and the rest of the target goes once more to the documents with the smallest hashes: the
thresholds of the budgets are nested. The threshold is found without sorting the documents: sizes
are summed by (source, hash bucket); the bucket that the budget ends in is refined by the next
hash bits, and only the few hashes of that last bucket are put in order. Documents are then filtered
by their hash alone, so reruns agree. The hash covers doc_id and text; rows that agree in both are
taken alike.

Nulls: a null text has size 0, a null source is a source of its own, a null doc_id counts by its text.
A document of size 0 takes 0 words. The document a budget ends in is taken if that brings the source
nearer to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.llm.common import join_small, n_words, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
LEVEL_BITS = 12          # hash bits of a histogram level
HASH_BITS = 60


def _source_key() -> Column:
    """Never null, distinct for a null source, and in the order of code points with null last."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))


def _hash() -> Column:
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _ranked(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """Sources with their place in the order. Ranges of sources are ranked apart and shifted by what precedes
    them: one row per range is all that meets in one task."""
    parts = written(spark, sources.repartitionByRange(8, "key").withColumn("part", F.spark_partition_id()), "mix-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    return parts.join(shift, "part").select("key", "source_size", (F.col("shift") + within - 1).alias("place"))


def targets(spark: SparkSession, digest: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, int]:
    """key, source_size, target for each source, and the number of sources. ``digest`` has key and size.

    ``level`` is the target of a source of weight 1 that isn't stopped: each round it is worked out
    anew from the sources below their stop, one row reaching the driver, until no other source stops.
    """
    sizes = digest.groupBy("key").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = written(spark, _ranked(spark, sizes).withColumn(
        "weight", F.get(cycle, F.pmod("place", F.lit(len(weights))).cast("int"))), "mix-sources")
    stop = F.lit(max_repeats) * F.col("source_size")
    n, level, stopped = per.count(), 0.0, -1
    while n:
        above = stop <= F.col("weight") * F.lit(level)
        row = per.agg(F.sum("source_size").alias("all"), F.sum(F.when(above, stop)).alias("held"),
                      F.sum(F.when(~above, F.col("weight"))).alias("open"), F.count(F.when(above, 1)).alias("n")).first()
        if row["n"] == stopped or not row["open"]:
            break
        stopped, level = row["n"], ((row["all"] or 0) - (row["held"] or 0)) / row["open"]
    target = F.least(stop.cast("double"), F.col("weight") * F.lit(level))
    return per.select("key", "source_size", target.alias("target")), n


def _boundary(digest: DataFrame, budgets: DataFrame, n: int, level: int) -> DataFrame:
    """Per source the hash bucket of this level that the budget ends in, and the budget left for it.

    ``budgets`` has key, prefix (the hash bits settled so far) and left; sources whose budget holds all that is
    there are absent from the result.
    """
    settled, shift = LEVEL_BITS * level, HASH_BITS - LEVEL_BITS * (level + 1)
    rows = digest
    if level:
        rows = join_small(digest, budgets.select("key", "prefix"), "key", n, "inner").filter(
            F.shiftright("h", HASH_BITS - settled) == F.col("prefix"))
    sums = rows.groupBy("key", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("key").orderBy("bucket"))
    found = (sums.withColumn("upto", upto).join(budgets.select("key", "left"), "key")
             .filter((F.col("upto") - F.col("size") <= F.col("left")) & (F.col("upto") > F.col("left"))))
    return found.select("key", F.col("bucket").alias("prefix"), (F.col("left") - F.col("upto") + F.col("size")).alias("left"))


def _plan(spark: SparkSession, docs: DataFrame, weights: tuple, max_repeats: int) -> tuple[DataFrame, DataFrame, int]:
    """The documents' digest (doc_id, source, key, size, h), the sources' thresholds, and the number of sources."""
    digest = written(spark, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", _source_key().alias("key"), n_words(F.col("text"), WORD).alias("size"), _hash().alias("h")), "mix-digest")
    per, n = targets(spark, digest, weights, max_repeats)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    per = per.withColumn("whole", whole.cast("long")).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    budgets = per.select("key", "left").filter("left > 0")
    first = written(spark, _boundary(digest, budgets, n, 0), "mix-bucket")
    last = written(spark, _boundary(digest, first, n, 1), "mix-bucket")
    # the hashes of the last bucket, in order: a 2 ** 24th of a source
    inside = join_small(digest, last, "key", n, "inner").filter(F.shiftright("h", HASH_BITS - 2 * LEVEL_BITS) == F.col("prefix"))
    inside = inside.groupBy("key", "left", "h").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("key").orderBy("h"))
    ends = (inside.withColumn("upto", upto).filter(F.col("upto") - F.col("size") / 2 <= F.col("left"))
            .groupBy("key").agg(F.max("h").alias("upto_h")))
    below = last.select("key", (F.shiftleft("prefix", HASH_BITS - 2 * LEVEL_BITS) - 1).alias("below"))
    # no last bucket: nothing is left of the budget
    thresholds = (per.join(below, "key", "left").join(ends, "key", "left")
                  .select("key", "source_size", "target", "whole", F.coalesce("upto_h", "below", F.lit(-1)).alias("threshold")))
    return digest, written(spark, thresholds, "mix-thresholds"), n


def _copies(max_repeats: int) -> Column:
    return F.col("whole") + F.when((F.col("h") <= F.col("threshold")) & (F.col("whole") < max_repeats), 1).otherwise(0)


def mixed(spark: SparkSession, docs: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words, repeats counted) for each row of ``docs``."""
    digest, thresholds, n = _plan(spark, docs, weights, max_repeats)
    out = join_small(digest, thresholds, "key", n).withColumn("copies", _copies(max_repeats))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(spark: SparkSession, docs: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; documents of size 0 carry no words and stay once."""
    _, thresholds, n = _plan(spark, docs, weights, max_repeats)
    row = docs.select(F.struct(*docs.columns).alias("row"), _source_key().alias("key"), _hash().alias("h"), n_words(F.col("text"), WORD).alias("size"))
    copies = F.when(F.col("size") == 0, 1).otherwise(_copies(max_repeats)).cast("int")
    out = join_small(row, thresholds, "key", n).withColumn("copies", copies).filter("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def oracle() -> str:
    """doc_id, size, source_size, target, taken in DuckDB's SQL."""
    weight = " ".join(f"when {i} then {float(w)}" for i, w in enumerate(WEIGHTS))
    digits = HASH_BITS // 4
    return f"""
with digest as (
  select doc_id, coalesce('0' || source, '1') as key, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || '|' || coalesce(text, '')), 1, {digits}))::bigint as h
  from documents),
sizes as (select key, sum(size)::bigint as source_size from digest group by key),
per as (
  select *, {MAX_REPEATS} * source_size as stop, case (row_number() over (order by key) - 1) % {len(WEIGHTS)} {weight} end::double as weight from sizes),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(stop) over (order by stop / weight, key rows between unbounded preceding and 1 preceding), 0))::double
            / sum(weight) over (order by stop / weight, key rows between current row and unbounded following) as level,
         row_number() over (order by stop / weight, key) as place
  from per),
level as (select coalesce(arg_min(level, place) filter (where level <= stop / weight), arg_max(level, place)) as level from levels),
targets as (select key, source_size, least(stop::double, weight * level) as target from per, level),
budgets as (
  select *, case when source_size > 0 then least({MAX_REPEATS}, floor(target / source_size)) else 0 end::bigint as whole,
         target - whole * source_size as rest
  from targets),
by_hash as (select key, h, sum(size) as size from digest group by key, h),
upto as (select key, h, size, sum(size) over (partition by key order by h) as upto from by_hash),
ends as (
  select key, max(h) as threshold from upto join budgets using (key)
  where rest > 0 and size > 0 and upto - size / 2 <= rest group by key)
select doc_id, size, source_size, target,
       size * (whole + case when whole < {MAX_REPEATS} and h <= threshold then 1 else 0 end)::bigint as taken
from digest join budgets using (key) left join ends using (key)"""
