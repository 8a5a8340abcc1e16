"""Appends under the table's keys (S5, C13, C14): what the reference's key constraints refuse is rejected row by row.

A batch is checked against itself, against the rows there and against the parents by joins on the keys alone, and appended once per
batch number: a batch that is run again adds nothing, whether it had ended or not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.sources.files import kept

Parent = tuple[Sequence[str], DataFrame, Sequence[str]]


def checked(df: DataFrame, there: DataFrame | None, keys: Sequence[str], parents: Sequence[Parent] = (), order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows that may be appended, rejected rows with ``_reason``).

    The first row of a key by ``order`` (default: the other columns) counts, the others are ``repeated key``; then ``null key``,
    ``key exists`` and ``no parent``, in this order. A null in a foreign key exempts the row, as in SQL.
    """
    keys = list(keys)
    columns = df.columns
    order = list(order) or [c for c in columns if c not in keys] or keys
    nulls = F.lit(False)
    for k in keys:
        nulls = nulls | F.col(k).isNull()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    rows = df.withColumn("_null", nulls).withColumn("_place", place)
    if there is not None:
        rows = rows.join(there.select(*keys).distinct().withColumn("_there", F.lit(True)), keys, "left")
    else:
        rows = rows.withColumn("_there", F.lit(None).cast("boolean"))
    orphan = F.lit(False)
    for i, (child, parent, named) in enumerate(parents):
        known = parent.select(*[F.col(p).alias(f"_p{i}_{c}") for p, c in zip(named, child, strict=True)]).distinct().withColumn(f"_known{i}", F.lit(True))
        on, exempt = F.lit(True), F.lit(False)
        for c in child:
            on, exempt = on & (F.col(c) == F.col(f"_p{i}_{c}")), exempt | F.col(c).isNull()
        rows = rows.join(known, on, "left")
        orphan = orphan | (F.col(f"_known{i}").isNull() & ~exempt)
    reason = (F.when(F.col("_null"), "null key").when(F.col("_place") > 1, "repeated key").when(F.col("_there"), "key exists").when(orphan, "no parent"))
    rows = rows.select(*columns, reason.alias("_reason"))
    return rows.where("_reason is null").select(*columns), rows.where("_reason is not null")


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_once(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], batch: int, parents: Sequence[Parent] = ()) -> DataFrame:
    """Append the rows of ``df`` that the keys allow to the table at ``path``; returns the rejected ones.

    The ledger of batch numbers (``<path>_batches``) is written after the rows. A batch in the ledger is not run again and
    rejects nothing; one that ended between rows and ledger finds its keys there.
    """
    ledger = _read(spark, f"{path}_batches", "batch long")
    if ledger is not None and not ledger.where(F.col("batch") == batch).isEmpty():
        return df.limit(0).withColumn("_reason", F.lit(None).cast("string"))
    there = _read(spark, path, df.schema)
    good, rejected = checked(df, there, keys, parents)
    rejected = kept(spark, rejected, "rejected")
    good.write.mode("append").parquet(path)
    spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("append").parquet(f"{path}_batches")
    return rejected
