"""Landing JSON records that drift (S3, F11): one bad record costs one row, and a landed file isn't landed again.

Records come one per line, or as documents that are arrays of records. Each is kept as text until it is parsed against the schema; what
doesn't parse is rejected with its text, fields that the schema doesn't know are reported, and the files landed
are written to a ledger beside the table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.sources.files import kept

CORRUPT = "_corrupt_record"


def records(spark: SparkSession, paths: list[str], json_lines: bool) -> DataFrame:
    """path and value (a record's text) of every record; a document that is no array of records is one record."""
    text = spark.read.option("wholetext", str(not json_lines).lower()).text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    if json_lines:
        return text.where(F.trim("value") != "")
    whole = F.from_json("value", "array<string>", {"mode": "PERMISSIVE"})
    return text.select("path", F.explode(F.coalesce(F.when(F.ltrim("value").startswith("["), whole), F.array("value"))).alias("value"))


def parsed(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of the schema, rejected records: path, value, _reason; unknown fields: path, field, n)."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = rows.withColumn("_r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    good = rows.where(~bad).select(*[F.col(f"_r.{f.name}") for f in schema.fields])
    rejected = rows.where(bad).select("path", "value", F.lit("does not fit the schema").alias("_reason"))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    unknown = (rows.where(~bad).select("path", F.explode(F.array_except(F.json_object_keys("value"), known)).alias("field"))
               .groupBy("path", "field").agg(F.count("*").alias("n")))
    return good, rejected, unknown


def land_records(spark: SparkSession, source: str, schema: T.StructType, out_path: str, json_lines: bool = True) -> tuple[DataFrame, DataFrame]:
    """Append the records of the files under ``source`` that haven't been landed to the table at ``out_path``. Returns the rejected
    records and the unknown fields. The ledger (``<out_path>_files``) is written last: a landing that broke off before
    is done again, so a reader that must not see rows twice checks their keys (``append.checked``)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path")
    try:
        files = files.join(spark.read.schema("path string").parquet(f"{out_path}_files"), "path", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new = [r["path"] for r in files.collect()]
    if not new:
        none = spark.createDataFrame([], "path string, value string, _reason string")
        return none, spark.createDataFrame([], "path string, field string, n long")
    good, rejected, unknown = parsed(records(spark, new, json_lines), schema)
    good.write.mode("append").parquet(out_path)
    rejected, unknown = kept(spark, rejected, "rejected-records"), kept(spark, unknown, "unknown-fields")
    spark.createDataFrame([(p,) for p in new], "path string").coalesce(1).write.mode("append").parquet(f"{out_path}_files")
    return rejected, unknown
