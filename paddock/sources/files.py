"""Sources and sinks (S1-S8, S13) and the table load (dedup, quarantine, layout).

One parallel scan replaces the per-file worker pool of the reference: a
directory of parquet files is read as one DataFrame and Spark splits it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.functions.timefn import parse_iso_utc
from paddock.operators.clean import dedup_first, quarantine
from paddock.sources.tables import Tables

# Fixed value: file names carry the telemetry keys like
# ``session_key=9998&driver_number=30.parquet``.
PATH_KEYS_PATTERN = r"session_key=(\d+)&driver_number=(\d+)"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               drop: Sequence[str] = (), skip_corrupt_files: bool = False) -> DataFrame:
    """Read one parquet file or a directory of them (one scan, split by Spark).

    With ``schema`` the read is typed and column-pruned by the schema; columns in ``drop``
    (``schemas.dropped_on_load`` of the table) are removed if present (C1/C2).
    ``skip_corrupt_files`` lets a directory load go on past unreadable files (C15), as the
    per-file loader did; ``unread_files`` names them.
    """
    reader = spark.read
    if skip_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path).drop(*drop)


def unread_files(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The files under ``path`` that gave ``df`` no row, because they can't be read or are empty (``path``)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    read = df.select(F.col("_metadata.file_path").alias("path")).distinct()
    return found.select("path").join(read, "path", "left_anti")


def keys_from_path(path_col: Column, pattern: str = PATH_KEYS_PATTERN,
                   names: Sequence[str] = ("session_key", "driver_number"),
                   types: Sequence[str] | None = None) -> list[Column]:
    """Key columns parsed from a file path with regex groups (null when absent)."""
    types = list(types or ["int"] * len(names))
    out = []
    for i, (n, t) in enumerate(zip(names, types), start=1):
        v = F.regexp_extract(path_col, pattern, i)
        out.append(F.when(v != "", v.cast(t)).alias(n))
    return out


def read_with_path_keys(spark: SparkSession, path: str, schema: T.StructType | None = None,
                        pattern: str = PATH_KEYS_PATTERN,
                        names: Sequence[str] = ("session_key", "driver_number")) -> DataFrame:
    """Read a directory and fill missing keys from each row's file name."""
    df = read_table(spark, path, schema)
    keys = keys_from_path(F.col("_metadata.file_path"), pattern, names)
    cols = []
    for k, c in zip(names, keys):
        cols.append(F.coalesce(F.col(k), c).alias(k) if k in df.columns else c)
    rest = [c for c in df.columns if c not in names]
    return df.select(*cols, *rest)


def land_json(spark: SparkSession, json_path: str, schema: T.StructType, out_path: str,
              mode: str = "overwrite", json_lines: bool = False) -> None:
    """JSON records as fetched from the API -> typed parquet.

    By default each file is one JSON document (an array of records, as the API
    returns them); ``json_lines=True`` reads one record per line instead.
    """
    (spark.read.schema(schema).option("multiLine", not json_lines).json(json_path)
     .write.mode(mode).parquet(out_path))


def append_table(df: DataFrame, table: str, database: str | None = None) -> None:
    """Append to a catalog table (``to_sql(if_exists='append')``)."""
    name = f"{database}.{table}" if database else table
    df.write.mode("append").saveAsTable(name)


def create_tables(spark: SparkSession, database: str, location: str | None = None,
                  tables: Mapping[str, T.StructType] = schemas.SCHEMAS) -> None:
    """Create the schema and the tables, replacing older ones (children first)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for name in reversed(list(tables)):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    for name, schema in tables.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {database}.{name} ({cols}) USING parquet")


def analyze_tables(spark: SparkSession, database: str, tables: Sequence[str] | None = None) -> None:
    """Table and column statistics for the catalog tables (the reference's ``ANALYZE``),
    so static planning sees real sizes; AQE still re-plans with run-time sizes."""
    present = {t.name for t in spark.catalog.listTables(database)}
    for name in tables or [n for n in schemas.SCHEMAS if n in present]:
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR ALL COLUMNS")


def materialize(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet under the shared ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a point every later job can restart from (a lost executor
    never recomputes what came before), unlike ``localCheckpoint``. Each call
    writes a new folder, so nothing that is being read is overwritten.
    """
    import uuid

    from paddock.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}/{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def kept(spark: SparkSession, df: DataFrame, name: str, must: bool = False) -> DataFrame:
    """``df`` materialized in the shared folder; in one made for it where a single-process session names none. On a cluster
    without a shared folder ``df`` is returned as it is, or is refused if its rows must stay as they are (``must``)."""
    import tempfile

    from paddock import session
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared and spark.sparkContext.master.split("[")[0] == "local" and spark.sparkContext.applicationId not in session._FALLBACK:
        session.checkpoint_dir(spark, tempfile.mkdtemp(prefix="paddock-"))
    if shared or must or spark.sparkContext.applicationId in session._FALLBACK:
        return materialize(spark, df, name)
    return df


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """SQL text over registered views -> DataFrame (lazy)."""
    return spark.sql(text)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def write_layout(df: DataFrame, path: str, lead: str = "session_key",
                 sort: Sequence[str] = ("driver_number", "date"), mode: str = "overwrite") -> None:
    """Physical layout by a leading key, time-ordered inside files.

    Partition directories by ``lead`` turn a session filter into a partition
    filter; sorting inside files keeps parquet row-group min/max tight so a
    driver/time filter skips row groups (what an index did in the reference).
    """
    (ranged(df, [lead, *sort]).write.mode(mode).partitionBy(lead).parquet(path))


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows dealt by ranges of ``order`` and sorted within each: a lead key that holds much of the
    data spans many tasks and files, each with its own range of the other columns."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


#: The column in which ``differing`` names a value that doesn't fit the schema.
BAD = "_bad"

#: Metadata of a column that the loaded files don't have.
ABSENT = {"absent": True}


def converted(c: Column, kind: T.DataType, to: T.DataType) -> Column:
    """``c`` as the schema's type, null where it doesn't fit (C12: ISO text with an offset moves to UTC)."""
    if isinstance(to, (T.TimestampNTZType, T.TimestampType)) and isinstance(kind, T.StringType):
        return parse_iso_utc(c).cast(to)
    out = c.try_cast(to)
    if isinstance(to, T.IntegralType) and isinstance(kind, (T.FractionalType, T.DecimalType)):
        # NaN is what a whole number with gaps looks like in a data frame of doubles: null, as try_cast has it
        return F.when(out == c, out)
    return out


def conform(df: DataFrame, table: str, order: Sequence[Column] | None = None,
            on_duplicate: str = "first") -> tuple[DataFrame, DataFrame]:
    """Cast to the table schema, enforce the primary key, quarantine bad rows.

    A row is bad when a key column is null or a value does not cast. Rows sharing a
    key are ordered by ``order`` (default: the other columns). ISO text becomes UTC where the schema has
    a time; a fraction where it has a whole number is a bad value. Columns that ``df`` doesn't have are null, and
    marked as absent in the field's metadata. With
    ``on_duplicate="first"`` the first is kept and the rest dropped, with
    ``"quarantine"`` the rest go to the bad rows as ``duplicate key``. Returns
    ``(good, bad)``; bad rows carry ``_reason``.
    """
    schema = schemas.SCHEMAS[table]
    keys = list(schemas.PRIMARY_KEYS[table])
    have = set(df.columns)
    casts, rules = [], {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name in have:
            value = converted(F.col(f.name), kinds[f.name], f.dataType)
            casts.append(value.alias(f.name))
            rules[f"bad {f.name}"] = F.col(f.name).isNotNull() & value.isNull()
            if BAD in have:  # a value that didn't fit when its file was read
                rules[f"bad {f.name}"] |= F.coalesce(F.col(BAD) == f"bad {f.name}", F.lit(False))
        else:
            casts.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=ABSENT))
    for k in keys:
        rules[f"null {k}"] = F.col(k).isNull()
    good, bad = quarantine(df, rules)
    extra = [c for c in good.columns if c not in schema.fieldNames() and c != BAD]
    good = good.select(*casts, *extra)
    order = list(order) if order is not None else [F.col(c).asc_nulls_last() for c in schema.fieldNames()
                                                   if c not in keys and c in have]
    order = order or [F.col(k) for k in keys]  # only key columns: duplicates are identical rows
    if on_duplicate == "first":
        return dedup_first(good, keys, order).drop(*extra), bad
    if on_duplicate == "quarantine":
        w = Window.partitionBy(*keys).orderBy(*order)
        ranked = good.withColumn("_dup", F.row_number().over(w) > 1)
        dups = ranked.where("_dup").drop("_dup", *extra).withColumn("_reason", F.lit("duplicate key"))
        bad = bad.drop(*[c for c in extra if c in bad.columns]).unionByName(dups, allowMissingColumns=True)
        return ranked.where(~F.col("_dup")).drop("_dup", *extra), bad
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def load_tables(spark: SparkSession, paths: Mapping[str, str]) -> tuple[Tables, dict[str, DataFrame]]:
    """Read, conform and dedup every table given by ``paths`` (name -> file or directory).

    Returns the clean ``Tables`` (lazy) and the quarantined rows per table.
    """
    clean, bad = {}, {}
    for name, path in paths.items():
        g, b = conform(read_table(spark, path, drop=schemas.dropped_on_load(name)), name)
        clean[name], bad[name] = g, b
    return Tables(**clean), bad
