"""A directory whose files differ (S2, C15): other column types, missing columns, files that can't be read.

The footers of all files are read in one distributed job (only the footers, where the tasks can open the path themselves;
else the file's bytes by Spark's reader). Files whose common columns agree in type are one scan, with missing
columns as nulls; each further combination of types is a scan of its own. Where there are several, the columns that the table's schema
knows become its types in each scan, and a value that doesn't fit is named in ``_bad``, for the load to
quarantine. Files that aren't parquet are returned as rows of path and error.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.operators.clean import to_bool
from paddock.sources.files import BAD, converted

FILES_PER_TASK = 200


def _types(source) -> str:
    import pyarrow.parquet as pq
    return json.dumps([[f.name, str(f.type)] for f in pq.read_schema(source)])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, types, error; neither types nor error where the path can't be opened from here."""
    from pyarrow import fs
    for batch in batches:
        out = []
        for path in batch.column("path").to_pylist():
            types = error = None
            scheme, _, rest = path.partition(":")
            try:
                files, name = fs.FileSystem.from_uri(f"{scheme}://{quote('/' + rest.lstrip('/') if scheme == 'file' else rest[2:], safe='/:@=&')}")
                file = files.open_input_file(name)
            except (OSError, pa.ArrowException, ValueError):
                file = None
            if file is not None:
                with file:
                    try:
                        types = _types(file)
                    except (OSError, pa.ArrowException) as e:
                        error = str(e).splitlines()[0][:200]
            out.append((path, types, error))
        path, types, error = zip(*out, strict=True) if out else ((), (), ())
        yield pa.record_batch([pa.array(path, pa.string()), pa.array(types, pa.string()), pa.array(error, pa.string())], names=["path", "types", "error"])


def _footers_of_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            types = error = None
            try:
                types = _types(pa.BufferReader(content.as_buffer()))
            except (OSError, pa.ArrowException) as e:
                error = str(e).splitlines()[0][:200]
            yield pa.record_batch([pa.array([path]), pa.array([types], pa.string()), pa.array([error], pa.string())], names=["path", "types", "error"])


def footers(spark: SparkSession, path: str) -> list:
    """path, types (column names and types as JSON) and error of every file under ``path``; the driver holds a row for each
    file, as it does for every scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = files.select("path")
    tasks = max(1, min(listed.count() // FILES_PER_TASK + spark.sparkContext.defaultParallelism, 10_000))
    found = listed.repartition(tasks, "path").mapInArrow(_footers, "path string, types string, error string").collect()
    closed = [(r["path"],) for r in found if r["types"] is None and r["error"] is None]
    if not closed:
        return found
    some = files.select("path", "content").join(spark.createDataFrame(closed, "path string"), "path", "left_semi")
    return [r for r in found if (r["path"],) not in set(closed)] + some.mapInArrow(_footers_of_bytes, "path string, types string, error string").collect()


def _groups(spark: SparkSession, rows: list) -> list[tuple[dict[str, T.StructField], list[str]]]:
    """Files by combination of types: the columns, and the paths."""
    by_types: dict[str, list[str]] = {}
    for r in rows:
        by_types.setdefault(r["types"], []).append(r["path"])
    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for paths in sorted(by_types.values(), key=len, reverse=True):
        columns = {f.name: f for f in spark.read.parquet(paths[0]).schema.fields}
        for known, members in groups:
            if all(known[c].dataType == f.dataType for c, f in columns.items() if c in known):
                known.update({c: f for c, f in columns.items() if c not in known})
                members += paths
                break
        else:
            groups.append((columns, list(paths)))
    return groups


def _settled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that the schema knows in its types; ``_bad`` names the first value that doesn't fit."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    bad, out = F.lit(None).cast("string"), []
    for f in reversed(schema.fields):
        if f.name in kinds and kinds[f.name] != f.dataType:
            given = F.col(f.name)
            if isinstance(f.dataType, T.BooleanType) and isinstance(kinds[f.name], T.NumericType):
                value = to_bool(f.name)
            else:
                value = converted(given, kinds[f.name], f.dataType)
                bad = F.when(given.isNotNull() & value.isNull() & ~_nan(given, kinds[f.name]), F.lit(f"bad {f.name}")).otherwise(bad)
            out.append((f.name, value))
    return df.withColumns({**dict(out), BAD: bad})


def _nan(c, kind: T.DataType):
    """A gap in a column of whole numbers, as a data frame of doubles writes it."""
    return F.isnan(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.lit(False)


def read_differing(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """All rows under ``path`` with their file (``_file``) and place in it (``_row``), and the files that can't be read (path, error).

    Rows have ``_bad`` if files disagree in the types of their columns.
    """
    found = footers(spark, path)
    errors = [(r["path"], r["error"]) for r in found if r["error"] is not None]
    unreadable = spark.createDataFrame(errors, "path string, error string")
    groups = _groups(spark, [r for r in found if r["types"] is not None])
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    if not groups:
        empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())]))
        return empty, unreadable
    whole = len(groups) == 1 and not errors

    def scan(columns: dict[str, T.StructField], paths: list[str]) -> DataFrame:
        reader = spark.read.schema(T.StructType(list(columns.values())))
        return (reader.parquet(path) if whole else reader.option("basePath", path).parquet(*paths)).select("*", *place)

    scans = [scan(*g) for g in groups]
    if len(scans) == 1:
        return scans[0], unreadable
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_widened(scans, s, schema) for s in scans]), unreadable


def _widened(scans: list[DataFrame], scan: DataFrame, schema: T.StructType) -> DataFrame:
    """A scan settled; columns that the schema doesn't know become text where scans disagree on them."""
    known = set(schema.fieldNames())
    kinds: dict[str, set] = {}
    for s in scans:
        for f in s.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    odd = [c for c in scan.columns if c not in known and len(kinds[c]) > 1]
    return _settled(scan.withColumns({c: F.col(c).cast("string") for c in odd}), schema)
