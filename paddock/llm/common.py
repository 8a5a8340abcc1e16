"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only when its counted rows are at most this many.
BROADCAST_ROWS = 100_000
# Copies of a small side that a salted join spreads a hot key over, beyond that bound.
SALTS = 32

# Rows of an Arrow batch: texts are large.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set[str] = set()
_SHARED: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temporary one only where it is unset in a single-process session."""
    app = spark.sparkContext.applicationId
    if app not in _SHARED:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            path = tempfile.mkdtemp(prefix="paddock-")
        _SHARED[app] = path.rstrip("/")
    return _SHARED[app]


def written(spark: SparkSession, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, and keep Arrow batches of texts small.

    A batch of 10,000 rows, Spark's default, can hold gigabytes of long texts in the JVM and in Python;
    a session that asks for another size keeps it.
    """
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="paddock-ship-"), "paddock_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "paddock")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def join_small(big: DataFrame, small: DataFrame, key: str, rows: int, how: str = "left") -> DataFrame:
    """Join with one row per key on the small side.

    Broadcast up to ``BROADCAST_ROWS`` counted rows. Beyond, the small side is repeated over
    ``SALTS`` salts, so that no key of the big side lands in one task.
    """
    if rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), key, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (big.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
            .join(salted, [key, "_salt"], how).drop("_salt"))


def n_words(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")
