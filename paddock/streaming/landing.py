"""Incremental load of a landing folder of parquet files (S2 + C5 + C15 + S5, streamed).

New files in ``src_dir`` are picked up by a file-source stream, conformed to
the table schema (bad rows go to a quarantine folder with a reason), reduced to
one row per primary key, and appended to the partitioned target only for keys
the target does not hold yet: the primary key of the table is enforced across
batches. Re-running a batch after a failure appends nothing twice, since its
keys are already in the target. The stream's checkpoint lives under the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paddock import schemas
from paddock.operators.joins import anti, semi
from paddock.session import checkpoint_dir
from paddock.sources.files import conform


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The target's rows; None only if nothing has been written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def load_stream(spark: SparkSession, src_dir: str, table: str, target: str, quarantine: str | None = None,
                lead: str = "session_key", checkpoint: str | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Start the incremental load; with ``available_now`` it processes what is there and stops."""
    keys = list(schemas.PRIMARY_KEYS[table])
    stream = spark.readStream.schema(schemas.SCHEMAS[table]).parquet(src_dir)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "landing", table)

    def batch(df: DataFrame, epoch_id: int) -> None:
        df = df.persist()  # read by the quarantine, the key lookup and the append
        good, bad = conform(df, table)
        if quarantine:
            bad.write.mode("append").parquet(quarantine)
        have = _existing(df.sparkSession, target)
        if have is not None:
            # Only the target partitions this batch touches: the join on the lead key prunes them.
            have = semi(have, good.select(lead).distinct(), [lead]).select(*keys)
        new = good if have is None else anti(good, have, keys)
        new.write.mode("append").partitionBy(lead).parquet(target)
        df.unpersist()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
