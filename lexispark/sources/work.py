"""Tables that jobs keep between their steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch that goes to a task's Python.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of the session are bounded by bytes, as rows of long texts fill many times as much as others."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables that queries keep: under spark.checkpoint.dir, a temporary one in a single local process only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared}/{name}-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix=f"lexispark-{name}-")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in a new work folder: computed once, and read again if a task is lost."""
    path = f"{work_folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
