"""What several operators need of a session."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Bytes of an Arrow batch that goes to a task's Python; rows of long texts would fill many times as much.
BATCH_BYTES = 4 << 20
#: Pieces that summed arrays are cut into.
SLICES = 256
PIECES = "place int, part binary"


def ready(spark: SparkSession) -> SparkSession:
    """Make sure that checkpoint() has a folder: the cluster's; where none is set, one of our own in a single local process only.

    Arrow batches are bounded to BATCH_BYTES in the session, so that memory follows neither texts' lengths nor counts of rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lexispark-"))
    return spark


def unused(columns: list[str], name: str) -> str:
    """The name, with underscores after it until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; -1 for a row without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(-1))


def pieces(whole: np.ndarray):
    """An array cut into SLICES pieces, as rows PIECES."""
    size = -(-len(whole) // SLICES)
    parts = [whole[i : i + size].tobytes() for i in range(0, len(whole), size)]
    yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["place", "part"])


def sum_arrays(parts: DataFrame, length: int, dtype=np.int64, into=np.int64) -> np.ndarray:
    """The sum (in ``into``, where larger ones end) of arrays of whole numbers of fixed length, cut by ``pieces`` in the tasks that make them.

    Each piece is summed on its own: a task reads its pieces only, however many arrays there
    are, and the driver gets each piece once.
    """
    size = -(-length // SLICES)

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                piece = np.frombuffer(x.as_py(), dtype)
                if place in totals:
                    totals[place] += piece
                else:
                    totals[place] = piece.astype(np.int64)
        for place, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([np.minimum(total, np.iinfo(into).max).astype(into).tobytes()], pa.binary())], ["place", "part"])

    out = np.zeros(length, into)
    for row in parts.repartition("place").mapInArrow(add, PIECES).collect():
        total = np.frombuffer(row.part, into)
        out[row.place * size : row.place * size + len(total)] = total
    return out


def labelled_sample(labelled: DataFrame, size: int, *strata: str) -> DataFrame:
    """At most ``size`` rows of each stratum, always the same: those of the smallest hashes of doc_id.

    The rows of each stratum are counted first. Only rows under a hash that lets about twice
    ``size`` of a stratum pass are put in order, so no task meets more of one however many
    rows there are. The counts have a row for each stratum, of which the models hold one each.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    kept = labelled.withColumns({"__place": place, "__all": F.lit(0)})
    counts = kept.groupBy("__all", *strata).agg((F.lit((2.0 * size + 100) * (1 << 40)) / F.count("*")).alias("__limit"))
    near = kept.join(F.broadcast(counts), ["__all", *strata]).where(F.col("__place") < F.col("__limit"))
    order = Window.partitionBy("__all", *strata).orderBy("__place", "doc_id")
    return near.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= size).select(*labelled.columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared checkpoint folder: smaller than checkpoint(), which does not compress."""
    context = ready(df.sparkSession).sparkContext
    path = f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
