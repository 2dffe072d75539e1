"""Written intermediate tables, row numbers and gapless ranks."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.running import running_totals
from ..session import scratch_root


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


# Texts are long, so fewer rows than Spark's default travel to a Python worker at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_BATCH, TEXT_BATCH = "10000", "2000"


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and send
    them small batches, unless the session sets a size of its own.

    On a cluster whose machines lack that folder, pass the package by --py-files.
    """
    if spark.conf.get(BATCH_ROWS) == DEFAULT_BATCH:
        spark.conf.set(BATCH_ROWS, TEXT_BATCH)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])


class Scratch:
    """Tables of one operator call, in the folder that all executors share.

    A written table cuts the lineage: losing an executor costs a re-read. Tables
    that the result still reads stay until the folder is emptied with the
    application; all others are dropped as soon as they are no longer needed.
    """

    def __init__(self, spark: SparkSession, label: str):
        workers_find_package(spark)
        self.spark = spark
        self.folder = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def written(self, name: str, schema: str) -> DataFrame:
        """The tables that were put below ``name``, as one; empty without any."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("recursiveFileLookup", True)
        return read.parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def packed_batch(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed value, which travels as a row's column."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked_batch(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed).read_next_batch()


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_rows(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and text alone, so that no other column of the input can clash.

    A null text becomes the empty one.
    """
    return df.select(
        F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def gapless_ranks(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """Add ``rank``, counting from 0 within each key in the given order.

    ``order`` must end in a unique row number. The rows are cut into even slices
    along (keys, order), so a key that holds most rows is spread over slices.
    """
    ranked = running_totals(df, keys, order, {"rank": F.lit(1)}, label)
    return ranked.withColumn("rank", F.col("rank_running") - 1).drop(
        "rank_running", "rank_before", "slice"
    )
