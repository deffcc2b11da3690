"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is absent a temporary folder is made and set if Spark runs on this machine alone (tests);
    elsewhere that would not be seen by the executors, so it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            found = jvm_dir.get()
        elif spark.sparkContext.master.startswith("local["):
            found = tempfile.mkdtemp(prefix="spark-shared-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


class Scratch:
    """Tables in a new folder below the shared one. Writing a table and reading it again cuts lineage: a lost
    executor costs a re-read instead of a recomputation. Tables that nothing reads any more are dropped."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{len(self.paths)}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.keep = [*getattr(self, "keep", []), out]  # ids stay unique while tables live
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, self.paths[id(t)])

    def drop_all_but(self, *tables: DataFrame) -> None:
        self.drop(*(t for t in self.keep if not any(t is x for x in tables)))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back. The folder's owner clears it."""
    return Scratch(df.sparkSession, label).put(df, "table")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed for them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def chunks(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into slices of about ``most_bytes`` of ``column`` each (one row at least),
    so that what a task holds does not depend on the length of the rows around it."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def release() -> None:
    """Give back to the system what this Python worker has freed. Workers go on from stage to stage, and what one
    stage's arrays took would else count beside the tables of the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and ``release`` when a task is through."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return through


def text_or_empty(column: str = "text"):
    """The whole text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))
