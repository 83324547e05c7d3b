"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handed to numpy at a time, in bytes; bounds a Python worker's memory.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="reviewmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch whose texts (null: empty) take about limit bytes together; a longer text comes alone."""
    texts = [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield batch.slice(start, i - start), texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def lower_ascii(c):
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
