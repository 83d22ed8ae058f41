"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The bytes that separate words: space and \x09-\x0D (what bytes.split() splits on).
SPACES = b" \t\n\x0b\x0c\r"
#: The same set as a regular-expression class body for Spark's and Java's engine.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.
    Only a local session without the setting gets a scratch folder of its own."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="promptwatt-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, which cuts
    its lineage and survives the loss of any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(ends: np.ndarray, begin: int, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes together, or one row."""
    k = 0
    while k < len(ends):
        stop = max(k + 1, int(np.searchsorted(ends, begin + limit, side="right")))
        yield k, stop
        begin, k = int(ends[stop - 1]), stop
