"""Session and table helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "promptwatt") -> SparkSession:
    """Local session for tests and the benchmark (UI off, AQE on, UTC)."""
    spark = (SparkSession.builder.master(master).appName(app_name)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is a shared folder set by the operator; only when it
    is unset (local tests) do we pick a scratch folder of our own.
    """
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="promptwatt-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at runtime
            pass
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """df written as Parquet in the shared checkpoint folder and read back: its
    lineage ends there, and no executor's loss takes it away."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_CONF = "promptwatt.scan.partitions"


def spread(df: DataFrame) -> DataFrame:
    """The scan as it is, split by ``spark.sql.files.maxPartitionBytes``; only a
    caller that sets ``promptwatt.scan.partitions`` (the local benchmark, whose
    table is one file with one row group) gets a round-robin to that number."""
    n = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(n)) if n else df
