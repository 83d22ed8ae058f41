"""Sources and sinks (IO1–IO9).

Tables are Parquet (the log partitioned by ``event_date``); CSV is supported
for interchange with an explicit schema. Writes are idempotent overwrites or
appends of whole partitions, so a re-run after a lost executor or a failed
job converges to the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import logs as L


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """IO1: header CSV. Pass a schema in production; without one types are
    inferred (an extra pass over the files)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO3/IO4: header CSV, one file per partition (no coalesce to one task)."""
    df.write.mode(mode).option("header", True).csv(path)


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: str | int = 42) -> DataFrame:
    """IO2: deterministic "shuffle and take n": order by md5(id || seed), take
    n — a top-k (TakeOrderedAndProject), no global sort, independent of
    partitioning, reproducible in SQL."""
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))
    return df.orderBy(key, F.col(id_col)).limit(n)


def export_logs(log: DataFrame, path: str, start=None, end=None, limit: int | None = None) -> int:
    """IO4: export a period of the log to CSV; no file when the period is
    empty. No row cap by default (``limit`` optional). Returns rows written."""
    part = L.recent_logs(log, start, end, limit=limit)
    n = part.count()
    if n:
        write_csv(part, path)
    return n


def append_log(log_rows: DataFrame, path: str, batch: str) -> None:
    """IO5: add a batch of log rows, partitioned by event date and batch. A
    batch that is written again replaces itself, so a retry adds nothing twice."""
    (log_rows.withColumn("event_date", F.to_date("timestamp")).withColumn("batch", F.lit(batch))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date", "batch").parquet(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def apply_retention(spark: SparkSession, path: str, as_of, days_to_keep: int = 90) -> int:
    """IO7: rewrite the log without rows older than the cutoff; returns the
    deleted count. Only date partitions at or before the cutoff date are
    rewritten (dynamic partition overwrite); newer partitions are untouched."""
    import datetime as dt
    cutoff = as_of - dt.timedelta(days=days_to_keep)
    log = read_log(spark, path)
    old = log.filter(F.col("event_date") <= F.lit(cutoff.date()))
    deleted = old.filter(F.col("timestamp") < L.ts_lit(cutoff)).count()
    if deleted:
        kept = old.filter(F.col("timestamp") >= L.ts_lit(cutoff))
        ckpt = kept.checkpoint()   # cut lineage: we overwrite what we read
        parts = ["event_date"] + ["batch"] * ("batch" in log.columns)
        (ckpt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
        # Partitions that became empty keep their old files under dynamic
        # overwrite, so drop their directories explicitly.
        emptied = (old.select(*parts).distinct().join(ckpt.select(*parts).distinct(), parts, "left_anti"))
        _drop_partitions(spark, path, ["/".join(f"{c}={v}" for c, v in zip(parts, r)) for r in emptied.collect()])
    return deleted


def _path(spark: SparkSession, path: str):
    """(file system, path) for any store that Hadoop knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _drop_partitions(spark: SparkSession, path: str, parts: list[str]) -> None:
    for x in parts:
        fs, p = _path(spark, f"{path.rstrip('/')}/{x}")
        fs.delete(p, True)


def write_reports(reports: DataFrame, path: str, spark: SparkSession) -> DataFrame:
    """IO6: upsert report rows keyed by report_id into a Parquet table. The new
    state is written beside the table and takes its place when it is whole; a
    run that ends in between is completed by the next one. Read errors other
    than a table that does not exist are raised."""
    fs, table = _path(spark, path)
    _, following = _path(spark, f"{path.rstrip('/')}.next")
    _, whole = _path(spark, f"{path.rstrip('/')}.next/_SUCCESS")
    if not fs.exists(table) and fs.exists(whole):
        fs.rename(following, table)
    merged = L.upsert_reports(spark.read.parquet(path), reports) if fs.exists(table) else reports
    merged.write.mode("overwrite").parquet(f"{path.rstrip('/')}.next")
    fs.delete(table, True)
    if not fs.rename(following, table):
        raise OSError(f"{path}.next could not take the place of {path}")
    return spark.read.parquet(path)


def export_report_json(report: DataFrame, path: str) -> None:
    """IO8: nested report documents as JSON lines."""
    L.report_json(report).select("report_data").write.mode("overwrite").text(path)


def save_model(model, path: str) -> None:
    """IO9: persist a fitted MLlib PipelineModel (scaler + estimator +
    feature list travel together)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def save_table(df: DataFrame, path: str) -> None:
    """Small result tables (e.g. calibration info) as Parquet."""
    df.write.mode("overwrite").parquet(path)
