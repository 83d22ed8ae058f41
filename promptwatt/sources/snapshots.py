"""Tables as a row of whole versions (IO6, IO7).

A table is a folder with one subfolder for each version and a folder of commits.
A writer writes a new version beside the others and then publishes it by renaming a
small file to the next commit's number; the rename succeeds for one writer only, and
the other starts again from the version it lost to. A reader takes the commit with
the highest number, so it finds a whole table at every moment, also while a writer
works and after one has stopped anywhere. Versions without a commit are left over
from stopped writers; `clean` removes them and versions older than the last few.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import logs as L
from .io import _path


def _commits(spark: SparkSession, path: str) -> dict[int, str]:
    """Number and version folder of each commit."""
    fs, folder = _path(spark, f"{path}/_commits")
    if not fs.exists(folder):
        return {}
    found = {}
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.isdigit():
            stream = fs.open(f.getPath())
            try:
                found[int(name)] = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
    return found


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest whole version; None if nothing was committed."""
    found = _commits(spark, path)
    return spark.read.parquet(f"{path}/{found[max(found)]}") if found else None


def write_version(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Writes a version that no reader sees yet; returns its folder."""
    name = f"v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{name}")
    return name


def publish(spark: SparkSession, path: str, version: str, number: int) -> bool:
    """Makes a version the table's commit `number`; False if another writer did."""
    fs, temp = _path(spark, f"{path}/_commits/_{version}")
    _, final = _path(spark, f"{path}/_commits/{number:012d}")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    done = not fs.exists(final) and fs.rename(temp, final)
    if not done:
        fs.delete(temp, False)
    return done


def commit(spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replaces the table by change(table), starting again if another writer was
    first; returns the new table."""
    while True:
        found = _commits(spark, path)
        last = max(found, default=-1)
        version = write_version(change(spark.read.parquet(f"{path}/{found[last]}") if found else None), path, partition_by)
        if publish(spark, path, version, last + 1):
            return spark.read.parquet(f"{path}/{version}")


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes all versions but those of the last `keep` commits; returns how many.
    Run it when no writer is at work and no reader holds an older version."""
    found = _commits(spark, path)
    held = {found[n] for n in sorted(found)[-keep:]}
    fs, folder = _path(spark, path)
    old = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("v-") and f.getPath().getName() not in held]
    for n in sorted(found)[:-keep]:
        fs.delete(_path(spark, f"{path}/_commits/{n:012d}")[1], False)
    for p in old:
        fs.delete(p, True)
    return len(old)


def upsert_reports(spark: SparkSession, path: str, reports: DataFrame) -> DataFrame:
    """IO6: the newest report of each report_id."""
    return commit(spark, path, lambda old: reports if old is None else L.upsert_reports(old, reports))


def append_rows(spark: SparkSession, path: str, rows: DataFrame, batch: str) -> DataFrame:
    """IO5: adds a batch of log rows; a batch that is written again replaces itself."""
    named = rows.withColumn("batch", F.lit(batch)).withColumn("event_date", F.to_date("timestamp"))
    return commit(spark, path, lambda old: named if old is None else old.filter(F.col("batch") != batch).unionByName(named), ("event_date",))


def retain(spark: SparkSession, path: str, as_of: dt.datetime, days_to_keep: int = 90) -> int:
    """IO7: drops rows older than the cutoff; returns how many."""
    cutoff = L.ts_lit(as_of - dt.timedelta(days=days_to_keep))
    table = current(spark, path)
    if table is None:
        return 0
    before = table.filter(F.col("timestamp") < cutoff).count()
    if before:
        commit(spark, path, lambda old: old.filter(F.col("timestamp") >= cutoff), ("event_date",) if "event_date" in table.columns else ())
    return before
