"""Versioned tables at every step of a writer, and late or repeated files of streams."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from promptwatt.session import ensure_checkpoint_dir, stored
from promptwatt.sources import snapshots as SN
from promptwatt.streaming import streams as ST


@pytest.fixture()
def path(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    return str(tmp_path / "table")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v long")


def seen(spark, path):
    found = SN.current(spark, path)
    return None if found is None else sorted(map(tuple, found.select("k", "v").collect()))


def test_a_reader_finds_a_whole_table_after_every_step(spark, path):
    assert seen(spark, path) is None
    version = SN.write_version(rows(spark, (1, 1)), path)
    assert seen(spark, path) is None                    # stopped before the commit
    assert SN.publish(spark, path, version, 0) and seen(spark, path) == [(1, 1)]
    held = SN.current(spark, path)
    left_over = SN.write_version(rows(spark, (9, 9)), path)
    assert seen(spark, path) == [(1, 1)]                # stopped again
    fs, temp = SN._path(spark, f"{path}/_commits/_{left_over}")
    fs.create(temp, True).close()
    assert seen(spark, path) == [(1, 1)]                # stopped while it wrote the commit
    SN.commit(spark, path, lambda old: old.unionByName(rows(spark, (2, 2))))
    assert seen(spark, path) == [(1, 1), (2, 2)]
    assert sorted(map(tuple, held.collect())) == [(1, 1)]  # a reader of the old version goes on
    assert SN.clean(spark, path, keep=1) == 2 and seen(spark, path) == [(1, 1), (2, 2)]


def test_a_writer_that_comes_second_starts_again(spark, path):
    SN.commit(spark, path, lambda old: rows(spark, (1, 1)))
    calls = []

    def change(old):
        calls.append(seen(spark, path))
        if len(calls) == 1:  # another writer commits in between
            SN.commit(spark, path, lambda table: table.unionByName(rows(spark, (2, 2))))
        return old.unionByName(rows(spark, (3, 3)))

    SN.commit(spark, path, change)
    assert len(calls) == 2 and seen(spark, path) == [(1, 1), (2, 2), (3, 3)]
    assert not SN.publish(spark, path, SN.write_version(rows(spark, (4, 4)), path), 0) and len(seen(spark, path)) == 3


def test_failed_changes_and_broken_versions_leave_the_table(spark, path):
    SN.commit(spark, path, lambda old: rows(spark, (1, 1)))
    with pytest.raises(Exception):
        SN.commit(spark, path, lambda old: old.withColumn("v", F.raise_error(F.lit("stop"))))
    assert seen(spark, path) == [(1, 1)]


def test_batches_replace_themselves_and_old_rows_go(spark, path):
    log = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(10)], "id long, timestamp timestamp").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    for batch, part in (("a", log.filter("id < 6")), ("b", log.filter("id >= 6")), ("b", log.filter("id >= 5"))):
        SN.append_rows(spark, path, part, batch)
    assert sorted(r.id for r in SN.current(spark, path).collect()) == [0, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    assert SN.retain(spark, path, dt.datetime(2024, 1, 10), 5) == 4 and SN.retain(spark, path, dt.datetime(2024, 1, 10), 5) == 0
    assert sorted(r.id for r in SN.current(spark, path).collect()) == [4, 5, 5, 6, 7, 8, 9]
    assert SN.retain(spark, path + "-none", dt.datetime(2024, 1, 10)) == 0


def test_late_rows_are_dropped_and_counted_and_files_read_once(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    base = dt.datetime(2024, 3, 1)
    parts = [[(0, 10), (1, 20)], [(2, 600)], [(6, 605)], [(3, 15), (4, 590)], [(5, 5000)]]  # (id, minutes); id 3 comes far too late
    for part in parts:
        df = spark.createDataFrame([(i, base + dt.timedelta(minutes=m), 1.0, False, "texas") for i, m in part], "id long, timestamp timestamp, energy_kwh double, is_anomaly boolean, region string")
        df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # the source takes files in the order of their times
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    query = ST.start_file_sink(ST.hourly_energy_stream(source), out, check)
    query.awaitTermination()
    assert ST.late_rows(query) == 1
    got = {r.hour_start: r.prompts for r in spark.read.parquet(out).collect()}
    assert got == {base: 2, base + dt.timedelta(hours=9): 1, base + dt.timedelta(hours=10): 2}
    ST.start_file_sink(ST.hourly_energy_stream(source), out, check).awaitTermination()
    assert {r.hour_start: r.prompts for r in spark.read.parquet(out).collect()} == got


def test_stored_tables_lie_in_the_shared_folder(spark):
    df = stored(spark.range(3), "numbers")
    assert ensure_checkpoint_dir(spark).split("/")[-1] in df.inputFiles()[0] and df.count() == 3
