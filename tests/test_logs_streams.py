import datetime as dt
import math
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from promptwatt.operators import logs as L
from promptwatt.streaming import streams as ST


def _fixture(spark):
    rows = []
    for i in range(5):
        rows.append((i, dt.datetime(2024, 1, 1, 10 + i), 50 + 10 * i, 0.3 + 0.1 * i, 0.1 + 0.05 * i,
                     0.04 + 0.02 * i, 0.2 + 0.1 * i, i == 4, i % 2 == 0, 0.0, "california"))
    df = spark.createDataFrame(rows, "id long, timestamp timestamp, token_count long, complexity_score double, "
                                     "energy_kwh double, carbon_kg double, water_liters double, is_anomaly boolean, "
                                     "was_optimized boolean, energy_saved_kwh double, region string")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_statistics_fixture(spark):
    s = L.period_statistics(_fixture(spark)).first()
    assert s.total_prompts == 5
    assert math.isclose(s.total_energy_kwh, 1.0) and math.isclose(s.average_energy_kwh, 0.2)
    assert math.isclose(s.min_energy_kwh, 0.1) and math.isclose(s.max_energy_kwh, 0.3)
    assert math.isclose(s.total_carbon_kg, 0.4) and math.isclose(s.total_water_liters, 2.0)
    assert s.anomaly_rate == 20.0 and s.optimization_count == 3 and s.average_tokens == 70.0


def test_empty_period_and_report(spark):
    log = _fixture(spark)
    e = L.period_statistics(log, dt.datetime(2030, 1, 1), dt.datetime(2030, 2, 1)).first()
    assert e.total_prompts == 0 and e.message
    r = L.transparency_report(log, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2),
                              as_of=dt.datetime(2024, 2, 1)).first()
    assert r.compliance_status == "COMPLIANT" and r.total_prompts == 5
    assert r.days_until_deadline == (dt.datetime(2026, 8, 1) - dt.datetime(2024, 2, 1)).days
    assert L.report_json(L.transparency_report(log, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2),
                                               as_of=dt.datetime(2024, 2, 1))).first().report_data.startswith("{")


def test_preview_and_hash(spark):
    from promptwatt.functions import text as T
    df = spark.createDataFrame([("x" * 150,), ("short",)], "t string")
    r = df.select(T.preview("t").alias("p"), T.privacy_hash("t").alias("h")).collect()
    assert r[0].p == "x" * 100 + "..." and r[1].p == "short"
    assert len(r[0].h) == 16 and r[0].h != "x" * 16


def test_upsert_keeps_latest(spark):
    old = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "report_id string, generated_at timestamp, v int")
    new = spark.createDataFrame([("a", dt.datetime(2024, 1, 2), 2), ("b", dt.datetime(2024, 1, 2), 3)],
                                "report_id string, generated_at timestamp, v int")
    out = {r.report_id: r.v for r in L.upsert_reports(old, new).collect()}
    assert out == {"a": 2, "b": 3}


def _streamed(spark, log, make, name):
    """Rows a stream emits for log, after two later files that close all windows."""
    d = tempfile.mkdtemp(prefix="pw-stream-", dir="/tmp")
    first = log.agg(F.max("timestamp")).first()[0]
    files = [log] + [log.limit(1).withColumn("timestamp", F.lit(first + dt.timedelta(days=30 * k)).cast("timestamp_ntz")) for k in (1, 2)]
    for k, part in enumerate(files):
        part.coalesce(1).write.mode("append").parquet(d + "/log")
        time.sleep(1.1)  # the source takes files in the order of their times
    src = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(d + "/log")
    w = make(src).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", d + "/ck")
    w.start().awaitTermination()
    return [r for r in spark.table(name).collect()], first


def _users(spark):
    rows = [(k, dt.datetime(2024, 1, 1 + k // 40) + dt.timedelta(minutes=37 * (k * k % 700)), k % 7, 10.0 + k, k % 5 == 0, k % 3 == 0, "texas" if k % 2 else "virginia") for k in range(160)]
    df = spark.createDataFrame(rows, "id long, timestamp timestamp, user_id long, energy_kwh double, is_anomaly boolean, was_optimized boolean, region string")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_session_stream_equals_batch(spark):
    log = _users(spark)
    rows, last = _streamed(spark, log, lambda s: ST.session_stream(s, user_col="user_id", gap="6 hours", lateness="6 hours"), "pw_sessions")
    got = sorted((r.user_id, r.session_start, r.prompts, r.energy_kwh, r.anomalies, r.optimizations) for r in rows if r.session_start <= last)
    want = L.session_metrics(log, user_col="user_id", gap_seconds=6 * 3600).collect()
    assert len(want) > 20
    assert got == sorted((r.user_id, r.session_start, r.prompts, r.total_energy_kwh, r.anomalies, r.optimizations) for r in want)


def test_hourly_stream_equals_batch(spark):
    log = _users(spark)
    rows, last = _streamed(spark, log, ST.hourly_energy_stream, "pw_hours")
    got = sorted((r.hour_start, r.region, r.prompts, r.energy_kwh, r.anomalies) for r in rows if r.hour_start <= last)
    want = log.groupBy(F.date_trunc("hour", "timestamp").alias("h"), "region").agg(F.count("*").alias("n"), F.sum("energy_kwh").alias("e"), F.sum(F.col("is_anomaly").cast("long")).alias("a")).collect()
    assert got == sorted((r.h, r.region, r.n, round(r.e, 6), r.a) for r in want)


def test_scored_log_stream_equals_batch(spark, prompts):
    d = tempfile.mkdtemp(prefix="pw-score-", dir="/tmp")
    rows = prompts.withColumn("ts", F.lit("2024-05-01 10:00:00").cast("timestamp_ntz"))
    rows.write.parquet(d + "/in")
    src = spark.readStream.schema(rows.schema).parquet(d + "/in")
    ST.start_log_sink(ST.scored_log_stream(src, threshold=0.25), d + "/out", d + "/ck", available_now=True).awaitTermination()
    cols = ["prompt_hash", "token_count", "energy_kwh", "is_anomaly"]
    got = sorted(map(tuple, spark.read.parquet(d + "/out").select(*cols).collect()))
    assert got == sorted(map(tuple, ST.scored_log_stream(rows, threshold=0.25).select(*cols).collect())) and len(got) == rows.count()


def test_sessions_cross_midnight_and_hot_users(spark):
    t = dt.datetime(2024, 1, 1, 22)
    rows = [(k, t + dt.timedelta(hours=h), 1) for k, h in enumerate((0, 1, 3, 4, 30, 31, 80))] + [(20, t, 2), (21, t, 2), (22, t, None)]
    df = spark.createDataFrame(rows, "id long, timestamp timestamp, user_id long").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    out = {(r.id): r.session_no for r in L.sessionize(df, user_col="user_id", gap_seconds=3 * 3600).collect()}
    assert [out[k] for k in range(7)] == [1, 1, 1, 1, 2, 2, 3] and out[20] == out[21] == 1 and out[22] == 1


def test_report_upsert_and_recovery(spark):
    from promptwatt.session import ensure_checkpoint_dir
    from promptwatt.sources import io as IO
    ensure_checkpoint_dir(spark)
    path = tempfile.mkdtemp(prefix="pw-reports-", dir="/tmp") + "/reports"
    make = lambda rows: spark.createDataFrame(rows, "report_id string, generated_at timestamp, v int")
    IO.write_reports(make([("a", dt.datetime(2024, 1, 1), 1)]), path, spark)
    IO.write_reports(make([("a", dt.datetime(2024, 1, 2), 2), ("b", dt.datetime(2024, 1, 2), 3)]), path, spark)
    assert {r.report_id: r.v for r in spark.read.parquet(path).collect()} == {"a": 2, "b": 3}
    os.rename(path, path + ".next")  # as a run leaves it that ends before the switch
    IO.write_reports(make([("c", dt.datetime(2024, 1, 3), 4)]), path, spark)
    assert {r.report_id: r.v for r in spark.read.parquet(path).collect()} == {"a": 2, "b": 3, "c": 4}
    open(path + "/broken.parquet", "w").write("no parquet")
    with pytest.raises(Exception):
        IO.write_reports(make([("d", dt.datetime(2024, 1, 4), 5)]), path, spark)
    assert os.path.exists(path + "/broken.parquet")  # nothing was replaced


def test_append_is_idempotent_and_retention_deletes(spark):
    from promptwatt.session import ensure_checkpoint_dir
    from promptwatt.sources import io as IO
    ensure_checkpoint_dir(spark)
    path = tempfile.mkdtemp(prefix="pw-log-", dir="/tmp") + "/log"
    log = _fixture(spark)
    old = log.withColumn("timestamp", F.expr("timestamp - INTERVAL 100 DAYS"))
    for _ in range(2):
        IO.append_log(log, path, "batch-1")
    IO.append_log(old, path, "batch-0")
    assert IO.read_log(spark, path).count() == 10
    assert IO.apply_retention(spark, path, dt.datetime(2024, 1, 2), 90) == 5
    spark.catalog.clearCache()
    assert IO.read_log(spark, path).count() == 5


def test_stored_reports_decode(spark):
    report = L.transparency_report(_fixture(spark), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), as_of=dt.datetime(2024, 2, 1))
    r = L.decode_reports(L.report_json(report), report).first()
    assert r.full_report.summary.total_prompts == 5 and r.full_report.compliance.status == "COMPLIANT"


def test_exact_quantiles_at_any_size(spark):
    from promptwatt.operators.quantiles import exact_quantiles
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 30_000):
        x = np.round(rng.lognormal(size=n), 3)
        df = spark.createDataFrame([(float(v), k % 3) for k, v in enumerate(x)] + [(None, 0)], "v double, k long")
        got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.95, 1.0]).first()[0]
        assert np.allclose(got, np.quantile(x, [0, 0.25, 0.5, 0.95, 1]))
        for r in exact_quantiles(df, "v", [0.25, 0.9], ["k"]).collect():
            assert np.allclose(r.quantiles, np.quantile(x[r.k::3], [0.25, 0.9]))


def test_isolation_sampling_bound_never_empties_the_forest():
    from promptwatt.operators.isolation import sample_bound
    for n in (1, 100, 10 ** 6, 10 ** 10, 10 ** 13):
        drawn = (sample_bound(n, 256) + 2 ** 63) / 2 ** 64 * n
        assert drawn >= min(n, 700) * 0.99 and sample_bound(n, 256) < 2 ** 63


def test_exact_quantiles_by_cells_are_the_same(spark):
    import numpy as np
    from promptwatt.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(7)
    ps = [0.0, 0.25, 0.5, 0.95, 1.0]
    for n in (0, 1, 2, 9000):
        x = np.where(rng.random(n) < 0.3, 1.5, np.exp(rng.normal(0, 3, n)))  # ties and a long tail
        rows = [(None if k % 4 == 3 else k % 4, float(v)) for k, v in enumerate(x)]
        df = spark.createDataFrame(rows, "k int, v double").repartition(3)
        for cells in (1, 16, 4096):
            got = exact_quantiles(df, "v", ps, cells=cells).collect()
            assert len(got) == 1 and np.allclose(got[0].quantiles, np.quantile(x, ps) if n else [])  # none of an empty table
        got = {r.k: r.quantiles for r in exact_quantiles(df, "v", ps, ["k"], cells=64).collect()}
        assert set(got) == {k for k, _ in rows}
        for k, q in got.items():
            assert np.allclose(q, np.quantile([v for j, v in rows if j == k], ps))
    inf = float("inf")
    odd = spark.createDataFrame([(v,) for v in (-inf, -1e308, -1.0, -0.0, 0.0, 2.0, 2.0, 1e308, inf, None)], "v double")
    for p in ([0.25, 0.75], [0.5], [0.125]):
        assert exact_quantiles(odd, "v", p, cells=8).first()[0] == exact_quantiles(odd, "v", p).first()[0]
