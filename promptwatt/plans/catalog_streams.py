"""Registered queries of streams and versioned tables (ST1 to ST3, IO5 to IO7).

A stream reads the files of a table as they are found (availableNow) and appends to
files in the shared folder; it is started a second time from its checkpoint, which
must add nothing. The oracle is the batch result over the rows that the watermark
lets out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import logs as L
from ..session import ensure_checkpoint_dir, read_table
from ..sources import snapshots as SN
from ..sources.io import _path
from ..streaming import streams as ST
from . import sqlgen as S
from .catalog import TEST_THRESHOLD, register
from .catalog_logs import _KEEP_DAYS, AS_OF, SESSION_GAP_S, _prompt_log_sql, event_log, event_rows, ts_sql, with_log


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _source(spark, sf_dir, name: str) -> DataFrame:
    """The table's files as a stream: those of its folder, or the one file."""
    folder, file = sf_dir.rstrip("/"), f"{name}.parquet"
    reader = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    fs, path = _path(spark, f"{folder}/{file}")
    return reader.parquet(f"{folder}/{file}") if fs.getFileStatus(path).isDirectory() else reader.option("pathGlobFilter", file).parquet(folder)


def _run(stream: DataFrame, name: str) -> DataFrame:
    """The rows that two starts of the stream leave in its sink."""
    spark = stream.sparkSession
    path, check = _folder(spark, name), _folder(spark, f"{name}-checkpoint")
    for _ in range(2):
        ST.start_file_sink(stream, path, check).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@register("stream_scored_log", _prompt_log_sql().replace("'default' AS region", f"{S.s(K.DEFAULT_REGION)} AS region"))
def stream_scored_log(spark, sf_dir):
    """ST1: every document through the scoring stream."""
    docs = _source(spark, sf_dir, "documents").select("doc_id", "text", L.ts_lit(AS_OF).alias("ts"))
    return _run(ST.scored_log_stream(docs, id_col="doc_id", threshold=TEST_THRESHOLD), "scored-log").drop("model_params", "event_date")


_LAST = "(SELECT max(timestamp) FROM log)"


@register("stream_hourly_energy", with_log(f"""SELECT strftime(date_trunc('hour', timestamp), '%Y-%m-%d %H:%M:%S') AS hour_start, region, count(*) AS prompts,
    {S.round_half('sum(energy_kwh)', 6)} AS energy_kwh, CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS anomalies FROM log
    GROUP BY date_trunc('hour', timestamp), region HAVING date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= {_LAST} - INTERVAL 1 HOUR"""))
def stream_hourly_energy(spark, sf_dir):
    """ST2: windows that end an hour before the last event are whole."""
    out = _run(ST.hourly_energy_stream(event_rows(_source(spark, sf_dir, "events"))), "hourly")
    return out.withColumn("hour_start", F.date_format("hour_start", "yyyy-MM-dd HH:mm:ss"))


@register("stream_sessions", with_log(f"""SELECT user_id, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS prompts,
    {S.round_half('sum(energy_kwh)', 6)} AS energy_kwh, CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS anomalies,
    CAST(sum(CAST(was_optimized AS BIGINT)) AS BIGINT) AS optimizations
    FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS session FROM (
      SELECT *, CASE WHEN timestamp < lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp) + INTERVAL {SESSION_GAP_S} SECOND THEN 0 ELSE 1 END AS new FROM log))
    GROUP BY user_id, session HAVING max(timestamp) + INTERVAL {SESSION_GAP_S} SECOND <= {_LAST} - INTERVAL 6 HOUR"""))
def stream_sessions(spark, sf_dir):
    """ST3: sessions that no event can extend any more."""
    out = _run(ST.session_stream(event_rows(_source(spark, sf_dir, "events")), user_col="user_id", gap=f"{SESSION_GAP_S} seconds"), "sessions")
    return out.drop("session_end").withColumn("session_start", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss"))


# IO5 / IO7: batches appended (one of them twice), old rows dropped -------------------------
@register("versioned_log", with_log(f"""SELECT strftime(timestamp, '%Y-%m-%d') AS day, region, count(*) AS prompts, {S.round_half('sum(energy_kwh)', 6)} AS energy_kwh
    FROM log WHERE timestamp >= {ts_sql(AS_OF)} - INTERVAL {_KEEP_DAYS} DAY GROUP BY 1, 2"""))
def versioned_log(spark, sf_dir):
    log, path = event_log(spark, sf_dir).drop("event_type"), _folder(spark, "versioned-log")
    for k in (0, 1, 1):
        SN.append_rows(spark, path, log.filter(F.pmod("user_id", F.lit(2)) == k), f"half-{k}")
    SN.retain(spark, path, AS_OF, _KEEP_DAYS)
    rows = SN.current(spark, path)
    return rows.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day"), "region").agg(F.count("*").alias("prompts"), T.round_half(F.sum("energy_kwh"), 6).alias("energy_kwh"))


# IO6: reports of every day, written again with later rows ------------------------------------
@register("versioned_reports", with_log(f"""SELECT 'TR-' || strftime(timestamp, '%Y%m%d') AS report_id, count(*) AS total_prompts, {S.round_half('sum(energy_kwh)', 6)} AS total_energy_kwh
    FROM log GROUP BY 1"""))
def versioned_reports(spark, sf_dir):
    log, path = event_log(spark, sf_dir), _folder(spark, "versioned-reports")
    SN.upsert_reports(spark, path, L.daily_reports(log.filter(F.col("region") == "texas"), as_of=AS_OF))
    out = SN.upsert_reports(spark, path, L.daily_reports(log, as_of=AS_OF))
    return out.select("report_id", "total_prompts", T.round_half(F.col("total_energy_kwh"), 6).alias("total_energy_kwh"))
