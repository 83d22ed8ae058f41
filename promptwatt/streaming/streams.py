"""Structured Streaming forms of ingestion, hourly energy and sessions
(ST1–ST3). The per-row operators are the batch ones (stateless projections),
so a stream and a batch over the same rows give the same answer; the
stateful parts use event-time watermarks, and sinks use checkpoints so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import logs as L
from ..plans.analyze import analyze


def scored_log_stream(prompts: DataFrame, *, text_col: str = "text", ts_col: str = "ts",
                      id_col: str | None = None, threshold: float = K.ANOMALY_THRESHOLD,
                      region: str = K.DEFAULT_REGION) -> DataFrame:
    """ST1: prompt stream → features → complexity → energy → rule anomaly →
    log rows (the L1 schema plus ``event_date`` for partitioned sinks)."""
    scored = analyze(prompts, text_col, threshold=threshold, region=region, keep_components=False)
    log = L.to_log(scored, text_col=text_col, id_col=id_col, ts_col=ts_col, region=region)
    return log.withColumn("event_date", F.to_date("timestamp"))


def start_log_sink(log_stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = False):
    """Append scored rows to a date-partitioned Parquet table."""
    w = (log_stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("event_date"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(path)


def start_file_sink(stream: DataFrame, path: str, checkpoint: str):
    """Appends the rows of a stream to Parquet files until all input found is read. The
    sink's log names the files of each batch, so a batch that is run again replaces
    itself."""
    return (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def late_rows(query) -> int:
    """Rows that a finished query dropped because they came behind its watermark."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def hourly_energy_stream(log_stream: DataFrame, *, lateness: str = "1 hour",
                         ts_col: str = "timestamp") -> DataFrame:
    """ST2: energy per region per hour; events up to ``lateness`` late are
    still counted, and each window is emitted once (append mode) when the
    watermark passes its end."""
    ts = F.col(ts_col).cast("timestamp")
    return (log_stream.withColumn("_et", ts).withWatermark("_et", lateness)
            .groupBy(F.window("_et", "1 hour").alias("w"), "region")
            .agg(F.count(F.lit(1)).alias("prompts"), F.sum("energy_kwh").alias("energy_kwh"),
                 F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"))
            .select(F.col("w.start").alias("hour_start"), "region", "prompts",
                    T.round_half(F.col("energy_kwh"), 6).alias("energy_kwh"), "anomalies"))


def session_stream(log_stream: DataFrame, *, user_col: str, gap: str = "6 hours",
                   lateness: str = "6 hours", ts_col: str = "timestamp") -> DataFrame:
    """ST3: session totals with a gap-based session window per user."""
    ts = F.col(ts_col).cast("timestamp")
    return (log_stream.withColumn("_et", ts).withWatermark("_et", lateness)
            .groupBy(F.session_window("_et", gap).alias("s"), user_col)
            .agg(F.count(F.lit(1)).alias("prompts"), F.sum("energy_kwh").alias("energy_kwh"),
                 F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"),
                 F.sum(F.col("was_optimized").cast("long")).alias("optimizations"))
            .select(user_col, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "prompts", T.round_half(F.col("energy_kwh"), 6).alias("energy_kwh"),
                    "anomalies", "optimizations"))

