"""Energy-log analytics and reports.

The log is a DataFrame with the columns of ``LOG_COLUMNS`` (``timestamp`` a
real timestamp; flags boolean). Every time-based operator takes its
reference time (``as_of``) and period bounds as parameters, never the clock.
All statistics are one aggregation pass; windows are partitioned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from .quantiles import CELLS, exact_quantiles

LOG_COLUMNS = ("id", "timestamp", "prompt_hash", "prompt_preview", "token_count",
               "complexity_score", "energy_kwh", "carbon_kg", "water_liters", "is_anomaly",
               "was_optimized", "energy_saved_kwh", "model_params", "region")


def to_log(scored: DataFrame, *, text_col: str = "text", id_col: str | None = None,
           ts_col: str | None = None, as_of: dt.datetime | None = None,
           region_col: str | None = None, region: str = "default",
           num_layers=K.BASELINE_LAYERS, training_hours=K.BASELINE_TRAINING_HOURS,
           flops_per_hour=K.BASELINE_FLOPS) -> DataFrame:
    """L1: build log rows from analyzed prompts (hash, preview, 0/1 flags,
    params as JSON, region default). Ids are content-derived (xxhash64), not
    an autoincrement; the timestamp is a column or the given ``as_of``."""
    t = F.col(text_col)
    ts = F.col(ts_col) if ts_col else ts_lit(as_of or dt.datetime(1970, 1, 1))
    rid = F.col(id_col) if id_col else F.xxhash64(t, ts)
    params = F.to_json(F.struct(_num(num_layers).alias("num_layers"),
                                _num(training_hours).cast("double").alias("training_hours"),
                                _num(flops_per_hour).cast("double").alias("flops_per_hour")))
    saved = F.col("energy_saved_kwh") if "energy_saved_kwh" in scored.columns else F.lit(0.0)
    opt = F.col("was_optimized") if "was_optimized" in scored.columns else F.lit(False)
    return scored.select(
        rid.alias("id"), ts.alias("timestamp"), T.privacy_hash(t).alias("prompt_hash"),
        T.preview(t).alias("prompt_preview"), F.col("token_count"), F.col("complexity_score"),
        F.col("energy_kwh"), F.col("carbon_footprint_kg").alias("carbon_kg"),
        F.col("water_usage_liters").alias("water_liters"),
        F.col("is_anomaly").cast("int").alias("is_anomaly"), opt.cast("int").alias("was_optimized"),
        saved.alias("energy_saved_kwh"), params.alias("model_params"),
        (F.col(region_col) if region_col else F.lit(region)).alias("region"))


def in_period(log: DataFrame, start=None, end=None, *, end_inclusive: bool = True,
              ts_col: str = "timestamp") -> DataFrame:
    """Inclusive ``>= start`` and ``<= end`` (half-open when ``end_inclusive``
    is False). Filters on the raw timestamp so Parquet pushdown applies; when
    the log is partitioned by ``event_date`` a date predicate is added too, so
    whole partitions are pruned."""
    ts = F.col(ts_col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= ts_lit(start))
        if "event_date" in log.columns:
            cond = cond & (F.col("event_date") >= F.lit(_as_date(start)))
    if end is not None:
        cond = cond & ((ts <= ts_lit(end)) if end_inclusive else (ts < ts_lit(end)))
        if "event_date" in log.columns:
            cond = cond & (F.col("event_date") <= F.lit(_as_date(end)))
    return log.filter(cond)


def recent_logs(log: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """L2: logs in a period, newest first; an optional row limit (top-k by
    time → TakeOrderedAndProject, no global sort)."""
    out = in_period(log, start, end).orderBy(F.col("timestamp").desc(), F.col("id").desc())
    return out.limit(limit) if limit is not None else out


def period_statistics(log: DataFrame, start=None, end=None) -> DataFrame:
    """L3: one row of period statistics in a single aggregation.

    Empty periods still yield one row (total_prompts 0, other values 0 and a
    message), like the reference's "no data" answer."""
    x = in_period(log, start, end)
    n = F.count(F.lit(1))
    s = x.agg(
        n.alias("total_prompts"),
        F.sum("energy_kwh").alias("_e"), F.avg("energy_kwh").alias("_avg"),
        F.min("energy_kwh").alias("_min"), F.max("energy_kwh").alias("_max"),
        F.sum("carbon_kg").alias("_c"), F.sum("water_liters").alias("_w"),
        F.sum(F.col("is_anomaly").cast("long")).alias("_a"),
        F.sum(F.col("was_optimized").cast("long")).alias("_o"),
        F.sum("energy_saved_kwh").alias("_s"), F.avg("token_count").alias("_t"),
        F.avg("complexity_score").alias("_cx"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    tp = F.col("total_prompts")
    return s.select(
        tp,
        T.round_half(z("_e"), 6).alias("total_energy_kwh"),
        T.round_half(z("_avg"), 6).alias("average_energy_kwh"),
        T.round_half(z("_min"), 6).alias("min_energy_kwh"),
        T.round_half(z("_max"), 6).alias("max_energy_kwh"),
        T.round_half(z("_c"), 4).alias("total_carbon_kg"),
        T.round_half(z("_w"), 4).alias("total_water_liters"),
        F.coalesce(F.col("_a"), F.lit(0)).cast("long").alias("anomaly_count"),
        F.when(tp > 0, T.round_half(F.col("_a") / tp * 100, 2)).otherwise(F.lit(0.0)).alias("anomaly_rate"),
        F.coalesce(F.col("_o"), F.lit(0)).cast("long").alias("optimization_count"),
        T.round_half(z("_s"), 6).alias("total_energy_saved_kwh"),
        T.round_half(z("_t"), 1).alias("average_tokens"),
        T.round_half(z("_cx"), 4).alias("average_complexity"),
        F.when(tp == 0, F.lit("No data available for the specified period")).alias("message"))


def energy_percentiles(log: DataFrame, start=None, end=None, *, col: str = "energy_kwh") -> DataFrame:
    """L4: exact p25/p50/p75/p95 with linear interpolation over the whole
    period; one row, of zeros for an empty period."""
    ps = [0.25, 0.50, 0.75, 0.95]
    r = exact_quantiles(in_period(log, start, end), col, ps, cells=CELLS).agg(F.first("quantiles").alias("_q"))
    return r.select(*[F.coalesce(T.round_half(F.get("_q", F.lit(i)), 6), F.lit(0.0)).alias(f"p{int(p * 100)}")
                      for i, p in enumerate(ps)])


def transparency_report(log: DataFrame, start: dt.datetime, end: dt.datetime, *,
                        as_of: dt.datetime) -> DataFrame:
    """One report row: sums from one scan, exact percentiles from their own
    two (single rows, joined as 1×1). The report id is derived
    from the period (no clock, no uuid) so re-running is idempotent."""
    stats = period_statistics(log, start, end)
    pct = energy_percentiles(log, start, end)
    r = stats.crossJoin(pct)
    deadline = dt.date.fromisoformat(K.EU_REPORTING_DEADLINE)
    days_left = (dt.datetime.combine(deadline, dt.time()) - as_of).days
    period_key = f"{start.isoformat()}|{end.isoformat()}"
    tp = F.col("total_prompts")
    return r.select(
        F.concat(F.lit("TR-"), F.substring(F.sha2(F.lit(period_key), 256), 1, 12)).alias("report_id"),
        ts_lit(as_of).alias("generated_at"),
        ts_lit(start).alias("period_start"),
        ts_lit(end).alias("period_end"),
        F.lit((end - start).days).alias("duration_days"),
        *[F.col(c) for c in stats.columns if c != "message"],
        F.col("p25"), F.col("p50"), F.col("p75"), F.col("p95"),
        T.round_half(F.col("total_carbon_kg") / K.KG_CO2_PER_TREE_YEAR, 2).alias("trees_equivalent"),
        T.round_half(F.col("total_energy_kwh") / K.HOME_KWH_PER_HOUR, 2).alias("homes_powered_hours"),
        T.round_half(F.col("total_energy_saved_kwh") * K.DEFAULT_CARBON_KG_PER_KWH, 4).alias("carbon_avoided_kg"),
        F.lit(K.REPORT_STANDARD).alias("compliance_standard"),
        F.lit(K.EU_REPORTING_DEADLINE).alias("deadline"),
        F.lit(days_left).alias("days_until_deadline"),
        F.when(tp > 0, "COMPLIANT").otherwise("NO_DATA").alias("compliance_status"),
        F.when(tp > 0, 100).otherwise(0).alias("data_completeness_percent"))


def report_document() -> Column:
    """The nested document of a report row (IO8)."""
    c = F.col
    return F.struct(
        c("report_id"), c("generated_at"),
        F.struct(c("period_start").alias("start"), c("period_end").alias("end"),
                 c("duration_days")).alias("period"),
        F.struct(*[c(x) for x in ("total_prompts", "total_energy_kwh", "average_energy_kwh",
                                  "min_energy_kwh", "max_energy_kwh", "total_carbon_kg",
                                  "total_water_liters", "anomaly_count", "anomaly_rate",
                                  "optimization_count", "total_energy_saved_kwh",
                                  "average_tokens", "average_complexity")]).alias("summary"),
        F.struct(c("p25"), c("p50"), c("p75"), c("p95")).alias("energy_distribution"),
        F.struct(c("total_carbon_kg").alias("carbon_footprint_kg"),
                 c("total_water_liters").alias("water_usage_liters"), c("trees_equivalent"),
                 c("homes_powered_hours")).alias("environmental_impact"),
        F.struct(c("optimization_count").alias("total_optimizations"),
                 c("total_energy_saved_kwh").alias("energy_saved_kwh"),
                 c("carbon_avoided_kg")).alias("optimization_impact"),
        F.struct(c("anomaly_count").alias("total_detected"),
                 c("anomaly_rate").alias("anomaly_rate_percent")).alias("anomalies"),
        F.struct(c("compliance_standard").alias("standard"), c("deadline"),
                 c("days_until_deadline"), c("compliance_status").alias("status"),
                 c("data_completeness_percent")).alias("compliance"))


def report_json(report: DataFrame) -> DataFrame:
    """IO8: nested report document (period, summary, distribution, impact,
    optimization, anomalies, compliance) as one JSON string per row."""
    return report.select("report_id", "generated_at", "period_start", "period_end",
                         "total_energy_kwh", "total_carbon_kg", "total_water_liters",
                         "total_prompts", "anomaly_count", "optimization_count",
                         F.to_json(report_document()).alias("report_data"), "compliance_status")


def daily_reports(log: DataFrame, *, as_of: dt.datetime) -> DataFrame:
    """Per-day report rows for a whole log in one grouped pass (the batch form
    of calling L5 once per day)."""
    day = F.to_date("timestamp")
    g = log.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("total_prompts"),
        T.round_half(F.sum("energy_kwh"), 6).alias("total_energy_kwh"),
        T.round_half(F.sum("carbon_kg"), 4).alias("total_carbon_kg"),
        T.round_half(F.sum("water_liters"), 4).alias("total_water_liters"),
        F.sum(F.col("is_anomaly").cast("long")).alias("anomaly_count"),
        F.sum(F.col("was_optimized").cast("long")).alias("optimization_count"))
    start = F.col("day").cast("timestamp_ntz")
    return g.select(
        F.concat(F.lit("TR-"), F.date_format("day", "yyyyMMdd")).alias("report_id"),
        (start + F.expr("INTERVAL 1 DAY")).alias("generated_at"),
        start.alias("period_start"), (start + F.expr("INTERVAL 1 DAY")).alias("period_end"),
        "total_energy_kwh", "total_carbon_kg", "total_water_liters", "total_prompts",
        "anomaly_count", "optimization_count",
        F.when(F.col("total_prompts") > 0, "COMPLIANT").otherwise("NO_DATA").alias("compliance_status"))


def upsert_reports(existing: DataFrame, new: DataFrame, key: str = "report_id",
                   order_col: str = "generated_at") -> DataFrame:
    """IO6: INSERT OR REPLACE by key — union, keep the latest per key."""
    w = Window.partitionBy(key).orderBy(F.col(order_col).desc(), F.col("_src").desc())
    both = (existing.withColumn("_src", F.lit(0))
            .unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True))
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")


def latest_reports(reports: DataFrame, limit: int = 10) -> DataFrame:
    """The N most recent stored reports (top-k by generated_at)."""
    return reports.orderBy(F.col("generated_at").desc(), F.col("report_id").desc()).limit(limit)


def decode_reports(stored: DataFrame, like: DataFrame) -> DataFrame:
    """``full_report`` parsed from the stored documents, with the types that
    ``like`` (report rows as L5 makes them) gives them; null if not readable."""
    kind = like.select(report_document().alias("d")).schema["d"].dataType
    return stored.withColumn("full_report", F.from_json("report_data", kind))


def hourly_breakdown(log: DataFrame, day: dt.date) -> DataFrame:
    """One day (half-open), count / sum / avg by hour 'HH'."""
    start = dt.datetime.combine(day, dt.time())
    x = in_period(log, start, start + dt.timedelta(days=1), end_inclusive=False)
    return (x.groupBy(F.date_format("timestamp", "HH").alias("hour"))
            .agg(F.count(F.lit(1)).alias("prompt_count"),
                 T.round_half(F.sum("energy_kwh"), 6).alias("total_energy"),
                 T.round_half(F.avg("energy_kwh"), 6).alias("avg_energy")))


def last_n_days_statistics(log: DataFrame, as_of: dt.datetime, days: int | None) -> DataFrame:
    """Statistics for the last 1 / 7 / 30 days (None = all time)."""
    start = None if days is None else as_of - dt.timedelta(days=days)
    return period_statistics(log, start, None)


def benchmarks(log: DataFrame, model_col: str, category_col: str) -> DataFrame:
    """Per (model_type, prompt_category): avg energy, avg tokens, n, and
    exact p25/50/75/95."""
    ps = [0.25, 0.50, 0.75, 0.95]
    log = log.select(F.col(model_col).alias("model_type"), F.col(category_col).alias("prompt_category"), "energy_kwh", "token_count")
    q = exact_quantiles(log, "energy_kwh", ps, ["model_type", "prompt_category"], cells=CELLS).select(
        F.col("model_type").alias("_m"), F.col("prompt_category").alias("_p"), F.col("quantiles").alias("_q"))
    g = log.groupBy("model_type", "prompt_category").agg(
        T.round_half(F.avg("energy_kwh"), 6).alias("avg_energy_kwh"),
        T.round_half(F.avg("token_count"), 4).alias("avg_tokens"),
        F.count(F.lit(1)).alias("sample_count"))
    g = g.join(q, g["model_type"].eqNullSafe(q["_m"]) & g["prompt_category"].eqNullSafe(q["_p"]), "left")
    return g.select("model_type", "prompt_category", "avg_energy_kwh", "avg_tokens", "sample_count",
                    *[T.round_half(F.get("_q", F.lit(i)), 6).alias(f"percentile_{int(p * 100)}")
                      for i, p in enumerate(ps)])


def log_summary(log: DataFrame) -> DataFrame:
    """Secondary report form — totals, average, peak, carbon at 0.42,
    water at 1.8, anomaly %, savings."""
    n = F.count(F.lit(1))
    return log.agg(
        n.alias("total_prompts"),
        T.round_half(F.sum("energy_kwh"), 6).alias("total_energy_kwh"),
        T.round_half(F.avg("energy_kwh"), 6).alias("average_energy_kwh"),
        T.round_half(F.max("energy_kwh"), 6).alias("peak_energy_kwh"),
        T.round_half(F.sum("energy_kwh") * K.DEFAULT_CARBON_KG_PER_KWH, 6).alias("total_carbon_kg"),
        T.round_half(F.sum("energy_kwh") * K.WATER_L_PER_KWH, 6).alias("total_water_liters"),
        T.round_half(F.sum(F.col("is_anomaly").cast("long")) / n * 100, 4).alias("anomaly_percent"),
        T.round_half(F.sum("energy_saved_kwh"), 6).alias("total_saved_kwh"))


def sessionize(log: DataFrame, *, user_col: str, gap_seconds: int, ts_col: str = "timestamp") -> DataFrame:
    """Gap sessionization: a new session starts when the gap to the user's
    previous event exceeds ``gap_seconds``; session id = (user, ordinal).

    A user's events are cut by day, so that a window holds one day of a user.
    Starts are counted within the day; the days' counts and last times (a row
    for each user and day) carry ordinals and gaps over midnight."""
    if ts_col != "timestamp":
        log = log.withColumn("timestamp", F.col(ts_col))
    late = lambda t, before: before.isNull() | (t - before > F.expr(f"INTERVAL {int(gap_seconds)} SECONDS"))
    day = Window.partitionBy(user_col, "_day").orderBy("timestamp", "id")
    rows = log.withColumn("_day", F.to_date("timestamp"))
    rows = rows.withColumn("_first", F.row_number().over(day) == 1).withColumn("_new", late(F.col("timestamp"), F.lag("timestamp").over(day)))
    rows = rows.withColumn("_no", F.sum((F.col("_new") & ~F.col("_first")).cast("long")).over(day.rowsBetween(Window.unboundedPreceding, 0)))
    user = Window.partitionBy("_user").orderBy("_of")
    days = rows.groupBy(F.col(user_col).alias("_user"), F.col("_day").alias("_of")).agg(
        F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to"), F.max("_no").alias("_more"))
    days = days.withColumn("_starts", late(F.col("_from"), F.lag("_to").over(user)).cast("long"))
    # ordinal of the day's first session: all starts up to it, without the day's own later ones
    days = days.withColumn("_base", F.sum(F.col("_starts") + F.col("_more")).over(user.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_more"))
    days = days.select("_user", "_of", "_base")
    out = rows.join(days, F.col(user_col).eqNullSafe(F.col("_user")) & F.col("_day").eqNullSafe(F.col("_of")))
    return out.withColumn("session_no", F.col("_base") + F.col("_no")).drop("_day", "_first", "_new", "_no", "_user", "_of", "_base")


def session_metrics(log: DataFrame, *, user_col: str, gap_seconds: int) -> DataFrame:
    """Per session — start, end, prompts, energy, anomalies, optimizations."""
    s = sessionize(log, user_col=user_col, gap_seconds=gap_seconds)
    return s.groupBy(user_col, "session_no").agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("prompts"),
        T.round_half(F.sum("energy_kwh"), 6).alias("total_energy_kwh"),
        F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"),
        F.sum(F.col("was_optimized").cast("long")).alias("optimizations"))


def energy_level_distribution(log: DataFrame, bounds=((0.3, "low"), (0.7, "medium")),
                              top: str = "high") -> DataFrame:
    """Real level counts (thresholds 0.3 / 0.7 kWh by default)."""
    lvl = T.bucketize(F.col("energy_kwh"), bounds, top)
    return log.groupBy(lvl.alias("level")).agg(F.count(F.lit(1)).alias("prompts"))


def recent_activity(log: DataFrame, n: int = 10) -> DataFrame:
    """The n newest events, six renamed columns, flags as symbols."""
    top = recent_logs(log, limit=n)
    return top.select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("Time"),
        F.col("prompt_preview").alias("Prompt"), F.col("token_count").alias("Tokens"),
        T.round_half(F.col("energy_kwh"), 6).alias("Energy (kWh)"),
        F.when(F.col("is_anomaly").cast("boolean"), "⚠️").otherwise("✓").alias("Anomaly"),
        F.when(F.col("was_optimized").cast("boolean"), "✓").otherwise("-").alias("Optimized"))


def energy_timeseries(log: DataFrame, *, by: str = "region", every: str = "1 hour") -> DataFrame:
    """Energy per time bucket and a running total. The cumulative window
    runs on the bucketed aggregate (one row per bucket and key), partitioned
    by ``by``, never on raw events."""
    g = (log.groupBy(by, F.window("timestamp", every).alias("w"))
         .agg(F.count(F.lit(1)).alias("prompts"), F.sum("energy_kwh").alias("_e")))
    w = Window.partitionBy(by).orderBy("bucket_start").rowsBetween(Window.unboundedPreceding, 0)
    return (g.select(by, F.col("w.start").alias("bucket_start"), "prompts", "_e")
            .withColumn("cumulative_energy_kwh", T.round_half(F.sum("_e").over(w), 6))
            .withColumn("energy_kwh", T.round_half(F.col("_e"), 6)).drop("_e"))


def region_rollup(log: DataFrame) -> DataFrame:
    """Totals by region and day with subtotals (rollup)."""
    return (log.rollup("region", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("prompts"),
                 T.round_half(F.sum("energy_kwh"), 6).alias("total_energy_kwh"),
                 T.round_half(F.sum("carbon_kg"), 6).alias("total_carbon_kg"),
                 F.sum(F.col("was_optimized").cast("long")).alias("optimizations")))


def retention(log: DataFrame, as_of: dt.datetime, days_to_keep: int = 90):
    """IO7: (kept rows, deleted-count row) for a cutoff ``as_of - days``.

    The kept table is written back by the caller (or whole ``event_date``
    partitions dropped); the count is one aggregate, not a collect."""
    cutoff = as_of - dt.timedelta(days=days_to_keep)
    kept = log.filter(F.col("timestamp") >= ts_lit(cutoff))
    counts = log.agg(F.sum((F.col("timestamp") < ts_lit(cutoff)).cast("long")).alias("deleted"),
                     F.sum((F.col("timestamp") >= ts_lit(cutoff)).cast("long")).alias("kept"))
    return kept, counts


def ts_lit(v) -> Column:
    """Timezone-free timestamp literal (TIMESTAMP_NTZ from its ISO text), so
    results do not depend on the session or Python time zone."""
    if isinstance(v, dt.datetime):
        text = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(v, dt.date):
        text = v.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(v)
    return F.lit(text).cast("timestamp_ntz")


def _num(v) -> Column:
    return F.col(v) if isinstance(v, str) else F.lit(v)


def _as_date(v):
    return v.date() if isinstance(v, dt.datetime) else v
