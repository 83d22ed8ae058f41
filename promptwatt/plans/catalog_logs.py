"""Registered log / report queries (L1–L15, IO2, IO7) over the ``events``
table bound to the energy-log schema.

Binding: id = event_id, timestamp = ts, energy_kwh = value, region =
user_id % 5 over the five regions, carbon = energy × regional intensity,
water = energy × 1.8, is_anomaly = (event_type = 'error'), was_optimized =
(event_type = 'purchase'), energy_saved_kwh = 0.2 × energy when optimized,
model_params = props, token_count = props.k, complexity = props.k / 100.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import logs as L
from ..session import read_table
from . import sqlgen as S
from .catalog import TEST_THRESHOLD, docs, register
from .analyze import analyze

REGIONS = tuple(r for r, _, _ in K.REGION_FACTORS)
KGS = tuple(k for _, _, k in K.REGION_FACTORS)
AS_OF = dt.datetime(2024, 2, 1)
P_START, P_END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25, 23, 59, 59)
R_START, R_END = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)
DAY = dt.date(2024, 1, 15)
SESSION_GAP_S = 6 * 3600


def event_log(spark, sf_dir) -> DataFrame:
    return event_rows(read_table(spark, sf_dir, "events"))


def event_rows(e: DataFrame) -> DataFrame:
    """Rows of ``events`` (a table or a stream) as log rows."""
    idx = (F.pmod(F.col("user_id"), F.lit(5)) + 1).cast("int")
    k = F.get_json_object("props", "$.k").cast("long")
    v = F.col("value")
    opt = F.col("event_type") == "purchase"
    return e.select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"),
        T.privacy_hash(F.col("event_id").cast("string")).alias("prompt_hash"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("prompt_preview"),
        k.alias("token_count"), (k / 100.0).alias("complexity_score"),
        v.alias("energy_kwh"),
        (v * F.element_at(F.array(*[F.lit(x) for x in KGS]), idx)).alias("carbon_kg"),
        (v * K.WATER_L_PER_KWH).alias("water_liters"),
        (F.col("event_type") == "error").alias("is_anomaly"), opt.alias("was_optimized"),
        F.when(opt, v * 0.2).otherwise(F.lit(0.0)).alias("energy_saved_kwh"),
        F.col("props").alias("model_params"),
        F.element_at(F.array(*[F.lit(r) for r in REGIONS]), idx).alias("region"),
        "user_id", "event_type")


LOG_SQL = f"""SELECT event_id AS id, ts AS timestamp,
    substr(sha256(CAST(event_id AS VARCHAR)), 1, 16) AS prompt_hash,
    'event ' || CAST(event_id AS VARCHAR) AS prompt_preview,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS token_count,
    CAST(json_extract_string(props, '$.k') AS BIGINT) / {S.d(100.0)} AS complexity_score,
    value AS energy_kwh,
    value * {'[' + ', '.join(S.d(x) for x in KGS) + ']'}[(user_id % 5) + 1] AS carbon_kg,
    value * {S.d(K.WATER_L_PER_KWH)} AS water_liters,
    (event_type = 'error') AS is_anomaly,
    (event_type = 'purchase') AS was_optimized,
    CASE WHEN event_type = 'purchase' THEN value * {S.d(0.2)} ELSE {S.d(0.0)} END AS energy_saved_kwh,
    props AS model_params,
    {S.str_list(REGIONS)}[(user_id % 5) + 1] AS region,
    user_id, event_type
  FROM events"""


def ts_sql(v) -> str:
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.strftime('%Y-%m-%d %H:%M:%S.%f')}'"
    return f"TIMESTAMP '{v.strftime('%Y-%m-%d')} 00:00:00'"


def period_sql(start, end, inclusive=True) -> str:
    conds = []
    if start is not None:
        conds.append(f"timestamp >= {ts_sql(start)}")
    if end is not None:
        conds.append(f"timestamp {'<=' if inclusive else '<'} {ts_sql(end)}")
    return " AND ".join(conds) if conds else "TRUE"


def stats_sql(where: str) -> str:
    r = S.round_half
    z = lambda x: f"coalesce({x}, {S.d(0.0)})"
    return f"""SELECT count(*) AS total_prompts,
        {r(z('sum(energy_kwh)'), 6)} AS total_energy_kwh,
        {r(z('avg(energy_kwh)'), 6)} AS average_energy_kwh,
        {r(z('min(energy_kwh)'), 6)} AS min_energy_kwh,
        {r(z('max(energy_kwh)'), 6)} AS max_energy_kwh,
        {r(z('sum(carbon_kg)'), 4)} AS total_carbon_kg,
        {r(z('sum(water_liters)'), 4)} AS total_water_liters,
        CAST(coalesce(sum(CAST(is_anomaly AS BIGINT)), 0) AS BIGINT) AS anomaly_count,
        CASE WHEN count(*) > 0 THEN {r('sum(CAST(is_anomaly AS BIGINT)) / count(*) * 100', 2)}
             ELSE {S.d(0.0)} END AS anomaly_rate,
        CAST(coalesce(sum(CAST(was_optimized AS BIGINT)), 0) AS BIGINT) AS optimization_count,
        {r(z('sum(energy_saved_kwh)'), 6)} AS total_energy_saved_kwh,
        {r(z('avg(token_count)'), 1)} AS average_tokens,
        {r(z('avg(complexity_score)'), 4)} AS average_complexity,
        CASE WHEN count(*) = 0 THEN 'No data available for the specified period' END AS message
      FROM log WHERE {where}"""


def with_log(final: str, extra=()) -> str:
    return S.with_ctes([("log", LOG_SQL), *extra], final)


def pct_sql(where: str, prefix: str = "p") -> str:
    parts = ", ".join(
        f"coalesce({S.round_half(f'quantile_cont(energy_kwh, {q})', 6)}, {S.d(0.0)}) AS {prefix}{int(q * 100)}"
        for q in (0.25, 0.50, 0.75, 0.95))
    return f"SELECT {parts} FROM log WHERE {where}"


# L2 ------------------------------------------------------------------------
@register("recent_logs", with_log(
    f"SELECT id, timestamp, energy_kwh, region FROM log WHERE {period_sql(R_START, R_END)} "
    f"ORDER BY timestamp DESC, id DESC LIMIT {K.LOG_LIMIT}"))
def recent_logs_q(spark, sf_dir):
    return L.recent_logs(event_log(spark, sf_dir), R_START, R_END, limit=K.LOG_LIMIT).select("id", "timestamp", "energy_kwh", "region")


# L3 ------------------------------------------------------------------------
@register("period_statistics", with_log(stats_sql(period_sql(P_START, P_END))))
def period_statistics_q(spark, sf_dir):
    return L.period_statistics(event_log(spark, sf_dir), P_START, P_END)


_EMPTY = (dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 31))


@register("empty_period_statistics", with_log(stats_sql(period_sql(*_EMPTY))))
def empty_period_statistics_q(spark, sf_dir):
    return L.period_statistics(event_log(spark, sf_dir), *_EMPTY)


# L4 ------------------------------------------------------------------------
@register("energy_percentiles", with_log(pct_sql(period_sql(P_START, P_END))))
def energy_percentiles_q(spark, sf_dir):
    return L.energy_percentiles(event_log(spark, sf_dir), P_START, P_END)


# L5 ------------------------------------------------------------------------
def _report_sql():
    import hashlib
    key = f"{P_START.isoformat()}|{P_END.isoformat()}"
    rid = "TR-" + hashlib.sha256(key.encode()).hexdigest()[:12]
    deadline = dt.datetime.combine(dt.date.fromisoformat(K.EU_REPORTING_DEADLINE), dt.time())
    r = S.round_half
    where = period_sql(P_START, P_END)
    return S.with_ctes(
        [("log", LOG_SQL), ("st", stats_sql(where)), ("pc", pct_sql(where))],
        f"""SELECT {S.s(rid)} AS report_id, {ts_sql(AS_OF)} AS generated_at,
            {ts_sql(P_START)} AS period_start, {ts_sql(P_END)} AS period_end,
            {(P_END - P_START).days} AS duration_days,
            st.* EXCLUDE (message), pc.*,
            {r(f'total_carbon_kg / {S.d(K.KG_CO2_PER_TREE_YEAR)}', 2)} AS trees_equivalent,
            {r(f'total_energy_kwh / {S.d(K.HOME_KWH_PER_HOUR)}', 2)} AS homes_powered_hours,
            {r(f'total_energy_saved_kwh * {S.d(K.DEFAULT_CARBON_KG_PER_KWH)}', 4)} AS carbon_avoided_kg,
            {S.s(K.REPORT_STANDARD)} AS compliance_standard, {S.s(K.EU_REPORTING_DEADLINE)} AS deadline,
            {(deadline - AS_OF).days} AS days_until_deadline,
            CASE WHEN total_prompts > 0 THEN 'COMPLIANT' ELSE 'NO_DATA' END AS compliance_status,
            CASE WHEN total_prompts > 0 THEN 100 ELSE 0 END AS data_completeness_percent
        FROM st CROSS JOIN pc""")


@register("transparency_report", _report_sql())
def transparency_report_q(spark, sf_dir):
    return L.transparency_report(event_log(spark, sf_dir), P_START, P_END, as_of=AS_OF)


# L6 ------------------------------------------------------------------------
@register("latest_reports", with_log(f"""SELECT 'TR-' || strftime(day, '%Y%m%d') AS report_id,
        CAST(day AS TIMESTAMP) + INTERVAL 1 DAY AS generated_at,
        CAST(day AS TIMESTAMP) AS period_start, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY AS period_end,
        {S.round_half('sum(energy_kwh)', 6)} AS total_energy_kwh,
        {S.round_half('sum(carbon_kg)', 4)} AS total_carbon_kg,
        {S.round_half('sum(water_liters)', 4)} AS total_water_liters,
        count(*) AS total_prompts,
        CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS anomaly_count,
        CAST(sum(CAST(was_optimized AS BIGINT)) AS BIGINT) AS optimization_count,
        'COMPLIANT' AS compliance_status
    FROM (SELECT *, CAST(timestamp AS DATE) AS day FROM log) GROUP BY day
    ORDER BY generated_at DESC, report_id DESC LIMIT 5"""))
def latest_reports_q(spark, sf_dir):
    return L.latest_reports(L.daily_reports(event_log(spark, sf_dir), as_of=AS_OF), 5)


# L7 ------------------------------------------------------------------------
_D0 = dt.datetime.combine(DAY, dt.time())


@register("hourly_breakdown", with_log(f"""SELECT strftime(timestamp, '%H') AS hour, count(*) AS prompt_count,
        {S.round_half('sum(energy_kwh)', 6)} AS total_energy, {S.round_half('avg(energy_kwh)', 6)} AS avg_energy
    FROM log WHERE {period_sql(_D0, _D0 + dt.timedelta(days=1), inclusive=False)} GROUP BY 1"""))
def hourly_breakdown_q(spark, sf_dir):
    return L.hourly_breakdown(event_log(spark, sf_dir), DAY)


# L8 ------------------------------------------------------------------------
@register("last_7_days_statistics", with_log(stats_sql(period_sql(AS_OF - dt.timedelta(days=7), None))))
def last_7_days_q(spark, sf_dir):
    return L.last_n_days_statistics(event_log(spark, sf_dir), AS_OF, 7)


# L9 ------------------------------------------------------------------------
@register("benchmarks", with_log(f"""SELECT event_type AS model_type, region AS prompt_category,
        {S.round_half('avg(energy_kwh)', 6)} AS avg_energy_kwh, {S.round_half('avg(token_count)', 4)} AS avg_tokens,
        count(*) AS sample_count,
        {', '.join(f"{S.round_half(f'quantile_cont(energy_kwh, {q})', 6)} AS percentile_{int(q * 100)}" for q in (0.25, 0.5, 0.75, 0.95))}
    FROM log GROUP BY 1, 2"""))
def benchmarks_q(spark, sf_dir):
    return L.benchmarks(event_log(spark, sf_dir), "event_type", "region")


# L10 -----------------------------------------------------------------------
@register("log_summary", with_log(f"""SELECT count(*) AS total_prompts,
        {S.round_half('sum(energy_kwh)', 6)} AS total_energy_kwh,
        {S.round_half('avg(energy_kwh)', 6)} AS average_energy_kwh,
        {S.round_half('max(energy_kwh)', 6)} AS peak_energy_kwh,
        {S.round_half(f'sum(energy_kwh) * {S.d(K.DEFAULT_CARBON_KG_PER_KWH)}', 6)} AS total_carbon_kg,
        {S.round_half(f'sum(energy_kwh) * {S.d(K.WATER_L_PER_KWH)}', 6)} AS total_water_liters,
        {S.round_half('sum(CAST(is_anomaly AS BIGINT)) / count(*) * 100', 4)} AS anomaly_percent,
        {S.round_half('sum(energy_saved_kwh)', 6)} AS total_saved_kwh
    FROM log"""))
def log_summary_q(spark, sf_dir):
    return L.log_summary(event_log(spark, sf_dir))


# L11 -----------------------------------------------------------------------
@register("session_metrics", with_log(f"""SELECT user_id, session_no, min(timestamp) AS session_start,
        max(timestamp) AS session_end, count(*) AS prompts,
        {S.round_half('sum(energy_kwh)', 6)} AS total_energy_kwh,
        CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS anomalies,
        CAST(sum(CAST(was_optimized AS BIGINT)) AS BIGINT) AS optimizations
    FROM s2 GROUP BY user_id, session_no""", extra=[
    ("s1", "SELECT *, lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp, id) AS prev FROM log"),
    ("s2", f"""SELECT *, CAST(sum(CASE WHEN prev IS NULL OR timestamp - prev > INTERVAL {SESSION_GAP_S} SECOND
               THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY timestamp, id ROWS UNBOUNDED PRECEDING)
               AS BIGINT) AS session_no FROM s1""")]))
def session_metrics_q(spark, sf_dir):
    return L.session_metrics(event_log(spark, sf_dir), user_col="user_id", gap_seconds=SESSION_GAP_S)


# L12 -----------------------------------------------------------------------
_LEVEL_BOUNDS = ((30.0, "low"), (70.0, "medium"))   # the 0.3 / 0.7 bands, scaled to the bound value range


@register("energy_level_distribution", with_log(
    f"SELECT {S.bucketize('energy_kwh', _LEVEL_BOUNDS, 'high')} AS level, count(*) AS prompts FROM log GROUP BY 1"))
def energy_level_distribution_q(spark, sf_dir):
    return L.energy_level_distribution(event_log(spark, sf_dir), _LEVEL_BOUNDS)


# L13 -----------------------------------------------------------------------
@register("recent_activity", with_log(f"""SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS "Time",
        prompt_preview AS "Prompt", token_count AS "Tokens", {S.round_half('energy_kwh', 6)} AS "Energy (kWh)",
        CASE WHEN is_anomaly THEN '⚠️' ELSE '✓' END AS "Anomaly",
        CASE WHEN was_optimized THEN '✓' ELSE '-' END AS "Optimized"
    FROM log ORDER BY timestamp DESC, id DESC LIMIT 10"""))
def recent_activity_q(spark, sf_dir):
    return L.recent_activity(event_log(spark, sf_dir), 10)


# L14 -----------------------------------------------------------------------
@register("energy_timeseries", with_log(f"""SELECT region, bucket_start, prompts,
        {S.round_half('sum(_e) OVER (PARTITION BY region ORDER BY bucket_start ROWS UNBOUNDED PRECEDING)', 6)}
          AS cumulative_energy_kwh,
        {S.round_half('_e', 6)} AS energy_kwh
    FROM (SELECT region, time_bucket(INTERVAL 1 HOUR, timestamp) AS bucket_start, count(*) AS prompts,
          sum(energy_kwh) AS _e FROM log GROUP BY 1, 2)"""))
def energy_timeseries_q(spark, sf_dir):
    return L.energy_timeseries(event_log(spark, sf_dir))


# L15 -----------------------------------------------------------------------
@register("region_rollup", with_log(f"""SELECT region, strftime(timestamp, '%Y-%m-%d') AS day, count(*) AS prompts,
        {S.round_half('sum(energy_kwh)', 6)} AS total_energy_kwh,
        {S.round_half('sum(carbon_kg)', 6)} AS total_carbon_kg,
        CAST(sum(CAST(was_optimized AS BIGINT)) AS BIGINT) AS optimizations
    FROM log GROUP BY ROLLUP (region, strftime(timestamp, '%Y-%m-%d'))"""))
def region_rollup_q(spark, sf_dir):
    return L.region_rollup(event_log(spark, sf_dir))


# IO7 -----------------------------------------------------------------------
_KEEP_DAYS = 20


@register("retention_counts", with_log(f"""SELECT
        CAST(sum(CAST(timestamp < {ts_sql(AS_OF - dt.timedelta(days=_KEEP_DAYS))} AS BIGINT)) AS BIGINT) AS deleted,
        CAST(sum(CAST(timestamp >= {ts_sql(AS_OF - dt.timedelta(days=_KEEP_DAYS))} AS BIGINT)) AS BIGINT) AS kept
    FROM log"""))
def retention_counts_q(spark, sf_dir):
    return L.retention(event_log(spark, sf_dir), AS_OF, _KEEP_DAYS)[1]


# L1 ------------------------------------------------------------------------
def _prompt_log_sql():
    from .catalog import _analyze_sql
    ctes = [("src", "SELECT doc_id, text FROM documents")] + _analyze_sql("src")
    return S.with_ctes(ctes, f"""SELECT doc_id AS id, {ts_sql(AS_OF)} AS timestamp,
        {S.privacy_hash('text')} AS prompt_hash, {S.preview('text')} AS prompt_preview,
        token_count, complexity_score, energy_kwh, carbon_footprint_kg AS carbon_kg,
        water_usage_liters AS water_liters, CAST(is_anomaly AS INTEGER) AS is_anomaly,
        0 AS was_optimized, {S.d(0.0)} AS energy_saved_kwh, 'default' AS region
    FROM a3""")


@register("prompt_log_rows", _prompt_log_sql())
def prompt_log_rows_q(spark, sf_dir):
    scored = analyze(docs(spark, sf_dir).select("doc_id", "text"), threshold=TEST_THRESHOLD,
                     keep_components=False)
    return L.to_log(scored, id_col="doc_id", as_of=AS_OF).drop("model_params")


# IO2 -----------------------------------------------------------------------
_SEED, _N = "42", 50


@register("sample_prompts", f"""SELECT doc_id, lang, source FROM documents
    ORDER BY md5(CAST(doc_id AS VARCHAR) || '{_SEED}'), doc_id LIMIT {_N}""")
def sample_prompts_q(spark, sf_dir):
    from ..sources.io import seeded_sample
    return seeded_sample(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source"),
                         "doc_id", _N, seed=_SEED)
