"""Registered queries of operators that the other catalogues leave out.

Bindings: ``measurements`` (catalog_ml) for models and labels; durations are
doc_id % 100 / 10 seconds; anomaly scores for the severity bands run from 0 to
-0.99 by doc_id % 100, so that every band is reached.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rewrite as R
from ..functions import text as T
from ..operators import anomaly as A
from ..operators import complexity as CX
from ..operators import energy as E
from ..operators import evaluate as V
from ..operators import features as FT
from ..operators import labels as LB
from ..session import read_table
from . import sqlgen as S
from .catalog import docs, register
from .catalog_ml import _metrics_sql, _r, _rounded_metrics, _ybar, measurements, with_meas
from .catalog_rewrite import PROMPTS_SQL, prompts

D = S.d


def _first(bands, x: str, op: str, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} {op} {D(limit)} THEN {S.s(text)}" for limit, text in bands) + f" ELSE {S.s(rest)} END"


# V5 / V6 ---------------------------------------------------------------------
_over, _under = K.BIAS_TEXTS["over"], K.BIAS_TEXTS["under"]
_half = lambda x, n=0: S.round_half(x, n)


@register("validation_interpretation", with_meas(f"""SELECT lang, {_first(K.CORRELATION_BANDS, 'correlation', '>', K.CORRELATION_REST)} AS correlation_text,
    CASE WHEN bias BETWEEN 0.8 AND 1.2 THEN {S.s(K.BIAS_TEXTS['fair'])}
         WHEN bias > 1.2 THEN {S.s(_over[0])} || CAST(CAST({_half('(bias - 1) * 100')} AS BIGINT) AS VARCHAR) || {S.s(_over[1])}
         ELSE {S.s(_under[0])} || CAST(CAST({_half('(1 - bias) * 100')} AS BIGINT) AS VARCHAR) || {S.s(_under[1])}
              || CAST(CAST({_half('1 / bias', 1)} AS DECIMAL(18,1)) AS VARCHAR) || {S.s(_under[2])} END AS bias_text,
    {_first(K.MAPE_BANDS, 'mape', '<', K.MAPE_REST)} AS mape_text FROM vm""", extra=[_ybar("lang"), ("vm", _metrics_sql("lang"))]))
def validation_interpretation(spark, sf_dir):
    m = _rounded_metrics(V.regression_metrics(measurements(spark, sf_dir), "label_a", "predicted", group_by=["lang"]), ["lang"])
    return V.interpret(m).select("lang", "correlation_text", "bias_text", "mape_text")


@register("comparison_table", with_meas(f"""SELECT doc_id, {_r('predicted - label_a')} AS error,
    CASE WHEN label_a <> 0 THEN {_r('(predicted - label_a) / label_a * 100')} END AS error_percent FROM m"""))
def comparison_table(spark, sf_dir):
    c = V.comparison_table(measurements(spark, sf_dir), "label_a", "predicted")
    return c.select("doc_id", *[T.round_half(F.col(x), 6).alias(x) for x in ("error", "error_percent")])


# X7 / X8 ---------------------------------------------------------------------
_COMPLEX = S.features_ctes("src", "text", keep_internals=True) + S.complexity_ctes("f4", "text", prefix="x", reuse_internals=True)


@register("complexity_colors", S.with_ctes([("src", "SELECT doc_id, text FROM documents"), *_COMPLEX], f"""SELECT doc_id,
    CASE WHEN complexity_score < {D(0.4)} THEN 'green' WHEN complexity_score < {D(0.7)} THEN 'yellow' ELSE 'red' END AS color,
    CASE complexity_level {" ".join(f"WHEN {S.s(k)} THEN {S.s(v)}" for k, v in K.COMPLEXITY_IMPACT.items())} END AS impact FROM x5"""))
def complexity_colors(spark, sf_dir):
    d = CX.complexity(FT.features(docs(spark, sf_dir).select("doc_id", "text"), "text", keep_internals=True), "text", parsed=True)
    return d.select("doc_id", CX.color_band(F.col("complexity_score")).alias("color"), CX.complexity_impact(F.col("complexity_level")).alias("impact"))


# A3, A7, A9, A12 ---------------------------------------------------------------
@register("severity_bands", f"""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'normal' WHEN doc_id % 100 > 90 THEN 'critical'
    WHEN doc_id % 100 > 70 THEN 'high' WHEN doc_id % 100 > 50 THEN 'medium' WHEN doc_id % 100 > 30 THEN 'low' ELSE 'normal' END AS severity FROM documents""")
def severity_bands(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", A.severity_band(-(F.col("doc_id") % 100), F.col("doc_id") % 7 != 0).alias("severity"))


def _detected(spark, sf_dir):
    return A.detect(measurements(spark, sf_dir), threshold=0.25, energy_col="energy_kwh")


_DETECTED = S.anomaly_ctes("m", prefix="a", threshold=0.25, energy_col="energy_kwh")


@register("anomaly_statistics", with_meas(f"""SELECT count(*) AS total_analyzed, CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS total_anomalies,
    {", ".join(f"CAST(count(*) FILTER (anomaly_severity = {S.s(x)}) AS BIGINT) AS severity_{x}" for x in A.SEVERITIES)},
    {", ".join(f"CAST(count(*) FILTER (anomaly_type = {S.s(x)}) AS BIGINT) AS type_{x}" for x in A.TYPES)},
    {_r('avg(anomaly_score)')} AS average_anomaly_score, min(anomaly_score) AS min_score, max(anomaly_score) AS max_score,
    {_r('sum(CAST(is_anomaly AS BIGINT)) / count(*)')} AS anomaly_rate FROM a3""", extra=_DETECTED))
def anomaly_statistics(spark, sf_dir):
    s = A.anomaly_statistics(_detected(spark, sf_dir))
    return s.withColumns({c: T.round_half(F.col(c), 6) for c in ("average_anomaly_score", "anomaly_rate")})


@register("anomaly_training_metrics", with_meas(f"""SELECT count(*) AS n_samples, CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS n_anomalies_detected,
    {_r('sum(CAST(is_anomaly AS BIGINT)) / count(*)')} AS anomaly_rate, {_r('avg(anomaly_score)')} AS mean_score,
    {_r('stddev_pop(anomaly_score)')} AS std_score, min(anomaly_score) AS min_score, max(anomaly_score) AS max_score FROM a3""", extra=_DETECTED))
def anomaly_training_metrics(spark, sf_dir):
    m = A.training_metrics(_detected(spark, sf_dir))
    return m.withColumns({c: T.round_half(F.col(c), 6) for c in ("anomaly_rate", "mean_score", "std_score")})


_FENCED = ("token_count", "avg_word_length")


@register("fence_flags", with_meas(f"SELECT doc_id, {_FENCED[0]}, {_FENCED[1]}, " + ", ".join(
    f"({c} < q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]) OR {c} > q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1])) AS {c}_iqr_outlier, "
    f"CASE WHEN s_{c} > 0 THEN abs({c} - m_{c}) / s_{c} > 3 ELSE false END AS {c}_z_outlier" for c in _FENCED)
    + " FROM m CROSS JOIN (SELECT " + ", ".join(
        f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}, avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _FENCED) + " FROM m)"))
def fence_flags(spark, sf_dir):
    m = measurements(spark, sf_dir).select("doc_id", *_FENCED)
    return A.fence_flags(m, A.feature_statistics(m, list(_FENCED)), list(_FENCED))


# E2, E4, E7, E10, E11, E14, E15 ------------------------------------------------
_LOG = "log10(CAST({} AS DOUBLE) + 1)"


@register("formula_energy", with_meas(f"""SELECT doc_id, {_r(f"greatest({D(0.001)}, ({D(0.1)} + token_count * {D(0.002)} + complexity_score * {D(0.5)} + num_layers * {D(0.01)} + log10({D(K.BASELINE_FLOPS)} + 1) * {D(0.05)}) * {D(K.PUE)})")} AS formula_joules FROM m"""))
def formula_energy(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return m.select("doc_id", T.round_half(E.formula_joules(F.col("token_count"), F.col("complexity_score"), "num_layers"), 6).alias("formula_joules"))


@register("config_scaling", with_meas(f"""SELECT doc_id, {_r(f"greatest({D(K.CONFIG_SCALE_MIN)}, least({D(K.CONFIG_SCALE_MAX)}, pow(sqrt(num_layers / {D(K.BASELINE_LAYERS)}), 0.4) * pow(log10(num_layers / 4.0 + 1) / log10({D(K.BASELINE_TRAINING_HOURS)} + 1), 0.2) * pow(log10(CAST(num_layers AS DOUBLE) * 1e10 + 1) / log10({D(K.BASELINE_FLOPS)} + 1), 0.4)))")} AS config_scale FROM m"""))
def config_scaling(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumns({"hours": F.col("num_layers") / 4.0, "flops": F.col("num_layers").cast("double") * 1e10})
    return m.select("doc_id", T.round_half(E.config_scale("num_layers", "hours", "flops"), 6).alias("config_scale"))


@register("legacy_levels", with_meas(f"""SELECT doc_id, {S.bucketize('label_d', K.LEGACY_LEVELS_KWH, 'very_high')} AS legacy_level FROM m"""))
def legacy_levels(spark, sf_dir):
    return measurements(spark, sf_dir).select("doc_id", E.legacy_level(F.col("label_d")).alias("legacy_level"))


@register("measured_runs", f"""SELECT doc_id, {_r(f"doc_id % 100 / 10.0 * {D(K.MEASURED_WATTS)}")} AS energy_joules,
    {_r(f"doc_id % 100 / 10.0 * {D(K.MEASURED_WATTS)} / {D(K.JOULES_PER_KWH)}", 10)} AS energy_kwh,
    {_r(f"doc_id % 100 / 10.0 * {D(K.MEASURED_WATTS)} / {D(K.JOULES_PER_KWH)} * {D(K.MEASURED_KG_PER_KWH)}", 10)} AS carbon_kg FROM documents""")
def measured_runs(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 100 / 10.0).alias("duration_seconds"))
    return E.measured_energy(d).select("doc_id", T.round_half(F.col("energy_joules"), 6).alias("energy_joules"),
                                       *[T.round_half(F.col(c), 10).alias(c) for c in ("energy_kwh", "carbon_kg")])


@register("impact_views", with_meas(f"""SELECT doc_id, {_r(f"carbon_footprint_kg / {D(K.KG_CO2_PER_TREE_YEAR)}", 10)} AS trees_equivalent,
    {_r(f"energy_kwh / {D(K.HOME_KWH_PER_HOUR)}", 10)} AS homes_powered_hours, {_r(f"carbon_footprint_kg / {D(K.KG_CO2_PER_CAR_MILE)}", 10)} AS car_miles_equivalent,
    {_r(f"energy_kwh * {D(0.2)} * {D(K.DEFAULT_CARBON_KG_PER_KWH)}", 10)} AS carbon_avoided_kg,
    {_r("carbon_footprint_kg * 1000", 8)} AS carbon_g, {_r("carbon_footprint_kg * 1000000", 6)} AS carbon_mg FROM m"""))
def impact_views(spark, sf_dir):
    m = measurements(spark, sf_dir)
    c, k = F.col("carbon_footprint_kg"), F.col("energy_kwh")
    x = m.select("doc_id", *E.impact_equivalents(c, k, k * 0.2), *E.carbon_views(c))
    digits = {"carbon_g": 8, "carbon_mg": 6}
    return x.select("doc_id", *[T.round_half(F.col(n), digits.get(n, 10)).alias(n) for n in x.columns[1:]])


@register("main_contributors", with_meas(f"""SELECT doc_id, {_r('token_count / 100')} AS token_count,
    {_r('complexity_score')} AS complexity_score, {_r('num_layers / 100')} AS num_layers FROM m"""))
def main_contributors(spark, sf_dir):
    m = measurements(spark, sf_dir)
    x = m.select("doc_id", E.main_contributors(F.col("token_count"), F.col("complexity_score"), "num_layers").alias("c"))
    return x.select("doc_id", *[T.round_half(F.col("c")[n], 6).alias(n) for n in ("token_count", "complexity_score", "num_layers")])


# P16 / P17 / P18 -------------------------------------------------------------------
_N = "len(_w)"
_LEN = S.total_length("_w")


@register("legacy_features", S.with_ctes([("w", f"SELECT doc_id, text, {S.ws_words('text')} AS _w FROM documents")], f"""SELECT doc_id,
    {S.ws_word_count('text')} AS token_count, CAST(length(text) AS BIGINT) AS char_count,
    {_r("len(regexp_extract_all(text, '[.,!?;:]')) / greatest(length(text), 1)")} AS punct_ratio, {_r(f'{_LEN} / greatest({_N}, 1)')} AS avg_word_length,
    {_r(f"len(list_filter(_w, lambda z: list_contains({S.str_list(K.STOPWORDS)}, lower(z)))) / greatest({_N}, 1)")} AS stopword_ratio,
    CAST(24 AS BIGINT) AS num_layers, {D(8.0)} AS training_hours, {D(1e11)} AS flops_per_hour,
    {_r(f"{D(1e11)} / 24")} AS flops_per_layer, {_r(f"{D(8.0)} / 24")} AS training_efficiency FROM w"""))
def legacy_features(spark, sf_dir):
    x = FT.legacy_features(docs(spark, sf_dir).select("doc_id", "text"), "text").drop("text")
    return x.withColumns({c: T.round_half(F.col(c), 6) for c in ("punct_ratio", "avg_word_length", "stopword_ratio", "flops_per_layer", "training_efficiency")})


@register("notebook_features", S.with_ctes([("w", f"SELECT doc_id, text, {S.ws_words('text')} AS _w FROM documents")], f"""SELECT doc_id,
    CAST(contains(text, '?') AS INTEGER) AS question_mark, CAST(contains(text, '!') AS INTEGER) AS exclamation_mark,
    {_r(f"length(text) / 50 + {S.safe_div(_LEN, _N)} / 5 + {_N} / 20")} AS legacy_complexity FROM w"""))
def notebook_features(spark, sf_dir):
    x = FT.notebook_features(docs(spark, sf_dir).select("doc_id", "text"), "text").drop("text")
    return x.withColumn("legacy_complexity", T.round_half(F.col("legacy_complexity"), 6))


# T3, T6, T7, T10, T11, T12, T13 ------------------------------------------------------
def _unit(key: str, seed: int, salt: str) -> str:
    return f"(CAST(('0x' || substr(md5({key} || ':{seed}:{salt}'), 1, 13)) AS BIGINT) / {D(float(16 ** 13))})"


_ID = "CAST(doc_id AS VARCHAR)"
_NOISE = f"{D(0.5)} * sqrt(-2 * ln(greatest({_unit(_ID, 7, 'c1')}, CAST('1e-12' AS DOUBLE)))) * cos(2 * pi() * {_unit(_ID, 7, 'c2')})"


@register("noisy_labels", with_meas(f"""SELECT doc_id, {_r(f"greatest({D(K.LABEL_C_FLOOR_J)}, {D(K.CALIBRATION_INTERCEPT)} + token_count * {D(K.CALIBRATION_SLOPE)} + {_NOISE})")} AS energy_joules FROM m"""))
def noisy_labels(spark, sf_dir):
    x = LB.label_c(measurements(spark, sf_dir).select("doc_id", "token_count"), noise_sd=0.5, id_col="doc_id", noise_seed=7)
    return x.select("doc_id", T.round_half(F.col("energy_joules"), 6).alias("energy_joules"))


_FRACTIONS = {c: round(0.1 + 0.1 * k, 1) for k, (c, _) in enumerate(K.TASK_MULTIPLIERS)}


@register("weighted_sample", with_meas(f"""SELECT doc_id, category FROM m WHERE {_unit(_ID, 42, 'w')} <
    CASE category {" ".join(f"WHEN {S.s(c)} THEN {D(x)}" for c, x in _FRACTIONS.items())} ELSE {D(0.0)} END"""))
def weighted_sample(spark, sf_dir):
    return LB.weighted_sample(measurements(spark, sf_dir).select("doc_id", "category"), "category", _FRACTIONS, "doc_id")


@register("expanded_templates", f"""SELECT topic, category, template, replace(template, '{{topic}}', topic) AS prompt
    FROM (SELECT DISTINCT source AS topic FROM documents) CROSS JOIN (VALUES {", ".join(f"({S.s(c)}, {S.s(t)})" for c, t in K.PROMPT_TEMPLATES)}) AS x(category, template)""")
def expanded_templates(spark, sf_dir):
    topics = read_table(spark, sf_dir, "documents").select(F.col("source").alias("topic")).distinct()
    return LB.expand_templates(topics, list(K.PROMPT_TEMPLATES))


@register("flattened_categories", "SELECT lang AS category, source || ' ' || CAST(doc_id AS VARCHAR) AS prompt FROM documents")
def flattened_categories(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    one = d.select(F.create_map("lang", F.array(F.concat_ws(" ", "source", F.col("doc_id").cast("string")))).alias("m"))
    return LB.flatten_category_map(one, "m")


# C2 ----
# C2 over the whole text of every document
@register("clean_prompts_whole", f"""SELECT doc_id, CASE WHEN length(x) > 5 THEN x END AS prompt FROM (
    SELECT doc_id, {S.collapse_ws("text")} AS x FROM documents)""")
def clean_prompts_whole(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", T.clean_prompt("text").alias("prompt"))


# R11 ---------------------------------------------------------------------------------
@register("replaced_words", S.with_ctes([("src", PROMPTS_SQL)], f"""SELECT doc_id, array_to_string(list_transform({S.ws_words('text')}, lambda w:
    CASE lower(w) {" ".join(f"WHEN {S.s(a)} THEN {S.s(b)}" for a, b in K.WORD_REPLACEMENTS)} ELSE w END), ' ') AS replaced FROM src"""))
def replaced_words(spark, sf_dir):
    return R.replace_words(prompts(spark, sf_dir), "text", "replaced").select("doc_id", "replaced")
