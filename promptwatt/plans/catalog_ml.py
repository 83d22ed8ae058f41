"""Registered label, calibration, validation and EDA queries (T*, F5, V*, D*).

Binding ("measurements"): features + complexity of every document; category
= one of the seven task names or 'other' by doc_id % 8 (exercises the default
multiplier); actual energy = label formula A (T1), predicted = the calibrated
estimate (E1, E3–E5); num_layers = 12/24/48/96 by doc_id % 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import evaluate as V
from ..operators import labels as LB
from ..operators.complexity import complexity
from ..operators.energy import estimate_energy
from ..operators.features import INTERNALS, features
from ..session import read_table, stored
from . import sqlgen as S
from .catalog import docs, register

CATS = tuple(c for c, _ in K.TASK_MULTIPLIERS) + ("other",)
LAYERS = (12, 24, 48, 96)


def measurements(spark, sf_dir) -> DataFrame:
    d = features(docs(spark, sf_dir), "text", keep_internals=True)
    d = complexity(d, "text", parsed=True, keep_components=False)
    d = d.drop(*INTERNALS, "text")
    d = d.withColumn("category", F.element_at(F.array(*[F.lit(c) for c in CATS]),
                                              (F.pmod("doc_id", F.lit(8)) + 1).cast("int")))
    d = d.withColumn("num_layers", F.element_at(F.array(*[F.lit(x) for x in LAYERS]),
                                                (F.pmod("doc_id", F.lit(4)) + 1).cast("int")))
    d = LB.label_a(d, category_col="category").withColumnRenamed("energy_joules", "label_a")
    d = LB.label_b(d, category_col="category").withColumnRenamed("energy_joules", "label_b")
    d = LB.label_d(d, notebook=True, num_layers="num_layers").withColumnRenamed("energy_kwh", "label_d")
    d = estimate_energy(d)
    return d.withColumnRenamed("energy_joules", "predicted")


def held_measurements(spark, sf_dir, *cols) -> DataFrame:
    """These columns of the measurements, computed once and kept as a table, for
    queries that read them more than once."""
    return stored(measurements(spark, sf_dir).select(*cols), "measurements")


def _pow15(x: str) -> str:
    return f"pow({x}, {S.d(1.5)})"


def meas_ctes():
    mult_a = " ".join(f"WHEN {S.s(c)} THEN {S.d(m)}" for c, m in K.TASK_MULTIPLIERS)
    mult_b = " ".join(f"WHEN {S.s(c)} THEN {S.d(m)}" for c, m in K.LABEL_B_CATEGORY_MULTIPLIERS)
    ctes = [("src", "SELECT doc_id, text, lang, source FROM documents")]
    ctes += S.features_ctes("src", "text", keep_internals=True)
    ctes += S.complexity_ctes("f4", "text", prefix="x", reuse_internals=True, keep_components=False)
    ctes += [("m0", f"""SELECT * EXCLUDE (_clean, _words, _sents, text),
        {S.str_list(CATS)}[(doc_id % 8) + 1] AS category,
        [{', '.join(str(x) for x in LAYERS)}][(doc_id % 4) + 1] AS num_layers FROM x5"""),
             ("m1", f"""SELECT *,
        {S.round_half(f'''{S.d(K.LABEL_A_BASE_J)} + token_count * {S.d(K.LABEL_A_J_PER_TOKEN)}
          * (1 + {_pow15('complexity_score')} * {S.d(K.LABEL_A_COMPLEXITY_MULT)})
          * (CASE category {mult_a} ELSE {S.d(K.DEFAULT_TASK_MULTIPLIER)} END)
          * (1 + (avg_word_length - {S.d(4.0)}) * {S.d(0.05)}) * (1 + unique_word_ratio * {S.d(0.1)})''', 4)} AS label_a,
        greatest({S.d(K.LABEL_B_FLOOR_J)}, ({S.d(K.CALIBRATION_INTERCEPT)} + token_count * {S.d(K.CALIBRATION_SLOPE)}
          + complexity_score * {S.d(K.LABEL_B_COMPLEXITY_J)}) * (CASE category {mult_b} ELSE {S.d(1.0)} END)) AS label_b,
        greatest({S.d(0.01)}, {S.d(0.5)} + token_count * {S.d(0.003)} + avg_word_length * {S.d(0.10)}
          + num_layers * {S.d(0.01)} + log10({S.d(K.BASELINE_FLOPS)} + 1) * {S.d(0.05)}) AS label_d
        FROM m0""")]
    ctes += S.energy_ctes("m1", prefix="e")
    ctes += [("m", "SELECT * RENAME (energy_joules AS predicted) FROM e2")]
    return ctes


def with_meas(final: str, extra=()) -> str:
    return S.with_ctes(meas_ctes() + list(extra), final)


def _eff(x: str) -> str:
    return S.bucketize(x, K.EFFICIENCY_LABELS, K.EFFICIENCY_TOP_LABEL)


# T1, T2, T4, T5 ----------------------------------------------------------------
@register("training_labels", with_meas(f"""SELECT doc_id, category, label_a, {S.round_half('label_b', 6)} AS label_b,
    {S.round_half('label_d', 6)} AS label_d, {_eff('label_a')} AS efficiency_label FROM m"""))
def training_labels(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return m.select("doc_id", "category", "label_a", T.round_half(F.col("label_b"), 6).alias("label_b"),
                    T.round_half(F.col("label_d"), 6).alias("label_d"),
                    LB.efficiency_label(F.col("label_a")).alias("efficiency_label"))


# F5 ----------------------------------------------------------------------------
def _r(x, n=6):
    return S.round_half(x, n)


@register("calibration_fit", with_meas(f"""SELECT {_r('energy_intercept')} AS energy_intercept,
    {_r('energy_slope')} AS energy_slope, {_r('linear_r2')} AS linear_r2, {_r('correlation')} AS correlation,
    min_tokens, max_tokens, {_r('min_energy')} AS min_energy, {_r('max_energy')} AS max_energy,
    {_r('mean_energy')} AS mean_energy, {_r('residual_std')} AS residual_std,
    {_r(f'energy_slope / {S.d(K.CALIBRATION_REFERENCE_SLOPE)}')} AS calibration_factor
    FROM fit CROSS JOIN (SELECT stddev_pop(label_b - (fit.energy_intercept + fit.energy_slope * token_count)) AS residual_std
                         FROM m CROSS JOIN fit)""", extra=[("fit", """SELECT
    regr_intercept(label_b, token_count) AS energy_intercept, regr_slope(label_b, token_count) AS energy_slope,
    regr_r2(label_b, token_count) AS linear_r2, corr(token_count, label_b) AS correlation,
    CAST(min(token_count) AS DOUBLE) AS min_tokens, CAST(max(token_count) AS DOUBLE) AS max_tokens,
    min(label_b) AS min_energy, max(label_b) AS max_energy, avg(label_b) AS mean_energy FROM m""")]))
def calibration_fit(spark, sf_dir):
    f = V.calibration_fit(held_measurements(spark, sf_dir, "token_count", "label_b"), "token_count", "label_b")
    return f.select(*[T.round_half(F.col(c), 6).alias(c) if c not in ("min_tokens", "max_tokens") else F.col(c)
                      for c in ("energy_intercept", "energy_slope", "linear_r2", "correlation", "min_tokens",
                                "max_tokens", "min_energy", "max_energy", "mean_energy", "residual_std",
                                "calibration_factor")])


# V1–V4, V7, V8 -------------------------------------------------------------------
_METRICS = ("rmse", "mae", "r2", "mape", "mape_shifted", "mape_raw", "correlation", "bias", "max_error", "within_10", "within_20")


def _metrics_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    join = f"JOIN ybar USING ({group})" if group else "CROSS JOIN ybar"
    rel = "CASE WHEN label_a > 0 THEN abs(predicted - label_a) / label_a END"
    body = f"""SELECT {g}count(*) AS n,
        {_r('sqrt(avg((predicted - label_a) * (predicted - label_a)))')} AS rmse,
        {_r('avg(abs(predicted - label_a))')} AS mae,
        {_r('1 - sum((predicted - label_a) * (predicted - label_a)) / sum((label_a - _ybar) * (label_a - _ybar))')} AS r2,
        {_r(f'avg({rel}) * 100')} AS mape,
        {_r('avg(abs(predicted - label_a) / (label_a + CAST(1e-6 AS DOUBLE))) * 100')} AS mape_shifted,
        {_r('avg(CASE WHEN label_a <> 0 THEN abs((predicted - label_a) / label_a) END) * 100')} AS mape_raw,
        {_r('corr(label_a, predicted)')} AS correlation,
        {_r('avg(predicted) / avg(label_a)')} AS bias,
        {_r('max(abs(predicted - label_a))')} AS max_error,
        {_r(f'avg(CASE WHEN label_a > 0 THEN CAST(({rel}) <= {S.d(0.10)} AS DOUBLE) END) * 100')} AS within_10,
        {_r(f'avg(CASE WHEN label_a > 0 THEN CAST(({rel}) <= {S.d(0.20)} AS DOUBLE) END) * 100')} AS within_20,
        count(*) >= 10 AS enough_predictions
      FROM m {join}{gb}"""
    return body


def _ybar(group):
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return ("ybar", f"SELECT {g}avg(label_a) AS _ybar FROM m{gb}")


def _rounded_metrics(df: DataFrame, keys=()):
    return df.select(*keys, "n", *[T.round_half(F.col(c), 6).alias(c) for c in _METRICS], "enough_predictions")


@register("validation_metrics", with_meas(f"""SELECT *, failed_standards = '' AS meets_standards FROM (SELECT *, array_to_string(list_filter([
      CASE WHEN NOT (r2 >= {S.d(0.80)}) THEN 'r2' END, CASE WHEN NOT (mape <= {S.d(25.0)}) THEN 'mape' END,
      CASE WHEN NOT (bias >= {S.d(0.90)} AND bias <= {S.d(1.10)}) THEN 'bias' END,
      CASE WHEN NOT (correlation >= {S.d(0.85)}) THEN 'correlation' END,
      CASE WHEN NOT (within_20 >= {S.d(70.0)}) THEN 'within_20' END], lambda z: z IS NOT NULL), ',') AS failed_standards
    FROM vm)""", extra=[_ybar(None), ("vm", _metrics_sql(None))]))
def validation_metrics(spark, sf_dir):
    m = V.regression_metrics(held_measurements(spark, sf_dir, "label_a", "predicted"), "label_a", "predicted")
    return V.standards_check(_rounded_metrics(m))


@register("validation_by_lang", with_meas(_metrics_sql("lang"), extra=[_ybar("lang")]))
def validation_by_lang(spark, sf_dir):
    return _rounded_metrics(V.regression_metrics(held_measurements(spark, sf_dir, "lang", "label_a", "predicted"), "label_a", "predicted",
                                                 group_by=["lang"]), ["lang"])


# D1 / D2 ---------------------------------------------------------------------------
_DCOLS = ("token_count", "word_count", "char_count", "avg_word_length", "avg_sentence_length",
          "stopword_ratio", "unique_word_ratio", "complexity_score")


@register("describe_features", with_meas(" UNION ALL ".join(
    f"""SELECT {S.s(c)} AS "column", count({c}) AS n, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS std,
        {_r(f'min(CAST({c} AS DOUBLE))')} AS min, {_r(f'max(CAST({c} AS DOUBLE))')} AS max,
        {_r(f'quantile_cont({c}, 0.25)')} AS q1, {_r(f'quantile_cont({c}, 0.5)')} AS median,
        {_r(f'quantile_cont({c}, 0.75)')} AS q3 FROM m""" for c in _DCOLS)))
def describe_features(spark, sf_dir):
    d = V.describe(held_measurements(spark, sf_dir, *_DCOLS), list(_DCOLS))
    return d.select("column", "n", *[T.round_half(F.col(c), 6).alias(c) for c in ("mean", "std", "min", "max", "q1", "median", "q3")])


@register("correlation_matrix", with_meas(" UNION ALL ".join(
    f"SELECT {S.s(a)} AS feature_a, {S.s(b)} AS feature_b, {_r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS correlation FROM m"
    for a in _DCOLS for b in _DCOLS)))
def correlation_matrix(spark, sf_dir):
    d = V.correlation_matrix(measurements(spark, sf_dir), list(_DCOLS))
    return d.select("feature_a", "feature_b", T.round_half(F.col("correlation"), 6).alias("correlation"))


@register("feature_correlations", with_meas(" UNION ALL ".join(
    f"SELECT {S.s(c)} AS feature, {_r(f'corr(CAST({c} AS DOUBLE), label_a)')} AS correlation FROM m"
    for c in _DCOLS)))
def feature_correlations(spark, sf_dir):
    d = V.target_correlations(measurements(spark, sf_dir), list(_DCOLS), "label_a")
    return d.select("feature", T.round_half(F.col("correlation"), 6).alias("correlation"))


# D3 / D4 ---------------------------------------------------------------------------
_BIN_SQL = ("CASE WHEN avg_word_length > 0 AND avg_word_length <= 5 THEN 'Simple' "
            "WHEN avg_word_length > 5 AND avg_word_length <= 6 THEN 'Moderate' "
            "WHEN avg_word_length > 6 AND avg_word_length <= 7 THEN 'Complex' WHEN avg_word_length > 7 THEN 'Very Complex' END")


@register("word_length_bins", with_meas(f"""SELECT {_BIN_SQL} AS bin, count(*) AS n, {_r('min(label_a)')} AS min,
    {_r('quantile_cont(label_a, 0.25)')} AS q1, {_r('quantile_cont(label_a, 0.5)')} AS median,
    {_r('quantile_cont(label_a, 0.75)')} AS q3, {_r('max(label_a)')} AS max FROM m GROUP BY 1"""))
def word_length_bins(spark, sf_dir):
    d = V.distribution_by(held_measurements(spark, sf_dir, "avg_word_length", "label_a"), V.right_closed_bins(F.col("avg_word_length")), "label_a")
    return d.select("bin", "n", *[T.round_half(F.col(c), 6).alias(c) for c in ("min", "q1", "median", "q3", "max")])


@register("energy_histogram", with_meas(f"""SELECT CAST(CASE WHEN (_hi - _lo) / 20 = 0 THEN 0 ELSE
      least(floor((label_a - _lo) / ((_hi - _lo) / 20)), 19) END AS INTEGER) AS bucket, count(*) AS count
    FROM m CROSS JOIN (SELECT min(label_a) AS _lo, max(label_a) AS _hi FROM m) GROUP BY 1"""))
def energy_histogram(spark, sf_dir):
    return V.histogram(held_measurements(spark, sf_dir, "label_a"), "label_a", 20)


# D5 --------------------------------------------------------------------------------
@register("layer_stats", with_meas(f"""SELECT num_layers, {S.round_half('avg(label_d)', 4)} AS mean,
    {S.round_half('stddev_samp(label_d)', 4)} AS std, {S.round_half('min(label_d)', 4)} AS min,
    {S.round_half('max(label_d)', 4)} AS max, {S.round_half('avg(token_count)', 4)} AS mean_tokens,
    {S.round_half('avg(avg_word_length)', 4)} AS mean_word_length FROM m GROUP BY num_layers"""))
def layer_stats(spark, sf_dir):
    return V.group_stats(measurements(spark, sf_dir), "num_layers", "label_d",
                         {"mean_tokens": "token_count", "mean_word_length": "avg_word_length"})


# D6 --------------------------------------------------------------------------------
_MEANS = ("token_count", "avg_word_length")


@register("median_split", with_meas(f"""SELECT CAST(count(*) FILTER (label_a > _med) AS BIGINT) AS high_count,
    CAST(count(*) FILTER (label_a <= _med) AS BIGINT) AS low_count,
    {_r('avg(label_a) FILTER (label_a > _med)')} AS high_mean, {_r('avg(label_a) FILTER (label_a <= _med)')} AS low_mean,
    {", ".join(f"{_r(f'avg({c}) FILTER (label_a {op} _med)')} AS {side}_{c}" for c in _MEANS for side, op in (("high", ">"), ("low", "<=")))},
    {_r('(avg(label_a) FILTER (label_a > _med) - avg(label_a) FILTER (label_a <= _med)) / avg(label_a) FILTER (label_a > _med) * 100')} AS potential_savings_percent
    FROM m CROSS JOIN (SELECT quantile_cont(label_a, 0.5) AS _med FROM m)"""))
def median_split(spark, sf_dir):
    d = V.median_split(held_measurements(spark, sf_dir, "label_a", *_MEANS), "label_a", "label_a", _MEANS)
    return d.select("high_count", "low_count", *[T.round_half(F.col(c), 6).alias(c) for c in d.columns if not c.endswith("_count") or c.endswith("token_count")])


# D7 / D8 ---------------------------------------------------------------------------
@register("category_counts", with_meas(f"""SELECT category, count(*) AS count,
    {_r('count(*) / sum(count(*)) OVER () * 100')} AS share_percent FROM m GROUP BY category"""))
def category_counts(spark, sf_dir):
    d = V.value_counts(measurements(spark, sf_dir), "category")
    return d.withColumn("share_percent", T.round_half(F.col("share_percent"), 6))


@register("energy_ranges", with_meas(f"""SELECT {_r('min(label_a)')} AS min_label_a, {_r('max(label_a)')} AS max_label_a,
    min(token_count) AS min_token_count, max(token_count) AS max_token_count,
    {_r('min(complexity_score)')} AS min_complexity_score, {_r('max(complexity_score)')} AS max_complexity_score FROM m"""))
def energy_ranges(spark, sf_dir):
    d = V.ranges(measurements(spark, sf_dir), ["label_a", "token_count", "complexity_score"])
    return d.select(*[T.round_half(F.col(c), 6).alias(c) if "token" not in c else F.col(c) for c in d.columns])


# Features joined to labels ------------------------------------------------
@register("features_with_labels", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents")] + S.features_ctes("src", "text"),
    "SELECT f4.doc_id, token_count, word_count, quality, toxic FROM f4 JOIN labels USING (doc_id)"))
def features_with_labels(spark, sf_dir):
    f = features(docs(spark, sf_dir).select("doc_id", "text"), "text")
    return f.join(read_table(spark, sf_dir, "labels"), "doc_id", "inner").select(
        "doc_id", "token_count", "word_count", "quality", "toxic")


@register("features_left_labels", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents")] + S.features_ctes("src", "text"),
    """SELECT f4.doc_id, token_count, word_count, labels.doc_id IS NOT NULL AS has_label,
       coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
       FROM f4 LEFT JOIN labels USING (doc_id)"""))
def features_left_labels(spark, sf_dir):
    f = features(docs(spark, sf_dir).select("doc_id", "text"), "text")
    lab = read_table(spark, sf_dir, "labels").withColumn("has_label", F.lit(True))
    return f.join(lab, "doc_id", "left").select(
        "doc_id", "token_count", "word_count", F.coalesce("has_label", F.lit(False)).alias("has_label"),
        F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"))


# Assembled training set; every tenth document counts as measured ------
def _unit(key: str, salt: str) -> str:
    return f"(CAST(('0x' || substr(md5({key} || ':42:{salt}'), 1, 13)) AS BIGINT) / {S.d(float(16 ** 13))})"


_ID, _COPY = "CAST(doc_id AS VARCHAR)", "(CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR))"


@register("training_set", with_meas(f"""SELECT doc_id, token_count, complexity_score, {_r('energy_joules')} AS energy_joules, data_source, copy,
    {_unit(_ID, 'split')} < {S.d(0.8)} AS is_train FROM (
      SELECT doc_id, token_count, complexity_score, label_b AS energy_joules, 'synthetic' AS data_source, -1 AS copy FROM m
      UNION ALL SELECT doc_id, token_count, complexity_score, label_b, 'measured', -1 FROM m WHERE doc_id % 10 = 0
      UNION ALL SELECT doc_id, greatest(1, token_count + CAST(floor({_unit(_COPY, 'tok')} * 3) AS BIGINT) - 1), complexity_score,
        label_b * ({S.d(0.97)} + {S.d(0.06)} * {_unit(_COPY, 'e')}), 'augmented', copy
        FROM m CROSS JOIN (SELECT unnest(range(1, 6)) AS copy) WHERE doc_id % 10 = 0)"""))
def training_set(spark, sf_dir):
    m = held_measurements(spark, sf_dir, "doc_id", "token_count", "complexity_score",
                          F.col("label_b").alias("energy_joules"))
    measured = m.filter(F.pmod("doc_id", F.lit(10)) == 0)
    aug = LB.augment(measured, id_col="doc_id")
    out = LB.union_sources(synthetic=m, measured=measured, augmented=aug)
    return (out.withColumn("is_train", LB.split_flag(F.col("doc_id"))).withColumn("copy", F.coalesce("copy", F.lit(-1)))
            .withColumn("energy_joules", T.round_half(F.col("energy_joules"), 6)))


# A1: the features that detectors read --------------------------------------------
_IF_COLS = ["token_count", "complexity_score", "char_count", "avg_word_length",
            "vocabulary_richness", "lexical_density", "token_to_word_ratio", "complexity_to_length_ratio"]



# Feature statistics and fence flags -------------------------------------------
@register("anomaly_feature_stats", with_meas(" UNION ALL ".join(
    f"""SELECT {S.s(c)} AS feature, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS std,
        {_r(f'quantile_cont({c}, 0.25)')} AS q1, {_r(f'quantile_cont({c}, 0.75)')} AS q3,
        {_r(f'quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)')} AS iqr FROM m"""
    for c in ("token_count", "complexity_score", "char_count", "avg_word_length"))))
def anomaly_feature_stats(spark, sf_dir):
    from ..operators.anomaly import feature_statistics
    cols = ["token_count", "complexity_score", "char_count", "avg_word_length"]
    st = feature_statistics(held_measurements(spark, sf_dir, *cols), cols)
    return st.select("feature", *[T.round_half(F.col(c), 6).alias(c) for c in ("mean", "std", "q1", "q3")],
                     T.round_half(F.col("q3") - F.col("q1"), 6).alias("iqr"))


# Model selection on the measurements (rows-only check) ------------
@register("energy_model_selection", None)
def energy_model_selection(spark, sf_dir):
    from ..operators import ml as ML
    cols = ["token_count", "word_count", "char_count", "complexity_score", "avg_word_length",
            "avg_sentence_length"]
    m = held_measurements(spark, sf_dir, "doc_id", *cols, "label_b")
    _, metrics = ML.select_best(m, cols, "label_b", "doc_id", kinds=("boosting", "forest", "ridge", "elastic_net"))
    return metrics.select("model", "n", *[T.round_half(F.col(c), 6).alias(c) for c in ("r2", "rmse", "mae")])
