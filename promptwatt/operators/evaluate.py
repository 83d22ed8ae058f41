"""Calibration fit (F5), validation metrics (V1–V8) and EDA.

Everything is a single aggregation pass (or two, when a statistic feeds a
second pass, e.g. residuals after the fit, or the median split); one-row
statistics are cross-joined back as a broadcast, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from .quantiles import exact_quantiles


def calibration_fit(df: DataFrame, x: str = "token_count", y: str = "energy_joules") -> DataFrame:
    """one-variable least squares E = a + b·x with R², correlation,
    residual std (population), factor = b / 0.015 and the ranges of x and y."""
    X, Y = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.regr_intercept(Y, X).alias("energy_intercept"),
                 F.regr_slope(Y, X).alias("energy_slope"),
                 F.regr_r2(Y, X).alias("linear_r2"), F.corr(X, Y).alias("correlation"),
                 F.min(X).alias("min_tokens"), F.max(X).alias("max_tokens"),
                 F.min(Y).alias("min_energy"), F.max(Y).alias("max_energy"),
                 F.avg(Y).alias("mean_energy"),
                 # variance of the residuals of a least-squares line
                 F.sqrt(F.greatest(F.lit(0.0), F.var_pop(Y) * (1 - F.regr_r2(Y, X)))).alias("residual_std")).withColumn(
        "calibration_factor", F.col("energy_slope") / K.CALIBRATION_REFERENCE_SLOPE)


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       group_by: list[str] | None = None) -> DataFrame:
    """V1–V3 (+V7 guard, V8 grouping): RMSE, MAE, R², MAPE over actual > 0,
    Pearson correlation, bias = mean(pred)/mean(actual), max error,
    % within 10 / 20 % (relative to actual > 0), and MAPE's two other forms:
    with 1e-6 added to actual, and raw over actual <> 0. One pass: the total
    sum of squares is the count times the population variance of actual."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    keys = group_by or []
    e = p - a
    rel = F.when(a > 0, F.abs(e) / a)
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / (F.count(F.lit(1)) * F.var_pop(a))).alias("r2"),
        (F.avg(F.abs(e) / (a + 1e-6)) * 100).alias("mape_shifted"), (F.avg(F.when(a != 0, F.abs(e / a))) * 100).alias("mape_raw"),
        (F.avg(rel) * 100).alias("mape"), F.corr(a, p).alias("correlation"),
        (F.avg(p) / F.avg(a)).alias("bias"), F.max(F.abs(e)).alias("max_error"),
        (F.avg(F.when(a > 0, (rel <= 0.10).cast("double"))) * 100).alias("within_10"),
        (F.avg(F.when(a > 0, (rel <= 0.20).cast("double"))) * 100).alias("within_20"))
    return out.withColumn("enough_predictions", F.col("n") >= 10)


def standards_check(metrics: DataFrame) -> DataFrame:
    """V4: pass flag and list of failing standards (R² ≥ .80, MAPE ≤ 25,
    .90 ≤ bias ≤ 1.10, correlation ≥ .85, within-20 ≥ 70)."""
    checks = {"r2": F.col("r2") >= 0.80, "mape": F.col("mape") <= 25.0,
              "bias": (F.col("bias") >= 0.90) & (F.col("bias") <= 1.10),
              "correlation": F.col("correlation") >= 0.85, "within_20": F.col("within_20") >= 70.0}
    fails = F.filter(F.array(*[F.when(~c, F.lit(k)) for k, c in checks.items()]), lambda x: x.isNotNull())
    return (metrics.withColumn("failed_standards", F.array_join(fails, ","))
                   .withColumn("meets_standards", F.size(fails) == 0))


def interpret(metrics: DataFrame) -> DataFrame:
    """V5: verbal interpretation of correlation, bias and MAPE (the bands of
    K.CORRELATION_BANDS, K.BIAS_BANDS and K.MAPE_BANDS)."""
    c, b, m = F.col("correlation"), F.col("bias"), F.col("mape")
    percent = lambda x: T.round_half(x * 100, 0).cast("long").cast("string")
    factor = T.round_half(1 / b, 1).cast("decimal(20,1)").cast("string")
    over, under = K.BIAS_TEXTS["over"], K.BIAS_TEXTS["under"]
    bias = (F.when(b.between(0.8, 1.2), K.BIAS_TEXTS["fair"])
            .when(b > 1.2, F.concat(F.lit(over[0]), percent(b - 1), F.lit(over[1])))
            .otherwise(F.concat(F.lit(under[0]), percent(1 - b), F.lit(under[1]), factor, F.lit(under[2]))))
    corr = F.coalesce(*[F.when(c > limit, text) for limit, text in K.CORRELATION_BANDS], F.lit(K.CORRELATION_REST))
    mape = F.coalesce(*[F.when(m < limit, text) for limit, text in K.MAPE_BANDS], F.lit(K.MAPE_REST))
    return metrics.select("*", corr.alias("correlation_text"), bias.alias("bias_text"), mape.alias("mape_text"))


def comparison_table(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """V6: per-row error and error %."""
    e = F.col(predicted) - F.col(actual)
    return df.withColumn("error", e).withColumn(
        "error_percent", F.when(F.col(actual) != 0, e / F.col(actual) * 100))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count / mean / std / min / max per column in one aggregation, and the
    exact quartiles, in long form."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").alias(s)
                                                   for s in ("n", "mean", "std", "min", "max")])
            for c in cols]
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("x")).select("x.*")
    q = exact_quantiles(long, "_v", [0.25, 0.5, 0.75], ["_c"])
    return out.join(q, F.col("column") == F.col("_c"), "left").select(
        *out.columns, *[F.get("quantiles", F.lit(k)).alias(n) for k, n in enumerate(("q1", "median", "q3"))])


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one aggregation, as
    rows (feature_a, feature_b, correlation)."""
    x = lambda c: F.col(c).cast("double")
    pairs = [(a, b) for k, a in enumerate(cols) for b in cols[k:]]
    wide = df.agg(*[F.corr(x(a), x(b)).alias(f"{a}|{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}|{b}`").alias("correlation")) for a, b in pairs]
    rows += [F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), F.col(f"`{a}|{b}`").alias("correlation")) for a, b in pairs if a != b]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def target_correlations(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """corr(column, target) for every column, one aggregation, long form."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def right_closed_bins(x: Column, edges=(5.0, 6.0, 7.0), labels=("Simple", "Moderate", "Complex", "Very Complex")) -> Column:
    """D3: right-closed bins (0,5], (5,6], (6,7], (7,∞); null at or below 0."""
    expr = F.when(x <= 0, F.lit(None))
    for e, lbl in zip(edges, labels):
        expr = expr.when(x <= e, lbl)
    return expr.otherwise(F.when(x.isNotNull(), labels[-1]))


def distribution_by(df: DataFrame, key: Column, value: str) -> DataFrame:
    """Box-plot numbers per bin (min, q1, median, q3, max, n)."""
    v = F.col(value).cast("double")
    rows = df.select(key.alias("bin"), v.alias("_v"))
    g = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"))
    q = exact_quantiles(rows, "_v", [0.25, 0.5, 0.75], ["bin"]).select(F.col("bin").alias("_bin"), "quantiles")
    g = g.join(q, g["bin"].eqNullSafe(q["_bin"]), "left")
    return g.select("bin", "n", "min", F.get("quantiles", F.lit(0)).alias("q1"), F.get("quantiles", F.lit(1)).alias("median"),
                    F.get("quantiles", F.lit(2)).alias("q3"), "max")


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between min and max; the last edge is
    closed. Range is a one-row aggregate cross-joined back (broadcast)."""
    v = F.col(value).cast("double")
    rng = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    j = df.crossJoin(F.broadcast(rng))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, 0).otherwise(
        F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return j.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


def group_stats(df: DataFrame, key: str, value: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Mean / std / min / max of ``value`` (and means of ``extra``) per key, round 4."""
    v = F.col(value)
    aggs = [T.round_half(F.avg(v), 4).alias("mean"), T.round_half(F.stddev_samp(v), 4).alias("std"),
            T.round_half(F.min(v), 4).alias("min"), T.round_half(F.max(v), 4).alias("max")]
    aggs += [T.round_half(F.avg(c), 4).alias(name) for name, c in (extra or {}).items()]
    return df.groupBy(key).agg(*aggs)


def median_split(df: DataFrame, split_col: str, value: str, means: tuple[str, ...] = ()) -> DataFrame:
    """Rows above / at-or-below the median of ``split_col``: counts, mean
    ``value``, mean of each of ``means``, and potential savings % (high vs low)."""
    med = exact_quantiles(df, split_col, [0.5]).select(F.get("quantiles", F.lit(0)).alias("_med"))
    j = df.crossJoin(F.broadcast(med))
    hi = F.col(split_col) > F.col("_med")
    r = j.agg(F.sum(hi.cast("long")).alias("high_count"), F.sum((~hi).cast("long")).alias("low_count"),
              F.avg(F.when(hi, F.col(value))).alias("high_mean"),
              F.avg(F.when(~hi, F.col(value))).alias("low_mean"),
              *[F.avg(F.when(side, F.col(c))).alias(f"{name}_{c}") for c in means for name, side in (("high", hi), ("low", ~hi))])
    return r.withColumn("potential_savings_percent",
                        (F.col("high_mean") - F.col("low_mean")) / F.col("high_mean") * 100)


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Counts and share % per value; the total is one row, broadcast."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    total = g.agg(F.sum("count").alias("_total"))
    return (g.crossJoin(F.broadcast(total)).withColumn("share_percent", F.col("count") / F.col("_total") * 100)
            .drop("_total"))


def ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """Min / max of each column in one aggregation."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])
