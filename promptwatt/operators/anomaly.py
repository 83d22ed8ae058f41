"""Anomaly detection: rule scoring (A1–A7), fences (A8–A9), training
metrics (A12). The isolation forest (A10) lives in ``isolation.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from .quantiles import exact_quantiles

SEVERITIES = ("normal", "low", "medium", "high", "critical")
TYPES = ("normal", "high_tokens", "high_complexity", "unusual_pattern")


def anomaly_features(df: DataFrame, *, energy_col: str | None = None) -> DataFrame:
    """A1: derived ratios (token/word, complexity per 1000 chars, energy/token)."""
    out = df.select(
        "*",
        (F.col("token_count") / F.greatest(F.col("word_count"), F.lit(1))).alias("token_to_word_ratio"),
        (F.col("complexity_score") / F.greatest(F.col("char_count"), F.lit(1)) * 1000)
        .alias("complexity_to_length_ratio"),
    )
    if energy_col is not None:
        out = out.withColumn("energy_per_token",
                             F.col(energy_col) / F.greatest(F.col("token_count"), F.lit(1)))
    return out


def detect(df: DataFrame, *, threshold: float = K.ANOMALY_THRESHOLD,
           energy_col: str | None = None, keep_features: bool = False) -> DataFrame:
    """Rule-based detection over a table of parsed, scored prompts.

    Needs token_count, word_count, char_count, complexity_score. Adds
    is_anomaly, anomaly_score, anomaly_confidence, anomaly_severity,
    anomaly_type, contributing_factors (map) and recommendation.

    The score is summed in integer hundredths so the threshold comparison
    has no floating-point ties. With the default threshold (-0.5) no prompt
    can be flagged (the lowest reachable score is -0.3).
    """
    staged = anomaly_features(df, energy_col=energy_col)
    tok, cx = F.col("token_count"), F.col("complexity_score")
    ttw, ctl = F.col("token_to_word_ratio"), F.col("complexity_to_length_ratio")
    hundredths = (F.lit(50)
                  - F.when(tok > 400, 30).otherwise(0)
                  - F.when(cx > 0.7, 20).otherwise(0)
                  - F.when(ttw > 1.8, 15).otherwise(0)
                  - F.when(ctl > 0.8, 15).otherwise(0))
    limit = int(round(threshold * 100))
    staged = staged.withColumn("_h", hundredths)
    h = F.col("_h")
    is_anom = h < limit
    score = (h / F.lit(100.0))
    severity = severity_band(h, is_anom)
    atype = (F.when(~is_anom, "normal").when(tok > 500, "high_tokens")
             .when(cx > 0.8, "high_complexity").otherwise("unusual_pattern"))
    ept = F.col("energy_per_token") if energy_col is not None else F.lit(0.0)
    conds = (cx > 0.8, tok > 500, ttw > 2.0, ept > 0.01, ctl > 1.0)
    keys = F.filter(F.array(*[F.when(cond, F.lit(name)) for cond, (name, _) in
                              zip(conds, K.ANOMALY_FACTORS)]), lambda x: x.isNotNull())
    texts = dict(K.ANOMALY_FACTORS)
    texts[K.ANOMALY_GENERAL_FACTOR[0]] = K.ANOMALY_GENERAL_FACTOR[1]
    text_map = F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])
    keys = F.when(~is_anom, F.array().cast("array<string>")).when(
        F.size(keys) == 0, F.array(F.lit(K.ANOMALY_GENERAL_FACTOR[0]))).otherwise(keys)
    staged = staged.withColumn("_sev", severity).withColumn("_type", atype).withColumn("_keys", keys)
    rec_map = F.create_map(*[F.lit(x) for kv in K.ANOMALY_RECOMMENDATION.items() for x in kv])
    rec = F.concat(rec_map[F.col("_type")],
                   F.when(F.col("_sev").isin("high", "critical"),
                          F.lit(K.ANOMALY_SEVERE_SUFFIX)).otherwise(F.lit("")))
    out = staged.select(
        *[c for c in staged.columns if not c.startswith("_")],
        is_anom.alias("is_anomaly"),
        score.alias("anomaly_score"),
        F.least(F.abs(score), F.lit(1.0)).alias("anomaly_confidence"),
        F.col("_sev").alias("anomaly_severity"),
        F.col("_type").alias("anomaly_type"),
        F.map_from_arrays(F.col("_keys"), F.transform("_keys", lambda k: text_map[k]))
        .alias("contributing_factors"),
        F.array_join("_keys", ",").alias("factor_keys"),
        rec.alias("recommendation"),
    )
    if not keep_features:
        out = out.drop("token_to_word_ratio", "complexity_to_length_ratio",
                       *(["energy_per_token"] if energy_col is not None else []))
    return out


def severity_band(hundredths: Column, is_anomaly: Column) -> Column:
    """A3: severity of an anomaly score in hundredths (K.SEVERITY_LEVELS);
    scores that are no anomaly are normal."""
    bands = F.coalesce(*[F.when(hundredths < int(round(limit * 100)), name) for limit, name in K.SEVERITY_LEVELS], F.lit("normal"))
    return F.when(~is_anomaly, "normal").otherwise(bands)


def anomaly_statistics(detected: DataFrame) -> DataFrame:
    """One row — totals, rate, severity and type counts (zero-filled),
    average/min/max score. One aggregation pass."""
    sev = F.col("anomaly_severity")
    aggs = [F.count(F.lit(1)).alias("total_analyzed"),
            F.sum(F.col("is_anomaly").cast("long")).alias("total_anomalies")]
    aggs += [F.sum((sev == s).cast("long")).alias(f"severity_{s}") for s in SEVERITIES]
    aggs += [F.sum((F.col("anomaly_type") == t).cast("long")).alias(f"type_{t}") for t in TYPES]
    aggs += [F.avg("anomaly_score").alias("average_anomaly_score"),
             F.min("anomaly_score").alias("min_score"), F.max("anomaly_score").alias("max_score")]
    out = detected.agg(*aggs)
    return out.withColumn("anomaly_rate", F.col("total_anomalies") / F.col("total_analyzed"))


def feature_statistics(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample std, exact q1, q3 and IQR per feature, one row each."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols])).alias("s")).select("s.*")
    base = long.groupBy("feature").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"))
    q = exact_quantiles(long, "x", [0.25, 0.75], ["feature"])
    return (base.join(q, "feature", "left")
                .select("feature", "mean", "std", F.get("quantiles", F.lit(0)).alias("q1"), F.get("quantiles", F.lit(1)).alias("q3"))
                .withColumn("iqr", F.col("q3") - F.col("q1")))


def fence_flags(df: DataFrame, stats: DataFrame, cols: list[str], *, k: float = 1.5,
                z: float = 3.0) -> DataFrame:
    """IQR-fence and z-score outlier flags from A8's statistics.

    The statistics table has one row per feature (bounded by the number of
    columns), pivoted to one row and broadcast-crossjoined — no shuffle of
    ``df``."""
    one = stats.agg(*[F.first(F.when(F.col("feature") == c, F.struct("mean", "std", "q1", "q3", "iqr")),
                              ignorenulls=True).alias(f"_st_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(one))
    flags = []
    for c in cols:
        s = F.col(f"_st_{c}")
        x = F.col(c)
        iqr_out = (x < s["q1"] - k * s["iqr"]) | (x > s["q3"] + k * s["iqr"])
        z_out = F.when(s["std"] > 0, F.abs(x - s["mean"]) / s["std"] > z).otherwise(F.lit(False))
        flags += [iqr_out.alias(f"{c}_iqr_outlier"), z_out.alias(f"{c}_z_outlier")]
    return out.select(*df.columns, *flags)


def training_metrics(scored: DataFrame, score_col: str = "anomaly_score",
                     label_col: str = "is_anomaly") -> DataFrame:
    """N, n anomalies, rate, score mean/std/min/max (population std)."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum(F.col(label_col).cast("long")).alias("n_anomalies_detected"),
        (F.sum(F.col(label_col).cast("long")) / F.count(F.lit(1))).alias("anomaly_rate"),
        F.avg(score_col).alias("mean_score"), F.stddev_pop(score_col).alias("std_score"),
        F.min(score_col).alias("min_score"), F.max(score_col).alias("max_score"))


def severity_order() -> Column:
    return F.create_map(*[x for i, s in enumerate(SEVERITIES) for x in (F.lit(s), F.lit(i))])
