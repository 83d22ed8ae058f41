"""Registered queries: each has a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, a DuckDB oracle string over the same tables.

Test bindings (driver tables standing in for the reference's inputs):
documents.text = prompts (doc_id = id, lang, source = category);
conversations with role='user' = chat prompts; events = the energy log
(ts, value = energy, error = anomaly, purchase = optimized, props = model
params, user_id % 5 = region); labels = label subset; embeddings = vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators.complexity import COMPONENTS, complexity
from ..operators.energy import estimate_energy
from ..operators.features import FEATURE_ORDER, features
from ..session import read_table, spread
from . import sqlgen as S
from .analyze import analyze

SparkQuery = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[SparkQuery, str | None]] = {}

# Region binding for prompts: doc_id % 6 over the five known regions and one
# unknown name (exercises the default-factor path).
BOUND_REGIONS = tuple(r for r, _, _ in K.REGION_FACTORS) + ("mars",)
# Threshold used by test queries: the default (-0.5) can never fire.
TEST_THRESHOLD = 0.25


def register(name: str, sql: str | None):
    def deco(fn: SparkQuery) -> SparkQuery:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _region_col(id_col: str):
    arr = F.array(*[F.lit(r) for r in BOUND_REGIONS])
    return F.element_at(arr, (F.pmod(F.col(id_col), F.lit(len(BOUND_REGIONS))) + 1).cast("int"))


def _region_sql(id_col: str) -> str:
    return f"{S.str_list(BOUND_REGIONS)}[({id_col} % {len(BOUND_REGIONS)}) + 1]"


def docs(spark, sf_dir) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


# ---------------------------------------------------------------------------
# Flagship: energy, carbon and cost of prompt traffic per language and level.
# ---------------------------------------------------------------------------

def _flagship_spark(spark, sf_dir):
    scored = analyze(docs(spark, sf_dir), threshold=TEST_THRESHOLD, keep_components=False)
    return (scored.groupBy("lang", "energy_level")
            .agg(F.count(F.lit(1)).alias("prompts"),
                 T.round_half(F.sum("energy_joules"), 4).alias("total_joules"),
                 T.round_half(F.sum("energy_kwh") * 1e6, 4).alias("total_mwh_micro"),
                 T.round_half(F.sum("carbon_footprint_kg") * 1e6, 4).alias("total_carbon_mg"),
                 T.round_half(F.sum("electricity_cost_usd") * 1e6, 4).alias("total_cost_micro_usd"),
                 F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"),
                 # complexity has 4 decimals: average it from an exact integer
                 # sum so the result does not depend on summation order
                 (F.sum(F.floor(F.col("complexity_score") * 10000 + 0.5)) / (F.count(F.lit(1)) * 10000.0))
                 .alias("avg_complexity"),
                 T.round_half(F.avg("token_count"), 4).alias("avg_tokens")))


def _analyze_sql(src: str, text_col: str = "text", region_col: str | None = None,
                 threshold: float = TEST_THRESHOLD, keep_components: bool = False):
    ctes = S.features_ctes(src, text_col, prefix="f", keep_internals=True)
    ctes += S.complexity_ctes("f4", text_col, prefix="x", reuse_internals=True,
                              keep_components=keep_components)
    ctes += [("xd", "SELECT * EXCLUDE (_clean, _words, _sents) FROM x5")]
    ctes += S.energy_ctes("xd", prefix="e", region_col=region_col)
    ctes += S.anomaly_ctes("e2", prefix="a", threshold=threshold, energy_col="energy_kwh")
    return ctes


_FLAGSHIP_SQL = S.with_ctes(
    [("src", "SELECT doc_id, text, lang, source FROM documents")] + _analyze_sql("src"),
    f"""SELECT lang, energy_level, count(*) AS prompts,
        {S.round_half('sum(energy_joules)', 4)} AS total_joules,
        {S.round_half('sum(energy_kwh) * ' + S.d(1e6), 4)} AS total_mwh_micro,
        {S.round_half('sum(carbon_footprint_kg) * ' + S.d(1e6), 4)} AS total_carbon_mg,
        {S.round_half('sum(electricity_cost_usd) * ' + S.d(1e6), 4)} AS total_cost_micro_usd,
        CAST(sum(CAST(is_anomaly AS BIGINT)) AS BIGINT) AS anomalies,
        CAST(sum(floor(complexity_score * {S.d(10000.0)} + {S.d(0.5)})) AS BIGINT) / (count(*) * {S.d(10000.0)}) AS avg_complexity,
        {S.round_half('avg(token_count)', 4)} AS avg_tokens
    FROM a3 GROUP BY lang, energy_level""")

register("energy_by_language", _FLAGSHIP_SQL)(_flagship_spark)


# ---------------------------------------------------------------------------
# Per-prompt features.
# ---------------------------------------------------------------------------

_FEATURE_COLS = [c for c in FEATURE_ORDER if not c.endswith(("noun_ratio", "verb_ratio",
                                                              "adj_ratio", "adv_ratio"))]


@register("prompt_features", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents")] + S.features_ctes("src", "text"),
    f"SELECT doc_id, {', '.join(_FEATURE_COLS)} FROM f4"))
def prompt_features(spark, sf_dir):
    return features(docs(spark, sf_dir).select("doc_id", "text"), "text").select("doc_id", *_FEATURE_COLS)


@register("conversation_features", S.with_ctes(
    [("src", "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'")]
    + S.features_ctes("src", "text"),
    f"SELECT conv_id, turn, {', '.join(_FEATURE_COLS)} FROM f4"))
def conversation_features(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return features(conv.select("conv_id", "turn", "text"), "text").select("conv_id", "turn", *_FEATURE_COLS)


# ---------------------------------------------------------------------------
# Complexity.
# ---------------------------------------------------------------------------

@register("prompt_complexity", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents")] + S.complexity_ctes("src", "text"),
    f"SELECT doc_id, complexity_score, complexity_level, {', '.join(COMPONENTS)} FROM x5"))
def prompt_complexity(spark, sf_dir):
    return (complexity(docs(spark, sf_dir).select("doc_id", "text"), "text")
            .select("doc_id", "complexity_score", "complexity_level", *COMPONENTS))


@register("benchmark_complexity", S.with_ctes(
    [("src", "SELECT item_id, text FROM benchmark")] + S.complexity_ctes("src", "text"),
    f"SELECT item_id, complexity_score, complexity_level, {', '.join(COMPONENTS)} FROM x5"))
def benchmark_complexity(spark, sf_dir):
    return (complexity(read_table(spark, sf_dir, "benchmark").select("item_id", "text"), "text")
            .select("item_id", "complexity_score", "complexity_level", *COMPONENTS))


# ---------------------------------------------------------------------------
# Energy per prompt with regional factors (broadcast join).
# ---------------------------------------------------------------------------

_ENERGY_OUT = ("energy_joules", "energy_kwh", "confidence_score", "carbon_footprint_kg",
               "water_usage_liters", "electricity_cost_usd", "energy_level", "comparison_to_average")


@register("prompt_energy", S.with_ctes(
    [("src", f"SELECT doc_id, text, {_region_sql('doc_id')} AS region FROM documents")]
    + S.features_ctes("src", "text")
    + S.energy_ctes("f4", prefix="e", region_col="region"),
    f"SELECT doc_id, region, token_count, {', '.join(_ENERGY_OUT)} FROM e2"))
def prompt_energy(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "text", _region_col("doc_id").alias("region"))
    return (estimate_energy(features(d, "text"), region_col="region")
            .select("doc_id", "region", "token_count", *_ENERGY_OUT))


# ---------------------------------------------------------------------------
# Rule-based anomaly detection.
# ---------------------------------------------------------------------------

_ANOM_OUT = ("is_anomaly", "anomaly_score", "anomaly_confidence", "anomaly_severity",
             "anomaly_type", "factor_keys", "recommendation")


@register("prompt_anomaly", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents")] + _analyze_sql("src"),
    f"SELECT doc_id, token_count, complexity_score, {', '.join(_ANOM_OUT)} FROM a3"))
def prompt_anomaly(spark, sf_dir):
    return (analyze(docs(spark, sf_dir).select("doc_id", "text"), threshold=TEST_THRESHOLD,
                    keep_components=False)
            .select("doc_id", "token_count", "complexity_score", *_ANOM_OUT))
