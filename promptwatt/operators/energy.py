"""Energy and impact estimation.

``estimate_energy`` chains: base model (linear calibration E1 by default, or
the formula E2, or a fitted MLlib model) → token scaling E3 → model-config
scaling E4 → floor E5 → kWh → carbon / water / cost by region E6–E7 →
level E9 → comparison to baseline E8. Region factors come from a broadcast
left join to a small factors table (unknown region → default factors).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T


def region_factors(spark: SparkSession) -> DataFrame:
    """The built-in 5-row factors table (region, cost_per_kwh, kg_per_kwh)."""
    return spark.createDataFrame(list(K.REGION_FACTORS),
                                 "region string, cost_per_kwh double, kg_per_kwh double")


def config_scale(num_layers=K.BASELINE_LAYERS, training_hours=K.BASELINE_TRAINING_HOURS,
                 flops_per_hour=K.BASELINE_FLOPS):
    """E4 factor; a Python float for numeric inputs, a Column otherwise."""
    if all(isinstance(v, (int, float)) for v in (num_layers, training_hours, flops_per_hour)):
        layer = math.sqrt(num_layers / K.BASELINE_LAYERS)
        train = math.log10(training_hours + 1) / math.log10(K.BASELINE_TRAINING_HOURS + 1)
        flops = math.log10(flops_per_hour + 1) / math.log10(K.BASELINE_FLOPS + 1)
        f = (layer ** 0.4) * (train ** 0.2) * (flops ** 0.4)
        return max(K.CONFIG_SCALE_MIN, min(K.CONFIG_SCALE_MAX, f))
    L, h, fl = (_num(v) for v in (num_layers, training_hours, flops_per_hour))
    layer = F.sqrt(L / K.BASELINE_LAYERS)
    train = F.log10(h + 1) / math.log10(K.BASELINE_TRAINING_HOURS + 1)
    flops = F.log10(fl + 1) / math.log10(K.BASELINE_FLOPS + 1)
    f = F.pow(layer, 0.4) * F.pow(train, 0.2) * F.pow(flops, 0.4)
    return F.greatest(F.lit(K.CONFIG_SCALE_MIN), F.least(F.lit(K.CONFIG_SCALE_MAX), f))


def token_scale(joules: Column, tokens: Column) -> Column:
    """Beyond 25 tokens multiply by min(sqrt(tokens/15), 10)."""
    factor = F.least(F.sqrt(tokens / K.TOKEN_SCALING_BASELINE), F.lit(K.TOKEN_SCALING_CAP))
    return F.when(tokens <= K.TOKEN_SCALING_MAX_TOKENS, joules).otherwise(joules * factor)


def calibrated_joules(tokens: Column, intercept: float = K.CALIBRATION_INTERCEPT,
                      slope: float = K.CALIBRATION_SLOPE) -> Column:
    """E_J = intercept + slope * tokens."""
    return F.lit(intercept) + F.lit(slope) * tokens


def formula_joules(tokens: Column, complexity: Column, num_layers=K.BASELINE_LAYERS,
                   flops_per_hour=K.BASELINE_FLOPS, noise_seed: int | None = None) -> Column:
    """(0.1 + 0.002·tok + 0.5·cx + 0.01·layers + 0.05·log10(flops+1))·PUE,
    floor 0.001; Gaussian noise (sd 0.02) only when a seed is given."""
    total = (F.lit(0.1) + tokens * 0.002 + complexity * 0.5 + _num(num_layers) * 0.01
             + F.log10(_num(flops_per_hour) + 1) * 0.05) * K.PUE
    if noise_seed is not None:
        total = total + F.randn(noise_seed) * 0.02
    return F.greatest(F.lit(0.001), total)


def estimate_energy(df: DataFrame, *, tokens_col: str = "token_count",
                    complexity_col: str = "complexity_score", region_col: str | None = None,
                    region: str = K.DEFAULT_REGION, num_layers=K.BASELINE_LAYERS,
                    training_hours=K.BASELINE_TRAINING_HOURS, flops_per_hour=K.BASELINE_FLOPS,
                    model: str = "linear", calibration: tuple[float, float] | None = None,
                    base_col: str | None = None, factors: DataFrame | None = None,
                    noise_seed: int | None = None) -> DataFrame:
    """Add energy_joules, energy_kwh, carbon_footprint_kg, water_usage_liters,
    electricity_cost_usd, energy_level, comparison_to_average, confidence_score.

    ``model``: "linear" (E1 with ``calibration`` = (intercept, slope)),
    "formula" (E2) or "column" (base Joules already in ``base_col``, e.g. the
    prediction of an MLlib model — confidence then ``K.CONFIDENCE['gbt']``).
    Model-config parameters are numbers or column names.
    """
    tok = F.col(tokens_col).cast("double")
    if model == "formula":
        joules = formula_joules(tok, F.col(complexity_col), num_layers, flops_per_hour, noise_seed)
        conf = K.CONFIDENCE["formula"]
    else:
        if model == "column":
            base = F.col(base_col)
            conf = K.CONFIDENCE["gbt"]
        else:
            a, b = calibration or (K.CALIBRATION_INTERCEPT, K.CALIBRATION_SLOPE)
            base = calibrated_joules(tok, a, b)
            conf = K.CONFIDENCE["linear"]
        scale = config_scale(num_layers, training_hours, flops_per_hour)
        scale = F.lit(scale) if isinstance(scale, float) else scale
        joules = token_scale(base, tok) * scale
    joules = F.greatest(F.lit(K.MIN_JOULES), joules)
    out = df.withColumn("_j", joules)
    if region_col is None:
        cost, kg = _factor_literals(region)
        out = out.withColumn("_cost", F.lit(cost)).withColumn("_kg", F.lit(kg))
    else:
        spark = df.sparkSession
        fac = factors if factors is not None else region_factors(spark)
        fac = fac.select(F.col("region").alias("_region_key"),
                         F.col("cost_per_kwh").alias("_cost"), F.col("kg_per_kwh").alias("_kg"))
        fac = F.broadcast(fac) if factors is None else fac  # five rows, or Catalyst's choice by bytes
        out = (out.join(fac, out[region_col] == fac["_region_key"], "left")
                  .drop("_region_key")
                  .withColumn("_cost", F.coalesce("_cost", F.lit(K.DEFAULT_COST_PER_KWH)))
                  .withColumn("_kg", F.coalesce("_kg", F.lit(K.DEFAULT_CARBON_KG_PER_KWH))))
    j = F.col("_j")
    kwh = j / K.JOULES_PER_KWH
    out = out.select(
        *[c for c in out.columns if c not in ("_j", "_cost", "_kg")],
        T.round_half(j, 4).alias("energy_joules"),
        T.round_half(kwh, 10).alias("energy_kwh"),
        F.lit(conf).alias("confidence_score"),
        T.round_half(kwh * F.col("_kg"), 10).alias("carbon_footprint_kg"),
        T.round_half(kwh * K.WATER_L_PER_KWH, 8).alias("water_usage_liters"),
        T.round_half(kwh * F.col("_cost"), 10).alias("electricity_cost_usd"),
        T.bucketize(j, K.ENERGY_LEVELS_J, K.ENERGY_TOP_LEVEL).alias("energy_level"),
        T.round_half((j - K.BASELINE_JOULES) / K.BASELINE_JOULES * 100, 2)
        .alias("comparison_to_average"),
    )
    return out


def _factor_literals(region: str) -> tuple[float, float]:
    for name, cost, kg in K.REGION_FACTORS:
        if name == region:
            return cost, kg
    return K.DEFAULT_COST_PER_KWH, K.DEFAULT_CARBON_KG_PER_KWH


def legacy_level(kwh: Column) -> Column:
    """Legacy kWh bands 0.5 / 1.0 / 2.0."""
    return T.bucketize(kwh, K.LEGACY_LEVELS_KWH, "very_high")


def measured_energy(df: DataFrame, duration_col: str = "duration_seconds") -> DataFrame:
    """Energy from a timed run at 25 W; carbon at 0.4 kg/kWh."""
    j = F.col(duration_col) * K.MEASURED_WATTS
    return df.select("*", j.alias("energy_joules"),
                     (j / K.JOULES_PER_KWH).alias("energy_kwh"),
                     (j / K.JOULES_PER_KWH * K.MEASURED_KG_PER_KWH).alias("carbon_kg"))


def impact_equivalents(carbon_kg: Column, kwh: Column, saved_kwh: Column | None = None) -> list[Column]:
    """Trees, home-hours, car miles, carbon avoided."""
    cols = [(carbon_kg / K.KG_CO2_PER_TREE_YEAR).alias("trees_equivalent"),
            (kwh / K.HOME_KWH_PER_HOUR).alias("homes_powered_hours"),
            (carbon_kg / K.KG_CO2_PER_CAR_MILE).alias("car_miles_equivalent")]
    if saved_kwh is not None:
        cols.append((saved_kwh * K.DEFAULT_CARBON_KG_PER_KWH).alias("carbon_avoided_kg"))
    return cols


def carbon_views(carbon_kg: Column) -> list[Column]:
    """Carbon in grams and milligrams."""
    return [(carbon_kg * 1000).alias("carbon_g"), (carbon_kg * 1_000_000).alias("carbon_mg")]


def main_contributors(tokens: Column, complexity: Column, num_layers=K.BASELINE_LAYERS,
                      importances: dict[str, float] | None = None) -> Column:
    """Top-5 feature importances when a model provides them, else the
    three raw ratios (tokens/100, complexity, layers/100)."""
    if importances:
        top = sorted(importances.items(), key=lambda kv: kv[1], reverse=True)[:5]
        return F.create_map(*[x for k, v in top for x in (F.lit(k), F.lit(float(v)))])
    return F.create_map(F.lit("token_count"), tokens / 100,
                        F.lit("complexity_score"), complexity.cast("double"),
                        F.lit("num_layers"), _num(num_layers) / 100)


def _num(v) -> Column:
    return F.col(v) if isinstance(v, str) else F.lit(v)
