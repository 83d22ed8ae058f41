"""Energy labels and training-set assembly.

Label formulas are column expressions; their random factors are opt-in and
deterministic (derived from a hash of the row id and a seed, so re-runs and
lost executors reproduce them). Multiplier tables are tiny literal lookups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T


def _lookup(key: Column, table, default: float) -> Column:
    m = F.create_map(*[x for k, v in table for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(m[key], F.lit(default))


def unit_hash(id_col: Column, seed: int, salt: str = "") -> Column:
    """Deterministic U[0, 1) per row: the first 13 hex digits of
    md5(id:seed:salt), which any engine can repeat."""
    key = F.concat_ws(":", id_col.cast("string"), F.lit(str(seed)), F.lit(salt))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def label_a(df: DataFrame, *, category_col: str, id_col: str | None = None,
            noise_seed: int | None = None) -> DataFrame:
    """0.1 + 0.015·tok·(1 + 0.3·cx^1.5)·task·(1 + 0.05(awl − 4))·(1 + 0.1·uwr),
    × U(.92, 1.08) when a seed is given; rounded to 4."""
    tok, cx = F.col("token_count"), F.col("complexity_score")
    mult = _lookup(F.col(category_col), K.TASK_MULTIPLIERS, K.DEFAULT_TASK_MULTIPLIER)
    e = (F.lit(K.LABEL_A_BASE_J) + tok * K.LABEL_A_J_PER_TOKEN
         * (1 + F.pow(cx, 1.5) * K.LABEL_A_COMPLEXITY_MULT) * mult
         * (1 + (F.col("avg_word_length") - 4.0) * 0.05) * (1 + F.col("unique_word_ratio") * 0.1))
    if noise_seed is not None:
        e = e * (0.92 + 0.16 * unit_hash(F.col(id_col), noise_seed, "a"))
    return df.withColumn("energy_joules", T.round_half(e, 4))


def label_b(df: DataFrame, *, category_col: str, intercept: float = K.CALIBRATION_INTERCEPT,
            slope: float = K.CALIBRATION_SLOPE, id_col: str | None = None,
            noise_seed: int | None = None) -> DataFrame:
    """(a + b·tok + 2·cx)·category multiplier (× U(.9, 1.1)), floor 0.5."""
    mult = _lookup(F.col(category_col), K.LABEL_B_CATEGORY_MULTIPLIERS, 1.0)
    e = (F.lit(intercept) + F.col("token_count") * slope
         + F.col("complexity_score") * K.LABEL_B_COMPLEXITY_J) * mult
    if noise_seed is not None:
        e = e * (0.90 + 0.20 * unit_hash(F.col(id_col), noise_seed, "b"))
    return df.withColumn("energy_joules", F.greatest(F.lit(K.LABEL_B_FLOOR_J), e))


def label_c(df: DataFrame, *, intercept: float = K.CALIBRATION_INTERCEPT,
            slope: float = K.CALIBRATION_SLOPE, noise_sd: float = 0.0,
            id_col: str | None = None, noise_seed: int | None = None) -> DataFrame:
    """A + b·tok (+ Gaussian noise of ``noise_sd`` via Box–Muller on two
    row hashes), floor 2."""
    e = F.lit(intercept) + F.col("token_count") * slope
    if noise_seed is not None and noise_sd > 0:
        u1 = F.greatest(unit_hash(F.col(id_col), noise_seed, "c1"), F.lit(1e-12))
        u2 = unit_hash(F.col(id_col), noise_seed, "c2")
        e = e + noise_sd * F.sqrt(-2 * F.log(u1)) * F.cos(2 * math.pi * u2)
    return df.withColumn("energy_joules", F.greatest(F.lit(K.LABEL_C_FLOOR_J), e))


def label_d(df: DataFrame, *, notebook: bool = False, num_layers=K.BASELINE_LAYERS,
            flops_per_hour=K.BASELINE_FLOPS) -> DataFrame:
    """T4: 0.5 + 0.003·tok + 0.10·awl (kWh); notebook variant adds
    0.01·layers + 0.05·log10(flops + 1); floor 0.01."""
    e = F.lit(0.5) + F.col("token_count") * 0.003 + F.col("avg_word_length") * 0.10
    if notebook:
        lay = F.col(num_layers) if isinstance(num_layers, str) else F.lit(num_layers)
        fl = F.col(flops_per_hour) if isinstance(flops_per_hour, str) else F.lit(flops_per_hour)
        e = e + lay * 0.01 + F.log10(fl + 1) * 0.05
    return df.withColumn("energy_kwh", F.greatest(F.lit(0.01), e))


def efficiency_label(energy: Column) -> Column:
    """T5: <3 efficient, <5 moderate, else inefficient."""
    return T.bucketize(energy, K.EFFICIENCY_LABELS, K.EFFICIENCY_TOP_LABEL)


def union_sources(**parts: DataFrame) -> DataFrame:
    """Union by name (missing columns null) with a ``data_source`` tag."""
    out = None
    for name, df in parts.items():
        df = df.withColumn("data_source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def augment(df: DataFrame, *, id_col: str, copies: int = 5, seed: int = 42) -> DataFrame:
    """``copies`` jittered copies per row — tokens ±1 (floor 1), energy
    × U(.97, 1.03) — from hashes of (id, copy), so deterministic."""
    x = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    key = F.concat_ws(":", F.col(id_col).cast("string"), F.col("copy").cast("string"))
    jitter = F.floor(unit_hash(key, seed, "tok") * 3).cast("long") - 1
    scale = 0.97 + 0.06 * unit_hash(key, seed, "e")
    return (x.withColumn("token_count", F.greatest(F.lit(1), F.col("token_count") + jitter))
             .withColumn("energy_joules", F.col("energy_joules") * scale))


def split_flag(id_col: Column, train_percent: int = 80, seed: int = 42) -> Column:
    """Stable 80/20 split on a hash of the id (independent of
    partitioning, unlike randomSplit)."""
    return unit_hash(id_col, seed, "split") < train_percent / 100


def weighted_sample(df: DataFrame, category_col: str, fractions: dict[str, float],
                    id_col: str, seed: int = 42) -> DataFrame:
    """Keep a row with its category's probability, decided by a hash of
    the id (reproducible; equivalent to sampleBy without its RNG)."""
    frac = _lookup(F.col(category_col), tuple(fractions.items()), 0.0)
    return df.filter(unit_hash(F.col(id_col), seed, "w") < frac)


def expand_templates(topics: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """Every topic in every (category, template) of the list, which is an
    argument of the plan: one projection and one explode, no join."""
    each = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(t).alias("template")) for c, t in templates])
    out = topics.withColumn("_t", F.explode(each)).select(*topics.columns, "_t.category", "_t.template")
    return out.withColumn("prompt", F.replace(F.col("template"), F.lit("{topic}"), F.col("topic")))


def flatten_category_map(df: DataFrame, map_col: str) -> DataFrame:
    """``map<category, array<prompt>>`` → (category, prompt) rows."""
    return (df.select(F.explode(map_col).alias("category", "prompts"))
              .select("category", F.explode("prompts").alias("prompt")))
