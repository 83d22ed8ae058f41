"""The analyze pipeline: features → complexity → energy → anomaly, one lazy
plan with the tokenizer run once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as K
from ..operators.anomaly import detect
from ..operators.complexity import complexity
from ..operators.energy import estimate_energy
from ..operators.features import INTERNALS, features


def analyze(df: DataFrame, text_col: str = "text", *, region_col: str | None = None,
            region: str = K.DEFAULT_REGION, threshold: float = K.ANOMALY_THRESHOLD,
            energy_kwargs: dict | None = None, keep_components: bool = True) -> DataFrame:
    staged = features(df, text_col, keep_internals=True)
    staged = complexity(staged, text_col, parsed=True, keep_components=keep_components)
    staged = staged.drop(*INTERNALS)
    staged = estimate_energy(staged, region_col=region_col, region=region, **(energy_kwargs or {}))
    return detect(staged, threshold=threshold, energy_col="energy_kwh")
