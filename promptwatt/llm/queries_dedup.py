"""Registered query of SimHash near-dedup (8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table
from .simhash_dedup import near_duplicates


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash_dedup": (op8_simhash_dedup, None)}
