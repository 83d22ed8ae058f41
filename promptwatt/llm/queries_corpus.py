"""Registered queries of the corpus-wide operators (2, 4 to 7) and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, mixing, quality_classifier, suffix_tree, token_file
from .common import table


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op2_lm_scoring": (op2_lm_scoring, None), "op4_quality_classifier": (op4_quality_classifier, None), "op5_decontamination": (op5_decontamination, None), "op6_mixing": (op6_mixing, None), "op7_token_output": (op7_token_output, None)}
