"""Registered queries of the hooks and of small operators that others build on.

Bindings: conversations hold the texts to tag and count; templates are filled for
documents, whose category is one of the templates' or, for doc_id % 6 = 5, none;
lineitem stands for a table of features of which a model knows six, one of them
(``l_margin``) missing from the table.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import features as FT
from ..operators import hooks as H
from ..operators import ml as ML
from ..operators import rewrite as RW
from ..session import read_table
from . import sqlgen as S
from .catalog import docs, register
from .catalog_ml import _r

RATIOS = ("noun_ratio", "verb_ratio", "adj_ratio", "adv_ratio")
TAG_SETS = (FT.NOUN_TAGS, FT.VERB_TAGS, FT.ADJ_TAGS, FT.ADV_TAGS)


def turns(spark, sf_dir):
    return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


TURNS_SQL = "SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations"

# Tag ratios ---------------------------------------------------------------
_TAG = "CASE " + " ".join(f"WHEN ends_with(w, {S.s(end)}) THEN {S.s(tag)}" for end, tag in K.SUFFIX_TAGS) + f" ELSE {S.s(K.SUFFIX_REST)} END"
_share = lambda tags: _r(S.safe_div(S.count_in("tags", tags), "len(tags)"))


@register("tag_ratios", S.with_ctes(
    [("src", TURNS_SQL), ("w1", f"SELECT conv_id, turn, role, {S.word_tokens(S.clean('text'))} AS ws FROM src"),
     ("t1", f"SELECT conv_id, turn, role, list_transform(ws, lambda w: {_TAG}) AS tags FROM w1")],
    "SELECT conv_id, turn, role, CAST(len(tags) AS BIGINT) AS word_count, " + ", ".join(f"{_share(x)} AS {n}" for n, x in zip(RATIOS, TAG_SETS)) + " FROM t1"))
def tag_ratios(spark, sf_dir):
    tag = H.tagger(H.suffix_tags)
    d = turns(spark, sf_dir).withColumn("tags", tag(T.word_tokens(T.clean(F.col("text")))))
    out = FT.features(d, "text", tags_col="tags")
    return out.select("conv_id", "turn", "role", "word_count", *[T.round_half(F.col(c), 6).alias(c) for c in RATIOS])


# A token counter -------------------------------------------------------------
@register("subword_counts", S.with_ctes(
    [("src", TURNS_SQL), ("c1", f"SELECT conv_id, turn, role, {S.clean('text')} AS c FROM src")],
    f"""SELECT conv_id, turn, role, CAST(least(512, {K.PIECE_SPECIALS} + coalesce(list_sum(list_transform(string_split(c, ' '),
        lambda w: (length(w) + {K.PIECE_CHARS - 1}) // {K.PIECE_CHARS})), 0)) AS BIGINT) AS token_count FROM c1"""))
def subword_counts(spark, sf_dir):
    out = FT.features(turns(spark, sf_dir), "text", token_counter=H.token_counter(H.piece_counts), max_tokens=512)
    return out.select("conv_id", "turn", "role", "token_count")


# Features without a parse -----------------------------------------------------
@register("fallback_features", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents"), *S.features_ctes("src", "text")],
    f"""SELECT doc_id, word_count + 2 AS token_count, word_count, CAST(word_count AS DOUBLE) AS avg_sentence_length,
        {_r('avg_word_length')} AS avg_word_length, {_r('lexical_density')} AS lexical_density FROM f4"""))
def fallback_features(spark, sf_dir):
    out = FT.features(docs(spark, sf_dir), "text", mode="approx")
    return out.select("doc_id", "token_count", "word_count", "avg_sentence_length", *[T.round_half(F.col(c), 6).alias(c) for c in ("avg_word_length", "lexical_density")])


# The vector of features, in its fixed order ---------------------------------------
_PLACES = [(f"f{k:02d}", c) for k, c in enumerate(FT.FEATURE_ORDER)]


@register("feature_vectors", S.with_ctes(
    [("src", "SELECT doc_id, text FROM documents"), *S.features_ctes("src", "text")],
    "SELECT doc_id, " + ", ".join(f"{_r(f'CAST({c} AS DOUBLE)')} AS {f}" for f, c in _PLACES) + " FROM f4"))
def feature_vectors(spark, sf_dir):
    out = FT.feature_vector(FT.features(docs(spark, sf_dir), "text")).select("doc_id", vector_to_array("features_vec").alias("v"))
    return out.select("doc_id", *[T.round_half(F.col("v")[k], 6).alias(f) for k, (f, _) in enumerate(_PLACES)])


# Numeric columns, aligned to what a model was trained on -------------------------
KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
TRAINED = ("l_tax", "l_margin", "l_quantity", "l_discount", "l_extendedprice")


@register("aligned_features", f"""SELECT l_orderkey, l_linenumber, 4 AS n_numeric, {", ".join(
    f"{S.d(0.0)} AS l_margin" if c == "l_margin" else f"coalesce(CAST({c} AS DOUBLE), {S.d(0.0)}) AS {c}" for c in TRAINED)} FROM lineitem""")
def aligned_features(spark, sf_dir):
    d = read_table(spark, sf_dir, "lineitem")
    names = ML.numeric_columns(d, exclude=KEYS)
    out = ML.align_features(d.select("l_orderkey", "l_linenumber", *names), list(TRAINED))
    return out.withColumn("n_numeric", F.lit(len(names)))


# Templates filled from columns ----------------------------------------------------
CATEGORIES = (*[c for c, _ in K.PROMPT_TEMPLATES], "none")
VALUES = (("topic", "source"), ("item1", "lang"), ("item2", "source"), ("content", "text"), ("items", "lang"))


def _filled(template: str) -> str:
    out = S.s(template)
    for name, column in VALUES:
        out = f"replace({out}, {S.s('{' + name + '}')}, coalesce({column}, ''))"
    return out


@register("filled_templates", f"""SELECT doc_id, category, CASE category {" ".join(f"WHEN {S.s(c)} THEN {_filled(t)}" for c, t in K.PROMPT_TEMPLATES)} END AS prompt
    FROM (SELECT *, {S.str_list(CATEGORIES)}[(doc_id % {len(CATEGORIES)}) + 1] AS category FROM documents)""")
def filled_templates(spark, sf_dir):
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.pmod("doc_id", F.lit(len(CATEGORIES))) + 1).cast("int"))
    values = docs(spark, sf_dir).select("doc_id", category.alias("category"), *[F.col(c).alias(n) for n, c in VALUES])
    return RW.fill_template(RW.templates_table(spark), values).select("doc_id", "category", "prompt")
