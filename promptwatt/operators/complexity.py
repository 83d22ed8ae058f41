"""Complexity scoring (X1–X8) on the raw text, as column expressions.

Five components in [0, 1], each a weighted sum of clipped terms, combined with
configurable weights. Reported components and the overall score are rounded to
4 digits (half up); the level is taken from the unrounded overall score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T

COMPONENTS = ("sentence_complexity", "vocabulary_complexity", "syntactic_complexity",
              "semantic_density", "structural_complexity")

# Runs on norm_ws(text), where Java's \s is the full whitespace class; nothing is gone
# over twice, however long a word is.
_CAPITALIZED = r"(?=\p{Lu})(?<!\S)\p{Lu}[^\p{Lu}\p{Lt}\p{Ll}\s]*+\p{Ll}[^\p{Lu}\p{Lt}\s]*+(?!\S)"
# Section marks: runs of '#', and numbers or letters where a line begins. A '#' can't
# be part of the latter, so both are counted alone; each starts at a fixed character.
_HASHES = f"#+[{K.WS}]"
_LINE_MARKS = r"\n(?:\p{Nd}+\.|[a-z]\))"


def _clip(c: Column) -> Column:
    return F.least(c, F.lit(1.0))


def complexity(df: DataFrame, text_col: str = "text", *, weights=None,
               parsed: bool = False, keep_components: bool = True) -> DataFrame:
    """Add ``complexity_score``, ``complexity_level`` and the five components.

    ``parsed``: df holds the internals of :func:`features` for the same text. Word
    tokens, sentences and what was counted in them are reused unless the raw text
    holds a non-whitespace control character; only then can those of the raw text
    differ from those of the cleaned text.
    """
    w = tuple(weights) if weights is not None else K.COMPLEXITY_WEIGHTS
    raw = F.col(text_col).cast("string")
    raw = F.coalesce(raw, F.lit(""))
    staged = df.withColumn("_raw", raw)
    raw, rest = F.col("_raw"), F.col("_rt")

    def reuse(mine: Column, theirs: str) -> Column:
        return F.when(F.coalesce(F.col("_ctrl"), F.lit(False)), mine).otherwise(F.col(theirs)) if parsed else mine

    staged = staged.withColumns({
        "_rt": F.coalesce(F.col("_rest") if parsed else T.without_plain_words(raw), F.lit("")),
        "_lower": F.lower(raw), "_rw": reuse(T.word_tokens(raw), "_words"),
        "_rs": reuse(T.sentences(T.norm_ws(raw), normalized=True), "_sents")})
    staged = staged.withColumn("_rl", reuse(F.transform("_rs", lambda s: T.ws_word_count(s, normalized=True)), "_lens"))
    lower = F.col("_lower")
    zero = F.lit(0).cast("long")
    stats = staged.select(
        "*",
        F.size("_rs").cast("long").alias("_ns"),
        F.aggregate("_rl", zero, lambda a, x: a + x).alias("_s1"),
        F.aggregate("_rl", zero, lambda a, x: a + x * x).alias("_s2"),
        (T.count_regex(rest, "[,;]") + T.count_regex(lower, " and ")
         + T.count_regex(lower, " but ")).alias("_clauses"),
        F.size("_rw").cast("long").alias("_n"),
        reuse(F.size(F.array_distinct("_rw")).cast("long"), "_distinct").alias("_rd"),
        reuse(T.total_length("_rw"), "_len_sum").alias("_lensum"),
        T.count_in("_rw", K.TECHNICAL_TERMS).alias("_tech"),
        F.size(F.filter("_rw", lambda x: F.length(x) > 8)).cast("long").alias("_long"),
        T.count_regex(rest, r"[(\[{]").alias("_parens"),
        T.count_chars(rest, "?").alias("_q"),
        _sum_flags([T.contains_word(lower, x) for x in K.REASONING_WORDS]).alias("_qw"),
        _sum_flags([T.contains_word(lower, x) for x in K.CONDITIONAL_MARKERS]).alias("_cond"),
        (T.count_regex(rest, "[:•-]") + T.count_regex(rest, r"\p{Nd}+\.")).alias("_list"),
        T.count_sub(raw, " ").alias("_spaces"),
        T.count_regex(T.norm_ws(rest), _CAPITALIZED).alias("_caps"),
        T.count_regex(rest, r"\p{Nd}+").alias("_nums"),
        F.length(raw).cast("long").alias("_chars"),
        T.count_sub(rest, "\n\n").alias("_paras"),
        (T.count_sub(rest, "```") + T.count_regex(rest, "[`\"']")).alias("_fmt"),
        (T.count_regex(rest, _HASHES) + T.count_regex(F.concat(F.lit("\n"), rest), _LINE_MARKS)).alias("_sections"),
    )
    c = F.col
    ns, n = c("_ns"), c("_n")
    avg_len = c("_s1") / ns
    var = (ns * c("_s2") - c("_s1") * c("_s1")) / (ns * ns)
    sentence = F.when(ns == 0, F.lit(0.0)).otherwise(
        F.lit(0.4) * _clip(avg_len / 25)
        + F.lit(0.3) * F.when(ns > 1, _clip(F.sqrt(var) / 10)).otherwise(F.lit(0.0))
        + F.lit(0.3) * _clip(c("_clauses") / (ns * 3)))
    vocabulary = F.when(n == 0, F.lit(0.0)).otherwise(
        F.lit(0.25) * (c("_rd") / n)
        + F.lit(0.25) * _clip((c("_lensum") / n) / 10)
        + F.lit(0.30) * _clip(c("_tech") / n * 10)
        + F.lit(0.20) * _clip(c("_long") / n * 3))
    syntactic = (F.lit(0.25) * _clip(c("_parens") / 5)
                 + F.lit(0.30) * _clip((c("_q") + c("_qw")) / 5)
                 + F.lit(0.25) * _clip(c("_cond") / 3)
                 + F.lit(0.20) * _clip(c("_list") / 5))
    nonspace = c("_chars") - c("_spaces")
    semantic = F.when((n == 0) | (nonspace == 0), F.lit(0.0)).otherwise(
        F.lit(0.30) * _clip(c("_rd") / nonspace * 50)
        + F.lit(0.20) * _clip(c("_caps") / n * 5)
        + F.lit(0.20) * _clip(c("_nums") / n * 10)
        + F.lit(0.30) * _clip(c("_tech") / n * 8))
    structural = (F.lit(0.35) * _clip(c("_chars") / 2000)
                  + F.lit(0.20) * _clip((c("_paras") + 1) / 5)
                  + F.lit(0.20) * _clip(c("_fmt") / 10)
                  + F.lit(0.25) * _clip(c("_sections") / 5))
    tmp = [x for x in stats.columns if x.startswith("_") and x not in df.columns]
    scored = stats.select(
        "*",
        sentence.alias("_c1"), vocabulary.alias("_c2"), syntactic.alias("_c3"),
        semantic.alias("_c4"), structural.alias("_c5"),
    )
    overall = (F.lit(w[0]) * c("_c1") + F.lit(w[1]) * c("_c2") + F.lit(w[2]) * c("_c3")
               + F.lit(w[3]) * c("_c4") + F.lit(w[4]) * c("_c5"))
    comp_cols = ([T.round_half(c(f"_c{i + 1}"), 4).alias(nm) for i, nm in enumerate(COMPONENTS)]
                 if keep_components else [])
    out = scored.select(
        "*",
        T.round_half(overall, 4).alias("complexity_score"),
        T.bucketize(overall, K.COMPLEXITY_LEVELS, K.COMPLEXITY_TOP_LEVEL).alias("complexity_level"),
        *comp_cols,
    )
    return out.drop(*tmp, "_c1", "_c2", "_c3", "_c4", "_c5")


def _sum_flags(flags: list[Column]) -> Column:
    total = None
    for f in flags:
        term = f.cast("long")
        total = term if total is None else total + term
    return total


def complexity_impact(level: Column) -> Column:
    """The impact sentence for a level."""
    m = F.create_map(*[F.lit(x) for kv in K.COMPLEXITY_IMPACT.items() for x in kv])
    return m[level]


def color_band(score: Column, bounds=((0.4, "green"), (0.7, "yellow")), top="red") -> Column:
    """UI colour bands (<0.4 / <0.7), or any other bounds."""
    return T.bucketize(score, bounds, top)
