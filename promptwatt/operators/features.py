"""Parser features (P1–P18) as one projection over a text column.

``features(df, text_col)`` adds one column per feature. Intermediate arrays
(tokens, sentences) are materialised once as columns and dropped at the end;
Catalyst does not collapse a projection whose expensive expression is
referenced several times, so the tokenizer runs once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T

FEATURE_ORDER = (
    "token_count", "word_count", "char_count", "sentence_count",
    "avg_word_length", "avg_sentence_length", "punct_ratio", "stopword_ratio",
    "unique_word_ratio", "vocabulary_richness", "lexical_density",
    "noun_ratio", "verb_ratio", "adj_ratio", "adv_ratio",
)

NOUN_TAGS = ("NN", "NNS", "NNP", "NNPS")
VERB_TAGS = ("VB", "VBD", "VBG", "VBN", "VBP", "VBZ")
ADJ_TAGS = ("JJ", "JJR", "JJS")
ADV_TAGS = ("RB", "RBR", "RBS")

# What ``keep_internals`` keeps: the cleaned text, its word tokens and sentences, the
# words of each sentence, whether the text holds control characters, the text without
# plain words, the distinct word tokens and the length of all.
INTERNALS = ("_clean", "_words", "_sents", "_lens", "_ctrl", "_rest", "_distinct", "_len_sum")


def features(df: DataFrame, text_col: str = "text", *, tags_col: str | None = None,
             token_counter=None, max_tokens: int | None = None,
             keep_internals: bool = False, mode: str = "exact") -> DataFrame:
    """Add P3–P13 feature columns computed from ``text_col``.

    ``token_counter``: optional hook U1 — a Column-returning function of the
    cleaned text (e.g. a pandas_udf around a subword tokenizer). Default is
    the whitespace word count. ``max_tokens`` truncates the count (e.g. 512).
    ``tags_col``: optional ``array<struct<token,tag>>`` of Penn tags (P13).
    ``mode="approx"``: the robust fallback of P18 (tokens ≈ words + 2,
    sentence length = words) used when no parse is wanted.
    """
    t = F.col(text_col)
    odd, ctrl = F.col("_odd"), F.col("_ctrl")
    out = (df.withColumn("_odd", T.is_odd(t))
             .withColumns({"_clean": T.collapse_ws(t, odd), "_ctrl": T.has_control(t, odd), "_rest": T.without_plain_words(t.cast("string"))})
             .withColumn("_clean", T.drop_control(F.col("_clean"), ctrl)).drop("_odd")
             .withColumns({"_words": T.word_tokens("_clean"), "_sents": sentence_list("_clean", ctrl)})
             .withColumn("_lens", sentence_lengths("_sents", ctrl)))
    n = F.size("_words").cast("long")
    # sentences end at white space, so their words are those of the text
    tokens = (token_counter(F.col("_clean")) if token_counter is not None
              else F.aggregate("_lens", F.lit(0).cast("long"), lambda a, x: a + x))
    if max_tokens is not None:
        tokens = F.least(tokens, F.lit(max_tokens))
    stop = T.count_in("_words", K.STOPWORDS)
    distinct = F.size(F.array_distinct("_words")).cast("long")
    out = out.select(
        "*",
        tokens.cast("long").alias("token_count"),
        n.alias("word_count"),
        F.length("_clean").cast("long").alias("char_count"),
        F.greatest(F.size("_sents"), F.lit(1)).cast("long").alias("sentence_count"),
        T.total_length("_words").alias("_len_sum"),
        T.count_regex("_rest", K.PUNCT_CLASS).alias("_punct"),
        stop.alias("_stop"),
        distinct.alias("_distinct"),
    )
    wc = F.col("word_count")
    out = out.select(
        *[c for c in out.columns if c not in ("_punct", "_stop")],
        T.safe_div(F.col("_len_sum"), wc).alias("avg_word_length"),
        (wc / F.col("sentence_count")).alias("avg_sentence_length"),
        T.safe_div(F.col("_punct"), F.col("char_count")).alias("punct_ratio"),
        T.safe_div(F.col("_stop"), wc).alias("stopword_ratio"),
        T.safe_div(F.col("_distinct"), wc).alias("unique_word_ratio"),
        T.safe_div(F.col("_distinct"), wc).alias("vocabulary_richness"),
        T.safe_div(wc - F.col("_stop"), wc).alias("lexical_density"),
        *_pos_ratios(tags_col),
    )
    if mode == "approx":
        out = (out.withColumn("token_count", F.col("word_count") + 2)
                  .withColumn("avg_sentence_length", F.col("word_count").cast("double")))
    if keep_internals:
        return out
    return out.drop(*INTERNALS)


def sentence_list(clean: str, ctrl: Column) -> Column:
    """P2 of the cleaned text; only where control characters were dropped can its
    white space be other than single ' '."""
    return F.when(ctrl, T.sentences(clean, normalized=True)).otherwise(T.even_sentences(clean))


def sentence_lengths(sents: str, ctrl: Column) -> Column:
    """Whitespace words of each sentence of the cleaned text."""
    return (F.when(ctrl, F.transform(sents, lambda s: T.ws_word_count(s, normalized=True)))
            .otherwise(F.transform(sents, lambda s: T.count_sub(s, " ") + F.lit(1).cast("long"))))


def _pos_ratios(tags_col: str | None) -> list[Column]:
    names = ("noun_ratio", "verb_ratio", "adj_ratio", "adv_ratio")
    if tags_col is None:
        return [F.lit(0.0).alias(nm) for nm in names]
    tags = F.transform(F.col(tags_col), lambda s: s["tag"])
    total = F.size(tags)
    cols = []
    for nm, tagset in zip(names, (NOUN_TAGS, VERB_TAGS, ADJ_TAGS, ADV_TAGS)):
        k = T.count_in(tags, tagset)
        cols.append(T.safe_div(k, total).alias(nm))
    return cols


def feature_vector(df: DataFrame, out_col: str = "features_vec") -> DataFrame:
    """The 15 features in fixed order as an MLlib vector."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(FEATURE_ORDER), outputCol=out_col).transform(df)


def legacy_features(df: DataFrame, text_col: str = "text", *, num_layers=24,
                    training_hours=8.0, flops_per_hour=1e11) -> DataFrame:
    """The legacy feature row (whitespace words, punct set '.,!?;:').

    Model parameters may be Python numbers or column names.
    """
    t = F.col(text_col)
    words = T.ws_words(t)
    nw = F.size(words)
    layers = _num(num_layers)
    out = df.withColumn("_w", words).select(
        "*",
        T.ws_word_count(t).alias("token_count"),
        F.length(t).cast("long").alias("char_count"),
        (T.count_regex(t, r"[.,!?;:]") / F.greatest(F.length(t), F.lit(1))).alias("punct_ratio"),
        (T.total_length("_w") / F.greatest(nw, F.lit(1))).alias("avg_word_length"),
        (F.size(F.filter("_w", lambda x: F.lower(x).isin(*K.STOPWORDS)))
         / F.greatest(nw, F.lit(1))).alias("stopword_ratio"),
        layers.cast("long").alias("num_layers"),
        _num(training_hours).cast("double").alias("training_hours"),
        _num(flops_per_hour).cast("double").alias("flops_per_hour"),
        (_num(flops_per_hour) / F.greatest(layers, F.lit(1))).alias("flops_per_layer"),
        (_num(training_hours) / F.greatest(layers, F.lit(1))).alias("training_efficiency"),
    )
    return out.drop("_w")


def notebook_features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """question/exclamation flags and the legacy complexity
    ``len/50 + avg_word_len/5 + words/20`` over whitespace words."""
    t = F.col(text_col)
    words = T.ws_words(t)
    nw = F.size(words)
    return df.withColumn("_w", words).select(
        "*",
        t.contains("?").cast("int").alias("question_mark"),
        t.contains("!").cast("int").alias("exclamation_mark"),
        (F.length(t) / 50 + T.safe_div(T.total_length("_w"), nw) / 5 + nw / 20)
        .alias("legacy_complexity"),
    ).drop("_w")


def _num(v) -> Column:
    return F.col(v) if isinstance(v, str) else F.lit(v)
