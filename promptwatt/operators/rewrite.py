"""Simplification strategies (R12–R15) and their metrics.

``simplify(df, text_col, strategy)`` — ``strategy`` is a name or a column of
names (one operator serves every strategy; CaseWhen evaluates only the branch
a row needs). Without a neural paraphraser (hook U3) the "t5"/"paraphrase"
branches resolve to the aggressive rule chain, as the reference does when its
model is unavailable. A text that duplicate-removal shrinks below 90 % is
replaced by its deduplicated form first (label prefix ``deduplicate+``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rewrite as R
from ..functions import text as T

OUT = ("simplified", "strategy_used", "original_token_count", "simplified_token_count",
       "token_reduction_percent", "estimated_energy_reduction_percent", "semantic_similarity")


ALL_STRATEGIES = ("t5", "paraphrase", "auto", "aggressive", "verbose", "filler", "compress",
                  "truncate", "core")


def against(similarity, text_col: str):
    """Similarity to the text in a column; Jaccard takes its words from the column
    ``{text_col}_words``, so that they are parted once."""
    if similarity is R.jaccard:
        return lambda x: R.jaccard_of_sets(F.col(f"{text_col}_words"), R.word_set(x))
    return lambda x: similarity(F.col(text_col), x)


def _strategy_columns(df: DataFrame, text_col: str, needed, p: str, min_similarity: float,
                      paraphraser=None, similarity=R.jaccard) -> DataFrame:
    """Compute, once per row, the rewritten text of every strategy in
    ``needed`` as column ``{p}_out_{strategy}`` plus its label column
    ``{p}_lab_{strategy}``; stages no strategy needs are not built."""
    needed = set(needed)
    t = F.col(text_col)
    dd, base = f"{p}_dd", f"{p}_base"
    df = R.dedup_content(df, text_col, dd)
    use_dd = F.length(F.col(dd)) < F.length(t) * 0.9
    df = df.withColumn(f"{p}_dup", use_dd)
    df = df.withColumn(base, F.when(F.col(f"{p}_dup"), F.col(dd)).otherwise(t))
    b, dup = F.col(base), F.col(f"{p}_dup")
    same_as_base = against(similarity, base)
    if similarity is R.jaccard:
        df = df.withColumn(f"{base}_words", R.word_set(b))

    def tag(name):
        return F.when(dup, F.lit("deduplicate+" + name)).otherwise(F.lit(name))

    # a base that is the text as it came has that text's duplicate removal
    known = {R.dedup_content: (text_col, dd)}
    if "core" in needed:
        df = R.remove_politeness(df, base, f"{p}_pol")
        known[R.remove_politeness] = (base, f"{p}_pol")
    if needed & {"t5", "paraphrase", "aggressive", "auto"}:
        df = R.aggressive(df, base, f"{p}_agg", known)
        neural = F.col(f"{p}_agg")
        if paraphraser is not None:  # hook U3: text -> array of paraphrases
            df = df.withColumn(f"{p}_par", paraphraser(b))
            neural = F.coalesce(R.best_paraphrase(b, F.col(f"{p}_par"), min_similarity, similarity), neural)
        df = df.withColumn(f"{p}_neural", neural)
    outs: dict[str, tuple[Column, Column]] = {}
    if needed & {"t5", "paraphrase"}:
        for nm in needed & {"t5", "paraphrase"}:
            outs[nm] = (F.col(f"{p}_neural"), F.lit("t5"))
    if "aggressive" in needed:
        outs["aggressive"] = (F.col(f"{p}_agg"), F.lit("aggressive"))
    simple = {"verbose": R.remove_verbose, "filler": R.remove_fillers, "compress": R.compress,
              "truncate": R.truncate}
    for nm, stage in simple.items():
        if nm in needed:
            df = stage(df, base, f"{p}_{nm}")
            outs[nm] = (F.col(f"{p}_{nm}"), tag(nm))
    if "core" in needed:
        df = R.core_question(df, f"{p}_pol", f"{p}_core")
        outs["core"] = (F.col(f"{p}_core"), F.lit("core_extraction"))
    if "auto" in needed:
        df = R.remove_fillers(R.remove_verbose(df, f"{p}_neural", f"{p}_r1"), f"{p}_r1", f"{p}_rr")
        if "verbose" not in needed:
            df = R.remove_verbose(df, base, f"{p}_verbose")
        df = R.compress(R.remove_redundancy(R.remove_fillers(
            df, f"{p}_verbose", f"{p}_q2"), f"{p}_q2", f"{p}_q3"), f"{p}_q3", f"{p}_rules")
        orig_tokens = T.ws_word_count(t)
        nt, rt = T.ws_word_count(F.col(f"{p}_neural")), T.ws_word_count(F.col(f"{p}_rr"))
        rule_ok = (rt < nt) & (same_as_base(F.col(f"{p}_rr")) >= min_similarity)
        neural_ok = (same_as_base(F.col(f"{p}_neural")) >= min_similarity) & (nt < orig_tokens)
        df = df.withColumn(f"{p}_ach", F.when(rule_ok, 1).when(neural_ok, 2).otherwise(3))
        ch = F.col(f"{p}_ach")
        outs["auto"] = (F.when(ch == 1, F.col(f"{p}_rr")).when(ch == 2, F.col(f"{p}_neural"))
                        .otherwise(F.col(f"{p}_rules")),
                        F.when(ch == 1, tag("t5+rules")).when(ch == 2, tag("t5")).otherwise(tag("rules")))
    for nm, (o, lab) in outs.items():
        df = df.withColumn(f"{p}_out_{nm}", o).withColumn(f"{p}_lab_{nm}", lab)
    return df


def _metrics(text: Column, out: Column, label: Column, similar) -> list[Column]:
    ot, nt = word_count(text), word_count(out)
    red = F.when(ot > 0, (ot - nt) / ot * 100).otherwise(F.lit(0.0))
    return [R._strip_ws(out), label, ot, nt, T.round_half(red, 2), T.round_half(red * 0.8, 2),
            T.round_half(similar(out), 4)]


def word_count(c: Column) -> Column:
    """T.ws_word_count, from the words that a word set is made of."""
    return F.size(T.ws_words(F.lower(c))).cast("long")


def simplify(df: DataFrame, text_col: str = "text", strategy: str = "auto", *,
             min_similarity: float = K.SIMPLIFIER_MIN_SIMILARITY, prefix: str = "",
             paraphraser=None, similarity=R.jaccard) -> DataFrame:
    """Add the R12/R13 columns (optionally name-prefixed) for one strategy:
    simplified, strategy_used, original/simplified token counts, token and
    estimated energy reduction (0.8 × tokens) in %, Jaccard similarity to the
    (deduplicated) input. ``paraphraser``: hook U3, a Column function from a
    text to an array of paraphrases, accepted by R.best_paraphrase, else the
    aggressive chain. ``similarity``: hook U2, a Column function of two texts,
    for instance a cosine of embeddings."""
    if strategy not in ALL_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    p = f"{prefix}_sx"
    df = _strategy_columns(df, text_col, {strategy}, p, min_similarity, paraphraser, similarity)
    vals = _metrics(F.col(text_col), F.col(f"{p}_out_{strategy}"), F.col(f"{p}_lab_{strategy}"),
                    against(similarity, f"{p}_base"))
    keep = [c for c in df.columns if not c.startswith(p)]
    return df.select(*keep, *[v.alias(prefix + nm) for v, nm in zip(vals, OUT)])


def alternatives(df: DataFrame, id_col: str, text_col: str = "text", *,
                 min_similarity: float = K.SIMPLIFIER_MIN_SIMILARITY, paraphraser=None,
                 similarity=R.jaccard) -> DataFrame:
    """Every strategy per prompt; keep results that differ from the text,
    are not a repeat of an earlier strategy's result and reach the similarity
    threshold; order by estimated energy reduction (ties keep strategy order).
    One row per kept alternative with ``alt_rank``. Each rewrite stage runs
    once per prompt, and filtering, dedup and ordering happen inside the
    prompt's own array — no shuffle."""
    p = "_alt"
    strategies = K.SIMPLIFY_STRATEGIES
    df = _strategy_columns(df.select(id_col, text_col), text_col, set(strategies), p,
                           min_similarity, paraphraser, similarity)
    t, similar = F.col(text_col), against(similarity, f"{p}_base")
    # the metrics are columns of their own, in which a text is parted once; structs and lambdas only read them
    of = lambda i: {o: F.col(f"{p}_{o}_{i}") for o in OUT}
    df = df.select(id_col, text_col, *[v.alias(f"{p}_{o}_{i}") for i, nm in enumerate(strategies) for v, o in zip(
        _metrics(t, F.col(f"{p}_out_{nm}"), F.col(f"{p}_lab_{nm}"), similar), OUT)])
    kept = [F.when((of(i)["simplified"] != t) & (of(i)["semantic_similarity"] >= min_similarity),
                   F.struct(F.lit(i).alias("strategy_rank"), *[v.alias(o) for o, v in of(i).items()])) for i in range(len(strategies))]
    ok = F.filter(F.array(*kept), lambda a: a.isNotNull())
    df = df.withColumn("_ok", ok)
    uniq = F.filter("_ok", lambda a, i: F.array_position(
        F.transform(F.col("_ok"), lambda b: b["simplified"]), a["simplified"]) == i + 1)
    ordered = F.array_sort(uniq, lambda a, b: F.when(
        a["estimated_energy_reduction_percent"] > b["estimated_energy_reduction_percent"], -1)
        .when(a["estimated_energy_reduction_percent"] < b["estimated_energy_reduction_percent"], 1)
        .otherwise(a["strategy_rank"] - b["strategy_rank"]))
    return (df.select(id_col, F.posexplode(ordered).alias("alt_rank", "a"))
            .select(id_col, (F.col("alt_rank") + 1).alias("alt_rank"), "a.*").drop("strategy_rank"))


def fill_template(templates: DataFrame, values: DataFrame, key: str = "category") -> DataFrame:
    """Fill ``{placeholder}`` templates from columns of ``values`` joined
    on ``key``; Catalyst picks the join by the templates' size."""
    joined = values.join(templates, key, "left")
    out = F.col("template")
    for ph in ("topic", "item1", "item2", "content", "items"):
        if ph in values.columns:
            out = F.replace(out, F.lit("{" + ph + "}"), F.coalesce(F.col(ph), F.lit("")))
    return joined.withColumn("prompt", out)


def templates_table(spark) -> DataFrame:
    return spark.createDataFrame(list(K.PROMPT_TEMPLATES), "category string, template string")
