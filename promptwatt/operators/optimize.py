"""Ranking rewrites by predicted savings.

Candidates (t5, simplify, compress, truncate, combined) are columns of the
prompt's row; prompt and candidates become rows that pass one features →
complexity → energy chain, and one shuffle by row brings them together again,
where they are kept and ranked inside an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rewrite as R
from ..functions import text as T
from .complexity import complexity
from .energy import estimate_energy
from .features import INTERNALS, features
from .rewrite import _strategy_columns, against, simplify, word_count

CANDIDATES = K.OPTIMIZER_STRATEGIES  # t5, simplify, compress, truncate, combined


def score_text(df: DataFrame, col: str, prefix: str, energy_kwargs: dict | None = None,
               keep=("energy_joules", "complexity_score")) -> DataFrame:
    """Energy (J, rounded 4) and complexity (rounded 4) of the text in
    ``col``, added as ``{prefix}_energy`` / ``{prefix}_cx`` (plus any other
    requested outputs as ``{prefix}_{name}``)."""
    before = set(df.columns)
    x = features(df, col, keep_internals=True)
    x = complexity(x, col, parsed=True)
    x = estimate_energy(x.drop(*INTERNALS), **(energy_kwargs or {}))
    new = [c for c in x.columns if c not in before]
    ren = {c: f"{prefix}_{c}" for c in keep}
    ren["energy_joules"] = f"{prefix}_energy"
    ren["complexity_score"] = f"{prefix}_cx"
    x = x.drop(*[c for c in new if c not in ren])
    return x.withColumnsRenamed({k: v for k, v in ren.items() if k in x.columns})


def _percent(c: Column) -> Column:
    return T.round_half(c, 0).cast("long").cast("string")


def candidate_texts(df: DataFrame, text_col: str, *, min_similarity: float,
                    revert: bool = False, paraphraser=None, similarity=R.jaccard) -> DataFrame:
    """O1/O2: the five candidate texts as columns ``_cand_{strategy}``, their
    similarity to the prompt as ``_sim_{strategy}``, and the steps of the simplify
    and combined strategies.

    The simplifier runs with threshold max(0.55, min − 0.10). Combined =
    simplify → truncate → paraphrase, stopping once similarity to the prompt
    drops below ``min_similarity``; ``revert=True`` returns the previous text
    at that point (the documented intent) instead of the failing one."""
    thr = max(0.55, min_similarity - 0.10)
    t = F.col(text_col)
    # t5 / simplify(auto) / compress / truncate share one dedup + one
    # aggressive chain per prompt.
    d = _strategy_columns(df, text_col, {"t5", "auto", "compress", "truncate"}, "_o0", thr, paraphraser, similarity)
    for s in ("t5", "auto", "compress", "truncate"):
        d = d.withColumn(f"_o0_cand_{s}", R._strip_ws(F.col(f"_o0_out_{s}")))
    # combined: rounds 2 and 3 run on the previous round's output
    hooks = dict(min_similarity=thr, paraphraser=paraphraser, similarity=similarity)
    d = simplify(d, "_o0_cand_auto", "truncate", prefix="_o5_", **hooks)
    d = simplify(d, "_o5_simplified", "t5", prefix="_o6_", **hooks)
    c1, c2, c3 = F.col("_o0_cand_auto"), F.col("_o5_simplified"), F.col("_o6_simplified")
    if similarity is R.jaccard:
        d = d.withColumn(f"{text_col}_words", R.word_set(t))
    similar = against(similarity, text_col)
    d = d.withColumns({"_o_s1": similar(c1), "_o_s2": similar(c2)})
    s1, s2 = F.col("_o_s1"), F.col("_o_s2")
    tokens, lab = word_count(t), F.col("_o0_lab_auto")
    reduction = F.when(tokens > 0, (tokens - word_count(F.col("_o0_out_auto"))) / tokens * 100).otherwise(F.lit(0.0))
    steps = F.array(F.concat(F.lit("Applied "), lab, F.lit(" strategy")),
                    F.when(lab.contains("t5"), F.lit(K.SIMPLIFY_STEPS[0])).otherwise(F.lit(K.SIMPLIFY_STEPS[1])),
                    F.concat(F.lit("Achieved "), _percent(T.round_half(reduction, 2)), F.lit("% token reduction")))
    more = lambda ok, name: F.when(ok, F.array(*[F.lit(x) for x in K.STRATEGY_STEPS[name]])).otherwise(F.array().cast("array<string>"))
    all_steps = F.concat(steps, more(s1 >= min_similarity, "truncate"), more((s1 >= min_similarity) & (s2 >= min_similarity), "paraphrase"))
    if revert:
        combined = F.when(s1 < min_similarity, t).when(s2 < min_similarity, c1).otherwise(c3)
        sim_combined = F.when(s1 < min_similarity, similar(t)).when(s2 < min_similarity, s1).otherwise(similar(c3))
    else:
        combined = F.when(s1 < min_similarity, c1).when(s2 < min_similarity, c2).otherwise(c3)
        sim_combined = F.when(s1 < min_similarity, s1).when(s2 < min_similarity, s2).otherwise(similar(c3))
    cands = {"t5": F.col("_o0_cand_t5"), "simplify": c1, "compress": F.col("_o0_cand_compress"), "truncate": F.col("_o0_cand_truncate"), "combined": combined}
    sims = {s: {"simplify": s1, "combined": sim_combined}.get(s, similar(c)) for s, c in cands.items()}
    return d.select(*[c for c in d.columns if not c.startswith("_o") and c != f"{text_col}_words"], *[c.alias(f"_cand_{s}") for s, c in cands.items()],
                    *[c.alias(f"_sim_{s}") for s, c in sims.items()], steps.alias("_steps_simplify"), all_steps.alias("_steps_combined"))


def optimize(df: DataFrame, id_col: str, text_col: str = "text", *,
             strategy: str = "auto", min_similarity: float = K.OPTIMIZER_MIN_SIMILARITY,
             max_alternatives: int | None = None, energy_kwargs: dict | None = None, revert: bool = False,
             paraphraser=None, similarity=R.jaccard) -> DataFrame:
    """One row per prompt with the chosen rewrite, its metrics, the steps
    taken and the ranked alternatives (array of structs, top-k).

    "auto" takes the best alternative, or the combined text if none is kept;
    simplify, compress, truncate and paraphrase take that text, any other name
    the combined one. Five alternatives are listed for "auto", else three."""
    max_alternatives = max_alternatives or (5 if strategy == "auto" else 3)
    d = candidate_texts(df.select(id_col, text_col), text_col, min_similarity=min_similarity,
                        revert=revert, paraphraser=paraphraser, similarity=similarity).withColumnRenamed(text_col, "_t").withColumn("_row", F.monotonically_increasing_id())
    # one scoring chain over a row for each text; the prompt itself comes first
    even = lambda c: F.trim(R._strip_ws(c))
    text = lambda x, sim: F.struct(x.alias("x"), sim.alias("sim"), (even(x) == F.col("_even")).alias("same"))
    d = d.withColumn("_even", even(F.col("_t")))
    texts = F.array(text(F.col("_t"), F.lit(None).cast("double")), *[text(F.col(f"_cand_{s}"), F.col(f"_sim_{s}")) for s in CANDIDATES])
    x = d.select("_row", id_col, "_steps_simplify", "_steps_combined", F.posexplode(texts).alias("_k", "_c"))
    x = score_text(x.select("_row", id_col, "_steps_simplify", "_steps_combined", "_k", F.col("_c")["x"].alias("_x"), F.col("_c")["sim"].alias("sim"), F.col("_c")["same"].alias("same")), "_x", "_s", energy_kwargs)
    x = x.select("_row", id_col, "_steps_simplify", "_steps_combined", F.struct("_k", "_x", F.col("_s_energy").alias("e"), F.col("_s_cx").alias("cx"), "sim", "same").alias("_c"))
    x = x.groupBy("_row").agg(*[F.first(c).alias(c) for c in (id_col, "_steps_simplify", "_steps_combined")], F.array_sort(F.collect_list("_c")).alias("_cs"))
    at = lambda k: F.get("_cs", F.lit(k))
    d = x.select(id_col, "_steps_simplify", "_steps_combined", "_cs", at(0)["_x"].alias(text_col), at(0)["e"].alias("_orig_energy"), at(0)["cx"].alias("_orig_cx"))
    t = F.col(text_col)
    oe, ocx = F.col("_orig_energy"), F.col("_orig_cx")
    names = F.array(*[F.lit(s) for s in CANDIDATES])

    def one(c: Column) -> Column:
        txt, e, cx, sim = c["_x"], c["e"], c["cx"], c["sim"]
        red = F.when(oe > 0, (oe - e) / oe * 100).otherwise(F.lit(0.0))
        cred = F.when(ocx > 0, (ocx - cx) / ocx * 100).otherwise(F.lit(0.0))
        score = F.when(red > 0, F.lit(0.50) * (red / 50) + F.lit(0.25) * sim
                       + F.lit(0.15) * F.greatest(F.lit(0.0), cred / 50)
                       + F.lit(0.10) * F.greatest(F.lit(0.0), 1 - F.length(txt) / F.length(t))
                       ).otherwise(F.lit(0.1) * sim)
        return F.struct(
            (c["_k"] - 1).alias("strategy_rank"), F.get(names, c["_k"] - 1).alias("strategy"), txt.alias("prompt"),
            T.round_half(sim, 4).alias("similarity"), T.round_half(e, 2).alias("energy_joules"),
            T.round_half(red, 2).alias("energy_reduction_percent"),
            T.round_half(cred, 2).alias("complexity_reduction_percent"),
            T.round_half(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4).alias("optimization_score"),
            (~c["same"] & (sim >= min_similarity)).alias("_keep"), e.alias("_e"), cx.alias("_cx"), sim.alias("_sim"))

    d = d.withColumn("_all", F.transform(F.slice("_cs", 2, len(CANDIDATES)), one))
    kept = F.filter("_all", lambda a: a["_keep"])
    ranked = F.array_sort(kept, lambda a, b: F.when(a["optimization_score"] > b["optimization_score"], -1)
                          .when(a["optimization_score"] < b["optimization_score"], 1)
                          .otherwise(a["strategy_rank"] - b["strategy_rank"]))
    d = d.withColumn("_ranked", F.slice(ranked, 1, max_alternatives))
    at_named = {"simplify": "simplify", "compress": "compress", "truncate": "truncate", "paraphrase": "t5"}.get(strategy, "combined")
    named = F.element_at("_all", CANDIDATES.index(at_named) + 1)
    steps = {"simplify": F.col("_steps_simplify"), "combined": F.col("_steps_combined")}.get(
        at_named, F.array(*[F.lit(x) for x in K.STRATEGY_STEPS.get(strategy, ())]))
    used = F.lit(strategy)
    best = named
    if strategy == "auto":
        any_kept = F.size("_ranked") > 0
        best = F.when(any_kept, F.element_at("_ranked", 1)).otherwise(named)
        used = F.when(any_kept, F.get("_ranked", F.lit(0))["strategy"]).otherwise(F.lit("combined"))
        steps = F.when(any_kept, F.array(F.concat(F.lit("Applied "), used, F.lit(" strategy")))).otherwise(steps)
    d = d.withColumn("_best", best).withColumn("_used", used).withColumn("optimization_steps", steps)
    b = F.col("_best")
    saved = oe - b["_e"]
    red = F.when(oe > 0, saved / oe * 100).otherwise(F.lit(0.0))
    cred = F.when(ocx > 0, (ocx - b["_cx"]) / ocx * 100).otherwise(F.lit(0.0))
    overall = (F.lit(0.35) * F.greatest(F.lit(0.0), red / 50) + F.lit(0.35) * b["_sim"]
               + F.lit(0.20) * F.greatest(F.lit(0.0), cred / 50)
               + F.lit(0.10) * F.when(F.length(b["prompt"]) < F.length(t), 1.0).otherwise(0.5))
    alt_fields = ("strategy", "prompt", "similarity", "energy_joules", "energy_reduction_percent",
                  "complexity_reduction_percent", "optimization_score")
    return d.select(
        id_col, t.alias("original_prompt"), b["prompt"].alias("optimized_prompt"),
        T.round_half(oe, 6).alias("original_energy_joules"),
        T.round_half(b["_e"], 6).alias("optimized_energy_joules"),
        T.round_half(F.greatest(F.lit(0.0), saved), 6).alias("energy_saved_joules"),
        T.round_half(F.greatest(F.lit(0.0), red), 2).alias("energy_reduction_percent"),
        T.round_half(b["_sim"], 4).alias("semantic_similarity"),
        T.round_half(F.greatest(F.lit(0.0), cred), 2).alias("complexity_reduction"),
        F.col("_used").alias("strategy_used"), "optimization_steps",
        F.transform("_ranked", lambda a: F.struct(*[a[f] for f in alt_fields])).alias("alternatives"),
        T.round_half(F.greatest(F.lit(0.0), F.least(F.lit(1.0), overall)), 4).alias("optimization_score"))


def ranked_alternatives(optimized: DataFrame, id_col: str) -> DataFrame:
    """O4 as rows: one row per kept alternative with its rank."""
    return (optimized.select(id_col, F.posexplode("alternatives").alias("rank", "a"))
            .select(id_col, (F.col("rank") + 1).alias("rank"), "a.*"))


def suggestions(df: DataFrame) -> DataFrame:
    """Improvement suggestions from features + complexity components
    (needs token_count, word_count, sentence_count, stopword_ratio,
    complexity_score, vocabulary_complexity, sentence_complexity)."""
    msgs = dict(K.SUGGESTIONS)
    arr = F.array(
        F.when(F.col("token_count") > 200,
               F.concat(F.lit(msgs["tokens"].split("{n}")[0]), F.col("token_count").cast("string"),
                        F.lit(msgs["tokens"].split("{n}")[1]))),
        F.when(F.col("complexity_score") > 0.6, F.lit(msgs["complexity"])),
        F.when(F.col("vocabulary_complexity") > 0.5, F.lit(msgs["vocabulary"])),
        F.when(F.col("sentence_complexity") > 0.5, F.lit(msgs["sentence"])),
        F.when(F.col("stopword_ratio") > 0.5, F.lit(msgs["stopwords"])),
        F.when((F.col("sentence_count") == 1) & (F.col("word_count") > 50), F.lit(msgs["single"])))
    got = F.filter(arr, lambda x: x.isNotNull())
    return df.withColumn("suggestions", F.when(F.size(got) > 0, got)
                         .otherwise(F.array(F.lit(K.DEFAULT_SUGGESTION))))


def savings_summary(optimized: DataFrame, by: str | None = "strategy_used") -> DataFrame:
    """Energy before / after and % saved, overall or per strategy."""
    g = optimized.groupBy(by) if by else optimized.groupBy()
    return g.agg(F.count(F.lit(1)).alias("prompts"),
                 T.round_half(F.sum("original_energy_joules"), 4).alias("energy_before_joules"),
                 T.round_half(F.sum("optimized_energy_joules"), 4).alias("energy_after_joules"),
                 T.round_half((F.sum("original_energy_joules") - F.sum("optimized_energy_joules"))
                              / F.sum("original_energy_joules") * 100, 2).alias("percent_saved"),
                 T.round_half(F.avg("energy_reduction_percent"), 2).alias("avg_reduction_percent"))


def compliance_flags(df: DataFrame, *, max_tokens: int = K.RULES_MAX_TOKENS,
                     target_complexity: float = K.RULES_TARGET_COMPLEXITY,
                     target_efficiency: float = K.RULES_TARGET_EFFICIENCY,
                     efficiency_col: str | None = None) -> DataFrame:
    """Rule-config predicates (token budget, complexity target, and an
    efficiency target on a score column when given)."""
    out = df.withColumn("within_token_budget", F.col("token_count") <= max_tokens) \
            .withColumn("within_complexity_target", F.col("complexity_score") <= target_complexity)
    if efficiency_col:
        out = out.withColumn("meets_efficiency_target", F.col(efficiency_col) >= target_efficiency)
    return out
