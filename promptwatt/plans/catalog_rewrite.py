"""Registered rewrite, optimizer and similarity queries (R*, O*, M*).

Binding: no driver text contains a verbose phrase, filler, politeness or
question, so every third document gets a fixed lead-in and tail
(``doc_id % 3 = 0``), identically in the oracle SQL; all rows are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rewrite as R
from ..functions import text as T
from ..operators import optimize as O
from ..operators.complexity import complexity
from ..operators.features import INTERNALS, features
from ..operators.rewrite import alternatives
from ..session import read_table, spread
from . import sqlgen as S
from .catalog import register

LEAD, TAIL = "In order to really explain this, ", " Thanks. What is it?"


def prompts(spark, sf_dir) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.when(F.pmod("doc_id", F.lit(3)) == 0,
                  F.concat(F.lit(LEAD), F.col("text"), F.lit(TAIL))).otherwise(F.col("text"))
    return spread(d.select("doc_id", text.alias("text")))


PROMPTS_SQL = (f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN {S.s(LEAD)} || text || {S.s(TAIL)} "
               f"ELSE text END AS text FROM documents")


# R2 ------------------------------------------------------------------------
@register("filler_removal", S.with_ctes([("src", PROMPTS_SQL)], f"""SELECT doc_id,
    array_to_string(list_filter({S.ws_words('text')},
        lambda w: NOT list_contains({S.str_list(K.FILLER_WORDS)}, trim(lower(w), {S.s(K.FILLER_STRIP)}))), ' ')
      AS simplified FROM src"""))
def filler_removal(spark, sf_dir):
    return R.remove_fillers(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


# R4 ------------------------------------------------------------------------
_WSC = f"[{K.WS}]"


@register("compress_rewrite", S.with_ctes([("src", PROMPTS_SQL)], f"""SELECT doc_id,
    trim(regexp_replace(
      regexp_replace(regexp_replace(regexp_replace(text, '\\([^)]*\\)', '', 'g'),
        ',{_WSC}*which{_WSC}+[^,]+,', ',', 'g'), ',{_WSC}*who{_WSC}+[^,]+,', ',', 'g'),
      '{_WSC}+', ' ', 'g')) AS simplified FROM src"""))
def compress_rewrite(spark, sf_dir):
    return R.compress(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


# R7 ------------------------------------------------------------------------
def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{_WSC}+|{_WSC}+$', '', 'g')"


@register("truncate_rewrite", S.with_ctes(
    [("src", PROMPTS_SQL), ("s1", f"SELECT doc_id, text, {S.sentences('text')} AS s FROM src")],
    f"""SELECT doc_id, CASE WHEN len(s) <= 3 THEN text ELSE
        {_strip_sql('s[1]')} || '. ' || {_strip_sql('s[(len(s) // 2) + 1]')} || '. ' || {_strip_sql('s[len(s)]')} || '.'
        END AS simplified FROM s1"""))
def truncate_rewrite(spark, sf_dir):
    return R.truncate(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


# RE2 has no lookaround, so the neighbours of a phrase are groups,
# and each replacement runs twice for phrases that share a neighbour. ------------
_NB = r"[^\p{L}\p{N}_]"


def _bounded_sql(x: str, pattern: str, rep: str) -> str:
    one = lambda y: f"regexp_replace({y}, {S.s(f'(^|{_NB}){pattern}($|{_NB})')}, {S.s(chr(92) + '1' + rep + chr(92) + '2')}, 'g')"
    return one(one(x))


def _verbose_sql(x: str) -> str:
    x = f"lower({x})"
    for phrase, rep in K.VERBOSE_PHRASES:
        x = _bounded_sql(x, re.escape(phrase).replace("\\ ", " ").replace("\\'", "'"), rep)
    first = "CASE WHEN substr(p, 1, 1) = 'ß' THEN 'SS' ELSE upper(substr(p, 1, 1)) END"
    return f"array_to_string(list_transform(string_split({x}, '. '), lambda p: {first} || substr(p, 2)), '. ')"


@register("verbose_rewrite", S.with_ctes([("src", PROMPTS_SQL)], f"SELECT doc_id, {_verbose_sql('text')} AS simplified FROM src"))
def verbose_rewrite(spark, sf_dir):
    return R.remove_verbose(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


def _polite_sql(x: str) -> str:
    for p in K.POLITENESS_PATTERNS:
        p = p.replace(r"\w", r"[\p{L}\p{N}_]")
        inner = p.removeprefix(r"\b")
        head = f"(^|{_NB})" if inner != p else ""
        # a boundary after the phrase is a neighbour, or the tail that the pattern takes itself
        inner = inner.replace(r"\b[,.]?\s*", rf"(?:[,.][{K.WS}]*|[{K.WS}]+|$)").replace(r"\b[^.]*[,.]?\s*", rf"(?:{_NB}[^.]*)?[,.]?[{K.WS}]*").replace(r"\b\s*", rf"(?:[{K.WS}]+|$)")
        one = lambda y, h=head, i=inner: f"regexp_replace({y}, {S.s('(?i)' + h + i)}, {S.s(chr(92) + '1' if h else '')}, 'g')"
        x = one(one(x)) if head else one(x)
    return f"trim(regexp_replace({x}, '{_WSC}+', ' ', 'g'))"


@register("polite_rewrite", S.with_ctes([("src", PROMPTS_SQL)], f"SELECT doc_id, {_polite_sql('text')} AS simplified FROM src"))
def polite_rewrite(spark, sf_dir):
    return R.remove_politeness(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


_CORE = " OR ".join(["contains(z, '?')", *[f"contains(lower(z), {S.s(w)})" for w in K.ACTION_WORDS]])


@register("core_question", S.with_ctes([("src", PROMPTS_SQL), ("s1", f"""SELECT doc_id, text,
    list_transform({S.sentences('text')}, lambda z: {_strip_sql('z')}) AS s FROM src"""),
    ("s2", f"SELECT *, list_filter(s, lambda z: {_CORE}) AS c FROM s1")],
    "SELECT doc_id, CASE WHEN len(c) > 0 THEN array_to_string(c[1:2], ' ') WHEN len(s) > 0 THEN s[1] ELSE text END AS simplified FROM s2"))
def core_question(spark, sf_dir):
    return R.core_question(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


# R5 / R6, R3, R10 -------------------------------------------------------------
def _dedup_ctes(src: str, col: str, dst: str) -> list[tuple[str, str]]:
    """CTEs that add ``dst``, the text of ``col`` without copied content; the
    last one is named like dst."""
    norm = lambda x: f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_ ]', '', 'g'))"
    return [
        (f"{dst}1", f"SELECT *, {S.collapse_ws(col)} AS _n FROM {src}"),
        (f"{dst}2", f"""SELECT *, length(_n) AS _ln, list_filter(list_transform(string_split(_n, '.'), lambda p: trim(p)), lambda p: p <> '') AS _parts,
            {S.sentences('_n')} AS _s FROM {dst}1"""),
        (f"{dst}3", f"SELECT *, list_transform(_parts, lambda p: {norm('p')}) AS _pn, list_transform(_s, lambda p: {norm('p')}) AS _sn FROM {dst}2"),
        (f"{dst}4", f"""SELECT *, CASE WHEN _ln >= 100 AND len(_parts) >= 2 AND len(list_filter(_pn, lambda p: p = _pn[1])) >= len(_parts) * 0.8
                THEN _parts[1] || '.' END AS _pa,
            coalesce(CASE WHEN _ln >= 100 AND instr(substr(_n, 51), substr(_n, 1, 50)) > 0 THEN list_filter(range(50, least(_ln // 2, 499) + 1), lambda z:
                (_ln - length(replace(_n, substr(_n, 1, z), ''))) // z >= 2
                AND ((_ln - length(replace(_n, substr(_n, 1, z), ''))) // z) * z / _ln >= 0.7)[1] END, 0) AS _l,
            list_filter(range(1, len(_s) + 1), lambda i: _sn[i] <> '' AND list_position(_sn, _sn[i]) = i) AS _k FROM {dst}3"""),
        (f"{dst}5", f"""SELECT *, substr(_n, 1, _l) AS _p, array_to_string(list_transform(_k, lambda i: trim(_s[i])), '. ') AS _j FROM {dst}4"""),
        (f"{dst}6", f"""SELECT *, coalesce(_pa, CASE WHEN _l > 0 THEN CASE WHEN contains(_p, '.') AND _l - instr(reverse(_p), '.') + 1 > 20
                THEN trim(substr(_n, 1, _l - instr(reverse(_p), '.') + 1)) ELSE trim(_p) END END) AS _pat FROM {dst}5"""),
        (dst, f"""SELECT * EXCLUDE (_n, _ln, _parts, _s, _pn, _sn, _pa, _l, _k, _p, _j, _pat), CASE WHEN {col} IS NULL OR length({col}) < 20 THEN {col}
            WHEN _pat IS NOT NULL AND _pat <> '' AND length(_pat) < _ln * 0.6 THEN trim(_pat)
            WHEN len(_s) > 1 AND len(_k) < len(_s) THEN CASE WHEN ends_with(_j, '.') THEN _j ELSE _j || '.' END ELSE {col} END AS {dst} FROM {dst}6"""),
    ]


def _redundant_sql(x: str) -> str:
    for phrase, rep in K.REDUNDANT_PAIRS:
        x = _bounded_sql(x, "(?i:" + re.escape(phrase).replace("\\ ", " ") + ")", rep)
    return x


def _filler_sql(x: str) -> str:
    return (f"array_to_string(list_filter({S.ws_words(x)}, lambda w: NOT list_contains({S.str_list(K.FILLER_WORDS)}, "
            f"trim(lower(w), {S.s(K.FILLER_STRIP)}))), ' ')")


def _compress_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\\([^)]*\\)', '', 'g'), "
            f"',{_WSC}*which{_WSC}+[^,]+,', ',', 'g'), ',{_WSC}*who{_WSC}+[^,]+,', ',', 'g'), '{_WSC}+', ' ', 'g'))")


def _core_sql(x: str, words: str) -> str:
    sents = f"list_transform({S.sentences(x)}, lambda z: {_strip_sql('z')})"
    core = f"list_filter({sents}, lambda z: {_CORE})"
    return (f"CASE WHEN {words} <= 30 THEN {x} WHEN len({core}) > 0 THEN array_to_string(({core})[1:2], ' ') "
            f"WHEN len({sents}) > 0 THEN ({sents})[1] ELSE {x} END")


@register("dedup_rewrite", S.with_ctes([("src", PROMPTS_SQL), *_dedup_ctes("src", "text", "deduplicated")],
                                       "SELECT doc_id, length(deduplicated) < length(text) AS shrunk, deduplicated FROM deduplicated"))
def dedup_rewrite(spark, sf_dir):
    return (R.dedup_content(prompts(spark, sf_dir), "text", "deduplicated")
            .select("doc_id", (F.length("deduplicated") < F.length("text")).alias("shrunk"), "deduplicated"))


@register("redundancy_rewrite", S.with_ctes([("src", PROMPTS_SQL), *_dedup_ctes("src", "text", "dd")],
                                            f"SELECT doc_id, {_redundant_sql('dd')} AS simplified FROM dd"))
def redundancy_rewrite(spark, sf_dir):
    return R.remove_redundancy(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


def _then(*steps: tuple[str, str, str]) -> list[tuple[str, str]]:
    """CTEs (name, previous, SQL): each replaces the column named like the
    previous CTE by one named like itself."""
    return [(name, f"SELECT * EXCLUDE ({prev}), {sql} AS {name} FROM {prev}") for name, prev, sql in steps]


def _aggressive_ctes(src: str, col: str, dst: str) -> list[tuple[str, str]]:
    n = [f"{dst}_{k}" for k in range(8)]
    tidy = f"regexp_replace(trim(regexp_replace({n[6]}, '{_WSC}+', ' ', 'g')), ' +([.,!?;:])', '\\1', 'g')"
    upper = f"CASE WHEN substr({n[7]}, 1, 1) = 'ß' THEN 'SS' ELSE upper(substr({n[7]}, 1, 1)) END || substr({n[7]}, 2)"
    return [*_dedup_ctes(src, col, n[0]), *_then((n[1], n[0], _polite_sql(n[0])), (n[2], n[1], _verbose_sql(n[1])), (n[3], n[2], _filler_sql(n[2]))),
            *_dedup_ctes(n[3], n[3], n[4]), (f"{n[5]}", f"SELECT * EXCLUDE ({n[3]}, {n[4]}), {_compress_sql(_redundant_sql(n[4]))} AS {n[5]} FROM {n[4]}"),
            *_then((n[6], n[5], _core_sql(n[5], S.ws_word_count(n[5]))), (n[7], n[6], tidy), (dst, n[7], upper))]


@register("aggressive_rewrite", S.with_ctes([("src", PROMPTS_SQL), *_aggressive_ctes("src", "text", "simplified")], "SELECT doc_id, simplified FROM simplified"))
def aggressive_rewrite(spark, sf_dir):
    return R.aggressive(prompts(spark, sf_dir), "text", "simplified").select("doc_id", "simplified")


def _lower_words_sql(x: str) -> str:
    return f"list_distinct({S.ws_words(f'lower({x})')})"


# R12–R14 ---------------------------------------------------------------------
def _jaccard_sql(a: str, b: str) -> str:
    x, y = _lower_words_sql(a), _lower_words_sql(b)
    return (f"(CASE WHEN len(list_distinct(list_concat({x}, {y}))) > 0 THEN len(list_intersect({x}, {y})) "
            f"/ len(list_distinct(list_concat({x}, {y}))) ELSE {S.d(0.0)} END)")


def _base_ctes(src: str, col: str, p: str) -> list[tuple[str, str]]:
    """Adds {p}dup and {p}base: duplicate removal where it shrinks below 90 %."""
    return [*_dedup_ctes(src, col, f"{p}dd"), (f"{p}base_", f"""SELECT * EXCLUDE ({p}dd), length({p}dd) < length({col}) * 0.9 AS {p}dup,
        CASE WHEN length({p}dd) < length({col}) * 0.9 THEN {p}dd ELSE {col} END AS {p}base FROM {p}dd""")]


def _truncate_sql(x: str) -> str:
    z = S.sentences(x)
    mid = f"({z})[(len({z}) // 2) + 1]"
    return (f"(CASE WHEN len({z}) <= 3 THEN {x} ELSE {_strip_sql(f'({z})[1]')} || '. ' || {_strip_sql(mid)} || '. ' "
            f"|| {_strip_sql(f'({z})[len({z})]')} || '.' END)")


def _tag_sql(p: str, label: str) -> str:
    return f"(CASE WHEN {p}dup THEN {S.s('deduplicate+' + label)} ELSE {S.s(label)} END)"


def _auto_ctes(p: str, col: str, thr: float) -> list[tuple[str, str]]:
    """After _base_ctes and {p}agg: adds {p}auto and its label {p}autolab."""
    words = S.ws_word_count
    return [(f"{p}r1", f"SELECT *, {_filler_sql(_verbose_sql(f'{p}agg'))} AS {p}rr, {_filler_sql(_verbose_sql(f'{p}base'))} AS {p}q2 FROM {p}agg"),
            *_dedup_ctes(f"{p}r1", f"{p}q2", f"{p}q3"),
            (f"{p}r2", f"SELECT * EXCLUDE ({p}q2, {p}q3), {_compress_sql(_redundant_sql(f'{p}q3'))} AS {p}rules FROM {p}q3"),
            (f"{p}r3", f"""SELECT *, CASE WHEN {words(f'{p}rr')} < {words(f'{p}agg')} AND {_jaccard_sql(f'{p}base', f'{p}rr')} >= {S.d(thr)} THEN 1
                WHEN {_jaccard_sql(f'{p}base', f'{p}agg')} >= {S.d(thr)} AND {words(f'{p}agg')} < {words(col)} THEN 2 ELSE 3 END AS {p}ch FROM {p}r2"""),
            (f"{p}auto_", f"""SELECT * EXCLUDE ({p}ch, {p}rr, {p}rules), CASE {p}ch WHEN 1 THEN {p}rr WHEN 2 THEN {p}agg ELSE {p}rules END AS {p}auto,
                CASE {p}ch WHEN 1 THEN {_tag_sql(p, 't5+rules')} WHEN 2 THEN {_tag_sql(p, 't5')} ELSE {_tag_sql(p, 'rules')} END AS {p}autolab FROM {p}r3""")]


_OUTS = {"t5": ("s_agg", "'t5'"), "paraphrase": ("s_agg", "'t5'"), "auto": ("s_auto", "s_autolab"), "aggressive": ("s_agg", "'aggressive'"),
         "verbose": (_verbose_sql("s_base"), _tag_sql("s_", "verbose")), "filler": (_filler_sql("s_base"), _tag_sql("s_", "filler")),
         "compress": (_compress_sql("s_base"), _tag_sql("s_", "compress")), "truncate": (_truncate_sql("s_base"), _tag_sql("s_", "truncate"))}


def _core_only_sql(x: str) -> str:
    return _core_sql(x, "31")


_OUTS["core"] = (_core_only_sql(_polite_sql("s_base")), "'core_extraction'")
_THR = K.SIMPLIFIER_MIN_SIMILARITY
_ALT_CTES = [("src", PROMPTS_SQL), *_base_ctes("src", "text", "s_"), *_aggressive_ctes("s_base_", "s_base", "s_agg"), *_auto_ctes("s_", "text", _THR),
             ("outs", " UNION ALL ".join(f"SELECT doc_id, text, s_base, {k} AS strategy_rank, {_OUTS[n][0]} AS o, {_OUTS[n][1]} AS strategy_used FROM s_auto_"
                                         for k, n in enumerate(K.SIMPLIFY_STRATEGIES))),
             ("scored", f"""SELECT *, {_strip_sql('o')} AS simplified, {S.ws_word_count('text')} AS ot, {S.ws_word_count('o')} AS nt,
                {S.round_half(_jaccard_sql('s_base', 'o'), 4)} AS semantic_similarity FROM outs"""),
             ("reduced", f"SELECT *, CASE WHEN ot > 0 THEN (ot - nt) / ot * 100 ELSE {S.d(0.0)} END AS red FROM scored WHERE simplified <> text AND semantic_similarity >= {S.d(_THR)}"),
             ("firsts", f"""SELECT *, {S.round_half('red', 2)} AS token_reduction_percent, {S.round_half(f'red * {S.d(0.8)}', 2)} AS estimated_energy_reduction_percent
                FROM reduced QUALIFY row_number() OVER (PARTITION BY doc_id, simplified ORDER BY strategy_rank) = 1""")]


@register("prompt_rewrites", S.with_ctes(_ALT_CTES, """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY estimated_energy_reduction_percent DESC, strategy_rank) AS INTEGER) AS alt_rank,
    simplified, strategy_used, ot AS original_token_count, nt AS simplified_token_count, token_reduction_percent, estimated_energy_reduction_percent, semantic_similarity FROM firsts""", ("s_base_", "s_agg", "s_r1", "s_auto_", "outs", "reduced")))
def prompt_rewrites(spark, sf_dir):
    return alternatives(prompts(spark, sf_dir), "doc_id")


# Candidates, their scores and the choice -------------------------------
_MIN = K.OPTIMIZER_MIN_SIMILARITY
_P0 = S.d(0.0)


def _optimizer_ctes(top: int) -> list[tuple[str, str]]:
    """`alt`: a row for each candidate (k of 1 to 5) with its scores and place among
    those kept; `orig`: the prompts with energy and complexity."""
    thr = max(0.55, _MIN - 0.10)
    red = lambda o, x: f"(CASE WHEN {o} > 0 THEN ({o} - {x}) / {o} * 100 ELSE {_P0} END)"
    achieved = S.round_half(S.round_half(red("CAST(" + S.ws_word_count("text") + " AS DOUBLE)", S.ws_word_count("o_auto")), 2), 0)
    steps = (f"['Applied ' || o_autolab || ' strategy', CASE WHEN contains(o_autolab, 't5') THEN {S.s(K.SIMPLIFY_STEPS[0])} ELSE {S.s(K.SIMPLIFY_STEPS[1])} END, "
             f"'Achieved ' || CAST(CAST({achieved} AS BIGINT) AS VARCHAR) || '% token reduction']")
    more = lambda cond, name: f"CASE WHEN {cond} THEN {S.str_list(K.STRATEGY_STEPS[name])} ELSE [] END"
    texts = ["text", "t5", "c1", "comp", "trunc", "combined"]
    ctes = [("src", PROMPTS_SQL), *_base_ctes("src", "text", "o_"), *_aggressive_ctes("o_base_", "o_base", "o_agg"), *_auto_ctes("o_", "text", thr),
            ("k1", f"""SELECT doc_id, text, {steps} AS steps, {_strip_sql('o_agg')} AS t5, {_strip_sql('o_auto')} AS c1, {_strip_sql(_compress_sql('o_base'))} AS comp,
                {_strip_sql(_truncate_sql('o_base'))} AS trunc FROM o_auto_"""),
            *_base_ctes("k1", "c1", "p_"), ("k2", f"SELECT * EXCLUDE (p_dup, p_base), {_strip_sql(_truncate_sql('p_base'))} AS c2 FROM p_base_"),
            *_base_ctes("k2", "c2", "q_"), *_aggressive_ctes("q_base_", "q_base", "q_agg"),
            ("k3", f"SELECT * EXCLUDE (q_agg, q_dup, q_base), {_strip_sql('q_agg')} AS c3, {_jaccard_sql('text', 'c1')} AS s1, {_jaccard_sql('text', 'c2')} AS s2 FROM q_agg"),
            ("k4", f"""SELECT *, CASE WHEN s1 < {S.d(_MIN)} THEN c1 WHEN s2 < {S.d(_MIN)} THEN c2 ELSE c3 END AS combined,
                list_concat(list_concat(steps, {more(f's1 >= {S.d(_MIN)}', 'truncate')}), {more(f's1 >= {S.d(_MIN)} AND s2 >= {S.d(_MIN)}', 'paraphrase')}) AS combined_steps FROM k3"""),
            ("cand", " UNION ALL ".join(f"SELECT doc_id, {k} AS k, text AS t, {x} AS x, combined_steps FROM k4" for k, x in enumerate(texts)))]
    ctes += S.features_ctes("cand", "x", prefix="f", keep_internals=True) + S.complexity_ctes("f4", "x", prefix="x", reuse_internals=True, keep_components=False)
    ctes += [("xd", "SELECT * EXCLUDE (_clean, _words, _sents) FROM x5")] + S.energy_ctes("xd", prefix="e")
    score = (f"(CASE WHEN red > 0 THEN {S.d(0.50)} * (red / 50) + {S.d(0.25)} * sim + {S.d(0.15)} * greatest({_P0}, cred / 50) "
             f"+ {S.d(0.10)} * greatest({_P0}, 1 - length(x) / length(t)) ELSE {S.d(0.1)} * sim END)")
    return ctes + [
        ("each1", "SELECT doc_id, k, t, x, combined_steps, energy_joules AS e, complexity_score AS cx FROM e2"),
        ("orig", "SELECT doc_id, e AS oe, cx AS ocx FROM each1 WHERE k = 0"),
        ("each2", f"""SELECT c.*, oe, ocx, {red('oe', 'e')} AS red, {red('ocx', 'cx')} AS cred, {_jaccard_sql('t', 'x')} AS sim,
            trim({_strip_sql('x')}) = trim({_strip_sql('t')}) AS same FROM each1 c JOIN orig USING (doc_id) WHERE k > 0"""),
        ("each3", f"SELECT *, {S.round_half(f'greatest({_P0}, least({S.d(1.0)}, {score}))', 4)} AS score, NOT same AND sim >= {S.d(_MIN)} AS kept FROM each2"),
        ("alt", f"""SELECT *, {S.str_list(K.OPTIMIZER_STRATEGIES)}[k] AS strategy,
            CASE WHEN kept THEN row_number() OVER (PARTITION BY doc_id, kept ORDER BY score DESC, k) END AS place, any_value(kept) OVER (PARTITION BY doc_id) AS any_,
            least({top}, count(*) FILTER (kept) OVER (PARTITION BY doc_id)) AS n_alternatives FROM each3"""),
    ]


def _best_sql(choice: str, used: str, steps: str) -> str:
    saved = "(oe - e)"
    overall = (f"{S.d(0.35)} * greatest({_P0}, red / 50) + {S.d(0.35)} * sim + {S.d(0.20)} * greatest({_P0}, cred / 50) "
               f"+ {S.d(0.10)} * (CASE WHEN length(x) < length(t) THEN {S.d(1.0)} ELSE {S.d(0.5)} END)")
    return f"""SELECT doc_id, x AS optimized_prompt, {S.round_half('oe', 6)} AS original_energy_joules, {S.round_half('e', 6)} AS optimized_energy_joules,
        {S.round_half(f'greatest({_P0}, {saved})', 6)} AS energy_saved_joules, {S.round_half(f'greatest({_P0}, red)', 2)} AS energy_reduction_percent,
        {S.round_half('sim', 4)} AS semantic_similarity, {S.round_half(f'greatest({_P0}, cred)', 2)} AS complexity_reduction, {used} AS strategy_used,
        {steps} AS optimization_steps, CAST(n_alternatives AS INTEGER) AS n_alternatives, {S.round_half(f'greatest({_P0}, least({S.d(1.0)}, {overall}))', 4)} AS optimization_score
        FROM alt WHERE {choice}"""


_HELD = ("src", "o_base_", "o_agg", "o_r1", "o_auto_", "k1", "p_base_", "k2", "q_base_", "q_agg", "k4", "cand", "f4", "x5", "e2", "each1", "each3", "alt")
_AUTO_BEST = _best_sql("CASE WHEN n_alternatives > 0 THEN coalesce(place = 1, false) ELSE k = 5 END", "CASE WHEN n_alternatives > 0 THEN strategy ELSE 'combined' END",
                       "CASE WHEN n_alternatives > 0 THEN 'Applied ' || strategy || ' strategy' ELSE array_to_string(combined_steps, '; ') END")


def best_rows(optimized: DataFrame) -> DataFrame:
    """The choice with its steps as one text and the number of alternatives."""
    return (optimized.withColumn("optimization_steps", F.array_join("optimization_steps", "; ")).withColumn("n_alternatives", F.size("alternatives"))
            .drop("original_prompt", "alternatives"))


@register("optimize_best", S.with_ctes(_optimizer_ctes(5), _AUTO_BEST, _HELD))
def optimize_best(spark, sf_dir):
    return best_rows(O.optimize(prompts(spark, sf_dir), "doc_id"))


# A named strategy ----
@register("optimize_named", S.with_ctes(_optimizer_ctes(3), _best_sql("k = 3", "'compress'", S.s("; ".join(K.STRATEGY_STEPS["compress"]))), _HELD))
def optimize_named(spark, sf_dir):
    return best_rows(O.optimize(prompts(spark, sf_dir), "doc_id", strategy="compress"))


@register("optimize_alternatives", S.with_ctes(_optimizer_ctes(5), f"""SELECT doc_id, CAST(place AS INTEGER) AS rank, strategy, {S.round_half('sim', 4)} AS similarity,
    {S.round_half('e', 2)} AS energy_joules, {S.round_half('red', 2)} AS energy_reduction_percent, {S.round_half('cred', 2)} AS complexity_reduction_percent, score AS optimization_score
    FROM alt WHERE place <= 5""", _HELD))
def optimize_alternatives(spark, sf_dir):
    return O.ranked_alternatives(O.optimize(prompts(spark, sf_dir), "doc_id"), "doc_id").drop("prompt")


@register("savings_by_strategy", S.with_ctes(_optimizer_ctes(5) + [("best", _AUTO_BEST)], f"""SELECT strategy_used, count(*) AS prompts,
    {S.round_half('sum(original_energy_joules)', 4)} AS energy_before_joules, {S.round_half('sum(optimized_energy_joules)', 4)} AS energy_after_joules,
    {S.round_half('(sum(original_energy_joules) - sum(optimized_energy_joules)) / sum(original_energy_joules) * 100', 2)} AS percent_saved,
    {S.round_half('avg(energy_reduction_percent)', 2)} AS avg_reduction_percent FROM best GROUP BY strategy_used""", _HELD))
def savings_by_strategy(spark, sf_dir):
    return O.savings_summary(O.optimize(prompts(spark, sf_dir), "doc_id"))


# O6 / O8 -------------------------------------------------------------------------
def _scored(spark, sf_dir):
    d = features(prompts(spark, sf_dir), "text", keep_internals=True)
    d = complexity(d, "text", parsed=True)
    return d.drop(*INTERNALS)


def _scored_sql():
    ctes = [("src", PROMPTS_SQL)] + S.features_ctes("src", "text", keep_internals=True)
    ctes += S.complexity_ctes("f4", "text", prefix="x", reuse_internals=True)
    ctes += [("sc", "SELECT * EXCLUDE (_clean, _words, _sents) FROM x5")]
    return ctes


_MSG = dict(K.SUGGESTIONS)
_TOK = _MSG["tokens"].split("{n}")


@register("prompt_suggestions", S.with_ctes(_scored_sql(), f"""SELECT doc_id, array_to_string(CASE WHEN len(g) > 0
      THEN g ELSE [{S.s(K.DEFAULT_SUGGESTION)}] END, ' | ') AS suggestions
    FROM (SELECT doc_id, list_filter([
      CASE WHEN token_count > 200 THEN {S.s(_TOK[0])} || CAST(token_count AS VARCHAR) || {S.s(_TOK[1])} END,
      CASE WHEN complexity_score > {S.d(0.6)} THEN {S.s(_MSG['complexity'])} END,
      CASE WHEN vocabulary_complexity > {S.d(0.5)} THEN {S.s(_MSG['vocabulary'])} END,
      CASE WHEN sentence_complexity > {S.d(0.5)} THEN {S.s(_MSG['sentence'])} END,
      CASE WHEN stopword_ratio > {S.d(0.5)} THEN {S.s(_MSG['stopwords'])} END,
      CASE WHEN sentence_count = 1 AND word_count > 50 THEN {S.s(_MSG['single'])} END],
      lambda z: z IS NOT NULL) AS g FROM sc)"""))
def prompt_suggestions(spark, sf_dir):
    return (O.suggestions(_scored(spark, sf_dir))
            .select("doc_id", F.array_join("suggestions", " | ").alias("suggestions")))


@register("compliance_flags", S.with_ctes(_scored_sql(), f"""SELECT doc_id, token_count, complexity_score,
    token_count <= {K.RULES_MAX_TOKENS} AS within_token_budget,
    complexity_score <= {S.d(K.RULES_TARGET_COMPLEXITY)} AS within_complexity_target FROM sc"""))
def compliance_flags(spark, sf_dir):
    return (O.compliance_flags(_scored(spark, sf_dir))
            .select("doc_id", "token_count", "complexity_score", "within_token_budget",
                    "within_complexity_target"))


# M1 / M3: Jaccard over a pair table (user turn vs the following turn) -------
@register("turn_similarity", f"""SELECT a.conv_id, a.turn,
    CASE WHEN len(list_distinct(list_concat({_lower_words_sql('a.text')}, {_lower_words_sql('b.text')}))) > 0
      THEN len(list_intersect({_lower_words_sql('a.text')}, {_lower_words_sql('b.text')}))
           / len(list_distinct(list_concat({_lower_words_sql('a.text')}, {_lower_words_sql('b.text')})))
      ELSE {S.d(0.0)} END AS similarity
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user'""")
def turn_similarity(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    a = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("a_text"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b_text"))
    return a.join(b, ["conv_id", "turn"]).select(
        "conv_id", "turn", R.jaccard(F.col("a_text"), F.col("b_text")).alias("similarity"))


# M2 / M3: cosine over a pair table (consecutive vectors) -------------------
@register("embedding_cosine", f"""SELECT a.vec_id,
    {S.round_half(f'''CASE WHEN list_sum(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) > 0
      AND list_sum(list_transform(b.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) > 0
      THEN list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))
        / (sqrt(list_sum(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))
           * sqrt(list_sum(list_transform(b.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))))
      ELSE {S.d(0.0)} END''', 6)} AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def embedding_cosine(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    a = e.select("vec_id", F.col("embedding").alias("ea"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("eb"))
    dbl = lambda c: F.transform(c, lambda x: x.cast("double"))
    return a.join(b, "vec_id").select(
        "vec_id", T.round_half(R.cosine(dbl(F.col("ea")), dbl(F.col("eb"))), 6).alias("cosine"))
