"""DuckDB SQL fragments for the oracle side of the correctness gate.

Each helper mirrors a Column builder in ``promptwatt.functions.text`` or an
operator, with the same constants and the same order of floating-point
operations, so both engines produce identical doubles. This is string
assembly for the independent check only; no query is planned or executed here.
"""

from __future__ import annotations

from .. import constants as K
from ..operators import complexity as CX

CHR1 = "chr(1)"


def s(x: str) -> str:
    """SQL string literal."""
    return "'" + x.replace("'", "''") + "'"


def d(x: float) -> str:
    """Double literal (DuckDB reads bare decimals as DECIMAL)."""
    return f"CAST({s(repr(float(x)))} AS DOUBLE)"


def str_list(words) -> str:
    return "[" + ", ".join(s(w) for w in words) + "]"


def round_half(x: str, digits: int) -> str:
    scale = d(float(10 ** digits))
    return f"(floor(({x}) * {scale} + {d(0.5)}) / {scale})"


def clean(x: str) -> str:
    return (f"regexp_replace(trim(regexp_replace(CAST({x} AS VARCHAR), {s('[' + K.WS + ']+')}, ' ', 'g')),"
            f" {s('[' + K.CTRL + ']')}, '', 'g')")


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace(CAST({x} AS VARCHAR), {s('[' + K.WS + ']+')}, ' ', 'g'))"


def word_tokens(x: str) -> str:
    return (f"list_filter(string_split(regexp_replace(lower({x}), {s(r'[^\p{L}\p{N}\-]+')}, ' ', 'g'), ' '),"
            f" lambda w: w <> '' AND NOT contains(w, '-'))")


def sentences(x: str) -> str:
    return (f"list_filter(string_split(regexp_replace({x}, {s('([.!?]+)[' + K.WS + ']+')}, '\\1' || {CHR1}, 'g'),"
            f" {CHR1}), lambda z: regexp_matches(z, {s('[^' + K.WS + ']')}))")


def ws_word_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {s('[^' + K.WS + ']+')})) AS BIGINT)"


def ws_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {s('[' + K.WS + ']+')}), lambda w: w <> '')"


def count_sub(x: str, sub: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, {s(sub)}, ''))) // {len(sub)} AS BIGINT)"


def count_regex(x: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {s(pattern)})) AS BIGINT)"


def count_in(arr: str, words) -> str:
    return f"CAST(len(list_filter({arr}, lambda w: list_contains({str_list(words)}, w))) AS BIGINT)"


def total_length(arr: str) -> str:
    return f"CAST(length(array_to_string({arr}, '')) AS BIGINT)"


def safe_div(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN ({num}) / ({den}) ELSE {d(0.0)} END)"


def preview(x: str, n: int = K.PREVIEW_CHARS) -> str:
    return f"(CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || '...' ELSE {x} END)"


def privacy_hash(x: str) -> str:
    return f"substr(sha256({x}), 1, 16)"


def bucketize(x: str, bounds, top: str) -> str:
    parts = " ".join(f"WHEN {x} < {d(b)} THEN {s(lbl)}" for b, lbl in bounds)
    return f"(CASE {parts} ELSE {s(top)} END)"


def clip(x: str) -> str:
    return f"least({x}, {d(1.0)})"


# ---------------------------------------------------------------------------
# Operator CTE chains. Each returns a list of (name, select-body) CTEs; the
# last CTE exposes the input columns plus the operator's outputs.
# ---------------------------------------------------------------------------

def features_ctes(src: str, text_col: str, prefix: str = "f", keep_internals: bool = False):
    c1 = (f"{prefix}1", f"SELECT *, {clean(text_col)} AS _clean FROM {src}")
    c2 = (f"{prefix}2", f"SELECT *, {word_tokens('_clean')} AS _words, {sentences('_clean')} AS _sents "
                        f"FROM {prefix}1")
    c3 = (f"{prefix}3", f"""SELECT *,
        {ws_word_count('_clean')} AS token_count,
        CAST(len(_words) AS BIGINT) AS word_count,
        CAST(length(_clean) AS BIGINT) AS char_count,
        CAST(greatest(len(_sents), 1) AS BIGINT) AS sentence_count,
        {total_length('_words')} AS _len_sum,
        {count_regex('_clean', K.PUNCT_CLASS)} AS _punct,
        {count_in('_words', K.STOPWORDS)} AS _stop,
        CAST(len(list_distinct(_words)) AS BIGINT) AS _distinct
        FROM {prefix}2""")
    keep = "" if keep_internals else ", _clean, _words, _sents"
    c4 = (f"{prefix}4", f"""SELECT * EXCLUDE (_len_sum, _punct, _stop, _distinct{keep}),
        {safe_div('_len_sum', 'word_count')} AS avg_word_length,
        word_count / sentence_count AS avg_sentence_length,
        {safe_div('_punct', 'char_count')} AS punct_ratio,
        {safe_div('_stop', 'word_count')} AS stopword_ratio,
        {safe_div('_distinct', 'word_count')} AS unique_word_ratio,
        {safe_div('_distinct', 'word_count')} AS vocabulary_richness,
        {safe_div('word_count - _stop', 'word_count')} AS lexical_density,
        {d(0.0)} AS noun_ratio, {d(0.0)} AS verb_ratio, {d(0.0)} AS adj_ratio, {d(0.0)} AS adv_ratio
        FROM {prefix}3""")
    return [c1, c2, c3, c4]


_CTRL_NOT_WS = r"[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]"
_CAP_WORD = (rf"\p{{Lu}}[^\p{{Lu}}\p{{Lt}}{K.WS}]*\p{{Ll}}[^\p{{Lu}}\p{{Lt}}{K.WS}]*")
_SECTIONS = rf"(?m)(#+[{K.WS}]|^\p{{Nd}}+\.|^[a-z]\))"


def complexity_ctes(src: str, text_col: str, prefix: str = "x", weights=None,
                    reuse_internals: bool = False, keep_components: bool = True):
    """Mirror of operators.complexity.complexity."""
    w = tuple(weights) if weights is not None else K.COMPLEXITY_WEIGHTS
    raw = f"coalesce(CAST({text_col} AS VARCHAR), '')"
    rw = word_tokens(raw)
    rs = sentences(raw)
    if reuse_internals:
        has_ctrl = f"regexp_matches({raw}, {s(_CTRL_NOT_WS)})"
        rw = f"(CASE WHEN {has_ctrl} THEN {rw} ELSE _words END)"
        rs = f"(CASE WHEN {has_ctrl} THEN {rs} ELSE _sents END)"
    lower = f"lower({raw})"
    reasoning = " + ".join(f"CAST(contains({lower}, {s(x)}) AS BIGINT)" for x in K.REASONING_WORDS)
    conds = " + ".join(f"CAST(contains({lower}, {s(x)}) AS BIGINT)" for x in K.CONDITIONAL_MARKERS)
    c1 = (f"{prefix}1", f"SELECT *, {rw} AS _rw, {rs} AS _rs FROM {src}")
    c2 = (f"{prefix}2", f"SELECT *, list_transform(_rs, lambda z: {ws_word_count('z')}) AS _lens FROM {prefix}1")
    c3 = (f"{prefix}3", f"""SELECT *,
        CAST(len(_rs) AS BIGINT) AS _ns,
        CAST(coalesce(list_sum(_lens), 0) AS BIGINT) AS _s1,
        CAST(coalesce(list_sum(list_transform(_lens, lambda z: z * z)), 0) AS BIGINT) AS _s2,
        ({count_sub(raw, ',')} + {count_sub(raw, ';')} + {count_sub(lower, ' and ')}
          + {count_sub(lower, ' but ')}) AS _clauses,
        CAST(len(_rw) AS BIGINT) AS _n,
        CAST(len(list_distinct(_rw)) AS BIGINT) AS _distinct,
        {total_length('_rw')} AS _lensum,
        {count_in('_rw', K.TECHNICAL_TERMS)} AS _tech,
        CAST(len(list_filter(_rw, lambda z: length(z) > 8)) AS BIGINT) AS _long,
        ({count_sub(raw, '(')} + {count_sub(raw, '[')} + {count_sub(raw, '{')}) AS _parens,
        {count_sub(raw, '?')} AS _q,
        ({reasoning}) AS _qw,
        ({conds}) AS _cond,
        ({count_sub(raw, ':')} + {count_regex(raw, r'\p{Nd}+\.')} + {count_sub(raw, '•')}
          + {count_sub(raw, '-')}) AS _list,
        CAST(length(replace({raw}, ' ', '')) AS BIGINT) AS _nonspace,
        CAST(len(list_filter({ws_words(raw)}, lambda z: regexp_full_match(z, {s(_CAP_WORD)}))) AS BIGINT) AS _caps,
        {count_regex(raw, r'\p{Nd}+')} AS _nums,
        CAST(length({raw}) AS BIGINT) AS _chars,
        {count_sub(raw, chr(10) + chr(10))} AS _paras,
        ({count_sub(raw, '```')} + {count_sub(raw, '`')} + {count_sub(raw, '"')}
          + {count_sub(raw, "'")}) AS _fmt,
        {count_regex(raw, _SECTIONS)} AS _sections
        FROM {prefix}2""")
    sentence = (f"(CASE WHEN _ns = 0 THEN {d(0.0)} ELSE {d(0.4)} * {clip('(_s1 / _ns) / 25')}"
                f" + {d(0.3)} * (CASE WHEN _ns > 1 THEN {clip('sqrt((_ns * _s2 - _s1 * _s1) / (_ns * _ns)) / 10')}"
                f" ELSE {d(0.0)} END) + {d(0.3)} * {clip('_clauses / (_ns * 3)')} END)")
    vocabulary = (f"(CASE WHEN _n = 0 THEN {d(0.0)} ELSE {d(0.25)} * (_distinct / _n)"
                  f" + {d(0.25)} * {clip('(_lensum / _n) / 10')} + {d(0.30)} * {clip('_tech / _n * 10')}"
                  f" + {d(0.20)} * {clip('_long / _n * 3')} END)")
    syntactic = (f"({d(0.25)} * {clip('_parens / 5')} + {d(0.30)} * {clip('(_q + _qw) / 5')}"
                 f" + {d(0.25)} * {clip('_cond / 3')} + {d(0.20)} * {clip('_list / 5')})")
    semantic = (f"(CASE WHEN _n = 0 OR _nonspace = 0 THEN {d(0.0)} ELSE {d(0.30)} * {clip('_distinct / _nonspace * 50')}"
                f" + {d(0.20)} * {clip('_caps / _n * 5')} + {d(0.20)} * {clip('_nums / _n * 10')}"
                f" + {d(0.30)} * {clip('_tech / _n * 8')} END)")
    structural = (f"({d(0.35)} * {clip('_chars / 2000')} + {d(0.20)} * {clip('(_paras + 1) / 5')}"
                  f" + {d(0.20)} * {clip('_fmt / 10')} + {d(0.25)} * {clip('_sections / 5')})")
    c4 = (f"{prefix}4", f"""SELECT *, {sentence} AS _c1, {vocabulary} AS _c2, {syntactic} AS _c3,
        {semantic} AS _c4, {structural} AS _c5 FROM {prefix}3""")
    overall = (f"({d(w[0])} * _c1 + {d(w[1])} * _c2 + {d(w[2])} * _c3 + {d(w[3])} * _c4"
               f" + {d(w[4])} * _c5)")
    comps = "".join(f", {round_half(f'_c{i + 1}', 4)} AS {nm}" for i, nm in enumerate(CX.COMPONENTS)) \
        if keep_components else ""
    tmp = ("_rw, _rs, _lens, _ns, _s1, _s2, _clauses, _n, _distinct, _lensum, _tech, _long, _parens, _q,"
           " _qw, _cond, _list, _nonspace, _caps, _nums, _chars, _paras, _fmt, _sections,"
           " _c1, _c2, _c3, _c4, _c5")
    c5 = (f"{prefix}5", f"""SELECT * EXCLUDE ({tmp}),
        {round_half(overall, 4)} AS complexity_score,
        {bucketize(overall, K.COMPLEXITY_LEVELS, K.COMPLEXITY_TOP_LEVEL)} AS complexity_level{comps}
        FROM {prefix}4""")
    return [c1, c2, c3, c4, c5]


def energy_ctes(src: str, prefix: str = "e", *, tokens_col: str = "token_count",
                region: str = K.DEFAULT_REGION, region_col: str | None = None,
                scale: float = 1.0, calibration=None):
    """Mirror of operators.energy.estimate_energy (linear model)."""
    from ..operators.energy import _factor_literals
    a, b = calibration or (K.CALIBRATION_INTERCEPT, K.CALIBRATION_SLOPE)
    tok = f"CAST({tokens_col} AS DOUBLE)"
    base = f"({d(a)} + {d(b)} * {tok})"
    scaled = (f"(CASE WHEN {tok} <= {K.TOKEN_SCALING_MAX_TOKENS} THEN {base}"
              f" ELSE {base} * least(sqrt({tok} / {K.TOKEN_SCALING_BASELINE}), {d(K.TOKEN_SCALING_CAP)}) END)")
    j = f"greatest({d(K.MIN_JOULES)}, {scaled} * {d(scale)})"
    if region_col is None:
        cost, kg = _factor_literals(region)
        fac_cost, fac_kg = d(cost), d(kg)
        c1 = (f"{prefix}1", f"SELECT *, {j} AS _j, {fac_cost} AS _cost, {fac_kg} AS _kg FROM {src}")
    else:
        vals = ", ".join(f"({s(r)}, {d(c)}, {d(k)})" for r, c, k in K.REGION_FACTORS)
        c1 = (f"{prefix}1", f"""SELECT src.*, {j} AS _j,
            coalesce(fac.c, {d(K.DEFAULT_COST_PER_KWH)}) AS _cost,
            coalesce(fac.k, {d(K.DEFAULT_CARBON_KG_PER_KWH)}) AS _kg
            FROM {src} AS src LEFT JOIN (VALUES {vals}) AS fac(r, c, k) ON src.{region_col} = fac.r""")
    kwh = f"(_j / {d(K.JOULES_PER_KWH)})"
    c2 = (f"{prefix}2", f"""SELECT * EXCLUDE (_j, _cost, _kg),
        {round_half('_j', 4)} AS energy_joules,
        {round_half(kwh, 10)} AS energy_kwh,
        {d(K.CONFIDENCE['linear'])} AS confidence_score,
        {round_half(kwh + ' * _kg', 10)} AS carbon_footprint_kg,
        {round_half(kwh + ' * ' + d(K.WATER_L_PER_KWH), 8)} AS water_usage_liters,
        {round_half(kwh + ' * _cost', 10)} AS electricity_cost_usd,
        {bucketize('_j', K.ENERGY_LEVELS_J, K.ENERGY_TOP_LEVEL)} AS energy_level,
        {round_half(f'(_j - {d(K.BASELINE_JOULES)}) / {d(K.BASELINE_JOULES)} * 100', 2)} AS comparison_to_average
        FROM {prefix}1""")
    return [c1, c2]


def anomaly_ctes(src: str, prefix: str = "a", *, threshold: float = K.ANOMALY_THRESHOLD,
                 energy_col: str | None = None):
    """Mirror of operators.anomaly.detect."""
    limit = int(round(threshold * 100))
    ttw = "(token_count / greatest(word_count, 1))"
    ctl = f"(complexity_score / greatest(char_count, 1) * 1000)"
    h = (f"(50 - (CASE WHEN token_count > 400 THEN 30 ELSE 0 END)"
         f" - (CASE WHEN complexity_score > {d(0.7)} THEN 20 ELSE 0 END)"
         f" - (CASE WHEN {ttw} > {d(1.8)} THEN 15 ELSE 0 END)"
         f" - (CASE WHEN {ctl} > {d(0.8)} THEN 15 ELSE 0 END))")
    ept = f"({energy_col} / greatest(token_count, 1))" if energy_col else d(0.0)
    c1 = (f"{prefix}1", f"SELECT *, {h} AS _h, {ttw} AS _ttw, {ctl} AS _ctl, {ept} AS _ept FROM {src}")
    anom = f"(_h < {limit})"
    sev = (f"(CASE WHEN NOT {anom} THEN 'normal' WHEN _h < -90 THEN 'critical' WHEN _h < -70 THEN 'high'"
           f" WHEN _h < -50 THEN 'medium' WHEN _h < -30 THEN 'low' ELSE 'normal' END)")
    typ = (f"(CASE WHEN NOT {anom} THEN 'normal' WHEN token_count > 500 THEN 'high_tokens'"
           f" WHEN complexity_score > {d(0.8)} THEN 'high_complexity' ELSE 'unusual_pattern' END)")
    conds = (f"complexity_score > {d(0.8)}", "token_count > 500", f"_ttw > {d(2.0)}",
             f"_ept > {d(0.01)}", f"_ctl > {d(1.0)}")
    keys = "list_filter([" + ", ".join(
        f"CASE WHEN {cnd} THEN {s(nm)} END" for cnd, (nm, _) in zip(conds, K.ANOMALY_FACTORS)
    ) + "], lambda z: z IS NOT NULL)"
    c2 = (f"{prefix}2", f"""SELECT *, {sev} AS _sev, {typ} AS _type,
        (CASE WHEN NOT {anom} THEN CAST([] AS VARCHAR[]) WHEN len({keys}) = 0 THEN ['general']
         ELSE {keys} END) AS _keys FROM {prefix}1""")
    recs = " ".join(f"WHEN _type = {s(k)} THEN {s(v)}" for k, v in K.ANOMALY_RECOMMENDATION.items())
    c3 = (f"{prefix}3", f"""SELECT * EXCLUDE (_h, _ttw, _ctl, _ept, _sev, _type, _keys),
        (_h < {limit}) AS is_anomaly,
        _h / {d(100.0)} AS anomaly_score,
        least(abs(_h / {d(100.0)}), {d(1.0)}) AS anomaly_confidence,
        _sev AS anomaly_severity,
        _type AS anomaly_type,
        array_to_string(_keys, ',') AS factor_keys,
        (CASE {recs} END) || (CASE WHEN _sev IN ('high', 'critical') THEN {s(K.ANOMALY_SEVERE_SUFFIX)} ELSE '' END)
          AS recommendation
        FROM {prefix}2""")
    return [c1, c2, c3]


def with_ctes(ctes, final: str, materialized: tuple[str, ...] = ()) -> str:
    body = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in materialized else ''}(\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"
