"""Rule-based rewrites (R1–R11) as DataFrame stages: ``stage(df, src, dst)``
adds column ``dst`` computed from column ``src``.

Stages materialise their intermediate values as temporary columns (prefixed
``dst__``) so that an expensive expression (lower-cased text, sentence
array) is computed once and lambdas only read attributes. Word boundaries
are written as explicit lookarounds over ``[\\p{L}\\p{N}_]`` so they do not
depend on the JDK's ``\\b`` semantics. Phrase folds are gated by cheap
``contains`` checks: rows without any phrase skip every regex.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from . import text as T

W = r"[\p{L}\p{N}_]"
WB_L = rf"(?<!{W})"
WB_R = rf"(?!{W})"
BIG = 1 << 30


def _tmp(dst: str, name: str) -> str:
    return f"{dst}__{name}"


def _drop_tmp(df: DataFrame, dst: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(dst + "__")])


def _phrase_regex(phrase: str) -> str:
    """The phrase between word boundaries; a search for its letters comes first."""
    p = re.escape(phrase)
    return p + rf"(?<!{W}{p})" + WB_R


def capitalize_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, BIG))


def _either(words) -> str:
    """Pattern of any of the words; the first letter is settled once."""
    rest: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        rest.setdefault(w[0], []).append(re.escape(w[1:]))
    return "(?:" + "|".join(f"{re.escape(a)}(?:{'|'.join(r)})" for a, r in rest.items()) + ")"


def _keys(rules) -> list[str]:
    """Of each (phrase, replacement) one word without which the phrase can't occur in
    any text that the rules make: no rule brings it in. Long ones that are no stopwords
    are rare."""
    words = lambda x: re.findall(r"\w+", x)
    brought = {w for ph, rep in rules for w in words(rep) if w not in words(ph)}
    return [max((w for w in words(ph) if w not in brought), key=lambda w: (w not in K.STOPWORDS, len(w))) for ph, _ in rules]


def _rule_fold(df: DataFrame, dst: str, start: str, low: str, rules, gate_on=None, odd: Column | None = None) -> DataFrame:
    """Apply ordered (gate literal, regex, replacement, key words) rules to column
    ``start`` in one ``aggregate`` over a rule array, which is one literal after constant
    folding.

    One pass over the lower-cased text (column ``low``) finds the key words it holds, and
    only rules with such a key word are tried: without one no match is possible. Of those
    a regex runs when its gate literal occurs in the current text (``gate_on(acc)``,
    default the text itself). ``odd``: rows whose letters are not the same by lower-casing
    and by the regexes' case folding; there all rules are tried."""
    held, all_rules, text = F.col(f"{dst}__held"), F.col(f"{dst}__all"), F.col(start)
    arr = F.from_json(F.lit(json.dumps([dict(zip("gprk", r)) for r in rules])), "array<struct<g:string,p:string,r:string,k:array<string>>>")
    pattern = rf"[^a-z\p{{L}}\p{{N}}_]({_either(k for r in rules for k in r[3])})" + WB_R
    df = df.withColumns({f"{dst}__held": F.regexp_extract_all(F.concat(F.lit(" "), F.col(low)), F.lit(pattern), F.lit(1)),
                         f"{dst}__all": F.lit(False) if odd is None else odd})
    tried = F.when(all_rules, arr).otherwise(F.filter(arr, lambda rule: F.arrays_overlap(held, rule["k"])))
    gate = gate_on or (lambda acc: acc)
    fold = F.aggregate(tried, text, lambda acc, rule: F.when(
        gate(acc).contains(rule["g"]), F.regexp_replace(acc, rule["p"], rule["r"])).otherwise(acc))
    return df.withColumn(dst, F.when((F.size(held) > 0) | all_rules, fold).otherwise(text))


VERBOSE_RULES = tuple((ph, _phrase_regex(ph), rep, [k]) for (ph, rep), k in zip(K.VERBOSE_PHRASES, _keys(K.VERBOSE_PHRASES)))
REDUNDANT_RULES = tuple((ph, "(?iu)" + _phrase_regex(ph), rep, [k]) for (ph, rep), k in zip(K.REDUNDANT_PAIRS, _keys(K.REDUNDANT_PAIRS)))
# Letters that a case-insensitive regex takes for an ASCII letter (long s, dotted and
# dotless i, the Kelvin sign), which lower-casing may keep apart; and characters of two
# code units, of which a look back sees the second one alone.
FOLDED = r"[\x{130}-\x{212a}&&[\x{17f}\x{130}\x{131}\x{212a}]]|[\x{10000}-\x{10ffff}]"


# R1 -------------------------------------------------------------------------
def remove_verbose(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Lower-case the whole text, replace the 103 verbose phrases in order,
    then capitalise every '. '-separated piece."""
    low = _tmp(dst, "low")
    df = df.withColumn(low, F.lower(F.col(src)))
    df = _rule_fold(df, _tmp(dst, "fold"), low, low, VERBOSE_RULES)
    pieces = F.split(F.col(_tmp(dst, "fold")), r"\. ")
    df = df.withColumn(dst, F.array_join(F.transform(pieces, capitalize_first), ". "))
    return _drop_tmp(df, dst)


# R2 -------------------------------------------------------------------------
_FILLER = rf"(?i)(?<!\S)[{K.FILLER_STRIP}]*+{_either(w for w in K.FILLER_WORDS if ' ' not in w)}[{K.FILLER_STRIP}]*+(?!\S) ?"


def remove_fillers(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Drop whitespace words whose lower-cased, punctuation-stripped form is a
    filler; re-join with single spaces."""
    one = _tmp(dst, "one")
    df = df.withColumn(one, T.collapse_ws(F.col(src)))
    # the Kelvin sign is lower-cased to a 'k', which the ASCII pattern doesn't know
    kept = F.trim(F.regexp_replace(F.col(one), _FILLER, ""))
    words = T.ws_words(F.col(one))
    odd = F.filter(words, lambda w: ~F.btrim(F.lower(w), F.lit(K.FILLER_STRIP)).isin(*K.FILLER_WORDS))
    df = df.withColumn(dst, F.when(F.col(one).contains("\u212a"), F.array_join(odd, " ")).otherwise(kept))
    return _drop_tmp(df, dst)


# R3 -------------------------------------------------------------------------
def remove_redundancy(df: DataFrame, src: str, dst: str) -> DataFrame:
    """R5 duplicate removal, then the 15 redundant pairs (case-insensitive)."""
    d, low = _tmp(dst, "dd"), _tmp(dst, "low")
    df = dedup_content(df, src, d).withColumn(low, F.lower(F.col(d)))
    gate = lambda acc: F.when(acc == F.col(d), F.col(low)).otherwise(F.lower(acc))  # noqa: E731  lowered anew only once changed
    df = _rule_fold(df, _tmp(dst, "x"), d, low, REDUNDANT_RULES, gate_on=gate, odd=F.col(d).rlike(FOLDED))
    return _drop_tmp(df.withColumn(dst, F.col(_tmp(dst, "x"))), dst)


# R4 -------------------------------------------------------------------------
def compress(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Drop parentheticals and ', which …,' / ', who …,' clauses; collapse
    whitespace."""
    x = T.norm_ws(F.col(src))
    x = F.regexp_replace(x, r"\([^)]*\)", "")
    x = F.regexp_replace(x, r",\s*which\s+[^,]+,", ",")
    x = F.regexp_replace(x, r",\s*who\s+[^,]+,", ",")
    return df.withColumn(dst, T.collapse_even(x))


# R5 / R6 --------------------------------------------------------------------
def _norm_pieces(c: Column, mark: str) -> Column:
    """The pieces of a text between marks: lower, nothing but letters, digits,
    underscore and white space. The whole text is passed once; a mark is a control
    character, which ends a word for lower-casing like the end of a piece."""
    return F.split(F.regexp_replace(F.lower(c), rf"[^a-z\p{{L}}\p{{N}}_\s{mark}]", ""), mark)


def dedup_content(df: DataFrame, src: str, dst: str, min_prefix: int = 50, max_prefix: int = 499) -> DataFrame:
    """Remove copy-pasted content. Texts under 20 characters are untouched.
    On the whitespace-normalised text: (a) if at least 80 % of the
    '.'-separated parts equal the first one, keep it; (b) else the shortest
    prefix (``min_prefix`` to ``max_prefix`` characters) whose non-overlapping repeats cover 70 % of the
    text, cut after its last '.' beyond position 20. A result under 60 % of the
    length wins. Otherwise drop repeated sentences (compared lower-cased
    without punctuation, first kept) and join with '. ' + final '.' — only if
    something was dropped."""
    t = F.col(src)
    nm, parts, pn = _tmp(dst, "n"), _tmp(dst, "parts"), _tmp(dst, "pn")
    df = df.withColumn(nm, T.collapse_ws(t))
    n = F.col(nm)
    ln = F.length(n)
    df = df.withColumn(parts, F.filter(F.transform(F.split(n, r"\."), lambda p: F.trim(p)),
                                       lambda p: p != F.lit("")))
    # white space of n is ' ' alone, so a line break stands for the '.'
    norm = _norm_pieces(F.replace(n, F.lit("."), F.lit("\n")), "\n")
    df = df.withColumn(pn, F.filter(F.zip_with(F.split(n, r"\."), norm, lambda p, k: F.when(F.trim(p) != "", F.trim(k))),
                                    lambda k: k.isNotNull()))
    same = F.size(F.filter(F.col(pn), lambda p: p == F.element_at(F.col(pn), 1)))
    pat_a = F.when((ln >= 100) & (F.size(parts) >= 2) & (same >= F.size(parts) * 0.8),
                   F.concat(F.element_at(F.col(parts), 1), F.lit(".")))
    # (b): first prefix length L in [min_prefix, min(n // 2, max_prefix)] with count >= 2 and
    # count * L / n >= 0.7; only rows whose shortest prefix recurs can qualify.
    # A longer prefix recurs no more often, so after a length that recurs c times
    # none below 0.7 n / c covers enough: the aggregate goes on from there without
    # a look at the text. acc: the length found (0: none yet), the next one to try.
    hi = F.least(F.floor(ln / 2), F.lit(max_prefix)).cast("int")
    pre = F.expr(f"locate(substring(`{nm}`, 1, {min_prefix}), `{nm}`, {min_prefix + 1}) > 0")
    found = F.aggregate(
        F.when(hi >= min_prefix, F.sequence(F.lit(min_prefix), hi)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(0).alias("found"), F.lit(0).alias("next")),
        lambda acc, L: F.when((acc["found"] > 0) | (L < acc["next"]), acc).otherwise(_covers(n, ln, L)),
        lambda acc: acc["found"])
    Lname = _tmp(dst, "L")
    df = df.withColumn(Lname, F.when((ln >= 100) & pat_a.isNull() & pre, found).otherwise(F.lit(0)))
    L = F.col(Lname)
    pattern = F.substr(n, F.lit(1), L)
    last_dot = L - F.locate(".", F.reverse(pattern)) + 1
    pat_b = F.when(L > 0, F.when(pattern.contains(".") & (last_dot > 20),
                                 F.trim(F.substr(n, F.lit(1), last_dot)))
                   .otherwise(F.trim(pattern)))
    df = df.withColumn(_tmp(dst, "pat"), F.coalesce(pat_a, pat_b))
    pat = F.col(_tmp(dst, "pat"))
    use_pat = pat.isNotNull() & (pat != F.lit("")) & (F.length(pat) < ln * 0.6)
    # sentence-level dedup
    marked, sents, norms = _tmp(dst, "m"), _tmp(dst, "s"), _tmp(dst, "sn")
    df = df.withColumn(marked, T.mark_sentences(n, normalized=True))
    df = df.withColumn(sents, F.filter(F.split(F.col(marked), T.SENT_MARK), lambda s: F.trim(s) != ""))
    df = df.withColumn(norms, F.filter(F.zip_with(F.split(F.col(marked), T.SENT_MARK), _norm_pieces(F.col(marked), T.SENT_MARK),
                                                  lambda s, k: F.when(F.trim(s) != "", F.trim(k))), lambda k: k.isNotNull()))
    # first of equal sentences: sorted by (norm, place), a sentence is first where its norm begins;
    # only texts with equal or empty ones are put in order
    order, twice = _tmp(dst, "so"), _tmp(dst, "tw")
    df = df.withColumn(twice, (F.size(F.array_distinct(norms)) < F.size(norms)) | F.array_contains(norms, ""))
    df = df.withColumn(order, F.when(F.col(twice), F.sort_array(F.transform(F.col(norms), lambda k, i: F.struct(k.alias("k"), i.alias("i"))))))
    firsts = F.filter(F.col(order), lambda z, i: (z["k"] != F.lit("")) & ((i == 0) | (F.get(F.col(order), i - 1)["k"] != z["k"])))
    df = df.withColumn(_tmp(dst, "kept"), F.array_sort(F.transform(firsts, lambda z: z["i"])))
    kc = F.col(_tmp(dst, "kept"))
    joined = F.array_join(F.transform(kc, lambda i: F.trim(F.get(F.col(sents), i))), ". ")
    joined = F.when(joined.endswith("."), joined).otherwise(F.concat(joined, F.lit(".")))
    sent_dedup = F.when(F.col(twice) & (F.size(sents) > 1) & (F.size(kc) < F.size(sents)), joined)
    short = t.isNull() | (F.length(t) < 20)
    out = (F.when(short, t).when(use_pat, F.trim(pat))
           .otherwise(F.coalesce(sent_dedup, t)))
    df = df.withColumn(dst, out)
    return _drop_tmp(df, dst)


def _covers(n: Column, ln: Column, L: Column) -> Column:
    """found: L if count(prefix of length L) >= 2 and count * L / len >= 0.7, else 0;
    next: the first longer length that can reach it. The non-overlapping count is
    computed once (bound through a one-element array)."""
    cnt = ((ln - F.length(F.replace(n, _prefix(n, L), F.lit("")))) / L).cast("long")
    return F.element_at(F.transform(F.array(cnt), lambda c: F.struct(
        F.when((c >= 2) & (c * L / ln >= 0.7), L).otherwise(F.lit(0)).alias("found"),
        F.when(c >= 2, F.floor(ln * 0.7 / c)).otherwise(F.lit(BIG)).cast("int").alias("next"))), 1)


def _prefix(n: Column, L: Column) -> Column:
    return F.substr(n, F.lit(1), L)


# R7 -------------------------------------------------------------------------
def _strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\x0b\x0c\r" + K.EXOTIC_WS))


def truncate(df: DataFrame, src: str, dst: str, max_sentences: int = 3) -> DataFrame:
    """Keep first, middle (n // 2) and last sentence when there are more than
    ``max_sentences``; join with '. ' and end with '.'."""
    s = _tmp(dst, "s")
    df = df.withColumn(s, T.sentences(F.col(src)))
    arr = F.col(s)
    n = F.size(arr)
    first = _strip_ws(F.element_at(arr, 1))
    last = _strip_ws(F.element_at(arr, -1))
    mid = _strip_ws(F.element_at(arr, (F.floor(n / 2) + 1).cast("int")))
    if max_sentences >= 3:
        body = F.concat_ws(". ", first, mid, last)
    elif max_sentences == 2:
        body = F.concat_ws(". ", first, last)
    else:
        body = first
    df = df.withColumn(dst, F.when(n <= max_sentences, F.col(src)).otherwise(F.concat(body, F.lit("."))))
    return _drop_tmp(df, dst)


# R8 -------------------------------------------------------------------------
def _to_java(pattern: str) -> str:
    r"""Rewrite a Python pattern for Java: Unicode \w, and \b, which stands before the
    first letter or after a letter."""
    p = WB_L + pattern[2:] if pattern.startswith(r"\b") else pattern
    return p.replace(r"\b", WB_R).replace(r"\w", W)


POLITENESS_JAVA = tuple("(?idu)" + _to_java(p) for p in K.POLITENESS_PATTERNS)
#: The anchored patterns, and what one of them needs at the start of the text.
_GREETINGS, _GREETING = 3, "(?idu)^(?:hi|hello|hey|dear|good)"
# For each of the others a lower-case literal that every match contains, and the words
# it occurs in (our own gates).
_POLITENESS_GATES = (("thank", "thanks"), ("thank",), ("please",), ("kindly",), ("hope",), ("looking",),
                     ("question", "questions"), ("free",), ("hesitate",), ("know",), ("regard", "regards"), ("sincerely",), ("thank", "thanks"))
POLITENESS_RULES = tuple((k[0], p, "", list(k)) for k, p in zip(_POLITENESS_GATES, POLITENESS_JAVA[_GREETINGS:]))


def remove_politeness(df: DataFrame, src: str, dst: str) -> DataFrame:
    """The 16 greeting / thanks / please / sign-off patterns in order
    (case-insensitive), then collapse whitespace."""
    low, even, start, left = _tmp(dst, "low"), _tmp(dst, "even"), _tmp(dst, "start"), _tmp(dst, "left")
    df = df.withColumns({low: F.lower(F.col(src)), even: T.norm_ws(F.col(src))})
    x = F.col(even)
    for p in POLITENESS_JAVA[:_GREETINGS]:
        x = F.regexp_replace(x, p, "")
    df = df.withColumn(start, F.when(F.substring(F.col(even), 1, 5).rlike(_GREETING), x).otherwise(F.col(even)))
    df = df.withColumn(left, F.lower(F.col(start)))  # a greeting may hide a word's start
    # Removal only shortens the text, so gating on the original lower-cased
    # text is exact; the gate literal sits inside every match.
    df = _rule_fold(df, _tmp(dst, "x"), start, left, POLITENESS_RULES, gate_on=lambda acc: F.col(low), odd=F.col(start).rlike(FOLDED))
    return _drop_tmp(df.withColumn(dst, T.collapse_even(F.col(_tmp(dst, "x")))), dst)


# R9 -------------------------------------------------------------------------
def core_question(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Sentences with '?' or an action word (substring); first two joined
    by a space; else the first sentence; else the text."""
    s = _tmp(dst, "s")
    df = df.withColumn(s, F.transform(T.sentences(F.col(src)), _strip_ws))

    # action words anywhere in the sentence; lower-casing and the ASCII pattern agree on them
    is_core = lambda x: x.rlike(r"(?i)\?|" + _either(K.ACTION_WORDS))
    core = F.filter(F.col(s), is_core)
    df = df.withColumn(_tmp(dst, "c"), core)
    c = F.col(_tmp(dst, "c"))
    out = (F.when(F.size(c) > 0, F.array_join(F.slice(c, 1, 2), " "))
           .when(F.size(F.col(s)) > 0, F.element_at(F.col(s), 1)).otherwise(F.col(src)))
    df = df.withColumn(dst, out)
    return _drop_tmp(df, dst)


# R10 ------------------------------------------------------------------------
def reused(df: DataFrame, stage, src: str, dst: str, known: tuple[str, str] | None) -> DataFrame:
    """``stage(df, src, dst)``, where ``known`` names a source and the result the stage
    gave for it: rows with the same text in both sources take that result."""
    if known is None:
        return stage(df, src, dst)
    new, made, same = _tmp(dst, "new"), _tmp(dst, "made"), F.col(src).eqNullSafe(F.col(known[0]))
    df = stage(df.withColumn(new, F.when(~same, F.col(src))), new, made)
    return _drop_tmp(df.withColumn(dst, F.when(same, F.col(known[1])).otherwise(F.col(made))), dst)


def aggressive(df: DataFrame, src: str, dst: str, known: dict | None = None) -> DataFrame:
    """R5 → R8 → R1 → R2 → R3 → R4 → (R9 when over 30 words) → tidy spaces
    and punctuation → capital first letter. ``known``: for a step, names of a source
    and of its result that df holds already."""
    steps = [dedup_content, remove_politeness, remove_verbose, remove_fillers,
             remove_redundancy, compress]
    cur = src
    for i, step in enumerate(steps):
        nxt = _tmp(dst, f"a{i}")
        df = reused(df, step, cur, nxt, (known or {}).get(step))
        cur = nxt
    cq = _tmp(dst, "core")
    df = core_question(df, cur, cq)
    x = F.when(T.ws_word_count(F.col(cur)) > 30, F.col(cq)).otherwise(F.col(cur))
    df = df.withColumn(_tmp(dst, "c"), x)
    x = T.collapse_ws(F.col(_tmp(dst, "c")))
    x = F.regexp_replace(x, r"\s+([.,!?;:])", "$1")
    df = df.withColumn(_tmp(dst, "x"), x)
    df = df.withColumn(dst, capitalize_first(F.col(_tmp(dst, "x"))))
    return _drop_tmp(df, dst)


# R11 ------------------------------------------------------------------------
def replace_words(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Word-for-word replacements (utilize → use, …) on whitespace words,
    matched case-insensitively; other words unchanged."""
    m = F.create_map(*[F.lit(x) for kv in K.WORD_REPLACEMENTS for x in kv])
    words = T.ws_words(F.col(src))
    return df.withColumn(dst, F.array_join(
        F.transform(words, lambda w: F.coalesce(m[F.lower(w)], w)), " "))


# M1 -------------------------------------------------------------------------
def word_set(c: Column) -> Column:
    return F.array_distinct(T.ws_words(F.lower(c)))


def jaccard(a: Column, b: Column) -> Column:
    """M1: |A ∩ B| / |A ∪ B| over lower-cased whitespace word sets; 0 when
    both are empty."""
    return jaccard_of_sets(word_set(a), word_set(b))


def jaccard_of_sets(A: Column, B: Column) -> Column:
    both = F.array_size(F.array_intersect(A, B))
    union = F.array_size(A) + F.array_size(B) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def best_paraphrase(text: Column, alternatives: Column, min_similarity: float, similarity=jaccard) -> Column:
    """Of an array of paraphrases the one with the highest mean of token
    reduction and similarity, among those with fewer tokens than the text and a
    similarity of at least max(0.55, min_similarity - 0.15); null if there is
    none, or if the first one is the text itself."""
    tokens, limit = T.ws_word_count(text), max(0.55, min_similarity - 0.15)
    scored = F.transform(alternatives, lambda a: F.struct(T.ws_word_count(a).alias("n"), similarity(text, a).alias("s"), a.alias("a")))
    fit = F.filter(scored, lambda z: (z["s"] >= limit) & (z["n"] < tokens))
    best = F.aggregate(fit, F.struct(F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("a")), lambda acc, z: F.when(
        0.5 * (tokens - z["n"]) / tokens + 0.5 * z["s"] > acc["score"],
        F.struct((0.5 * (tokens - z["n"]) / tokens + 0.5 * z["s"]).alias("score"), z["a"].alias("a"))).otherwise(acc), lambda acc: acc["a"])
    return F.when(F.coalesce(F.get(alternatives, F.lit(0)) != text, F.lit(False)), best)


def cosine(a: Column, b: Column) -> Column:
    """M2: cosine of two float arrays; 0 when a norm is 0."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, v: s + v * v))
    return F.when((na > 0) & (nb > 0), dot / (na * nb)).otherwise(F.lit(0.0))
