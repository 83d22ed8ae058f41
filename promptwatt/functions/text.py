"""Column-expression builders for text (all JVM-side, no Python UDFs).

Token contract (documented in the README): the cleaner collapses Unicode
whitespace to single spaces, trims, then drops control characters. Word tokens
are the lower-cased text with every character that is not a letter, a digit
or a hyphen turned into a space, split on spaces, keeping the pieces that are
entirely letters/digits (hyphenated words drop out). Sentences end after a run
of ``.!?`` followed by whitespace. The token count is the whitespace word count.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

SENT_MARK = "\u0001"
# K.EXOTIC_WS; three comparisons settle a character of most scripts.
_EXOTIC = r"[\x1c\x1d\x1e\x1f\x85\xa0[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"

# Control characters that are not whitespace.
_CTRL_NOT_WS = r"[\x00-\x1b\x7f-\x9f&&[^\x09-\x0d\x85]]"
# Both of them: low characters listed one by one are settled by one lookup.
_ODD = ("[[" + r"\x{1680}-\x{3000}&&" + _EXOTIC[_EXOTIC.index("&&") + 2:-2] + "]"
        + "".join(rf"\x{c:02x}" for c in (*range(0x09), *range(0x0e, 0x20), *range(0x7f, 0xa1))) + "]")
# Letters by how common they are in English.
_COMMON_FIRST = " etaoinshrdlcumwfgypbvkjxqz"
# From a ' ' to a later one over lower-case words alone.
_PLAIN_WORDS = r" [a-z[ \p{Ll}]]* "


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half(c: Column, digits: int) -> Column:
    """Round half up by ``floor(x * 10^d + 0.5) / 10^d``.

    Written the same way in the oracle SQL, so both engines produce the same
    double bit for bit (Spark's ``round`` and DuckDB's ``round`` disagree on
    values whose shortest decimal form ends in 5).
    """
    scale = float(10 ** digits)
    return (F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def norm_ws(c: str | Column) -> Column:
    """Map the rare non-ASCII whitespace characters to ' ' (one-to-one, so
    lengths and positions are unchanged); Java's ``\\s`` then equals the
    Unicode whitespace class and regexes stay on the fast path. A text without
    a match comes back as it is; ``translate`` would look up every character."""
    return F.regexp_replace(col(c), _EXOTIC, " ")


def clean(c: str | Column) -> Column:
    """Collapse whitespace, trim, strip control characters."""
    odd = is_odd(c)
    return drop_control(collapse_ws(c, odd), has_control(c, odd))


def is_odd(c: str | Column) -> Column:
    """Whether the text holds non-ASCII whitespace or control characters other than
    the whitespace ``\\s`` knows; most texts hold none, and one pass settles both."""
    return col(c).cast("string").rlike(_ODD)


def has_control(c: str | Column, odd: Column | None = None) -> Column:
    """Whether the text holds control characters that are not whitespace."""
    found = col(c).cast("string").rlike(_CTRL_NOT_WS)
    return found if odd is None else F.when(odd, found).otherwise(F.lit(False))


def drop_control(collapsed: Column, has_ctrl: Column) -> Column:
    """The second half of C1: collapsed white space holds no control characters,
    so only a text with others (:func:`has_control`) is passed over."""
    return F.when(has_ctrl, F.regexp_replace(collapsed, f"[{K.CTRL}]", "")).otherwise(collapsed)


def collapse_ws(c: str | Column, odd: Column | None = None) -> Column:
    """Whitespace collapse + trim only (the first half of C1)."""
    c = col(c).cast("string")
    even = norm_ws(c) if odd is None else F.when(odd, norm_ws(c)).otherwise(c)
    return collapse_even(even)


def collapse_even(c: Column) -> Column:
    """Whitespace collapse + trim of a text whose white space ``\\s`` knows; what is a
    single ' ' already is left alone."""
    return F.trim(F.regexp_replace(c, r"\s(?:\s+|(?<! ))", " "))


def without_plain_words(c: str | Column) -> Column:
    """The text without the lower-case words between two spaces. All else stays
    beside the same neighbours, so counts of other characters, of patterns made of
    them and of words that aren't all lower-case are those of the whole text."""
    return F.regexp_replace(col(c), _PLAIN_WORDS, " ")


def clean_prompt(c: str | Column, min_chars: int = 6) -> Column:
    """White space collapsed and trimmed; null if fewer than ``min_chars``
    characters remain (a null text counts as too short)."""
    x = F.trim(collapse_ws(c))
    return F.when(F.length(x) >= min_chars, x)


def word_tokens(c: str | Column) -> Column:
    """Lower-cased, fully alphanumeric word tokens (array<string>)."""
    # A run holds only letters, digits and '-', so "all alphanumeric" is "no hyphen".
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"[a-z[\p{L}\p{N}\-]]+"), F.lit(0))
    return F.filter(runs, lambda x: ~x.contains("-"))


def sentences(c: str | Column, normalized: bool = False) -> Column:
    """Sentence pieces (array<string>), empty pieces dropped.

    ``normalized``: the input holds no non-ASCII whitespace (cleaned text or
    :func:`norm_ws` output), so the faster ``\\s`` classes are exact."""
    nws = r"\S" if normalized else f"[^{K.WS}]"
    return F.filter(F.split(mark_sentences(c, normalized), SENT_MARK), lambda s: s.rlike(nws))


def mark_sentences(c: str | Column, normalized: bool = False) -> Column:
    """The text with SENT_MARK for the white space after each sentence."""
    ws = r"\s" if normalized else f"[{K.WS}]"
    return F.regexp_replace(col(c), f"([.!?]+){ws}+", "$1" + SENT_MARK)


def even_sentences(c: str | Column) -> Column:
    """:func:`sentences` of a trimmed text whose only white space is single ' ':
    none is empty unless the text is."""
    marked = F.regexp_replace(col(c), r"([.!?]+) ", "$1" + SENT_MARK)
    return F.array_remove(F.split(marked, SENT_MARK), "")


def ws_word_count(c: str | Column, normalized: bool = False) -> Column:
    """Number of whitespace-separated words (Python ``len(s.split())``)."""
    c = col(c) if normalized else norm_ws(c)
    return F.regexp_count(c, F.lit(r"\S+")).cast("long")


def count_chars(c: str | Column, chars: str) -> Column:
    """Occurrences of any of the given single characters."""
    return reduce(Column.__add__, [count_sub(c, x) for x in dict.fromkeys(chars)])


def ws_words(c: str | Column) -> Column:
    """Whitespace-separated words (array<string>), no empty pieces; without a
    lambda, so that one projection splits a text once however often it is asked."""
    return F.array_remove(F.split(collapse_ws(c), " "), "")


def count_sub(c: str | Column, sub: str) -> Column:
    """Non-overlapping occurrences of a literal substring (``str.count``), from
    sizes in bytes, which take no pass over the text."""
    c = col(c)
    removed = F.octet_length(c) - F.octet_length(F.replace(c, F.lit(sub), F.lit("")))
    return (removed / F.lit(len(sub.encode()))).cast("long")


def contains_word(c: str | Column, word: str) -> Column:
    """Whether the text holds a literal. A search tries each place of its first
    byte, so the part from its rarest letter on is looked for first."""
    starts = range(max(1, len(word) - 2))
    part = word[max(starts, key=lambda i: (_COMMON_FIRST.find(word[i]), -i)):]
    found = col(c).contains(word)
    return found if part == word else col(c).contains(part) & found


def count_regex(c: str | Column, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern)).cast("long")


def count_in(arr: str | Column, words: Iterable[str]) -> Column:
    """Elements of ``arr`` that belong to a fixed word set (with multiplicity).

    ``isin`` with many literals is rewritten by Catalyst into a hashed InSet,
    so this is one hash probe per token.
    """
    ws = list(words)
    return F.size(F.filter(col(arr), lambda x: x.isin(*ws))).cast("long")


def total_length(arr: str | Column) -> Column:
    """Sum of element lengths of a string array."""
    return F.length(F.array_join(col(arr), "")).cast("long")


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def preview(c: str | Column, n: int = K.PREVIEW_CHARS) -> Column:
    """First ``n`` characters plus '...' when longer."""
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def privacy_hash(c: str | Column) -> Column:
    """C4: first 16 hex chars of SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(col(c), 256), 1, 16)


def bucketize(c: Column, bounds, top_label: str) -> Column:
    """``when`` chain over ascending (upper_bound, label) pairs, strict ``<``."""
    expr = None
    for bound, label in bounds:
        expr = (F.when(c < bound, label) if expr is None
                else expr.when(c < bound, label))
    return expr.otherwise(top_label)
