"""Quality rules (operator 3): length and repetition rules on whole texts, then
the Jensen-Shannon distance between a document's character-class and
common-word histograms and the references of its language.

The references are sums over all documents of the language that pass the base
rules. A common word is one that makes up at least COMMON_SHARE of its
language's words, so a language has at most 1 / COMMON_SHARE of them and the
references of MAX_LANGUAGES languages have a proven size bound; languages
beyond the most frequent MAX_LANGUAGES share one pooled reference.

Null texts count as texts without words (they fail the base rules); a null
language is a language of its own; rows are judged one by one, so repeated
rows and ties get equal verdicts; further columns of the input are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SPACES, byte_texts, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LANGUAGES = 256
COMMON_SHARE = 0.002
#: Guards: texts with fewer words are not held against the references, and since
#: short histograms are noisy, the limit on the word distance is wider by
#: WORD_SCATTER / sqrt(words).
MIN_WORDS_FOR_TESTS = 50
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE, WORD_SCATTER = 0.24, 1.6
SYMBOLS = b"#*$%&|<>"
#: A partial word count is handed on when it holds this many words.
FLUSH_WORDS = 200_000
POOLED = "\x00pooled"

#: Character classes by (first) byte; continuation bytes of UTF-8 have none.
CLASSES = ("lower", "upper", "digit", "space", "stop", "bracket", "symbol", "control",
           "latin", "two_byte", "three_byte", "four_byte")


def _class_of() -> np.ndarray:
    of = np.full(256, CLASSES.index("symbol"))
    of[:32] = of[127] = CLASSES.index("control")
    of[0x80:0xC0] = len(CLASSES)
    for name, chars in (("space", SPACES), ("stop", b".,;:!?"), ("bracket", b"()[]{}'\"-")):
        of[list(chars)] = CLASSES.index(name)
    for name, lo, hi in (("digit", 0x30, 0x3A), ("upper", 0x41, 0x5B), ("lower", 0x61, 0x7B), ("latin", 0xC2, 0xC4),
                         ("two_byte", 0xC4, 0xE0), ("three_byte", 0xE0, 0xF0), ("four_byte", 0xF0, 0x100)):
        of[lo:hi] = CLASSES.index(name)
    return of


CLASS_OF = _class_of()


def class_counts(text: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.bincount(CLASS_OF, weights=by_byte, minlength=len(CLASSES) + 1)[:-1]


def repeated_positions(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    # numbers of pairs first, so that three-word keys stay exact for any text
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    keys = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    tight = text.translate(None, SPACES)
    chars = len(tight) - int(np.count_nonzero((np.frombuffer(tight, np.uint8) & 0xC0) == 0x80))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_positions(words))


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms; 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = sum(np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, q))
    return float(np.sqrt(max(kl / 2, 0.0)))


def _reference_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    classes: dict = {}

    def rows(found: list) -> pa.RecordBatch:
        lang, kind, key, n = zip(*found) if found else ((), (), (), ())
        return pa.record_batch({"lang": pa.array(lang, pa.string()), "kind": pa.array(kind, pa.string()),
                                "key": pa.array(key, pa.binary()), "n": pa.array(n, pa.int64())})

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), byte_texts(batch, "text")):
            found = text.split()
            if base_fails(len(found), repeated_positions(found)):
                continue
            classes[lang] = classes.get(lang, 0) + class_counts(text)
            words.update((lang, w) for w in found)
            if len(words) > FLUSH_WORDS:
                yield rows([(x, "word", w, n) for (x, w), n in words.items()])
                totals = Counter()
                for (x, _), n in words.items():
                    totals[x] += n
                yield rows([(x, "total", b"", n) for x, n in totals.items()])
                words.clear()
    totals = Counter()
    for (x, _), n in words.items():
        totals[x] += n
    yield rows([(x, "word", w, n) for (x, w), n in words.items()] + [(x, "total", b"", n) for x, n in totals.items()]
               + [(x, "class", str(k).encode(), int(n)) for x, c in classes.items() for k, n in enumerate(c) if n])


def references(docs: DataFrame) -> dict[str | None, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """By language: class counts, common words by number, their counts with the
    count of all other words last."""
    rows = (docs.select("lang", "text").mapInArrow(_reference_rows, "lang string, kind string, key binary, n long")
            .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    rows = stored(rows, "rules-reference")
    top = [r.lang for r in rows.filter("kind = 'total'").orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()]
    keep = F.lit(False)
    for x in top:
        keep = keep | F.col("lang").eqNullSafe(F.lit(x))
    rows = (rows.withColumn("lang", F.when(keep, F.col("lang")).otherwise(F.lit(POOLED)))
            .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    small = rows.filter("kind <> 'word'").collect()  # at most 257 languages of 13 rows
    total = {r.lang: r.n for r in small if r.kind == "total"}
    classes: dict = {x: np.zeros(len(CLASSES)) for x in total}
    for r in small:
        if r.kind == "class":
            classes[r.lang][int(r.key)] = r.n
    common = F.lit(False)
    for x, n in total.items():
        common = common | (F.col("lang").eqNullSafe(F.lit(x)) & (F.col("n") >= COMMON_SHARE * n))
    words: dict = {x: [] for x in total}
    for r in rows.filter("kind = 'word'").filter(common).collect():  # at most 1 / COMMON_SHARE a language
        words[r.lang].append((bytes(r.key), r.n))
    out = {}
    for x, found in words.items():
        found.sort()
        counts = [n for _, n in found]
        out[x] = (classes[x], {w: k for k, (w, _) in enumerate(found)}, np.array([*counts, total[x] - sum(counts)], float))
    return out


def quality_rules(docs: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE,
                  max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """A verdict for each row of docs (doc_id, text, lang)."""
    known = docs.sparkSession.sparkContext.broadcast(references(docs))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = known.value
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), byte_texts(batch, "text")):
                words = text.split()
                base = base_counts(text, words)
                failed = base_fails(base[0], base[4])
                ref = refs.get(lang, refs.get(POOLED))
                char_d = word_d = None
                if ref is not None and len(words) >= MIN_WORDS_FOR_TESTS:
                    char_d = distance(class_counts(text), ref[0])
                    counts = np.bincount([ref[1].get(w, len(ref[1])) for w in words], minlength=len(ref[2]))
                    word_d = distance(counts, ref[2])
                kept = not failed and (char_d is None or char_d <= max_char_distance and word_d <= max_word_distance + WORD_SCATTER / math.sqrt(len(words)))
                out.append((*base, failed, kept, char_d, word_d))
            cols = list(zip(*out)) or [()] * 9
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")
            kinds = (*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64(), pa.float64())
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), "text", "lang").mapInArrow(
        judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "base_failed boolean, kept boolean, char_distance double, word_distance double")
