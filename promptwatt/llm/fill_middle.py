"""Fill-in-middle transformation (operator 11): texts cut between lines and their
parts put in the order in which a model learns to fill the middle.

A text is n units, its lines with their ends. Two draws (fixed by seed and doc_id)
choose the units after which prefix and middle end. Cutting works on whole Arrow
batches: the UTF-8 bytes of many texts are viewed as 64-bit words; arithmetic on
a word marks each of its bytes that ends a line (and, likewise, each that starts
a code point), bitwise_count gives the marks of a word, and their running sum
is searched for the word that holds the k-th mark, which is then resolved inside
the word by comparing its eight running byte counts at once. No text is split into
lines and no character is a Python object.

The output is `<P>`prefix`<S>`suffix`<M>`middle (form psm), `<S>`suffix`<P>`prefix
`<M>`middle (spm) or the text itself (plain). Texts that hold a mark stay plain, so
`restored` gives back every text exactly.

Defined results: null texts are empty; empty texts are plain with n = 0; a null
doc_id draws like the empty string; repeated rows are transformed each by itself,
with equal results (there are no ties to break); very long texts take a slice of
memory of their own, some four times their size; an empty table gives an empty
result; only the key and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices

#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 4 << 20

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def byte_marks(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of each byte that equals `byte`; no carry crosses a byte."""
    x = words ^ (ONES * np.uint64(byte))
    return ~(((x & LOW) + LOW) | x | LOW)


def start_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that starts a code point (is not 10xxxxxx)."""
    return ~(words & ~(words << np.uint64(1))) & HIGH


class Marks:
    """Rank and select over the marked bytes of an array of words."""

    def __init__(self, marks: np.ndarray):
        self.marks = np.append(marks, np.uint64(0))
        self.before = np.zeros(len(self.marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.before[1:], dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many of the bytes before position `at` are marked."""
        word, low = at >> 3, ((at & 7) << 3).astype(np.uint64)
        inside = self.marks[word] & ((np.uint64(1) << low) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The position of the mark that k marks precede."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left = (k - self.before[word]).astype(np.uint64)
        upto = (self.marks[word] >> np.uint64(7)) * ONES  # byte i: marks in bytes 0 to i
        not_yet = ((left * ONES | HIGH) - upto) & HIGH    # set where upto <= left
        return word * 8 + np.bitwise_count(not_yet)


class Lines:
    """Lines of the texts data[begin:end] that lie one after the other in data."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        padded = np.zeros(len(data) + 7 >> 3, "<u8")
        padded.view(np.uint8)[:len(data)] = data
        self.begin, self.end = begin, end
        self.ends, self.starts = Marks(byte_marks(padded, 0x0A)), Marks(start_marks(padded))
        self.first = self.ends.rank(begin)
        self.whole = self.ends.rank(end) - self.first  # lines with their end
        open_end = (end > begin) & (data[np.maximum(end - 1, 0)] != 0x0A) if len(data) else end > begin
        self.n = self.whole + open_end

    def after(self, k: np.ndarray) -> np.ndarray:
        """Position after the first k lines of each text."""
        inner = (k > 0) & (k <= self.whole)
        at = np.where(k > 0, self.end, self.begin)
        at[inner] = self.ends.select((self.first + k - 1)[inner]) + 1
        return at

    def chars(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.starts.rank(end) - self.starts.rank(begin)


def _cut(text: pa.Array, draws: list[np.ndarray], percents: tuple[int, int]) -> dict[str, pa.Array]:
    """Columns n, form, prefix_chars, middle_chars and output of a slice."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.empty(0, np.uint8)
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    lines = Lines(data, begin, end)
    one, two = draws[0] % (lines.n + 1), draws[1] % (lines.n + 1)
    p, q = lines.after(np.minimum(one, two)), lines.after(np.maximum(one, two))
    plain = (begin == end) | (draws[2] % 100 >= percents[0])
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(text, mark).to_numpy(zero_copy_only=False)
    spm = draws[3] % 100 < percents[1]
    whole, out = memoryview(data), []
    for b, i, j, e, is_plain, is_spm in zip(*(x.tolist() for x in (begin, p, q, end, plain, spm))):
        if is_plain:
            out.append(bytes(whole[b:e]))
        elif is_spm:
            out.append(b"".join((b"<S>", whole[j:e], b"<P>", whole[b:i], b"<M>", whole[i:j])))
        else:
            out.append(b"".join((b"<P>", whole[b:i], b"<S>", whole[j:e], b"<M>", whole[i:j])))
    return {"n": pa.array(lines.n), "form": pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
            "prefix_chars": pa.array(lines.chars(begin, p), mask=plain), "middle_chars": pa.array(lines.chars(p, q), mask=plain),
            "output": pa.array(out, pa.binary()).view(pa.string())}


def draws(key: Column, seed: int, n: int = 4) -> list[Column]:
    """n unsigned 32-bit numbers from the digest of `seed:key`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """A row for each row of docs: key, n, form, prefix_chars, middle_chars, output.
    `rate` percent of the texts are cut, `spm` percent of those suffix first."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("t").cast(pa.large_binary()), b"")
            if not len(texts):
                continue
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            drawn = [batch.column(f"h{k}").to_numpy() for k in range(4)]
            for i, j in slices(bounds[1:], int(bounds[0]), SLICE_BYTES):
                cut = _cut(texts.slice(i, j - i), [x[i:j] for x in drawn], (rate, spm))
                yield pa.record_batch([batch.column("k").slice(i, j - i), *cut.values()], ["k", *cut])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col(key), seed))])
    out = rows.mapInArrow(run, f"k {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("k", key)


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output: what lies between the marks, in text order."""
    parts = F.split(output, "<[PSM]>", 4)
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(parts[2], parts[3], parts[1]))
