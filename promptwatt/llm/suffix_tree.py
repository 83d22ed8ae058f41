"""LM scoring with a probabilistic suffix tree (operator 2).

The model reads a text as its lower-cased words joined by single spaces and
closed by an end mark, byte by byte. Contexts are the last 1 to DEPTH bytes. One
pass counts all (DEPTH + 1)-byte windows of the training texts; shorter ones are
sums of these. Level by level, a context's next-byte distribution is smoothed
towards that of its suffix (Witten-Bell: with N occurrences and T distinct next
bytes, P = (n + T * P_suffix) / (N + T); the root adds half a count to each of
the 256 bytes). A context is retained if its distribution diverges from its
suffix's: N * KL(context, suffix) > T / 2 * ln(all bytes), the price of its T
parameters. Suffixes of retained contexts are retained too; no context that passes
the test is dropped, so the model that tasks receive grows with their number. A byte is scored in the state of its longest retained
suffix.

The base score needs the training count of every token. The HOT_WORDS most
frequent words (a fixed number) go to every task; all other tokens are joined to
the table of counts by word.

Defined results: null texts are empty and consist of the end token only; a null
doc_id has remainder 0 (training); repeated rows are rows of their own and all
train; ties among words at a bound are broken by value; a very long
text is read by itself; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import byte_texts, slices, stored

DEPTH = 5
HOT_WORDS = 100_000
END = b"\n"
#: Partial counts are handed on, or merged, at these sizes.
FLUSH_WORDS, FLUSH_GRAMS, CHUNK = 100_000, 1 << 20, 1 << 20
#: Bytes of texts that are split into words at a time.
SLICE_BYTES = 4 << 20


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, of at most SLICE_BYTES of text (or one text) at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
        for i, j in slices(np.cumsum(sizes), 0, SLICE_BYTES):
            yield batch.slice(i, j - i)


def chunks(texts: list[list[bytes]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of some word lists at a time: their range, the windows of DEPTH + 1 bytes
    as numbers (one for each byte scored) and where each text's windows begin."""
    k = 0
    while k < len(texts):
        first, parts, sizes, held = k, [], [], 0
        while k < len(texts) and (held < CHUNK or k == first):
            seq = b" ".join(texts[k]) + END
            parts += [END * DEPTH, seq]
            sizes.append(len(seq))
            held += len(seq)
            k += 1
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        code = data[DEPTH:].copy()
        for j in range(1, DEPTH + 1):
            code |= data[DEPTH - j:len(data) - j] << np.uint64(8 * j)
        sizes = np.array(sizes)
        starts = np.cumsum(sizes) - sizes
        keep = np.ones(len(code), bool)  # not the windows that end in a text's padding
        if len(sizes) > 1:
            gaps = (starts + np.arange(len(sizes)) * DEPTH)[1:]
            keep[(gaps[:, None] - DEPTH + np.arange(DEPTH)).ravel()] = False
        yield first, k, code[keep], starts


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their sums."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    total = np.diff(np.append(first, len(keys))) if counts is None else (np.add.reduceat(counts, first) if len(first) else counts)
    return keys[first], total


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def of_words(found: Counter) -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(list(found), pa.binary()), "gram": pa.nulls(len(found), pa.int64()), "n": pa.array(list(found.values()), pa.int64())})

    def of_grams(found: list) -> tuple[np.ndarray, np.ndarray]:
        return summed(*(np.concatenate(x) for x in zip(*found)))

    words: Counter = Counter()
    grams: list = []
    held = 0
    for batch in parts_of(batches):
        texts = [t.lower().split() for t in byte_texts(batch, "text")]
        words[b""] += len(texts)  # the end token, which no word equals
        for t in texts:
            words.update(t)
            if len(words) > FLUSH_WORDS:
                yield of_words(words)
                words = Counter()
        for _, _, code, _ in chunks(texts):
            grams.append(summed(code))
            held += len(grams[-1][0])
            if held > FLUSH_GRAMS:
                grams = [of_grams(grams)]
                held = 0
    yield of_words(words)
    if grams:
        keys, n = of_grams(grams)
        yield pa.record_batch({"word": pa.nulls(len(keys), pa.binary()), "gram": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))})


def counts(training: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of all training texts: (word, n) with the end token as the empty word,
    and (gram, n) of windows of DEPTH + 1 bytes."""
    rows = training.select("text").mapInArrow(_count_rows, "word binary, gram long, n long")
    rows = stored(rows.groupBy("word", "gram").agg(F.sum("n").alias("n")), "suffix-counts")
    return rows.filter("word is not null").select("word", "n"), rows.filter("gram is not null").select("gram", "n")


def tree(grams: DataFrame) -> dict:
    """The retained tree: total, and by depth the entries (windows with their
    log10 probabilities) and states (contexts with log10 of their back-off)."""
    levels = {DEPTH: stored(grams, "suffix-level")}
    for d in range(DEPTH - 1, -1, -1):
        up = levels[d + 1].select(F.col("gram").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("gram"), "n")
        levels[d] = stored(up.groupBy("gram").agg(F.sum("n").alias("n")), "suffix-level")
    total = levels[0].agg(F.sum("n")).first()[0] or 0
    smooth = {0: levels[0].withColumn("p", (F.col("n") + 0.5) / F.lit(total + 128.0))}
    states = {}
    for d in range(1, DEPTH + 1):
        x = levels[d].withColumns({"state": F.shiftright("gram", 8), "up": F.col("gram").bitwiseAND((1 << 8 * d) - 1)})
        x = x.join(smooth[d - 1].select(F.col("gram").alias("up"), F.col("p").alias("p_up")), "up")
        kl = F.sum(F.col("n") * F.log(F.col("n") / F.col("p_up")))
        s = x.groupBy("state").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), kl.alias("kl"))
        s = s.withColumn("gain", F.col("kl") - F.col("total") * F.log("total"))
        smooth[d] = stored(x.join(s.select("state", "total", "kinds"), "state").select(
            "gram", "state", ((F.col("n") + F.col("kinds") * F.col("p_up")) / (F.col("total") + F.col("kinds"))).alias("p")), "suffix-smooth")
        states[d] = s.select("state", F.lit(d).alias("depth"), "gain", (F.col("kinds") / (F.col("total") + F.col("kinds"))).alias("back"),
                             (F.col("gain") > F.col("kinds") / 2 * math.log(total + 1)).alias("diverges"))
    all_states = states[1]
    for d in range(2, DEPTH + 1):
        all_states = all_states.unionByName(states[d])
    all_states = stored(all_states, "suffix-states")
    closed = {}
    for d in range(DEPTH, 0, -1):
        own = all_states.filter((F.col("depth") == d) & F.col("diverges")).select("state")
        if d < DEPTH:
            own = own.unionByName(closed[d + 1].select(F.col("state").bitwiseAND((1 << 8 * d) - 1).alias("state")))
        closed[d] = stored(own.distinct(), "suffix-closed")
    root = smooth[0].orderBy("gram").toArrow()
    out = {"root": np.full(256, math.log10(0.5 / (total + 128.0))), "states": {}, "entries": {}}
    out["root"][root["gram"].to_numpy()] = np.log10(root["p"].to_numpy())
    for d in range(1, DEPTH + 1):
        e = smooth[d].join(closed[d], "state").select("gram", "p").orderBy("gram").toArrow()
        out["entries"][d] = (e["gram"].to_numpy().astype(np.uint64), np.log10(e["p"].to_numpy()))
        backs = all_states.filter(F.col("depth") == d).join(closed[d], "state").select("state", "back").toArrow()
        s = backs["state"].to_numpy().astype(np.uint64)
        order = np.argsort(s)
        out["states"][d] = (s[order], np.log10(backs["back"].to_numpy()[order]))
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys if len(table) else np.zeros(len(keys), bool))


def log_probs(model: dict, windows: np.ndarray) -> np.ndarray:
    """log10 probabilities of the last bytes of windows, after the others."""
    p = model["root"][(windows & np.uint64(255)).astype(np.int64)]
    for d in range(1, DEPTH + 1):
        code = windows & np.uint64((1 << 8 * (d + 1)) - 1)
        at, known = _find(model["states"][d][0], code >> np.uint64(8))
        if not known.any():
            break
        back = p[known] + model["states"][d][1][at[known]]
        to, seen = _find(model["entries"][d][0], code[known])
        p[known] = np.where(seen, model["entries"][d][1][to], back) if len(model["entries"][d][0]) else back
    return p


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("held_out", held_out(F.col("doc_id")))
    words, grams = counts(docs.filter(~F.col("held_out")))
    seen = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("v")).first()
    n_all, base = seen.n, math.log10(seen.n + 0.5 * (seen.v + 1))
    words = words.filter("n > 0")
    hot = words.orderBy(F.desc("n"), "word").limit(HOT_WORDS).toArrow()
    hot = {w: math.log10(n + 0.5) for w, n in zip(hot["word"].to_pylist(), hot["n"].to_pylist())}
    shared = spark.sparkContext.broadcast((tree(grams), hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in parts_of(batches):
            texts = [t.lower().split() for t in byte_texts(batch, "text")]
            out: dict[str, list] = {k: [] for k in ("hot_known", "hot_score", "rare")}
            for t in texts:
                own = [known.get(w) for w in (*t, b"")]
                got = [x for x in own if x is not None]
                out["hot_known"].append(len(got))
                out["hot_score"].append(math.fsum(got))
                out["rare"].append([w for w, x in zip((*t, b""), own) if x is None] if len(got) < len(own) else [])
            scores = np.zeros(len(texts))
            sizes = np.zeros(len(texts), np.int64)
            for a, b, code, starts in chunks(texts):
                distinct, back = np.unique(code, return_inverse=True)
                scores[a:b] = np.add.reduceat(log_probs(model, distinct)[back], starts)
                sizes[a:b] = np.diff(np.append(starts, len(code)))
            n = len(texts)
            yield pa.record_batch([
                pa.array(np.arange(row, row + n)), batch.column("doc_id"), batch.column("held_out"), pa.array([len(t) + 1 for t in texts], pa.int64()),
                pa.array(out["hot_known"], pa.int64()), pa.array(out["hot_score"], pa.float64()), pa.array(out["rare"], pa.list_(pa.binary())), pa.array(scores), pa.array(sizes)],
                ["row", "doc_id", "held_out", "n_tokens", "hot_known", "hot_score", "rare", "score", "n_bytes"])
            row += n

    scored = stored(docs.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_score double, rare array<binary>, score double, n_bytes long"), "suffix-scored")
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("k"))
    rare = rare.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("rare_known"), F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_score"))
    out = scored.drop("rare").join(rare, "row", "left").withColumn("n_known", F.col("hot_known") + F.coalesce("rare_known", F.lit(0)))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
                      (F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0)) - F.col("n_tokens") * F.lit(base)).alias("base_score"), "score", "n_bytes")
