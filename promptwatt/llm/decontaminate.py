"""Benchmark decontamination (operator 5): latent semantic retrieval of benchmark
passages in documents, then longest-common-subsequence and answer checks.

1. Benchmark items are dealt into blocks of about BLOCK_CHARS characters; each
   block is one set of queries against all documents, so what tasks receive has a
   bound that does not depend on the size of the benchmark.
2. The space is learnt from the block's passages (items cut into at most PASSAGE
   words) and from all document windows near them: the distinct windows of all
   documents in which words of the block hold the share MIN_SHARE of the weight.
   Words that occur with the block's words in MIN_WITH of these windows, and in as
   many of every PER of them, join the vocabulary, so a synonym gets a place beside
   the word it stands for and the vocabulary has a bound (WINDOW / MIN_WITH * PER
   words join at most). Nothing is sampled: windows, the words beside and document
   frequencies come from all documents, and windows stay a distributed table.
3. Randomised subspace iteration over the distributed TF-IDF rows gives their
   right singular vectors: each pass sums A^T (A W) over the tasks, and a final
   Gram matrix rotates the basis. The rank is at most half the number of passages
   and at most RANK, so the space is smaller than what passages span, and words
   which occur together share directions. Windows weigh as much as passages.
4. Documents are read once, in windows of WINDOW words, STEP apart, whose latent
   vectors are sums over their words. The cosine of a window and a passage is
   taken in the space, on both sides. All items above MIN_COSINE are candidates,
   however many; windows in which words of the block hold less than MIN_SHARE of
   the weight are skipped. What the space does not hold can't be near in it, so
   every run of MIN_WORDS words of an item is an anchor: items with an anchor in a
   text are candidates too, whatever their cosine, and no verbatim copy is missed.
5. A candidate is confirmed by the longest common subsequence of the item and the
   words around its windows: at least SURE of the item's words; or at least
   LIKELY of them and, for paraphrases, ANSWER of the words of the item's answer
   (its last sentence, or last MAX_ANSWER words if that is longer).

Words are lower-cased runs of letters, digits and non-ASCII characters. Items of
fewer than MIN_WORDS words name nothing in particular and never match. Null
texts are empty and match nothing; repeated rows give one row per doc_id and
item; ties need no order; empty tables give an empty result; extra columns are
ignored by `matches` and kept by `clean`.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stored

BLOCK_CHARS = 1 << 18
PASSAGE = 64
WINDOW, STEP = 32, 16
RANK, OVERSAMPLE, ITERATIONS, SEED = 256, 16, 3, 5
MIN_WITH, PER = 3, 4096
MIN_SHARE, MIN_COSINE = 0.12, 0.5
#: Windows whose cosines, or whose part of the space, are taken together.
TOGETHER = 256
#: Tasks of a pass over the rows, each of which sends a sum as large as the basis, and
#: words of the basis in a row of that sum.
SUMS, SLICE = 64, 64
#: Words a task counts before it hands on what it has.
HELD_WORDS = 200_000
SURE, LIKELY, ANSWER = 0.8, 0.6, 0.8
MIN_WORDS, MAX_ANSWER = 5, 12

#: Bytes to a space, except letters, digits and bytes of non-ASCII characters.
SPLIT = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(SPLIT).split()


def answer_of(text: str) -> list[bytes]:
    """Words of the last sentence with a word, its last MAX_ANSWER at most."""
    sentences = [w for w in map(words_of, text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".")) if w]
    return sentences[-1][-MAX_ANSWER:] if sentences else []


def common_length(item: list[bytes], masks: dict[bytes, int], words: list[bytes]) -> int:
    """Length of the longest common subsequence, by bit operations; masks: the
    positions of each word of the item."""
    full = (1 << len(item)) - 1
    row = full
    for w in words:
        m = masks.get(w)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def masks_of(item: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each word of the vocabulary occurs, and how many
    documents there are."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column("text").to_pylist():
                n.update(known.value.intersection(words_of(text)))
        n[b""] = rows
        yield pa.record_batch({"word": pa.array(list(n), pa.binary()), "n": pa.array(list(n.values()), pa.int64())})

    found = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = {bytes(r.word): r.n for r in found}  # a row for each word of the block
    return out, out.pop(b"", 0)


def latent_space(passages: DataFrame, words: int, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (words x rank) of the sparse rows (ids, weights)."""
    sc = passages.sparkSession.sparkContext

    def summed(basis: np.ndarray, gram: bool) -> np.ndarray:
        """Over all rows a: sum of a (a W), or of (a W)^T (a W)."""
        known = sc.broadcast(basis)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = known.value
            total = np.zeros((w.shape[1], w.shape[1]) if gram else w.shape)
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER):
                    part = batch.slice(at, TOGETHER)
                    sizes = part.column("ids").value_lengths().to_numpy()
                    ids, x = part.column("ids").flatten().to_numpy(), part.column("weights").flatten().to_numpy()[:, None]
                    y = np.add.reduceat(w[ids] * x, np.cumsum(sizes) - sizes)  # no row is empty
                    if gram:
                        total += y.T @ y
                    else:
                        order = np.argsort(ids, kind="stable")
                        here, first = np.unique(ids[order], return_index=True)
                        total[here] += np.add.reduceat(y[np.repeat(np.arange(len(y)), sizes)[order]] * x[order], first)
            cuts = range(0, len(total), SLICE)
            yield pa.record_batch({"slice": pa.array(list(cuts), pa.int64()), "part": pa.array([total[k:k + SLICE].tobytes() for k in cuts], pa.binary())})

        def add(parts: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(p.as_buffer()) for p in parts.column("part"))
            return pa.table({"slice": parts.column("slice")[:1], "part": pa.array([total.tobytes()], pa.binary())})

        parts = passages.filter("size(ids) > 0").select("ids", "weights").coalesce(SUMS).mapInArrow(run, "slice long, part binary")
        found = sorted(parts.groupBy("slice").applyInArrow(add, "slice long, part binary").collect())  # as large as the basis
        return np.concatenate([np.frombuffer(r.part) for r in found]).reshape((basis.shape[1], basis.shape[1]) if gram else basis.shape)

    size = min(rank + OVERSAMPLE, words)
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((words, size)))[0]
    for _ in range(ITERATIONS):
        basis = np.linalg.qr(summed(basis, gram=False))[0]
    values, turn = np.linalg.eigh(summed(basis, gram=True))
    best = [k for k in np.argsort(-values)[:rank] if values[k] > 1e-9 * max(values.max(), 1e-300)]
    return basis @ turn[:, best]


def run_keys(ids: np.ndarray) -> np.ndarray:
    """A hash of each run of MIN_WORDS word numbers; equal hashes of different
    runs only give a candidate more."""
    out = np.zeros(max(0, len(ids) - MIN_WORDS + 1), np.uint64)
    for j in range(MIN_WORDS):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + len(out)].astype(np.uint64) + np.uint64(1)
    return out


def inverse(df: int, n_docs: int) -> float:
    """Inverse document frequency of a word in df of n_docs documents."""
    return max(1e-3, math.log((n_docs + 1) / (df + 0.5)))


def windows_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the windows over n words."""
    first = np.arange(0, max(1, n - STEP), STEP)
    return first, np.minimum(first + WINDOW, n)


def powers(weight: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the squared weights of each window."""
    c = np.concatenate(([0.0], np.cumsum(weight ** 2)))
    return c[last] - c[first]


def near_windows(docs: DataFrame, idf: dict[bytes, float], other: float) -> DataFrame:
    """The windows the space is fitted on: line, the words of each distinct window of
    all documents that is near the words of idf; other: the weight of other words."""
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = known.value
        for batch in batches:
            lines: set[bytes] = set()
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                weight = np.array([idf.get(w, 0.0) for w in words])
                if not weight.any():
                    continue
                first, last = windows_of(len(words))
                near = powers(weight, first, last) >= MIN_SHARE * powers(np.where(weight > 0, weight, other), first, last)
                lines.update(b" ".join(words[a:b]) for a, b in zip(first[near].tolist(), last[near].tolist()))
            yield pa.record_batch({"line": pa.array(list(lines), pa.binary())})

    return stored(docs.select("text").mapInArrow(run, "line binary").distinct(), "near-windows")


def words_beside(windows: DataFrame, own: set[bytes]) -> list[bytes]:
    """Words outside own that occur in enough of the windows."""
    least = max(MIN_WITH, -(-MIN_WITH * windows.count() // PER))
    known = windows.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def held() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(n), pa.binary()), "n": pa.array(list(n.values()), pa.int64())})

        for batch in batches:
            for line in batch.column("line").to_pylist():
                n.update(set(line.split()) - known.value)
            if len(n) >= HELD_WORDS:
                yield held()
                n.clear()
        yield held()

    found = windows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return sorted(bytes(r.word) for r in found.collect())  # at most WINDOW / MIN_WITH * PER words


def weighted(words: list[bytes], number: dict[bytes, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the known words, and their weights, of length 1 together."""
    ids, n = np.unique([number[w] for w in words if w in number], return_counts=True)
    x = n * idf[ids]
    return ids, x / np.linalg.norm(x)


def prepared(items: list[tuple[int, str]], docs: DataFrame, rank: int = RANK) -> dict | None:
    """The model of one block of items; None if it has nothing to look for."""
    items = [(i, t, w) for i, t in items if len(w := words_of(t)) >= MIN_WORDS]
    if not items:
        return None
    own = sorted({w for _, _, words in items for w in words})
    df, n_docs = document_frequencies(docs, set(own))
    other = inverse(0, n_docs)
    windows = near_windows(docs, {w: inverse(df.get(w, 0), n_docs) for w in own}, other)
    beside = words_beside(windows, set(own))
    vocabulary = own + beside  # the block's words come first
    df |= document_frequencies(docs, set(beside))[0] if beside else {}
    number = {w: k for k, w in enumerate(vocabulary)}
    idf = np.array([inverse(df.get(w, 0), n_docs) for w in vocabulary])

    passages, owners = [], []
    for k, (_, _, words) in enumerate(items):
        for a in range(0, len(words), PASSAGE):
            passages.append(weighted(words[a:a + PASSAGE], number, idf))
            owners.append(k)
    balance = math.sqrt(min(1.0, len(passages) / max(1, windows.count())))
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast((number, idf))

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, idf = known.value
        for batch in batches:
            rows = [weighted(line.split(), number, idf) for line in batch.column("line").to_pylist()]
            yield pa.record_batch({"ids": pa.array([ids for ids, _ in rows], pa.list_(pa.int32())), "weights": pa.array([x * balance for _, x in rows], pa.list_(pa.float64()))})

    table = spark.createDataFrame([(ids.tolist(), x.tolist()) for ids, x in passages], "ids array<int>, weights array<double>")
    table = stored(table.repartition(1).unionByName(windows.mapInArrow(window_rows, table.schema)), "latent-rows")
    space = latent_space(table, len(vocabulary), min(rank, max(1, len(passages) // 2)))
    latent = np.array([x @ space[ids] for ids, x in passages])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    space = np.vstack([space * idf[:, None], np.zeros(space.shape[1])])  # the last row is for words outside the vocabulary
    runs = [np.unique(run_keys(np.array([number[w] for w in words]))) for _, _, words in items]
    keys, holders = np.concatenate(runs), np.repeat(np.arange(len(items)), [len(x) for x in runs])
    order = np.argsort(keys, kind="stable")
    return {"number": number, "own": len(own), "idf": idf, "other": other, "space": space.astype(np.float32),
            "latent": latent.astype(np.float32), "owners": np.array(owners), "anchors": (keys[order], holders[order]),
            "ids": [i for i, _, _ in items], "words": [w for _, _, w in items],
            "masks": [masks_of(w) for _, _, w in items], "answers": [(a := answer_of(t), masks_of(a)) for _, t, _ in items]}


def cosines(model: dict, ids: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Cosines in the latent space, windows x passages, of spans of word numbers."""
    y = np.array([model["space"][ids[a:b]].sum(axis=0) for a, b in spans])
    return y @ model["latent"].T / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)


def anchored(model: dict, ids: np.ndarray, windows: int) -> dict[int, set[int]]:
    """By window: the items of which it holds a run of MIN_WORDS words."""
    inside = np.concatenate(([0], np.cumsum(ids >= 0)))
    at = np.flatnonzero(inside[MIN_WORDS:] - inside[:-MIN_WORDS] == MIN_WORDS) if len(ids) >= MIN_WORDS else np.zeros(0, np.int64)
    if not len(at):
        return {}
    keys, holders = model["anchors"]
    own = run_keys(ids)[at]
    lo, hi = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
    out: dict[int, set[int]] = {}
    for k in np.flatnonzero(hi > lo).tolist():
        out.setdefault(min(int(at[k]) // STEP, windows - 1), set()).update(holders[lo[k]:hi[k]].tolist())
    return out


def candidates(model: dict, words: list[bytes]) -> dict[int, list[tuple[int, float]]]:
    """By item: the windows (first word, cosine) that may hold it."""
    n = len(words)
    if not n:
        return {}
    number = model["number"]
    ids = np.array([number.get(w, -1) for w in words])
    inside = (ids >= 0) & (ids < model["own"])
    if not inside.any():
        return {}
    weight = np.where(ids >= 0, model["idf"][ids], model["other"])
    first, last = windows_of(n)
    runs = anchored(model, np.where(inside, ids, -1), len(first))
    near_enough = powers(np.where(inside, weight, 0), first, last) >= MIN_SHARE * powers(weight, first, last)
    near_enough[list(runs)] = True
    found = np.flatnonzero(near_enough).tolist()
    out: dict[int, list[tuple[int, float]]] = {}
    for j in range(0, len(found), TOGETHER):
        part = found[j:j + TOGETHER]
        near = cosines(model, ids, [(int(first[k]), int(last[k])) for k in part])
        chosen = near >= MIN_COSINE
        for r, k in enumerate(part):
            if k in runs:
                chosen[r] |= np.isin(model["owners"], list(runs[k]))
        for r, p in zip(*map(np.ndarray.tolist, np.nonzero(chosen))):
            out.setdefault(int(model["owners"][p]), []).append((int(first[part[r]]), float(near[r, p])))
    return out


def confirmed(model: dict, text: str | None) -> list[tuple[int, float, float, float]]:
    """(item_id, cosine, share of the item in order, share of its answer) of the
    items that a text holds."""
    words = words_of(text)
    out = []
    for k, windows in candidates(model, words).items():
        item, (answer, answer_masks) = model["words"][k], model["answers"][k]
        best, spans = (0.0, 0.0), []
        for a, _ in windows:  # windows that touch are searched together
            lo, hi = max(0, a - len(item)), min(len(words), a + WINDOW + len(item))
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = hi
            else:
                spans.append([lo, hi])
        for lo, hi in spans:
            for a in range(lo, max(lo + 1, hi - len(item)), max(1, len(item) // 2)):  # stretches of twice the item
                part = words[a:min(hi, a + 2 * len(item))]
                masks = model["masks"][k]
                if sum(masks[w].bit_count() for w in masks.keys() & set(part)) < LIKELY * len(item):
                    continue  # too few of the item's words, in any order
                share = common_length(item, masks, part) / len(item)
                if share >= LIKELY:
                    best = max(best, (share, common_length(answer, answer_masks, part) / len(answer)))
        if best[0] >= SURE or best[0] >= LIKELY and best[1] >= ANSWER:
            out.append((model["ids"][k], max(c for _, c in windows), *best))
    return out


def blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items (item_id, text) by blocks of about BLOCK_CHARS characters."""
    rows = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).filter("item_id is not null").distinct()
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // BLOCK_CHARS))
    for k in range(n):
        found = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()  # one block
        yield sorted((r.item_id, r.text) for r in found)


def matches(docs: DataFrame, items: DataFrame, rank: int = RANK) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_share of every document that
    holds a benchmark item."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    kinds = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double"
    out = docs.sparkSession.createDataFrame([], kinds)
    for block in blocks(items):
        model = prepared(block, docs, rank)
        if model is None:
            continue
        known = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for m in confirmed(known.value, t)]
                cols = list(zip(*rows)) or [()] * 5
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), *[pa.float64()] * 3))], ["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])

        out = out.unionByName(docs.mapInArrow(run, kinds))
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs_share", "answer_share")])


def clean(docs: DataFrame, items: DataFrame, rank: int = RANK) -> DataFrame:
    """The rows of docs (doc_id, text and others) that hold no benchmark item."""
    whole = docs
    for block in blocks(items):
        model = prepared(block, whole, rank)
        if model is None:
            continue
        known = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not confirmed(known.value, t) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
