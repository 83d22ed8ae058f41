"""Ranked lexical search (operator 13): the best documents for each of many items,
by sharing work between the items.

Terms that several items hold are mined for sets that occur together: the items
of a block become sets of leaves (a term and how often the item has it), and
in rounds the pair that most items still hold becomes a node that replaces it in
them, until no pair is left in two items. The nodes form a directed acyclic
graph shared by the items. A document's score is linear in its terms' parts, so
a task computes, for many documents at once, each leaf's part, each node as the
sum of its two children (once, however many items lie above it), and each
item as the sum of the few nodes left to it, and keeps the best documents of each
item; a window over the tasks' best rows gives the ranks.

All documents pass once for their terms (the table `search-index` holds each
document's length and the counts of those terms that items have, and each task's
sums of documents, lengths and documents holding a term) and once, from that
table, for their scores. Items are dealt into blocks of about BLOCK_CHARS
characters, one pass each; only a block's terms and graph reach the driver and are
broadcast, so their size is bounded by that parameter and by the longest item.

Weights are floor(1000 ln((2N+2)/(2df+1))), all else 64-bit integers, so sums are
exact in any order.

Defined results: documents without a term (null, empty) take no part; equal
scores rank by ascending doc_id, a null doc_id last; repeated documents are ranked
each by itself; equal rows of items are one item, an item without terms (or that no
document matches) has no rows; long texts are counted whole; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import byte_texts, stored

TOP = 10
BLOCK_CHARS = 1 << 17
#: Leaves of an item that are mined together; a longer item is mined piece by piece.
PIECE = 256
#: Size of a task's matrix of partial sums.
MATRIX_BYTES = 16 << 20
SLICE_CHARS = 1 << 22

#: Bytes of terms (letters, digits and all beyond ASCII), A-Z lower-cased; others part terms.
_TERM_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
_LAST = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def share(items: list[set[int]], leaves: int) -> tuple[list[tuple[int, int]], list[set[int]]]:
    """Children of the nodes leaves, leaves + 1, ... and the nodes left to each
    item, whose leaves together are exactly the item's."""
    held = [set(x) for x in items]
    nodes: list[tuple[int, int]] = []
    while True:
        where: dict[int, set[int]] = defaultdict(set)
        for i, x in enumerate(held):
            for a in x:
                where[a].add(i)
        pairs = Counter()
        for x in held:
            common = sorted(a for a in x if len(where[a]) > 1)
            for at in range(0, len(common), PIECE):
                pairs.update(combinations(common[at:at + PIECE], 2))
        made = 0
        for (a, b), n in sorted(pairs.items(), key=lambda p: (-p[1], p[0])):
            if n < 2:
                break
            both = where[a] & where[b]
            if len(both) < 2:
                continue
            new = leaves + len(nodes)
            nodes.append((a, b))
            where[a] -= both
            where[b] -= both
            for i in both:
                held[i] -= {a, b}
                held[i].add(new)
            made += 1
        if not made:
            return nodes, held


PLAN = ("block int, terms array<binary>, leaf_term array<int>, leaf_times array<long>, left array<int>, right array<int>, "
        "item_id array<long>, item_nodes array<array<int>>")


def _plan_of_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The shared graph of one block of items."""
    rows = rows.sort_values(["item_id", "text"], na_position="last")
    counts = [Counter(terms_of((t or "").encode())) for t in rows["text"]]
    terms = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
    leaves: dict[tuple[int, int], int] = {}
    items = [{leaves.setdefault((terms[t], n), len(leaves)) for t, n in sorted(c.items())} for c in counts]
    nodes, held = share(items, len(leaves))
    ids = [None if pd.isna(i) else int(i) for i in rows["item_id"]]
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "terms": [list(terms)], "leaf_term": [[t for t, _ in leaves]], "leaf_times": [[n for _, n in leaves]],
                         "left": [[a for a, _ in nodes]], "right": [[b for _, b in nodes]], "item_id": [ids], "item_nodes": [[sorted(x) for x in held]]})


def plans(items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each block of items: its terms, nodes and items."""
    rows = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    blocks = max(1, math.ceil((rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0) / block_chars))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    return stored(rows.groupBy("block").applyInPandas(_plan_of_block, PLAN), "search-plans")


INDEX = "doc_id long, docs long, n long, terms array<int>, counts array<long>"


def index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Documents with a term: n terms in all, and which of `terms` how often
    (docs is null); and a row for each task: docs, their terms n, and in how many
    documents each of `terms` occurs."""
    known = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def rows(doc_id, docs, n, flat, counts, sizes):
        at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, pa.array(flat, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))]
        return pa.record_batch([pa.array(doc_id, pa.int64()), pa.array(docs, pa.int64()), pa.array(n, pa.int64()), *lists], ["doc_id", "docs", "n", "terms", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n_docs, n_terms, holding = known.value, 0, 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at in range(0, len(ids), 256):
                out_ids, out_n, flat, counts, sizes = [], [], [], [], []
                for doc_id, text in zip(ids[at:at + 256], byte_texts(batch.slice(at, 256), "text")):
                    found = terms_of(text)
                    if found:
                        mine = [(number[t], c) for t, c in Counter(found).items() if t in number]
                        out_ids.append(doc_id)
                        out_n.append(len(found))
                        flat.extend(k for k, _ in mine)
                        counts.extend(c for _, c in mine)
                        sizes.append(len(mine))
                if out_ids:
                    n_docs, n_terms = n_docs + len(out_ids), n_terms + sum(out_n)
                    np.add.at(holding, np.array(flat, np.int64), 1)
                    yield rows(out_ids, [None] * len(out_ids), out_n, flat, counts, sizes)
        if n_docs:
            some = np.flatnonzero(holding)
            yield rows([None], [n_docs], [n_terms], some, holding[some], [len(some)])

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX), "search-index")


class Scorer:
    """Scores documents for all items of a plan along its graph."""

    def __init__(self, plan: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        self.weights, self.n_docs, self.n_terms = weights, n_docs, n_terms
        self.leaf_term, self.times = np.array(plan["leaf_term"], np.int64), np.array(plan["leaf_times"], np.int64)
        left, right = np.array(plan["left"], np.int64), np.array(plan["right"], np.int64)
        first = len(self.leaf_term)
        depth = np.zeros(first + len(left), np.int64)
        for k, (a, b) in enumerate(zip(left, right)):  # children come before their node
            depth[first + k] = max(depth[a], depth[b]) + 1
        self.levels = [(new, left[new - first], right[new - first]) for d in range(1, int(depth.max(initial=0)) + 1) if len(new := np.flatnonzero(depth == d))]
        self.size = len(depth)
        some = [(k, x) for k, x in enumerate(plan["item_nodes"]) if x]  # items with terms
        self.items = np.array([k for k, _ in some], np.int64)
        self.nodes = np.array([a for _, x in some for a in x], np.int64)
        self.starts = np.cumsum([0, *(len(x) for _, x in some)])[:-1].astype(np.int64)

    def width(self) -> int:
        """Documents to be scored at a time."""
        return max(1, MATRIX_BYTES // (8 * (self.size + len(self.nodes) + len(self.weights) + 1)))

    def scores(self, n: np.ndarray, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A row for each item with terms, a column for each document."""
        doc = np.repeat(np.arange(len(n)), sizes)
        m = 100 - 75 + (75 * n * self.n_docs) // self.n_terms
        parts = np.zeros((len(self.weights), len(n)), np.int64)
        parts[terms, doc] = self.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[doc]))
        sums = np.empty((self.size, len(n)), np.int64)
        sums[:len(self.leaf_term)] = parts[self.leaf_term] * self.times[:, None]
        for new, left, right in self.levels:
            sums[new] = sums[left] + sums[right]
        return np.add.reduceat(sums[self.nodes], self.starts, axis=0)


class Best:
    """The best documents of each item so far, in rank order."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.score, self.doc = np.zeros((items, top), np.int64), np.full((items, top), _LAST)

    def add(self, doc: np.ndarray, scores: np.ndarray) -> None:
        last, last_doc = self.score[:, -1:], self.doc[:, -1:]
        item, at = np.nonzero((scores > last) | (scores == last) & (last > 0) & (doc < last_doc))
        if not len(item):
            return
        some = np.unique(item)
        items = np.concatenate([np.repeat(some, self.top), item])
        score = np.concatenate([self.score[some].ravel(), scores[item, at]])
        docs = np.concatenate([self.doc[some].ravel(), doc[at]])
        order = np.lexsort((docs, -score, items))
        items, score, docs = items[order], score[order], docs[order]
        place = np.arange(len(items)) - np.searchsorted(items, items)
        keep = place < self.top
        self.score[items[keep], place[keep]], self.doc[items[keep], place[keep]] = score[keep], docs[keep]


def _rank_block(docs: DataFrame, plan: dict, top: int) -> DataFrame:
    """item (its place in the plan), doc_id and score of each task's best rows."""
    spark = docs.sparkSession
    table = index(docs, plan["terms"])
    sums = table.filter("docs is not null")
    n_docs, n_terms = sums.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(plan["terms"]), np.int64)
    for r in sums.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df")).collect():  # terms of the block
        held[r.terms] = r.df
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in held], np.int64)
    model = spark.sparkContext.broadcast((plan, weights, n_docs, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        best, step = Best(len(scorer.items), top), scorer.width()
        for batch in batches:
            for at in range(0, batch.num_rows if len(scorer.items) else 0, step):
                part = batch.slice(at, step)
                doc = part.column("doc_id").fill_null(_LAST).to_numpy()
                terms, counts = part.column("terms"), part.column("counts")
                best.add(doc, scorer.scores(part.column("n").to_numpy(), terms.flatten().to_numpy(), counts.flatten().to_numpy(), terms.value_lengths().to_numpy()))
        item, place = np.nonzero(best.score)
        doc = best.doc[item, place]
        yield pa.record_batch([pa.array(scorer.items[item], pa.int64()), pa.array(doc, mask=doc == _LAST), pa.array(best.score[item, place])], ["item", "doc_id", "score"])

    return table.filter("docs is null").select("doc_id", "n", "terms", "counts").mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id and score of the best `top` documents of each item."""
    spark = docs.sparkSession
    graphs, found = plans(items, block_chars), None
    for block in sorted(r.block for r in graphs.select("block").collect()):
        plan = graphs.filter(F.col("block") == block).first().asDict()
        plan["terms"] = [bytes(t) for t in plan["terms"]]
        names = spark.createDataFrame(list(enumerate(plan["item_id"])), "item long, item_id long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = _rank_block(docs, plan, top).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        rows = stored(ranked.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "search-ranks")
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
