"""HTML extraction (operator 1): gradient-boosted trees over the nodes of a page's
tree, decoded so that no kept block has a dropped ancestor.

Features of a node: its tag, words in its class, id and role, those of its
ancestors, depth, place and number of siblings, and of its subtree the text
length, share of the page, link density, tags and stops per text, paragraphs and
runs. The trees are fitted by Spark's boosting on TRAINING_PAGES random layouts
with known main text (html_samples); their number bounds the model that tasks
receive. A node's target is whether its subtree holds main text, so targets obey
the tree. Decoding maximises the sum of log probabilities over labellings in which
all descendants of a dropped node are dropped, from the leaves up in one pass.

The text is that of the kept runs: character references decoded, white space
inside a block one space, blocks joined by \\n in page order; a line break element
ends a block. Scripts, styles, forms and the like never hold text; a form around a
page's layout (main, article or nav) is a block like others.

Defined results: null and empty pages, and pages without main text, give an empty
text; repeated rows are extracted alike; broken markup is closed as browsers do,
roughly; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from .html_dom import Page, features
from .html_samples import MARK, Samples

TRAINING_PAGES, TREES, TREE_DEPTH, SEED = 800, 30, 5, 11
#: Nodes that are scored together.
SCORED_NODES = 20_000


def targets(page: Page) -> np.ndarray:
    """Of a training page, which nodes hold main text; -1 for nodes without text."""
    out = np.array([-1 if not t else int(MARK in t) for t in page.texts])
    for k in range(len(out) - 1, 0, -1):
        out[page.parents[k]] = max(out[page.parents[k]], out[k])
    return out


def training_rows(n_pages: int = TRAINING_PAGES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    samples, xs, ys = Samples(seed), [], []
    for _ in range(n_pages):
        page = Page(samples.page())
        y = targets(page)
        page.texts = [t.replace(MARK, "") for t in page.texts]
        keep = np.flatnonzero(y >= 0)
        xs.append(features(page)[keep])
        ys.append(y[keep])
    return np.concatenate(xs), np.concatenate(ys)


def fitted(spark: SparkSession, n_pages: int = TRAINING_PAGES) -> list[tuple[np.ndarray, ...]]:
    """The boosted trees as arrays: feature, threshold, left, right, value."""
    x, y = training_rows(n_pages)
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.astype(float).tolist(), y.tolist())], ["features", "label"])
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=SEED, maxBins=48, cacheNodeIds=False).fit(rows.coalesce(spark.sparkContext.defaultParallelism))
    out = []
    for tree, weight in zip(model.trees, model.treeWeights):
        nodes: list[list] = []

        def walk(node, nodes=nodes, weight=weight) -> int:
            k = len(nodes)
            nodes.append([-1, 0.0, k, k, node.prediction() * weight])
            if node.subtreeDepth() > 0:
                nodes[k][0], nodes[k][1] = node.split().featureIndex(), node.split().threshold()
                nodes[k][2], nodes[k][3] = walk(node.leftChild()), walk(node.rightChild())
            return k

        walk(tree._call_java("rootNode"))
        out.append(tuple(np.array(c) for c in zip(*nodes)))
    return out


def probabilities(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    margin, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(TREE_DEPTH):
            at = np.where(x[rows, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
        margin += value[at]
    return 1 / (1 + np.exp(-2 * margin))


def decoded(page: Page, p: np.ndarray) -> list[str]:
    """Texts of the runs that the best consistent labelling keeps."""
    keep, drop = np.log(np.clip(p, 1e-6, 1)), np.log(np.clip(1 - p, 1e-6, 1))
    has_text = np.array([bool(t) for t in page.texts])
    for k in range(len(p) - 1, 0, -1):  # a node without any text says nothing
        has_text[page.parents[k]] |= has_text[k]
    keep, drop = np.where(has_text, keep, 0), np.where(has_text, drop, 0)
    best_keep, best_drop = keep.tolist(), drop.tolist()
    for k in range(len(p) - 1, 0, -1):
        up = page.parents[k]
        best_keep[up] += max(best_keep[k], best_drop[k])
        best_drop[up] += best_drop[k]
    kept, out = [True] * len(p), []
    for k in range(len(p)):
        up = page.parents[k]
        kept[k] = (up < 0 or kept[up]) and best_keep[k] >= best_drop[k]
        if kept[k] and page.texts[k]:
            out.append(page.texts[k])
    return out


def extract_texts(trees: list, htmls: list[str]) -> list[str]:
    out: list[str] = []
    held: list[tuple[Page, np.ndarray]] = []

    def finish() -> None:
        p = probabilities(trees, np.concatenate([x for _, x in held])) if held else np.zeros(0)
        at = 0
        for page, x in held:
            out.append("\n".join(decoded(page, p[at:at + len(x)])))
            at += len(x)
        held.clear()

    for html in htmls:
        page = Page(html)
        held.append((page, features(page)))
        if sum(len(x) for _, x in held) >= SCORED_NODES:
            finish()
    finish()
    return out


def extract(pages: DataFrame, trees: list | None = None) -> DataFrame:
    """page_id, url, text of each row of pages (page_id, url, html)."""
    model = pages.sparkSession.sparkContext.broadcast(trees if trees is not None else fitted(pages.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = extract_texts(model.value, [h or "" for h in part.column("html").to_pylist()])
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string")
