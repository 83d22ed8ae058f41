"""SimHash near-dedup (operator 8): 64-bit fingerprints over word shingles, and
tiled exact comparison of them by exclusive-or and bit counts.

Equal fingerprints are one row from the start, so exact copies cost nothing. The
distinct fingerprints are dealt into classes by the bit counts of their two
halves (at most 33 x 33 classes) and, within a class, by a hash into tiles of
about TILE. Two fingerprints within the radius r have |difference of the high
counts| + |difference of the low counts| <= r, so tile pairs of classes further
apart are skipped; every other tile pair is compared in full inside one task.
A task hands on a spanning forest of the links that it found (a row for a
fingerprint at most), never all pairs of a group of copies, and star contraction
joins the forests to components. The comparison itself stays quadratic in the
number of distinct fingerprints; the classes only lower its constant.

Null texts count as empty; a text without words has fingerprint zero, linked
like any other; repeated doc_ids keep one row each; ties need no order, since
component ids are minima; a null doc_id gets its fingerprint and never names a
component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import byte_texts, stored
from .components import connected_components

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 2048
#: Links that a task holds before it reduces them to a spanning forest.
HELD_LINKS = 1 << 18
#: Fingerprint rows compared with a tile at once, and shingles counted at once.
STRIP, COUNTED = 128, 1 << 16


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[len(words) - n:].tolist()
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    h = shingle_hashes(text, width)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), COUNTED):
        bits = np.unpackbits(h[k:k + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return sum(1 << k for k in np.flatnonzero(2 * counts > len(h)).tolist())


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in byte_texts(batch, "text")], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For n nodes and links u-v: the smallest node of each node's component."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[u], label[v])
        new = label.copy()
        for at in (label[u], label[v]):
            np.minimum.at(new, at, m)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> np.ndarray:
    """Component labels over the rows of tile a, then those of tile b; None for
    b compares tile a with itself."""
    n, off = len(a) + (0 if b is None else len(b)), 0 if b is None else len(a)
    other = a if b is None else b
    held, size, label = [], 0, np.arange(n)
    for k in range(0, len(a), STRIP):
        hit = np.bitwise_count(a[k:k + STRIP, None] ^ other[None, :]) <= radius
        i, j = np.divmod(np.flatnonzero(hit), len(other))
        keep = (i + k) < j if b is None else slice(None)
        held.append((i[keep] + k, j[keep] + off))
        size += len(held[-1][0])
        if size > HELD_LINKS:
            label = _joined(n, label, held)
            held, size = [], 0
    return _joined(n, label, held) if size else label


def _joined(n: int, label: np.ndarray, held: list) -> np.ndarray:
    u, v = (np.concatenate([x[k] for x in held]) for k in (0, 1))
    moved = np.flatnonzero(label != np.arange(n))
    return forest(n, np.concatenate((u, moved)), np.concatenate((v, label[moved])))


def _link_rows(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                fa, ra, fb, rb = (batch.column(x)[k].values for x in ("fps_a", "reps_a", "fps_b", "reps_b"))
                a, ids = (np.asarray(x) for x in (fa, ra))
                b = None
                if not batch.column("same")[k].as_py():
                    b, ids = np.asarray(fb).view(np.uint64), np.concatenate((ids, np.asarray(rb)))
                label = tile_links(a.view(np.uint64), b, radius)
                moved = np.flatnonzero(label != np.arange(len(label)))
                if len(moved):
                    yield pa.record_batch({"u": pa.array(ids[moved]), "v": pa.array(ids[label[moved]])})
    return run


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Spanning links (u, v) between the reps of distinct fingerprints; nodes
    are rows (fp, rep) of longs."""
    spark = nodes.sparkSession
    nodes = nodes.select("fp", "rep", F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int").alias("hi"),
                         F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF)).cast("int").alias("lo"))
    sizes = {(r.hi, r.lo): r.n for r in nodes.groupBy("hi", "lo").agg(F.count("*").alias("n")).collect()}  # at most 33 x 33 rows
    if not sizes:
        return spark.createDataFrame([], "u long, v long")
    classes = spark.createDataFrame([(h, x, -(-n // tile)) for (h, x), n in sizes.items()], "hi int, lo int, n int")
    tiles = (nodes.join(F.broadcast(classes), ["hi", "lo"])
             .groupBy("hi", "lo", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int").alias("t"))
             .agg(F.collect_list(F.struct("fp", "rep")).alias("rows")))
    tiles = stored(tiles.select((F.col("hi") * 64 + F.col("lo")).alias("class"), "t", F.col("rows.fp").alias("fps"), F.col("rows.rep").alias("reps")), "tiles")
    near = [(h * 64 + x, k * 64 + y) for h, x in sizes for k, y in sizes if (h, x) <= (k, y) and abs(h - k) + abs(x - y) <= radius]
    near = spark.createDataFrame(near, "class int, class_b int")  # at most 1089 x (2 r (r + 1) + 1) / 2 rows
    keys = tiles.select("class", "t")
    pairs = (keys.join(F.broadcast(near), "class")
             .join(keys.select(F.col("class").alias("class_b"), F.col("t").alias("t_b")), "class_b")
             .filter("class < class_b or t <= t_b"))
    named = tiles.select("class", "t", F.col("fps").alias("fps_a"), F.col("reps").alias("reps_a"))
    other = tiles.select(F.col("class").alias("class_b"), F.col("t").alias("t_b"), F.col("fps").alias("fps_b"), F.col("reps").alias("reps_b"))
    joined = pairs.join(other, ["class_b", "t_b"]).join(named, ["class", "t"]).select(
        ((F.col("class") == F.col("class_b")) & (F.col("t") == F.col("t_b"))).alias("same"), "fps_a", "reps_a", "fps_b", "reps_b")
    return joined.mapInArrow(_link_rows(radius), "u long, v long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row for each row of docs: doc_id, fp, component_id (the smallest
    doc_id reachable over links, itself included)."""
    fps = stored(fingerprints(docs, width), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-nodes")
    found = connected_components(links(nodes.filter("rep is not null"), radius, tile))
    named = nodes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of docs, with all their columns, that stay: of each group the one
    with the smallest doc_id, and of rows with that doc_id one. Rows without a
    doc_id stay."""
    first = near_duplicates(docs, width, radius, tile).filter("doc_id = component_id").select(F.col("doc_id").alias("_first")).distinct()
    with_id = docs.filter("doc_id is not null").join(first, F.col("doc_id").cast("long") == F.col("_first"), "left_semi").dropDuplicates(["doc_id"])
    return with_id.unionByName(docs.filter("doc_id is null"))
