"""Nearest neighbours of all rows of a vector table, and the local outlier factor.

Equal vectors become one point with a weight, so copies cost nothing. Points are
dealt to pivots (a bounded choice by hash), and the points of a pivot are cut by their
distance to it into tiles of near-equal size. A tile is known by its centre and radius. Two
bounds hold for a point's k-th neighbour: the k-th distance in its own tile, and
the distance within which the nearest tiles together must hold k points (which
widens the search where a tile holds fewer). A point is compared with the points of
every tile that may, by the triangle inequality (with the tile's centre and radius, and
with its pivot and the ring around it), hold one inside the point's own bound, so the
neighbours are exact. How many that leaves depends on the vectors: few for a handful of features, nearly all for noise in many dimensions,
whose cost is then quadratic in the number of distinct vectors.

A point goes to the tiles within its reach, where a task holds one tile and compares
batches of points with it. A tile that many points reach is held by several tasks.
The number of tiles is at most about 2 * MAX_TILES,
which bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T
from ..session import stored
from .quantiles import exact_quantiles

#: Rows of a tile for each dimension: few dimensions gain from small tiles, many
#: dimensions mostly pay for sending points to each.
DIM_ROWS = 128
MAX_TILES = 4096
#: So many times the points of a tile may visit it in one task.
PARTNERS = 32
#: Distances count as equal when they agree to so many decimals.
DECIMALS = 9
#: Fixed value: added to a mean reachability so that copies have a finite density.
EPSILON = 1e-10


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def _kth(d: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """The least distance in each row within which k points lie (inf if none)."""
    order = np.argsort(d, axis=1)
    held = np.cumsum(weight[order], axis=1)
    at = (held < k).sum(1)
    near = np.take_along_axis(d, order, 1)
    return np.where(at < d.shape[1], near[np.arange(len(d)), np.minimum(at, d.shape[1] - 1)], np.inf)


def points(df: DataFrame, id_col: str, vector: Column) -> DataFrame:
    """A row for each distinct vector: point (its smallest id), weight, vector.
    Vectors that are null or hold a null are left out."""
    rows = df.select(F.col(id_col).alias("point"), F.transform(vector, lambda x: x.cast("double")).alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    return rows.groupBy("vector").agg(F.min("point").alias("point"), F.count("*").alias("weight"))


def tiles(found: DataFrame, k: int) -> DataFrame:
    """Points with their tile, `bound`, the k-th distance inside the tile, its pivot and
    `away`, the distance to the pivot."""
    n, dims = found.agg(F.count("*"), F.max(F.size("vector"))).first()
    rows = max(DIM_ROWS * dims, -(-n // MAX_TILES))
    pivots = found.orderBy(F.xxhash64("point"), "point").limit(max(1, min(MAX_TILES, n // rows))).select("vector").collect()  # bounded
    spark = found.sparkSession
    centres = spark.sparkContext.broadcast(np.array([r.vector for r in pivots]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                d = _squares(_matrix(part.column("vector")), centres.value)
                yield pa.record_batch([*part.columns, pa.array(d.argmin(1)), pa.array(np.sqrt(d.min(1)))], [*part.schema.names, "cell", "away"])

    dealt = stored(found.mapInArrow(deal, "vector array<double>, point long, weight long, cell long, away double"), "cells")
    # rings of a cell hold about `rows` points each; a jitter parts points at one distance
    away = F.col("away") * (1 + F.pmod(F.xxhash64("point"), F.lit(1024)) * 1e-9)
    cells = dealt.groupBy("cell").agg(F.count("*").alias("n"))
    most = cells.agg(F.max("n")).first()[0]
    shares = [k / 64 for k in range(1, 64)] if most <= 64 * rows else [k * rows / most for k in range(1, -(-most // rows))]
    edges = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.percentile_approx(away, shares, 10_000).alias("edges"))
    # every so many of the shares is an edge, so that each cell has the rings it needs
    each = F.greatest(F.lit(1), F.floor((len(shares) + 1) * F.lit(float(rows)) / F.col("n")))
    edges = edges.select("cell", F.filter("edges", lambda e, i: (i + 1) % each == 0).alias("edges"))
    ring = F.size(F.filter("edges", lambda e: e < away))
    placed = dealt.join(F.broadcast(edges), "cell").select("vector", "point", "weight", F.col("away"), (F.col("cell") * 65536 + ring).alias("tile"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            part = pa.Table.from_batches(held).combine_chunks()
            x, w = _matrix(part["vector"].combine_chunks()), part["weight"].to_numpy()
            found = np.concatenate([_kth(np.sqrt(_squares(x[at:at + 256], x)), w, k + 1) for at in range(0, len(x), 256)])
            return pa.record_batch([*[part[c].combine_chunks() for c in ("vector", "point", "weight")], pa.array(found), *[part[c].combine_chunks() for c in ("tile", "away")], pa.array([centres.value[part["tile"][0].as_py() // 65536]] * len(x))], ["vector", "point", "weight", "bound", "tile", "away", "pivot"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            names = batch.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for at, stop in zip(cuts, cuts[1:]):
                if stop > at:
                    if held and held[0].column("tile")[0].as_py() != names[at]:
                        yield whole(held)
                        held = []
                    held.append(batch.slice(at, stop - at))
        if held:
            yield whole(held)

    ordered = placed.repartition("tile").sortWithinPartitions("tile")
    return stored(ordered.mapInArrow(bound, "vector array<double>, point long, weight long, bound double, tile long, away double, pivot array<double>"), "tiles")


class About:
    """Centres, radii, weights, pivots and rings of all tiles (at most some
    2 * MAX_TILES)."""

    def __init__(self, dealt: DataFrame):
        dims = len(dealt.first().vector)
        means = dealt.groupBy("tile").agg(F.sum("weight").alias("weight"), F.min("away").alias("inner"), F.max("away").alias("outer"), F.first("pivot").alias("pivot"), *[F.avg(F.col("vector")[j]).alias(f"c{j}") for j in range(dims)])
        centres = means.select("tile", "weight", "inner", "outer", "pivot", F.array(*[f"c{j}" for j in range(dims)]).alias("centre"))
        far = F.sqrt(F.aggregate(F.zip_with("vector", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))
        radii = dealt.join(F.broadcast(centres.select("tile", "centre")), "tile").groupBy("tile").agg(F.max(far).alias("radius"))
        table = centres.join(radii, "tile").orderBy("tile").toArrow()
        self.names, self.weight, self.inner, self.outer = (table[c].to_numpy() for c in ("tile", "weight", "inner", "outer"))
        _, first, self.cell = np.unique(self.names // 65536, return_index=True, return_inverse=True)
        self.pivots = _matrix(table["pivot"].combine_chunks())[first]
        self.radius = table["radius"].to_numpy() * (1 + 1e-9) + 1e-12
        self.centre = _matrix(table["centre"].combine_chunks())

    def least(self, x: np.ndarray, d: np.ndarray) -> np.ndarray:
        """A lower bound of the distance from each of x to the points of each tile;
        d: the distances to the centres. Rounding of the sums of squares is taken off."""
        to_pivot = np.sqrt(_squares(x, self.pivots))[:, self.cell]
        ring = np.maximum(to_pivot - self.outer, self.inner - to_pivot)
        size = np.sqrt((x * x).sum(1))[:, None] + np.sqrt((self.pivots * self.pivots).sum(1))[self.cell]
        return np.maximum(d - self.radius, ring) - 1e-7 * size


def _slack(bound: np.ndarray) -> np.ndarray:
    return bound * (1 + 1e-9) + 1e-6


def meetings(dealt: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(tile, part, its points), once for each part, and (tile, part, the points that may
    have neighbours among them). A part holds PARTNERS of the latter for each of the former."""
    model = dealt.sparkSession.sparkContext.broadcast(About(dealt))

    def tighten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = _matrix(part.column("vector"))
                d = np.sqrt(_squares(x, t.centre))
                bound = np.minimum(part.column("bound").to_numpy(), _kth(d + t.radius, t.weight, k + 1))
                near = t.least(x, d) <= _slack(bound)[:, None]
                offsets = pa.array(np.concatenate([[0], np.cumsum(near.sum(1))]).astype(np.int32))
                reach = pa.ListArray.from_arrays(offsets, pa.array(t.names[np.nonzero(near)[1]]))
                yield pa.record_batch([*[part.column(c) for c in ("tile", "point", "weight", "vector")], pa.array(bound), reach], ["tile", "point", "weight", "vector", "bound", "reach"])

    own = stored(dealt.mapInArrow(tighten, "tile long, point long, weight long, vector array<double>, bound double, reach array<long>"), "tile-points")
    come = own.select(F.explode("reach").alias("tile")).groupBy("tile").agg(F.count("*").alias("come"))
    live = own.groupBy("tile").agg(F.count("*").alias("live"))
    parts = stored(live.join(come, "tile").select("tile", F.ceil(F.col("come") / (F.col("live") * PARTNERS)).alias("parts")), "tile-parts")  # a row for each tile
    held = own.drop("reach", "bound").join(F.broadcast(parts), "tile").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    visits = own.select("point", "vector", "bound", F.explode("reach").alias("tile")).join(F.broadcast(parts), "tile")
    return held.drop("parts"), visits.withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts"))).drop("parts")


def nearest(df: DataFrame, id_col: str, vector: Column, k: int = 20) -> DataFrame:
    """point, other, distance and weight: the k nearest other rows of each distinct
    vector, nearest first and smaller ids first among equals; equal neighbours are
    one row with their number as weight. A vector's own copies are its neighbours."""
    found = stored(points(df, id_col, vector), "points")
    if not found.head(1):
        return found.sparkSession.createDataFrame([], "point long, other long, distance double, weight long")
    held, visits = meetings(tiles(found, k), k)
    # weight is null for a visitor, bound for a point of the tile
    rows = held.withColumn("kind", F.lit(0)).unionByName(visits.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    rows = rows.repartition("tile", "part").sortWithinPartitions("tile", "part", "kind")
    rows = rows.mapInArrow(_best_of_tiles(k), "point long, other long, weight long, distance double")
    rank = Window.partitionBy("point").orderBy("distance", "other").rowsBetween(Window.unboundedPreceding, -1)
    copies = found.filter("weight > 1").select("point", F.col("point").alias("other"), (F.col("weight") - 1).alias("weight"), F.lit(0.0).alias("distance"))
    ranked = rows.unionByName(copies).withColumn("before", F.coalesce(F.sum("weight").over(rank), F.lit(0))).filter(F.col("before") < k)
    return ranked.select("point", "other", "distance", F.least("weight", F.lit(k) - F.col("before")).alias("weight"))


def _best_of_tiles(k: int):
    def best(visitors: pa.RecordBatch, y: np.ndarray, name: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The best k points of a tile inside each visitor's bound."""
        x, ids, limit = _matrix(visitors.column("vector")), visitors.column("point").to_numpy(), visitors.column("bound").to_numpy()
        for at in range(0, len(x), 512):
            xs = x[at:at + 512]
            # the rounded sums only choose; distances of those chosen are exact
            row, col = np.nonzero(_squares(xs, y) <= (limit[at:at + 512, None] + 1e-6) ** 2 + 1e-9)
            keep = ids[at + row] != name[col]
            row, col = row[keep], col[keep]
            d = np.sqrt(((xs[row] - y[col]) ** 2).sum(1))
            d = np.floor(d * 10 ** DECIMALS + 0.5) / 10 ** DECIMALS
            order = np.lexsort((name[col], d, row))
            row, col, d = row[order], col[order], d[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, col, d = row[first], col[first], d[first]
            if len(row):
                yield pa.record_batch([pa.array(ids[at + row]), pa.array(name[col]), pa.array(weight[col]), pa.array(d)], ["point", "other", "weight", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own, tile = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("tile", "part", "kind")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for at, stop in zip(cuts, cuts[1:]):
                if at == stop:
                    continue
                part, key = batch.slice(at, stop - at), tuple(keys[at][:2])
                if key != group:
                    group, own, tile = key, [], None
                if keys[at][2] == 0:
                    own.append(part)
                    continue
                if tile is None:
                    mine = pa.Table.from_batches(own).combine_chunks()
                    tile = [_matrix(mine["vector"].combine_chunks()), mine["point"].to_numpy(), mine["weight"].to_numpy()]
                yield from best(part, *tile)

    return run


def outlier_factor(df: DataFrame, id_col: str, vector: Column, k: int = 20, contamination: float = 0.1) -> DataFrame:
    """Id, k_distance, density (local reachability density), lof and
    is_outlier (lof above the quantile that leaves the `contamination` share). Each
    row has k neighbours, all others if they are fewer; rows without a whole
    vector, or the only one, have nulls and are no outliers."""
    rows = stored(df.select(F.col(id_col), F.transform(vector, lambda x: x.cast("double")).alias("_vector")))  # read for the points and the result
    edges = stored(nearest(rows, id_col, F.col("_vector"), k))
    reach = edges.groupBy("point").agg(F.max("distance").alias("k_distance"))
    far = edges.join(reach.withColumnRenamed("point", "other"), "other")
    each = F.greatest("distance", "k_distance") * F.col("weight")
    density = stored(far.groupBy("point").agg((1 / (F.sum(each) / F.sum("weight") + F.lit(EPSILON))).alias("density")))
    beside = edges.join(density.select(F.col("point").alias("other"), F.col("density").alias("_d")), "other")
    ratio = beside.groupBy("point").agg((F.sum(F.col("_d") * F.col("weight")) / F.sum("weight")).alias("_near"))
    scored = density.join(ratio, "point").join(reach, "point").withColumn("lof", T.round_half(F.col("_near") / F.col("density"), 6)).drop("_near")
    points_of = points(rows, id_col, F.col("_vector")).select(F.col("vector").alias("_vector"), "point")
    out = stored(rows.join(points_of.join(scored, "point").drop("point"), "_vector", "left").drop("_vector"))
    limit = exact_quantiles(out, "lof", [1 - contamination]).select(F.get("quantiles", F.lit(0)).alias("_limit"))
    return out.crossJoin(F.broadcast(limit)).withColumn("is_outlier", F.coalesce(F.col("lof") > F.col("_limit"), F.lit(False))).drop("_limit")
