"""Isolation forest (A10) on Spark.

Fit: each of ``n_trees`` trees draws its own deterministic subsample, the ``sample``
rows with the smallest hashes of (row id, tree), found among the about 3 * sample
rows below a bound; rows are routed to their trees, and each tree is grown into a
small node table in ``applyInPandas``. Features and thresholds come from hashes of
(tree, node), so any engine can repeat the forest. Nodes are numbered as in a heap:
the children of n are 2n and 2n + 1. The forest is at most n_trees x (2 * sample - 1)
nodes -- its size is bounded by the parameters, not by the data -- so it is broadcast
to the scoring ``mapInPandas`` pass over the full table. The anomaly threshold is the
exact ``contamination`` quantile of the scores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stored
from .labels import unit_hash
from .linear import unit
from .quantiles import exact_quantiles

NODE_SCHEMA = "tree long, node long, feature int, threshold double, left long, right long, size long"


def _c(n: float) -> float:
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(tree_id: int, X: np.ndarray, max_depth: int, seed: int) -> list[tuple]:
    nodes = []
    stack = [(np.arange(len(X)), 0, 1)]   # (row idx, depth, node id)
    while stack:
        idx, depth, nid = stack.pop()
        sub = X[idx]
        cand = np.flatnonzero(sub.max(axis=0) > sub.min(axis=0)) if depth < max_depth and len(idx) > 1 else []
        if len(cand) == 0:
            nodes.append((tree_id, nid, -1, 0.0, -1, -1, len(idx)))
            continue
        key = f"{tree_id}:{nid}:{seed}"
        f = int(cand[int(unit(f"{key}:feature") * len(cand))])
        lo, hi = float(sub[:, f].min()), float(sub[:, f].max())
        thr = lo + unit(f"{key}:threshold") * (hi - lo)
        nodes.append((tree_id, nid, f, thr, 2 * nid, 2 * nid + 1, len(idx)))
        mask = sub[:, f] < thr
        stack.append((idx[mask], depth + 1, 2 * nid))
        stack.append((idx[~mask], depth + 1, 2 * nid + 1))
    return nodes


def sample_bound(n: int, m: int) -> int:
    """Highest signed 64-bit hash at which one of n rows is drawn, so that about
    3 m rows are (all of them, if there are fewer)."""
    return -(1 << 63) + min((1 << 64) - 1, 3 * m * (1 << 64) // max(n, 1))


def fit(df: DataFrame, feature_cols: list[str], id_col: str, *, n_trees: int = 100,
        sample: int = 256, seed: int = 42) -> DataFrame:
    """Grow the forest; returns the node table (a small DataFrame)."""
    n = df.count()
    m = min(sample, n)
    bound = (sample_bound(n, m) + (1 << 63)) / (1 << 64)   # as a share of the hashes
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    drawn = F.transform(trees, lambda t: F.struct(t.alias("t"), unit_hash(F.concat_ws("/", F.col(id_col).cast("string"), t.cast("string")), seed, "sample").alias("h")))
    rows = (df.select(id_col, *feature_cols, F.explode(F.filter(drawn, lambda d: d["h"] < bound)).alias("_d"))
              .select(id_col, *feature_cols, F.col("_d.t").alias("tree"), F.col("_d.h").alias("_h")))
    w = Window.partitionBy("tree").orderBy("_h", id_col)
    rows = rows.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= m).drop("_rk", "_h")
    depth = int(math.ceil(math.log2(max(m, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        X = pdf[feature_cols].to_numpy(dtype=float)
        nodes = _grow(t, X, depth, seed)
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])

    return rows.groupBy("tree").applyInPandas(grow, NODE_SCHEMA), m


def score(df: DataFrame, nodes: DataFrame, feature_cols: list[str], sample: int,
          out_col: str = "if_score") -> DataFrame:
    """Anomaly score s = 2^(−E[h(x)]/c(sample)) per row (higher = more
    anomalous), computed batch-wise with numpy against the broadcast forest."""
    forest = nodes.toPandas()   # bounded: n_trees × (2·sample − 1) rows
    if sample > 0 and forest.empty:
        raise ValueError("no tree was grown: no row was drawn")
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(forest)
    cn = _c(sample)
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType(list(df.schema.fields) + [StructField(out_col, DoubleType())])

    def run(batches):
        fr = bc.value
        trees = []
        for _, g in fr.groupby("tree"):
            k = int(g["node"].max()) + 1
            arrs = {c: np.full(k, -1 if c != "threshold" else 0.0) for c in ("feature", "threshold", "left", "right", "size")}
            idx = g["node"].to_numpy()
            for c in arrs:
                arrs[c][idx] = g[c].to_numpy()
            csize = np.array([_c(v) for v in arrs["size"]])
            trees.append((arrs["feature"].astype(int), arrs["threshold"], arrs["left"].astype(int),
                          arrs["right"].astype(int), csize))
        for pdf in batches:
            X = pdf[feature_cols].to_numpy(dtype=float)
            n = len(X)
            rows = np.arange(n)
            depth_sum = np.zeros(n)
            for feat, thr, left, right, csize in trees:       # vectorised over the batch
                nid = np.ones(n, dtype=int)
                d = np.zeros(n)
                while True:
                    f = feat[nid]
                    act = f >= 0
                    if not act.any():
                        break
                    x = X[rows, np.where(act, f, 0)]
                    nxt = np.where(x < thr[nid], left[nid], right[nid])
                    nid = np.where(act, nxt, nid)
                    d += act
                depth_sum += d + csize[nid]
            avg = depth_sum / max(len(trees), 1)
            yield pdf.assign(**{out_col: np.power(2.0, -avg / cn) if cn > 0 else np.full(n, 0.5)})

    return df.mapInPandas(run, schema)


def detect(df: DataFrame, feature_cols: list[str], id_col: str, *, n_trees: int = 100,
           sample: int = 256, contamination: float = 0.1, seed: int = 42) -> DataFrame:
    """Fit on standardised features, score every row, flag the top
    ``contamination`` share (score above the (1 − c) quantile)."""
    stats = df.agg(*[x for c in feature_cols for x in (F.avg(c).alias(f"{c}__m"),
                                                      F.stddev_pop(c).alias(f"{c}__s"))])
    z = df.crossJoin(F.broadcast(stats))
    z = z.select(*df.columns, *[T.round_half(F.when(F.col(f"{c}__s") > 0, (F.col(c) - F.col(f"{c}__m")) / F.col(f"{c}__s"))
                                             .otherwise(F.lit(0.0)), 6).alias(f"_z_{c}") for c in feature_cols])
    zcols = [f"_z_{c}" for c in feature_cols]
    z = stored(z, "isolation-rows")   # read by fit, count and score
    nodes, m = fit(z, zcols, id_col, n_trees=n_trees, sample=sample, seed=seed)
    scored = stored(score(z, nodes, zcols, m).withColumn("if_score", T.round_half(F.col("if_score"), 6)), "isolation-scores")   # read for the threshold and the result
    thr = exact_quantiles(scored, "if_score", [1 - contamination]).select(F.get("quantiles", F.lit(0)).alias("_thr"))
    out = scored.crossJoin(F.broadcast(thr))
    return (out.withColumn("if_anomaly", F.col("if_score") > F.col("_thr"))
               .withColumn("decision_score", F.col("_thr") - F.col("if_score"))
               .drop("_thr", *zcols))
