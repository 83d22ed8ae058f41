"""Random forest as a node table: growth, prediction with the spread between trees
(E13), importances (F10) and main contributors (E14).

Trees are extremely randomised: each node draws a few splits (a feature and a
threshold inside its range) from hashes of (tree, node) and takes the one that lowers
the squared error most; a tree sees the share BAG of the rows, by a hash of the
row's id. A level of all trees is one aggregate over the rows, which stay where they
are and find their node by walking the nodes grown so far; what reaches the driver
and is broadcast is the model: at most trees * 2^(depth + 1) nodes. Growth, walk and
scores are column expressions, and SQL can repeat them from the same hashes.

Nodes are numbered as in a heap (children of n: 2n and 2n + 1, the root is 1); a row
goes right if its feature exceeds the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..session import stored
from .labels import unit_hash
from .linear import unit

BAG = 0.632
#: Gains count as equal when they agree to so many decimals.
DECIMALS = 6
NODES = "tree int, node int, feature int, threshold double, n long, value double, gain double"


def draw(tree: int, node: int, candidate: int, low: list[float], high: list[float], seed: int) -> tuple[int, float]:
    """Feature and threshold of a candidate split."""
    key = f"{tree}:{node}:{candidate}:{seed}"
    feature = int(unit(f"{key}:feature") * len(low))
    return feature, low[feature] + unit(f"{key}:threshold") * (high[feature] - low[feature])


def _model(spark, nodes: list[tuple], trees: int, depth: int) -> DataFrame:
    """One row: for each tree the nodes in heap order (null where there is none)."""
    heap = [[None] * (2 ** (depth + 1) - 1) for _ in range(trees)]
    for tree, node, feature, threshold, _, value, _ in nodes:
        heap[tree][node - 1] = (feature, threshold, value)
    return spark.createDataFrame([(heap,)], "_forest array<array<struct<feature:int,threshold:double,value:double>>>")


def _walk(tree: Column, x: Column, depth: int) -> Column:
    """The node of a tree where a row ends."""
    def step(node: Column, _: Column) -> Column:
        at = F.get(tree, node - 1)
        return F.when(at["feature"].isNull(), node).otherwise(2 * node + (F.get(x, at["feature"]) > at["threshold"]).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(1), step)


def grow(df: DataFrame, id_col: str, cols: list[str], label: str, *, trees: int = 20, depth: int = 6, candidates: int = 4,
         min_split: int = 5, min_leaf: int = 2, seed: int = 42) -> DataFrame:
    """the node table of a forest for `label`; rows with a null are left out."""
    spark = df.sparkSession
    bag = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: unit_hash(F.concat_ws("/", F.col(id_col).cast("string"), t.cast("string")), seed, "bag") < BAG)
    whole = df.filter(~F.greatest(*[F.col(c).isNull() for c in (*cols, label)]))
    rows = stored(whole.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), F.col(label).cast("double").alias("y"), bag.alias("bag")), "forest-rows")
    spans = rows.agg(*[f(F.col("x")[i]) for f in (F.min, F.max) for i in range(len(cols))]).first()
    if spans[0] is None:
        return spark.createDataFrame([], NODES)
    low, high = list(spans)[:len(cols)], list(spans)[len(cols):]
    nodes: list[tuple] = []
    level = [(t, 1) for t in range(trees)]
    for d in range(depth + 1):
        drawn = {(t, n): [draw(t, n, c, low, high, seed) for c in range(candidates)] for t, n in level}
        table = spark.createDataFrame([(t, n, s) for (t, n), s in drawn.items()], "tree int, node int, splits array<struct<feature:int,threshold:double>>")
        walked = rows.crossJoin(F.broadcast(_model(spark, nodes, trees, depth))).select("x", "y", F.explode("bag").alias("tree"), "_forest")
        walked = walked.select("x", "y", "tree", _walk(F.get("_forest", F.col("tree")), F.col("x"), d).alias("node")).join(F.broadcast(table), ["tree", "node"])
        left = [F.get("x", F.col("splits")[c]["feature"]) <= F.col("splits")[c]["threshold"] for c in range(candidates)]
        sums = [y for c in range(candidates) for y in (F.count_if(left[c]).alias(f"n{c}"), F.sum(F.when(left[c], F.col("y")).otherwise(0.0)).alias(f"s{c}"))]
        found = walked.groupBy("tree", "node").agg(F.count("*").alias("n"), F.sum("y").alias("s"), *sums).collect()  # a row for each open node
        level = []
        for r in sorted(found, key=lambda r: (r.tree, r.node)):
            best = None
            for c, (feature, threshold) in enumerate(drawn[r.tree, r.node]):
                a, b = r[f"n{c}"], r.n - r[f"n{c}"]
                if d < depth and r.n >= min_split and min(a, b) >= min_leaf:
                    s = r[f"s{c}"]
                    gain = round(s * s / a + (r.s - s) ** 2 / b - r.s * r.s / r.n, DECIMALS)
                    if gain > 0 and (best is None or gain > best[2]):
                        best = (feature, threshold, gain)
            nodes.append((r.tree, r.node, best and best[0], best and best[1], r.n, r.s / r.n, best and best[2]))
            if best:
                level += [(r.tree, 2 * r.node), (r.tree, 2 * r.node + 1)]
        if not level:
            break
    return spark.createDataFrame(nodes, NODES)


def predict(df: DataFrame, nodes: DataFrame, cols: list[str], out: str = "prediction") -> DataFrame:
    """df with the mean over trees, `spread` (their population deviation) and E13's
    `confidence`, 1 - spread / mean clipped to [0, 1]. Null features stay left."""
    found = [tuple(r) for r in nodes.collect()]  # the model: bounded by its parameters
    trees = max((r[0] for r in found), default=-1) + 1
    depth = max((r[1].bit_length() - 1 for r in found), default=0)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))) for c in cols])
    staged = df.withColumn("_x", x).crossJoin(F.broadcast(_model(df.sparkSession, found, trees, depth)))
    value = F.transform("_forest", lambda t: F.get(t, _walk(t, F.col("_x"), depth) - 1)["value"])
    staged = staged.withColumn("_values", value).drop("_forest", "_x")
    mean = F.aggregate("_values", F.lit(0.0), lambda s, v: s + v) / F.nullif(F.size("_values"), F.lit(0))
    staged = staged.withColumn(out, mean)
    square = F.aggregate("_values", F.lit(0.0), lambda s, v: s + (v - F.col(out)) * (v - F.col(out)))
    staged = staged.withColumn("spread", F.sqrt(square / F.nullif(F.size("_values"), F.lit(0)))).drop("_values")
    return staged.withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("spread") / (F.col(out) + 1e-6))))


def importances(nodes: DataFrame, cols: list[str]) -> DataFrame:
    """feature, importance (its share of all split gains) and rank; features of
    equal importance keep their order."""
    names = nodes.sparkSession.createDataFrame(list(enumerate(cols)), "feature int, name string")
    gains = nodes.filter("feature is not null").groupBy("feature").agg(F.sum("gain").alias("gain"))
    whole = gains.agg(F.sum("gain").alias("whole"))
    share = T.round_half(F.coalesce(F.col("gain") / F.col("whole"), F.lit(0.0)), 6)
    out = F.broadcast(names).join(gains, "feature", "left").crossJoin(F.broadcast(whole)).select(F.col("name").alias("feature"), "feature", share.alias("importance"))
    return _ranked(out.toDF("feature", "_at", "importance"))


def _ranked(df: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("i"), F.col("_at").alias("a"), F.col("feature").alias("f"))))  # a row for each feature
    return df.agg(rows.alias("r")).select(F.posexplode("r").alias("p", "r")).select(F.col("r.f").alias("feature"), (-F.col("r.i")).alias("importance"), (F.col("p") + 1).cast("int").alias("rank"))
