"""Ridge from sums (F1, F4, F6, F7, F9) and the forest (F2, F10, E13) against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptwatt.operators import forest, linear

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1, 100, 1e-3] + [5, 1000, 0]
    x[:, 2] = np.where(rng.random(400) < 0.5, x[:, 2], x[:, 0] / 7)
    y = 3 * x[:, 0] + 0.02 * x[:, 1] + rng.normal(size=400) * 0.1
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double")
    return x, y, df.repartition(3)


def scaled(x):
    return (x - x.mean(0)) / x.std(0)


def ridge(z, y, penalty):
    m, t = z.mean(0), y.mean()
    w = np.linalg.solve((z - m).T @ (z - m) + penalty * np.eye(z.shape[1]), (z - m).T @ (y - t))
    return w, t - m @ w


def test_ridge_and_importances(data):
    x, y, df = data
    w, w0 = ridge(scaled(x), y, 2.5)
    out = {r.feature: r for r in linear.ridge_fit(df, COLS, "y", 2.5).collect()}
    assert [out[c].coefficient for c in COLS] == pytest.approx(w.tolist()) and out["intercept"].coefficient == pytest.approx(w0)
    assert [out[c].importance for c in COLS] == pytest.approx((abs(w) / abs(w).sum()).tolist()) and out["intercept"].importance is None


def test_polynomial_features_are_scaled_by_the_population(data):
    x, _, df = data
    wide, names = linear.degree_two(df, COLS)
    got = linear.scaled(wide, names, ["id"]).orderBy("id").toPandas()[names].to_numpy()
    want = np.column_stack([x, *[x[:, i] * x[:, j] for i in range(3) for j in range(i, 3)]])
    assert np.allclose(got, scaled(want), atol=1e-8)


def test_search_repeats_plain_cross_validation(data):
    x, y, df = data
    z = scaled(x)
    fold = np.array([int(linear.unit(f"{i}:42:fold") * 5) for i in range(len(x))])
    penalties = linear.drawn_penalties(3)
    out = linear.ridge_search(df, "id", COLS, "y", penalties).collect()
    assert len(out) == 15 and all(1e-3 <= p <= 100 for p in penalties) and penalties == linear.drawn_penalties(3)
    for r in out:
        test = fold == r.fold
        w, w0 = ridge(z[~test], y[~test], penalties[r.point])
        e = y[test] - w0 - z[test] @ w
        assert (r.n, r.rmse, r.r2) == (test.sum(), pytest.approx(np.sqrt((e * e).mean())), pytest.approx(1 - (e * e).sum() / ((y[test] - y[test].mean()) ** 2).sum()))
    best = linear.search_summary(linear.ridge_search(df, "id", COLS, "y", penalties)).orderBy(F.desc("mean_r2")).first()
    assert best.folds == 5 and best.mean_r2 > 0.9


def test_ridge_of_constant_null_or_no_rows(spark, data):
    _, _, df = data
    flat = df.withColumn("c", F.lit(4.0)).withColumn("a", F.when(F.col("id") > 3, F.col("a")))
    out = {r.feature: r.coefficient for r in linear.ridge_fit(flat, COLS, "y").collect()}
    assert out["c"] == 0 and np.isfinite(list(out.values())).all()
    assert linear.ridge_fit(df.limit(0), COLS, "y").collect() == [] and linear.ridge_search(df.limit(0), "id", COLS, "y", [1.0]).collect() == []


def grow_plainly(x, y, trees, depth, candidates, min_split, min_leaf, seed):
    low, high = x.min(0).tolist(), x.max(0).tolist()
    out = {}
    for t in range(trees):
        bag = np.array([linear.unit(f"{i}/{t}:{seed}:bag") < forest.BAG for i in range(len(x))])
        stack = [(1, np.flatnonzero(bag), 0)]
        while stack:
            node, rows, d = stack.pop()
            best = None
            for c in range(candidates):
                f, thr = forest.draw(t, node, c, low, high, seed)
                left = x[rows, f] <= thr
                if d < depth and len(rows) >= min_split and min(left.sum(), (~left).sum()) >= min_leaf:
                    gain = round(sum(y[rows[s]].sum() ** 2 / s.sum() for s in (left, ~left)) - y[rows].sum() ** 2 / len(rows), 6)
                    if gain > 0 and (best is None or gain > best[2]):
                        best = (f, thr, gain, left)
            out[t, node] = (best and best[0], best and best[1], len(rows), y[rows].mean(), best and best[2])
            if best:
                stack += [(2 * node, rows[best[3]], d + 1), (2 * node + 1, rows[~best[3]], d + 1)]
    return out


def test_forest_matches_a_plain_one_and_its_spread(data):
    x, y, df = data
    want = grow_plainly(x, y, 5, 4, 3, 6, 2, 7)
    nodes = forest.grow(df, "id", COLS, "y", trees=5, depth=4, candidates=3, min_split=6, min_leaf=2, seed=7)
    got = {(r.tree, r.node): (r.feature, r.threshold, r.n, r.value, r.gain) for r in nodes.collect()}
    assert set(got) == set(want)
    for k, (f, thr, n, value, gain) in want.items():
        assert got[k][:3] == (f, thr, n) and got[k][3] == pytest.approx(value) and (gain is None) == (got[k][4] is None)

    def walk(t, row):
        node = 1
        while want[t, node][0] is not None:
            node = 2 * node + int(row[want[t, node][0]] > want[t, node][1])
        return want[t, node][3]

    for r in forest.predict(df, nodes, COLS).collect():
        values = np.array([walk(t, x[r.id]) for t in range(5)])
        assert (r.prediction, r.spread) == (pytest.approx(values.mean()), pytest.approx(values.std(), abs=1e-9))
        assert r.confidence == pytest.approx(min(1, max(0, 1 - values.std() / (values.mean() + 1e-6))))
    gains = np.array([sum(v[4] for v in want.values() if v[0] == i) for i in range(3)])
    ranks = forest.importances(nodes, COLS).orderBy("rank").collect()
    assert [r.feature for r in ranks] == [COLS[i] for i in np.argsort(-gains, kind="stable")]
    assert sum(r.importance for r in ranks) == pytest.approx(1, abs=1e-5)


def test_forest_of_nulls_and_no_rows(spark, data):
    _, _, df = data
    empty = forest.grow(df.limit(0), "id", COLS, "y", trees=2, depth=2)
    assert empty.collect() == [] and [r.prediction for r in forest.predict(df.limit(2), empty, COLS).collect()] == [None, None]
    nodes = forest.grow(df.withColumn("y", F.when(F.col("id") > 20, F.col("y"))), "id", COLS, "y", trees=2, depth=2)
    assert all(r.prediction is not None for r in forest.predict(df.withColumn("a", F.lit(None).cast("double")), nodes, COLS).collect())


def test_isolation_forest_isolates_an_outlier(spark):
    from promptwatt.operators import isolation
    rng = np.random.default_rng(2)
    rows = [(i, *rng.normal(size=2).tolist()) for i in range(300)] + [(999, 30.0, -30.0)]
    out = isolation.detect(spark.createDataFrame(rows, "id long, a double, b double"), ["a", "b"], "id", n_trees=30, sample=64).collect()
    assert max(out, key=lambda r: r.if_score).id == 999 and sum(r.if_anomaly for r in out) == pytest.approx(30, abs=2)
