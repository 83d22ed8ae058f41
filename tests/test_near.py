"""Nearest neighbours and local outlier factor (A11), similar texts (M3), against brute force."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptwatt.operators import neighbours, similar

SF = "/root/testdata/sf0.001"


def lof_plainly(rows, k):
    """sorted (id, k_distance, density, lof) by the definition, over rows (id, vector)."""
    first = {}
    for i, v in sorted(rows):
        first.setdefault(tuple(v), i)
    near = {}
    for i, v in rows:
        others = sorted((round(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), 9), first[tuple(w)], j) for j, w in rows if j != i)[:k]
        near[i] = [(d, j) for d, _, j in others]
    far = {i: x[-1][0] for i, x in near.items() if x}
    density = {i: 1 / (np.mean([max(d, far[j]) for d, j in near[i]]) + 1e-10) for i in far}
    return sorted((i, far[i], density[i], np.mean([density[j] for _, j in near[i]]) / density[i]) for i in far)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).round(3).tolist()) for i in range(150)]
    rows += [(200 + i, (rng.normal(size=3) * 0.05 + 6).round(3).tolist()) for i in range(60)]
    rows += [(300 + i, [1.0, 1.0, 1.0]) for i in range(70)]                  # a hot group of copies
    rows += [(400 + i, [float(i % 4), float(i // 4), -5.0]) for i in range(16)]  # equal distances
    rows += [(500, [40.0, -40.0, 0.0])]
    return rows


@pytest.mark.parametrize("dim_rows, partners", [(128, 32), (6, 3), (2, 1)])
def test_outlier_factor_matches_the_definition(spark, vectors, monkeypatch, dim_rows, partners):
    monkeypatch.setattr(neighbours, "DIM_ROWS", dim_rows)
    monkeypatch.setattr(neighbours, "PARTNERS", partners)
    df = spark.createDataFrame(vectors, "id long, v array<double>").repartition(5)
    got = sorted((r.id, r.k_distance, r.density, r.lof, r.is_outlier) for r in neighbours.outlier_factor(df, "id", F.col("v"), 10).collect())
    want = lof_plainly(vectors, 10)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1:4] for g in got], [w[1:] for w in want], rtol=1e-6, atol=2e-6)
    limit = np.quantile([g[3] for g in got], 0.9)
    assert [g[4] for g in got] == [g[3] > limit + 1e-12 for g in got]
    assert dict((g[0], g[4]) for g in got)[500]


def test_pruned_tiles_are_fewer_than_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "DIM_ROWS", 20)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=2) + 30 * (i % 9)).tolist()) for i in range(1800)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    dealt = neighbours.tiles(neighbours.points(df, "id", F.col("v")).checkpoint(), 5)
    n = dealt.select("tile").distinct().count()
    own, sent = neighbours.meetings(dealt, 5)
    assert n >= 30 and sent.count() < 0.3 * n * 1800 and own.select("point").distinct().count() == 1800


def test_a_far_point_draws_no_others_to_its_tile(spark, monkeypatch):
    """a point goes where its own bound reaches, however far a tile's widest bound does."""
    monkeypatch.setattr(neighbours, "DIM_ROWS", 20)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=2) + 300 * np.array([i % 3, i // 3 % 3])).tolist()) for i in range(1800)]
    rows += [(2000 + i, [300.0 * (i % 3) + 140.0, 300.0 * (i // 3) + 140.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    dealt = neighbours.tiles(neighbours.points(df, "id", F.col("v")).checkpoint(), 5)
    _, sent = neighbours.meetings(dealt, 5)
    assert sent.count() < 5 * 1800


def test_outlier_factor_of_few_missing_or_no_vectors(spark):
    kind = "id long, v array<float>, point long, lof string"
    df = spark.createDataFrame([(1, [0.0, 1.0], 9, "a"), (2, None, 9, "a"), (3, [None, 1.0], 9, "a"), (4, [0.0, 3.0], 9, "a"), (5, [0.0, 3.0], 9, "a")], kind)
    out = {r.id: r for r in neighbours.outlier_factor(df, "id", F.col("v"), 20).collect()}
    assert set(out) == {1, 2, 3, 4, 5} and out[2].lof is None and out[3].lof is None and not out[2].is_outlier
    assert out[1].k_distance == 2.0 and out[4].k_distance == 2.0
    assert neighbours.outlier_factor(df.limit(0), "id", F.col("v")).collect() == []
    assert [r.lof for r in neighbours.outlier_factor(df.filter("id = 1"), "id", F.col("v")).collect()] == [None]


def links_plainly(rows, threshold):
    sets = {i: frozenset((t or "").lower().split()) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    held = collections.defaultdict(list)
    for i, s in sets.items():
        for w in s:
            held[w].append(i)
    out = {}
    for i, s in sets.items():
        common = collections.Counter(j for w in s for j in held[w] if j != i)
        out[i] = (first[s], sum(c >= threshold * (len(s) + len(sets[j]) - c) - 1e-9 for j, c in common.items()))
    return out


def near_copies(n, size, changes, seed):
    rng = np.random.default_rng(seed)
    base = [f"w{seed}x{j}" for j in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for j in rng.choice(size, rng.integers(0, changes + 1), replace=False):
            words[j] = f"n{rng.integers(0, 40)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("hot, tile, threshold", [(64, 2048, 0.8), (3, 8, 0.8), (3, 700, 0.6), (10**6, 8, 0.8)])
def test_similar_texts_match_brute_force(spark, monkeypatch, hot, tile, threshold):
    monkeypatch.setattr(similar, "HOT", hot)
    monkeypatch.setattr(similar, "TILE", tile)
    texts = near_copies(120, 30, 5, 1) + near_copies(40, 12, 3, 2) + near_copies(9, 200, 30, 3) + [None, "", " \n ", "One", "one", "one two", "ONE Two two", "word " * 3000] * 2
    rows = list(enumerate(texts)) + [(10_000 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash")).repartition(4)
    got = {r.doc_id: (r.class_id, r.links) for r in similar.similar_texts(df, "doc_id", "text", threshold).collect()}
    assert got == links_plainly(rows, threshold)
    assert similar.similar_texts(df.limit(0), "doc_id", "text").collect() == []


def test_chance_meetings_of_long_texts_move_no_words(spark, monkeypatch):
    rows = [(i, " ".join([f"pair{i // 2}", *(f"w{i}x{j}" for j in range(600))])) for i in range(60)]
    rows += [(100, rows[0][1] + " more"), (101, rows[0][1])]
    kept, stored = {}, similar.stored
    monkeypatch.setattr(similar, "stored", lambda df, name="table": kept.setdefault(name, stored(df, name)))
    got = {r.doc_id: (r.class_id, r.links) for r in similar.similar_texts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 0.8).collect()}
    assert got == links_plainly(rows, 0.8) and got[0] == (0, 2)
    assert [tuple(r) for r in kept["near-pairs"].collect()] == [(0, 100)]


@pytest.mark.parametrize("hot", [64, 2])
def test_similar_texts_of_rows_that_come_twice(spark, monkeypatch, hot):
    monkeypatch.setattr(similar, "HOT", hot)
    rows = list(enumerate(near_copies(12, 30, 4, 5) + ["one two", None]))
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    once = links_plainly(rows, 0.8)
    out = [(r.doc_id, (r.class_id, r.links)) for r in similar.similar_texts(df, "doc_id", "text", 0.8).collect()]
    words = dict(rows)
    assert sorted(out) == sorted([(i, (c, 2 * n + bool(words[i]))) for i, (c, n) in once.items()] * 2)


def test_sketches_fold_to_the_smaller_size(spark):
    a, b = [1, 2, 4, 8, 16, 32, 64, 128], [17, 34, 68, 136]
    r = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(
        similar.folded(F.col("a"), F.lit(4)), similar.folded(F.col("b"), F.lit(4)), similar.folded(F.col("a"), F.lit(2))).first()
    assert r[0] == b and r[1] == b and r[2] is None


def test_chance_meetings_at_a_hot_word_move_no_words(spark, monkeypatch):
    monkeypatch.setattr(similar, "HOT", 3)
    monkeypatch.setattr(similar, "TILE", 8)
    rows = [(i, " ".join(["shared", *(f"w{i}x{j}" for j in range(100 + 20 * (i % 9)))])) for i in range(40)]
    rows += [(100, rows[7][1] + " more")]
    kept, stored = {}, similar.stored
    monkeypatch.setattr(similar, "stored", lambda df, name="table": kept.setdefault(name, stored(df, name)))
    monkeypatch.setattr(similar, "frequent_words", lambda sets: stored(sets.limit(0).select(F.lit(0).alias("word"), F.lit(0).alias("df")), "none").toPandas())
    monkeypatch.setattr(similar, "_needed", lambda n, threshold: n * 0 + 1)  # whole sets as prefixes, also a valid bound
    got = {r.doc_id: (r.class_id, r.links) for r in similar.similar_texts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 0.8).collect()}
    assert got == links_plainly(rows, 0.8) and got[7] == (7, 1)
    assert {r["class"] for r in kept["hot-words"].collect()} == {i for i, _ in rows}
    assert {r["class"] for r in kept["tile-rows"].collect()} == {7, 100}
