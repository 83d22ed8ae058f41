"""Scaling, degree-2 features and ridge regression from sums.

Everything that a ridge fit needs of the data is the matrix of sums of products of
its features, its label and one. These sums are one aggregate for each fold, so a
fit, k folds and any number of penalties cost one pass over the rows: the sums of a
training set are the total less those of its fold, and the squared error on the
fold follows from the fold's own sums. Only matrices of (features + 2)^2 numbers
for each fold reach the driver.

Features are scaled by the mean and population deviation over all rows, before the
folds are cut. A feature without deviation becomes zero.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .labels import unit_hash


def unit(key: str) -> float:
    """The same U[0, 1) of a key as ``unit_hash``."""
    return int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16 ** 13


def degree_two(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """df with all products of two columns (squares included), named a__b, and
    the names of all features, the columns first."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    out = df.select("*", *[(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    return out, [*cols, *[f"{a}__{b}" for a, b in pairs]]


def scaled(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """the columns `keep` and the features, each less its mean over its
    population deviation. The statistics are one row, broadcast."""
    stats = df.agg(*[x for i, c in enumerate(cols) for x in (F.avg(F.col(c).cast("double")).alias(f"_m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"_d{i}"))])
    each = [F.when(F.col(f"_d{i}") > 0, (F.col(c) - F.col(f"_m{i}")) / F.col(f"_d{i}")).otherwise(F.lit(0.0)).alias(c) for i, c in enumerate(cols)]
    return df.crossJoin(F.broadcast(stats)).select(*keep, *each)


def fold_sums(df: DataFrame, cols: list[str], label: str, fold: str | None = None) -> dict[int, np.ndarray]:
    """For each fold the sums of products of (1, features, label); one pass. Rows
    with a null feature or label are left out."""
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in cols], F.col(label).cast("double")]
    whole = df.filter(~F.greatest(*[F.col(c).isNull() for c in (*cols, label)]))
    sums = [F.sum(terms[i] * terms[j]).alias(f"s{i}_{j}") for i in range(len(terms)) for j in range(i, len(terms))]
    keyed = whole.groupBy((F.col(fold) if fold else F.lit(0)).alias("fold")).agg(*sums)
    out = {}
    for r in keyed.collect():  # a row for each fold
        m = np.zeros((len(terms), len(terms)))
        for i in range(len(terms)):
            for j in range(i, len(terms)):
                m[i, j] = m[j, i] = r[f"s{i}_{j}"]
        out[r.fold] = m
    return out


def solve(sums: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the ridge fit: the centred sums with the
    penalty on their diagonal; the intercept is free."""
    n, mean = sums[0, 0], sums[0, 1:] / sums[0, 0]
    centred = sums[1:, 1:] - n * np.outer(mean, mean)
    p = len(mean) - 1
    coefficients = np.linalg.solve(centred[:p, :p] + penalty * np.eye(p), centred[:p, p])
    return coefficients, float(mean[p] - mean[:p] @ coefficients)


def errors(sums: np.ndarray, coefficients: np.ndarray, intercept: float) -> tuple[float, float]:
    """RMSE and R2 of a fit on the rows that the sums describe."""
    n, w = sums[0, 0], np.concatenate([[-intercept], -coefficients, [1.0]])
    squares = float(w @ sums @ w)
    total = sums[-1, -1] - sums[0, -1] ** 2 / n
    return float(np.sqrt(max(squares, 0.0) / n)), float(1 - squares / total) if total > 0 else float("nan")


def ridge_fit(df: DataFrame, cols: list[str], label: str, penalty: float = 1.0) -> DataFrame:
    """feature, coefficient (on scaled features) and importance (F10, its share
    of the absolute coefficients); the intercept is a row with a null importance."""
    sums = fold_sums(scaled(df, cols, [label]), cols, label)
    rows = []
    if sums:
        coefficients, intercept = solve(sums[0], penalty)
        whole = float(np.abs(coefficients).sum()) or 1.0
        rows = [(c, float(w), abs(float(w)) / whole) for c, w in zip(cols, coefficients)] + [("intercept", intercept, None)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, importance double")


def drawn_penalties(n: int, seed: int = 42, low: float = -3, high: float = 2) -> list[float]:
    """n penalties, log-uniform between 10^low and 10^high, fixed by the seed."""
    return [10 ** (low + (high - low) * unit(f"{k}:{seed}:penalty")) for k in range(n)]


def ridge_search(df: DataFrame, id_col: str, cols: list[str], label: str, penalties: list[float], folds: int = 5, seed: int = 42) -> DataFrame:
    """a row for each fold and penalty: n, rmse and r2 on the fold of the fit
    to all other folds. Folds come from a hash of the id."""
    rows = scaled(df, cols, [id_col, label]).withColumn("_fold", F.floor(unit_hash(F.col(id_col), seed, "fold") * folds).cast("int"))
    sums = fold_sums(rows, cols, label, "_fold")
    total = sum(sums.values()) if sums else None
    out = []
    for fold, own in sorted(sums.items()):
        if len(sums) > 1:  # else there is nothing to fit to
            out += [(fold, i, float(penalty), int(own[0, 0]), *errors(own, *solve(total - own, penalty))) for i, penalty in enumerate(penalties)]
    return df.sparkSession.createDataFrame(out, "fold int, point int, penalty double, n long, rmse double, r2 double")


def search_summary(results: DataFrame) -> DataFrame:
    """Mean and population deviation of r2 over the folds for each penalty,
    best first."""
    return results.groupBy("point", "penalty").agg(F.count("*").alias("folds"), F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"), F.avg("rmse").alias("mean_rmse"))
