"""Model fitting and selection with MLlib.

Training data is a DataFrame; fitting is distributed by MLlib. Folds and
splits come from hashes of the row id (stable across partitionings).
"""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns by type, minus an exclude list."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def align_features(df: DataFrame, names: list[str]) -> DataFrame:
    """Reorder to a trained feature list; missing columns become 0.0."""
    cols = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) if n in df.columns
            else F.lit(0.0).alias(n) for n in names]
    return df.select(*[c for c in df.columns if c not in names], *cols)


def estimator(kind: str, label: str, features: str = "scaled", seed: int = 42, **params):
    """F2 forest (100 trees, depth 15), F3 boosting (200 × depth 5, step 0.1;
    ``precision``: 150 × 4, subsample 0.8), F4 ridge / elastic net."""
    if kind == "forest":
        return RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed,
                                     numTrees=params.get("numTrees", 100), maxDepth=params.get("maxDepth", 15),
                                     minInstancesPerNode=params.get("minInstancesPerNode", 2))
    if kind in ("boosting", "precision"):
        p = dict(maxIter=200, maxDepth=5, stepSize=0.1, subsamplingRate=1.0) if kind == "boosting" else \
            dict(maxIter=150, maxDepth=4, stepSize=0.1, subsamplingRate=0.8)
        p.update(params)
        return GBTRegressor(featuresCol=features, labelCol=label, seed=seed, **p)
    if kind == "ridge":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=params.get("regParam", 1.0),
                                elasticNetParam=0.0)
    if kind == "elastic_net":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=params.get("regParam", 0.1),
                                elasticNetParam=params.get("l1_ratio", 0.5))
    raise ValueError(kind)


def pipeline(feature_cols: list[str], label: str, kind: str = "boosting", polynomial: bool = False,
             **params) -> Pipeline:
    """F1 (+F9) + estimator: assemble → (degree-2 expansion) → standardise → fit."""
    stages = [VectorAssembler(inputCols=feature_cols, outputCol="raw_features", handleInvalid="keep")]
    src = "raw_features"
    if polynomial:
        stages.append(PolynomialExpansion(degree=2, inputCol=src, outputCol="poly_features"))
        src = "poly_features"
    stages.append(StandardScaler(inputCol=src, outputCol="scaled", withMean=True, withStd=True))
    stages.append(estimator(kind, label, **params))
    return Pipeline(stages=stages)


def fold_column(df: DataFrame, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(k)).cast("int"))


def evaluate(pred: DataFrame, label: str) -> dict:
    """R², RMSE, MAE of a prediction DataFrame (three small aggregations)."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("r2", "rmse", "mae")}


def metrics_frame(pred: DataFrame, label: str, model_name: str) -> DataFrame:
    """The same metrics as a one-row DataFrame in one aggregation pass."""
    e = F.col("prediction") - F.col(label)
    m = pred.agg(F.avg(label).alias("_ybar"))
    return (pred.crossJoin(F.broadcast(m))
            .agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                 (1 - F.sum(e * e) / F.sum((F.col(label) - F.col("_ybar")) ** 2)).alias("r2"),
                 F.count(F.lit(1)).alias("n"))
            .withColumn("model", F.lit(model_name)))


def cross_validate(df: DataFrame, pipe: Pipeline, label: str, id_col: str, k: int = 5,
                   grid=None, parallelism: int = 2, metric: str = "r2"):
    """k-fold CV on hash folds (``foldCol``) over an optional grid."""
    est = pipe
    grid = grid or ParamGridBuilder().build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, foldCol="fold", numFolds=k,
                        evaluator=RegressionEvaluator(labelCol=label, metricName=metric),
                        parallelism=parallelism, seed=42)
    return cv.fit(fold_column(df, id_col, k))


def random_grid(est, space: dict, n: int, seed: int = 42):
    """a seeded random sample of ``n`` points from a full grid."""
    b = ParamGridBuilder()
    for p, values in space.items():
        b = b.addGrid(getattr(est, p), values)
    grid = b.build()
    random.Random(seed).shuffle(grid)
    return grid[:n]


def select_best(df: DataFrame, feature_cols: list[str], label: str, id_col: str,
                kinds=("boosting", "forest", "ridge", "elastic_net"), train_percent: int = 80):
    """F8: fit each family on the hash train split, score on the test split,
    return (best PipelineModel, metrics DataFrame of all candidates)."""
    from pyspark import StorageLevel
    # Iterative fitting re-reads its input many times: materialise the
    # (numeric, narrow) training frame once instead of recomputing its lineage.
    df = df.select(id_col, *feature_cols, label).persist(StorageLevel.MEMORY_AND_DISK)
    split = F.pmod(F.xxhash64(F.col(id_col), F.lit(42)), F.lit(100)) < train_percent
    train, test = df.filter(split), df.filter(~split)
    best, best_r2, frames = None, None, []
    for kind in kinds:
        model = pipeline(feature_cols, label, kind).fit(train)
        mf = metrics_frame(model.transform(test), label, kind)
        r2 = mf.select("r2").first()[0]
        frames.append(mf)
        if best_r2 is None or (r2 is not None and r2 > best_r2):
            best, best_r2 = model, r2
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return best, out


def feature_importance(model: PipelineModel, feature_cols: list[str]) -> list[tuple[str, float]]:
    """tree importances or |coefficients|, sorted descending (a list of
    at most len(features) pairs — model metadata, not data)."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in last.coefficients.toArray().tolist()]
    names = feature_cols if len(vals) == len(feature_cols) else [f"f{i}" for i in range(len(vals))]
    return sorted(zip(names, vals), key=lambda kv: kv[1], reverse=True)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """batch prediction."""
    return model.transform(df)
