"""Regression forests per series, that is per target of a site, on keyed feature tables.

Each fit is one distributed Spark ML job over the series' rows. Fits of different series and
parameters are independent, so a small driver pool keeps several jobs in flight; only models and
scores reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .splits import fold_contiguous, fold_expanding, trailing_window

# The parameter grid.
GRID_TREES = (100, 200, 300, 400, 500)
GRID_FEATURES = ("log2", "sqrt", "all")
GRID_MIN_LEAF = (2, 5, 10, 20, 30)
FOLDS = 3
FINAL_DAYS = 365

PARAMS_SCHEMA = "struct<trees int, features string, min_leaf int>"

# What a model belongs to, and its values: (site_id, target).
SERIES = ("site_id", "target")
Series = tuple[str, str]


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    features: str = "all"
    min_leaf: int = 2


# The deepest trees the fitted library allows; bins of a feature, finer than its default.
MAX_DEPTH = 30
MAX_BINS = 128


def default_grid() -> list[ForestParams]:
    return [ForestParams(t, f, m) for t in GRID_TREES for f in GRID_FEATURES for m in GRID_MIN_LEAF]


def _forest(p: ForestParams, seed: int, max_depth: int, max_bins: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol="y", predictionCol="yhat", numTrees=p.trees,
        featureSubsetStrategy=p.features, minInstancesPerNode=p.min_leaf, maxDepth=max_depth,
        maxBins=max_bins, seed=seed, cacheNodeIds=False,
    )


def fit_forest(
    train: DataFrame, features: Sequence[str], params: ForestParams, seed: int = 42, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS
) -> PipelineModel:
    """Forest on the rows of one series; the feature order is stored in the model."""
    steps = [VectorAssembler(inputCols=list(features), outputCol="features"), _forest(params, seed, max_depth, max_bins)]
    return Pipeline(stages=steps).fit(train)


def trees_at_limit(model: PipelineModel, max_depth: int = MAX_DEPTH) -> int:
    """Trees that stopped growing at ``max_depth`` rather than by the size of their leaves."""
    return sum(tree.depth >= max_depth for tree in model.stages[-1].trees)


def feature_order(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def tune(
    train: DataFrame, features: Sequence[str], grid: Sequence[ForestParams], folds: str = "contiguous", k: int = FOLDS,
    seed: int = 42, parallelism: int = 4, ts: str = "ts", max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS,
) -> list[tuple[ForestParams, float]]:
    """Mean squared error over k time-ordered folds for each parameter set of one series."""
    keys = list(SERIES)
    label = fold_contiguous if folds == "contiguous" else fold_expanding
    assembled = (
        VectorAssembler(inputCols=list(features), outputCol="features")
        .transform(label(train, keys, k, ts))
        .select("features", "y", "fold")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    evaluator = RegressionEvaluator(labelCol="y", predictionCol="yhat", metricName="mse")
    try:
        if folds == "contiguous":
            forest = _forest(grid[0], seed, max_depth, max_bins)
            maps = [
                {forest.numTrees: p.trees, forest.featureSubsetStrategy: p.features, forest.minInstancesPerNode: p.min_leaf}
                for p in grid
            ] or ParamGridBuilder().build()
            cv = CrossValidator(
                estimator=forest, estimatorParamMaps=maps, evaluator=evaluator, numFolds=k, foldCol="fold",
                parallelism=parallelism, seed=seed,
            )
            return list(zip(grid, cv.fit(assembled).avgMetrics))

        def error(job: tuple[ForestParams, int]) -> float:
            p, fold = job
            model = _forest(p, seed, max_depth, max_bins).fit(assembled.where(F.col("fold") < fold))
            return evaluator.evaluate(model.transform(assembled.where(F.col("fold") == fold)))

        jobs = [(p, i) for p in grid for i in range(k)]
        scores = in_flight(train.sparkSession, error, jobs, parallelism)
        return [(p, sum(scores[i * k : (i + 1) * k]) / k) for i, p in enumerate(grid)]
    finally:
        assembled.unpersist()


def in_flight(spark: SparkSession, fn: Callable, jobs: Iterable, parallelism: int = 4) -> list:
    """Run independent Spark jobs with a few of them in flight; results keep their order."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fn), jobs))


def scores_frame(spark: SparkSession, scores: Mapping[Series, Sequence[tuple[ForestParams, float]]]) -> DataFrame:
    """Typed rows (site_id, target, params, param_order, mse): one per series and grid point."""
    rows = [
        (*t, (p.trees, p.features, p.min_leaf), i, float(mse))
        for t, per in scores.items()
        for i, (p, mse) in enumerate(per)
    ]
    return spark.createDataFrame(rows, f"site_id string, target string, params {PARAMS_SCHEMA}, param_order int, mse double")


def best_params(scores: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Parameters with the lowest mean error; ties go to the earlier grid point."""
    rank = F.struct("mse", "param_order")
    return scores.groupBy(*keys).agg(F.min_by("params", rank).alias("params"), F.min("mse").alias("mse"))


def as_params(row) -> ForestParams:
    return ForestParams(**row["params"].asDict())


def params_frame(spark: SparkSession, params: Mapping[Series, ForestParams]) -> DataFrame:
    return spark.createDataFrame(
        [(*t, tuple(asdict(p).values())) for t, p in params.items()], f"site_id string, target string, params {PARAMS_SCHEMA}"
    )


def refit(
    rows: DataFrame, features: Sequence[str], params: ForestParams, days: int | None = None, seed: int = 42,
    max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS,
) -> PipelineModel:
    """Final fit on the trailing window of the series, or on every valid row."""
    recent = rows if days is None else trailing_window(rows, list(SERIES), days)
    return fit_forest(recent, features, params, seed, max_depth, max_bins)


def score(horizon: Mapping[Series, DataFrame], models: Mapping[Series, PipelineModel], keep: Sequence[str] = (*SERIES, "ts")) -> DataFrame:
    """Forecasts of every series that has both a model and horizon rows, as one long table."""
    out = None
    for target in sorted(models):
        if target not in horizon:
            continue
        one = models[target].transform(horizon[target]).select(*keep, F.col("yhat"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no series has both a model and history")
    return out


def importances(spark: SparkSession, models: Mapping[Series, PipelineModel]) -> DataFrame:
    """Feature importances by name, highest first within a series: one row per model feature."""
    rows = [
        (*t, name, float(v))
        for t, m in models.items()
        for name, v in zip(feature_order(m), m.stages[-1].featureImportances.toArray())
    ]
    return spark.createDataFrame(rows, "site_id string, target string, feature string, importance double").orderBy(
        *SERIES, F.desc("importance"), "feature"
    )
