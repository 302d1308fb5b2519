"""Load workflows over any number of series in one job each: tune, train, forecast, retrain, with trees as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import to_local
from ..operators.fleet import fit_fleet, mean_scores, predict_fleet
from ..operators.forest import FINAL_DAYS, SERIES, best_params
from ..operators.grid import day_horizon
from ..operators.history import params_for, scorable, upsert
from ..operators.lags import DEFAULT_LAGS
from ..operators.splits import period_stats, regression_metrics, split_label, trailing_window
from ..session import stage
from .load import BASE_FEATURES, feature_horizon, scoring_matrix, training_panel


@dataclass
class TrainedFleet:
    """Result of a training run: trees of the final models, predictions of the held-out rows, one typed metrics row per series."""

    trees: DataFrame
    tested: DataFrame
    metrics: DataFrame


def train_fleet(
    panel: DataFrame, features: Sequence[str], scores: DataFrame, train_end: Column, test_start: Column | None = None,
    final_days: int | None = FINAL_DAYS, seed: int = 42,
) -> TrainedFleet:
    """Choose parameters from fold errors, test on the held-out period, refit, for every series of the panel.

    ``scores``: rows of ``fleet.tune_fleet`` over the training rows. Series without rows to train on or to test on are
    left out of the metrics; series without scores raise.
    """
    keys = list(SERIES)
    split = stage(panel.withColumn("split", split_label("ts", train_end, test_start)), "panel", SERIES)
    best = stage(best_params(mean_scores(scores)), "best-params")
    params_for(split.select(*keys).distinct(), best, keys)  # raises where one is lacking
    chosen = best.select(*keys, "params")
    train, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    tested = stage(predict_fleet(test, fit_fleet(train, features, chosen, seed), [*keys, "ts", "y"]), "tested")
    final = split if final_days is None else trailing_window(split, keys, final_days)
    trees = stage(fit_fleet(final.drop("split"), features, chosen, seed), "trees", ["site_id"])
    stats = period_stats(split.where(F.col("split").isNotNull()), [*keys, "split"])
    periods = stats.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("split") == s, F.col(c))).alias(n)
            for s in ("train", "test")
            for c, n in (("period_start", f"{s}_start"), ("period_end", f"{s}_end"), ("n_samples", f"n_{s}"))
        ]
    )
    last = period_stats(final, keys).select(
        *keys, F.col("period_start").alias("final_train_start"), F.col("period_end").alias("final_train_end"),
        F.col("n_samples").alias("final_train_samples"),
    )
    measured = regression_metrics(tested, keys).drop("n_rows")
    return TrainedFleet(trees, tested, chosen.join(measured, keys).join(periods, keys).join(last, keys))


def forecast_fleet(
    history: DataFrame, weather: DataFrame, holidays: DataFrame, trees: DataFrame, day: str, tz: str, zero_months: Sequence[int] = (), **options
) -> tuple[DataFrame, DataFrame]:
    """Day-ahead forecast (site, target, ts, yhat, ts_local) of every series with model and history, and the series without history.

    One plan whatever the number of series. A day in the zero months is an all-zero forecast that reads no history. A
    feature that is unknown after repair makes a null forecast.
    """
    keys = list(SERIES)
    d = F.lit(day).cast("date")
    models = trees.select(*keys).distinct()
    if int(day[5:7]) in zero_months:
        out = day_horizon(models, keys, d, tz).withColumn("yhat", F.lit(0.0))
        return out.withColumn("ts_local", to_local("ts", tz)), models.limit(0)
    wanted = history.join(models, keys, "left_semi")
    matrix = stage(scoring_matrix(wanted, feature_horizon(weather, holidays, d, tz), d, tz, **options), "scoring", ["site_id"])
    _, without = scorable(matrix, models, keys)
    return predict_fleet(matrix, trees).withColumn("ts_local", to_local("ts", tz)), without


def retrain_fleet(
    history: DataFrame, new_block: DataFrame, params: DataFrame, targets: Sequence[str], days: int | None = FINAL_DAYS,
    features: Sequence[str] = BASE_FEATURES, hours: Sequence[int] = DEFAULT_LAGS, nonzero: bool = False, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Upsert a new dataset block and refit every series of the targets from its stored parameters: (history, trees).

    Lags are taken before the trailing window is cut, so the window keeps its first week.
    """
    keys = list(SERIES)
    current = upsert(history, new_block, ["site_id", "ts"])
    panel, names = training_panel(current, targets, features, hours, nonzero)
    recent = stage(panel if days is None else trailing_window(panel, keys, days), "panel", SERIES)
    chosen = params_for(recent.select(*keys).distinct(), params, keys)
    return current, fit_fleet(recent, names, chosen, seed)
