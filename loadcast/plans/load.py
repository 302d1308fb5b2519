"""Load workflows: build datasets, train, forecast, retrain."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import CYCLIC_FEATURES, add_calendar
from ..functions.scalars import clip, zero_in_months
from ..functions.timecols import DAY, HOUR, shift, to_local
from ..operators.clean import conform, dedup_first, valid_rows
from ..operators.forest import (
    FINAL_DAYS, MAX_DEPTH, SERIES, ForestParams, Series, as_params, best_params, feature_order, fit_forest, in_flight,
    score, scores_frame, trees_at_limit, tune,
)
from ..operators.grid import between_ts, bin_mean, day_horizon, spine, to_grid
from ..operators.history import next_window, params_for, upsert
from ..operators.interpolate import fill_linear, fill_time
from ..operators.lags import DEFAULT_LAGS, lag_name, lag_onto_horizon, lag_time
from ..operators.meters import (
    GROSS_PREFIX, GROSS_TOTAL, NET_TOTAL, SUPPLY_ROLES, align, counter_to_power, gross, join_weather,
    prefer_main, pv_sum,
)
from ..operators.ordered import series_bounds
from ..operators.splits import period_stats, regression_metrics, split_label, trailing_window
from ..session import stage
from ..sources.weather import WEATHER_COLUMNS

# Defaults of the two load workflows.
SUPPLY_FILL_LIMIT = 2
SUMMER_MONTHS = (5, 6, 7, 8, 9)
THERMAL_CAP_KW = 13000.0
HISTORY_DAYS = 8
MIN_LAG_HOURS = 48

BASE_FEATURES = [*WEATHER_COLUMNS, *CYCLIC_FEATURES, "campus_closed", "T_open"]


PV_ROLES = ("pv_main", "pv_backup")


def meter_bins(readings: DataFrame, meter_map: DataFrame) -> DataFrame:
    """15-minute means (site, variable, ts, value) of every mapped meter, counters as power."""
    clean = dedup_first(
        readings.select("site_id", "variable_id", "ts", "value"), ["site_id", "variable_id", "ts"], ["value"]
    )
    is_pv = F.col("role").isin(*PV_ROLES)

    def of(which: Column) -> DataFrame:
        used = meter_map.where(which).select("site_id", "variable_id").distinct()
        return clean.join(used, ["site_id", "variable_id"], "left_semi")

    keys = ["site_id", "variable_id"]
    power = counter_to_power(of(is_pv), keys, power="kw").select(*keys, "ts", F.col("kw").alias("value"))
    return bin_mean(of(~is_pv), keys).withColumn("counter", F.lit(False)).unionByName(
        bin_mean(power, keys).withColumn("counter", F.lit(True))
    )


def supply_15m(bins: DataFrame, limit: int = SUPPLY_FILL_LIMIT) -> DataFrame:
    """Grid and CHP power (site, role, variable, ts, value) on the site's grid, short gaps filled."""
    keys = ["site_id", "role", "variable_id"]
    means = bins.where(F.col("role").isin(*SUPPLY_ROLES)).select(*keys, "ts", "value")
    meters = means.select(*keys).distinct()
    span = series_bounds(means, ["site_id"], "ts").drop("n_rows")
    grid = spine(meters.join(span, "site_id"), keys, "first_ts", "last_ts")
    return fill_linear(grid.join(means, [*keys, "ts"], "left"), keys, ["value"], limit=limit)


def electric_targets(
    readings: DataFrame, meter_map: DataFrame, residual_cabin: str, fill_limit: int = SUPPLY_FILL_LIMIT, gross_min: int = 1, net_min: int = 1
) -> DataFrame:
    """Long targets (site, target, ts, y): gross consumption per cabin and the two totals.

    The raw readings are reduced to 15-minute bins and staged; the balance then runs on groups
    of (site, ts), which hold one row per cabin and supply meter.
    """
    bins = stage(meter_bins(readings, meter_map), "meter-bins")
    placed = bins.join(meter_map, ["site_id", "variable_id"]).where(
        F.col("counter") == F.col("role").isin(*PV_ROLES)
    )
    cabin = ["site_id", "cabin", "ts"]
    net = placed.where(F.col("role") == "net").groupBy(*cabin).agg(F.sum("value").alias("value"))
    pv = pv_sum(prefer_main(placed.where(F.col("role").isin(*PV_ROLES)), ["site_id", "cabin", "position", "ts"]), cabin)
    supply = supply_15m(placed, fill_limit)

    def rows(df: DataFrame, kind: str, name: Column, value: str = "value") -> DataFrame:
        return df.select("site_id", name.alias("cabin"), "ts", F.lit(kind).alias("kind"), F.col(value).alias("value"))

    every = (
        rows(net, "net", F.col("cabin"))
        .unionByName(rows(pv, "pv", F.col("cabin"), "pv"))
        .unionByName(rows(supply, "supply", F.concat_ws(":", "role", "variable_id")))
    )

    def of(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("value")))

    role = F.col("role")
    cabins = meter_map.groupBy("site_id", "cabin").agg(
        F.max(role == "net").alias("has_net"), F.max(role.isin(*PV_ROLES)).alias("has_pv")
    )
    rest_pv = meter_map.groupBy("site_id").agg(
        F.max((F.col("cabin") == residual_cabin) & role.isin(*PV_ROLES)).alias("rest_has_pv")
    )
    per_cabin = (
        every.groupBy(*cabin)
        .agg(of("net").alias("net"), of("pv").alias("pv"), of("supply").alias("supply"))
        .join(cabins, ["site_id", "cabin"], "left")
        .join(rest_pv, "site_id")
        .withColumn("gross", F.when(F.col("has_net"), gross(F.col("net"), F.col("pv"), F.col("has_pv"))))
    )
    # The residual cabin has no net meter: its net is what the others leave of the supply, and its PV adds to that.
    own = F.col("cabin") == residual_cabin
    left_net = F.sum("supply") - F.sum("net")
    left_over = gross(left_net, F.max(F.when(own, F.col("pv"))), F.max("rest_has_pv"))
    named = F.struct(F.concat(F.lit(GROSS_PREFIX), "cabin").alias("target"), F.col("gross").alias("y"))
    site = per_cabin.groupBy("site_id", "ts").agg(
        F.collect_list(F.when(F.col("has_net"), named)).alias("cabins"),  # one per cabin of the site
        left_over.alias("rest"),
        F.when(F.count("supply") >= net_min, F.sum("supply")).alias("net_total"),
        F.when(
            F.count("gross") + left_over.isNotNull().cast("int") >= gross_min,
            F.coalesce(F.sum("gross"), F.lit(0.0)) + F.coalesce(left_over, F.lit(0.0)),
        ).alias("gross_total"),
    )
    extra = F.array(
        F.struct(F.lit(GROSS_PREFIX + residual_cabin).alias("target"), F.col("rest").alias("y")),
        F.struct(F.lit(GROSS_TOTAL).alias("target"), F.col("gross_total").alias("y")),
        F.struct(F.lit(NET_TOTAL).alias("target"), F.col("net_total").alias("y")),
    )
    return site.select("site_id", "ts", F.explode(F.concat("cabins", extra)).alias("t")).select(
        "site_id", "t.target", "ts", "t.y"
    )


def wide_dataset(targets: DataFrame, names: Sequence[str], weather: DataFrame, holidays: DataFrame, tz: str) -> DataFrame:
    """Targets side by side on the site's grid, with weather and calendar features.

    The aligned table is staged: the grid reads it twice, for its bounds and for its values.
    """
    wide = to_grid(stage(align(targets, ["site_id"], "target", names, value="y"), "aligned"), ["site_id"])
    return add_calendar(join_weather(wide, weather), holidays, tz)


def build_electric_dataset(
    readings: DataFrame, meter_map: DataFrame, weather: DataFrame, holidays: DataFrame, cabins: Sequence[str], residual_cabin: str,
    tz: str, **options,
) -> DataFrame:
    """Readings to the 15-minute training dataset of the electrical targets."""
    names = [*[GROSS_PREFIX + c for c in [*cabins, residual_cabin]], GROSS_TOTAL, NET_TOTAL]
    return wide_dataset(electric_targets(readings, meter_map, residual_cabin, **options), names, weather, holidays, tz)


def thermal_targets(
    readings: DataFrame, names: Mapping[str, str], tz: str, cap: float = THERMAL_CAP_KW, months: Sequence[int] = SUMMER_MONTHS
) -> DataFrame:
    """Long thermal targets: first reading per stamp, bin means, clipped, zero in summer."""
    label = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])[F.col("variable_id")]
    used = readings.where(F.col("variable_id").isin(*names))
    clean = dedup_first(used.select("site_id", "variable_id", "ts", "value"), ["site_id", "variable_id", "ts"], ["value"])
    means = stage(bin_mean(clean.withColumn("target", label), ["site_id", "target"]), "thermal-bins")
    y = zero_in_months(clip("value", 0.0, cap), "ts", months, tz)
    return to_grid(means, ["site_id", "target"]).select("site_id", "target", "ts", y.alias("y"))


def build_thermal_dataset(readings: DataFrame, names: Mapping[str, str], weather: DataFrame, holidays: DataFrame, tz: str, **options) -> DataFrame:
    """Readings to the 15-minute training dataset of the thermal targets."""
    return wide_dataset(thermal_targets(readings, names, tz, **options), list(names.values()), weather, holidays, tz)


def training_panel(
    dataset: DataFrame, targets: Sequence[str], features: Sequence[str] = BASE_FEATURES, hours: Sequence[int] = DEFAULT_LAGS,
    nonzero: bool = False, ts: str = "ts",
) -> tuple[DataFrame, list[str]]:
    """Valid rows (site, target, ts, y, features, lags) of every target, and the feature order.

    The jobs below stage the panel by target, so each fit reads only its own folder.
    """
    long = dataset.unpivot(["site_id", ts, *features], list(targets), "target", "y").where(F.col("y").isNotNull())
    lagged = lag_time(long, ["site_id", "target"], "y", hours, ts)
    names = [*features, *[lag_name(h) for h in hours]]
    return valid_rows(lagged, names, "y", nonzero), names


@dataclass
class Trained:
    """Result of a training run: models by (site_id, target), typed metrics, fold scores."""

    models: dict[Series, PipelineModel]
    metrics: DataFrame
    scores: DataFrame
    features: list[str] = field(default_factory=list)


def series_of(panel: DataFrame) -> list[Series]:
    """Distinct (site_id, target), sorted: one row per model reaches the driver."""
    return [tuple(r) for r in panel.select(*SERIES).distinct().orderBy(*SERIES).collect()]


def rows_of(panel: DataFrame, series: Series) -> DataFrame:
    """The rows of one series; as literals, so a panel staged by series reads one folder."""
    site, target = series
    return panel.where((F.col("site_id") == site) & (F.col("target") == target))


def train_load_models(
    panel: DataFrame, features: Sequence[str], train_end: Column, test_start: Column | None, grid: Sequence[ForestParams],
    folds: str = "contiguous", k: int = 3, final_days: int | None = FINAL_DAYS, seed: int = 42, parallelism: int = 4, **forest,
) -> Trained:
    """Tune, test on the held-out period, refit, for every series (site and target) of the panel."""
    spark = panel.sparkSession
    split = stage(panel.withColumn("split", split_label("ts", train_end, test_start)), "panel", SERIES)
    names = series_of(split)
    keys = list(SERIES)

    def one(series: Series):
        rows = rows_of(split, series)
        train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
        if train.isEmpty() or test.isEmpty():
            raise ValueError(f"{series}: no rows to train on or none to test on")
        scores = tune(train, features, grid, folds, k, seed, parallelism, **forest)
        best = min(scores, key=lambda s: s[1])[0]
        tested = fit_forest(train, features, best, seed, **forest).transform(test).select(*keys, "ts", "y", "yhat")
        final = rows if final_days is None else trailing_window(rows, keys, final_days)
        return scores, best, tested, fit_forest(final, features, best, seed, **forest), final

    results = dict(zip(names, in_flight(spark, one, names, min(parallelism, 2))))
    tested = None
    finals = None
    for _, _, rows, _, final in results.values():
        tested = rows if tested is None else tested.unionByName(rows)
        one_final = final.select(*keys, "ts")
        finals = one_final if finals is None else finals.unionByName(one_final)
    measured = regression_metrics(tested, keys).drop("n_rows")
    scores = scores_frame(spark, {t: r[0] for t, r in results.items()})
    stats = period_stats(split.where(F.col("split").isNotNull()), [*keys, "split"])
    by = stats.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("split") == s, F.col(c))).alias(n)
            for s in ("train", "test")
            for c, n in (("period_start", f"{s}_start"), ("period_end", f"{s}_end"), ("n_samples", f"n_{s}"))
        ]
    )
    last = period_stats(finals, keys).select(
        *keys, F.col("period_start").alias("final_train_start"), F.col("period_end").alias("final_train_end"),
        F.col("n_samples").alias("final_train_samples"),
    )
    depth = forest.get("max_depth", MAX_DEPTH)
    cut = spark.createDataFrame(
        [(*t, trees_at_limit(r[3], depth)) for t, r in results.items()], "site_id string, target string, trees_at_limit int"
    )
    metrics = best_params(scores).drop("mse").join(measured, keys).join(by, keys).join(last, keys).join(cut, keys)
    return Trained({t: r[3] for t, r in results.items()}, metrics, scores, list(features))


def feature_horizon(weather: DataFrame, holidays: DataFrame, day: Column, tz: str) -> DataFrame:
    """Weather and calendar features on the grid of one local day, per site."""
    sites = weather.select("site_id").distinct()
    grid = day_horizon(sites, ["site_id"], day, tz)
    return add_calendar(grid.join(weather, ["site_id", "ts"], "left"), holidays, tz)


def scoring_matrix(
    history: DataFrame, horizon: DataFrame, day: Column, tz: str, hours: Sequence[int] = DEFAULT_LAGS,
    features: Sequence[str] = BASE_FEATURES, history_days: int = HISTORY_DAYS, min_lag_hours: int = MIN_LAG_HOURS,
    lag_cap: float | None = None,
) -> DataFrame:
    """Horizon rows of every target with base features and repaired lags.

    The history is cut to the days the lags can reach before anything else, so the scan prunes.
    """
    start = F.to_utc_timestamp(day.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), tz)
    recent = between_ts(history, shift(start, -history_days * DAY), shift(end, -min_lag_hours * HOUR - 900))
    keys = ["site_id", "target"]
    repaired = fill_time(to_grid(recent, keys), keys, ["y"])
    ahead = horizon.join(recent.select(*keys).distinct(), "site_id")
    lagged = lag_onto_horizon(repaired, ahead, keys, "y", hours)
    names = [lag_name(h) for h in hours]
    if lag_cap is not None:
        lagged = lagged.withColumns({n: clip(n, 0.0, lag_cap) for n in names})
    full = ahead.select(*keys, "ts", *features).join(lagged, [*keys, "ts"])
    return fill_linear(full, keys, [*features, *names], both=True)


def require_known(matrix: DataFrame, needed: Mapping[Series, Sequence[str]]) -> None:
    """Raise, with the columns, where a feature of a series is still unknown after repair; one pass over the horizon."""
    names = sorted({n for per in needed.values() for n in per})
    counts = matrix.groupBy(*SERIES).agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in names]).collect()
    unknown = {(r[0], r[1]): [n for n in needed[r[0], r[1]] if r[n]] for r in counts if (r[0], r[1]) in needed}
    if unknown := {t: cols for t, cols in unknown.items() if cols}:
        raise ValueError(f"features still unknown after repair: {unknown}")


def forecast_load(
    history: DataFrame, weather: DataFrame, holidays: DataFrame, models: Mapping[Series, PipelineModel], day: str, tz: str,
    zero_months: Sequence[int] = (), **options,
) -> DataFrame:
    """Day-ahead forecast (site, target, ts, yhat, ts_local) of every series with model and history.

    A day in the zero months is an all-zero forecast that reads no history.
    """
    d = F.lit(day).cast("date")
    if int(day[5:7]) in zero_months:
        named = history.sparkSession.createDataFrame(sorted(models), "site_id string, target string")
        out = day_horizon(named, list(SERIES), d, tz).withColumn("yhat", F.lit(0.0))
        return out.withColumn("ts_local", to_local("ts", tz))
    # Staged by series: one model reads one folder, and the history is repaired once.
    named = history.sparkSession.createDataFrame(sorted(models), "site_id string, target string")
    wanted = history.join(named, list(SERIES), "left_semi")
    matrix = stage(scoring_matrix(wanted, feature_horizon(weather, holidays, d, tz), d, tz, **options), "scoring", SERIES)
    have = series_of(matrix)
    if left_out := sorted(set(models) - set(have)):
        warnings.warn(f"series without history, not forecast: {left_out}", stacklevel=2)
    rows = {}
    for t in have:
        rows[t] = conform(rows_of(matrix, t), feature_order(models[t]), [*SERIES, "ts"])
    require_known(matrix, {t: feature_order(models[t]) for t in have})
    return score(rows, models).withColumn("ts_local", to_local("ts", tz))


def retrain_load(
    spark: SparkSession, history: DataFrame, new_block: DataFrame, params: DataFrame, targets: Sequence[str], days: int | None = FINAL_DAYS,
    features: Sequence[str] = BASE_FEATURES, hours: Sequence[int] = DEFAULT_LAGS, nonzero: bool = False, seed: int = 42,
    parallelism: int = 4, **forest,
) -> tuple[DataFrame, dict[Series, PipelineModel]]:
    """Upsert a new dataset block and refit every series of the targets from its stored parameters.

    Lags are taken before the trailing window is cut, so the window keeps its first week.
    """
    current = upsert(history, new_block, ["site_id", "ts"])
    panel, names = training_panel(current, targets, features, hours, nonzero)
    recent = stage(panel if days is None else trailing_window(panel, list(SERIES), days), "panel", SERIES)
    wanted = recent.select(*SERIES).distinct()
    chosen = {(r["site_id"], r["target"]): as_params(r) for r in params_for(wanted, params, SERIES).collect()}

    def one(series: Series) -> PipelineModel:
        return fit_forest(rows_of(recent, series), names, chosen[series], seed, **forest)

    every = sorted(chosen)
    return current, dict(zip(every, in_flight(spark, one, every, parallelism)))


def retrain_from_readings(
    readings: DataFrame, history: DataFrame, now: Column, build, tz: str, params: DataFrame, targets: Sequence[str], **options
) -> tuple[DataFrame, dict[Series, PipelineModel]]:
    """The retraining job: take the readings that are due, build their dataset block, upsert it and refit.

    ``build`` turns a block of readings into dataset rows with the history's columns. A block is built with its own
    readings only, so it starts with the next whole quarter-hour after the history.
    """
    block = stage(missing_block(readings, history, now, tz), "due-readings")
    new = history.limit(0) if block.isEmpty() else build(block).select(*history.columns)
    return retrain_load(history.sparkSession, history, new, params, targets, **options)


def missing_block(
    readings: DataFrame, history: DataFrame, now: Column, tz: str, keys: Sequence[str] = ("site_id",), **options
) -> DataFrame:
    """Readings of the next block to append, per site; nothing for sites already current.

    The outer bounds of all windows are literals, so the scan of the readings prunes; each site's own window follows.
    """
    window = stage(next_window(history, keys, now, tz, **options), "next-window")
    first, last = window.agg(F.min("window_start"), F.max("window_end")).first()
    if first is None:
        return readings.limit(0)
    due = readings.where((F.col("ts") >= F.lit(first)) & (F.col("ts") < shift(F.lit(last), 900)))
    return due.join(window, list(keys)).where(
        (F.col("ts") >= F.col("window_start")) & (F.col("ts") < shift("window_end", 900))
    ).drop("window_start", "window_end")
