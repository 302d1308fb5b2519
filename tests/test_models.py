"""Regressions against independent solutions, optimality conditions and known signals."""

import numpy as np
import pandas as pd
import pytest
from conftest import stamps
from pyspark.sql import functions as F

from loadcast.functions.holidays import holiday_dimension
from loadcast.operators.forest import (
    ForestParams, best_params, default_grid, fit_forest, importances, params_frame, scores_frame, trees_at_limit, tune,
)
from loadcast.operators.lags import lag_name
from loadcast.operators.lasso import _rules, fit_day, fit_hourly, l1_path, optimality, path_at, penalty_by_aic, penalty_by_cv
from loadcast.operators.pricing import n_features, price_design, rolling_scales, small_mode
from loadcast.operators.splits import fold_contiguous, regression_metrics
from loadcast.plans.load import (
    forecast_load, require_known, retrain_from_readings, retrain_load, train_load_models, training_panel,
)
from loadcast.plans.pricejobs import design_and_anchors, forecast_prices
from loadcast.sources.models import load_models, model_registry, save_models

TZ = "Europe/Rome"


def problem(n, p, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    x[:, -7:] = np.eye(7)[np.arange(n) % 7]  # dummies that sum to one
    x[:, 1] = x[:, 0] + 1e-3 * rng.normal(size=n)
    y = x[:, :8] @ rng.normal(size=8) + rng.normal(size=n)
    return x - x.mean(0), y - y.mean()


@pytest.mark.parametrize("n,p", [(200, 40), (30, 60), (14, 103)])
def test_path_is_optimal_at_any_penalty(n, p):
    x, y = problem(n, p)
    knots, coefs = l1_path(x, y)
    assert (np.diff(knots) <= 0).all()
    for penalty in knots[0] * np.geomspace(0.95, 1e-5, 15):
        b = path_at(knots, coefs, np.array([penalty]))[0]
        g = x.T @ (y - x @ b) / n
        assert np.abs(g).max() <= penalty * (1 + 1e-6) + 1e-12
        np.testing.assert_allclose(g[b != 0], penalty * np.sign(b[b != 0]), atol=1e-9)


def test_path_matches_proximal_descent():
    x, y = problem(60, 20, seed=4)
    knots, coefs = l1_path(x, y)
    penalty, n = knots[0] * 0.1, len(y)
    rate, b = 1 / np.linalg.eigvalsh(x.T @ x / n).max(), np.zeros(20)
    for _ in range(200_000):
        z = b + rate * (x.T @ (y - x @ b) / n)
        b = np.sign(z) * np.maximum(np.abs(z) - rate * penalty, 0)
    ours = path_at(knots, coefs, np.array([penalty]))[0]
    cost = [((y - x @ w) ** 2).sum() / (2 * n) + penalty * np.abs(w).sum() for w in (ours, b)]
    assert cost[0] <= cost[1] + 1e-10


def test_penalty_rules_find_a_sparse_signal():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 30))
    y = 3 * x[:, 0] - 2 * x[:, 3] + 0.1 * rng.normal(size=200)
    x, y = x - x.mean(0), y - y.mean()
    path = l1_path(x, y)
    for penalty in (penalty_by_aic(x, y, *path), penalty_by_cv(x, y)):
        b = path_at(*path, np.array([penalty]))[0]
        assert abs(b[0] - 3) < 0.1 and abs(b[3] + 2) < 0.1 and np.abs(np.delete(b, [0, 3])).max() < 0.05
    with pytest.raises(ValueError, match="days"):
        penalty_by_aic(x[:20], y[:20], *path)


def plain_scales(x, y):
    def of(a):
        low, mid, high = np.percentile(a, [25, 50, 75], axis=0)
        return mid, np.where(high == low, 1.0, high - low)

    (center, width), (y_center, y_width) = of(x), of(y)
    center[-7:], width[-7:] = 0, 1
    return center, width, y_center, y_width


def test_rolling_scales_are_those_of_each_window(spark):
    """Every anchor's window by itself, days with an unknown hour left out, a constant feature, an anchor without history."""
    rng = np.random.default_rng(5)
    rows = []
    for zone in ("N", "S"):
        for day in range(40):
            x, y = rng.normal(size=15).round(1), rng.normal(size=24)
            x[0] = 4.0
            rows.append((zone, 0, day, [None if (zone, day) == ("N", 17) and k == 3 else float(v) for k, v in enumerate(x)], y.tolist()))
    design = spark.createDataFrame(rows, "zone string, phase bigint, day int, x array<double>, y array<double>")
    anchors = spark.createDataFrame([("N", 0, 20), ("N", 0, 40), ("S", 0, 1), ("S", 0, 0), ("S", 0, 33), ("S", 0, 33)], "zone string, phase bigint, day int")
    got = {(r["zone"], r["day"]): r for r in rolling_scales(design, anchors, 12).collect()}
    assert set(got) == {("N", 20), ("N", 40), ("S", 1), ("S", 33)}
    for (zone, day), r in got.items():
        use = [q for q in rows if q[0] == zone and day - 12 <= q[2] < day and None not in q[3]]
        want = plain_scales(np.array([q[3] for q in use]), np.array([q[4] for q in use]))
        for name, value in zip(("x_center", "x_range", "y_center", "y_range"), want):
            np.testing.assert_allclose(r[name], value)


def test_optimality_tells_wrong_models(spark, prices):
    dates = spark.createDataFrame([("N", pd.Timestamp("2024-02-06").date())], "zone string, forecast_date date")
    design, anchors = design_and_anchors(prices, dates, TZ)
    models = fit_hourly(design, anchors, 28).cache()
    right = optimality(design, models, 28).toPandas()
    assert len(right) == 24 and right["excess"].max() <= 1 + 1e-6 and right["slack"].max() <= 1e-6
    wrong = models.withColumn("coef", F.transform("coef", lambda c: c * 1.01))
    assert (optimality(design, wrong, 28).toPandas()["slack"] > 1e-4).all()


def test_fit_day_chooses_its_rule_by_window_length():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(110, n_features())), rng.normal(size=(110, 1))
    for rule in ("cv7", "aic"):
        assert fit_day(x, y, rule, plain_scales(x, y))[0][0] == rule
    with pytest.raises(ValueError, match="AIC"):
        fit_day(x[:50], y[:50], "aic", plain_scales(x, y))
    with pytest.raises(ValueError, match="7 days"):
        fit_day(x[:6], y[:6], "cv7", plain_scales(x, y))


def test_rule_of_a_window_is_that_of_small_mode(spark):
    """The window's known hours decide, gaps included; the same count as ``small_mode``."""
    rng = np.random.default_rng(3)
    for days, gap in ((118, 0), (119, 0), (130, 10), (130, 12)):
        ts = pd.date_range("2024-01-01", periods=24 * days, freq="h")
        keep = [t for t in ts if not 0 < (t - ts[0]).days - 20 <= gap]
        rows = [("N", t.to_pydatetime(), float(v)) for t, v in zip(keep, rng.normal(50, 9, len(keep)))]
        prices = spark.createDataFrame(rows, "zone string, ts timestamp, price double")
        day = (ts[-1] + pd.Timedelta(hours=1)).date()
        dates = spark.createDataFrame([("N", day)], "zone string, forecast_date date")
        design, anchors = design_and_anchors(prices, dates, "UTC", phases=[0])
        ahead = prices.unionByName(spark.createDataFrame([("N", pd.Timestamp(day).to_pydatetime() + pd.Timedelta(hours=h), None) for h in range(24)], prices.schema))
        small = small_mode(ahead, ["zone"]).first()["small"]
        assert _rules(design, anchors, 364, "auto").first()["rule"] == ("cv7" if small else "aic"), (days, gap)


def test_every_requested_forecast_returns(spark, prices):
    """A day with too little history gives its rows, null and with the reason."""
    dates = spark.createDataFrame([("N", pd.Timestamp(d).date()) for d in ("2024-01-04", "2024-02-06")], "zone string, forecast_date date")
    got = forecast_prices(prices, dates, TZ, window_days=28).toPandas()
    assert len(got) == 48
    early = got[got["ts_local"] < pd.Timestamp("2024-01-10")]
    assert len(early) == 24 and early["yhat"].isna().all() and early["reason"].str.contains("known days").all()
    assert got["yhat"].notna().sum() == 24


def test_exogenous_forecasts_are_known(spark, prices):
    """A column known on the forecast day, when the price is not, reaches the design."""
    two = prices.withColumn("load", F.col("price") * 2 + 1)
    day = pd.Timestamp("2024-02-06")
    cut = two.withColumn("price", F.when(F.col("ts") < F.lit("2024-02-05 23:00:00").cast("timestamp"), F.col("price")))
    dates = spark.createDataFrame([("N", day.date())], "zone string, forecast_date date")
    got = forecast_prices(cut, dates, TZ, window_days=28, exog=["load"]).toPandas()
    assert len(got) == 24 and got["yhat"].notna().all()


@pytest.fixture(scope="module")
def prices(spark):
    """Two zones with a daily and weekly shape; the week before repeats with noise."""
    rng = np.random.default_rng(7)
    ts = pd.date_range("2024-01-01", periods=24 * 45, freq="h")
    rows = []
    for zone, level in (("N", 60.0), ("S", 90.0)):
        shape = level + 20 * np.sin(2 * np.pi * ts.hour / 24) + 10 * (ts.dayofweek < 5) + rng.normal(0, 1, len(ts))
        rows += [(zone, t.to_pydatetime(), float(v)) for t, v in zip(ts, shape)]
    return spark.createDataFrame(rows, "zone string, ts timestamp, price double").cache()


def test_design_cells(spark, prices):
    row = price_design(prices, "zone", [0]).where("zone = 'N' AND day = 19743").first()  # 2024-01-21, a Sunday
    known = {(r["ts"]): r["price"] for r in prices.where("zone = 'N'").collect()}
    day = pd.Timestamp("2024-01-21")
    want = [known[(day - pd.Timedelta(days=d) + pd.Timedelta(hours=h)).to_pydatetime()] for h in range(24) for d in (1, 2, 3, 7)]
    assert row["x"][:96] == want and row["x"][96:] == [0.0] * 6 + [1.0]
    assert row["y"] == [known[(day + pd.Timedelta(hours=h)).to_pydatetime()] for h in range(24)]


def test_design_with_exogenous_columns(prices):
    two = prices.withColumn("load", F.col("price") * 2)
    row = price_design(two, "zone", [0], exog=["load"]).where("zone = 'N' AND day = 19743").first()
    base = price_design(prices, "zone", [0]).where("zone = 'N' AND day = 19743").first()
    assert len(row["x"]) == n_features(1) == 175
    lag1 = [base["x"][4 * h] for h in range(24)]
    assert [row["x"][96 + 3 * h] for h in range(24)] == [2 * v for v in lag1]
    assert [row["x"][96 + 3 * h + 2] for h in range(24)] == [2 * v for v in base["y"]]


def test_price_forecasts_beat_last_week_and_do_not_see_the_day(spark, prices):
    dates = spark.createDataFrame([(z, pd.Timestamp(d).date()) for z in "NS" for d in ("2024-02-05", "2024-02-06", "2024-02-12")], "zone string, forecast_date date")
    got = forecast_prices(prices, dates, TZ, window_days=28, days_per_group=2).toPandas()
    assert len(got) == 2 * 3 * 24 and got["yhat"].notna().all() and (got["yhat"] >= 0).all()
    assert got["ts_local"].dt.hour.tolist() == got["hour"].tolist()
    truth = prices.toPandas().rename(columns={"price": "y"})
    week = truth.assign(ts=truth["ts"] + pd.Timedelta(days=7)).rename(columns={"y": "naive"})
    j = got.merge(truth, on=["zone", "ts"]).merge(week, on=["zone", "ts"])
    assert (j["y"] - j["yhat"]).abs().mean() < (j["y"] - j["naive"]).abs().mean()
    # Prices from the forecast day on change nothing.
    cut = prices.where(F.col("ts") < F.lit("2024-02-11 23:00:00").cast("timestamp"))
    again = forecast_prices(cut, dates, TZ, window_days=28, days_per_group=5).toPandas()
    pd.testing.assert_frame_equal(
        got.sort_values(["zone", "ts"]).reset_index(drop=True), again.sort_values(["zone", "ts"]).reset_index(drop=True)
    )


FEATURES = ["temperature_2m", "sin_quarter", "cos_quarter"]
SIZE = {"max_depth": 5, "max_bins": 32}
SMALL = ForestParams(8, "all", 2)


@pytest.fixture(scope="module")
def data(spark):
    """Three weeks of two targets that follow the hour and the temperature."""
    rng = np.random.default_rng(11)
    ts = stamps("2024-01-01", 96 * 21)
    q = np.arange(len(ts)) % 96
    temp = 10 + 5 * np.sin(2 * np.pi * q / 96) + rng.normal(0, 0.5, len(ts))
    rows = [
        ("S1", t, float(100 + 3 * k + rng.normal()), float(10 + np.cos(2 * np.pi * h / 96)), float(k), float(np.sin(2 * np.pi * h / 96)), float(np.cos(2 * np.pi * h / 96)))
        for t, h, k in zip(ts, q, temp)
    ]
    return spark.createDataFrame(rows, "site_id string, ts timestamp, a double, b double, temperature_2m double, sin_quarter double, cos_quarter double").cache()


def test_training_job(spark, data):
    panel, names = training_panel(data, ["a", "b"], FEATURES, [48])
    assert names == [*FEATURES, lag_name(48)]
    grid = [ForestParams(1, "log2", 400), SMALL]
    done = train_load_models(panel, names, F.lit("2024-01-17").cast("timestamp"), None, grid, final_days=10, **SIZE)
    m = {r["target"]: r for r in done.metrics.collect()}
    assert set(m) == {"a", "b"} and set(done.models) == {("S1", "a"), ("S1", "b")}
    for r in m.values():
        assert r["params"]["trees"] == 8 and r["r2"] > 0.8
        assert r["train_end"] == pd.Timestamp("2024-01-17") and r["test_start"] == pd.Timestamp("2024-01-17 00:15")
        assert r["final_train_end"] == r["test_end"] and r["final_train_samples"] <= 10 * 96 + 1
        assert r["n_train"] + r["n_test"] == panel.where(F.col("target") == r["target"]).count()
    assert done.scores.count() == 4


def test_expanding_folds_only_look_back(spark, data):
    panel, names = training_panel(data, ["a"], FEATURES, [48])
    scores = tune(panel, names, [SMALL, ForestParams(1, "log2", 500)], "expanding", **SIZE)
    best = best_params(scores_frame(spark, {("S1", "a"): scores})).first()
    assert best["params"]["trees"] == 8
    folds = fold_contiguous(panel, ["target"], 3).groupBy("fold").agg(F.min("ts").alias("a"), F.max("ts").alias("z")).orderBy("fold").collect()
    assert folds[0]["z"] < folds[1]["a"] and folds[1]["z"] < folds[2]["a"]


def test_forecast_day_from_saved_models(spark, data, tmp_path):
    panel, names = training_panel(data, ["a", "b"], FEATURES, [48, 168])
    history = data.unpivot(["site_id", "ts"], ["a", "b"], "target", "y")
    _, models = retrain_load(
        spark, data.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp")), data.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")),
        params_frame(spark, {("S1", "a"): SMALL, ("S1", "b"): SMALL}), ["a", "b"], 14, FEATURES, [48, 168], **SIZE,
    )
    save_models(spark, models, str(tmp_path))
    assert [r["target"] for r in model_registry(spark, str(tmp_path)).collect()] == ["a", "b"]
    loaded = load_models(spark, str(tmp_path))
    hol = holiday_dimension(spark, 2024, 2024)
    weather = data.select("site_id", "ts", "temperature_2m")
    got = forecast_load(history, weather, hol, loaded, "2024-01-20", TZ, hours=[48, 168], features=FEATURES)
    assert got.groupBy("target").count().toPandas()["count"].tolist() == [96, 96]
    judged = regression_metrics(got.join(history, ["site_id", "target", "ts"]), ["target"]).toPandas()
    assert (judged["r2"] > 0.8).all()
    zero = forecast_load(history, weather, hol, loaded, "2024-07-01", TZ, zero_months=(5, 6, 7, 8, 9))
    assert zero.count() == 192 and zero.where("yhat <> 0").count() == 0
    ranked = importances(spark, loaded).where("target = 'a'").collect()
    assert ranked[0]["importance"] == max(r["importance"] for r in ranked) and len(ranked) == len(names)


def test_each_site_has_its_own_models(spark, data):
    """Equal target names on two sites: every model sees its own site's rows only."""
    other = data.withColumn("site_id", F.lit("S2")).withColumn("a", 1000 - F.col("a"))
    panel, names = training_panel(data.unionByName(other), ["a"], FEATURES, [48])
    done = train_load_models(panel, names, F.lit("2024-01-17").cast("timestamp"), None, [SMALL], final_days=10, **SIZE)
    rows = {(r["site_id"], r["target"]): r for r in done.metrics.collect()}
    assert set(rows) == {("S1", "a"), ("S2", "a")} == set(done.models)
    assert all(r["r2"] > 0.8 and r["rmse"] < 20 for r in rows.values())
    assert rows["S1", "a"]["n_train"] == panel.where("site_id = 'S1'").where(F.col("ts") <= F.lit("2024-01-17").cast("timestamp")).count()


def test_scoring_names_unknown_features(spark):
    matrix = spark.createDataFrame([("S", "a", 1.0, None), ("S", "a", None, 2.0), ("S", "b", 1.0, None)], "site_id string, target string, x double, z double")
    with pytest.raises(ValueError, match=r"'a'\): \['x', 'z'\]"):
        require_known(matrix, {("S", "a"): ["x", "z"], ("S", "b"): ["x"]})
    require_known(matrix, {("S", "b"): ["x"]})


def test_trees_at_their_depth_limit_are_counted(spark, data):
    panel, names = training_panel(data, ["a"], FEATURES, [48])
    model = fit_forest(panel, names, SMALL, max_depth=3)
    assert trees_at_limit(model, 3) == SMALL.trees and trees_at_limit(model) == 0


def test_metrics_count_the_final_forests_cut_trees(spark, data):
    panel, names = training_panel(data, ["a"], FEATURES, [48])
    done = train_load_models(panel, names, F.lit("2024-01-17").cast("timestamp"), None, [SMALL], final_days=10, max_depth=3)
    assert [r["trees_at_limit"] for r in done.metrics.collect()] == [trees_at_limit(done.models[("S1", "a")], 3)] == [SMALL.trees]


def test_retraining_job(spark, data):
    """Due readings to a block, upsert, refit, as one job."""
    history = data.where(F.col("ts") < F.lit("2024-01-18").cast("timestamp"))
    ends = F.lit("2024-01-21 12:00:00").cast("timestamp")
    readings = data.select("site_id", "ts")
    current, models = retrain_from_readings(
        readings, history, ends, lambda block: block.join(data, ["site_id", "ts"]), TZ, params_frame(spark, {("S1", "a"): SMALL}), ["a"],
        days=14, features=FEATURES, hours=[48], **SIZE,
    )
    assert set(models) == {("S1", "a")}
    assert current.count() == data.where(F.col("ts") < F.lit("2024-01-19 23:00:00").cast("timestamp")).count()


def test_default_grid():
    assert len(default_grid()) == 75
