"""Model operators.

What SQL can say of a fitted model is in the result of the keys with SQL: rows, stamps, periods, counts, rules, and
whether the fitted values are what they must be. The fitted values themselves are the result of the ``*_values`` keys,
which have no SQL; ``tests/test_models.py`` and ``tests/test_fleet.py`` hold them against independent solutions.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...functions.calendar import CYCLIC_FEATURES
from ...operators.fleet import fit_fleet, importances_of, load_fleet, predict_fleet, registry_of, save_fleet, tune_fleet
from ...operators.forest import ForestParams, default_grid, params_frame
from ...functions.timecols import HOUR
from ...operators.grid import resample_mean
from ...operators.interpolate import fill_linear, fill_time
from ...operators.lasso import fit_hourly, optimality, penalty_summary, predict_hourly
from ...operators.lags import DEFAULT_LAGS, lag_name
from ...operators.pricing import DEFAULT_WINDOW_DAYS, price_design, robust_scale, rolling_scales
from ...operators.splits import regression_metrics, split_label, trailing_window
from ...sources.panel import METRICS_SCHEMA, write_metrics
from ...sources.weather import WEATHER_COLUMNS, explode_regular_block
from ..fleet import forecast_fleet, retrain_fleet, train_fleet
from ..load import training_panel, wide_dataset
from ..pricejobs import design_and_anchors, forecast_prices
from .aggregates import DAYS_IN_WINDOW, LAST_DAY, window_design
from .base import GRID, PRICES, TZ, Tables, local, query, rnd, to_utc

DESIGN = f"""{PRICES}, d AS (SELECT DISTINCT zone, date_trunc('day', ts) AS d0 FROM p),
    hh AS (SELECT unnest(generate_series(0, 23)) AS h), ll AS (SELECT * FROM (VALUES (0, 1), (1, 2), (2, 3), (3, 7)) v(i, k)),
    cells AS (SELECT d.zone, d0, h * 4 + i AS feature, p.price AS value FROM d, hh, ll
        LEFT JOIN p ON p.zone = d.zone AND p.ts = d0 + to_hours(h) - to_days(k)
      UNION ALL SELECT zone, d0, 96 + w, CASE WHEN isodow(d0) = w + 1 THEN 1.0 ELSE 0.0 END FROM d, (SELECT unnest(generate_series(0, 6)) AS w)),
    xs AS (SELECT zone, CAST(epoch(d0) / 86400 AS INTEGER) AS day, CAST(feature AS INTEGER) AS feature, CAST(value AS DOUBLE) AS value FROM cells)"""


@query("price_design_matrix", f"WITH {DESIGN} SELECT zone, day, feature, {rnd('value')} AS value FROM xs")
def price_design_matrix(t: Tables):
    design = price_design(t.price_history, "zone", [0])
    return design.select("zone", "day", F.posexplode("x").alias("feature", "value"))


@query(
    "price_design_scaled",
    f"""WITH {DESIGN}, ok AS (SELECT zone, day FROM xs GROUP BY ALL HAVING count(value) = 103),
    ky AS (SELECT zone, CAST(epoch(date_trunc('day', ts)) / 86400 AS INTEGER) AS day FROM p GROUP BY ALL HAVING count(price) = 24),
    tr AS (SELECT * FROM xs JOIN ok USING (zone, day) JOIN ky USING (zone, day) WHERE day >= {LAST_DAY} - {DAYS_IN_WINDOW - 7} AND day < {LAST_DAY}),
    st AS (SELECT zone, feature, quantile_cont(value, 0.5::DOUBLE) AS mid, quantile_cont(value, 0.75::DOUBLE) - quantile_cont(value, 0.25::DOUBLE) AS iqr FROM tr GROUP BY ALL)
    SELECT zone, day, feature, {rnd('CASE WHEN feature >= 96 THEN value ELSE (value - mid) / CASE WHEN iqr = 0 THEN 1 ELSE iqr END END')} AS value FROM tr JOIN st USING (zone, feature)""",
)
def price_design_scaled(t: Tables):
    scaled = robust_scale(window_design(t), ["zone"])
    return scaled.select("zone", "day", F.posexplode("x").alias("feature", "value"))


@query(
    "rolling_scales",
    f"""WITH {DESIGN}, ok AS (SELECT zone, day FROM xs GROUP BY ALL HAVING count(value) = 103),
    ky AS (SELECT zone, CAST(epoch(date_trunc('day', ts)) / 86400 AS INTEGER) AS day FROM p GROUP BY ALL HAVING count(price) = 24),
    tr AS (SELECT xs.* FROM xs JOIN ok USING (zone, day) JOIN ky USING (zone, day) WHERE feature < 96),
    an AS (SELECT DISTINCT zone, day FROM xs)
    SELECT an.zone, an.day, feature, {rnd('quantile_cont(value, 0.5::DOUBLE) + 1e-10')} AS center,
      {rnd('1e-10 + CASE WHEN quantile_cont(value, 0.75::DOUBLE) = quantile_cont(value, 0.25::DOUBLE) THEN 1 ELSE quantile_cont(value, 0.75::DOUBLE) - quantile_cont(value, 0.25::DOUBLE) END')} AS range
    FROM an JOIN tr ON tr.zone = an.zone AND tr.day >= an.day - {DAYS_IN_WINDOW - 7} AND tr.day < an.day GROUP BY ALL""",
)
def scales_of_all_days(t: Tables):
    """Center and range of every price feature over the window before each day of each zone.

    Both sides add 1e-10 before rounding: quartiles of hundredths often end in a 5 that the two would round apart.
    """
    design = price_design(t.price_history, "zone", [0])
    scales = rolling_scales(design, design, DAYS_IN_WINDOW - 7)
    both = F.slice(F.arrays_zip("x_center", "x_range"), F.lit(1), F.lit(96))
    return scales.select("zone", "day", F.posexplode(both).alias("feature", "s")).select(
        "zone", "day", "feature", (F.col("s.x_center") + 1e-10).alias("center"), (F.col("s.x_range") + 1e-10).alias("range")
    )


def _last_day_models(t: Tables, rule: str):
    """Models of the last local day of every zone, from the 21 days before it."""
    dates = t.price_history.groupBy("zone").agg(F.lit("2024-01-30").cast("date").alias("forecast_date"))
    design, anchors = design_and_anchors(t.price_history, dates, TZ)
    return design, t.stored(f"last-day-{rule}", lambda: fit_hourly(design, anchors, DAYS_IN_WINDOW, rule))


def _optimal(design, models):
    """Models with whether they meet the conditions of their penalty's optimum."""
    checked = optimality(design, models, DAYS_IN_WINDOW).withColumn("sound", (F.col("excess") <= 1 + 1e-6) & (F.col("slack") <= 1e-6))
    return models.join(checked.select("zone", "phase", "day", "hour", "sound"), ["zone", "phase", "day", "hour"], "left").withColumn(
        "sound", F.coalesce("sound", F.lit(False))
    )


# Hours of every zone, and the 14 training days before the last local day, which starts at 23:00 UTC.
ZONES = f"""{PRICES}, span AS (SELECT zone, min(ts) AS a, max(ts) AS z FROM p GROUP BY zone),
    hours AS (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS hour),
    wins AS (SELECT zone, CAST(count(*) AS INTEGER) AS n_days FROM span, (SELECT TIMESTAMP '2024-01-29 23:00:00' - to_days(CAST(k AS INTEGER)) AS d0
      FROM (SELECT unnest(generate_series(1, {DAYS_IN_WINDOW - 7})) AS k)) WHERE a <= d0 - INTERVAL 7 day AND z >= d0 + INTERVAL 23 hour GROUP BY zone)"""
LAST_ANCHOR = "CAST(epoch(TIMESTAMP '2024-01-29') / 86400 AS INTEGER) AS day"


@query(
    "lasso_penalty_select",
    f"WITH {ZONES} SELECT zone, {LAST_ANCHOR}, hour, 'cv7' AS rule, n_days, 1 AS sound FROM wins, hours",
)
def lasso_penalty_select(t: Tables):
    """Rule and days behind every hour's penalty; sound: the model is the optimum at that penalty."""
    return _optimal(*_last_day_models(t, "cv7")).select("zone", "day", "hour", "rule", "n_days", "sound")


@query("lasso_penalty_select_values")
def lasso_penalty_select_values(t: Tables):
    """The chosen penalty of every hour and how many coefficients it leaves."""
    return penalty_summary(_last_day_models(t, "cv7")[1])


@query("lear_fit", f"WITH {ZONES} SELECT zone, {LAST_ANCHOR}, hour, 'cv7' AS rule, n_days, 103 AS n_coef, 1 AS sound FROM wins, hours")
def lear_fit(t: Tables):
    """The fitted models' rule, days and size; sound: the model is its penalty's optimum, with as many non-zero as stated."""
    models = _optimal(*_last_day_models(t, "auto"))
    sound = F.col("sound") & (F.size(F.filter("coef", lambda c: c != 0)) == F.col("n_nonzero"))
    return models.select("zone", "day", "hour", "rule", "n_days", F.size("coef").alias("n_coef"), sound.alias("sound"))


@query("lear_fit_values")
def lear_fit_values(t: Tables):
    """Intercept and coefficients of every zone and hour, one row each; feature -1 is the intercept."""
    every = F.concat(F.array("intercept"), "coef")
    rows = _last_day_models(t, "auto")[1].select("zone", "day", "hour", F.posexplode(every).alias("at", "value"))
    return rows.select("zone", "day", "hour", (F.col("at") - 1).alias("feature"), "value")


def _known():
    return F.coalesce(F.col("yhat") >= 0, F.lit(False)).alias("known")


@query(
    "lear_forecast",
    f"""WITH {ZONES} SELECT zone, 82800 AS phase, {LAST_ANCHOR}, hour, TIMESTAMP '2024-01-29 23:00:00' + to_hours(hour) AS ts, 1 AS known, 0 AS failed
    FROM wins, hours""",
)
def lear_forecast(t: Tables):
    design, models = _last_day_models(t, "auto")
    out = predict_hourly(design, models)
    return out.select("zone", "phase", "day", "hour", "ts", _known(), F.col("reason").isNotNull().alias("failed"))


@query("lear_forecast_values")
def lear_forecast_values(t: Tables):
    """The forecast of every zone and hour of the last day."""
    design, models = _last_day_models(t, "auto")
    return predict_hourly(design, models)


@query(
    "lear_backtest",
    f"""WITH {ZONES}, dd AS (SELECT DISTINCT zone, CAST({local()} AS DATE) AS d FROM p),
    due AS (SELECT dd.zone, d FROM dd JOIN (SELECT zone, min(d) AS first FROM dd GROUP BY zone) f ON dd.zone = f.zone WHERE d > first + {DAYS_IN_WINDOW + 1})
    SELECT zone, hour, {to_utc('(CAST(d AS TIMESTAMP))')} + to_hours(hour) AS ts, CAST(d AS TIMESTAMP) + to_hours(hour) AS ts_local, 1 AS known FROM due, hours""",
)
def lear_backtest(t: Tables):
    """A rolling back-test: every local day with three weeks of prices before it, every zone."""
    return _backtest(t).select("zone", "hour", "ts", "ts_local", _known())


@query("lear_backtest_values")
def lear_backtest_values(t: Tables):
    """The back-test's forecasts beside the prices that came true."""
    return _backtest(t).join(t.price_history.select("zone", "ts", "price"), ["zone", "ts"], "left").select("zone", "ts", "hour", "yhat", "price", "reason")


def _backtest(t: Tables):
    days = t.price_history.where(F.col("price").isNotNull()).select(
        "zone", F.to_date(F.from_utc_timestamp("ts", TZ)).alias("forecast_date")
    ).distinct()
    starts = days.groupBy("zone").agg(F.min("forecast_date").alias("first"))
    due = days.join(starts, "zone").where(F.col("forecast_date") > F.date_add("first", DAYS_IN_WINDOW + 1)).drop("first")
    return forecast_prices(t.price_history, due, TZ, DAYS_IN_WINDOW, days_per_group=2)


# Years of prices, so that the default window of 364 days has more days than features: daily order values per priority
# stand in for a market's days, an order's key for the hour; unknown hours are interpolated.
LONG_PRICES = """o AS (SELECT o_orderpriority AS zone, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts FROM orders),
    b AS (SELECT zone, min(ts) AS a, max(ts) AS z FROM o GROUP BY zone), dd AS (SELECT zone, a, z, CAST(timezone('Europe/Rome', timezone('UTC', z)) AS DATE) - k AS d FROM b, (SELECT CAST(unnest([1, 2]) AS INTEGER) AS k)),
    hh AS (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS hour)"""


def long_prices(t: Tables):
    orders = t.read("orders").select(
        F.col("o_orderpriority").alias("zone"), F.col("o_totalprice").alias("price"),
        F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.pmod("o_orderkey", F.lit(24)) * 3600).alias("ts"),
    )
    return t.stored("long-prices", lambda: fill_linear(resample_mean(orders, ["zone"], value="price", step=HOUR), ["zone"], ["price"], both=True))


@query(
    "lear_forecast_year",
    f"""WITH {LONG_PRICES} SELECT zone, hour, {to_utc('(CAST(d AS TIMESTAMP))')} + to_hours(hour) AS ts, 'aic' AS rule, 357 AS n_days, 1 AS known FROM dd, hh""",
)
def lear_forecast_year(t: Tables):
    """The last two whole local days of every zone from the default window of 364 days, where AIC chooses the penalty."""
    return _year(t).select("zone", "hour", "ts", "rule", "n_days", _known())


@query("lear_forecast_year_values")
def lear_forecast_year_values(t: Tables):
    """Forecast, penalty and number of coefficients of every hour of these days."""
    return _year(t)


def _year(t: Tables):
    prices = long_prices(t)
    last = prices.groupBy("zone").agg(F.to_date(F.from_utc_timestamp(F.max("ts"), TZ)).alias("last"))
    dates = last.select("zone", F.explode(F.sequence(F.date_sub("last", 2), F.date_sub("last", 1))).alias("forecast_date"))
    first = dates.agg(F.min("forecast_date")).first()[0]
    recent = prices.where(F.col("ts") >= F.date_sub(F.lit(first), DEFAULT_WINDOW_DAYS + 8).cast("timestamp"))
    design, anchors = design_and_anchors(recent, dates, TZ)
    models = t.stored("year-models", lambda: fit_hourly(design, anchors, days_per_group=1))
    out = predict_hourly(design, models)
    return out.join(models.select("zone", "phase", "day", "hour", "rule", "n_days", "penalty", "n_nonzero"), ["zone", "phase", "day", "hour"]).select(
        "zone", "hour", "ts", "rule", "n_days", "penalty", "n_nonzero", "yhat"
    )


# Forests -------------------------------------------------------------------------------------

TARGETS = ["click", "error", "purchase", "signup", "view"]
FEATURES = [*WEATHER_COLUMNS, *CYCLIC_FEATURES, "campus_closed", "T_open"]
LAGS = DEFAULT_LAGS
PARAMS = ForestParams(100, "sqrt", 5)
GRID_POINTS = default_grid()
TRAIN_END = "2024-01-24 00:00:00"

# Rows that can be trained on: a week after a target's first bin, when all its lags are known.
VALID = f"""{GRID}, v AS (SELECT 'S1' AS site_id, variable_id AS target, ts FROM (SELECT *, min(ts) OVER (PARTITION BY variable_id) AS a FROM g)
      WHERE ts >= a + INTERVAL {max(DEFAULT_LAGS)} hour), s AS (SELECT DISTINCT site_id, target FROM v),
    n AS (SELECT site_id, target, count(*) FILTER (ts <= TIMESTAMP '{TRAIN_END}') AS n_train, count(*) FILTER (ts > TIMESTAMP '{TRAIN_END}') AS n_test,
      min(ts) FILTER (ts <= TIMESTAMP '{TRAIN_END}') AS train_start, max(ts) FILTER (ts <= TIMESTAMP '{TRAIN_END}') AS train_end,
      min(ts) FILTER (ts > TIMESTAMP '{TRAIN_END}') AS test_start, max(ts) FILTER (ts > TIMESTAMP '{TRAIN_END}') AS test_end, max(ts) AS z FROM v GROUP BY ALL)"""
FEATURE_ROWS = ", ".join(f"('{f}')" for f in [*FEATURES, *[lag_name(h) for h in DEFAULT_LAGS]])
GRID_ROWS = ", ".join(f"({i}, {p.trees}, '{p.features}', {p.min_leaf})" for i, p in enumerate(GRID_POINTS))


def dataset(t: Tables):
    """Wide dataset of all five series; gaps of the sparse sample are filled, as features must be known."""
    return t.stored("dataset", lambda: _make_dataset(t))


def _make_dataset(t: Tables):
    long = fill_time(t.grid, ["variable_id"], ["value"]).where(F.col("variable_id").isin(*TARGETS)).select(
        F.lit("S1").alias("site_id"), F.col("variable_id").alias("target"), "ts", F.col("value").alias("y")
    )
    weather = fill_time(explode_regular_block(t.weather_blocks), ["site_id"], WEATHER_COLUMNS).select("site_id", "ts", *WEATHER_COLUMNS)
    return wide_dataset(long, TARGETS, weather, t.event_holidays, TZ)


def panel(t: Tables):
    rows, names = training_panel(dataset(t), TARGETS, FEATURES, LAGS)
    return t.stored("panel", lambda: rows), names


def _split(rows):
    return rows.withColumn("split", split_label("ts", F.lit(TRAIN_END).cast("timestamp")))


def _finite():
    """Errors are positive and in the order that any errors must have."""
    return F.coalesce((F.col("rmse") > 0) & (F.col("mae") <= F.col("rmse")) & (F.col("r2") < 1), F.lit(False)).alias("sound")


def params_of_all(t: Tables):
    return params_frame(t.spark, dict.fromkeys([("S1", x) for x in TARGETS], PARAMS))


def bounded(scored, trained):
    """Rows (site_id, target, ts) with whether yhat lies among the targets ``trained`` on, as a mean of them must."""
    span = trained.groupBy("site_id", "target").agg(F.min("y").alias("_lo"), F.max("y").alias("_hi"))
    within = F.coalesce(F.col("yhat").between(F.col("_lo") - 1e-9, F.col("_hi") + 1e-9), F.lit(False))
    return scored.join(span, ["site_id", "target"]).withColumn("within", within).drop("_lo", "_hi", "yhat", "y")


def _fit_metrics(t: Tables):
    rows, names = panel(t)
    split = _split(rows)
    trees = fit_fleet(split.where(F.col("split") == "train"), names, params_of_all(t))
    scored = predict_fleet(split.where(F.col("split") == "test"), trees, ["site_id", "target", "y"])
    return regression_metrics(scored, ["site_id", "target"])


@query("rf_fit", f"WITH {VALID} SELECT site_id, target, n_test AS n_rows, 1 AS sound FROM n")
def rf_fit(t: Tables):
    """Rows behind the held-out metrics of one forest per series."""
    return _fit_metrics(t).select("site_id", "target", "n_rows", _finite())


@query("rf_fit_values")
def rf_fit_values(t: Tables):
    """Held-out RMSE, MAE and R² of one forest of 100 trees per series."""
    return _fit_metrics(t)


def _scores(t: Tables, folds: str):
    """Fold errors of the whole grid, written once per session: the training job reads them too."""

    def tuned():
        rows, names = panel(t)
        return tune_fleet(_split(rows).where(F.col("split") == "train").drop("split"), names, GRID_POINTS, folds)

    return t.stored(f"scores-{folds}", tuned)


def _tuned(t: Tables, folds: str):
    """Every grid point of every series, with the rows each fold was tested on; sound: all fold errors are positive."""
    tested = [F.max(F.when(F.col("fold") == k, F.col("n_rows"))).alias(f"tested_{k}") for k in range(3)]
    return _scores(t, folds).groupBy("site_id", "target", "param_order", "params").agg(*tested, (F.min("mse") > 0).alias("sound")).select(
        "site_id", "target", "param_order", "params.*", "tested_0", "tested_1", "tested_2", "sound"
    )


@query(
    "rf_grid_contiguous",
    f"""WITH {VALID} SELECT site_id, target, param_order, trees, features, min_leaf,
      {', '.join(f'n_train // 3 + CASE WHEN {k} < n_train % 3 THEN 1 ELSE 0 END AS tested_{k}' for k in range(3))}, 1 AS sound
    FROM n, (VALUES {GRID_ROWS}) q(param_order, trees, features, min_leaf)""",
)
def rf_grid_contiguous(t: Tables):
    return _tuned(t, "contiguous")


@query(
    "rf_grid_expanding",
    f"""WITH {VALID} SELECT site_id, target, param_order, trees, features, min_leaf, {', '.join(f'n_train // 4 AS tested_{k}' for k in range(3))}, 1 AS sound
    FROM n, (VALUES {GRID_ROWS}) q(param_order, trees, features, min_leaf)""",
)
def rf_grid_expanding(t: Tables):
    return _tuned(t, "expanding")


def _errors(scores):
    return scores.select("site_id", "target", "param_order", "params.*", "fold", "n_rows", "mse")


@query("rf_grid_contiguous_values")
def rf_grid_contiguous_values(t: Tables):
    """Error of each of the 75 grid points in each contiguous fold of each series."""
    return _errors(_scores(t, "contiguous"))


@query("rf_grid_expanding_values")
def rf_grid_expanding_values(t: Tables):
    """Error of each of the 75 grid points in each expanding fold of each series."""
    return _errors(_scores(t, "expanding"))


@query("rf_refit", f"WITH {VALID} SELECT site_id, target, ts, 1 AS within FROM v")
def rf_refit(t: Tables):
    """Forests refitted on the last 14 days, over every valid row: forecasts lie among the targets of those days."""
    rows, names = panel(t)
    recent = trailing_window(rows, ["site_id", "target"], 14)
    return bounded(predict_fleet(rows, fit_fleet(recent, names, params_of_all(t))), recent)


def _models(t: Tables):
    """Forests of every series, saved once per session and read from their folders."""
    return load_fleet(t.spark, t.once("forests", lambda path: _save_forests(t, path)))


def _save_forests(t: Tables, path: str) -> None:
    rows, names = panel(t)
    save_fleet(fit_fleet(rows, names, params_of_all(t)), path)


@query(
    "model_registry",
    f"""WITH {VALID} SELECT site_id, target, {PARAMS.trees} AS trees, '{','.join([*FEATURES, *[lag_name(h) for h in DEFAULT_LAGS]])}' AS features,
      1 AS leaves_kept FROM s""",
)
def model_registry(t: Tables):
    """One row per saved model, its features in their order; leaves_kept: no leaf holds fewer rows than asked for."""
    kept = (F.col("smallest_leaf") >= PARAMS.min_leaf).alias("leaves_kept")
    return registry_of(_models(t)).select("site_id", "target", "trees", F.concat_ws(",", "features").alias("features"), kept)


IMPORTANCES = f"WITH {VALID} SELECT site_id, target, feature, 1 AS share, 1.0 AS total FROM s, (VALUES {FEATURE_ROWS}) q(feature)"


def _shares(ranked, *more: str):
    """Every feature of every series, its importance being a share of one."""
    whole = Window.partitionBy("site_id", "target")  # the features of one model
    return ranked.select(
        "site_id", "target", "feature", F.col("importance").between(0, 1).alias("share"), F.round(F.sum("importance").over(whole), 6).alias("total"), *more
    )


def _retrained(t: Tables):
    data = dataset(t)
    history = data.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    block = data.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    return importances_of(retrain_fleet(history, block, params_of_all(t), TARGETS, 14, FEATURES, LAGS)[1])


@query("rf_retrain", IMPORTANCES)
def rf_retrain(t: Tables):
    """Importances after appending the days from 15 January and refitting from stored parameters."""
    return _shares(_retrained(t))


@query("rf_retrain_values")
def rf_retrain_values(t: Tables):
    """Importance and rank of every feature of the refitted models."""
    return _retrained(t)


def _day_ahead(t: Tables):
    data = dataset(t)
    history = data.unpivot(["site_id", "ts"], TARGETS, "target", "y")
    weather = data.select("site_id", "ts", *WEATHER_COLUMNS)
    return forecast_fleet(history, weather, t.event_holidays, _models(t), "2024-01-30", TZ, hours=LAGS, features=FEATURES)[0]


@query(
    "day_ahead_forecast",
    f"""WITH {VALID}, h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-29 23:00:00', TIMESTAMP '2024-01-30 22:45:00', INTERVAL 15 minute)) AS ts)
    SELECT site_id, target, ts, {local()} AS ts_local, 1 AS within FROM s, h""",
)
def day_ahead_forecast(t: Tables):
    """30 January from saved forests, weather of the day, and targets up to two days before its end."""
    return bounded(_day_ahead(t), panel(t)[0])


@query("day_ahead_forecast_values")
def day_ahead_forecast_values(t: Tables):
    """The forecast of every series and quarter-hour."""
    return _day_ahead(t)


@query("importance_rank", IMPORTANCES.replace("1.0 AS total", "1.0 AS total, 1 AS ranked"))
def importance_rank(t: Tables):
    """Every feature's share; ranked: no feature behind this one has a higher share, and ranks have no gap."""
    ranked = importances_of(_models(t))
    order = Window.partitionBy("site_id", "target").orderBy("rank")  # the features of one model
    sound = (F.lag("importance", 1, 2.0).over(order) >= F.col("importance")) & (F.col("rank") == F.row_number().over(order))
    return _shares(ranked.withColumn("ranked", sound), "ranked")


@query("importance_rank_values")
def importance_rank_values(t: Tables):
    """Importance and rank of every feature of the saved models."""
    return importances_of(_models(t))


def _trained(t: Tables):
    rows, names = panel(t)
    return train_fleet(rows, names, _scores(t, "contiguous"), F.lit(TRAIN_END).cast("timestamp"), final_days=14)


PERIODS = ["train_start", "train_end", "test_start", "test_end", "n_train", "n_test", "final_train_start", "final_train_end", "final_train_samples"]


PERIODS_SQL = f"""WITH {VALID}, fin AS (SELECT site_id, target, min(ts) AS final_train_start, max(ts) AS final_train_end, count(*) AS final_train_samples
      FROM v JOIN (SELECT site_id, target, z FROM n) e USING (site_id, target) WHERE ts >= z - INTERVAL 14 day GROUP BY ALL)
    SELECT site_id, target, train_start, train_end, test_start, test_end, n_train, n_test, final_train_start, final_train_end, final_train_samples, 1 AS sound
    FROM n JOIN fin USING (site_id, target)"""


@query("train_load_models", PERIODS_SQL)
def train_models(t: Tables):
    """Periods and counts of the whole training job's typed metrics, parameters chosen from the whole grid."""
    return _trained(t).metrics.select("site_id", "target", *PERIODS, _finite())


def _written_metrics(t: Tables):
    path = t.once("metrics", lambda path: write_metrics(_trained(t).metrics, path))
    return t.spark.read.schema(METRICS_SCHEMA).parquet(path)


@query("metrics_sink", PERIODS_SQL)
def metrics_sink(t: Tables):
    """The training job's metrics, written and read back by their schema."""
    return _written_metrics(t).select("site_id", "target", *PERIODS, _finite())


@query("train_load_models_values")
def train_models_values(t: Tables):
    """The typed metrics: chosen parameters, held-out errors, periods and counts."""
    return _written_metrics(t).select("site_id", "target", "params.*", "rmse", "mae", "r2", *PERIODS)
