"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.clean import dedup_mean, null_profile
from ...operators.grid import resample_mean
from ...operators.history import available_dates, latest_common
from ...operators.lags import lag_time
from ...operators.meters import net_mean_of_sums, net_sum_of_means, pv_sum
from ...operators.pricing import day_blocks, known, price_design, robust_stats, training_days
from ...operators.splits import period_stats, regression_metrics, split_label
from .base import GRID, HOURLY, READINGS, TZ, Tables, local, query, rnd
from .rows import WIDE, WIDE_COLS, wide


@query("resample_15m_mean", f"WITH {GRID} SELECT variable_id, ts, {rnd('value')} AS value FROM g")
def resample_15m_mean(t: Tables):
    return resample_mean(t.readings, ["variable_id"])


@query(
    "net_sum_of_means",
    f"""WITH {READINGS}, m AS (SELECT variable_id, meter, time_bucket(INTERVAL 15 minute, ts) AS ts, avg(value) AS value FROM r GROUP BY ALL)
    SELECT variable_id, ts, {rnd('sum(value)')} AS net FROM m GROUP BY variable_id, ts""",
)
def net_sum_of_means_query(t: Tables):
    return net_sum_of_means(t.readings, ["variable_id"], "meter")


@query(
    "net_mean_of_sums",
    f"""WITH {READINGS}, h AS (SELECT variable_id, meter, date_trunc('minute', ts) AS ts, value FROM r),
    m AS (SELECT variable_id, meter, ts, avg(value) AS value FROM h GROUP BY ALL),
    s AS (SELECT variable_id, ts, sum(value) AS value FROM m GROUP BY ALL)
    SELECT variable_id, time_bucket(INTERVAL 15 minute, ts) AS ts, {rnd('avg(value)')} AS net FROM s GROUP BY ALL""",
)
def net_mean_of_sums_query(t: Tables):
    """Readings stamped by the minute, so meters share stamps."""
    minutes = t.readings.withColumn("ts", F.date_trunc("minute", "ts"))
    return net_mean_of_sums(minutes, ["variable_id"], "meter")


@query(
    "pv_cabin_sum",
    f"""WITH {GRID}, p AS (SELECT CASE WHEN variable_id IN ('view', 'click') THEN 'C1' ELSE 'C2' END AS cabin, ts, value FROM g)
    SELECT cabin, ts, {rnd('sum(value)')} AS pv FROM p GROUP BY cabin, ts""",
)
def pv_cabin_sum(t: Tables):
    cabin = F.when(F.col("variable_id").isin("view", "click"), "C1").otherwise("C2")
    return pv_sum(t.grid.withColumn("cabin", cabin), ["cabin", "ts"])


@query(
    "dedup_mean",
    f"""WITH {READINGS} SELECT variable_id, date_trunc('hour', ts) AS ts, {rnd('avg(value)')} AS value FROM r GROUP BY ALL""",
)
def dedup_mean_query(t: Tables):
    return dedup_mean(t.readings.withColumn("ts", F.date_trunc("hour", "ts")), ["variable_id", "ts"])


@query(
    "null_profile",
    f"""WITH {GRID}, {WIDE} {' UNION ALL '.join(f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM wide" for c in WIDE_COLS)}""",
)
def null_profile_query(t: Tables):
    return null_profile(wide(t), WIDE_COLS)


@query(
    "split_period_stats",
    f"""WITH {GRID}, s AS (SELECT variable_id AS target, ts, CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS split FROM g WHERE value IS NOT NULL)
    SELECT target, split, min(ts) AS period_start, max(ts) AS period_end, count(*) AS n_samples FROM s GROUP BY target, split""",
)
def split_period_stats(t: Tables):
    rows = t.grid.where(F.col("value").isNotNull()).withColumnRenamed("variable_id", "target")
    return period_stats(rows.withColumn("split", split_label("ts", F.lit("2024-01-20 00:00:00").cast("timestamp"))), ["target", "split"])


@query(
    "regression_metrics",
    f"""WITH {GRID}, e AS (SELECT g.variable_id AS target, g.value AS y, l.value AS yhat FROM g JOIN g l ON l.variable_id = g.variable_id AND l.ts = g.ts - INTERVAL 24 hour
      WHERE g.value IS NOT NULL AND l.value IS NOT NULL)
    SELECT target, {rnd('sqrt(avg((y - yhat) ** 2))')} AS rmse, {rnd('avg(abs(y - yhat))')} AS mae,
      {rnd('1 - sum((y - yhat) ** 2) / (var_pop(y) * count(*))')} AS r2, count(*) AS n_rows FROM e GROUP BY target""",
)
def regression_metrics_query(t: Tables):
    """The value one day before, judged as a forecast."""
    lagged = lag_time(t.grid.withColumnsRenamed({"value": "y", "variable_id": "target"}), ["target"], "y", [24])
    return regression_metrics(lagged, ["target"], "y", "lag_24h")


@query(
    "available_market_dates",
    f"WITH {READINGS} SELECT DISTINCT variable_id AS zone, strftime({local()}, '%Y-%m-%d') AS day FROM r",
)
def available_market_dates(t: Tables):
    return available_dates(t.readings.withColumnRenamed("variable_id", "zone"), TZ)


@query(
    "latest_common_date",
    f"""WITH {READINGS}, d AS (SELECT DISTINCT variable_id AS zone, CAST({local()} AS DATE) AS day FROM r WHERE NOT (variable_id = 'view' AND {local()} >= TIMESTAMP '2024-01-28'))
    SELECT strftime(max(day), '%Y-%m-%d') AS latest_common FROM (SELECT day FROM d WHERE zone = 'view' INTERSECT SELECT day FROM d WHERE zone = 'click')""",
)
def latest_common_date(t: Tables):
    return latest_common(two_zone_dates(t), ["view", "click"])


def two_zone_dates(t: Tables):
    """Dates of every zone, where zone 'view' stops before 28 January."""
    kept = t.readings.where(
        ~((F.col("variable_id") == "view") & (F.from_utc_timestamp("ts", TZ) >= F.lit("2024-01-28 00:00:00").cast("timestamp")))
    )
    return available_dates(kept.withColumnRenamed("variable_id", "zone"), TZ)


DAYS_IN_WINDOW = 21
LAST_DAY = 19752  # 2024-01-30 in days since 1970


def window_design(t: Tables):
    """Design of the calibration window that ends before 30 January, complete days only."""
    design = price_design(t.price_history, "zone", [0])
    return training_days(design.where(known("x") & known("y")), F.lit(LAST_DAY), DAYS_IN_WINDOW)


@query(
    "robust_scale_stats",
    f"""WITH {HOURLY}, v AS (SELECT zone, CAST(hour(ts) AS INTEGER) AS feature, price FROM h)
    SELECT zone, feature, {rnd('quantile_cont(price, 0.5::DOUBLE)')} AS center,
      {rnd('quantile_cont(price, 0.75::DOUBLE) - quantile_cont(price, 0.25::DOUBLE)')} AS iqr FROM v GROUP BY ALL""",
)
def robust_scale_stats(t: Tables):
    """One feature per hour of the day: a value per zone and day each."""
    return robust_stats(day_blocks(t.hourly), ["zone"], "price", skip_last=0)
