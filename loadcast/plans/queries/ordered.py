"""Window and ordered-series functions, sorts and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.timecols import HOUR
from ...operators.clean import dedup_first, dedup_last
from ...operators.forest import PARAMS_SCHEMA, best_params
from ...operators.grid import day_starts, resample_mean
from ...operators.interpolate import fill_linear, fill_time
from ...operators.lags import DEFAULT_LAGS, lag_onto_horizon, lag_rows, lag_time
from ...operators.meters import counter_to_power
from ...operators.splits import fold_contiguous, fold_expanding, last_rows
from ...sources.readings import series_or_null_grid
from .base import COUNTERS, GRID, HOURLY, READINGS, Tables, bins, fill, grid, query, rnd

POWER = f"""{READINGS}, {COUNTERS}, d AS (SELECT variable_id, ts, value, value - lag(value) OVER w AS de,
      (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3.6e9 AS dh FROM c WINDOW w AS (PARTITION BY variable_id ORDER BY ts)),
    kw AS (SELECT variable_id, ts, CASE WHEN de >= 0 AND dh > 0 THEN de / dh END AS power FROM d)"""


@query("counter_to_power", f"WITH {POWER} SELECT variable_id, ts, round(power, 3) + 0.0 AS power FROM kw")
def counter_to_power_query(t: Tables):
    power = counter_to_power(t.counters.select("variable_id", "ts", "value"), ["variable_id"])
    return power.select("variable_id", "ts", F.round("power", 3).alias("power"))


@query(
    "lag_rows",
    f"""WITH {GRID}, k AS (SELECT variable_id, ts, value AS y FROM g WHERE value IS NOT NULL)
    SELECT variable_id, ts, {rnd('y')} AS y, {', '.join(f"{rnd(f'lag(y, {4 * h}) OVER w')} AS lag_{h}h" for h in (48, 72))} FROM k
    WINDOW w AS (PARTITION BY variable_id ORDER BY ts)""",
)
def lag_rows_query(t: Tables):
    known = t.grid.where(F.col("value").isNotNull()).withColumnRenamed("value", "y")
    return lag_rows(known, ["variable_id"], "y", [48, 72])


@query(
    "lag_time_range",
    f"""WITH {GRID} SELECT g.variable_id, g.ts, {rnd('g.value')} AS y, {', '.join(f'{rnd(f"l{h}.value")} AS lag_{h}h' for h in DEFAULT_LAGS)} FROM g
    {' '.join(f'LEFT JOIN g l{h} ON l{h}.variable_id = g.variable_id AND l{h}.ts = g.ts - INTERVAL {h} hour' for h in DEFAULT_LAGS)}""",
)
def lag_time_range(t: Tables):
    return lag_time(t.grid.withColumnRenamed("value", "y"), ["variable_id"])


@query(
    "lag_onto_horizon",
    f"""WITH {GRID}, z AS (SELECT max(ts) AS m FROM g), s AS (SELECT DISTINCT variable_id FROM g),
    hz AS (SELECT variable_id, unnest(generate_series(m + INTERVAL 15 minute, m + INTERVAL 1 day, INTERVAL 15 minute)) AS ts FROM s, z)
    SELECT hz.variable_id, hz.ts, {', '.join(f'{rnd(f"l{h}.value")} AS lag_{h}h' for h in DEFAULT_LAGS)} FROM hz
    {' '.join(f'LEFT JOIN g l{h} ON l{h}.variable_id = hz.variable_id AND l{h}.ts = hz.ts - INTERVAL {h} hour' for h in DEFAULT_LAGS)}""",
)
def lag_onto_horizon_query(t: Tables):
    """The day after the last reading, for every meter."""
    hist = t.grid.withColumnRenamed("value", "y")
    last = hist.agg(F.unix_seconds(F.max("ts"))).first()[0]
    # 96 stamps for each distinct meter.
    ahead = F.transform(F.sequence(F.lit(1), F.lit(96)), lambda i: F.timestamp_seconds(F.lit(last) + i * 900))
    horizon = hist.select("variable_id").distinct().select("variable_id", F.explode(ahead).alias("ts"))
    return lag_onto_horizon(hist, horizon, ["variable_id"])


@query("interp_limit2", f"WITH {GRID}, f AS ({fill('g', limit=2)}) SELECT variable_id, ts, {rnd('value')} AS value FROM f")
def interp_limit2(t: Tables):
    return fill_linear(t.grid, ["variable_id"], ["value"], limit=2)


SITE_GRID = f"""{READINGS}, b AS ({bins('r')}), sp AS (SELECT min(ts) AS a, max(ts) AS z FROM b),
    g AS (SELECT s.variable_id, s.ts, b.value FROM (SELECT variable_id, unnest(generate_series(a, z, INTERVAL 15 minute)) AS ts
      FROM (SELECT DISTINCT variable_id FROM b), sp) s LEFT JOIN b USING (variable_id, ts))"""


def site_grid(t: Tables):
    """Every meter on the grid of the whole site, so that gaps reach the edges."""
    first, last = t.readings.agg(F.min("ts"), F.max("ts")).first()
    return series_or_null_grid(t.readings.select("variable_id", "ts", "value"), t.bins, F.lit(first), F.lit(last))


@query("interp_time_both", f"WITH {SITE_GRID}, f AS ({fill('g', both=True)}) SELECT variable_id, ts, {rnd('value')} AS value FROM f")
def interp_time_both(t: Tables):
    return fill_time(site_grid(t), ["variable_id"], ["value"])


@query(
    "interp_linear_both",
    f"""WITH {GRID}, x AS (SELECT a.variable_id, a.ts, a.value AS v1, l.value AS v2 FROM g a LEFT JOIN g l ON l.variable_id = a.variable_id AND l.ts = a.ts - INTERVAL 48 hour),
    f1 AS ({fill('x', value='v1', both=True)}), f2 AS ({fill('x', value='v2', both=True)})
    SELECT variable_id, ts, {rnd('v1')} AS y, {rnd('v2')} AS lag_48h FROM f1 JOIN f2 USING (variable_id, ts)""",
)
def interp_linear_both(t: Tables):
    """Two feature columns repaired in one pass; the lag starts with a gap of two days."""
    matrix = lag_time(t.grid.withColumnRenamed("value", "y"), ["variable_id"], "y", [48])
    return fill_linear(matrix, ["variable_id"], ["y", "lag_48h"], both=True)


@query(
    "dedup_first",
    f"""WITH {READINGS}, k AS (SELECT variable_id, date_trunc('hour', ts) AS ts, value, event_id FROM r)
    SELECT variable_id, ts, {rnd('value')} AS value, event_id FROM k QUALIFY row_number() OVER (PARTITION BY variable_id, ts ORDER BY event_id) = 1""",
)
def dedup_first_query(t: Tables):
    return dedup_first(_hour_stamps(t), ["variable_id", "ts"], ["event_id"])


def _hour_stamps(t: Tables):
    return t.readings.select("variable_id", F.date_trunc("hour", "ts").alias("ts"), "value", "event_id")


@query(
    "dedup_last",
    f"""WITH {READINGS}, k AS (SELECT variable_id, date_trunc('hour', ts) AS ts, value, event_id FROM r)
    SELECT variable_id, ts, {rnd('value')} AS value, event_id FROM k QUALIFY row_number() OVER (PARTITION BY variable_id, ts ORDER BY event_id DESC) = 1""",
)
def dedup_last_query(t: Tables):
    return dedup_last(_hour_stamps(t), ["variable_id", "ts"], ["event_id"])


@query(
    "tail_n_rows",
    f"""WITH {READINGS}, b AS ({bins('r')}) SELECT variable_id, ts, {rnd('value')} AS value FROM b
    QUALIFY row_number() OVER (PARTITION BY variable_id ORDER BY ts DESC) <= 504""",
)
def tail_n_rows(t: Tables):
    return last_rows(t.bins, ["variable_id"], 504)


@query(
    "fold_contiguous",
    f"""WITH {READINGS}, b AS ({bins('r')}) SELECT variable_id, ts, CAST(ntile(3) OVER (PARTITION BY variable_id ORDER BY ts) - 1 AS INTEGER) AS fold FROM b""",
)
def fold_contiguous_query(t: Tables):
    return fold_contiguous(t.bins.select("variable_id", "ts"), ["variable_id"], 3)


@query(
    "fold_expanding",
    f"""WITH {READINGS}, b AS ({bins('r')}), n AS (SELECT variable_id, ts, row_number() OVER (PARTITION BY variable_id ORDER BY ts) - 1 AS p,
      count(*) OVER (PARTITION BY variable_id) AS n FROM b)
    SELECT variable_id, ts, CAST(CASE WHEN p >= n - (n // 4) THEN 2 WHEN p >= n - 2 * (n // 4) THEN 1 WHEN p >= n - 3 * (n // 4) THEN 0 ELSE -1 END AS INTEGER) AS fold FROM n""",
)
def fold_expanding_query(t: Tables):
    return fold_expanding(t.bins.select("variable_id", "ts"), ["variable_id"], 3)


@query("order_by_time", f"WITH {READINGS} SELECT variable_id, ts, {rnd('value')} AS value FROM r ORDER BY ts, variable_id")
def order_by_time(t: Tables):
    # The event id splits equal stamps, so copies of one stamp need not share a task.
    return t.readings.orderBy("ts", "variable_id", "event_id").select("variable_id", "ts", "value")


@query("preview_head", f"WITH {READINGS}, b AS ({bins('r')}) SELECT variable_id, ts, {rnd('value')} AS value FROM b ORDER BY ts, variable_id LIMIT 5")
def preview_head(t: Tables):
    return t.bins.orderBy("ts", "variable_id").limit(5)


@query(
    "best_params_argmin",
    """WITH s AS (SELECT event_type AS target, CAST(value AS INTEGER) AS trees, avg((value - 30) ** 2) AS mse FROM events GROUP BY 1, 2)
    SELECT target, arg_min(trees, mse * 1000000 + trees) AS trees, round(min(mse), 8) + 0.0 AS mse FROM s GROUP BY target""",
)
def best_params_argmin(t: Tables):
    """Mean squared distance from 30 per whole value stands in for fold errors."""
    trees = F.rint("value").cast("int")
    scores = t.events.groupBy(F.col("event_type").alias("target"), trees.alias("trees")).agg(
        F.avg(F.pow(F.col("value") - 30, 2)).alias("mse")
    )
    params = F.struct(F.col("trees"), F.lit("all").alias("features"), F.lit(2).alias("min_leaf")).cast(PARAMS_SCHEMA)
    best = best_params(scores.select("target", params.alias("params"), F.col("trees").alias("param_order"), "mse"), ["target"])
    return best.select("target", "params.trees", "mse")


@query(
    "day_stride",
    f"""WITH {HOURLY}, hg AS ({grid('h', 'zone', 'price', HOUR)}) SELECT zone, ts, {rnd('price')} AS price FROM hg WHERE hour(ts) = 23""",
)
def day_stride(t: Tables):
    """Day starts of a market whose local midnight is 23:00 UTC."""
    hourly = resample_mean(t.hourly, ["zone"], value="price", step=HOUR)
    return day_starts(hourly, ["zone"], F.lit("2024-01-30 23:00:00").cast("timestamp"))
