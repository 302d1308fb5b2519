"""Joins and alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.calendar import mark_holidays
from ...operators.grid import to_grid
from ...operators.history import params_for, scorable
from ...operators.lags import lag_time_join
from ...operators.meters import align, join_weather, pair_meters, prefer_main
from ...sources.weather import WEATHER_COLUMNS, explode_regular_block
from .base import GRID, READINGS, WEATHER_GRID, Tables, bins, computus, query, rnd
from .rows import KINDS


@query(
    "align_full_outer",
    f"""WITH {READINGS}, b AS ({bins('r')}) SELECT ts, {', '.join(f"{rnd(f'max(CASE WHEN variable_id = {chr(39)}{k}{chr(39)} THEN value END)')} AS {k}" for k in KINDS)}
    FROM b GROUP BY ts""",
)
def align_full_outer(t: Tables):
    return align(t.bins, [], "variable_id", KINDS)


@query(
    "load_weather_join",
    f"""WITH {GRID}, {WEATHER_GRID}, y AS (SELECT 'S1' AS site_id, variable_id AS target, ts, value AS y FROM b)
    SELECT site_id, target, ts, {rnd('y')} AS y, {', '.join(f'{rnd(c)} AS {c}' for c in WEATHER_COLUMNS)} FROM y FULL JOIN wg USING (site_id, ts)""",
)
def load_weather_join(t: Tables):
    targets = t.bins.select(F.lit("S1").alias("site_id"), F.col("variable_id").alias("target"), "ts", F.col("value").alias("y"))
    return join_weather(targets, explode_regular_block(t.weather_blocks))


@query(
    "primary_backup_coalesce",
    f"""WITH {READINGS}, b AS ({bins('r')}), pairs AS (SELECT * FROM (VALUES ('C1', 'view', 'click'), ('C2', 'purchase', 'signup'), ('C3', 'error', NULL)) p(cabin, main, backup)),
    m AS (SELECT cabin, ts, value FROM b JOIN pairs ON variable_id = main), k AS (SELECT cabin, ts, value FROM b JOIN pairs ON variable_id = backup)
    SELECT cabin, ts, {rnd('coalesce(m.value, k.value)')} AS value FROM m FULL JOIN k USING (cabin, ts)""",
)
def primary_backup_coalesce(t: Tables):
    """Three cabins; the last has no backup meter."""
    kind = F.col("variable_id")
    cabin = F.when(kind.isin("view", "click"), "C1").when(kind.isin("purchase", "signup"), "C2").when(kind == "error", "C3")
    role = F.when(kind.isin("view", "purchase", "error"), "pv_main").otherwise("pv_backup")
    return prefer_main(t.bins.withColumn("cabin", cabin).withColumn("role", role), ["cabin", "ts"])


@query(
    "meter_pairing",
    """WITH m AS (SELECT DISTINCT event_type, user_id, user_id // 10 AS cabin FROM events),
    p AS (SELECT event_type, cabin, user_id, row_number() OVER (PARTITION BY event_type, cabin ORDER BY user_id) - 1 AS position FROM m)
    SELECT 'S1' AS site_id, CAST(coalesce(a.cabin, k.cabin) AS VARCHAR) AS cabin, CAST(coalesce(a.position, k.position) AS INTEGER) AS position,
      'view-' || a.user_id AS main_id, 'click-' || k.user_id AS backup_id
    FROM (SELECT * FROM p WHERE event_type = 'view') a FULL JOIN (SELECT * FROM p WHERE event_type = 'click') k
      ON a.cabin = k.cabin AND a.position = k.position""",
)
def meter_pairing(t: Tables):
    """Meters seen in the readings: ten users make a cabin, listed by user."""
    seen = t.readings.where(F.col("variable_id").isin("view", "click")).select("variable_id", "meter").distinct()
    # Ten meters per list.
    lists = seen.groupBy("variable_id", F.floor(F.col("meter") / 10).cast("string").alias("cabin")).agg(
        F.sort_array(F.collect_list("meter")).alias("meters")
    )
    role = F.when(F.col("variable_id") == "view", "pv_main").otherwise("pv_backup")
    meter_map = lists.select(
        F.lit("S1").alias("site_id"), "cabin", role.alias("role"), F.posexplode("meters").alias("position", "meter"), "variable_id"
    ).withColumn("variable_id", F.concat_ws("-", "variable_id", "meter"))
    return pair_meters(meter_map)


@query("grid_reindex", f"WITH {GRID} SELECT variable_id, ts, {rnd('value')} AS value FROM g")
def grid_reindex(t: Tables):
    return to_grid(t.bins, ["variable_id"])


@query(
    "lag_time_selfjoin",
    f"""WITH {READINGS}, b AS ({bins('r')}) SELECT b.variable_id, b.ts, {rnd('b.value')} AS y, {rnd('l.value')} AS lag_48h
    FROM b LEFT JOIN b l ON l.variable_id = b.variable_id AND l.ts = b.ts - INTERVAL 48 hour""",
)
def lag_time_selfjoin(t: Tables):
    return lag_time_join(t.bins.withColumnRenamed("value", "y"), ["variable_id"], 48)


PARAMS = [("click", 200, "sqrt", 5), ("error", 100, "log2", 2), ("purchase", 300, "all", 10), ("signup", 100, "all", 2), ("view", 500, "sqrt", 20)]


@query(
    "params_lookup",
    f"""WITH p AS (SELECT * FROM (VALUES {', '.join(str(p) for p in PARAMS)}) v(target, trees, features, min_leaf)),
    n AS (SELECT event_type AS target, count(*) AS n_rows FROM events GROUP BY 1)
    SELECT target, n_rows, trees, features, min_leaf FROM n JOIN p USING (target)""",
)
def params_lookup(t: Tables):
    targets = t.events.groupBy(F.col("event_type").alias("target")).agg(F.count(F.lit(1)).alias("n_rows"))
    params = t.spark.createDataFrame(
        [(a, (b, c, d)) for a, b, c, d in PARAMS], "target string, params struct<trees int, features string, min_leaf int>"
    )
    return params_for(targets, params).select("target", "n_rows", "params.*")


MODELS = "m AS (SELECT DISTINCT o_orderpriority AS target FROM orders UNION SELECT DISTINCT event_type FROM events WHERE event_type <> 'view')"


def _models(t: Tables):
    """Models named after event types and order priorities; only the former have readings."""
    kinds = t.events.where(F.col("event_type") != "view").select(F.col("event_type").alias("target"))
    return t.read("orders").select(F.col("o_orderpriority").alias("target")).unionByName(kinds).distinct()


def _history(t: Tables):
    return t.bins.select(F.col("variable_id").alias("target"))


@query("models_semi_history", f"WITH {MODELS} SELECT target FROM m WHERE target IN (SELECT event_type FROM events)")
def models_semi_history(t: Tables):
    return scorable(_history(t), _models(t))[0]


@query("models_anti_history", f"WITH {MODELS} SELECT target FROM m WHERE target NOT IN (SELECT event_type FROM events)")
def models_anti_history(t: Tables):
    return scorable(_history(t), _models(t))[1]


@query(
    "holiday_join",
    f"""WITH {computus()} SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS n_lines,
      max(CASE WHEN CAST(l_shipdate AS DATE) IN (SELECT day FROM hol) THEN 1 ELSE 0 END) AS is_holiday
    FROM lineitem GROUP BY 1""",
)
def holiday_join(t: Tables):
    """Every line marked, then counted by day."""
    lines = t.read("lineitem").select(F.col("l_shipdate").cast("timestamp").alias("ts_local"))
    marked = mark_holidays(lines, t.holidays(1990, 2030))
    return marked.groupBy(F.to_date("ts_local").alias("day")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.max(F.col("is_holiday").cast("int")).alias("is_holiday")
    )
