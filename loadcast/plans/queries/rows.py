"""Projections, filters, predicates and row arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.calendar import add_calendar_ints
from ...functions.scalars import clip, row_sum, to_num, zero_in_months
from ...operators.clean import (
    conform, discover_targets, exclude_window_table, exclude_windows, feature_projection, history_coverage, incomplete_counts,
    valid_rows,
)
from ...operators.grid import between_ts, day_horizon, local_day
from ...operators.history import zone_prices
from ...operators.lags import lag_time
from ...operators.meters import align, gross, residual, totals
from ...operators.splits import split_label, trailing_window
from .base import GRID, READINGS, TZ, Tables, local, query, rnd, to_utc

KINDS = ["view", "click", "purchase", "error", "signup"]
WIDE = (
    "wide AS (SELECT ts, "
    + ", ".join(f"max(CASE WHEN variable_id = '{k}' THEN value END) AS gross_el_cons_{k}" for k in KINDS)
    + " FROM g GROUP BY ts)"
)


def wide(t: Tables):
    named = t.grid.withColumn("variable_id", F.concat(F.lit("gross_el_cons_"), "variable_id"))
    return align(named, [], "variable_id", [f"gross_el_cons_{k}" for k in KINDS])


WIDE_COLS = [f"gross_el_cons_{k}" for k in KINDS]


@query(
    "time_window_filter",
    f"""SELECT event_id, ts, {rnd('value')} AS value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12 12:00:00'""",
)
def time_window_filter(t: Tables):
    a, b = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 00:00:00", "2024-01-12 12:00:00"))
    return between_ts(t.events.select("event_id", "ts", "value"), a, b)


@query(
    "local_day_slice",
    f"WITH {GRID} SELECT variable_id, ts, {rnd('value')} AS value FROM g WHERE CAST({local()} AS DATE) = DATE '2024-01-15'",
)
def local_day_slice(t: Tables):
    return local_day(t.grid, "2024-01-15", TZ)


@query(
    "bad_window_exclude",
    f"""WITH {GRID} SELECT variable_id, ts, {rnd('value')} AS value FROM g WHERE ts >= TIMESTAMP '2024-01-03'
      AND NOT (ts >= TIMESTAMP '2024-01-08' AND ts <= TIMESTAMP '2024-01-09 12:00:00')
      AND NOT (ts >= TIMESTAMP '2024-01-29')""",
)
def bad_window_exclude(t: Tables):
    return exclude_windows(
        t.grid, "2024-01-03 00:00:00",
        [("2024-01-08 00:00:00", "2024-01-09 12:00:00"), ("2024-01-29 00:00:00", None), (None, None)],
    )


# Every third event opens a window of up to 99 seconds on its meter; two meters are bad up to a day, one from a day on.
BAD_WINDOWS = """w AS (SELECT variable_id, ts AS a, ts + to_seconds(CAST(event_id % 100 AS INTEGER)) AS z FROM r WHERE event_id % 3 = 0
      UNION ALL SELECT * FROM (VALUES ('view', NULL, TIMESTAMP '2024-01-04 06:00:00'), ('click', NULL, TIMESTAMP '2024-01-02'),
        ('view', TIMESTAMP '2024-01-28', NULL), ('error', NULL, NULL)) v(variable_id, a, z))"""


@query(
    "bad_window_table",
    f"""WITH {READINGS}, {BAD_WINDOWS} SELECT variable_id, event_id, ts FROM r WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.variable_id = r.variable_id
      AND (a IS NOT NULL OR z IS NOT NULL) AND r.ts >= coalesce(a, TIMESTAMP '1900-01-01') AND r.ts <= coalesce(z, TIMESTAMP '2900-01-01'))""",
)
def bad_window_table(t: Tables):
    """Raw readings outside thousands of bad windows, overlapping and open ones among them."""
    third = t.readings.where(F.col("event_id") % 3 == 0)
    until = F.timestamp_micros(F.unix_micros("ts") + F.col("event_id") % 100 * 1_000_000)
    rows = [("view", None, "2024-01-04 06:00:00"), ("click", None, "2024-01-02 00:00:00"), ("view", "2024-01-28 00:00:00", None), ("error", None, None)]
    listed = t.spark.createDataFrame(rows, "variable_id string, a string, z string").select(
        "variable_id", F.col("a").cast("timestamp").alias("start_ts"), F.col("z").cast("timestamp").alias("end_ts")
    )
    windows = third.select("variable_id", F.col("ts").alias("start_ts"), until.alias("end_ts")).unionByName(listed)
    return exclude_window_table(t.readings.select("variable_id", "event_id", "ts"), windows, ["variable_id"])


@query(
    "drop_incomplete_rows",
    f"""WITH {GRID}, {WIDE}, k AS (SELECT CAST(ts AS DATE) AS d, {' AND '.join(f'{c} IS NOT NULL' for c in WIDE_COLS)} AS ok FROM wide)
    SELECT strftime(d, '%Y-%m-%d') AS day, count(*) AS rows_before, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS rows_after FROM k GROUP BY d""",
)
def drop_incomplete_rows(t: Tables):
    return incomplete_counts(wide(t).withColumn("day", F.to_date("ts")), ["day"], WIDE_COLS)


LAGGED = f"""{GRID}, x AS (SELECT g.variable_id AS target, g.ts, g.value AS y, a.value AS lag_48h, c.value AS lag_168h FROM g
      LEFT JOIN g a ON a.variable_id = g.variable_id AND a.ts = g.ts - INTERVAL 48 hour
      LEFT JOIN g c ON c.variable_id = g.variable_id AND c.ts = g.ts - INTERVAL 168 hour)"""


def lagged(t: Tables):
    return lag_time(t.grid.withColumnsRenamed({"value": "y", "variable_id": "target"}), ["target"], "y", [48, 168])


@query(
    "valid_mask",
    f"""WITH {LAGGED} SELECT target, ts, {rnd('y')} AS y, {rnd('lag_48h')} AS lag_48h, {rnd('lag_168h')} AS lag_168h FROM x
    WHERE y IS NOT NULL AND lag_48h IS NOT NULL AND lag_168h IS NOT NULL""",
)
def valid_mask(t: Tables):
    return valid_rows(lagged(t), ["lag_48h", "lag_168h"], "y")


@query(
    "valid_mask_nonzero",
    f"""WITH {LAGGED}, q AS (SELECT target, ts, floor(y / 10) AS y, lag_48h FROM x)
    SELECT target, ts, {rnd('y')} AS y, {rnd('lag_48h')} AS lag_48h FROM q WHERE lag_48h IS NOT NULL AND y IS NOT NULL AND y <> 0""",
)
def valid_mask_nonzero(t: Tables):
    tens = lagged(t).drop("lag_168h").withColumn("y", F.floor(F.col("y") / 10).cast("double"))
    return valid_rows(tens, ["lag_48h"], "y", nonzero=True)


@query(
    "train_test_split_time",
    f"""WITH {GRID} SELECT variable_id, ts, {rnd('value')} AS value,
      CASE WHEN ts <= TIMESTAMP '2024-01-20 12:00:00' THEN 'train' WHEN ts >= TIMESTAMP '2024-01-20 12:15:00' THEN 'test' END AS split FROM g""",
)
def train_test_split_time(t: Tables):
    return t.grid.withColumn("split", split_label("ts", F.lit("2024-01-20 12:00:00").cast("timestamp")))


@query(
    "trailing_window",
    f"""WITH {GRID}, e AS (SELECT variable_id, max(ts) AS z FROM g GROUP BY 1)
    SELECT variable_id, ts, {rnd('value')} AS value FROM g JOIN e USING (variable_id) WHERE ts >= z - INTERVAL 7 day""",
)
def trailing_window_query(t: Tables):
    return trailing_window(t.grid, ["variable_id"], 7)


@query(
    "target_discovery",
    f"""WITH {GRID}, {WIDE} SELECT target, count(y) AS n_known, {rnd('avg(y)')} AS mean_y FROM
      (UNPIVOT (SELECT {', '.join(WIDE_COLS)} FROM wide) ON {', '.join(WIDE_COLS)} INTO NAME target VALUE y) GROUP BY target""",
)
def target_discovery(t: Tables):
    table = wide(t)
    found = discover_targets(table.columns, "gross_el_cons_", ["CONS_TOT_kW"])
    return table.unpivot(["ts"], found, "target", "y").groupBy("target").agg(
        F.count("y").alias("n_known"), F.avg("y").alias("mean_y")
    )


@query(
    "feature_projection",
    f"""WITH {GRID}, {WIDE} SELECT ts, {rnd('2 * gross_el_cons_view')} AS feature FROM wide""",
)
def feature_projection_query(t: Tables):
    table = add_calendar_ints(wide(t).withColumn("feature", F.col("gross_el_cons_view") * 2), TZ)
    return feature_projection(table, WIDE_COLS)


@query(
    "clip_null_safe",
    f"""WITH {GRID} SELECT variable_id, ts, {rnd('CASE WHEN value < 5 THEN 5 WHEN value > 40 THEN 40 ELSE value END')} AS value FROM g""",
)
def clip_null_safe(t: Tables):
    return t.grid.withColumn("value", clip("value", 5.0, 40.0))


@query(
    "summer_zero",
    f"""SELECT o_orderkey, {rnd("CASE WHEN month(" + local('o_orderdate') + ") IN (5, 6, 7, 8, 9) THEN 0 ELSE CASE WHEN o_totalprice > 130000 THEN 130000 ELSE o_totalprice END END")} AS load FROM orders""",
)
def summer_zero(t: Tables):
    o = t.read("orders")
    capped = clip("o_totalprice", 0.0, 130000.0)
    return o.select(
        "o_orderkey", zero_in_months(capped, F.col("o_orderdate").cast("timestamp"), (5, 6, 7, 8, 9), TZ).alias("load")
    )


@query(
    "summer_zero_forecast",
    f"""WITH d AS (SELECT DISTINCT date_trunc('day', o_orderdate) AS run_date FROM orders WHERE month(o_orderdate) IN (5, 6, 7, 8, 9))
    SELECT strftime(run_date, '%Y-%m-%d') AS run_date, unnest(generate_series({to_utc('run_date')},
      {to_utc('run_date + INTERVAL 1 day')} - INTERVAL 15 minute, INTERVAL 15 minute)) AS ts, 0.0::DOUBLE AS yhat FROM d""",
)
def summer_zero_forecast(t: Tables):
    """All-zero forecasts for every order day in the zero months."""
    day = F.to_date("o_orderdate")
    days = t.read("orders").where(F.month("o_orderdate").isin(5, 6, 7, 8, 9)).select(day.alias("run_date")).distinct()
    return day_horizon(days, ["run_date"], F.col("run_date"), TZ).withColumn("yhat", F.lit(0.0))


@query(
    "try_numeric",
    """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'view' THEN 'n/a' WHEN event_type = 'click' THEN ' ' || CAST(value AS VARCHAR)
      ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS number FROM events""",
)
def try_numeric(t: Tables):
    text = F.col("value").cast("string")
    odd = F.when(F.col("event_type") == "view", "n/a").when(F.col("event_type") == "click", F.concat(F.lit(" "), text))
    return t.events.select("event_id", to_num(odd.otherwise(text)).alias("number"))


@query(
    "row_sum_min_count",
    f"""WITH {GRID}, {WIDE}, k AS (SELECT ts, {' + '.join(f'coalesce({c}, 0)' for c in WIDE_COLS)} AS s,
      {' + '.join(f'({c} IS NOT NULL)::INT' for c in WIDE_COLS)} AS n FROM wide)
    SELECT ts, {rnd('CASE WHEN n >= 1 THEN s END')} AS sum_min1, {rnd('CASE WHEN n >= 3 THEN s END')} AS sum_min3,
      {rnd('CASE WHEN n >= 5 THEN s END')} AS sum_min5 FROM k""",
)
def row_sum_min_count(t: Tables):
    return wide(t).select("ts", *[row_sum(WIDE_COLS, m).alias(f"sum_min{m}") for m in (1, 3, 5)])


ROLES = """ro AS (SELECT ts, CASE variable_id WHEN 'signup' THEN 'chp' WHEN 'error' THEN 'grid' ELSE 'net' END AS role, value FROM g)"""


def _roles(t: Tables):
    kind = F.col("variable_id")
    return t.grid.withColumn("role", F.when(kind == "signup", "chp").when(kind == "error", "grid").otherwise("net"))


@query(
    "balance_residual",
    f"""WITH {GRID}, {ROLES} SELECT ts, {rnd("sum(CASE WHEN role IN ('grid', 'chp') THEN value END) - sum(CASE WHEN role = 'net' THEN value END)")} AS residual
    FROM ro GROUP BY ts""",
)
def balance_residual(t: Tables):
    return residual(_roles(t), ["ts"])


@query(
    "gross_from_net_pv",
    f"""WITH {GRID}, n AS (SELECT ts, {', '.join(f"max(CASE WHEN variable_id = '{k}' THEN value END) AS {k}" for k in KINDS)} FROM g GROUP BY ts)
    SELECT ts, 'C1' AS cabin, {rnd('purchase + view')} AS gross FROM n UNION ALL SELECT ts, 'C2', {rnd('error')} FROM n
    UNION ALL SELECT ts, 'C3', {rnd('signup + click')} FROM n""",
)
def gross_from_net_pv(t: Tables):
    """Cabins C1 and C3 have a PV system, C2 has none."""
    n = align(t.grid, [], "variable_id", KINDS)
    meters = [("C1", "purchase", "view"), ("C2", "error", None), ("C3", "signup", "click")]
    cabins = F.array(*[
        F.struct(F.lit(c).alias("cabin"), F.col(net).alias("net"), (F.col(pv) if pv else F.lit(None).cast("double")).alias("pv"), F.lit(pv is not None).alias("has"))
        for c, net, pv in meters
    ])
    return n.select("ts", F.explode(cabins).alias("c")).select(
        "ts", "c.cabin", gross(F.col("c.net"), F.col("c.pv"), F.col("c.has")).alias("gross")
    )


@query(
    "consumption_totals",
    f"""WITH {GRID}, {ROLES} SELECT ts, {rnd("CASE WHEN count(CASE WHEN role = 'net' THEN value END) >= 2 THEN sum(CASE WHEN role = 'net' THEN value END) END")} AS "CONS_TOT_kW",
      {rnd("sum(CASE WHEN role IN ('grid', 'chp') THEN value END)")} AS "CONS_TOT_NET_kW" FROM ro GROUP BY ts""",
)
def consumption_totals(t: Tables):
    role = F.when(F.col("role") == "net", "gross").otherwise(F.col("role"))
    return totals(_roles(t).withColumn("role", role), ["ts"], gross_min=2)


@query(
    "feature_conform",
    f"WITH {GRID}, {WIDE} SELECT ts, {rnd('gross_el_cons_signup')} AS gross_el_cons_signup, {rnd('gross_el_cons_view')} AS gross_el_cons_view FROM wide",
)
def feature_conform(t: Tables):
    return conform(wide(t), ["gross_el_cons_signup", "gross_el_cons_view"], ["ts"])


@query(
    "history_coverage",
    """SELECT event_type AS variable_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts,
      CASE WHEN min(ts) <= TIMESTAMP '2024-01-01 00:15:00' AND max(ts) >= TIMESTAMP '2024-01-30 23:30:00' THEN 1 ELSE 0 END AS covered
    FROM events GROUP BY event_type""",
)
def history_coverage_query(t: Tables):
    a, b = (F.lit(x).cast("timestamp") for x in ("2024-01-01 00:15:00", "2024-01-30 23:30:00"))
    return history_coverage(t.readings, ["variable_id"], a, b)


@query(
    "zone_filter",
    """SELECT event_type AS zone, event_id, ts, round(value, 8) AS price FROM events WHERE event_type IN ('purchase', 'signup')""",
)
def zone_filter(t: Tables):
    prices = t.readings.select(F.col("variable_id").alias("zone"), "event_id", "ts", F.col("value").alias("price"))
    return zone_prices(prices, ["purchase", "signup"])
