"""End-to-end dataset and price jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.weather import WEATHER_COLUMNS, explode_regular_block
from ..load import build_electric_dataset, build_thermal_dataset
from ..pricejobs import market_update
from .base import GRID, PRICES, TZ, WEATHER_GRID, Tables, bins, closed, computus, fill, local, query, rnd

# The meters of the site: event type and user modulo 3 name a meter.
METERS = [
    ("C1", "net", 0, "purchase-0"), ("C2", "net", 0, "purchase-1"), ("C2", "net", 1, "purchase-2"),
    ("C1", "pv_main", 0, "view-0"), ("C1", "pv_backup", 0, "click-0"),
    ("C2", "pv_main", 0, "view-1"), ("C2", "pv_backup", 0, "click-1"), ("C2", "pv_main", 1, "view-2"),
    ("C10", "pv_main", 0, "click-2"),
    ("MCB1", "grid", 0, "error-0"), ("MCB2", "grid", 0, "error-1"), ("MCB3", "grid", 0, "error-2"),
    ("CHP", "chp", 0, "signup-0"), ("CHP", "chp", 1, "signup-1"), ("CHP", "chp", 2, "signup-2"),
]
VALUES = ", ".join(f"('S1', '{c}', '{r}', {p}, '{v}')" for c, r, p, v in METERS)

CALENDAR_SQL = f"""CAST(month(lt) - 1 AS INTEGER) AS month, CAST(isodow(lt) - 1 AS INTEGER) AS day_of_week,
      CAST(hour(lt) * 4 + minute(lt) // 15 AS INTEGER) AS quarter_hour,
      {rnd('sin(2 * pi() * (month(lt) - 1) / 12)')} AS sin_month, {rnd('cos(2 * pi() * (month(lt) - 1) / 12)')} AS cos_month,
      {rnd('sin(2 * pi() * (isodow(lt) - 1) / 7)')} AS sin_day_of_week, {rnd('cos(2 * pi() * (isodow(lt) - 1) / 7)')} AS cos_day_of_week,
      {rnd('sin(2 * pi() * (hour(lt) * 4 + minute(lt) // 15) / 96)')} AS sin_quarter, {rnd('cos(2 * pi() * (hour(lt) * 4 + minute(lt) // 15) / 96)')} AS cos_quarter,
      CAST({closed('lt', 'CAST(lt AS DATE) IN (SELECT day FROM hol)')} AS INTEGER) AS campus_closed,
      {rnd('temperature_2m * (1 - (' + closed('lt', 'CAST(lt AS DATE) IN (SELECT day FROM hol)') + '))')} AS "T_open" """


def site_readings(t: Tables):
    """Readings of the fifteen meters; PV meters report a counter."""
    meter = F.concat_ws("-", "variable_id", F.pmod("meter", F.lit(3)).cast("string"))
    counter = F.pmod("event_id", F.lit(977)) + F.col("value") / 1000
    is_pv = F.col("variable_id").isin("view", "click")
    return t.readings.select(
        "site_id", meter.alias("variable_id"), "ts", F.when(is_pv, counter).otherwise(F.col("value")).alias("value")
    )


def meter_map(t: Tables):
    return t.spark.createDataFrame(
        [("S1", *m) for m in METERS], "site_id string, cabin string, role string, position int, variable_id string"
    )


@query(
    "build_electric_dataset",
    f"""WITH {computus()}, {GRID}, {WEATHER_GRID},
    mm AS (SELECT * FROM (VALUES {VALUES}) v(site_id, cabin, role, position, variable_id)),
    sr AS (SELECT event_type || '-' || (user_id % 3) AS variable_id, ts,
      CASE WHEN event_type IN ('view', 'click') THEN (event_id % 977) + value / 1000 ELSE value END AS value FROM events),
    tg AS (SELECT sr.*, cabin, role, position FROM sr JOIN mm USING (variable_id)),
    su AS (SELECT * FROM tg WHERE role IN ('grid', 'chp')), sb AS ({bins('su', 'role, variable_id')}),
    sg AS (SELECT s.role, s.variable_id, s.ts, sb.value FROM
      (SELECT role, variable_id, unnest(generate_series(a, z, INTERVAL 15 minute)) AS ts FROM
        (SELECT DISTINCT role, variable_id FROM sb), (SELECT min(ts) AS a, max(ts) AS z FROM sb)) s LEFT JOIN sb USING (role, variable_id, ts)),
    sf AS ({fill('sg', 'role, variable_id', limit=2)}),
    ne AS (SELECT * FROM tg WHERE role = 'net'), nb AS ({bins('ne', 'cabin, variable_id')}),
    net AS (SELECT cabin, ts, sum(value) AS net FROM nb GROUP BY cabin, ts),
    pc AS (SELECT variable_id, ts, value FROM sr WHERE variable_id LIKE 'view%' OR variable_id LIKE 'click%'),
    pd AS (SELECT variable_id, ts, value - lag(value) OVER w AS de, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3.6e9 AS dh FROM pc
      WINDOW w AS (PARTITION BY variable_id ORDER BY ts)),
    pk AS (SELECT variable_id, ts, CASE WHEN de >= 0 AND dh > 0 THEN de / dh END AS value FROM pd), pb AS ({bins('pk')}),
    pm AS (SELECT cabin, position, ts, coalesce(max(CASE WHEN role = 'pv_main' THEN value END), max(CASE WHEN role = 'pv_backup' THEN value END)) AS value
      FROM pb JOIN mm USING (variable_id) WHERE role LIKE 'pv%' GROUP BY ALL),
    pv AS (SELECT cabin, ts, sum(value) AS pv FROM pm GROUP BY cabin, ts),
    bal AS (SELECT ts, sum(s) - sum(n) AS net FROM (SELECT ts, value AS s, NULL AS n FROM sf UNION ALL SELECT ts, NULL, net FROM net) GROUP BY ts),
    gr AS (SELECT coalesce(n.ts, p.ts) AS ts, cabin, n.net + p.pv AS y FROM net n FULL JOIN pv p USING (cabin, ts) WHERE cabin IN ('C1', 'C2')
      UNION ALL SELECT ts, 'C10', bal.net + p.pv FROM bal LEFT JOIN (SELECT ts, pv FROM pv WHERE cabin = 'C10') p USING (ts)),
    ct AS (SELECT ts, max(CASE WHEN cabin = 'C1' THEN y END) AS c1, max(CASE WHEN cabin = 'C2' THEN y END) AS c2, max(CASE WHEN cabin = 'C10' THEN y END) AS c10, sum(y) AS tot
      FROM gr GROUP BY ts),
    nt AS (SELECT ts, sum(value) AS net FROM sf GROUP BY ts),
    wd AS (SELECT * FROM ct FULL JOIN nt USING (ts)),
    wi AS (SELECT s.ts, wd.* EXCLUDE (ts) FROM (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 15 minute)) AS ts FROM wd) s LEFT JOIN wd USING (ts)),
    ds AS (SELECT 'S1' AS site_id, * EXCLUDE (site_id), {local()} AS lt FROM wi FULL JOIN wg USING (ts))
    SELECT site_id, ts, round(c1, 7) + 0.0 AS "gross_el_cons_C1", round(c2, 7) + 0.0 AS "gross_el_cons_C2", round(c10, 7) + 0.0 AS "gross_el_cons_C10",
      round(tot, 7) + 0.0 AS "CONS_TOT_kW", round(net, 7) + 0.0 AS "CONS_TOT_NET_kW",
      {', '.join(f'{rnd(c)} AS {c}' for c in WEATHER_COLUMNS)}, lt AS ts_local, {CALENDAR_SQL} FROM ds""",
)
def electric(t: Tables):
    data = build_electric_dataset(
        site_readings(t), meter_map(t), explode_regular_block(t.weather_blocks), t.event_holidays, ["C1", "C2"], "C10", TZ
    )
    powers = ["gross_el_cons_C1", "gross_el_cons_C2", "gross_el_cons_C10", "CONS_TOT_kW", "CONS_TOT_NET_kW"]
    return data.withColumns({c: F.round(c, 7) for c in powers})


@query(
    "build_thermal_dataset",
    f"""WITH {computus()}, {GRID}, {WEATHER_GRID},
    th AS (SELECT ts, max(CASE WHEN variable_id = 'purchase' THEN least(value, 100) END) AS heat, max(CASE WHEN variable_id = 'error' THEN least(value, 100) END) AS dh
      FROM g WHERE variable_id IN ('purchase', 'error') AND value IS NOT NULL GROUP BY ts),
    tw AS (SELECT s.ts, th.* EXCLUDE (ts) FROM (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 15 minute)) AS ts FROM th) s LEFT JOIN th USING (ts)),
    ds AS (SELECT 'S1' AS site_id, * EXCLUDE (site_id), {local()} AS lt FROM tw FULL JOIN wg USING (ts))
    SELECT site_id, ts, {rnd('heat')} AS "THERMAL_LOAD_kW", {rnd('dh')} AS "DH_THERMAL_LOAD_kW",
      {', '.join(f'{rnd(c)} AS {c}' for c in WEATHER_COLUMNS)}, lt AS ts_local, {CALENDAR_SQL} FROM ds""",
)
def thermal(t: Tables):
    names = {"purchase": "THERMAL_LOAD_kW", "error": "DH_THERMAL_LOAD_kW"}
    return build_thermal_dataset(
        t.readings, names, explode_regular_block(t.weather_blocks), t.event_holidays, TZ, cap=100.0
    )


@query(
    "update_prices",
    f"WITH {PRICES} SELECT zone, ts, {rnd('price')} AS price FROM p WHERE {local()} < TIMESTAMP '2024-01-31'",
)
def update(t: Tables):
    """History to 24 January, documents for every local day, target 30 January."""
    return _market_update(t, [])[0]


@query(
    "update_prices_failed_days",
    f"""WITH {PRICES}, lastzone AS (SELECT max(zone) AS zone FROM p)
    SELECT '2024-01-26' AS day, 'no records' AS reason UNION ALL SELECT '2024-01-27', 'lacks ' || zone FROM lastzone UNION ALL
    SELECT '2024-01-28', 'not landed'""",
)
def update_failed(t: Tables):
    """Of the due days, one document without records, one without a zone, one that has not landed."""
    return _market_update(t, ["2024-01-26", "2024-01-27", "2024-01-28"])[1]


@query(
    "update_prices_partial",
    f"""WITH {PRICES} SELECT zone, ts, {rnd('price')} AS price FROM p WHERE {local()} < TIMESTAMP '2024-01-31'
      AND CAST({local()} AS DATE) NOT IN (DATE '2024-01-26', DATE '2024-01-27', DATE '2024-01-28')""",
)
def update_partial(t: Tables):
    """The prices landed beside the failed days."""
    return _market_update(t, ["2024-01-26", "2024-01-27", "2024-01-28"])[0]


def _market_update(t: Tables, bad: list[str]):
    day = F.to_date(F.from_utc_timestamp("ts", TZ))
    history = t.price_history.where(day < F.lit("2024-01-25").cast("date"))
    record = F.struct(F.unix_seconds("ts").alias("At"), F.col("zone").alias("Zone"), F.col("price").alias("Price"))
    # Hours and zones of one day.
    docs = t.price_history.groupBy(day.alias("day")).agg(
        F.to_json(F.struct(F.struct(F.sort_array(F.collect_list(record)).alias("rows")).alias("result"))).alias("doc")
    )
    zones = [r[0] for r in t.price_history.select("zone").distinct().orderBy("zone").collect()]
    if bad:
        empty, lacking, absent = (F.lit(d).cast("date") for d in bad)
        other = F.replace("doc", F.lit(f'"Zone":"{zones[-1]}"'), F.lit('"Zone":"elsewhere"'))
        docs = docs.where(F.col("day") != absent).withColumn(
            "doc", F.when(F.col("day") == empty, F.lit('{"result": []}')).when(F.col("day") == lacking, other).otherwise(F.col("doc"))
        )
    return market_update(history, docs, zones, F.lit("2024-01-30").cast("date"), TZ)
