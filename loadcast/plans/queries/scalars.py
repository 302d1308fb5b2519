"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.calendar import add_calendar, add_calendar_ints, add_cyclic, mark_holidays, site_closed, weekday_dummies
from ...functions.timecols import HOUR, floor_15m, market_stamp, parse_ts, to_local
from ...operators.pricing import small_mode
from .base import HOURLY, READINGS, TZ, Tables, bins, closed, computus, local, query, rnd, to_utc


@query("floor_15m", "SELECT event_id, time_bucket(INTERVAL 15 minute, ts) AS ts FROM events")
def floor_15m_query(t: Tables):
    return t.readings.select("event_id", floor_15m("ts").alias("ts"))


@query("utc_to_local", f"SELECT l_orderkey, l_linenumber, {local("l_shipdate + INTERVAL (l_partkey % 24) hour")} AS ts_local FROM lineitem")
def utc_to_local(t: Tables):
    return t.read("lineitem").select("l_orderkey", "l_linenumber", to_local(_ship_hour(), TZ).alias("ts_local"))


def _ship_hour():
    """Ship date plus an hour of the day taken from the part key."""
    day = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    return F.timestamp_seconds(day + F.pmod("l_partkey", F.lit(24)) * HOUR)


QUARTER = "(o_orderdate + INTERVAL (o_orderkey % 96 * 15) minute)"


def _orders(t: Tables):
    """Order date plus a quarter-hour of the day taken from the order key, as UTC."""
    day = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return t.read("orders").select("o_orderkey", F.timestamp_seconds(day + F.pmod("o_orderkey", F.lit(96)) * 900).alias("ts"))


ORDERS = f"o AS (SELECT o_orderkey, {QUARTER} AS ts, {local(QUARTER)} AS lt FROM orders)"


@query(
    "calendar_ints",
    f"""WITH {ORDERS} SELECT o_orderkey, ts, lt AS ts_local, CAST(month(lt) - 1 AS INTEGER) AS month, CAST(isodow(lt) - 1 AS INTEGER) AS day_of_week,
      CAST(hour(lt) * 4 + minute(lt) // 15 AS INTEGER) AS quarter_hour FROM o""",
)
def calendar_ints(t: Tables):
    return add_calendar_ints(_orders(t), TZ)


@query(
    "cyclic_encoding",
    f"""WITH {ORDERS}, k AS (SELECT o_orderkey, month(lt) - 1 AS m, isodow(lt) - 1 AS d, hour(lt) * 4 + minute(lt) // 15 AS q FROM o)
    SELECT o_orderkey, {rnd('sin(2 * pi() * m / 12)')} AS sin_month, {rnd('cos(2 * pi() * m / 12)')} AS cos_month,
      {rnd('sin(2 * pi() * d / 7)')} AS sin_day_of_week, {rnd('cos(2 * pi() * d / 7)')} AS cos_day_of_week,
      {rnd('sin(2 * pi() * q / 96)')} AS sin_quarter, {rnd('cos(2 * pi() * q / 96)')} AS cos_quarter FROM k""",
)
def cyclic_encoding(t: Tables):
    return add_cyclic(add_calendar_ints(_orders(t), TZ)).drop("ts", "ts_local", "month", "day_of_week", "quarter_hour")


@query(
    "campus_closed",
    f"""WITH {computus()}, {ORDERS} SELECT o_orderkey, ts, CAST({closed('lt', 'CAST(lt AS DATE) IN (SELECT day FROM hol)')} AS INTEGER) AS campus_closed FROM o""",
)
def campus_closed(t: Tables):
    marked = mark_holidays(_orders(t).withColumn("ts_local", to_local("ts", TZ)), t.holidays(1990, 2030))
    return marked.select("o_orderkey", "ts", site_closed("ts_local", "is_holiday").alias("campus_closed"))


@query(
    "t_open",
    f"""WITH {computus()}, {READINGS}, b AS ({bins('r')}), k AS (SELECT variable_id AS site_id, ts, value AS temperature_2m, {local()} AS lt FROM b)
    SELECT site_id, ts, {rnd('temperature_2m')} AS temperature_2m, CAST({closed('lt', 'CAST(lt AS DATE) IN (SELECT day FROM hol)')} AS INTEGER) AS campus_closed,
      {rnd('temperature_2m * (1 - (' + closed('lt', 'CAST(lt AS DATE) IN (SELECT day FROM hol)') + '))')} AS "T_open" FROM k""",
)
def t_open(t: Tables):
    """Every series as the temperature of a site of its own."""
    weather = t.bins.select(F.col("variable_id").alias("site_id"), "ts", F.col("value").alias("temperature_2m"))
    return add_calendar(weather, t.event_holidays, TZ).select("site_id", "ts", "temperature_2m", "campus_closed", "T_open")


@query(
    "market_day_stamps",
    f"""WITH d AS (SELECT date_trunc('day', o_orderdate) AS day FROM orders GROUP BY 1),
    s AS (SELECT day, {to_utc('day')} AS a, {to_utc('day + INTERVAL 1 day')} AS z FROM d),
    x AS (SELECT day, unnest(generate_series(a, z - INTERVAL 1 hour, INTERVAL 1 hour)) AS ts, a FROM s)
    SELECT strftime(day, '%Y-%m-%d') AS day, CAST(epoch(ts - a) / 3600 AS BIGINT) AS position, ts, {local()} AS ts_local FROM x""",
)
def market_day_stamps(t: Tables):
    """Hourly stamps of every order day: 23, 24 or 25 of them."""
    days = t.read("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    first = F.unix_seconds(F.to_utc_timestamp(F.col("day").cast("timestamp"), TZ))
    after = F.unix_seconds(F.to_utc_timestamp(F.date_add("day", 1).cast("timestamp"), TZ))
    steps = days.select("day", F.explode(F.sequence(F.lit(0), F.floor((after - first) / HOUR) - 1)).alias("position"))
    stamps = steps.withColumn("ts", market_stamp("day", "position", HOUR, TZ))
    return stamps.withColumn("ts_local", to_local("ts", TZ))


@query(
    "weekday_dummies",
    f"""WITH {ORDERS} SELECT o_orderkey, {', '.join(f'CASE WHEN isodow(lt) = {i + 1} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weekday_{i}' for i in range(7))} FROM o""",
)
def weekday_dummies_query(t: Tables):
    flags = _orders(t).withColumn("ts_local", to_local("ts", TZ)).withColumn("d", weekday_dummies("ts_local"))
    return flags.select("o_orderkey", *[F.get("d", F.lit(i)).alias(f"weekday_{i}") for i in range(7)])


@query(
    "parse_ts_text",
    """SELECT event_id, CASE event_type WHEN 'view' THEN date_trunc('second', ts) WHEN 'click' THEN date_trunc('day', ts)
      WHEN 'purchase' THEN date_trunc('second', ts) - INTERVAL 1 hour END AS ts FROM events""",
)
def parse_ts_text(t: Tables):
    """Plain, date-only and zoned text, the words for no timestamp, and text that is no time."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "purchase", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
        .when(kind == "error", F.when(F.col("user_id") % 2 == 0, " None ").otherwise(""))
        .otherwise("next week")
    )
    return t.events.select("event_id", text.alias("text")).select("event_id", parse_ts("text").alias("ts"))


@query(
    "small_mode_flag",
    f"""WITH {HOURLY}, n AS (SELECT zone, least(count(*), 8736) / 24 AS d FROM h GROUP BY zone)
    SELECT zone, {rnd('d')} AS calibration_days, CASE WHEN d - 9 < 103 THEN 1 ELSE 0 END AS small FROM n""",
)
def small_mode_flag(t: Tables):
    return small_mode(t.hourly, ["zone"])
