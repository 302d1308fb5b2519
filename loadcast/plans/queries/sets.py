"""Set operations and history upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.history import append_block, common_dates, missing_dates, next_window, upsert, with_future_rows
from .aggregates import two_zone_dates
from .base import HOURLY, READINGS, TZ, Tables, bins, local, query, rnd, to_utc


@query(
    "append_block",
    f"""WITH {READINGS}, b AS ({bins('r')}) SELECT variable_id, ts, {rnd('value')} AS value, NULL::DOUBLE AS power FROM b WHERE ts < TIMESTAMP '2024-01-20'
    UNION ALL SELECT variable_id, ts, NULL, {rnd('2 * value')} FROM b WHERE ts >= TIMESTAMP '2024-01-15'""",
)
def append_block_query(t: Tables):
    history, block = _history_and_block(t)
    return append_block(history, block.select("variable_id", "ts", (F.col("value") * 2).alias("power")))


def _history_and_block(t: Tables):
    old = t.bins.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    new = t.bins.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    return old, new


@query(
    "upsert_keep_last",
    f"""WITH {READINGS}, b AS ({bins('r')}) SELECT variable_id, ts, {rnd("CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1000 ELSE value END")} AS value FROM b""",
)
def upsert_keep_last(t: Tables):
    old, new = _history_and_block(t)
    block = new.withColumn("value", F.col("value") + 1000)
    once = upsert(old, block, ["variable_id", "ts"])
    return upsert(once, block, ["variable_id", "ts"])


TWO_ZONES = f"""{READINGS}, d AS (SELECT DISTINCT variable_id AS zone, CAST({local()} AS DATE) AS day FROM r
    WHERE NOT (variable_id = 'view' AND {local()} >= TIMESTAMP '2024-01-28'))"""


@query(
    "dates_intersect",
    f"WITH {TWO_ZONES} SELECT strftime(day, '%Y-%m-%d') AS day FROM (SELECT day FROM d WHERE zone = 'view' INTERSECT SELECT day FROM d WHERE zone = 'click')",
)
def dates_intersect(t: Tables):
    return common_dates(two_zone_dates(t), ["view", "click"])


@query(
    "dates_missing",
    f"""WITH {TWO_ZONES}, k AS (SELECT max(day) AS m FROM (SELECT day FROM d WHERE zone = 'view' INTERSECT SELECT day FROM d WHERE zone = 'click'))
    SELECT strftime(day, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(m + INTERVAL 1 day, TIMESTAMP '2024-02-02', INTERVAL 1 day)) AS day FROM k)""",
)
def dates_missing(t: Tables):
    return missing_dates(two_zone_dates(t), ["view", "click"], F.lit("2024-02-02").cast("date"))


@query(
    "future_placeholder",
    f"""WITH {HOURLY}, f AS (SELECT zone, unnest(generate_series(TIMESTAMP '2024-01-30 23:00:00', TIMESTAMP '2024-01-31 22:00:00', INTERVAL 1 hour)) AS ts FROM (SELECT DISTINCT zone FROM h))
    SELECT zone, ts, {rnd('price')} AS price FROM h ANTI JOIN f USING (zone, ts) UNION ALL SELECT zone, ts, NULL FROM f""",
)
def future_placeholder(t: Tables):
    return with_future_rows(t.hourly, ["zone"], F.lit("2024-01-30 23:00:00").cast("timestamp"))


@query(
    "incremental_bounds",
    f"""WITH m AS (SELECT user_id, max(CASE WHEN event_type = 'view' THEN time_bucket(INTERVAL 15 minute, ts) END) AS last_ts FROM events GROUP BY 1),
    x AS (SELECT user_id, coalesce(last_ts + INTERVAL 15 minute, {to_utc("TIMESTAMP '2023-12-01'")}) AS window_start, {to_utc("TIMESTAMP '2024-01-29 23:45:00'")} AS window_end FROM m)
    SELECT * FROM x WHERE window_start <= window_end""",
)
def incremental_bounds(t: Tables):
    """Next block per user on 31 January 11:00 UTC; users without a view start 61 days back."""
    seen = t.readings.select(
        F.col("meter").alias("user_id"),
        F.when(F.col("variable_id") == "view", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 900) * 900)).alias("ts"),
    )
    return next_window(seen, ["user_id"], F.lit("2024-01-31 11:00:00").cast("timestamp"), TZ, delay_days=2, init_days=61)
