"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.timecols import from_epoch_ms, local_to_utc, to_epoch_ms
from ...operators.lags import lag_time
from ...session import scratch_path
from ...sources.panel import read_panel, to_payload, write_forecast, write_panel, write_training_matrix
from ...sources.prices import coerce_prices, extract_zone_prices, read_price_csv
from ...sources.readings import scan_readings, series_or_null_grid
from ...sources.weather import WEATHER_COLUMNS, explode_regular_block
from .base import GRID, PRICES, READINGS, TZ, WEATHER_GRID, Tables, local, query, rnd, to_utc


@query(
    "scan_readings_range",
    f"""SELECT event_type AS variable_id, ts, {rnd('value')} AS value FROM events
    WHERE event_type IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-08' AND ts <= TIMESTAMP '2024-01-21 23:45:00'""",
)
def scan_readings_range(t: Tables):
    raw = t.events.select(F.col("event_type").alias("variable_id"), "ts", "value")
    a, b = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-08 00:00:00", "2024-01-21 23:45:00"))
    return scan_readings(raw, ["view", "click"], a, b)


@query("epoch_ms_to_ts", "SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events")
def epoch_ms_to_ts(t: Tables):
    ms = t.readings.select("event_id", to_epoch_ms("ts").alias("timestamp"))
    return ms.select("event_id", from_epoch_ms("timestamp").alias("ts"))


@query("ts_to_epoch_ms", "SELECT event_id, epoch_us(ts) // 1000 AS timestamp FROM events")
def ts_to_epoch_ms(t: Tables):
    return t.readings.select("event_id", to_epoch_ms("ts").alias("timestamp"))


@query(
    "null_grid_for_missing_meter",
    f"""WITH {READINGS}, w AS (SELECT time_bucket(INTERVAL 15 minute, min(ts)) AS a, time_bucket(INTERVAL 15 minute, max(ts)) AS z FROM r),
    m AS (SELECT DISTINCT variable_id FROM r UNION ALL SELECT 'silent'),
    s AS (SELECT variable_id, unnest(generate_series(a, z, INTERVAL 15 minute)) AS ts FROM m, w),
    b AS (SELECT variable_id, time_bucket(INTERVAL 15 minute, ts) AS ts, avg(value) AS value FROM r GROUP BY ALL)
    SELECT variable_id, ts, {rnd('value')} AS value FROM s LEFT JOIN b USING (variable_id, ts)""",
)
def null_grid_for_missing_meter(t: Tables):
    span = t.readings.agg(F.min("ts").alias("a"), F.max("ts").alias("z"))
    meters = t.readings.select("variable_id").distinct().unionByName(span.select(F.lit("silent").alias("variable_id")))
    first, last = span.first()
    return series_or_null_grid(t.readings.select("variable_id", "ts", "value"), meters, F.lit(first), F.lit(last))


@query(
    "explode_weather_block",
    f"""WITH {GRID}, {WEATHER_GRID} SELECT site_id, ts, {', '.join(f'{rnd(c)} AS {c}' for c in WEATHER_COLUMNS)} FROM wg""",
)
def explode_weather_block(t: Tables):
    return explode_regular_block(t.weather_blocks)


@query(
    "price_scan_coerce",
    f"""WITH {PRICES} SELECT zone, ts, {rnd('price')} AS price FROM p WHERE price IS NOT NULL
      AND hour(ts) <> 5 AND NOT (zone = 'error' AND hour(ts) = 7)""",
)
def price_scan_coerce(t: Tables):
    """Written as text files with unreadable stamps at 5 h and unreadable prices of one zone at 7 h."""
    path = scratch_path(t.spark, "price-csv")
    hour = F.hour("ts")
    text = t.price_history.select(
        "zone",
        F.date_format(F.from_utc_timestamp("ts", TZ), "yyyy-MM-dd HH:mm:ss").alias("italian datetime"),
        F.when(hour == 5, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")).alias("datetime"),
        F.when((F.col("zone") == "error") & (hour == 7), "n/a").otherwise(F.col("price").cast("string")).alias("price"),
    )
    text.write.partitionBy("zone").option("header", True).csv(path)
    return coerce_prices(read_price_csv(t.spark, path))


def landed_documents(t: Tables):
    """One JSON document per UTC day with the hourly prices of every zone, twelve levels down."""
    record = F.struct(F.hour("ts").alias("Hour"), F.col("zone").alias("Zone"), F.col("price").alias("Price"))
    return t.price_history.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.to_json(
            F.struct(
                F.lit("ok").alias("status"),
                F.array(F.lit(1), F.lit(2)).alias("codes"),
                F.struct(
                    F.struct(F.lit("x").alias("Zone")).alias("about"),
                    F.array(
                        F.struct(F.lit("empty").alias("name")).alias("head"),
                    ).alias("notes"),
                    _wrapped(F.sort_array(F.collect_list(record)).alias("rows"), 10).alias("inner"),
                ).alias("body"),
            )
        ).alias("doc")
    )


def _wrapped(value, times: int):
    """``value`` inside so many objects and lists in turn."""
    for k in range(times):
        value = F.struct(value.alias(f"level{k}")) if k % 2 else F.array(value)
    return value


@query(
    "json_zone_price_extract",
    f"""WITH {PRICES} SELECT strftime(ts, '%Y-%m-%d') AS day,
      CAST(row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY hour(ts), zone) - 1 AS INTEGER) AS position,
      zone, {rnd('price')} AS price FROM p""",
)
def json_zone_price_extract(t: Tables):
    return extract_zone_prices(t.stored("landed-documents", lambda: landed_documents(t)), ["day"], "doc")


@query("panel_roundtrip", f"WITH {GRID} SELECT 'S1' AS site_id, variable_id, ts, {rnd('value')} AS value, strftime(ts, '%Y-%m') AS month FROM g")
def panel_roundtrip(t: Tables):
    path = scratch_path(t.spark, "panel")
    write_panel(t.grid.select(F.lit("S1").alias("site_id"), "variable_id", "ts", "value"), path)
    back = read_panel(t.spark, path, "variable_id string, ts timestamp, value double, site_id string, month string")
    return back.select("site_id", "variable_id", "ts", "value", "month")


def _naive(t: Tables):
    """The value seven days before as a forecast."""
    return lag_time(t.grid.withColumnRenamed("value", "y"), ["variable_id"], "y", [168]).select(
        F.col("variable_id").alias("target"), "ts", F.col("lag_168h").alias("yhat")
    )


NAIVE = f"{GRID}, f AS (SELECT g.variable_id AS target, g.ts, l.value AS yhat FROM g LEFT JOIN g l ON l.variable_id = g.variable_id AND l.ts = g.ts - INTERVAL 168 hour)"


@query(
    "forecast_sink",
    f"WITH {NAIVE} SELECT target, strftime({local()}, '%Y-%m-%d') AS run_date, ts, {rnd('yhat')} AS yhat FROM f",
)
def forecast_sink(t: Tables):
    path = scratch_path(t.spark, "forecasts")
    write_forecast(_naive(t), path, tz=TZ)
    schema = "ts timestamp, yhat double, target string, run_date string"
    return t.spark.read.schema(schema).parquet(path).select("target", "run_date", "ts", "yhat")


@query(
    "upload_payload",
    f"""WITH {NAIVE}, u AS (SELECT target AS variable_id, strftime({local()}, '%Y-%m-%d') AS run_date, epoch_ms(ts) AS timestamp, yhat FROM f)
    SELECT variable_id, run_date, CAST(sum(CASE WHEN yhat IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY variable_id, run_date) AS BIGINT) AS n_missing,
      CAST(row_number() OVER (PARTITION BY variable_id, run_date ORDER BY timestamp) - 1 AS INTEGER) AS position,
      timestamp, {rnd('coalesce(yhat, 0)')} AS value FROM u""",
)
def upload_payload(t: Tables):
    payload = to_payload(_naive(t), tz=TZ)
    flat = payload.select("variable_id", "run_date", "n_missing", F.posexplode("samples").alias("position", "s"))
    return flat.select("variable_id", "run_date", "n_missing", "position", "s.timestamp", "s.value")


@query(
    "local_to_utc",
    f"SELECT l_orderkey, l_linenumber, {to_utc('l_shipdate')} AS ts FROM lineitem",
)
def local_to_utc_query(t: Tables):
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", local_to_utc(F.col("l_shipdate").cast("timestamp"), TZ).alias("ts")
    )


@query(
    "training_matrix_export",
    f"""WITH {GRID}, x AS (SELECT g.variable_id AS target, g.ts, g.value AS y, a.value AS lag_48h, c.value AS lag_168h FROM g
      JOIN g a ON a.variable_id = g.variable_id AND a.ts = g.ts - INTERVAL 48 hour
      JOIN g c ON c.variable_id = g.variable_id AND c.ts = g.ts - INTERVAL 168 hour)
    SELECT target, ts, {rnd('y')} AS y, {rnd('lag_48h')} AS lag_48h, {rnd('lag_168h')} AS lag_168h FROM x
    WHERE y IS NOT NULL AND lag_48h IS NOT NULL AND lag_168h IS NOT NULL""",
)
def training_matrix_export(t: Tables):
    path = scratch_path(t.spark, "matrix")
    panel = lag_time(t.grid.withColumnsRenamed({"value": "y", "variable_id": "target"}), ["target"], "y", [48, 168])
    write_training_matrix(panel.na.drop("any"), path)
    schema = "ts timestamp, y double, lag_48h double, lag_168h double, target string"
    return t.spark.read.schema(schema).parquet(path).select("target", "ts", "y", "lag_48h", "lag_168h")
