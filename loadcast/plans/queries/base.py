"""Query registry, the logical tables derived from the given ones, and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.holidays import holiday_dimension
from ...functions.timecols import DAY, HOUR, QUARTER_HOUR
from ...operators.grid import bin_mean, resample_mean
from ...operators.interpolate import fill_linear
from ...session import configure, scratch_path

TZ = "Europe/Rome"
PRECISION = 8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_STORED: dict[tuple[str, str, str], str] = {}


class Tables:
    """The given tables of one directory as readings, prices, weather and dimensions."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def readings(self) -> DataFrame:
        """One site; the event type is the meter, the user its sub-meter."""
        return self.events.select(
            F.lit("S1").alias("site_id"), F.col("event_type").alias("variable_id"), F.col("user_id").alias("meter"),
            F.col("ts").cast("timestamp").alias("ts"), "value", "event_id",
        )

    @cached_property
    def counters(self) -> DataFrame:
        """A rising kWh counter per meter that starts over every 977 events."""
        return self.readings.withColumn("value", F.pmod("event_id", F.lit(977)) + F.col("value") / 1000)

    @cached_property
    def bins(self) -> DataFrame:
        return bin_mean(self.readings, ["variable_id"])

    @cached_property
    def grid(self) -> DataFrame:
        return resample_mean(self.readings, ["variable_id"])

    @cached_property
    def hourly(self) -> DataFrame:
        """Known hourly prices (zone, ts, price)."""
        return bin_mean(
            self.readings.select(F.col("variable_id").alias("zone"), "ts", F.col("value").alias("price")),
            ["zone"], value="price", step=HOUR,
        )

    @cached_property
    def prices(self) -> DataFrame:
        """Hourly prices on a continuous grid, gaps filled."""
        grid = resample_mean(self.hourly, ["zone"], value="price", step=HOUR)
        return fill_linear(grid, ["zone"], ["price"], step=HOUR)

    @cached_property
    def weather_blocks(self) -> DataFrame:
        """Landed weather blocks, one per day."""
        return self.stored("weather-blocks", self._make_weather_blocks)

    def _make_weather_blocks(self) -> DataFrame:
        """Four parallel arrays of 96 quarter-hour means per day."""
        slot = F.floor(F.pmod(F.unix_seconds("ts"), F.lit(DAY)) / QUARTER_HOUR).cast("int")
        kinds = ["view", "click", "purchase", "signup"]
        names = ["temperature_2m", "relative_humidity_2m", "dew_point_2m", "direct_normal_irradiance"]
        # At most 96 slots per day in one map.
        maps = (
            self.bins.groupBy(F.to_date("ts").cast("timestamp").alias("start_ts"), slot.alias("slot"))
            .pivot("variable_id", kinds).agg(F.max("value"))
            .groupBy("start_ts")
            .agg(*[F.map_from_entries(F.collect_list(F.struct("slot", k))).alias(k) for k in kinds])
        )

        def in_order(kind: str):
            return F.transform(F.sequence(F.lit(0), F.lit(95)), lambda i: F.try_element_at(F.col(kind), i))

        arrays = [in_order(k).alias(n) for k, n in zip(kinds, names)]
        return maps.select(
            F.lit("S1").alias("site_id"), "start_ts", F.timestamp_seconds(F.unix_seconds("start_ts") + DAY).alias("end_ts"),
            F.lit(QUARTER_HOUR).alias("step_s"), *arrays,
        )

    def once(self, label: str, write: Callable[[str], None]) -> str:
        """Path of something written once per session."""
        key = (self.spark.sparkContext.applicationId, self.dir, label)
        if key not in _STORED:
            path = scratch_path(self.spark, label)
            write(path)
            _STORED[key] = path
        return _STORED[key]

    def stored(self, label: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived table written once per session and read back, as a job reads its history."""
        return self.spark.read.parquet(self.once(label, lambda path: make().write.parquet(path)))

    @cached_property
    def price_history(self) -> DataFrame:
        return self.stored("prices", lambda: self.prices)

    def holidays(self, first: int, last: int) -> DataFrame:
        return holiday_dimension(self.spark, first, last)

    @cached_property
    def event_holidays(self) -> DataFrame:
        return self.holidays(2023, 2025)


def deliver(df: DataFrame) -> DataFrame:
    """Doubles rounded, instants as UTC wall time: what the SQL side returns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, PRECISION)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(Tables) -> DataFrame`` and its SQL counterpart under one key."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: deliver(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


# SQL building blocks -------------------------------------------------------------------------

READINGS = "r AS (SELECT 'S1' AS site_id, event_type AS variable_id, user_id AS meter, ts, value, event_id FROM events)"
COUNTERS = "c AS (SELECT variable_id, ts, (event_id % 977) + value / 1000 AS value FROM r)"


def rnd(expr: str) -> str:
    """Rounded like ``deliver``, without negative zero."""
    return f"(round({expr}, {PRECISION}) + 0.0)"


def local(ts: str = "ts") -> str:
    return f"timezone('{TZ}', timezone('UTC', {ts}))"


def to_utc(ts_local: str) -> str:
    return f"timezone('UTC', timezone('{TZ}', {ts_local}))"


def bins(src: str, keys: str = "variable_id", value: str = "value", step: int = QUARTER_HOUR) -> str:
    return (
        f"SELECT {keys}, time_bucket(INTERVAL '{step} seconds', ts) AS ts, avg({value}) AS {value} "
        f"FROM {src} GROUP BY {keys}, time_bucket(INTERVAL '{step} seconds', ts)"
    )


def grid(src: str, keys: str = "variable_id", value: str = "value", step: int = QUARTER_HOUR) -> str:
    return (
        f"SELECT s.*, b.{value} FROM (SELECT {keys}, unnest(generate_series(min(ts), max(ts), "
        f"INTERVAL '{step} seconds')) AS ts FROM {src} GROUP BY {keys}) s LEFT JOIN {src} b USING ({keys}, ts)"
    )


def fill(src: str, keys: str = "variable_id", value: str = "value", step: int = QUARTER_HOUR, limit: int | None = None, both: bool = False) -> str:
    """Linear fill of a gridded series."""
    seen = f"CASE WHEN {value} IS NOT NULL THEN epoch(ts) END"
    within = "pv + (nv - pv) * ((epoch(ts) - pt) / (nt - pt))"
    known = f"CASE WHEN nt IS NULL THEN pv ELSE {within} END"
    if limit is not None:
        known = f"CASE WHEN (epoch(ts) - pt) / {step} <= {limit} THEN {known} END"
    start = "nv" if both else "NULL"
    return f"""
      SELECT {keys}, ts, CASE WHEN {value} IS NOT NULL THEN {value} WHEN pt IS NULL THEN {start} ELSE {known} END AS {value}
      FROM (SELECT *,
        last_value({seen} IGNORE NULLS) OVER p AS pt, last_value({value} IGNORE NULLS) OVER p AS pv,
        first_value({seen} IGNORE NULLS) OVER q AS nt, first_value({value} IGNORE NULLS) OVER q AS nv
      FROM {src} WINDOW p AS (PARTITION BY {keys} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        q AS (PARTITION BY {keys} ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


GRID = f"{READINGS}, b AS ({bins('r')}), g AS ({grid('b')})"
HOURLY = f"{READINGS}, z AS (SELECT variable_id AS zone, ts, value AS price FROM r), h AS ({bins('z', 'zone', 'price', HOUR)})"
PRICES = f"{HOURLY}, hg AS ({grid('h', 'zone', 'price', HOUR)}), p AS ({fill('hg', 'zone', 'price', HOUR)})"
WEATHER = """w AS (SELECT 'S1' AS site_id, ts,
      max(CASE WHEN variable_id = 'view' THEN value END) AS temperature_2m,
      max(CASE WHEN variable_id = 'click' THEN value END) AS relative_humidity_2m,
      max(CASE WHEN variable_id = 'purchase' THEN value END) AS dew_point_2m,
      max(CASE WHEN variable_id = 'signup' THEN value END) AS direct_normal_irradiance
    FROM b GROUP BY ts)"""
WEATHER_GRID = f"""{WEATHER}, days AS (SELECT DISTINCT date_trunc('day', ts) AS d FROM b),
    wg AS (SELECT 'S1' AS site_id, s.ts, w.* EXCLUDE (site_id, ts) FROM
      (SELECT unnest(generate_series(d, d + INTERVAL 1425 minute, INTERVAL 15 minute)) AS ts FROM days) s LEFT JOIN w USING (ts))"""


def computus(years: str = "SELECT unnest(generate_series(1990, 2030)) AS y") -> str:
    """Holiday days ``hol(day)`` by the rules of ``functions.holidays``, in DuckDB's SQL.

    Both follow the same public computus; tests hold the library's Easter dates against published ones.
    """
    return f"""yrs AS ({years}),
    e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
    e2 AS (SELECT *, (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 AS h FROM e1),
    e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - (c % 4)) % 7 AS l FROM e2),
    e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS q FROM e3),
    easter AS (SELECT make_date(y, q // 31, q % 31 + 1) AS day FROM e4),
    hol AS (SELECT day FROM easter UNION SELECT day + 1 FROM easter
      UNION SELECT make_date(y, m, d) FROM yrs, (VALUES (1,1),(1,6),(4,25),(5,1),(8,15),(11,1),(12,8),(12,25),(12,26)) v(m, d)
      UNION SELECT make_date(y, 6, 2) FROM yrs WHERE y >= 2001
      UNION SELECT make_date(y, 10, 4) FROM yrs WHERE y >= 2026)"""


def closed(t: str, holiday: str) -> str:
    return f"""CASE WHEN isodow({t}) = 7 OR {holiday} THEN 1
      WHEN week({t}) IN (33, 34) THEN 1
      WHEN (month({t}) = 12 AND day({t}) >= 23) OR (month({t}) = 1 AND day({t}) <= 3) THEN 1
      WHEN isodow({t}) <= 5 THEN CASE WHEN hour({t}) >= 7 AND hour({t}) < 21 THEN 0 ELSE 1 END
      ELSE CASE WHEN hour({t}) >= 7 AND hour({t}) < 20 THEN 0 ELSE 1 END END"""
