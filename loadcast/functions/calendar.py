"""Local-time calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timecols import to_local

# Cycle lengths of month, weekday and quarter-hour.
PERIODS = {"month": 12, "day_of_week": 7, "quarter_hour": 96}
CYCLE_NAMES = {"month": "month", "day_of_week": "day_of_week", "quarter_hour": "quarter"}

# Opening rules of the site.
CLOSED_ISO_WEEKS = (33, 34)
OPEN_FROM_HOUR = 7
WEEKDAY_CLOSING_HOUR = 21
SATURDAY_CLOSING_HOUR = 20
WINTER_BREAK_FROM = (12, 23)
WINTER_BREAK_TO = (1, 3)

CYCLIC_FEATURES = [f"{fn}_{CYCLE_NAMES[c]}" for c in PERIODS for fn in ("sin", "cos")]


def month0(local: str) -> Column:
    return F.expr(f"month(`{local}`) - 1")


def weekday0(local: str) -> Column:
    """Monday = 0."""
    return F.expr(f"weekday(`{local}`)")


def quarter_hour(local: str) -> Column:
    return F.expr(f"hour(`{local}`) * 4 + minute(`{local}`) div 15").cast("int")


def cyclic(name: str, period: int) -> tuple[Column, Column]:
    angle = f"2 * pi() * `{name}` / {period}"
    return F.expr(f"sin({angle})"), F.expr(f"cos({angle})")


def site_closed(local: str, holiday: str) -> Column:
    """1 when the site is closed at the local wall time. The first rule that applies decides."""
    t, weeks = f"`{local}`", ", ".join(map(str, CLOSED_ISO_WEEKS))
    return F.expr(
        f"""CASE WHEN weekday({t}) = 6 OR coalesce(`{holiday}`, false) THEN 1
        WHEN weekofyear({t}) IN ({weeks}) THEN 1
        WHEN month({t}) = {WINTER_BREAK_FROM[0]} AND day({t}) >= {WINTER_BREAK_FROM[1]} THEN 1
        WHEN month({t}) = {WINTER_BREAK_TO[0]} AND day({t}) <= {WINTER_BREAK_TO[1]} THEN 1
        WHEN hour({t}) >= {OPEN_FROM_HOUR}
          AND hour({t}) < CASE WHEN weekday({t}) = 5 THEN {SATURDAY_CLOSING_HOUR} ELSE {WEEKDAY_CLOSING_HOUR} END THEN 0
        ELSE 1 END"""
    )


def weekday_dummies(local: str) -> Column:
    """Array of seven 0/1 values, Monday first."""
    return F.expr(f"transform(sequence(0, 6), i -> double(weekday(`{local}`) = i))")


def add_calendar_ints(df: DataFrame, tz: str, ts: str = "ts") -> DataFrame:
    return df.withColumn("ts_local", to_local(ts, tz)).withColumns(
        {
            "month": month0("ts_local"),
            "day_of_week": weekday0("ts_local"),
            "quarter_hour": quarter_hour("ts_local"),
        }
    )


def add_cyclic(df: DataFrame) -> DataFrame:
    out = {}
    for name, period in PERIODS.items():
        out[f"sin_{CYCLE_NAMES[name]}"], out[f"cos_{CYCLE_NAMES[name]}"] = cyclic(name, period)
    return df.withColumns(out)


def add_calendar(
    df: DataFrame, holidays: DataFrame, tz: str, ts: str = "ts", temperature: str = "temperature_2m"
) -> DataFrame:
    """Every calendar feature, plus the temperature that counts only while the site is open.

    ``holidays`` is the dimension of :mod:`loadcast.functions.holidays`, a few dozen rows per
    year of coverage.
    """
    local = add_cyclic(add_calendar_ints(df, tz, ts))
    flagged = mark_holidays(local, holidays)
    closed = flagged.withColumn("campus_closed", site_closed("ts_local", "is_holiday")).drop("is_holiday")
    if temperature in df.columns:
        closed = closed.withColumn("T_open", F.col(temperature) * (1 - F.col("campus_closed")))
    return closed


def mark_holidays(df: DataFrame, holidays: DataFrame, local: str = "ts_local") -> DataFrame:
    """Add ``is_holiday`` by a left join on the local date; the dimension holds one row per day."""
    days = holidays.select(F.col("day").alias("_day")).distinct().withColumn("is_holiday", F.lit(True))
    return (
        df.withColumn("_local_day", F.to_date(local))
        .join(days, F.col("_local_day") == F.col("_day"), "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
        .drop("_day", "_local_day")
    )
