"""Price workflows: keep the history current, forecast the next days, back-test."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import HOUR, market_stamp, to_local
from ..operators.clean import dedup_last
from ..operators.history import available_dates, missing_dates, upsert
from ..operators.lasso import anchors_of, fit_hourly, predict_hourly
from ..operators.pricing import DEFAULT_WINDOW_DAYS, WARMUP_DAYS, price_design
from ..session import stage
from ..sources.prices import extract_zone_prices


def landed_days(docs: DataFrame, zones: Sequence[str], day: str = "day") -> tuple[DataFrame, DataFrame]:
    """Records (day, position, zone, price) of the days that have every zone, and the failed days (day, reason).

    A document without records, or without one of the zones, fails its own day only.
    """
    # Staged: the check of the days and the rows themselves both read the records.
    records = stage(extract_zone_prices(docs, [day], "doc", missing="skip"), "market-records")
    has = records.groupBy(day).agg(F.array_sort(F.array_except(F.array(*[F.lit(z) for z in zones]), F.collect_set("zone"))).alias("lacking"))
    judged = docs.select(day).distinct().join(has, day, "left")
    failed = judged.where(F.col("lacking").isNull() | (F.size("lacking") > 0)).select(
        day, F.when(F.col("lacking").isNull(), F.lit("no records")).otherwise(F.concat(F.lit("lacks "), F.array_join("lacking", ", "))).alias("reason")
    )
    return records.join(failed, day, "left_anti"), failed


def market_days(docs: DataFrame, zones: Sequence[str], tz: str, step_s: int = HOUR, day: str = "day") -> DataFrame:
    """Landed documents, one per market day, to price rows (zone, ts, ts_local, price); raises for a day that failed."""
    records, failed = landed_days(docs, zones, day)
    if bad := failed.limit(5).collect():
        raise ValueError(f"market days without prices: {[tuple(map(str, r)) for r in bad]}")
    return stamped_prices(records, zones, tz, step_s, day)


def stamped_prices(records: DataFrame, zones: Sequence[str], tz: str, step_s: int = HOUR, day: str = "day") -> DataFrame:
    """Records (day, position, zone, price) to price rows (zone, ts, ts_local, price)."""
    picked = records.where(F.col("zone").isin(*zones))
    # The n-th price of a zone within one document: a day's records at most.
    nth = F.row_number().over(Window.partitionBy(day, "zone").orderBy("position")) - 1
    stamped = picked.withColumn("_n", nth).select("zone", market_stamp(day, "_n", step_s, tz).alias("ts"), "price")
    return stamped.select("zone", "ts", to_local("ts", tz).alias("ts_local"), "price")


def market_update(
    prices: DataFrame, docs: DataFrame, zones: Sequence[str], target: Column, tz: str, step_s: int = HOUR
) -> tuple[DataFrame, DataFrame]:
    """History plus the landed documents of the missing days, and the due days (day, reason) that gave nothing.

    The last row per (zone, ts) stays. A day whose document is bad or has not landed stops no other.
    """
    due = stage(missing_dates(available_dates(prices, tz), zones, target), "due-days")
    landed = docs.join(due, "day", "left_semi")
    records, failed = landed_days(landed, zones)
    absent = due.join(docs.select("day"), "day", "left_anti").select("day", F.lit("not landed").alias("reason"))
    new = stamped_prices(records, zones, tz, step_s)
    current = upsert(prices, new.select(*[c for c in new.columns if c in prices.columns]), ["zone", "ts"])
    return current, failed.unionByName(absent)


def update_prices(prices: DataFrame, docs: DataFrame, zones: Sequence[str], target: Column, tz: str, step_s: int = HOUR) -> DataFrame:
    """The prices of :func:`market_update`; the days that failed are named in a warning."""
    current, failed = market_update(prices, docs, zones, target, tz, step_s)
    if bad := failed.limit(20).collect():
        warnings.warn(f"market days not landed: {[tuple(map(str, r)) for r in bad]}", stacklevel=2)
    return current


def forecast_prices(
    prices: DataFrame, dates: DataFrame, tz: str, window_days: int = DEFAULT_WINDOW_DAYS, rule: str = "auto",
    exog: Sequence[str] = (), weekday_tz: str | None = None, phases: Sequence[int] | None = None, days_per_group: int = 7,
) -> DataFrame:
    """Hourly forecasts of every (zone, forecast_date) of ``dates``, each from its own window.

    Many dates make a rolling back-test: the design is built once and every (zone, block of
    dates) is a separate task. ``phases``: UTC second at which local midnight falls; both clock
    settings of ``tz`` by default.
    """
    # The earliest requested date bounds the history that any window can reach: a literal, so the
    # scan prunes. ``dates`` is the request, one row per forecast.
    first = dates.agg(F.min("forecast_date")).first()[0]
    reach = F.date_sub(F.lit(first), window_days + WARMUP_DAYS + 1).cast("timestamp")
    recent = prices.where(F.col("ts") >= reach)
    design, anchors = design_and_anchors(recent, dates, tz, exog, weekday_tz, phases)
    models = fit_hourly(design, anchors, window_days, rule, days_per_group)
    return predict_hourly(design, models).withColumn("ts_local", to_local("ts", tz))


def midnight_phases(tz: str) -> Column:
    """Seconds after 00:00 UTC of local midnight in January and July, as an array of one or two."""
    at = [F.to_utc_timestamp(F.lit(d).cast("timestamp"), tz) for d in ("2024-01-15", "2024-07-15")]
    return F.array_distinct(F.array(*[F.pmod(F.unix_seconds(a), F.lit(86400)) for a in at]))


def design_and_anchors(
    prices: DataFrame, dates: DataFrame, tz: str, exog: Sequence[str] = (), weekday_tz: str | None = None, phases: Sequence[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Design rows of all day blocks, the forecast days' own included, and the forecast anchors."""
    clean = dedup_last(prices.select("zone", "ts", "price", *exog), ["zone", "ts"], ["price"])
    anchors = anchors_of(dates, tz)
    ahead = anchors.select(
        "zone",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.timestamp_seconds(
            F.col("day").cast("bigint") * 86400 + F.col("phase") + h * HOUR))).alias("ts"),
    ).withColumn("price", F.lit(None).cast("double"))
    # Forecast hours without a price stand in as empty rows; known prices stay for earlier dates
    # of a back-test, whose own day is never part of its training rows.
    with_ahead = clean.unionByName(ahead, allowMissingColumns=True)
    every = with_ahead.groupBy("zone", "ts").agg(*[F.max(c).alias(c) for c in ("price", *exog)])
    design = price_design(every, "zone", midnight_phases(tz) if phases is None else phases, exog, weekday_tz or tz)
    return design, anchors
