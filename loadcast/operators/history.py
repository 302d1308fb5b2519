"""Keeping history tables current."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import HOUR, QUARTER_HOUR, local_date, shift
from .clean import dedup_last


def append_block(history: DataFrame, new: DataFrame) -> DataFrame:
    """Append a block whose columns may differ; absent ones are NULL."""
    return history.unionByName(new, allowMissingColumns=True)


def upsert(history: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Append and keep the last row per key: any new row beats history.

    Within one side, ``order`` decides; keys are unique per side when it is empty.
    """
    both = append_block(history.withColumn("_batch", F.lit(0)), new.withColumn("_batch", F.lit(1)))
    return dedup_last(both, keys, ["_batch", *order]).drop("_batch")


def available_dates(prices: DataFrame, tz: str, zone: str = "zone", ts: str = "ts") -> DataFrame:
    """Distinct local dates present per zone."""
    return prices.where(F.col(ts).isNotNull()).select(zone, local_date(ts, tz).alias("day")).distinct()


def common_dates(dates: DataFrame, zones: Sequence[str], zone: str = "zone") -> DataFrame:
    """Dates present in every listed zone."""
    out = None
    for z in zones:
        one = dates.where(F.col(zone) == z).select("day")
        out = one if out is None else out.intersect(one)
    return out


def latest_common(dates: DataFrame, zones: Sequence[str], zone: str = "zone") -> DataFrame:
    return common_dates(dates, zones, zone).agg(F.max("day").alias("latest_common"))


def missing_dates(dates: DataFrame, zones: Sequence[str], target: Column, zone: str = "zone") -> DataFrame:
    """Dates after the latest common one, up to the target, that some zone lacks.

    Nothing when the latest common date has reached the target; only the target when no date is
    common.
    """
    common = common_dates(dates, zones, zone)
    bounds = common.agg(F.max("day").alias("latest")).select(
        F.coalesce(F.date_add("latest", 1), target).alias("first"), target.alias("last")
    )
    wanted = bounds.where(F.col("first") <= F.col("last")).select(
        F.explode(F.sequence("first", "last")).alias("day")
    )
    return wanted.exceptAll(common)


def future_rows(series: DataFrame, start: Column, n: int, step_s: int = HOUR, ts: str = "ts", value: str = "price") -> DataFrame:
    """n empty rows from ``start`` for every row of ``series``."""
    return series.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i")).select(
        *series.columns, shift(start, F.col("_i") * step_s).alias(ts), F.lit(None).cast("double").alias(value)
    )


def with_future_rows(prices: DataFrame, keys: Sequence[str], start: Column, n: int = 24, ts: str = "ts", value: str = "price") -> DataFrame:
    """Prices plus n empty future rows per series; a future row replaces a known one."""
    ahead = future_rows(prices.select(*keys).distinct(), start, n, ts=ts, value=value)
    return upsert(prices.select(*keys, ts, value), ahead, [*keys, ts])


def next_window(
    history: DataFrame, keys: Sequence[str], now: Column, tz: str, delay_days: int = 2, init_days: int = 365, ts: str = "ts", step: int = QUARTER_HOUR
) -> DataFrame:
    """Start and end of the next block to fetch per series; series already current are left out.

    Starts one step after the last stamp, or at local midnight ``init_days`` back for a series
    without any. Ends at the last quarter-hour of the local day ``delay_days`` back.
    """
    today = local_date(now, tz)
    end_local = shift(F.date_add(F.date_sub(today, delay_days), 1).cast("timestamp"), -step)
    first_local = F.date_sub(today, init_days).cast("timestamp")
    return (
        history.groupBy(*keys)
        .agg(F.max(ts).alias("_last"))
        .select(
            *keys,
            F.coalesce(shift("_last", step), F.to_utc_timestamp(first_local, tz)).alias("window_start"),
            F.to_utc_timestamp(end_local, tz).alias("window_end"),
        )
        .where(F.col("window_start") <= F.col("window_end"))
    )


def zone_prices(prices: DataFrame, zones: Sequence[str], zone: str = "zone", per: Sequence[str] = ()) -> DataFrame:
    """Rows of the chosen zones; raises when one of them has none (in any group of ``per``)."""
    counts = prices.groupBy(*per).agg(*[F.count_if(F.col(zone) == z).alias(z) for z in zones])
    lacking = counts.where(F.least(F.lit(1), *[F.col(f"`{z}`") for z in zones]) == 0).limit(5).collect()
    if lacking:
        raise ValueError(f"zones without prices: {[{k: v for k, v in r.asDict().items() if k in per or v == 0} for r in lacking]}")
    return prices.where(F.col(zone).isin(*zones))


def params_for(targets: DataFrame, params: DataFrame, on: Sequence[str] = ("target",)) -> DataFrame:
    """Stored parameters per model; raises when one has none. Both sides hold one row per model."""
    on = list(on)
    lacking = targets.join(params, on, "left_anti").limit(5).collect()
    if lacking:
        raise ValueError(f"no stored parameters for {[tuple(r[c] for c in on) for r in lacking]}")
    return targets.join(params, on)


def scorable(panel: DataFrame, models: DataFrame, on: str | Sequence[str] = "target") -> tuple[DataFrame, DataFrame]:
    """Models whose series has history, and models whose series has none; ``on`` names what a model is keyed by."""
    on = [on] if isinstance(on, str) else list(on)
    have = panel.select(*on).distinct()
    return models.join(have, on, "left_semi"), models.join(have, on, "left_anti")
