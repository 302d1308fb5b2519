"""Regular grids: resampling, reindexing, time windows and local-day horizons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import DAY, QUARTER_HOUR, epoch_s, floor_to
from ..session import stage
from .ordered import series_bounds


def bin_mean(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", step: int = QUARTER_HOUR) -> DataFrame:
    """Mean per (series, bin); bins without readings are absent."""
    return df.groupBy(*keys, floor_to(ts, step).alias(ts)).agg(F.avg(value).alias(value))


def spine(bounds: DataFrame, keys: Sequence[str], first: str, last: str, ts: str = "ts", step: int = QUARTER_HOUR) -> DataFrame:
    """Every stamp first, first + step, ... up to last, for each row of ``bounds``.

    Generated by day and then within the day, so no array spans a whole series.
    """
    per_day = max(DAY // step, 1)
    by = [f"`{k}`" for k in keys]
    return (
        bounds.where(f"`{first}` <= `{last}`")
        .selectExpr(*by, f"unix_seconds(`{first}`) AS _a", f"(unix_seconds(`{last}`) - unix_seconds(`{first}`)) div {step} AS _n")
        .selectExpr(*by, "_a", "_n", f"explode(sequence(0, _n div {per_day})) AS _day")
        .selectExpr(*by, "_a", f"explode(sequence(_day * {per_day}, least(_n, (_day + 1) * {per_day} - 1))) AS _k")
        .selectExpr(*by, f"timestamp_seconds(_a + _k * {step}) AS `{ts}`")
    )


def to_grid(df: DataFrame, keys: Sequence[str], ts: str = "ts", step: int = QUARTER_HOUR) -> DataFrame:
    """Reindex each series to the continuous grid between its own first and last stamp."""
    own = spine(series_bounds(df, keys, ts), keys, "first_ts", "last_ts", ts, step)
    return own.join(df, [*keys, ts], "left")


def resample_mean(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", step: int = QUARTER_HOUR) -> DataFrame:
    """Left-closed, left-labelled bin means; empty bins inside a series' range exist as NULL.

    The readings are reduced to bins once; the grid reads the kept bins for its bounds and for its values.
    """
    return to_grid(stage(bin_mean(df, keys, ts, value, step), "bins"), keys, ts, step)


def between_ts(df: DataFrame, start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Rows of the inclusive window; a plain predicate that reaches the scan."""
    return df.where((F.col(ts) >= start) & (F.col(ts) <= end))


def local_day_bounds(day: Column, tz: str, step: int = QUARTER_HOUR) -> tuple[Column, Column]:
    """UTC instants of the first and last grid stamp of a local calendar day."""
    start = F.to_utc_timestamp(day.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), tz)
    return start, F.timestamp_seconds(F.unix_seconds(end) - step)


def local_day(df: DataFrame, day: str, tz: str, ts: str = "ts") -> DataFrame:
    """Rows of one local day. The bounds are literals in UTC, so partitions and files prune."""
    d = F.lit(day).cast("date")
    start = F.to_utc_timestamp(d.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(d, 1).cast("timestamp"), tz)
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def day_horizon(keys_df: DataFrame, keys: Sequence[str], day: Column, tz: str, ts: str = "ts", step: int = QUARTER_HOUR) -> DataFrame:
    """The grid of one local day for each key row: 92, 96 or 100 stamps at 15 minutes."""
    start, end = local_day_bounds(day, tz, step)
    return spine(keys_df.withColumns({"_first": start, "_last": end}), keys, "_first", "_last", ts, step)


def day_starts(df: DataFrame, keys: Sequence[str], anchor: Column, ts: str = "ts") -> DataFrame:
    """Rows a whole number of days before (or after) the anchor instant.

    Counted in hours from the anchor rather than in rows, so a missing hour does not move the
    days before it.
    """
    return df.where(F.pmod(F.unix_seconds(anchor) - epoch_s(ts), F.lit(DAY)) == 0)
