"""Lag features: by rows, by exact time, and onto a future horizon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import HOUR, QUARTER_HOUR, epoch_s, shift
from .ordered import exact_lags, row_position

# Default lags in hours.
DEFAULT_LAGS = (48, 72, 96, 120, 144, 168)


def lag_name(hours: int) -> str:
    return f"lag_{hours}h"


def lag_time(df: DataFrame, keys: Sequence[str], value: str = "y", hours: Sequence[int] = DEFAULT_LAGS, ts: str = "ts") -> DataFrame:
    """Value exactly h hours earlier, else NULL; every lag from one shuffle."""
    return exact_lags(df, keys, epoch_s(ts), {lag_name(h): (value, h * HOUR) for h in hours})


def lag_time_join(df: DataFrame, keys: Sequence[str], hours: int, value: str = "y", ts: str = "ts") -> DataFrame:
    """Single time lag as an equi-join on the shifted stamp."""
    earlier = df.select(*keys, shift(ts, hours * HOUR).alias(ts), F.col(value).alias(lag_name(hours)))
    return df.join(earlier, [*keys, ts], "left")


def lag_rows(
    df: DataFrame, keys: Sequence[str], value: str = "y", hours: Sequence[int] = DEFAULT_LAGS, ts: str = "ts", step: int = QUARTER_HOUR
) -> DataFrame:
    """Value h hours' worth of rows earlier: across removed rows it reaches further back."""
    per_hour = HOUR // step
    numbered = row_position(df, keys, ts, pos="_pos", size=None)
    return exact_lags(
        numbered, keys, F.col("_pos"), {lag_name(h): (value, h * per_hour) for h in hours}
    ).drop("_pos")


def lag_onto_horizon(
    history: DataFrame, horizon: DataFrame, keys: Sequence[str], value: str = "y", hours: Sequence[int] = DEFAULT_LAGS, ts: str = "ts"
) -> DataFrame:
    """History values h hours before each horizon stamp; only horizon rows come back."""
    both = history.select(*keys, ts, value, F.lit(False).alias("_ahead")).unionByName(
        horizon.select(*keys, ts, F.lit(None).cast("double").alias(value), F.lit(True).alias("_ahead"))
    )
    # A stamp in both parts keeps its known value and still counts as horizon.
    merged = both.groupBy(*keys, ts).agg(F.max(value).alias(value), F.max("_ahead").alias("_ahead"))
    return lag_time(merged, keys, value, hours, ts).where("_ahead").drop("_ahead", value)
