"""Meter readings, meter maps and the null grid of silent meters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..functions.timecols import QUARTER_HOUR, floor_to, from_epoch_ms
from ..operators.grid import bin_mean, spine

READINGS_SCHEMA = "site_id string, variable_id string, ts timestamp, value double"
METER_MAP_SCHEMA = "site_id string, cabin string, role string, position int, variable_id string"


def scan_readings(readings: DataFrame, ids: Sequence[str], start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Readings of the listed meters in the inclusive window.

    Two plain predicates, so both reach the file scan. No row limit: every reading of the window
    is returned.
    """
    return readings.where(F.col("variable_id").isin(*ids) & (F.col(ts) >= start) & (F.col(ts) <= end))


def from_records(records: DataFrame) -> DataFrame:
    """Rows ``(variable_id, samples ARRAY<STRUCT<timestamp BIGINT, value DOUBLE>>)`` -> readings."""
    flat = records.select(*[c for c in records.columns if c != "samples"], F.explode("samples").alias("s"))
    return flat.select(
        *[c for c in records.columns if c != "samples"],
        from_epoch_ms("s.timestamp").alias("ts"),
        nan_to_null("s.value").alias("value"),
    )


def series_or_null_grid(
    readings: DataFrame, meters: DataFrame, start: Column, end: Column, keys: Sequence[str] = ("variable_id",), step: int = QUARTER_HOUR
) -> DataFrame:
    """Bin means of each listed meter on the grid of the window; a silent meter is all NULL."""
    window = meters.select(*keys).distinct().withColumns({"_a": floor_to(start, step), "_b": floor_to(end, step)})
    grid = spine(window, keys, "_a", "_b", "ts", step)
    means = bin_mean(readings.where((F.col("ts") >= start) & (F.col("ts") <= end)), keys, "ts", "value", step)
    return grid.join(means, [*keys, "ts"], "left")
