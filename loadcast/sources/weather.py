"""Regular weather blocks: start, end, step and parallel value arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..functions.timecols import epoch_s

# The weather variables, in block order.
WEATHER_COLUMNS = ("temperature_2m", "relative_humidity_2m", "dew_point_2m", "direct_normal_irradiance")


def explode_regular_block(
    blocks: DataFrame, keys: Sequence[str] = ("site_id",), values: Sequence[str] = WEATHER_COLUMNS,
    start: str = "start_ts", end: str = "end_ts", step: str = "step_s",
) -> DataFrame:
    """One row per step of each block, end exclusive. No shuffle."""
    rows = blocks.select(*keys, start, end, step, F.posexplode(F.arrays_zip(*values)).alias("_pos", "_v"))
    at = F.timestamp_seconds(epoch_s(start) + F.col("_pos").cast("bigint") * F.col(step))
    return rows.select(*keys, at.alias("ts"), end, *[nan_to_null(F.col("_v")[v]).alias(v) for v in values]).where(
        F.col("ts") < F.col(end)
    ).drop(end)
