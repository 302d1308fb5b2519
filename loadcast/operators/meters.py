"""Meter readings to consumption balances.

Roles in the meter map: ``net`` (cabin transformers), ``pv_main``/``pv_backup`` (cumulative PV
energy), ``grid`` and ``chp`` (site supply), ``thermal``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import sum_min_count
from ..functions.timecols import QUARTER_HOUR
from .grid import bin_mean
from .ordered import RAW_CHUNK, previous_row

# Names of the electrical targets.
GROSS_PREFIX = "gross_el_cons_"
GROSS_TOTAL = "CONS_TOT_kW"
NET_TOTAL = "CONS_TOT_NET_kW"

SUPPLY_ROLES = ("grid", "chp")


def counter_to_power(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", energy: str = "value", power: str = "power", span: int = RAW_CHUNK
) -> DataFrame:
    """Cumulative kWh to kW: change in energy over elapsed hours since the reading before.

    NULL for the first reading, for a falling counter (reset) and where no time passed. Stamps
    are unique per series (see ``clean.dedup_first``).
    """
    prev = previous_row(df, keys, ts, [energy], span)
    gained = F.col(energy) - F.col(f"prev_{energy}")
    hours = (F.unix_micros(ts) - F.unix_micros(f"prev_{ts}")) / F.lit(3.6e9)
    return prev.withColumn(power, F.when((gained >= 0) & (hours > 0), gained / hours)).drop(
        f"prev_{energy}", f"prev_{ts}"
    )


def net_sum_of_means(df: DataFrame, group: Sequence[str], meter: str, ts: str = "ts", value: str = "value", step: int = QUARTER_HOUR) -> DataFrame:
    """Bin mean per meter, then the null-tolerant sum over the group's meters (the default)."""
    per_meter = bin_mean(df, [*group, meter], ts, value, step)
    return per_meter.groupBy(*group, ts).agg(F.sum(value).alias("net"))


def net_mean_of_sums(df: DataFrame, group: Sequence[str], meter: str, ts: str = "ts", value: str = "value", step: int = QUARTER_HOUR) -> DataFrame:
    """Mean per duplicate stamp, sum over meters per stamp, then the bin mean."""
    per_stamp = df.groupBy(*group, meter, ts).agg(F.avg(value).alias(value))
    summed = per_stamp.groupBy(*group, ts).agg(F.sum(value).alias(value))
    return bin_mean(summed, group, ts, value, step).withColumnRenamed(value, "net")


def align(df: DataFrame, keys: Sequence[str], series: str, names: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Full outer alignment of N series on time: one pivot over (key, ts), not N joins."""
    return df.groupBy(*keys, ts).pivot(series, list(names)).agg(F.max(value))


def join_weather(targets: DataFrame, weather: DataFrame, keys: Sequence[str] = ("site_id",), ts: str = "ts") -> DataFrame:
    return targets.join(weather, [*keys, ts], "full")


def pair_meters(meter_map: DataFrame, main: str = "pv_main", backup: str = "pv_backup") -> DataFrame:
    """Main and backup meters side by side by list position; the longer list decides."""

    def side(role: str, name: str) -> DataFrame:
        return meter_map.where(F.col("role") == role).select(
            "site_id", "cabin", "position", F.col("variable_id").alias(name)
        )

    return side(main, "main_id").join(side(backup, "backup_id"), ["site_id", "cabin", "position"], "full")


def prefer_main(df: DataFrame, keys: Sequence[str], role: str = "role", value: str = "value", main: str = "pv_main", backup: str = "pv_backup") -> DataFrame:
    """Main value per key, the backup's only where the main is NULL or absent."""
    return df.groupBy(*keys).agg(
        F.coalesce(
            F.max(F.when(F.col(role) == main, F.col(value))), F.max(F.when(F.col(role) == backup, F.col(value)))
        ).alias(value)
    )


def pv_sum(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Sum of PV systems; NULL only where every system is NULL."""
    return df.groupBy(*keys).agg(F.sum(value).alias("pv"))


def residual(df: DataFrame, keys: Sequence[str], role: str = "role", value: str = "value") -> DataFrame:
    """Supply minus measured net cabins; NULL when either side has no value at all."""
    supply = F.when(F.col(role).isin(*SUPPLY_ROLES), F.col(value))
    net = F.when(F.col(role) == "net", F.col(value))
    return df.groupBy(*keys).agg((F.sum(supply) - F.sum(net)).alias("residual"))


def gross(net: Column, pv: Column, has_pv: Column) -> Column:
    """Net plus PV; a group without any PV system is its net, one with a missing PV value is NULL."""
    return F.when(has_pv, net + pv).otherwise(net)


def totals(df: DataFrame, keys: Sequence[str], role: str = "role", value: str = "value", gross_min: int = 1, net_min: int = 1) -> DataFrame:
    """Gross total over cabins and net total over the supply, each with a minimum known count."""
    return df.groupBy(*keys).agg(
        sum_min_count(F.when(F.col(role) == "gross", F.col(value)), gross_min).alias(GROSS_TOTAL),
        sum_min_count(F.when(F.col(role).isin(*SUPPLY_ROLES), F.col(value)), net_min).alias(NET_TOTAL),
    )

