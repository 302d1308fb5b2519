"""Duplicate rules, row filters and coverage guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import DAY, epoch_s


def _rank(df: DataFrame, order: Sequence[str], unknown: float) -> Column:
    """What rows of a key are ordered by; never NULL, since min_by and max_by pass over rows with a NULL rank.

    A single number gets ``unknown`` for NULL and stays in hash aggregation; anything else is a struct.
    """
    if len(order) == 1 and isinstance(df.schema[order[0]].dataType, (T.DoubleType, T.FloatType)):
        return F.coalesce(F.col(order[0]).cast("double"), F.lit(unknown))
    flags = [F.col(c).isNull() if unknown > 0 else F.col(c).isNotNull() for c in order]
    return F.struct(*[x for pair in zip(flags, order) for x in pair])


def _one_per_key(df: DataFrame, keys: Sequence[str], pick, order: Sequence[str], unknown: float) -> DataFrame:
    rank = _rank(df, order, unknown)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[pick(F.col(c), rank).alias(c) for c in rest]).select(*df.columns)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key. ``order`` makes the choice unique; unknown order values come last.

    An aggregate, not a row number: copies of one key collapse before the shuffle.
    """
    return _one_per_key(df, keys, F.min_by, order, float("inf"))


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key (the upsert rule); unknown order values come first."""
    return _one_per_key(df, keys, F.max_by, order, float("-inf"))


def dedup_mean(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def exclude_windows(
    df: DataFrame, min_ts: str | None = None, windows: Sequence[tuple[str | None, str | None]] = (), ts: str = "ts"
) -> DataFrame:
    """Lower bound plus inclusive bad-data windows; either end of a window may be open."""
    out = df if min_ts is None else df.where(F.col(ts) >= F.lit(min_ts).cast("timestamp"))
    for start, end in windows:
        if start is None and end is None:
            continue
        if start is not None and end is not None and start > end:
            raise ValueError(f"bad window runs backwards: {start} > {end}")
        inside = F.lit(True)
        if start is not None:
            inside = inside & (F.col(ts) >= F.lit(start).cast("timestamp"))
        if end is not None:
            inside = inside & (F.col(ts) <= F.lit(end).cast("timestamp"))
        out = out.where(~inside)
    return out


# Span that bad windows and readings meet in.
WINDOW_BUCKET = DAY


def merged_windows(windows: DataFrame, keys: Sequence[str], start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Closed windows per key without overlaps: those that meet or overlap become one. Raises for one that runs backwards.

    A running maximum per key over its windows, so a key's windows are sorted in one task; they are entries of a
    maintenance list, not readings.
    """
    order = Window.partitionBy(*keys).orderBy(start, end)
    backwards = F.col(start) > F.col(end)
    closed = windows.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        *keys, start, F.when(backwards, F.raise_error(F.concat(F.lit("bad window runs backwards: "), F.col(start).cast("string")))).otherwise(F.col(end)).alias(end)
    )
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = closed.withColumn("_begins", F.when(before >= F.col(start), 0).otherwise(1))
    numbered = opened.select(*keys, start, end, F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_island"))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def exclude_window_table(
    df: DataFrame, windows: DataFrame, keys: Sequence[str], ts: str = "ts", start: str = "start_ts", end: str = "end_ts", span: int = WINDOW_BUCKET
) -> DataFrame:
    """Rows of ``df`` that lie in no window of their key; both ends are included.

    ``windows``: (keys, start, end), any number per key, overlapping or not. A null start reaches back without end, a null
    end forward; a window without both is no window, as in :func:`exclude_windows`. A row without stamp stays.

    Windows are merged per key and meet the rows by (key, time bucket), an equality, so no row is held against all
    windows and a hot key is spread over its buckets. Open ends are two bounds per key.
    """
    keys = list(keys)
    whole = windows.select(*keys, F.col(start).alias("_from"), F.col(end).alias("_to"))
    bounds = whole.where(F.col("_from").isNull() != F.col("_to").isNull()).groupBy(*keys).agg(
        F.max(F.when(F.col("_from").isNull(), F.col("_to"))).alias("_past"), F.min(F.when(F.col("_to").isNull(), F.col("_from"))).alias("_ahead")
    )
    inside = (F.col(ts) <= F.col("_past")) | (F.col(ts) >= F.col("_ahead"))
    kept = df.join(bounds, keys, "left").where(~F.coalesce(inside, F.lit(False))).select(*df.columns)
    bucket = lambda c: F.floor(epoch_s(c) / F.lit(span))
    held = merged_windows(whole, keys, "_from", "_to").select(
        *[F.col(k).alias(f"_w_{k}") for k in keys], "_from", "_to", F.explode(F.sequence(bucket("_from"), bucket("_to"))).alias("_in")
    )
    same = bucket(ts) == F.col("_in")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_w_{k}"))
    return kept.join(held, same & (F.col(ts) >= F.col("_from")) & (F.col(ts) <= F.col("_to")), "left_anti")


def complete(cols: Sequence[str]) -> Column:
    """Every column is known."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.where(complete(cols or df.columns))


def incomplete_counts(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows before and after :func:`drop_incomplete`, in one pass."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(complete(cols)).alias("rows_after")
    )


def valid_rows(df: DataFrame, features: Sequence[str], target: str, nonzero: bool = False) -> DataFrame:
    ok = complete([*features, target])
    return df.where(ok & (F.col(target) != 0) if nonzero else ok)


def null_profile(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Null count per column, one pass over the data, one row per (key, column)."""
    counts = df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot(list(keys), list(cols), "column_name", "n_null")


def history_coverage(df: DataFrame, keys: Sequence[str], required_from: Column, required_to: Column, ts: str = "ts") -> DataFrame:
    """Per series: rows, bounds, and whether the bounds reach the required ones."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    ).withColumn(
        "covered", ((F.col("first_ts") <= required_from) & (F.col("last_ts") >= required_to)).cast("int")
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when nothing is left; reads one row at most."""
    if df.isEmpty():
        raise ValueError(f"no rows left: {what}")
    return df


def discover_targets(columns: Sequence[str], prefix: str, totals: Sequence[str] = ()) -> list[str]:
    """Target columns of a wide table: those with the prefix, then the fixed totals present."""
    found = [c for c in columns if c.startswith(prefix)] + [c for c in totals if c in columns]
    if not found:
        raise ValueError(f"no target column starts with {prefix!r}")
    return found


def feature_projection(df: DataFrame, targets: Sequence[str], drop: Sequence[str] = ("ts_local", "month", "day_of_week", "quarter_hour")) -> DataFrame:
    """Drop raw calendar integers, local time and every target."""
    gone = {*targets, *drop}
    return df.select(*[c for c in df.columns if c not in gone])


def conform(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Select the model's features in their saved order; missing ones are named in the error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing model features: {missing}")
    return df.select(*keep, *names)
