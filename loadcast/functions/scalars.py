"""Null-safe numeric expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecols import _col, to_local


def to_num(c: Column | str) -> Column:
    """Text to DOUBLE; NULL where the text is no number. NaN becomes NULL."""
    v = _col(c).try_cast("double")
    return F.when(F.isnan(v), F.lit(None)).otherwise(v)


def nan_to_null(c: Column | str) -> Column:
    v = _col(c)
    return F.when(F.isnan(v), F.lit(None)).otherwise(v)


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` would skip it)."""
    v = _col(c)
    out = v
    if hi is not None:
        out = F.when(v > hi, F.lit(float(hi))).otherwise(out)
    if lo is not None:
        out = F.when(v < lo, F.lit(float(lo))).otherwise(out)
    return out


def zero_in_months(c: Column | str, ts: Column | str, months: Iterable[int], tz: str) -> Column:
    """0.0 in the given local months, even where the value is NULL."""
    return F.when(F.month(to_local(ts, tz)).isin(*months), F.lit(0.0)).otherwise(_col(c))


def row_sum(cols: Iterable[Column | str], min_count: int = 1) -> Column:
    """Sum of the non-null columns, NULL when fewer than ``min_count`` are non-null."""
    cs = [_col(c) for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs[1:]), F.coalesce(cs[0], F.lit(0.0)))
    known = sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int"))
    return F.when(known >= min_count, total)


def sum_min_count(c: Column | str, min_count: int = 1) -> Column:
    """Aggregate counterpart of :func:`row_sum`."""
    v = _col(c)
    return F.when(F.count(v) >= min_count, F.sum(v))
