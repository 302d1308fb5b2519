"""Gap filling on gridded series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.timecols import QUARTER_HOUR
from .ordered import GRID_CHUNK, known_neighbours


def fill_linear(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    ts: str = "ts",
    step: int = QUARTER_HOUR,
    limit: int | None = None,
    both: bool = False,
    span: int = GRID_CHUNK,
) -> DataFrame:
    """Linear fill between known neighbours of a gridded series.

    ``limit``: fill at most that many steps after a known value (a longer gap keeps its rest).
    A gap at the end repeats the last value, under the same limit. ``both``: a gap at the start
    takes the first value; otherwise it stays NULL. On a grid, steps and elapsed time agree, so
    this serves fills by position and fills by time alike.
    """
    near = known_neighbours(df, keys, ts, cols, span)
    at = f"unix_seconds(`{ts}`)"

    def filled(c: str) -> str:
        pt, pv, nt, nv = (f"`_{k}_{c}`" for k in ("pt", "pv", "nt", "nv"))
        value = f"CASE WHEN {nt} IS NULL THEN {pv} ELSE {pv} + ({nv} - {pv}) * (({at} - {pt}) / ({nt} - {pt})) END"
        if limit is not None:
            value = f"CASE WHEN ({at} - {pt}) / {step} <= {limit} THEN {value} END"
        start = nv if both else "NULL"
        return f"CASE WHEN `{c}` IS NOT NULL THEN `{c}` WHEN {pt} IS NULL THEN {start} ELSE {value} END AS `{c}`"

    return near.selectExpr(*[filled(c) if c in cols else f"`{c}`" for c in df.columns])


def fill_time(df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str = "ts", span: int = GRID_CHUNK) -> DataFrame:
    """Fill by elapsed time in both directions; edges take the nearest value."""
    return fill_linear(df, keys, cols, ts, limit=None, both=True, span=span)
