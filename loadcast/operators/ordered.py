"""Ordered-series primitives that hold when one series carries most of the rows.

A plain ``Window.partitionBy(series).orderBy(ts)`` puts a whole series into one task. Here a
window is always partitioned by (series, chunk), where a chunk is a fixed span of the order
column, so its size is bounded by span / resolution whatever the length of the series. What a
row needs from other chunks arrives in one of two ways:

* bounded reach (lags): the rows of the reach are copied into the chunk they are needed in;
* unbounded reach (previous value, next value, row position): one summary row per chunk is
  computed by partial aggregation, carried along the chunks, and joined back on (series, chunk).

Slow readings in fine chunks make the summary as long as the series, so summaries are carried as a
tree: blocks of chunks are summed up in turn, and no window holds more than one block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import DAY, HOUR, epoch_s

# Chunk span for series on a regular grid: 28 days = 2,688 rows at 15 minutes.
GRID_CHUNK = 28 * DAY
# Chunk span for raw readings with millisecond stamps: at most 3.6 million rows after
# duplicate removal.
RAW_CHUNK = HOUR

# Chunks per block of the tree that carries summaries, and the length of series that one top block covers.
FAN = 1024
LONGEST = 64 * 365 * DAY

_CHUNK = "_chunk"

# What a chunk takes from the others, in SQL: order of the window, value over its frame, summary of a block, and how
# what comes from the own block (a) and from other blocks (b) combine.
_KNOWN = "FILTER (WHERE {x} IS NOT NULL)"
_TAKES = {
    "before": ("ASC", "last({x}, true)", "max_by({x}, _chunk) " + _KNOWN, "coalesce({a}, {b})"),
    "after": ("DESC", "last({x}, true)", "min_by({x}, _chunk) " + _KNOWN, "coalesce({a}, {b})"),
    "sum_before": ("ASC", "sum({x})", "sum({x})", "coalesce({a}, 0) + coalesce({b}, 0)"),
    "sum_after": ("DESC", "sum({x})", "sum({x})", "coalesce({a}, 0) + coalesce({b}, 0)"),
}


def chunk_of(order: Column, span: int) -> Column:
    return F.floor(order / F.lit(span)).cast("bigint")


def _in_chunk(keys: Sequence[str], order: Column):
    return Window.partitionBy(*keys, _CHUNK).orderBy(order)


def carry(summary: DataFrame, keys: Sequence[str], takes: Mapping[str, tuple[str, str]], span: int) -> DataFrame:
    """(keys, chunk, names): what every chunk takes from the other chunks of its series.

    ``summary`` has one row per (series, chunk of ``span``); ``takes`` names the results: ``before`` and ``after`` give
    the nearest known value of a column among earlier and later chunks, ``sum_before`` and ``sum_after`` the sums over
    them (0 without any). A window holds one block of ``FAN`` chunks; blocks are carried in the same way, up to one block per series.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    wide = span * FAN < LONGEST
    within = f"{by}, _block" if wide else by
    placed = summary.withColumn("_block", F.expr(f"{_CHUNK} div {FAN} - int({_CHUNK} % {FAN} < 0)")) if wide else summary

    def own(name: str) -> str:
        kind, x = takes[name]
        way, value = _TAKES[kind][:2]
        frame = f"(PARTITION BY {within} ORDER BY {_CHUNK} {way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return f"{value.format(x=f'`{x}`')} OVER {frame} AS `_own_{name}`"

    inner = placed.selectExpr(*[f"`{k}`" for k in keys], _CHUNK, *(["_block"] if wide else []), *[own(n) for n in takes])
    if not wide:
        # Without blocks nothing comes from elsewhere.
        return inner.selectExpr(
            *[f"`{k}`" for k in keys], _CHUNK,
            *[f"{_TAKES[kind][3].format(a=f'`_own_{n}`', b='NULL')} AS `{n}`" for n, (kind, _) in takes.items()],
        )
    sums = {x: _TAKES[kind][2].format(x=f"`{x}`") for kind, x in takes.values()}
    blocks = placed.groupBy(*keys, F.col("_block").alias(_CHUNK)).agg(*[F.expr(e).alias(x) for x, e in sums.items()])
    others = carry(blocks, keys, takes, span * FAN).selectExpr(
        *[f"`{k}`" for k in keys], f"{_CHUNK} AS _block", *[f"`{n}` AS `_far_{n}`" for n in takes]
    )
    return inner.join(others, [*keys, "_block"], "left").selectExpr(
        *[f"`{k}`" for k in keys], _CHUNK,
        *[f"{_TAKES[kind][3].format(a=f'`_own_{n}`', b=f'`_far_{n}`')} AS `{n}`" for n, (kind, _) in takes.items()],
    )


def exact_lags(
    df: DataFrame,
    keys: Sequence[str],
    order: Column,
    lags: Mapping[str, tuple[str, int]],
    span: int | None = None,
) -> DataFrame:
    """Add ``{name: value of column c at exactly order - offset, else NULL}`` for each (c, offset).

    ``order`` is an integer expression, unique per series (epoch seconds, day or row number).
    One shuffle serves every lag: each row goes to its own chunk and, as a thin copy with its
    other columns left empty, to the chunks within the longest offset after it.
    """
    reach = max(offset for _, offset in lags.values())
    span = span or 4 * reach
    needed = {c for c, _ in lags.values()} | set(keys)
    placed = (
        df.withColumn("_order", order.cast("bigint"))
        .withColumn("_home", chunk_of(F.col("_order"), span))
        .withColumn(
            _CHUNK, F.explode(F.sequence(F.col("_home"), chunk_of(F.col("_order") + F.lit(reach), span)))
        )
    )
    own = F.col(_CHUNK) == F.col("_home")
    thin = placed.select(
        *[F.col(c) if c in needed else F.when(own, F.col(c)).alias(c) for c in df.columns],
        "_order", _CHUNK, own.alias("_own"),
    )
    w = _in_chunk(keys, F.col("_order"))
    lagged = thin.select(
        "*", *[F.first(c).over(w.rangeBetween(-o, -o)).alias(name) for name, (c, o) in lags.items()]
    )
    return lagged.where("_own").select(*df.columns, *lags)


def previous_row(
    df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], span: int = RAW_CHUNK
) -> DataFrame:
    """Add ``prev_<c>`` (and ``prev_<ts>``): the values of the row just before, NULLs included.

    ``ts`` is unique per series.
    """
    names = [ts, *[c for c in cols if c != ts]]
    placed = df.withColumn(_CHUNK, chunk_of(epoch_s(ts), span))
    # max_by keeps a NULL value of the last row, which is what the row before means.
    last = placed.groupBy(*keys, _CHUNK).agg(F.max_by(F.struct(*names), ts).alias("_last"))
    carried = carry(last, keys, {"_c": ("before", "_last")}, span)
    w = _in_chunk(keys, F.col(ts))
    return (
        placed.join(carried, [*keys, _CHUNK], "left")
        .select("*", (F.row_number().over(w) == 1).alias("_first"), *[F.lag(c).over(w).alias(f"_l_{c}") for c in names])
        .select(
            *df.columns,
            *[F.when(F.col("_first"), F.col("_c")[c]).otherwise(F.col(f"_l_{c}")).alias(f"prev_{c}") for c in names],
        )
    )


def known_neighbours(
    df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], span: int = GRID_CHUNK
) -> DataFrame:
    """Add, per column, the nearest known value at or before and at or after each row.

    New columns: ``_pt_<c>``/``_pv_<c>`` (stamp in epoch seconds and value before) and
    ``_nt_<c>``/``_nv_<c>`` (after).
    """
    at = f"unix_seconds(`{ts}`)"
    by = ", ".join(f"`{k}`" for k in keys)
    seen = {c: f"CASE WHEN `{c}` IS NOT NULL THEN {at} END" for c in cols}
    placed = df.withColumn(_CHUNK, chunk_of(F.expr(at), span))
    # One struct of (stamp, value) per column and side, NULL where the chunk knows no value.
    edges = placed.groupBy(*keys, _CHUNK).agg(
        *[
            F.expr(f"{pick}_by(struct({at} AS t, `{c}` AS v), {seen[c]}) AS `_{side}_{c}`")
            for c in cols for side, pick in (("p", "max"), ("n", "min"))
        ]
    )
    takes = {f"_c{d}_{c}": (kind, f"_{d}_{c}") for c in cols for d, kind in (("p", "before"), ("n", "after"))}
    carried = carry(edges, keys, takes, span)
    # Descending windows serve the look ahead: a frame that grows is read once.
    rows = {
        "p": f"OVER (PARTITION BY {by}, {_CHUNK} ORDER BY `{ts}` ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "n": f"OVER (PARTITION BY {by}, {_CHUNK} ORDER BY `{ts}` DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    }
    return placed.join(carried, [*keys, _CHUNK], "left").selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[
            f"coalesce(last({value}, true) {w}, `_c{d}_{c}`.{k}) AS `_{d}{k}_{c}`"
            for c in cols
            for d, w in rows.items()
            for k, value in (("t", seen[c]), ("v", f"`{c}`"))
        ],
    )


def row_position(
    df: DataFrame, keys: Sequence[str], ts: str, span: int = GRID_CHUNK, pos: str = "pos", size: str | None = "n_rows"
) -> DataFrame:
    """Add the zero-based position of each row in its series and the series' row count.

    ``ts`` is unique per series.
    """
    placed = df.withColumn(_CHUNK, chunk_of(epoch_s(ts), span))
    counts = placed.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = carry(counts, keys, {"_offset": ("sum_before", "_n"), "_rest": ("sum_after", "_n")}, span)
    out = placed.join(offsets, [*keys, _CHUNK]).withColumn(
        pos, F.row_number().over(_in_chunk(keys, F.col(ts))).cast("bigint") - 1 + F.col("_offset")
    )
    if size:
        out = out.withColumn(size, F.col("_offset") + F.count(F.lit(1)).over(Window.partitionBy(*keys, _CHUNK)) + F.col("_rest"))
    return out.select(*df.columns, pos, *([size] if size else []))


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """First and last stamp and row count per series, by partial aggregation."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows")
    )
