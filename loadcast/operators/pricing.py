"""Hourly price panels to regression designs.

A day block is 24 consecutive hours that start at the same UTC hour as the forecast day (its
phase). Local midnight has two phases per year where clocks change, so designs are keyed by
(zone, phase, day number).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import DAY, HOUR, epoch_s, to_local
from .ordered import exact_lags

# Shape of the design.
PRICE_LAG_DAYS = (1, 2, 3, 7)
EXOG_LAG_DAYS = (1, 7, 0)
HOURS = 24
N_DUMMIES = 7
PRICE_FEATURES = HOURS * len(PRICE_LAG_DAYS)
WARMUP_DAYS = 7
# Days of the window that small mode does not count: the warm-up week and two more.
UNCOUNTED_DAYS = WARMUP_DAYS + 2

DEFAULT_WINDOW_DAYS = 364


def n_features(n_exog: int = 0) -> int:
    return PRICE_FEATURES + N_DUMMIES + HOURS * len(EXOG_LAG_DAYS) * n_exog


def phase_of(anchor: Column) -> Column:
    """Seconds after 00:00 UTC at which the day blocks of a forecast start."""
    return F.pmod(F.unix_seconds(anchor), F.lit(DAY))


def day_blocks(
    prices: DataFrame, zone: str = "zone", phases: Sequence[int] | Column = (0,), ts: str = "ts", values: Sequence[str] = ("price",)
) -> DataFrame:
    """One row per (zone, phase, day): an array of 24 values per column, NULL at missing hours.

    24 conditional aggregates that combine before the shuffle; at most one price per hour.
    """
    phase = phases if isinstance(phases, Column) else F.array(*[F.lit(int(p)) for p in phases])
    placed = (
        prices.select(zone, ts, *values, F.explode(phase).alias("phase"))
        .withColumn("_s", epoch_s(ts) - F.col("phase"))
        .withColumn("day", F.floor(F.col("_s") / DAY).cast("int"))
        .withColumn("_h", F.floor(F.pmod(F.col("_s"), F.lit(DAY)) / HOUR).cast("int"))
    )
    return placed.groupBy(zone, "phase", "day").agg(
        *[F.expr(f"array({', '.join(f'max(`{v}`) FILTER (WHERE _h = {h})' for h in range(HOURS))})").alias(v) for v in values]
    )


def block_start(day: Column | str = "day", phase: Column | str = "phase") -> Column:
    d, p = (F.col(c) if isinstance(c, str) else c for c in (day, phase))
    return F.timestamp_seconds(d.cast("bigint") * DAY + p)


def price_design(
    prices: DataFrame,
    zone: str = "zone",
    phases: Sequence[int] | Column = (0,),
    exog: Sequence[str] = (),
    tz: str = "UTC",
    ts: str = "ts",
) -> DataFrame:
    """Rows (zone, phase, day, x, y): the regression design of every day block.

    ``x``: for each hour the prices 1, 2, 3 and 7 days before; then for each hour the exogenous
    values 1 and 7 days before and on the day; then seven weekday dummies of the block start in
    ``tz``. ``y``: the 24 prices of the day, NULL where not known yet.
    """
    blocks = day_blocks(prices, zone, phases, ts, ["price", *exog])
    lags = {f"_p{d}": ("price", d) for d in PRICE_LAG_DAYS}
    for e in exog:
        lags |= {f"_{e}_{d}": (e, d) for d in EXOG_LAG_DAYS if d}
    lagged = exact_lags(blocks, [zone, "phase"], F.col("day"), lags, span=28)

    cells = [f"`_p{d}`[{h}]" for h in range(HOURS) for d in PRICE_LAG_DAYS]
    for h in range(HOURS):
        cells += [f"`_{e}_{d}`[{h}]" for d in EXOG_LAG_DAYS if d for e in exog]
        cells += [f"`{e}`[{h}]" for e in exog]
    cells += [f"double(_weekday = {i})" for i in range(N_DUMMIES)]
    # A block without a lag day has a NULL array, whose cells are NULL.
    return lagged.withColumn("_weekday", F.weekday(to_local(block_start(), tz))).select(
        zone, "phase", "day", F.expr(f"array({', '.join(cells)})").alias("x"), F.col("price").alias("y")
    )


def known(array: Column | str) -> Column:
    a = F.col(array) if isinstance(array, str) else array
    return ~F.exists(a, lambda v: v.isNull())


def training_days(design: DataFrame, anchor_day: Column, window_days: int) -> DataFrame:
    """Days of the calibration window that have their own warm-up week inside it."""
    return design.where(
        (F.col("day") >= anchor_day - (window_days - WARMUP_DAYS)) & (F.col("day") < anchor_day)
    )


def robust_stats(design: DataFrame, keys: Sequence[str], array: str = "x", skip_last: int = N_DUMMIES) -> DataFrame:
    """Median and inter-quartile range per feature, quantiles interpolated linearly.

    Exact quantiles gather the values of one (key, feature) in one buffer: at most one value per
    day of the calibration window, so cut the design to that window first.
    """
    cells = design.select(*keys, F.posexplode(array).alias("feature", "value"))
    if skip_last:
        width = F.size(array)
        cells = design.select(*keys, F.posexplode(F.slice(F.col(array), F.lit(1), width - skip_last)).alias("feature", "value"))
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return cells.groupBy(*keys, "feature").agg(q.alias("_q")).select(
        *keys, "feature",
        F.get("_q", F.lit(1)).alias("center"),
        (F.get("_q", F.lit(2)) - F.get("_q", F.lit(0))).alias("iqr"),
    )


def robust_scale(design: DataFrame, keys: Sequence[str], array: str = "x", skip_last: int = N_DUMMIES) -> DataFrame:
    """Scale every feature but the last ``skip_last`` by median and range; a zero range divides by 1.

    Statistics hold one array pair per key.
    """
    stats = robust_stats(design, keys, array, skip_last).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("feature", "center", "iqr"))).alias("_stats")
    )

    def scaled(v: Column, i: Column) -> Column:
        s = F.get(F.col("_stats"), i)
        return F.when(s.isNull(), v).otherwise((v - s["center"]) / F.when(s["iqr"] == 0, 1.0).otherwise(s["iqr"]))

    return design.join(stats, list(keys)).withColumn(array, F.transform(array, scaled)).drop("_stats")


def rolling_scales(design: DataFrame, anchors: DataFrame, span: int, skip_last: int = N_DUMMIES) -> DataFrame:
    """Median and range of every feature and output over the ``span`` days before each anchor.

    Rows (zone, phase, day, x_center, x_range, y_center, y_range), one per anchor that has a known day in its window;
    the last ``skip_last`` features have center 0 and range 1, a zero range is 1, as in :func:`robust_scale`. Days with
    an unknown hour don't count.

    Exact order statistics by one sliding window per (zone, phase, feature): the days of one feature, thousands at most
    whatever the number of anchors, and no design row is copied per anchor.
    """
    keys = ["zone", "phase"]
    width = F.size("x")
    cells = F.concat(F.slice(F.col("x"), F.lit(1), width - skip_last), F.col("y"))
    rows = design.where(known("x") & known("y")).select(*keys, "day", width.alias("_p"), F.posexplode(cells).alias("feature", "value"))
    size = design.groupBy(*keys).agg(F.max(width).alias("_p"))
    asked = anchors.select(*keys, "day").distinct().join(size, keys).select(
        *keys, "day", "_p", F.explode(F.sequence(F.lit(0), F.col("_p") - skip_last + HOURS - 1)).alias("feature"), F.lit(None).cast("double").alias("value"),
        F.lit(True).alias("_asked"),
    )
    both = rows.withColumn("_asked", F.lit(False)).unionByName(asked)
    window = Window.partitionBy(*keys, "feature").orderBy("day").rangeBetween(-span, -1)
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(window)
    stats = both.select("*", q.alias("_q")).where(F.col("_asked") & F.col("_q").isNotNull())
    iqr = F.get("_q", F.lit(2)) - F.get("_q", F.lit(0))
    one = F.struct("feature", F.get("_q", F.lit(1)).alias("center"), F.when(iqr == 0, 1.0).otherwise(iqr).alias("range"))
    of = stats.groupBy(*keys, "day").agg(F.max("_p").alias("_p"), F.array_sort(F.collect_list(one)).alias("_s"))

    def part(name: str, first, n, fill: float | None = None):
        got = F.slice(F.col(f"_s.{name}"), first, n)
        return got if fill is None else F.concat(got, F.array_repeat(F.lit(fill), skip_last))

    n = F.col("_p") - skip_last
    return of.select(
        *keys, "day", part("center", F.lit(1), n, 0.0).alias("x_center"), part("range", F.lit(1), n, 1.0).alias("x_range"),
        part("center", n + 1, F.lit(HOURS)).alias("y_center"), part("range", n + 1, F.lit(HOURS)).alias("y_range"),
    )


def small_mode(prices: DataFrame, keys: Sequence[str], window_days: int = DEFAULT_WINDOW_DAYS, n_exog: int = 0) -> DataFrame:
    """Per series: are there fewer counted calibration days than features?"""
    days = calibration_days(F.count(F.lit(1)), window_days)
    return prices.groupBy(*keys).agg(
        days.alias("calibration_days"), is_small(days, F.lit(n_features(n_exog))).cast("int").alias("small")
    )


def calibration_days(hours: Column, window_days: int) -> Column:
    """Days that so many hourly rows make, up to the window's length."""
    return F.least(hours, F.lit(window_days * HOURS)) / HOURS


def is_small(days: Column, features: Column) -> Column:
    """Fewer counted days than features: the penalty is cross-validated."""
    return days - UNCOUNTED_DAYS < features
