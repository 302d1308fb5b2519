"""Twenty-four L1 regressions per zone and forecast day.

Spark partitions the work by (zone, phase, block of forecast days): one group holds the design
rows of the calibration window plus the block, at most ``window_days + days_per_group`` rows,
whatever the length of the price history. Neighbouring forecast days share their window, so a
long back-test moves each design row about ``window_days / days_per_group`` times.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip
from ..functions.timecols import HOUR, shift
from ..session import ship_package
from .pricing import (
    DEFAULT_WINDOW_DAYS, HOURS, WARMUP_DAYS, block_start, calibration_days, is_small, known, n_features, rolling_scales,
)

# Penalty grid and folds of the cross-validated choice.
CV_FOLDS = 7
CV_PENALTIES = 100
CV_RATIO = 1e-6

MODEL_SCHEMA = (
    "zone string, phase bigint, day int, hour int, n_days int, rule string, penalty double, "
    "n_nonzero int, intercept double, coef array<double>"
)


def l1_path(x: np.ndarray, y: np.ndarray, floor: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """Exact solution path of ``|y - xb|² / 2n + penalty |b|₁`` for centred x and y.

    Returns the penalties at which the set of non-zero coefficients changes, falling, and the
    coefficients there. Between two of them every coefficient is linear in the penalty.
    """
    n, p = x.shape
    gram, corr = x.T @ x / n, x.T @ y / n
    beta = np.zeros(p)
    level = float(np.abs(corr).max(initial=0.0))
    knots, coefs = [level], [beta.copy()]
    stop, eps = level * floor, level * 1e-12
    active: list[int] = []
    closed = np.zeros(p, dtype=bool)  # active, or within the span of the active ones
    entering, left = (int(np.argmax(np.abs(corr))) if level > 0 else -1), -1
    for _ in range(8 * (n + p)):
        if entering >= 0:
            closed[entering] = True
            spare = gram[entering, entering]
            if active:
                g = gram[active, entering]
                spare = spare - g @ np.linalg.solve(gram[np.ix_(active, active)], g)
            if spare > 1e-9 * max(gram[entering, entering], 1e-300):
                active.append(entering)
        if not active or level <= stop:
            break
        step = np.linalg.solve(gram[np.ix_(active, active)], np.sign(corr[active]))
        slope = gram[:, active] @ step
        reach, entering, leaving = level - stop, -1, -1
        with np.errstate(divide="ignore", invalid="ignore"):
            up, down = (level - corr) / (1 - slope), (level + corr) / (1 + slope)
            cross = -beta[active] / step
        if left >= 0:  # sits on the boundary it has just left, and moves inside
            (up if corr[left] > 0 else down)[left] = np.inf
        for cand in (up, down):
            cand = np.where(closed | ~(cand > eps), np.inf, cand)
            if cand.min() < reach:
                reach, entering = float(cand.min()), int(cand.argmin())
        cross = np.where(cross > eps, cross, np.inf)
        left = -1
        if cross.min() < reach:
            reach, entering, leaving = float(cross.min()), -1, int(cross.argmin())
        beta[active] += reach * step
        if leaving >= 0:
            left = active.pop(leaving)
            beta[left] = 0.0
            closed[:] = False
            closed[active] = True
        level -= reach
        corr = x.T @ (y - x @ beta) / n
        knots.append(level)
        coefs.append(beta.copy())
    else:
        raise ValueError(f"the solution path of {n} rows and {p} columns has not ended after {8 * (n + p)} steps")
    return np.array(knots), np.array(coefs)


def path_at(knots: np.ndarray, coefs: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Coefficients (len(penalty), p) at any penalties, linear between the knots."""
    rising = knots[::-1]
    at = np.clip(np.searchsorted(rising, penalty), 1, len(rising) - 1) if len(rising) > 1 else np.zeros(len(penalty), int)
    if len(rising) == 1:
        return np.repeat(coefs, len(penalty), axis=0)
    lo, hi = rising[at - 1], rising[at]
    share = np.clip((penalty - lo) / np.where(hi > lo, hi - lo, 1.0), 0.0, 1.0)[:, None]
    back = coefs[::-1]
    return back[at - 1] * (1 - share) + back[at] * share


def penalty_by_aic(x: np.ndarray, y: np.ndarray, knots: np.ndarray, coefs: np.ndarray) -> float:
    """Penalty with the lowest AIC on the path; degrees of freedom = non-zero coefficients."""
    n, p = x.shape
    if n <= p + 1:
        raise ValueError(f"the AIC rule needs more than {p + 1} days, got {n}; use the cross-validated rule")
    full = np.linalg.lstsq(x, y, rcond=None)[0]
    noise = float(((y - x @ full) ** 2).sum()) / (n - p - 1)
    rss = ((y[:, None] - x @ coefs.T) ** 2).sum(axis=0)
    freedom = (np.abs(coefs) > np.finfo(float).eps).sum(axis=1)
    return float(knots[np.argmin(rss / max(noise, 1e-300) + 2 * freedom)])


def penalty_by_cv(x: np.ndarray, y: np.ndarray) -> float:
    """Penalty with the lowest mean squared error over contiguous folds."""
    n = len(y)
    if n < CV_FOLDS:
        raise ValueError(f"the cross-validated rule needs {CV_FOLDS} days, got {n}")
    top = float(np.abs((x - x.mean(0)).T @ (y - y.mean())).max()) / n
    if top == 0:
        return 0.0
    grid = np.geomspace(top, top * CV_RATIO, CV_PENALTIES)
    errors = np.zeros(CV_PENALTIES)
    for test in np.array_split(np.arange(n), CV_FOLDS):
        train = np.setdiff1d(np.arange(n), test)
        xm, ym = x[train].mean(0), y[train].mean()
        knots, coefs = l1_path(x[train] - xm, y[train] - ym)
        guess = (x[test] - xm) @ path_at(knots, coefs, grid).T + ym
        errors += ((y[test][:, None] - guess) ** 2).mean(axis=0)
    return float(grid[errors.argmin()])


Scales = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def fit_day(x: np.ndarray, y: np.ndarray, rule: str, scales: Scales) -> list[tuple]:
    """(rule, penalty, n_nonzero, intercept, coef) per output hour, in raw units; ``rule`` is ``aic`` or ``cv7``.

    ``scales``: center and range of the features and of the outputs (``pricing.rolling_scales``).
    """
    center, scale, y_center, y_scale = scales
    xs, ys = (x - center) / scale, (y - y_center) / y_scale
    xm = xs.mean(0)
    out = []
    for h in range(y.shape[1]):
        xc, ym = xs - xm, ys[:, h].mean()
        yc = ys[:, h] - ym
        path = l1_path(xc, yc)
        penalty = penalty_by_aic(xc, yc, *path) if rule == "aic" else penalty_by_cv(xc, yc)
        beta = path_at(*path, np.array([penalty]))[0]
        raw = beta / scale * y_scale[h]
        intercept = y_center[h] + y_scale[h] * (ym - xm @ beta) - raw @ center
        out.append((rule, penalty, int((beta != 0).sum()), float(intercept), raw))
    return out


def fit_hourly(
    design: DataFrame, anchors: DataFrame, window_days: int = DEFAULT_WINDOW_DAYS, rule: str = "auto", days_per_group: int = 7
) -> DataFrame:
    """One model per (zone, phase, forecast day, hour).

    ``anchors``: the forecast days (zone, phase, day), one row each. Days with an unknown hour in
    their design row are left out of the training rows. ``rule``: ``aic``, ``cv7`` or ``auto``, which
    cross-validates where the window has too few days for its features (``pricing.is_small``, over the
    hours known in the window and those of the forecast day).

    Every anchor gives its 24 rows. Where the days do not suffice for the rule, the model is null and
    ``rule`` says why.
    """
    ship_package(design.sparkSession)
    span = window_days - WARMUP_DAYS
    keys = ["zone", "phase", "_block"]
    due = anchors.select("zone", "phase", "day", F.floor(F.col("day") / days_per_group).cast("int").alias("_block")).distinct()
    due = due.join(_rules(design, due, window_days, rule), ["zone", "phase", "day"], "left")
    due = due.join(rolling_scales(design, due, span), ["zone", "phase", "day"], "left")
    rows = (
        design.where(known("x") & known("y"))
        .select(
            "zone", "phase", "day", "x", "y",
            F.explode(
                F.sequence(
                    F.floor((F.col("day") + 1) / days_per_group).cast("int"),
                    F.floor((F.col("day") + span) / days_per_group).cast("int"),
                )
            ).alias("_block"),
        )
        .join(due.select(*keys).distinct(), keys, "left_semi")
    )
    # New names keep the two sides of the cogroup apart: both may come from one price table.
    due = due.select(*[F.col(c).alias(f"{c}_due") for c in due.columns])
    scale_names = [f"{c}_due" for c in ("x_center", "x_range", "y_center", "y_range")]

    def fit(known_days: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        known_days = known_days.sort_values("day")
        day = known_days["day"].to_numpy()
        for zone, phase, anchor, chosen, *scales in wanted[["zone_due", "phase_due", "day_due", "rule_due", *scale_names]].itertuples(index=False):
            use = np.flatnonzero((day < anchor) & (day >= anchor - span)) if len(day) else np.zeros(0, int)
            try:
                if len(use) < 2:
                    raise ValueError(f"{len(use)} known days in the window")
                x, y = (np.stack(known_days[c].to_numpy()[use]) for c in ("x", "y"))
                models = fit_day(x, y, chosen, tuple(np.asarray(s, float) for s in scales))
            except ValueError as reason:
                models = [(str(reason), None, None, None, None)] * HOURS
            out += [(zone, phase, anchor, hour, len(use), *model) for hour, model in enumerate(models)]
        names = [f.split()[0] for f in MODEL_SCHEMA.split(", ")]
        return pd.DataFrame(out, columns=names)

    # A fixed number of partitions: the groups are small in bytes and long in time, so they must
    # not be merged into a few tasks.
    spark = design.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    due_keys = [f"{c}_due" for c in keys]
    spread, wanted_days = rows.repartition(n, *keys), due.repartition(n, *due_keys)
    return spread.groupBy(*keys).cogroup(wanted_days.groupBy(*due_keys)).applyInPandas(fit, MODEL_SCHEMA)


def _rules(design: DataFrame, anchors: DataFrame, window_days: int, rule: str) -> DataFrame:
    """(zone, phase, day, rule): the rule that each anchor's window calls for."""
    keys = ["zone", "phase", "day"]
    if rule != "auto":
        return anchors.select(*keys, F.lit(rule).alias("rule"))
    known_hours = F.size(F.filter("y", lambda v: v.isNotNull()))
    hours = design.select("zone", "phase", F.col("day").alias("_at"), known_hours.alias("_hours"), F.size("x").alias("_p"))
    # The window's days and the forecast day, whose hours are not known yet but counted.
    window = anchors.select(*keys, F.explode(F.sequence(F.col("day") - window_days, F.col("day") - 1)).alias("_at"))
    seen = window.join(hours, ["zone", "phase", "_at"], "left").groupBy(*keys).agg(
        F.coalesce(F.sum("_hours"), F.lit(0)).alias("_hours"), F.max("_p").alias("_p")
    )
    days = calibration_days(F.col("_hours") + HOURS, window_days)
    small = is_small(days, F.coalesce("_p", F.lit(n_features())))
    return seen.select(*keys, F.when(small, "cv7").otherwise("aic").alias("rule"))


def predict_hourly(design: DataFrame, models: DataFrame, floor: float | None = 0.0) -> DataFrame:
    """Forecast (zone, day, hour, ts, yhat, reason) from the design row of each model's day.

    A forecast that cannot be made is a row all the same, null with the reason.
    """
    rows = design.select("zone", "phase", "day", "x")
    dot = F.aggregate(F.zip_with("coef", "x", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    scored = models.join(rows, ["zone", "phase", "day"], "left").withColumn("yhat", F.col("intercept") + dot)
    return scored.select(
        "zone", "phase", "day", "hour",
        shift(block_start(), F.col("hour") * HOUR).alias("ts"),
        (clip("yhat", lo=floor) if floor is not None else F.col("yhat")).alias("yhat"),
        F.when(F.col("coef").isNull(), F.col("rule")).when(F.col("yhat").isNull(), "unknown features on the day").alias("reason"),
    )


def anchors_of(days: DataFrame, tz: str, zone: str = "zone", local_day: str = "forecast_date") -> DataFrame:
    """Forecast dates (local) -> (zone, phase, day) anchors."""
    start = F.to_utc_timestamp(F.col(local_day).cast("timestamp"), tz)
    s = F.unix_seconds(start)
    return days.select(
        zone, local_day, F.pmod(s, F.lit(86400)).alias("phase"), F.floor(s / 86400).cast("int").alias("day")
    )


def optimality(design: DataFrame, models: DataFrame, window_days: int) -> DataFrame:
    """How far each model is from the conditions of its penalty's optimum: (zone, phase, day, hour, excess, slack).

    In scaled units a feature's gradient is its mean product with the residuals. ``excess``: the largest gradient over the
    penalty, 1 at the optimum of a model with any coefficient; ``slack``: the largest share by which the gradient of a
    non-zero coefficient stays away from the penalty. Computed from rows and coefficients alone. Models without
    coefficients are left out.
    """
    span = window_days - WARMUP_DAYS
    keys = ["zone", "phase", "day"]
    fitted = models.where(F.col("coef").isNotNull() & (F.col("penalty") > 0))
    scales = rolling_scales(design, fitted.select(*keys).distinct(), span)
    past = design.where(known("x") & known("y")).select("zone", "phase", F.col("day").alias("_at"), "x", "y")
    dot = F.aggregate(F.zip_with("coef", "x", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    rows = fitted.withColumn("_at", F.explode(F.sequence(F.col("day") - span, F.col("day") - 1))).join(past, ["zone", "phase", "_at"])
    left = rows.select(*keys, "hour", "penalty", "coef", "n_days", (F.get("y", F.col("hour")) - F.col("intercept") - dot).alias("_r"), "x")
    sums = left.select(*keys, "hour", "penalty", "n_days", "_r", F.posexplode(F.arrays_zip("x", "coef")).alias("feature", "c")).groupBy(
        *keys, "hour", "penalty", "n_days", "feature"
    ).agg(F.sum(F.col("c.x") * F.col("_r")).alias("_g"), F.first("c.coef").alias("_b"))
    each = sums.join(scales, keys)
    gradient = F.abs(F.col("_g")) / (F.col("n_days") * F.get("x_range", F.col("feature")) * F.get("y_range", F.col("hour"))) / F.col("penalty")
    return each.groupBy(*keys, "hour").agg(
        F.max(gradient).alias("excess"), F.coalesce(F.max(F.when(F.col("_b") != 0, F.abs(gradient - 1))), F.lit(0.0)).alias("slack")
    )


def penalty_summary(models: DataFrame, keys: Sequence[str] = ("zone",)) -> DataFrame:
    return models.select(*keys, "day", "hour", "rule", "penalty", "n_nonzero", "n_days")
