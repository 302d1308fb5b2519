"""Train/test splits, folds, trailing windows and their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import DAY, QUARTER_HOUR, epoch_s, shift
from .ordered import GRID_CHUNK, chunk_of, row_position


def split_label(ts: Column | str, train_end: Column, test_start: Column | None = None) -> Column:
    """'train' up to and including the end; 'test' from its start, 15 minutes later by default."""
    t = F.col(ts) if isinstance(ts, str) else ts
    start = shift(train_end, QUARTER_HOUR) if test_start is None else test_start
    return F.when(t <= train_end, "train").when(t >= start, "test")


def time_split(df: DataFrame, train_end: Column, test_start: Column | None = None, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    label = split_label(ts, train_end, test_start)
    return df.where(label == "train"), df.where(label == "test")


def trailing_window(df: DataFrame, keys: Sequence[str], days: int, ts: str = "ts") -> DataFrame:
    """Rows within N days of the series' last stamp, both ends included.

    The last stamp per series comes from a partial aggregate joined back, not from a window
    over the whole series.
    """
    ends = df.groupBy(*keys).agg(F.max(ts).alias("_end"))
    return df.join(ends, list(keys)).where(F.col(ts) >= shift("_end", -days * DAY)).drop("_end")


def last_rows(df: DataFrame, keys: Sequence[str], n: int, ts: str = "ts", span: int = GRID_CHUNK) -> DataFrame:
    """The last N rows of each series.

    Row counts per chunk tell which chunks the N rows reach; the others are dropped before
    anything is sorted.
    """
    placed = df.withColumn("_chunk", chunk_of(epoch_s(ts), span))
    later = Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    reached = counts.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_later")).where(F.col("_later") < n)
    from_end = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(F.desc(ts))) + F.col("_later")
    return (
        placed.join(reached, [*keys, "_chunk"]).withColumn("_from_end", from_end).where(F.col("_from_end") <= n).select(*df.columns)
    )


def fold_contiguous(df: DataFrame, keys: Sequence[str], k: int, ts: str = "ts", fold: str = "fold") -> DataFrame:
    """Label k contiguous time blocks 0..k-1; earlier blocks take the extra rows."""
    numbered = row_position(df, keys, ts, pos="_pos", size="_n")
    base, extra = F.floor(F.col("_n") / k), F.col("_n") % k
    in_long = F.col("_pos") < extra * (base + 1)
    label = F.when(in_long, F.floor(F.col("_pos") / (base + 1))).otherwise(
        extra + F.floor((F.col("_pos") - extra * (base + 1)) / base)
    )
    return numbered.withColumn(fold, label.cast("int")).drop("_pos", "_n")


def fold_expanding(df: DataFrame, keys: Sequence[str], k: int, ts: str = "ts", fold: str = "fold") -> DataFrame:
    """Label time blocks for expanding folds.

    Fold i (0..k-1) tests the rows labelled i and trains on every row with a smaller label; -1
    marks rows that are only ever trained on. The test blocks hold floor(n / (k + 1)) rows each.
    """
    numbered = row_position(df, keys, ts, pos="_pos", size="_n")
    block = F.floor(F.col("_n") / (k + 1))
    head = F.col("_n") - block * k
    label = F.when(F.col("_pos") < head, F.lit(-1)).otherwise(F.floor((F.col("_pos") - head) / block))
    return numbered.withColumn(fold, label.cast("int")).drop("_pos", "_n")


def period_stats(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Bounds and sample count per (key, split)."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias("period_start"), F.max(ts).alias("period_end"), F.count(F.lit(1)).alias("n_samples")
    )


def regression_metrics(df: DataFrame, keys: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """RMSE, MAE and R² from one partial aggregation."""
    err = F.col(y) - F.col(yhat)
    known = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    return known.groupBy(*keys).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(F.lit(1)).alias("n_rows"),
    )
