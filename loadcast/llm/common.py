"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

# Words are runs without space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# Rows per Arrow batch: texts may be long, a batch must stay small.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20
_AT_BITS = 33  # of monotonically_increasing_id: row within its task


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """What operators with Python stages need: this package on the executors, small Arrow batches.

    Batches of more rows than usual are bounded in bytes too.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if rows > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def parts_of(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, order: Sequence[Column], parts: int, ranges: Sequence[Column] | None = None) -> DataFrame:
    """Range-partitioned and sorted, with ``_part`` and ``_at``: task number and row within it, both in order.

    ``ranges``: a shorter key of the same order to cut ranges by, where ``order`` holds whole texts; the driver sees a
    sample of it.
    """
    spread = df.repartitionByRange(parts, *(ranges or order)).sortWithinPartitions(*order)
    number = spread.withColumn("_id", F.monotonically_increasing_id())
    return number.select(
        *df.columns, F.shiftright("_id", _AT_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _AT_BITS) - 1)).alias("_at"),
    )


def carried(totals: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """``totals`` (one row per task, or per task and group) with ``_carry``: the sum over earlier tasks.

    There are as many rows as tasks, or tasks a group lies in, so one window holds few rows.
    """
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_carry", F.coalesce(F.sum(value).over(w), F.lit(0)))


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of columns both sides have."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def numbered(df: DataFrame, order: Sequence[Column], label: str, group: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``_before``: rows before it in its group. ``order`` starts with the group columns.

    A range sort deals hot groups over many tasks; the numbers of earlier tasks are carried over.
    """
    rows = keep(in_order(df, order, parts_of(df.sparkSession)), label)
    spans = rows.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    shift = keep(
        carried(spans, "_n", group).select("_part", *group, (F.col("_carry") - F.col("_first")).alias("_shift")), f"{label}-shift"
    )
    joined = rows.join(shift, same(rows, shift, ["_part", *group]), "left")
    return joined.select(*[rows[c] for c in df.columns], (F.col("_at") + F.col("_shift")).alias("_before"))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names made here never clash with the caller's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(rows: pd.DataFrame, most: int = BATCH_ROWS) -> Iterator[pd.DataFrame]:
    for k in range(0, len(rows), most):
        yield rows.iloc[k : k + most]


def coded(items: Sequence[str]) -> tuple[np.ndarray, list[str]]:
    """Number of each item among the distinct ones, in order of appearance; strings may hold any character, NUL too."""
    distinct = list(dict.fromkeys(items))
    number = dict(zip(distinct, range(len(distinct))))
    return np.fromiter(map(number.__getitem__, items), np.int64, len(items)), distinct


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix64) over unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
