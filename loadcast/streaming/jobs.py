"""Streaming jobs with the results of the batch operators.

Each job reads a file stream, runs until the available input is used up (or on the trigger
given), and writes files; nothing goes through the driver.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timecols import QUARTER_HOUR
from ..operators.clean import dedup_first, dedup_last
from ..operators.meters import counter_to_power

LATENESS = "2 days"
AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}


def bin_mean_stream(stream: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", lateness: str = LATENESS) -> DataFrame:
    """Running 15-minute means; a bin is emitted once the watermark has passed its end.

    State is one partial mean per (series, open bin).
    """
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(*keys, F.window(ts, f"{QUARTER_HOUR} seconds").alias("_w"))
        .agg(F.avg(value).alias(value))
        .select(*keys, F.col("_w.start").alias(ts), value)
    )


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """First reading per (keys, ts) within the lateness; state is dropped behind the watermark."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([*keys, ts])


def append_files(out: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    return (
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**trigger).start(path)
    )


def run_of(spark: SparkSession, root: str, checkpoint: str) -> int:
    """Number of the run that a checkpoint stands for in a table: its own when it goes on, the next for a new one.

    Batch numbers start anew with a checkpoint, run numbers don't, so no run writes over another's folders.
    """
    runs = os.path.join(root, "_runs")
    first = spark.createDataFrame([], "checkpoint string, run int")
    first.write.mode("append").parquet(runs)  # so that there is a table to read
    known = spark.read.schema(first.schema).parquet(runs)
    own = known.where(F.col("checkpoint") == checkpoint).agg(F.max("run")).first()[0]
    if own is not None:
        return own
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    spark.createDataFrame([(checkpoint, run)], first.schema).coalesce(1).write.mode("append").parquet(runs)
    return run


def _folder(root: str, run: int, number: int) -> str:
    return os.path.join(root, f"run={run}", f"batch={number}")


def upsert_stream(stream: DataFrame, root: str, checkpoint: str, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    """Land each micro-batch in a folder of its own next to the history.

    A batch writes its own rows only, and a batch that runs again replaces its own folder, so
    nothing is applied twice; a new checkpoint is a new run with folders of its own.
    :func:`current_table` reads the upserted state, :func:`compact` makes it the history of a new table.
    """
    run = run_of(stream.sparkSession, root, checkpoint)

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(_folder(root, run, number))

    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_table(df: DataFrame, root: str) -> None:
    df.write.mode("overwrite").parquet(_folder(root, 0, -1))


def current_table(spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Last row per key over history and landed batches: later runs and batches win, then ``order``."""
    return dedup_last(spark.read.parquet(root), keys, ["run", "batch", *order]).drop("run", "batch")


def compact(spark: SparkSession, root: str, new_root: str, keys: Sequence[str], order: Sequence[str] = ()) -> None:
    """Write the current state as the history of a new table, so that reads stop at the last row per key."""
    start_table(current_table(spark, root, keys, order), new_root)


def counter_power_stream(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], ts: str = "ts", energy: str = "value",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Counter to power across micro-batches.

    The last (ts, energy) of each meter is carried from batch to batch in a table of one row per
    meter. Within a batch the chunked batch operator runs, so a meter with most of the readings
    is spread over many tasks. A meter with late readings, not newer than its carried one, is
    computed again from its first late reading on, with the landed readings around it, so the
    reading after a late one gets its new power too; :func:`power_table` takes the last result.
    """
    keys = list(keys)
    spark = stream.sparkSession
    run = run_of(spark, root, checkpoint)
    carry, power, landed = (os.path.join(root, n) for n in ("carry", "power", "readings"))

    def before(number: int) -> DataFrame | None:
        """The carried rows that this batch starts from: those of the batch, or of the run, before it."""
        if number:
            return spark.read.parquet(_folder(carry, run, number))
        if run == 1:
            return None
        old = spark.read.parquet(carry).where(F.col("run") < run)
        last = old.agg(F.max(F.struct("run", "batch"))).first()[0]
        return None if last is None else old.where((F.col("run") == last["run"]) & (F.col("batch") == last["batch"])).drop("run", "batch")

    def apply(batch: DataFrame, number: int) -> None:
        fresh = dedup_first(batch.select(*keys, ts, energy), [*keys, ts], [energy])
        fresh.write.mode("overwrite").parquet(_folder(landed, run, number))
        fresh = spark.read.schema(fresh.schema).parquet(_folder(landed, run, number))
        last = before(number)
        rows, again = fresh.withColumn("_new", F.lit(True)), None
        if last is not None:
            known = fresh.join(last.select(*keys, F.col(ts).alias("_last")), keys, "left")
            late = known.where(F.col(ts) <= F.col("_last")).groupBy(*keys).agg(F.min(ts).alias("_late"))
            rows = known.where(F.col("_last").isNull() | (F.col(ts) > F.col("_last"))).drop("_last")
            rows = rows.withColumn("_new", F.lit(True)).unionByName(last.withColumn("_new", F.lit(False)))
            if not late.isEmpty():
                again = _again(late, number)
        out = counter_to_power(rows, keys, ts, energy).where("_new").drop("_new")
        if again is not None:
            out = out.join(again.select(*keys).distinct(), keys, "left_anti").unionByName(again)
        out.write.mode("overwrite").parquet(_folder(power, run, number))
        ends = fresh if last is None else fresh.unionByName(last)
        ends.groupBy(*keys).agg(F.max_by(energy, F.struct(F.col(ts), -F.col(energy))).alias(energy), F.max(ts).alias(ts)).write.mode(
            "overwrite"
        ).parquet(_folder(carry, run, number + 1))

    def _again(late: DataFrame, number: int) -> DataFrame:
        """Power of the meters with late readings, from the first late one on."""
        every = spark.read.parquet(landed).where((F.col("run") < run) | (F.col("batch") <= number)).drop("run", "batch")
        theirs = dedup_first(every.join(late, keys).drop("_late"), [*keys, ts], [energy])
        return counter_to_power(theirs, keys, ts, energy).join(late, keys).where(F.col(ts) >= F.col("_late")).drop("_late")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def power_table(spark: SparkSession, root: str, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Power per (meter, stamp): what the last batch that computed it found."""
    return dedup_last(spark.read.parquet(os.path.join(root, "power")), [*keys, ts], ["run", "batch"]).drop("run", "batch")
