"""Upsert of a stream into the partitions it touches.

A micro-batch merges its rows with the current rows of the partitions that it touches and writes these as a new
version; a manifest row per partition and version, appended by one job, makes them current all at once. Reads take
the newest version of each partition, so they cost the same after any number of batches. A run that is lost before
its manifest rows leaves the old versions current, and a batch that runs again is applied once.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import dedup_last
from ..operators.history import upsert
from .jobs import AVAILABLE_NOW, run_of

MANIFEST_SCHEMA = "part string, version bigint"


def part_of(keys: Sequence[str], ts: str, buckets: int) -> Column:
    """Month and bucket of the other keys, as a folder name; both are fixed by the keys, so a key has one partition."""
    month = F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit("none"))
    return F.concat_ws("-", month, F.pmod(F.xxhash64(*[k for k in keys if k != ts]), F.lit(buckets)).cast("string"))


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(os.path.join(root, "manifest"))


def _folders(parts: DataFrame, root: str) -> list[str]:
    """Folder of the newest version of each listed partition: one path per month and bucket."""
    newest = parts.groupBy("part").agg(F.max("version").alias("version")).orderBy("part")
    return [os.path.join(root, "data", f"version={r['version']}", f"part={r['part']}") for r in newest.collect()]


def _write(rows: DataFrame, root: str, version: int, ts: str) -> None:
    """Rows with their ``part`` as one version, then its manifest rows."""
    path = os.path.join(root, "data", f"version={version}")
    (
        rows.repartition("part", F.to_date(ts)).sortWithinPartitions("part", ts)
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)
    )
    listed = rows.sparkSession.read.schema("part string").parquet(path).select("part", F.lit(version).cast("bigint").alias("version"))
    listed.distinct().coalesce(1).write.mode("append").parquet(os.path.join(root, "manifest"))


def start_merged(df: DataFrame, root: str, keys: Sequence[str], order: Sequence[str] = (), ts: str = "ts", buckets: int = 1) -> None:
    """Begin a table with a history; of rows of one key the last by ``order`` stays."""
    one = dedup_last(df, keys, order) if order else df
    empty = df.sparkSession.createDataFrame([], MANIFEST_SCHEMA)
    empty.write.mode("append").parquet(os.path.join(root, "manifest"))  # also of an empty history
    _write(one.withColumn("part", part_of(keys, ts, buckets)), root, 0, ts)


def merge_batch(
    batch: DataFrame, root: str, version: int, keys: Sequence[str], order: Sequence[str] = (), ts: str = "ts", buckets: int = 1
) -> None:
    """Merge one batch as ``version``; nothing is done when the manifest has that version already.

    Rows of the batch beat current ones, and ``order`` decides among its own. The batch and the table have the same columns.
    """
    spark = batch.sparkSession
    manifest = _manifest(spark, root)
    if not manifest.where(F.col("version") == version).isEmpty():
        return
    new = batch.withColumn("part", part_of(keys, ts, buckets))
    folders = _folders(manifest.join(new.select("part").distinct(), "part", "left_semi"), root)
    known = spark.read.schema(batch.schema).parquet(*folders) if folders else spark.createDataFrame([], batch.schema)
    merged = upsert(known, batch, keys, order)
    _write(merged.withColumn("part", part_of(keys, ts, buckets)), root, version, ts)


def merge_stream(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str] = (), ts: str = "ts", buckets: int = 1,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Merge every micro-batch into the table begun by :func:`start_merged`, with the same keys and buckets."""
    run = run_of(stream.sparkSession, root, checkpoint)

    def apply(batch: DataFrame, number: int) -> None:
        kept = batch.persist()  # read twice: for the partitions it touches and for its rows
        try:
            merge_batch(kept, root, (run << 32) + number, keys, order, ts, buckets)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def merged_table(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Current rows: the newest version of every partition."""
    folders = _folders(_manifest(spark, root), root)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
