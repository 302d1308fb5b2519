"""Panel, forecast, metrics and payload sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import local_date, to_epoch_ms
from ..operators.history import upsert

PANEL_PARTITIONS = ("site_id", "month")


def with_month(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("month", F.date_format(ts, "yyyy-MM"))


def write_panel(df: DataFrame, path: str, partitions: Sequence[str] = PANEL_PARTITIONS, ts: str = "ts", mode: str = "overwrite") -> None:
    """Parquet by site and month, sorted by time within files.

    Rows are spread over (partition, day) so a site that holds most rows is written by many
    tasks.
    """
    out = df if "month" in df.columns or "month" not in partitions else with_month(df, ts)
    (
        out.repartition(*partitions, F.to_date(ts))
        .sortWithinPartitions(*partitions, ts)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    )


def read_panel(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def upsert_panel(spark: SparkSession, path: str, schema: str, new: DataFrame, keys: Sequence[str], ts: str = "ts") -> None:
    """Upsert a block into a written panel, rewriting only the partitions it touches."""
    block = with_month(new, ts)
    touched = block.select(*PANEL_PARTITIONS).distinct()
    kept = spark.read.schema(schema).parquet(path).join(touched, list(PANEL_PARTITIONS), "left_semi")
    write_panel(upsert(kept, block, keys), path, ts=ts)


def write_forecast(df: DataFrame, path: str, by: str = "target", ts: str = "ts", tz: str = "UTC") -> None:
    """One output per (target or zone, local run day); a rerun replaces only its own days."""
    (
        df.withColumn("run_date", local_date(ts, tz))
        .repartition(by, "run_date")
        .sortWithinPartitions(by, "run_date", ts)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, "run_date").parquet(path)
    )


def write_training_matrix(df: DataFrame, path: str, fmt: str = "parquet", ts: str = "ts") -> None:
    """Features and target of each model for inspection, one folder per target."""
    (
        df.repartition("target", F.to_date(ts)).sortWithinPartitions("target", ts)
        .write.mode("overwrite").partitionBy("target").format(fmt).option("header", True).save(path)
    )


METRICS_SCHEMA = (
    "site_id string, target string, params struct<trees int, features string, min_leaf int>, rmse double, mae double, r2 double, "
    "train_start timestamp, train_end timestamp, test_start timestamp, test_end timestamp, n_train bigint, n_test bigint, "
    "final_train_start timestamp, final_train_end timestamp, final_train_samples bigint, trees_at_limit int"
)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One typed row per series."""
    metrics.write.mode("overwrite").parquet(path)


def to_payload(forecasts: DataFrame, id_map: Mapping[str, str] | None = None, tz: str = "UTC", target: str = "target", ts: str = "ts", value: str = "yhat") -> DataFrame:
    """Upload rows (variable_id, run_date, samples, n_missing); a missing forecast is sent as 0.0.

    One payload per variable and local day, so an array holds one day of samples.
    """
    variable: Column = F.col(target)
    out = forecasts
    if id_map:
        variable = F.create_map(*[F.lit(v) for kv in id_map.items() for v in kv])[F.col(target)]
        out = out.where(variable.isNotNull())
    sample = F.struct(to_epoch_ms(ts).alias("timestamp"), F.coalesce(F.col(value), F.lit(0.0)).alias("value"))
    return out.groupBy(variable.alias("variable_id"), local_date(ts, tz).alias("run_date")).agg(
        F.sort_array(F.collect_list(sample)).alias("samples"), F.count_if(F.col(value).isNull()).alias("n_missing")
    )


def payload_json(payload: DataFrame) -> DataFrame:
    return payload.select("variable_id", "run_date", "n_missing", F.to_json(F.array(F.struct("variable_id", "samples"))).alias("body"))
