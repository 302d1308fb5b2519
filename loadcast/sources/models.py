"""Saved forests: one folder per series and a registry row each."""

from __future__ import annotations

import os
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.forest import SERIES, Series, feature_order

REGISTRY_SCHEMA = "site_id string, target string, path string, features array<string>"


def save_models(spark: SparkSession, models: Mapping[Series, PipelineModel], root: str) -> DataFrame:
    """Save each model under its site and target; returns the registry (one row per model)."""
    rows = []
    for series in sorted(models):
        path = os.path.join(root, "models", *(quote(name, safe="") for name in series))
        models[series].write().overwrite().save(path)
        rows.append((*series, path, feature_order(models[series])))
    registry = spark.createDataFrame(rows, REGISTRY_SCHEMA)
    registry.write.mode("overwrite").parquet(os.path.join(root, "registry"))
    return registry


def model_registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(os.path.join(root, "registry")).orderBy(*SERIES)


def load_models(spark: SparkSession, root: str) -> dict[Series, PipelineModel]:
    """Every registered model by (site_id, target), in name order."""
    rows = model_registry(spark, root).collect()
    if not rows:
        raise ValueError(f"no models registered under {root}")
    return {(r["site_id"], r["target"]): PipelineModel.load(r["path"]) for r in rows}
