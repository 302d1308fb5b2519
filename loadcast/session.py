"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

# Time zone of every stored timestamp; local time is derived with from_utc_timestamp.
EVENT_TIME_ZONE = "UTC"


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; call once per session.

    ``requireAllClusterKeysForDistribution``: rows that already sit together by series would
    otherwise satisfy a window by (series, chunk), and a hot series would stay in one task.
    """
    spark.conf.set("spark.sql.session.timeZone", EVENT_TIME_ZONE)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForDistribution", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (local tests) a temporary folder is made and kept in
    the session for later calls.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("loadcast.scratch.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    made = tempfile.mkdtemp(prefix="loadcast-")
    spark.conf.set("loadcast.scratch.dir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For results that several later branches read: they are computed once, and a lost executor
    costs a re-read, not the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="loadcast-zip-"), "loadcast")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(here), os.path.basename(here)))
    _shipped.add(app)
