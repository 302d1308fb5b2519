"""Streams over several files give the batch results."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadcast.operators.clean import dedup_first, dedup_last
from loadcast.operators.grid import bin_mean
from loadcast.operators.history import upsert
from loadcast.operators.meters import counter_to_power
from loadcast.streaming.jobs import (
    append_files, bin_mean_stream, compact, counter_power_stream, current_table, dedup_stream, power_table, start_table, upsert_stream,
)
from loadcast.streaming.merge import merge_batch, merge_stream, merged_table, start_merged
from loadcast.streaming.state import counter_power_state

SCHEMA = "variable_id string, ts timestamp, value double, n bigint"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Four files of readings in time order, one meter with most of them."""
    rng = np.random.default_rng(9)
    root = str(tmp_path_factory.mktemp("landed"))
    start, rows = dt.datetime(2024, 1, 1), []
    for i in range(400):
        meter = "hot" if rng.random() < 0.7 else f"m{rng.integers(3)}"
        rows.append((meter, start + dt.timedelta(minutes=31 * i), float(i % 90), i))
    for part in range(4):
        own = rows[part * 100 : (part + 1) * 100]
        spark.createDataFrame(own, SCHEMA).coalesce(1).write.mode("append").parquet(root)
    return root, spark.createDataFrame(rows, SCHEMA).cache()


def source(spark, root):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(root)


def test_bins_equal_batch_behind_the_watermark(spark, landed, tmp_path):
    root, batch = landed
    out = bin_mean_stream(source(spark, root), ["variable_id"])
    append_files(out, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    limit = batch.agg(F.max("ts")).first()[0] - dt.timedelta(days=2)
    want = bin_mean(batch, ["variable_id"]).where(F.col("ts") + F.expr("INTERVAL 15 MINUTES") <= F.lit(limit))
    assert want.count() > 100
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got.select(*want.columns)).count() == 0


def test_duplicates_are_dropped(spark, landed, tmp_path):
    root, batch = landed
    doubled = str(tmp_path / "d")
    for _ in range(2):
        batch.coalesce(1).write.mode("append").parquet(doubled)
    out = dedup_stream(source(spark, doubled), ["variable_id"], lateness="30 days")
    append_files(out, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == batch.count()


def test_upsert_equals_batch_and_reruns_change_nothing(spark, landed, tmp_path):
    root, batch = landed
    keyed = batch.withColumn("ts", F.date_trunc("day", "ts"))
    table, history = str(tmp_path / "t"), keyed.where("n < 50").withColumn("value", F.lit(-1.0))
    start_table(history, table)
    late = source(spark, root).withColumn("ts", F.date_trunc("day", "ts"))
    upsert_stream(late, table, str(tmp_path / "c")).awaitTermination()
    once = current_table(spark, table, ["variable_id", "ts"], ["n"])
    want = upsert(history, keyed, ["variable_id", "ts"], ["n"])
    assert once.select(*want.columns).exceptAll(want).count() == 0 and once.count() == want.count()
    before = sorted(map(tuple, once.select(*want.columns).collect()))
    upsert_stream(late, table, str(tmp_path / "c2")).awaitTermination()  # the same batches land again
    again = current_table(spark, table, ["variable_id", "ts"], ["n"])
    assert sorted(map(tuple, again.select(*want.columns).collect())) == before


def test_counter_power_crosses_batches(spark, landed, tmp_path):
    root, batch = landed
    counter_power_stream(source(spark, root), str(tmp_path / "s"), str(tmp_path / "c"), ["variable_id"]).awaitTermination()
    got = power_table(spark, str(tmp_path / "s"), ["variable_id"]).toPandas().sort_values(["variable_id", "ts"]).reset_index(drop=True)
    want = counter_to_power(batch, ["variable_id"]).toPandas().sort_values(["variable_id", "ts"]).reset_index(drop=True)
    pd.testing.assert_series_equal(got["power"], want["power"])
    assert got["power"].isna().sum() >= 4


def test_late_counter_readings_are_applied(spark, landed, tmp_path):
    """Files in any order of time: late readings get a power, and the reading after one a new power."""
    _, batch = landed
    root = str(tmp_path / "late")
    for part in (2, 0, 3, 1):
        batch.where(F.pmod("n", F.lit(4)) == part).coalesce(1).write.mode("append").parquet(root)
    counter_power_stream(source(spark, root), str(tmp_path / "s"), str(tmp_path / "c"), ["variable_id"]).awaitTermination()
    got = power_table(spark, str(tmp_path / "s"), ["variable_id"]).toPandas().sort_values(["variable_id", "ts"]).reset_index(drop=True)
    want = counter_to_power(batch, ["variable_id"]).toPandas().sort_values(["variable_id", "ts"]).reset_index(drop=True)
    pd.testing.assert_series_equal(got["power"], want["power"])


def test_a_new_checkpoint_keeps_landed_batches(spark, landed, tmp_path):
    root, batch = landed
    table = str(tmp_path / "t")
    start_table(batch.limit(0), table)
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    batch.where("n < 200").coalesce(1).write.parquet(first)
    batch.where("n >= 200").coalesce(1).write.parquet(second)
    upsert_stream(source(spark, first), table, str(tmp_path / "c1")).awaitTermination()
    upsert_stream(source(spark, second), table, str(tmp_path / "c2")).awaitTermination()
    assert current_table(spark, table, ["variable_id", "ts"]).count() == batch.count()
    compact(spark, table, str(tmp_path / "new"), ["variable_id", "ts"])
    assert current_table(spark, str(tmp_path / "new"), ["variable_id", "ts"]).count() == batch.count()


def test_counter_power_as_keyed_state(spark, landed, tmp_path):
    """Files out of order within the lateness, equal stamps and unknown energies: what the batch gives behind the watermark."""
    _, batch = landed
    odd = batch.withColumn("value", F.when(F.col("n") % 50 != 7, F.col("value")))
    odd = odd.unionByName(odd.where("n % 40 = 3").withColumn("value", F.col("value") + 5)).unionByName(odd.where("n = 9").withColumn("ts", F.lit(None).cast("timestamp")))
    root = str(tmp_path / "late")
    arrival = F.floor((F.col("n") + F.pmod(F.xxhash64("n"), F.lit(40))) / 100)
    for part in range(5):
        odd.where(arrival == part).coalesce(1).write.mode("append").parquet(root)
    out = counter_power_state(source(spark, root), ["variable_id"])
    append_files(out, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "o")).toPandas().sort_values(["variable_id", "ts"]).reset_index(drop=True)
    limit = (batch.agg(F.max("ts")).first()[0] - dt.timedelta(days=2)).replace(minute=0, second=0, microsecond=0)
    once = dedup_first(odd.where("ts IS NOT NULL").select("variable_id", "ts", "value"), ["variable_id", "ts"], ["value"])
    want = counter_to_power(once, ["variable_id"]).where(F.col("ts") < F.lit(limit)).toPandas().sort_values(["variable_id", "ts"]).reset_index(drop=True)
    assert len(want) > 250 and want["power"].isna().sum() > 4
    pd.testing.assert_frame_equal(got[["variable_id", "ts", "value", "power"]], want[["variable_id", "ts", "value", "power"]], check_dtype=False)


def test_keyed_state_holds_the_lateness_only(spark, landed, tmp_path):
    """After the run the state holds the hours of the last two days and one reading per meter, and a restart goes on from it."""
    root, batch = landed
    half, checkpoint, path = str(tmp_path / "in"), str(tmp_path / "c"), str(tmp_path / "o")
    for part in ("n < 200", "n >= 200"):
        batch.where(part).coalesce(1).write.mode("append").parquet(half)
        out = counter_power_state(source(spark, half), ["variable_id"])
        query = append_files(out, path, checkpoint)
        query.awaitTermination()
    held = spark.read.format("statestore").option("stateVarName", "waiting").load(checkpoint)
    meters_hours = batch.where(F.col("ts") > F.lit(batch.agg(F.max("ts")).first()[0] - dt.timedelta(days=2, hours=1)))
    assert 0 < held.count() <= meters_hours.count()
    got = spark.read.schema(out.schema).parquet(path)
    limit = (batch.agg(F.max("ts")).first()[0] - dt.timedelta(days=2)).replace(minute=0, second=0, microsecond=0)
    want = counter_to_power(batch, ["variable_id"]).where(F.col("ts") < F.lit(limit)).select("variable_id", "ts", "power")
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def rows_of(df):
    return sorted(map(tuple, df.select("variable_id", "ts", "value", "n").collect()))


def test_merge_rewrites_touched_partitions_only(spark, landed, tmp_path):
    """Batches that touch some months leave the files of the others, and reads see one version of each."""
    root, batch = landed
    table, keys = str(tmp_path / "t"), ["variable_id", "ts"]
    keyed = batch.withColumn("ts", F.date_trunc("day", "ts"))
    old = keyed.withColumn("ts", F.col("ts") - F.expr("INTERVAL 60 DAYS")).withColumn("value", F.lit(-1.0))
    history = old.unionByName(keyed.where("n < 50").withColumn("value", F.lit(-2.0)))
    start_merged(history, table, keys, ["n"], buckets=3)
    before = {f for f in merged_table(spark, table, SCHEMA).inputFiles() if "part=2023" in f}
    late = source(spark, root).withColumn("ts", F.date_trunc("day", "ts"))
    merge_stream(late, table, str(tmp_path / "c"), keys, ["n"], buckets=3).awaitTermination()
    got = merged_table(spark, table, SCHEMA)
    want = upsert(dedup_last(history, keys, ["n"]), keyed, keys, ["n"])
    assert rows_of(got) == rows_of(want)
    files = got.inputFiles()
    parts = [f.split("/part=")[1].split("/")[0] for f in files]
    versions = {(p, f.split("/version=")[1].split("/")[0]) for p, f in zip(parts, files)}
    assert before and before <= set(files) and len(versions) == len(set(parts))


def test_merge_survives_lost_and_repeated_runs(spark, landed, tmp_path):
    _, batch = landed
    table, keys = str(tmp_path / "t"), ["variable_id", "ts"]
    start_merged(batch.limit(0), table, keys)
    assert merged_table(spark, table, SCHEMA).count() == 0
    merge_batch(batch.where("n < 300"), table, 1, keys, ["n"])
    first = rows_of(merged_table(spark, table, SCHEMA))
    # A run that was lost after it had written some of its data, before its manifest rows.
    batch.withColumn("part", F.date_format("ts", "yyyy-MM-'0'")).write.partitionBy("part").parquet(f"{table}/data/version=2")
    assert rows_of(merged_table(spark, table, SCHEMA)) == first == rows_of(batch.where("n < 300"))
    late = batch.where("n >= 200").withColumn("value", F.lit(7.0))
    for _ in range(2):  # the second time it is known already
        merge_batch(late, table, 2, keys, ["n"])
        assert rows_of(merged_table(spark, table, SCHEMA)) == rows_of(upsert(batch.where("n < 300"), late, keys, ["n"]))
    merge_batch(late.limit(0), table, 3, keys, ["n"])
    assert merged_table(spark, table, SCHEMA).count() == batch.count()
