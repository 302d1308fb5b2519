"""Chunked primitives against pandas, with chunks far smaller than the series."""

import numpy as np
import pandas as pd
import pytest
from conftest import stamps
from pyspark.sql import functions as F

from loadcast.functions.timecols import epoch_s
from loadcast.operators.interpolate import fill_linear, fill_time
from loadcast.operators.lags import lag_onto_horizon, lag_rows, lag_time, lag_time_join
from loadcast.operators.meters import counter_to_power
from loadcast.operators import ordered
from loadcast.operators.ordered import RAW_CHUNK, exact_lags, known_neighbours, previous_row, row_position
from loadcast.operators.splits import fold_contiguous, fold_expanding, last_rows

HOUR = 3600


@pytest.fixture(scope="module")
def series(spark):
    """Two series of uneven length with holes; the first holds most of the rows."""
    rng = np.random.default_rng(3)
    rows = []
    for k, n in (("a", 300), ("b", 37), ("c", 1)):
        for ts in stamps("2024-01-01", n):
            if rng.random() > 0.25 or n == 1:
                rows.append((k, ts, float(np.round(rng.normal(), 3)) if rng.random() > 0.4 else None))
    pdf = pd.DataFrame(rows, columns=["k", "ts", "v"]).astype({"v": float})
    return spark.createDataFrame(rows, "k string, ts timestamp, v double").cache(), pdf


def collected(df, *by):
    return df.toPandas().sort_values(list(by)).reset_index(drop=True)


@pytest.mark.parametrize("span", [900, 4 * HOUR, 400 * HOUR])
def test_previous_row_crosses_chunks(series, span):
    df, pdf = series
    got = collected(previous_row(df, ["k"], "ts", ["v"], span), "k", "ts")
    want = pdf.sort_values(["k", "ts"]).reset_index(drop=True)
    pd.testing.assert_series_equal(got["prev_v"], want.groupby("k")["v"].shift(1), check_names=False)
    assert (got["prev_ts"].isna() == want.groupby("k")["ts"].shift(1).isna()).all()


@pytest.mark.parametrize("span", [900, 5 * HOUR])
def test_row_position(series, span):
    df, pdf = series
    got = collected(row_position(df, ["k"], "ts", span), "k", "ts")
    want = pdf.sort_values(["k", "ts"]).groupby("k").cumcount()
    assert got["pos"].tolist() == want.tolist()
    assert got["n_rows"].tolist() == pdf.sort_values(["k", "ts"]).groupby("k")["ts"].transform("size").tolist()


@pytest.mark.parametrize("span", [2 * HOUR, 100 * HOUR])
def test_exact_lags(series, span):
    df, pdf = series
    lags = {"l1": ("v", HOUR), "l7": ("v", 7 * HOUR)}
    got = collected(exact_lags(df, ["k"], epoch_s("ts"), lags, span), "k", "ts")
    assert len(got) == len(pdf)
    at = {(k, ts): v for k, ts, v in pdf.itertuples(index=False)}
    for name, hours in (("l1", 1), ("l7", 7)):
        want = [at.get((k, ts - pd.Timedelta(hours=hours)), np.nan) for k, ts in zip(got["k"], got["ts"])]
        np.testing.assert_array_equal(got[name], want)


@pytest.mark.parametrize("span", [1800, 6 * HOUR, 1000 * HOUR])
@pytest.mark.parametrize("limit,both", [(2, False), (None, True), (None, False)])
def test_fill_matches_pandas(spark, span, limit, both):
    rng = np.random.default_rng(5)
    v = pd.Series(rng.normal(size=200)).where(rng.random(200) > 0.7)
    v[:5] = np.nan
    v[60:120] = np.nan
    v[-6:] = np.nan
    rows = [("a", ts, None if np.isnan(x) else float(x)) for ts, x in zip(stamps("2024-03-01", 200), v)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    got = collected(fill_linear(df, ["k"], ["v"], limit=limit, both=both, span=span), "ts")["v"]
    want = v.interpolate(limit=limit, limit_direction="both" if both else "forward")
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_fill_leaves_an_empty_series_empty(spark):
    df = spark.createDataFrame([("a", t, None) for t in stamps("2024-01-01", 5)], "k string, ts timestamp, v double")
    assert fill_time(df, ["k"], ["v"]).where("v IS NOT NULL").count() == 0


def test_lag_by_rows_reaches_across_a_hole_and_lag_by_time_does_not(spark):
    kept = [t for i, t in enumerate(stamps("2024-01-01", 40)) if not 8 <= i < 12]
    df = spark.createDataFrame([("a", t, float(i)) for i, t in enumerate(kept)], "k string, ts timestamp, y double")
    rows = collected(lag_rows(df, ["k"], "y", [1]), "ts")
    time = collected(lag_time(df, ["k"], "y", [1]), "ts")
    join = collected(lag_time_join(df, ["k"], 1), "ts")
    assert rows["lag_1h"].tolist()[4:] == [float(i) for i in range(len(kept) - 4)]
    pd.testing.assert_series_equal(time["lag_1h"], join["lag_1h"])
    assert time["lag_1h"].isna().sum() == 4 + 4
    whole = spark.createDataFrame([("a", t, float(i)) for i, t in enumerate(stamps("2024-01-01", 40))], df.schema)
    a, b = collected(lag_rows(whole, ["k"], "y", [1]), "ts"), collected(lag_time(whole, ["k"], "y", [1]), "ts")
    pd.testing.assert_frame_equal(a, b)


def test_lag_onto_horizon(spark):
    hist = spark.createDataFrame([("a", t, float(i)) for i, t in enumerate(stamps("2024-01-01", 8))], "k string, ts timestamp, y double")
    ahead = spark.createDataFrame([("a", t) for t in stamps("2024-01-01 02:00", 6)], "k string, ts timestamp")
    got = collected(lag_onto_horizon(hist, ahead, ["k"], "y", [1, 2]), "ts")
    assert got["lag_2h"].tolist() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    np.testing.assert_array_equal(got["lag_1h"], [4.0, 5.0, 6.0, 7.0, np.nan, np.nan])


def test_counter_reset(spark):
    df = spark.createDataFrame(
        [("m", t, e) for t, e in zip(stamps("2024-01-01 00:30", 4), [10.0, 12.0, 1.0, 3.0])], "k string, ts timestamp, value double"
    )
    got = collected(counter_to_power(df, ["k"], span=1800), "ts")["power"]
    np.testing.assert_array_equal(got, [np.nan, 8.0, np.nan, 8.0])


def test_folds_and_tail(spark):
    df = spark.createDataFrame([(k, t) for k, n in (("a", 23), ("b", 2)) for t in stamps("2024-01-01", n)], "k string, ts timestamp")
    got = collected(fold_contiguous(df, ["k"], 3), "k", "ts")
    sizes = got[got.k == "a"].groupby("fold").size()
    assert sizes.tolist() == [8, 8, 7]
    assert got[got.k == "b"]["fold"].tolist() == [0, 1]
    own = got[got.k == "a"]["fold"]
    assert own.is_monotonic_increasing
    grown = collected(fold_expanding(df.where("k = 'a'"), ["k"], 3), "ts")["fold"]
    assert grown.is_monotonic_increasing
    assert grown.value_counts().to_dict() == {-1: 8, 0: 5, 1: 5, 2: 5}
    tail = collected(last_rows(df, ["k"], 5, span=HOUR), "k", "ts")
    assert tail.groupby("k").size().to_dict() == {"a": 5, "b": 2}
    assert tail[tail.k == "a"]["ts"].min() == stamps("2024-01-01", 23)[18]


def test_windows_are_split_by_chunk(series):
    """No window of a chunked operator puts a whole series of raw rows into one task."""
    df, _ = series
    plan = lag_time(df.withColumnRenamed("v", "y"), ["k"], "y", [48])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line or "Window(" in line]
    assert windows and all("_chunk" in line for line in windows)


@pytest.mark.parametrize("fan, span", [(2, 900), (3, 4 * HOUR)])
def test_summaries_are_carried_over_many_levels(series, monkeypatch, fan, span):
    """A tree of narrow blocks gives what one window per series gives, also before 1970, where chunks are negative."""
    monkeypatch.setattr(ordered, "FAN", fan)
    df, pdf = series
    monkeypatch.setattr(ordered, "LONGEST", span * fan**3)
    old = df.withColumn("ts", F.col("ts") - F.expr("INTERVAL 54 YEARS"))
    by_series = pdf.sort_values(["k", "ts"]).groupby("k")
    for rows in (df, old):
        got = collected(previous_row(rows, ["k"], "ts", ["v"], span), "k", "ts")
        pd.testing.assert_series_equal(got["prev_v"], by_series["v"].shift(1).reset_index(drop=True), check_names=False)
        got = collected(row_position(rows, ["k"], "ts", span), "k", "ts")
        assert got["pos"].tolist() == by_series.cumcount().tolist()
        assert got["n_rows"].tolist() == by_series["k"].transform("size").tolist()
        got = collected(known_neighbours(rows, ["k"], "ts", ["v"], span), "k", "ts")
        for name, want in (("_pv_v", by_series["v"].ffill()), ("_nv_v", by_series["v"].bfill())):
            pd.testing.assert_series_equal(got[name], want.reset_index(drop=True), check_names=False)


def test_slow_readings_of_a_hot_series(spark):
    """Ten years of one-hour readings fill one chunk each, and no window takes all chunks of the series."""
    n = 10 * 365 * 24
    rows = spark.range(0, n, 1, 8).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * HOUR + 7).alias("ts"), F.col("id").cast("double").alias("value"))
    power = counter_to_power(rows, ["k"])
    got = power.agg(F.count("power").alias("n"), F.min("power").alias("a"), F.max("power").alias("z")).first()
    assert tuple(got) == (n - 1, 1.0, 1.0)
    summary = rows.groupBy("k", ordered.chunk_of(epoch_s("ts"), RAW_CHUNK).alias("_chunk")).agg(F.max("value").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        carried = ordered.carry(summary, ["k"], {"c": ("before", "x")}, RAW_CHUNK)
        per_task = [r["n"] for r in carried.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("c")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == n and max(per_task) < 0.6 * n and len(per_task) >= 3
