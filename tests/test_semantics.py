"""Sharp cases: nulls, clock changes, closures, upserts, price documents."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from conftest import stamps
from pyspark.sql import functions as F

from loadcast.functions.calendar import mark_holidays, site_closed
from loadcast.functions.holidays import holiday_dimension
from loadcast.functions.scalars import clip, row_sum, to_num, zero_in_months
from loadcast.functions.timecols import market_stamp, parse_ts
from loadcast.operators.clean import conform, dedup_first, dedup_last, discover_targets, exclude_window_table, exclude_windows
from loadcast.operators.grid import day_horizon, resample_mean, to_grid
from loadcast.operators.history import missing_dates, next_window, params_for, upsert, zone_prices
from loadcast.operators.meters import gross, net_mean_of_sums, net_sum_of_means, pair_meters, prefer_main
from loadcast.sources.panel import read_panel, to_payload, upsert_panel, write_panel
from loadcast.sources.prices import extract_zone_prices
from loadcast.sources.readings import from_records

TZ = "Europe/Rome"


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (9.0,), (-1.0,)], "v double")
    assert [r[0] for r in df.select(clip("v", 0, 5)).collect()] == [1.0, None, 5.0, 0.0]


def test_row_sum_min_count(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (1.0, 2.0)], "a double, b double")
    got = df.select(row_sum(["a", "b"], 1), row_sum(["a", "b"], 2)).collect()
    assert [tuple(r) for r in got] == [(None, None), (1.0, None), (3.0, 3.0)]


def test_sum_of_means_differs_from_mean_of_sums(spark):
    t = stamps("2024-01-01", 2, 5)
    df = spark.createDataFrame([("a", t[0], 2.0), ("a", t[1], 4.0), ("b", t[0], 10.0)], "m string, ts timestamp, value double")
    df = df.withColumn("g", F.lit("C1"))
    assert net_sum_of_means(df, ["g"], "m").first()["net"] == 13.0
    assert net_mean_of_sums(df, ["g"], "m").first()["net"] == 8.0
    same = df.where(F.col("ts") == F.lit(t[0]))
    assert net_sum_of_means(same, ["g"], "m").first()["net"] == net_mean_of_sums(same, ["g"], "m").first()["net"]


def test_gross(spark):
    df = spark.createDataFrame([(5.0, None, False), (5.0, None, True), (5.0, 2.0, True)], "n double, p double, h boolean")
    assert [r[0] for r in df.select(gross(F.col("n"), F.col("p"), F.col("h"))).collect()] == [5.0, None, 7.0]


def test_summer_zero_comes_after_the_clip(spark):
    rows = [(dt.datetime(2024, 7, 1, 12), None), (dt.datetime(2024, 7, 1, 12), 14000.0), (dt.datetime(2024, 1, 1, 12), 14000.0),
            (dt.datetime(2024, 1, 1, 12), -3.0), (dt.datetime(2024, 4, 30, 22, 30), 7.0)]
    df = spark.createDataFrame(rows, "ts timestamp, v double")
    got = [r[0] for r in df.select(zero_in_months(clip("v", 0, 13000), "ts", (5, 6, 7, 8, 9), TZ)).collect()]
    assert got == [0.0, 0.0, 13000.0, 0.0, 0.0]  # 22:30 UTC on 30 April is May in Rome


@pytest.mark.parametrize("day,n", [("2025-03-30", 92), ("2025-06-01", 96), ("2025-10-26", 100)])
def test_local_day_length(spark, day, n):
    one = spark.createDataFrame([("S1",)], "site_id string")
    got = day_horizon(one, ["site_id"], F.lit(day).cast("date"), TZ).toPandas()["ts"].sort_values()
    assert len(got) == n and got.diff().dropna().eq(pd.Timedelta("15min")).all()


@pytest.mark.parametrize("day,n,last", [("2025-03-30", 23, "2025-03-30 21:00:00"), ("2025-10-26", 25, "2025-10-26 22:00:00")])
def test_market_stamps_are_distinct_on_clock_changes(spark, day, n, last):
    got = spark.range(n).select(market_stamp(F.lit(day).cast("date"), "id", 3600, TZ).alias("ts")).toPandas()["ts"]
    assert got.nunique() == n and got.max() == pd.Timestamp(last)


def test_closure_rules(spark):
    cases = [("2024-01-07 12:00", 1), ("2024-02-10 19:45", 0), ("2024-02-10 20:00", 1), ("2024-02-12 06:45", 1), ("2024-02-12 07:00", 0),
             ("2024-12-23 10:00", 1), ("2025-01-03 10:00", 1), ("2023-01-04 10:00", 0), ("2024-08-13 10:00", 1), ("2024-04-01 10:00", 1),
             ("2024-04-25 10:00", 1), ("2024-02-12 21:00", 1)]
    df = spark.createDataFrame([(pd.Timestamp(t).to_pydatetime(), c) for t, c in cases], "ts_local timestamp, want int")
    marked = mark_holidays(df, holiday_dimension(spark, 2022, 2026))
    got = marked.select("ts_local", "want", site_closed("ts_local", "is_holiday").alias("got")).collect()
    assert len(got) == len(cases) and all(r["got"] == r["want"] for r in got), got


def test_easter(spark):
    days = holiday_dimension(spark, 1995, 2026).where("name = 'Easter Sunday'").toPandas()["day"].astype(str).tolist()
    for known in ("1995-04-16", "2000-04-23", "2008-03-23", "2011-04-24", "2024-03-31", "2025-04-20", "2026-04-05"):
        assert known in days
    assert len(days) == 32


def test_parse_ts_and_numbers(spark):
    texts = ["2024-06-08", "2024-06-08T08:00:00", "2024-06-08T08:00:00+02:00", " None ", "", "NULL", "no", "soon"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(parse_ts("s").cast("string")).collect()]
    assert got == ["2024-06-08 00:00:00", "2024-06-08 08:00:00", "2024-06-08 06:00:00", None, None, None, None, None]
    nums = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "s string").select(to_num("s")).collect()
    assert [r[0] for r in nums] == [1.5, None, None, None]


def test_grid_row_count_and_empty_bins(spark):
    rows = [("a", pd.Timestamp(t).to_pydatetime(), v) for t, v in (("2024-01-01 00:07", 1.0), ("2024-01-01 00:14", 3.0), ("2024-01-03 11:59", 5.0))]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    got = resample_mean(df, ["k"]).toPandas().sort_values("ts")
    assert len(got) == (pd.Timestamp("2024-01-03 11:45") - pd.Timestamp("2024-01-01")) // pd.Timedelta("15min") + 1
    assert got["value"].dropna().tolist() == [2.0, 5.0]
    assert to_grid(resample_mean(df, ["k"]), ["k"]).count() == len(got)


def test_dedup_and_upsert(spark):
    t = stamps("2024-01-01", 2)
    df = spark.createDataFrame([("a", t[0], 1.0, 1), ("a", t[0], None, 2), ("a", t[1], 3.0, 3)], "k string, ts timestamp, v double, n int")
    assert sorted(r["n"] for r in dedup_first(df, ["k", "ts"], ["n"]).collect()) == [1, 3]
    last = {r["ts"]: r["v"] for r in dedup_last(df, ["k", "ts"], ["n"]).collect()}
    assert last == {t[0]: None, t[1]: 3.0}  # the last row wins whole, NULL included
    base = dedup_first(df, ["k", "ts"], ["n"])
    new = spark.createDataFrame([("a", t[1], 9.0, 0), ("b", t[0], 2.0, 0)], df.schema)
    once = upsert(base, new, ["k", "ts"])
    twice = upsert(once, new, ["k", "ts"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {(r["k"], r["ts"]): r["v"] for r in once.collect()}[("a", t[1])] == 9.0


def test_upsert_panel_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "panel")
    schema = "target string, ts timestamp, y double, site_id string, month string"
    cols = "site_id string, target string, ts timestamp, y double"
    rows = [("S1", "x", dt.datetime(2024, m, 5), float(m)) for m in (1, 2, 3)]
    write_panel(spark.createDataFrame(rows, cols), path)
    before = sorted(str(p) for p in (tmp_path / "panel").rglob("*.parquet") if "2024-01" in str(p))
    new = spark.createDataFrame([("S1", "x", dt.datetime(2024, 2, 5), 20.0), ("S1", "x", dt.datetime(2024, 4, 5), 4.0)], cols)
    for _ in range(2):
        upsert_panel(spark, path, schema, new, ["site_id", "target", "ts"])
    got = {r["ts"].month: r["y"] for r in read_panel(spark, path, schema).collect()}
    assert got == {1: 1.0, 2: 20.0, 3: 3.0, 4: 4.0}
    assert before == sorted(str(p) for p in (tmp_path / "panel").rglob("*.parquet") if "2024-01" in str(p))


def _dates(spark, a, b):
    rows = [(z, dt.date(2024, 1, d)) for z, ds in (("A", a), ("B", b)) for d in ds]
    return spark.createDataFrame(rows, "zone string, day date")


def test_missing_dates(spark):
    def due(a, b, target):
        got = missing_dates(_dates(spark, a, b), ["A", "B"], F.lit(target).cast("date")).collect()
        return sorted(r["day"].day for r in got)

    assert due([1, 2, 3, 4, 5], [1, 2, 3, 5], "2024-01-07") == [6, 7]
    assert due([1, 2, 3, 5], [1, 2, 3], "2024-01-05") == [4, 5]
    assert due([], [], "2024-01-07") == [7]
    assert due([7], [7], "2024-01-07") == []


def test_next_window(spark):
    rows = [("a", dt.datetime(2024, 3, 28, 10)), ("b", dt.datetime(2024, 4, 2)), ("c", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    got = {r["k"]: r for r in next_window(df, ["k"], F.lit("2024-04-02 10:00:00").cast("timestamp"), TZ, 2, 10).collect()}
    assert set(got) == {"a", "c"}
    assert got["a"]["window_start"] == dt.datetime(2024, 3, 28, 10, 15)
    assert got["a"]["window_end"] == dt.datetime(2024, 3, 31, 21, 45)  # 23:45 in summer time
    assert got["c"]["window_start"] == dt.datetime(2024, 3, 22, 23)


def test_errors_name_what_is_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="c"):
        conform(df, ["a", "c"])
    with pytest.raises(ValueError):
        discover_targets(["x"], "gross_")
    with pytest.raises(ValueError):
        exclude_windows(df, None, [("2024-02-01", "2024-01-01")])
    targets = spark.createDataFrame([("t1",), ("t2",)], "target string")
    with pytest.raises(ValueError, match="t2"):
        params_for(targets, spark.createDataFrame([("t1", 1)], "target string, trees int"))
    with pytest.raises(ValueError, match="B"):
        zone_prices(spark.createDataFrame([("A", 1.0)], "zone string, price double"), ["A", "B"])


def test_meter_pairs_and_backup(spark):
    schema = "site_id string, cabin string, role string, position int, variable_id string"
    meters = spark.createDataFrame(
        [("S", "C5", "pv_main", 0, "m0"), ("S", "C5", "pv_main", 1, "m1"), ("S", "C5", "pv_backup", 0, "b0"), ("S", "C9", "pv_backup", 0, "b9")], schema
    )
    got = {(r["cabin"], r["position"]): (r["main_id"], r["backup_id"]) for r in pair_meters(meters).collect()}
    assert got == {("C5", 0): ("m0", "b0"), ("C5", 1): ("m1", None), ("C9", 0): (None, "b9")}
    df = spark.createDataFrame([(1, "pv_main", None), (1, "pv_backup", 4.0), (2, "pv_main", 1.0), (2, "pv_backup", 4.0), (3, "pv_backup", 6.0)], "ts int, role string, value double")
    assert {r["ts"]: r["value"] for r in prefer_main(df, ["ts"]).collect()} == {1: 4.0, 2: 1.0, 3: 6.0}


def _first_records(node):
    """Plain recursive walk, to compare with."""
    if isinstance(node, list):
        if node and isinstance(node[0], dict) and {"Zone", "Price"} <= set(node[0]):
            return node
        for item in node:
            if (found := _first_records(item)) is not None:
                return found
    if isinstance(node, dict):
        if {"Zone", "Price"} <= set(node):
            return [node]
        for value in node.values():
            if (found := _first_records(value)) is not None:
                return found
    return None


DOCS = [
    [{"Zone": "N", "Price": 1.5}, {"Zone": "S", "Price": 2}],
    {"Zone": "N", "Price": 3},
    {"z": {"deep": [{"Zone": "late key", "Price": 1}]}, "a": [{"Zone": "early key", "Price": 2}]},
    {"x": [], "y": [1, "Zone", None, {"Zone": "only"}], "w": {"v": [[{"Zone": "N", "Price": "7.25"}]]}},
    [{"Zone": "no price"}, {"Zone": "N", "Price": 4}, {"Zone": "S", "Price": 5}],
    {"a": {"b": {"c": {"Zone": "obj", "Price": None}}}, "rows": [{"Zone": "N", "Price": 1}]},
    {"a": {"b": {"c": {"d": {"e": [[{"f": {"g": {"h": {"i": [{"j": {"k": [{"Zone": "deep", "Price": 6}]}}]}}}}]]}}}}},
]


def test_price_documents_match_a_plain_walk(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCS)], "doc_id int, doc string")
    got = extract_zone_prices(df).orderBy("doc_id", "position").toPandas()
    for i, doc in enumerate(DOCS):
        want = [(r["Zone"], float(r["Price"]) if r["Price"] is not None else None) for r in _first_records(doc)]
        have = [(z, None if np.isnan(p) else p) for z, p in got[got.doc_id == i][["zone", "price"]].itertuples(index=False)]
        assert have == want, (i, have, want)


def test_an_unknown_order_value_blanks_nothing(spark):
    rows = [("a", None, 7.0), ("b", None, 1.0), ("b", 5.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, price double, load double")
    for pick in (dedup_first, dedup_last):
        assert {r["k"]: (r["price"], r["load"]) for r in pick(df, ["k"], ["price"]).collect()} == {"a": (None, 7.0), "b": (5.0, 2.0)}


def test_a_document_without_prices_raises(spark):
    df = spark.createDataFrame([(1, '{"a": [1, 2]}')], "doc_id int, doc string")
    with pytest.raises(Exception, match="without Zone/Price"):
        extract_zone_prices(df).collect()


def test_records_and_payload(spark):
    rec = spark.createDataFrame([("v", [(1704067200123, 1.0), (1704067260000, float("nan"))])], "variable_id string, samples array<struct<timestamp:bigint,value:double>>")
    got = from_records(rec).orderBy("ts").collect()
    assert got[0]["ts"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000) and got[1]["value"] is None
    t = stamps("2024-01-01", 3)
    f = spark.createDataFrame([("y", t[2], 3.0), ("y", t[0], None), ("y", t[1], 2.0), ("other", t[0], 1.0)], "target string, ts timestamp, yhat double")
    rows = to_payload(f, {"y": "VAR"}).collect()
    assert len(rows) == 1 and rows[0]["variable_id"] == "VAR" and rows[0]["n_missing"] == 1
    assert [s["value"] for s in rows[0]["samples"]] == [0.0, 2.0, 3.0]
    assert rows[0]["samples"][0]["timestamp"] == 1704067200000


def test_many_bad_windows(spark):
    """10,000 windows of one site, overlapping, touching, nested and open, against each reading in turn."""
    import random

    rng = random.Random(4)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    month = 30 * 86400
    spans = [(a, a + rng.choice([0, 5, 60, 600])) for a in (rng.randrange(month) for _ in range(10_000))] + [(86400 * 3, 86400 * 9)]
    windows = [("S1", at(a), at(z)) for a, z in spans] + [("S2", None, at(86400)), ("S2", None, at(50)), ("S2", at(month - 86400), None), ("S3", None, None)]
    rows = [(site, at(rng.randrange(month)), k) for k, site in enumerate(["S1"] * 3000 + ["S2"] * 300 + ["S3"] * 30 + ["S4"] * 30)] + [("S1", None, -1)]
    covered = bytearray(month + 1000)
    for a, z in spans:
        covered[a : z + 1] = b"\1" * (z + 1 - a)
    off = lambda t: int((t - dt.datetime(2024, 1, 1)).total_seconds())
    bad = {"S1": lambda s: covered[s], "S2": lambda s: s <= 86400 or s >= month - 86400}
    want = sorted(k for site, t, k in rows if t is None or not bad.get(site, lambda s: False)(off(t)))
    readings = spark.createDataFrame(rows, "site string, ts timestamp, k int")
    table = spark.createDataFrame(windows, "site string, start_ts timestamp, end_ts timestamp")
    out = exclude_window_table(readings, table, ["site"])
    assert sorted(r["k"] for r in out.collect()) == want and 0 < len(want) < 2500
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert exclude_window_table(readings, table.limit(0), ["site"]).count() == len(rows)
    backwards = spark.createDataFrame([("S1", at(9), at(3))], table.schema)
    with pytest.raises(Exception, match="backwards"):
        exclude_window_table(readings, backwards, ["site"]).collect()
