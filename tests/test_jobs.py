"""Pieces of the jobs that the registered queries do not reach."""

import datetime as dt

import pytest
from conftest import stamps
from pyspark.sql import functions as F

from loadcast.operators.clean import drop_incomplete, require_rows
from loadcast.operators.splits import time_split
from loadcast.plans.load import electric_targets, missing_block
from loadcast.plans.pricejobs import market_days, market_update, update_prices
from loadcast.sources.panel import payload_json, to_payload, write_metrics

TZ = "Europe/Rome"


def meters(spark, *rows):
    return spark.createDataFrame([("S", *r) for r in rows], "site_id string, cabin string, role string, position int, variable_id string")


def readings(spark, **series):
    rows = [("S", k, t, v) for k, values in series.items() for t, v in zip(stamps("2024-01-01", len(values)), values) if v is not None]
    return spark.createDataFrame(rows, "site_id string, variable_id string, ts timestamp, value double")


def targets_at(df, i):
    when = stamps("2024-01-01", i + 1)[i]
    return {r["target"]: r["y"] for r in df.collect() if r["ts"] == when}


def test_balance_and_totals(spark):
    m = meters(spark, ("C1", "net", 0, "n1"), ("C2", "net", 0, "n2"), ("C2", "pv_main", 0, "e2"), ("C2", "pv_backup", 0, "e2"),
               ("G", "grid", 0, "g"), ("H", "chp", 0, "h"), ("C9", "pv_main", 0, "e9"))
    r = readings(spark, n1=[1.0, 2.0, 3.0], n2=[4.0, 5.0, 6.0], e2=[0.0, 2.0, None], e9=[0.0, 9.0, 18.0], g=[10.0, 20.0, 30.0], h=[1.0, None, 1.0])
    out = electric_targets(r, m, "C10")
    second = targets_at(out, 1)
    # CHP is filled to 1.0; C2 adds 2 kWh in a quarter-hour = 8 kW of PV.
    assert second["gross_el_cons_C1"] == 2.0 and second["gross_el_cons_C2"] == 13.0
    assert second["gross_el_cons_C10"] == 21.0 - 7.0 and second["CONS_TOT_NET_kW"] == 21.0
    assert second["CONS_TOT_kW"] == 2.0 + 13.0 + 14.0
    third = targets_at(out, 2)
    assert third["gross_el_cons_C2"] is None  # it has PV, whose value is missing
    assert "gross_el_cons_C9" not in second
    strict = targets_at(electric_targets(r, m, "C10", gross_min=3, net_min=3), 2)
    assert strict["CONS_TOT_kW"] is None and strict["CONS_TOT_NET_kW"] is None


def test_residual_cabin_with_pv(spark):
    """Its gross is what the others leave of the supply, plus its own PV."""
    m = meters(spark, ("C1", "net", 0, "n1"), ("C10", "pv_main", 0, "e"), ("G", "grid", 0, "g"))
    r = readings(spark, n1=[1.0, 2.0, 3.0], e=[0.0, 2.0, None], g=[10.0, 20.0, 30.0])
    second, third = (targets_at(electric_targets(r, m, "C10"), i) for i in (1, 2))
    assert second["gross_el_cons_C10"] == 18.0 + 8.0 and second["CONS_TOT_kW"] == 2.0 + 26.0
    assert third["gross_el_cons_C10"] is None and third["CONS_TOT_kW"] == 3.0


def test_one_bad_document_fails_its_own_day(spark):
    good = '{"r": [{"Zone": "N", "Price": 1}, {"Zone": "S", "Price": 2}]}'
    rows = [(dt.date(2025, 3, 1), good), (dt.date(2025, 3, 2), "not json"), (dt.date(2025, 3, 3), '[{"Zone": "N", "Price": 1}]'), (dt.date(2025, 3, 4), good)]
    docs = spark.createDataFrame(rows, "day date, doc string")
    history = spark.createDataFrame([(z, dt.datetime(2025, 2, 28, 12), 1.0) for z in ("N", "S")], "zone string, ts timestamp, price double")
    current, failed = market_update(history, docs, ["N", "S"], F.lit("2025-03-05").cast("date"), TZ)
    assert {(str(r["day"]), r["reason"]) for r in failed.collect()} == {
        ("2025-03-02", "no records"), ("2025-03-03", "lacks S"), ("2025-03-05", "not landed")
    }
    assert current.count() == 6
    with pytest.warns(UserWarning, match="2025-03-02"):
        assert update_prices(history, docs, ["N", "S"], F.lit("2025-03-05").cast("date"), TZ).count() == 6


def test_missing_block_takes_only_what_is_due(spark):
    r = readings(spark, a=[float(i) for i in range(96 * 6)])
    history = spark.createDataFrame([("S", dt.datetime(2024, 1, 2, 10))], "site_id string, ts timestamp")
    got = missing_block(r, history, F.lit("2024-01-06 09:00:00").cast("timestamp"), TZ, delay_days=2)
    span = got.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    assert span[0] == dt.datetime(2024, 1, 2, 10, 15) and span[1] == dt.datetime(2024, 1, 4, 22, 45)
    assert span[2] == (span[1] - span[0]) // dt.timedelta(minutes=15) + 1


def test_market_days_on_a_clock_change_and_idempotent_update(spark):
    rows = [f'{{"Zone": "{z}", "Price": {h}.5}}' for h in range(23) for z in ("N", "S", "other")]
    docs = spark.createDataFrame([(dt.date(2025, 3, 30), '{"r": [' + ",".join(rows) + "]}")], "day date, doc string")
    got = market_days(docs, ["N", "S"], TZ).where("zone = 'N'").orderBy("ts").collect()
    assert len(got) == 23 and len({r["ts"] for r in got}) == 23
    assert got[0]["ts"] == dt.datetime(2025, 3, 29, 23) and got[2]["ts_local"] == dt.datetime(2025, 3, 30, 3)
    assert [r["price"] for r in got] == [h + 0.5 for h in range(23)]
    history = spark.createDataFrame([(z, dt.datetime(2025, 3, 29, 12), 1.0) for z in ("N", "S")], "zone string, ts timestamp, price double")
    target = F.lit("2025-03-30").cast("date")
    once = update_prices(history, docs, ["N", "S"], target, TZ).cache()
    again = update_prices(once, docs, ["N", "S"], target, TZ)
    assert once.count() == 48 and again.exceptAll(once).count() == 0 and again.count() == 48


def test_small_parts(spark, tmp_path):
    df = spark.createDataFrame([(t, float(i) if i else None) for i, t in enumerate(stamps("2024-01-01", 4))], "ts timestamp, y double")
    assert drop_incomplete(df).count() == 3
    train, test = time_split(df, F.lit("2024-01-01 00:15:00").cast("timestamp"))
    assert train.count() == 2 and test.count() == 2
    with pytest.raises(ValueError, match="nothing here"):
        require_rows(df.where("y > 99"), "nothing here")
    f = df.select(F.lit("t").alias("target"), "ts", F.col("y").alias("yhat"))
    body = payload_json(to_payload(f)).first()["body"]
    assert body.startswith('[{"variable_id":"t","samples":[{"timestamp":1704067200000,"value":0.0}')
    write_metrics(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 4
