"""Plans: hot series are spread, filters reach the scan, nothing runs in Python that need not."""

import pytest
from conftest import ROOT  # noqa: F401
from pyspark.sql import functions as F

from loadcast.functions.calendar import add_calendar
from loadcast.functions.holidays import holiday_dimension
from loadcast.operators.interpolate import fill_time
from loadcast.operators.lags import lag_rows, lag_time
from loadcast.operators.meters import counter_to_power
from loadcast.operators.splits import fold_contiguous, last_rows
from loadcast.plans.queries import QUERIES
from loadcast.session import shared_dir


@pytest.fixture(scope="module")
def hot(spark):
    """Two years of quarter-hours where one series is nearly everything."""
    steps = spark.range(0, 2 * 365 * 96, 1, 8).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(1700000100) + F.col("id") * 900).alias("ts"),
        F.when(F.col("id") % 7 != 3, F.col("id").cast("double")).alias("y"), "id",
    )
    return steps.unionByName(steps.where("id < 10").withColumn("k", F.lit("cold")))


OPERATORS = {
    "lag_time": lambda df: lag_time(df, ["k"], "y", [48, 168]),
    "lag_rows": lambda df: lag_rows(df, ["k"], "y", [48]),
    "fill": lambda df: fill_time(df, ["k"], ["y"]),
    "power": lambda df: counter_to_power(df, ["k"], energy="y"),
    "fold": lambda df: fold_contiguous(df, ["k"], 3),
}


@pytest.mark.parametrize("gathered", [False, True])
@pytest.mark.parametrize("name", OPERATORS)
def test_a_hot_series_is_spread_over_tasks(spark, hot, name, gathered):
    """Also when the rows arrive gathered by series, as they do after a join on it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = hot.repartition("k") if gathered else hot
    try:
        out = OPERATORS[name](rows)
        # The hash keeps every column, so that no window is pruned away.
        counted = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.xxhash64(*out.columns)))
        per_task = [r["n"] for r in counted.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == 2 * 365 * 96 + 10
    assert len(per_task) >= 4 and max(per_task) < 0.5 * sum(per_task)


def test_last_rows_on_a_hot_series(hot):
    got = last_rows(hot, ["k"], 500).groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("a")).collect()
    assert {r["k"]: (r["n"], r["a"]) for r in got} == {"hot": (500, 2 * 365 * 96 - 500), "cold": (10, 0)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["scan_readings_range", "time_window_filter"])
def test_filters_reach_the_scan(spark, sf_dir, name):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(mode)
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThanOrEqual(ts" in pushed
    assert "props" not in plan[plan.index("ReadSchema") :].splitlines()[0]


@pytest.mark.parametrize("name", ["feature_panel", "resample_15m_mean", "counter_to_power", "interp_limit2", "price_design_matrix", "campus_closed", "json_zone_price_extract"])
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "InPandas" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan


def test_six_lags_share_one_window(hot):
    plan = plan_of(lag_time(hot, ["k"]))
    assert plan.count("+- Window [") + plan.count("Window (") <= 2 and plan.count("Exchange hashpartitioning") == 1


def test_calendar_needs_no_shuffle_of_the_facts(spark, hot):
    plan = plan_of(add_calendar(hot, holiday_dimension(spark, 2023, 2026), "Europe/Rome"))
    assert "BroadcastHashJoin" in plan


def test_shared_folder_is_the_one_the_session_names(spark):
    class Conf:
        def get(self, key, default):
            return {"spark.checkpoint.dir": "/shared/folder"}.get(key, default)

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == "/shared/folder"
