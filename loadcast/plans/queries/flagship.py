"""The flagship query: readings to a model-ready 15-minute panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ...functions.calendar import add_calendar
from ...operators.lags import lag_time
from .base import GRID, TZ, Tables, closed, computus, deliver, local, query, rnd

SQL = f"""WITH {computus()}, {GRID}, x AS (SELECT g.variable_id, g.ts, g.value AS y, l.value AS lag_48h, {local('g.ts')} AS lt FROM g
      LEFT JOIN g l ON l.variable_id = g.variable_id AND l.ts = g.ts - INTERVAL 48 hour)
    SELECT variable_id, ts, {rnd('y')} AS y, {rnd('lag_48h')} AS lag_48h, lt AS ts_local, CAST(month(lt) - 1 AS INTEGER) AS month,
      CAST(isodow(lt) - 1 AS INTEGER) AS day_of_week, CAST(hour(lt) * 4 + minute(lt) // 15 AS INTEGER) AS quarter_hour,
      {rnd('sin(2 * pi() * (month(lt) - 1) / 12)')} AS sin_month, {rnd('cos(2 * pi() * (month(lt) - 1) / 12)')} AS cos_month,
      {rnd('sin(2 * pi() * (isodow(lt) - 1) / 7)')} AS sin_day_of_week, {rnd('cos(2 * pi() * (isodow(lt) - 1) / 7)')} AS cos_day_of_week,
      {rnd('sin(2 * pi() * (hour(lt) * 4 + minute(lt) // 15) / 96)')} AS sin_quarter, {rnd('cos(2 * pi() * (hour(lt) * 4 + minute(lt) // 15) / 96)')} AS cos_quarter,
      CAST({closed('lt', 'CAST(lt AS DATE) IN (SELECT day FROM hol)')} AS INTEGER) AS campus_closed FROM x"""


@query("feature_panel", SQL)
def feature_panel(t: Tables) -> DataFrame:
    lagged = lag_time(t.grid.withColumnRenamed("value", "y"), ["variable_id"], "y", [48])
    return add_calendar(lagged, t.event_holidays, TZ)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliver(feature_panel(Tables(spark, sf_dir)))
