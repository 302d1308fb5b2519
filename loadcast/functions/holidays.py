"""Public-holiday dimension of Italy, generated for a span of years.

Size: thirteen rows per year at most, whatever the size of the fact tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (name, month, day, first year, last year) of holidays with a fixed date.
FIXED_DAYS = [
    ("New Year", 1, 1, 1900, 9999),
    ("Epiphany", 1, 6, 1900, 1977),
    ("Epiphany", 1, 6, 1986, 9999),
    ("Liberation Day", 4, 25, 1946, 9999),
    ("Labour Day", 5, 1, 1946, 9999),
    ("Republic Day", 6, 2, 1948, 1976),
    ("Republic Day", 6, 2, 2001, 9999),
    ("Assumption", 8, 15, 1900, 9999),
    ("Saint Francis", 10, 4, 2026, 9999),
    ("All Saints", 11, 1, 1900, 9999),
    ("Immaculate Conception", 12, 8, 1900, 9999),
    ("Christmas", 12, 25, 1900, 9999),
    ("Saint Stephen", 12, 26, 1900, 9999),
]


# Gregorian Easter by integer arithmetic (the anonymous Gregorian computus), from ``year``.
EASTER_SQL = """
SELECT make_date(year, int(q div 31), int(q % 31 + 1)) AS sunday
FROM (SELECT year, epact + wd - 7 * ((golden + 11 * epact + 22 * wd) div 451) + 114 AS q
  FROM (SELECT *, (32 + 2 * (century % 4) + 2 * ((year % 100) div 4) - epact - (year % 100) % 4) % 7 AS wd
    FROM (SELECT year, golden, century,
        (19 * golden + century - century div 4 - (century - (century + 8) div 25 + 1) div 3 + 15) % 30 AS epact
      FROM (SELECT year, year % 19 AS golden, year div 100 AS century FROM {years}))))
"""


def holiday_dimension(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Rows ``(country, day, name)`` for the inclusive span of years."""
    years = spark.range(first_year, last_year + 1, 1, 1).selectExpr("int(id) AS year")
    rules = ", ".join(f"('{n}', {m}, {d}, {a}, {b})" for n, m, d, a, b in FIXED_DAYS)
    return spark.sql(
        f"""
        WITH easter AS ({EASTER_SQL.format(years="{years}")}),
        rules AS (SELECT * FROM VALUES {rules} AS r(name, m, d, first, last))
        SELECT 'IT' AS country, make_date(year, m, d) AS day, name FROM {{years}} JOIN rules ON year BETWEEN first AND last
        UNION ALL SELECT 'IT', sunday, 'Easter Sunday' FROM easter
        UNION ALL SELECT 'IT', date_add(sunday, 1), 'Easter Monday' FROM easter
        """,
        years=years,
    )
