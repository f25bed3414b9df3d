"""Calendar expressions on UTC instants and dates, mostly as SQL text. Monday is day 0.

Holiday rules read the column `year`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Edmonton"


def hours(count: int | Column) -> Column:
    return F.make_dt_interval(F.lit(0), count if isinstance(count, Column) else F.lit(count))


def local_time(ts: str) -> str:
    """SQL text of the local clock time of a UTC instant."""
    return f"from_utc_timestamp({ts}, '{LOCAL_ZONE}')"


def with_easter(df: DataFrame, year: str = "year", name: str = "easter") -> DataFrame:
    """Add Gregorian Easter Sunday by the anonymous (Meeus/Jones/Butcher) computus.

    Each step is its own column because later steps use it several times;
    nested in one expression the formula would repeat itself many times over.
    """
    steps = {
        "_century": "{y} div 100",
        "_moon": "(19 * ({y} % 19) + _century - _century div 4 - (_century - (_century + 8) div 25 + 1) div 3 + 15) % 30",
        "_to_sunday": "(32 + 2 * (_century % 4) + 2 * (({y} % 100) div 4) - _moon - ({y} % 100) % 4) % 7",
        "_days": "_moon + _to_sunday - 7 * (({y} % 19 + 11 * _moon + 22 * _to_sunday) div 451) + 114",
        name: "make_date({y}, cast(_days div 31 as int), cast(_days % 31 + 1 as int))",
    }
    for column, formula in steps.items():
        df = df.withColumn(column, F.expr(formula.format(y=year)))
    return df.drop("_century", "_moon", "_to_sunday", "_days")


def nth_monday(month: int, nth: int) -> str:
    first = f"make_date(year, {month}, 1)"
    return f"date_add({first}, (7 - weekday({first})) % 7 + {7 * (nth - 1)})"


def monday_on_or_before(month: int, day: int) -> str:
    at = f"make_date(year, {month}, {day})"
    return f"date_sub({at}, weekday({at}))"


def weekend_moved(day: str) -> str:
    """Saturday moves two days on and Sunday one, both to Monday."""
    return f"date_add({day}, case weekday({day}) when 5 then 2 when 6 then 1 else 0 end)"
