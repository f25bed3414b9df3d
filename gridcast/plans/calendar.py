"""Hourly calendar with Alberta and Canada statutory holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.dates import local_time, monday_on_or_before, nth_monday, weekend_moved, with_easter


def time_bounds(df: DataFrame, ts: str) -> DataFrame:
    """One row: first and last hour. No rows when there is no data."""
    return df.agg(F.min(ts).alias("first_utc"), F.max(ts).alias("last_utc")).where("first_utc is not null")


def hourly_spine(bounds: DataFrame) -> DataFrame:
    """Every hour between the bounds, exploded by day first so that the days can be spread over tasks."""
    days = bounds.selectExpr("last_utc", "explode(sequence(first_utc, last_utc, interval 24 hours)) as from_utc")
    until = "least(last_utc, from_utc + interval 23 hours)"
    return days.repartition("from_utc").selectExpr(
        f"explode(sequence(from_utc, {until}, interval 1 hour)) as timestamp_utc"
    )


def holiday_years(bounds: DataFrame) -> DataFrame:
    """Local years of the span and one more on each side, for dates observed across New Year."""
    first, last = f"year({local_time('first_utc')})", f"year({local_time('last_utc')})"
    return bounds.selectExpr(f"explode(sequence({first} - 1, {last} + 1)) as year")


def holiday_dates(years: DataFrame) -> DataFrame:
    """Eleven holidays per year with their actual and observed dates."""
    fixed = "make_date(year, {}, {})".format
    # fixed values: name, actual date, date a weekend day is observed on (None: the Monday after), Alberta, Canada
    rules = [
        ("New Year\\'s Day", fixed(1, 1), None, True, True),
        ("Alberta Family Day", nth_monday(2, 3), None, True, False),
        ("Good Friday", "date_sub(easter, 2)", None, True, True),
        ("Victoria Day", monday_on_or_before(5, 24), None, True, True),
        ("Canada Day", fixed(7, 1), None, True, True),
        ("Labour Day", nth_monday(9, 1), None, True, True),
        ("National Day for Truth and Reconciliation", fixed(9, 30), None, False, True),
        ("Thanksgiving Day", nth_monday(10, 2), None, True, True),
        ("Remembrance Day", fixed(11, 11), None, True, True),
        ("Christmas Day", fixed(12, 25), fixed(12, 27), True, True),
        ("Boxing Day", fixed(12, 26), fixed(12, 28), False, True),
    ]
    entries = ", ".join(
        f"struct('{name}' as holiday_name, {actual} as actual_date, {moved or 'cast(null as date)'} as moved_date,"
        f" {alberta} as is_alberta_stat_holiday, {canada} as is_canada_stat_holiday)"
        for name, actual, moved, alberta, canada in rules
    )
    observed = f"if(weekday(actual_date) >= 5, coalesce(moved_date, {weekend_moved('actual_date')}), actual_date)"
    return with_easter(years).selectExpr("year", f"inline(array({entries}))").selectExpr(
        "year", "holiday_name", "actual_date", f"{observed} as observed_date",
        "is_alberta_stat_holiday", "is_canada_stat_holiday",
    )


_NAMES = "array_join(sort_array(collect_list(holiday_name)), ', ')"
# days of the Friday-to-Monday weekend of a holiday observed on a Monday or Friday
_WEEKEND = """case weekday(observed_date)
    when 0 then sequence(date_sub(observed_date, 3), observed_date)
    when 4 then sequence(observed_date, date_add(observed_date, 3)) end"""


def holidays_by_date(dates: DataFrame) -> DataFrame:
    return dates.groupBy(F.col("observed_date").alias("local_date")).agg(
        F.expr(f"{_NAMES} as holiday_name"),
        F.expr("bool_or(is_alberta_stat_holiday) as is_alberta_stat_holiday"),
        F.expr("bool_or(is_canada_stat_holiday) as is_canada_stat_holiday"),
    )


def long_weekend_days(dates: DataFrame) -> DataFrame:
    """Friday to Monday around every holiday observed on a Monday or a Friday."""
    return dates.selectExpr(f"explode({_WEEKEND}) as local_date").distinct()


def day_dimension(dates: DataFrame) -> DataFrame:
    """Holidays by date and long-weekend days as one dimension, one row per special day."""
    holiday = "struct(observed_date as local_date, holiday_name, is_alberta_stat_holiday, is_canada_stat_holiday, false as is_long_weekend)"
    weekend = f"""transform(coalesce({_WEEKEND}, array()), d -> struct(d as local_date, cast(null as string) as holiday_name,
        false as is_alberta_stat_holiday, false as is_canada_stat_holiday, true as is_long_weekend))"""
    return dates.selectExpr(f"inline(concat(array({holiday}), {weekend}))").groupBy("local_date").agg(
        F.expr(f"nullif({_NAMES}, '') as holiday_name"),
        F.expr("bool_or(is_alberta_stat_holiday) as _alberta"),
        F.expr("bool_or(is_canada_stat_holiday) as _canada"),
        F.expr("bool_or(is_long_weekend) as _long_weekend"),
    )


def _with_holidays(df: DataFrame, years: DataFrame, ts: str) -> DataFrame:
    """The dimension has at most 11 holidays and 44 long-weekend days per calendar year:
    a bound set by the calendar, not by the data, so it is always broadcast."""
    days = F.broadcast(day_dimension(holiday_dates(years)))
    return df.withColumn("local_date", F.expr(f"to_date({local_time(ts)})")).join(days, "local_date", "left")


def _day_flags(ts: str) -> list[str]:
    alberta, canada, long_weekend = (f"coalesce({c}, false)" for c in ("_alberta", "_canada", "_long_weekend"))
    off = f"(weekday({local_time(ts)}) >= 5 or {alberta} or {canada})"
    return [
        f"{alberta} as is_alberta_stat_holiday",
        f"{canada} as is_canada_stat_holiday",
        f"({alberta} or {canada}) as is_stat_holiday",
        f"{long_weekend} as is_long_weekend",
        f"{off} as is_non_workday",
        f"not {off} as is_workday",
    ]


def calendar_hourly(bounds: DataFrame) -> DataFrame:
    """One row per hour of the span: UTC parts, local parts and day flags."""
    utc, local = "timestamp_utc", local_time("timestamp_utc")
    return _with_holidays(hourly_spine(bounds), holiday_years(bounds), utc).selectExpr(
        "timestamp_utc",
        f"to_date({utc}) as date",
        f"hour({utc}) as hour",
        f"weekday({utc}) as day_of_week",
        f"month({utc}) as month",
        f"year({utc}) as year",
        f"weekday({utc}) >= 5 as is_weekend",
        "local_date",
        f"hour({local}) as local_hour",
        f"weekday({local}) as local_day_of_week",
        f"weekday({local}) >= 5 as is_local_weekend",
        "holiday_name",
        *_day_flags(utc),
    )


def add_calendar(df: DataFrame, ts: str, bounds: DataFrame | None = None) -> DataFrame:
    """Calendar features of any timestamped rows; weekend is UTC, holidays are local."""
    years = holiday_years(time_bounds(df, ts) if bounds is None else bounds)
    added = [f"hour({ts}) as hour", f"weekday({ts}) as day_of_week", f"month({ts}) as month",
             f"weekday({ts}) >= 5 as is_weekend", *_day_flags(ts)]
    base = df.drop(*[text.rsplit(" as ", 1)[1] for text in added], "local_date", "holiday_name")
    return _with_holidays(base, years, ts).selectExpr(*base.columns, *added)
