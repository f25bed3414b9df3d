from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from gridcast.functions.dates import with_easter
from gridcast.plans import calendar as cal
from tests.conftest import rows


def years(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "year int")


def at(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp").alias("timestamp_utc"))


def test_easter(spark):
    assert rows(with_easter(years(spark, 2024, 2025)), "easter") == [(date(2024, 3, 31),), (date(2025, 4, 20),)]


def test_holidays_of_2024(spark):
    found = {r.holiday_name: r for r in cal.holiday_dates(years(spark, 2024)).collect()}
    assert len(found) == 11
    assert found["Alberta Family Day"].observed_date == date(2024, 2, 19)
    assert found["Good Friday"].observed_date == date(2024, 3, 29)
    assert found["Canada Day"].observed_date == date(2024, 7, 1)
    assert found["Victoria Day"].observed_date == date(2024, 5, 20)
    assert found["New Year's Day"].observed_date == date(2024, 1, 1)
    truth = found["National Day for Truth and Reconciliation"]
    assert (truth.is_alberta_stat_holiday, truth.is_canada_stat_holiday) == (False, True)


def test_weekend_holidays_are_observed_later(spark):
    found = {(r.year, r.holiday_name): r.observed_date for r in cal.holiday_dates(years(spark, 2021, 2022)).collect()}
    assert found[2021, "Christmas Day"] == date(2021, 12, 27) and found[2021, "Boxing Day"] == date(2021, 12, 28)
    assert found[2022, "Christmas Day"] == date(2022, 12, 27) and found[2022, "Boxing Day"] == date(2022, 12, 26)
    assert found[2022, "New Year's Day"] == date(2022, 1, 3)


def test_day_flags(spark):
    days = at(spark, "2024-01-01 12:00", "2024-01-02 12:00", "2024-03-29 12:00")
    got = cal.add_calendar(days, "timestamp_utc").orderBy("timestamp_utc")
    flags = [tuple(r) for r in got.select("is_stat_holiday", "is_long_weekend", "is_workday", "is_non_workday").collect()]
    assert flags == [(True, True, False, True), (False, False, True, False), (True, True, False, True)]


def test_flags_follow_the_local_day_and_weekend_is_utc(spark):
    got = cal.add_calendar(at(spark, "2024-01-01 08:00", "2024-01-02 08:00", "2024-01-02 06:00", "2024-01-06 03:00"), "timestamp_utc")
    assert [tuple(r) for r in got.orderBy("timestamp_utc").select("is_stat_holiday", "is_weekend", "is_non_workday").collect()] == [
        (True, False, True), (True, False, True), (False, False, False), (False, True, False)]


def test_expected_warehouse_rows(spark):
    expected = {
        date(2024, 1, 1): (True, True, True, True, False), date(2024, 1, 2): (False, False, False, False, True),
        date(2024, 2, 19): (True, True, False, True, False), date(2024, 3, 29): (True, True, True, True, False),
        date(2024, 7, 1): (True, True, True, True, False)}
    bounds = cal.time_bounds(at(spark, "2024-01-01 00:00", "2024-07-05 00:00"), "timestamp_utc")
    got = cal.calendar_hourly(bounds)
    flags = ["is_stat_holiday", "is_alberta_stat_holiday", "is_canada_stat_holiday", "is_long_weekend", "is_workday"]
    seen = {r[0]: tuple(r[1:]) for r in got.select("local_date", *flags).distinct().collect()}
    assert {d: seen[d] for d in expected} == expected
    assert got.count() == got.select("timestamp_utc").distinct().count() == 186 * 24 + 1


def test_spine_is_hourly_and_empty_without_data(spark):
    one = at(spark, "2024-03-10 05:00", "2024-03-11 07:00")
    spine = cal.hourly_spine(cal.time_bounds(one, "timestamp_utc"))
    assert spine.count() == 27
    assert min(rows(spine)) == (datetime(2024, 3, 10, 5),)
    assert cal.calendar_hourly(cal.time_bounds(one.where("false"), "timestamp_utc")).count() == 0


def test_names_of_shared_dates_are_joined(spark):
    dates = spark.createDataFrame(
        [(2024, "B", date(2024, 1, 1), True, False), (2024, "A", date(2024, 1, 1), False, False)],
        "year int, holiday_name string, observed_date date, is_alberta_stat_holiday boolean, is_canada_stat_holiday boolean")
    assert rows(cal.holidays_by_date(dates)) == [(date(2024, 1, 1), "A, B", True, False)]
    assert rows(cal.long_weekend_days(dates)) == [(date(2023, 12, 29),), (date(2023, 12, 30),), (date(2023, 12, 31),), (date(2024, 1, 1),)]
