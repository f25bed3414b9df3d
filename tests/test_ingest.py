from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridcast.functions.coerce import to_number, to_utc_timestamp
from gridcast.sources.feeds import GENERATION, INTERTIE, WEATHER, empty_feed, read_feed_csv, transform_feed
from gridcast.sources.market import read_market_csv, read_market_parts, refused_market, require_rows, transform_market
from tests.conftest import rows

STAMP = datetime(2026, 1, 2, 3, 4, 5)


def stamp():
    return F.lit("2026-01-02 03:04:05").cast("timestamp")


def market(spark):
    return spark.createDataFrame(
        [("2020-01-01 7:00", "9,467", "30.24"), ("1/1/2020 8:00", "9361", "29.43"), ("not-a-date", "9200", "28.19"),
         ("2020-01-01 10:00", None, "30.00"), ("2020-01-01 11:00", "bad-load", None)],
        "Date_Begin_GMT string, ACTUAL_AIL string, ACTUAL_POOL_PRICE string",
    )


def test_market_rows_need_time_and_both_values(spark):
    load, price = transform_market(market(spark), "test_csv", stamp())
    assert load.columns == ["interval_start_utc", "alberta_internal_load_mw", "source", "ingested_at"]
    assert rows(load) == [
        (datetime(2020, 1, 1, 7), 9467.0, "test_csv", STAMP), (datetime(2020, 1, 1, 8), 9361.0, "test_csv", STAMP)]
    assert rows(price, "pool_price_cad_mwh") == [(29.43,), (30.24,)]


def test_market_columns_are_required(spark):
    with pytest.raises(ValueError, match="ACTUAL_AIL, ACTUAL_POOL_PRICE"):
        transform_market(spark.createDataFrame([("2020-01-01 7:00",)], "Date_Begin_GMT string"))


def test_market_csv_parts_may_order_columns_differently(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date_Begin_GMT,ACTUAL_AIL,ACTUAL_POOL_PRICE,OTHER\n2020-01-01 7:00,\"9,467\",30.24,x\n")
    (tmp_path / "b.csv").write_text("OTHER,ACTUAL_POOL_PRICE,Date_Begin_GMT,ACTUAL_AIL\ny,29.43,1/1/2020 8:00,9361\n")
    both = read_market_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    load, _ = transform_market(both)
    assert rows(load, "alberta_internal_load_mw") == [(9361.0,), (9467.0,)]
    assert require_rows(load, "market") is load
    with pytest.raises(ValueError, match="no valid rows"):
        require_rows(load.where("false"), "market")
    with pytest.raises(ValueError):
        read_market_csv(spark, [])


def test_market_rows_are_either_good_or_refused(spark, tmp_path):
    header = "Date_Begin_GMT,ACTUAL_AIL,ACTUAL_POOL_PRICE"
    (tmp_path / "a.csv").write_text(
        f'\ufeff{header}\n2020-01-01 7:00,"9,467",30.24\n\nsoon,1,2\n2020-01-01 9:00, ,x\n2020-01-01 9:00\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text(
        "ACTUAL_POOL_PRICE,MORE,ACTUAL_AIL,Date_Begin_GMT\r\n29.43,,9361,1/1/2020 8:00,beyond\r\n"
        "ACTUAL_POOL_PRICE,MORE,ACTUAL_AIL,Date_Begin_GMT\r\n,,,\r\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text(header)
    parts = read_market_parts(spark, str(tmp_path))
    load, price = transform_market(parts)
    refused = refused_market(parts)
    assert rows(load, "alberta_internal_load_mw") == [(9361.0,), (9467.0,)]
    assert rows(refused.withColumn("file", F.regexp_extract("file", "[^/]+$", 0))) == sorted([
        ("a.csv", "soon,1,2", "unreadable Date_Begin_GMT"),
        ("a.csv", "2020-01-01 9:00, ,x", "no ACTUAL_AIL, unreadable ACTUAL_POOL_PRICE"),
        ("a.csv", "2020-01-01 9:00", "no ACTUAL_AIL, no ACTUAL_POOL_PRICE"),
        ("b.csv", ",,,", "no Date_Begin_GMT, no ACTUAL_AIL, no ACTUAL_POOL_PRICE"),
    ], key=repr)
    assert load.count() + refused.count() == price.count() + refused.count() == parts.count() == 6


def test_market_files_of_many_blocks_keep_their_header(spark, tmp_path):
    lines = "".join(f"2020-01-01 7:00,x,{i},{-i}\n" for i in range(500))
    (tmp_path / "a.csv").write_text("\n" * 3000 + "Date_Begin_GMT,OTHER,ACTUAL_AIL,ACTUAL_POOL_PRICE\n" + lines)
    settings = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        parts = read_market_parts(spark, str(tmp_path))
        assert parts.rdd.getNumPartitions() > 4
        assert rows(parts, "ACTUAL_AIL", "ACTUAL_POOL_PRICE") == sorted(((str(i), str(-i)) for i in range(500)), key=repr)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_empty_files_have_no_market_rows_and_unfit_ones_are_named(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    parts = read_market_parts(spark, str(tmp_path / "empty.csv"))
    assert parts.columns == ["file", "line", "Date_Begin_GMT", "ACTUAL_AIL", "ACTUAL_POOL_PRICE"]
    assert parts.count() == refused_market(parts).count() == 0
    (tmp_path / "unfit.csv").write_text("Date_Begin_GMT,ACTUAL_AIL\n2020-01-01,1\n")
    with pytest.raises(ValueError, match="Market CSV .*ACTUAL_POOL_PRICE in .*unfit.csv"):
        read_market_parts(spark, str(tmp_path))


def test_the_plan_of_many_market_files_is_that_of_few(spark, tmp_path):
    from random import Random

    names, draw = ["Date_Begin_GMT", "ACTUAL_AIL", "ACTUAL_POOL_PRICE", "A", "B"], Random(7)
    for i in range(400):
        order = draw.sample(names, 5)
        values = dict(zip(names, ["2020-01-01 7:00" if i % 10 else "soon", str(i), str(-i), "x", ""]))
        (tmp_path / f"{i}.csv").write_text(",".join(order) + "\n" + ",".join(values[c] for c in order) + "\n")

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())

    few = read_market_parts(spark, [str(tmp_path / f"{i}.csv") for i in range(1, 3)])
    many = read_market_parts(spark, [str(tmp_path / f"{i}.csv") for i in range(400)])
    assert size(many) == size(few)
    load, _ = transform_market(many)
    assert rows(load, "alberta_internal_load_mw") == sorted(((float(i),) for i in range(400) if i % 10), key=repr)
    assert refused_market(many).count() == 40


def test_weather_keeps_known_rows_and_fills_absent_numbers(spark):
    text = spark.createDataFrame(
        [("2024-01-01 00:00", "2024-01-02 00:00", "Calgary", "-12.5", "5.2"),
         ("bad-date", "2024-01-02 01:00", "Edmonton", "not-a-number", "6.1")],
        "forecast_issue_utc string, forecast_target_utc string, region string, temperature_c string, wind_speed_mps string",
    )
    clean = transform_feed(text, WEATHER, ingested_at=stamp())
    assert clean.columns == empty_feed(spark, WEATHER).columns
    assert rows(clean) == [(datetime(2024, 1, 1), datetime(2024, 1, 2), "calgary", -12.5, 5.2, None, None,
                            "external_weather_forecast_csv", STAMP)]


def test_generation_accepts_fuel_grain(spark):
    text = spark.createDataFrame(
        [("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "Gas", "1,234.5", "50")],
        "availability_issue_utc string, availability_target_utc string, fuel_type string, "
        "available_capacity_mw string, outage_capacity_mw string",
    )
    clean = transform_feed(text, GENERATION)
    assert clean.columns == empty_feed(spark, GENERATION).columns
    assert rows(clean, "fuel_type", "unit_id", "available_capacity_mw", "derated_capacity_mw", "outage_capacity_mw") == [
        ("gas", "unreported", 1234.5, None, 50.0)]


def test_intertie_normalizes(spark):
    text = spark.createDataFrame(
        [("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "BC", "100", "25", "1,200", "900", None)],
        "schedule_issue_utc string, schedule_target_utc string, intertie_id string, scheduled_import_mw string, "
        "scheduled_export_mw string, transfer_limit_import_mw string, transfer_limit_export_mw string, constraint_mw string",
    )
    clean = transform_feed(text, INTERTIE)
    assert rows(clean, "intertie_id", "scheduled_import_mw", "transfer_limit_import_mw", "constraint_mw") == [
        ("bc", 100.0, 1200.0, None)]


def test_feed_keys_are_required_and_path_is_optional(spark, tmp_path):
    with pytest.raises(ValueError, match="region"):
        transform_feed(spark.createDataFrame([("a", "b")], "forecast_issue_utc string, forecast_target_utc string"), WEATHER)
    assert read_feed_csv(spark, None, WEATHER) is None
    assert read_feed_csv(spark, "  ", WEATHER) is None
    (tmp_path / "w.csv").write_text("forecast_issue_utc,forecast_target_utc,region,source\n2024-01-01,2024-01-02, ,station\n")
    assert rows(read_feed_csv(spark, str(tmp_path / "w.csv"), WEATHER), "region", "source") == [("alberta", "station")]


def test_numbers_have_no_type_suffix(spark):
    texts = ["9467d", "1f", "1,234.5", " 7 ", "-.5", "1e3", "0x10", "", "1.", "--1", "2L", "+3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_number("t").alias("n"))
    assert {r["t"]: r["n"] for r in df.collect()} == {
        "9467d": None, "1f": None, "1,234.5": 1234.5, " 7 ": 7.0, "-.5": -0.5, "1e3": 1000.0, "0x10": None, "": None, "1.": 1.0,
        "--1": None, "2L": None, "+3": 3.0}


def test_timestamps_with_half_days_and_month_names(spark):
    texts = ["1/2/2020 1:00 PM", "01/02/2020 07:00:00 AM", "02-Jan-2020 07:00", "2 January 2020", "Jan 2, 2020 13:00", "January 2, 2020 7:05",
             "1/2/2020 12:30 AM", "13/2/2020 1:00 PM", "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_utc_timestamp("t").cast("string").alias("u"))
    assert {r["t"]: r["u"] for r in df.collect()} == {
        "1/2/2020 1:00 PM": "2020-01-02 13:00:00", "01/02/2020 07:00:00 AM": "2020-01-02 07:00:00", "02-Jan-2020 07:00": "2020-01-02 07:00:00",
        "2 January 2020": "2020-01-02 00:00:00", "Jan 2, 2020 13:00": "2020-01-02 13:00:00", "January 2, 2020 7:05": "2020-01-02 07:05:00",
        "1/2/2020 12:30 AM": "2020-01-02 00:30:00", "13/2/2020 1:00 PM": None, "soon": None}
