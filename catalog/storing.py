"""Queries that write and read back: CSV exports and tables, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import ingest
from catalog.base import query
from gridcast.session import shared_folder
from gridcast.sources import stand_ins as raw
from gridcast.sources import tables
from gridcast.sources.feeds import WEATHER, read_feed_csv
from gridcast.sources.market import LOAD, PRICE, TIME, read_market_csv, read_market_parts, refused_market, transform_market


def _new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_market", "interval_start_utc:ts series:text amount:num source:text", """
select interval_start_utc, s.series, case when s.series = 'load' then cast(alberta_internal_load_mw as double) else cast(pool_price_cad_mwh as double) end as amount, source
from text_market cross join (values ('load'), ('price')) s(series)
where interval_start_utc is not null and alberta_internal_load_mw is not null and pool_price_cad_mwh is not null""")
def csv_market(spark, folder):
    """The untidy market text, written as CSV and read back by its header."""
    path = _new_folder(spark, "market-csv")
    raw.untidy_market(spark, folder).write.option("header", True).csv(path)
    load, price = transform_market(read_market_csv(spark, path))
    pick = lambda df, series, column: df.select("interval_start_utc", F.lit(series).alias("series"), F.col(column).alias("amount"), "source")
    return pick(load, "load", "alberta_internal_load_mw").unionByName(pick(price, "price", "pool_price_cad_mwh"))


_TIME = "case when event_id % 13 = 0 then 'not-a-date' when event_id % 2 = 0 then strftime(ts, '%Y-%m-%d %-H:%M') else strftime(ts, '%-m/%-d/%Y %-H:%M') end"
_LOAD = """case when event_id % 11 = 0 then '' when event_id % 17 = 0 then 'bad-load' else '"9,' || lpad(cast(event_id % 1000 as varchar), 3, '0') || '"' end"""
_PRICE = "case when event_id % 19 = 0 or value is null then '' else cast(cast(value as decimal(12,2)) as varchar) end"


@query("csv_market_refused", "layout:text line:text reason:text", f"""
select * from (select case when event_id % 3 = 0 then 'b' else 'a' end as layout,
  case when event_id % 3 = 0 then concat({_PRICE}, ',kept,', {_TIME}, ',', {_LOAD}) else concat({_TIME}, ',', {_LOAD}, ',', {_PRICE}) end as line,
  concat_ws(', ', case when event_id % 13 = 0 then 'unreadable Date_Begin_GMT' end,
    case when event_id % 11 = 0 then 'no ACTUAL_AIL' when event_id % 17 = 0 then 'unreadable ACTUAL_AIL' end,
    case when event_id % 19 = 0 or value is null then 'no ACTUAL_POOL_PRICE' end) as reason from events) where reason <> ''""")
def csv_market_refused(spark, folder):
    """Refused lines of untidy market files in two column orders, with the reason for each."""
    text = raw.untidy_market(spark, folder, "event_id")
    orders = {"a": ("event_id % 3 <> 0", [TIME, LOAD, PRICE]), "b": ("event_id % 3 = 0", [PRICE, "note", TIME, LOAD])}
    paths = []
    for name, (chosen, columns) in orders.items():
        paths.append(_new_folder(spark, f"market-{name}"))
        text.where(chosen).withColumn("note", F.lit("kept")).select(*columns).write.option("header", True).csv(paths[-1])
    refused = refused_market(read_market_parts(spark, paths))
    return refused.withColumn("layout", F.regexp_extract("file", "/market-([ab])-", 1))


@query("csv_weather", "forecast_issue_utc:ts forecast_target_utc:ts region:text temperature_c:num wind_speed_mps:num relative_humidity_pct:num precipitation_mm:num source:text",
       ingest._feed_sql("text_weather", "forecast_issue_utc", "forecast_target_utc", "region", "alberta", None,
                        {"temperature_c": 1, "wind_speed_mps": 1, "relative_humidity_pct": 0, "precipitation_mm": 0}, "'external_weather_forecast_csv'"))
def csv_weather(spark, folder):
    """The untidy weather feed, written as CSV and read back."""
    path = _new_folder(spark, "weather-csv")
    text = raw.untidy_feed(spark, folder, "forecast_issue_utc", "forecast_target_utc", "region", ingest._REGIONS, ingest._spark(ingest._WEATHER_TEXT))
    text.write.option("header", True).csv(path)
    return read_feed_csv(spark, path, WEATHER)


@query("stored_tables", "step:text k:text n:int", """
select s.step, k, s.times * n as n from (select event_type as k, count(*) as n from events group by 1)
cross join (values ('overwrite', 2), ('replace', 3), ('append', 2), ('optional', 3), ('layer', 1)) s(step, times)""")
def stored_tables(spark, folder):
    """Rows per event type after overwriting, replacing, appending two runs and an empty one, reading
    optional tables, and publishing a layer."""
    counted = spark.read.parquet(f"{folder}/events.parquet").groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("n"))
    layer = f"gridcast_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {layer} LOCATION '{_new_folder(spark, layer)}'")
    tables.overwrite_table(counted, f"{layer}.kept")
    tables.overwrite_table(counted.select((F.col("n") * 2).alias("n"), "k"), f"{layer}.kept")
    tables.replace_table(counted, f"{layer}.replaced")
    tables.replace_table(counted.select(F.col("k").alias("name"), (F.col("n") * 3).alias("m")), f"{layer}.replaced")
    for run in ("r1", "r2"):
        tables.append_run(counted.withColumn("run_id", F.lit(run)), f"{layer}.runs")
    tables.append_run(counted.where("false").withColumn("run_id", F.lit("r3")), f"{layer}.runs")
    found = [
        spark.table(f"{layer}.kept").select(F.lit("overwrite").alias("step"), "k", "n"),
        spark.table(f"{layer}.replaced").select(F.lit("replace").alias("step"), F.col("name").alias("k"), F.col("m").alias("n")),
        spark.table(f"{layer}.runs").groupBy("k").agg(F.sum("n").alias("n")).select(F.lit("append").alias("step"), "k", "n"),
        tables.materialize(counted, layer, "published").select(F.lit("layer").alias("step"), "k", "n"),
    ]
    for name, required in (("absent", []), ("replaced", ["k"]), ("replaced", ["name", "m"])):
        table = tables.read_optional_table(spark, f"{layer}.{name}", required, ["name"])
        if table is not None:
            found.append(table.select(F.lit("optional").alias("step"), F.col("name").alias("k"), F.col("m").alias("n")))
    whole = found[0]
    for one in found[1:]:
        whole = whole.unionByName(one)
    return whole
