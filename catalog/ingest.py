"""Queries over the ingestion transforms, on untidy text made from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from catalog.parts import part, pick
from gridcast.sources import stand_ins as raw
from gridcast.sources.feeds import GENERATION, INTERTIE, WEATHER, transform_feed
from gridcast.sources.market import transform_market

# fixed values: untidy text of the feed columns, valid in both engines
_WEATHER_TEXT = {
    "temperature_c": "case when event_id % 17 = 0 then 'not-a-number' else concat('-', cast(cast(value as decimal(12,2)) as {text})) end",
    "wind_speed_mps": "concat('1,', lpad(cast(event_id % 1000 as {text}), 3, '0'))",
}
_GENERATION_TEXT = {
    "unit_id": "case when user_id % 4 = 0 then '  ' else concat(' U', cast(user_id % 4 as {text})) end",
    "available_capacity_mw": "concat('1,', lpad(cast(event_id % 1000 as {text}), 3, '0'), '.5')",
    "outage_capacity_mw": "case when event_id % 5 = 0 then '' else cast(event_id % 50 as {text}) end",
    "source": "case when event_id % 3 = 0 then null when event_id % 3 = 1 then ' plant ' else '' end",
}
_INTERTIE_TEXT = {
    "scheduled_import_mw": "cast(event_id % 900 as {text})",
    "scheduled_export_mw": "cast(event_id % 70 as {text})",
    "transfer_limit_import_mw": "'1,200'",
    "transfer_limit_export_mw": "'900'",
    "constraint_mw": "case when event_id % 2 = 0 then cast(event_id % 40 as {text}) end",
}
_REGIONS = ["Calgary", " Edmonton ", "", "NORTH"]
_FUELS = ["Gas", " Wind", "SOLAR ", "", "coal"]
_TIES = ["BC", "sk", " MT ", ""]


def _spark(values):
    return {name: sql.format(text="string") for name, sql in values.items()}


def _text_part(name, issue, target, entity, names, values):
    columns = ", ".join(f"{sql.format(text='varchar')} as {column}" for column, sql in values.items())
    part(name, f"""
select case when event_id % 13 = 0 then 'bad-date' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as {issue},
  strftime(ts + to_hours(cast(event_id % 49 as int)), '%Y-%m-%d %H:%M:%S') as {target},
  {pick('user_id', *names)} as {entity}, {columns} from events""")


def _number(column):
    return f"try_cast(replace(trim({column}), ',', '') as double) as {column}"


def _feed_sql(name, issue, target, entity, default, unit, numbers, source):
    columns = [f"try_cast({issue} as timestamp) as {issue}", f"try_cast({target} as timestamp) as {target}",
               f"lower(coalesce(nullif(trim({entity}), ''), '{default}')) as {entity}"]
    columns += [f"coalesce(nullif(trim({unit}), ''), 'unreported') as {unit}"] if unit else []
    columns += [_number(n) if known else f"null as {n}" for n, known in numbers.items()]
    columns.append(f"{source} as source")
    return f"select * from (select {', '.join(columns)} from {name}) where {issue} is not null and {target} is not null"


_text_part("text_weather", "forecast_issue_utc", "forecast_target_utc", "region", _REGIONS, _WEATHER_TEXT)
_text_part("text_generation", "availability_issue_utc", "availability_target_utc", "fuel_type", _FUELS, _GENERATION_TEXT)
_text_part("text_intertie", "schedule_issue_utc", "schedule_target_utc", "intertie_id", _TIES, _INTERTIE_TEXT)
part("text_market", """
select case when event_id % 13 = 0 then null else date_trunc('minute', ts) end as interval_start_utc,
  case when event_id % 11 = 0 or event_id % 17 = 0 then null else 9000 + event_id % 1000 end as alberta_internal_load_mw,
  case when event_id % 19 = 0 then null else cast(value as decimal(12,2)) end as pool_price_cad_mwh, 'market_csv' as source from events""")


@query("ingest_market_clean", "interval_start_utc:ts series:text amount:num source:text", """
select interval_start_utc, s.series, case when s.series = 'load' then cast(alberta_internal_load_mw as double) else cast(pool_price_cad_mwh as double) end as amount, source
from text_market cross join (values ('load'), ('price')) s(series)
where interval_start_utc is not null and alberta_internal_load_mw is not null and pool_price_cad_mwh is not null""")
def ingest_market_clean(spark, folder):
    """Both raw tables of the cleaned market text, stacked."""
    load, price = transform_market(raw.untidy_market(spark, folder))
    pick_out = lambda df, series, column: df.select(
        "interval_start_utc", F.lit(series).alias("series"), F.col(column).alias("amount"), "source"
    )
    return pick_out(load, "load", "alberta_internal_load_mw").unionByName(pick_out(price, "price", "pool_price_cad_mwh"))


@query("ingest_weather_clean", "forecast_issue_utc:ts forecast_target_utc:ts region:text temperature_c:num wind_speed_mps:num relative_humidity_pct:num precipitation_mm:num source:text",
       _feed_sql("text_weather", "forecast_issue_utc", "forecast_target_utc", "region", "alberta", None,
                 {"temperature_c": 1, "wind_speed_mps": 1, "relative_humidity_pct": 0, "precipitation_mm": 0}, "'external_weather_forecast_csv'"))
def ingest_weather_clean(spark, folder):
    text = raw.untidy_feed(spark, folder, "forecast_issue_utc", "forecast_target_utc", "region", _REGIONS, _spark(_WEATHER_TEXT))
    return transform_feed(text, WEATHER)


@query("ingest_generation_clean", "availability_issue_utc:ts availability_target_utc:ts fuel_type:text unit_id:text available_capacity_mw:num derated_capacity_mw:num outage_capacity_mw:num source:text",
       _feed_sql("text_generation", "availability_issue_utc", "availability_target_utc", "fuel_type", "unknown", "unit_id",
                 {"available_capacity_mw": 1, "derated_capacity_mw": 0, "outage_capacity_mw": 1},
                 "coalesce(nullif(trim(source), ''), 'external_generation_availability_csv')"))
def ingest_generation_clean(spark, folder):
    text = raw.untidy_feed(spark, folder, "availability_issue_utc", "availability_target_utc", "fuel_type", _FUELS, _spark(_GENERATION_TEXT))
    return transform_feed(text, GENERATION)


@query("ingest_intertie_clean", "schedule_issue_utc:ts schedule_target_utc:ts intertie_id:text scheduled_import_mw:num scheduled_export_mw:num transfer_limit_import_mw:num transfer_limit_export_mw:num constraint_mw:num source:text",
       _feed_sql("text_intertie", "schedule_issue_utc", "schedule_target_utc", "intertie_id", "unknown", None,
                 dict.fromkeys(["scheduled_import_mw", "scheduled_export_mw", "transfer_limit_import_mw", "transfer_limit_export_mw", "constraint_mw"], 1),
                 "'external_intertie_schedule_csv'"))
def ingest_intertie_clean(spark, folder):
    text = raw.untidy_feed(spark, folder, "schedule_issue_utc", "schedule_target_utc", "intertie_id", _TIES, _spark(_INTERTIE_TEXT))
    return transform_feed(text, INTERTIE)
