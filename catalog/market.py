"""Queries over the market pipeline: staging, calendar, features, marts and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from catalog.parts import part
from gridcast.operators.asof import Feed, asof_latest
from gridcast.operators.dedup import dedup_latest
from gridcast.plans import calendar as cal
from gridcast.plans import features, marts, reports, staging
from gridcast.session import settle
from gridcast.sources import stand_ins as raw
from gridcast.sources.feeds import GENERATION, INTERTIE, WEATHER, empty_feed

TIE = ["event_id"]


def stg_load(spark, folder):
    return staging.stage_load(raw.raw_load(spark, folder), TIE)


def stg_price(spark, folder):
    return staging.stage_price(raw.raw_price(spark, folder), TIE)


def stg_weather(spark, folder):
    return staging.stage_weather(raw.raw_weather(spark, folder), TIE)


def stg_generation(spark, folder):
    return staging.stage_generation(raw.raw_generation(spark, folder), TIE)


def stg_intertie(spark, folder):
    return staging.stage_intertie(raw.raw_intertie(spark, folder), TIE)


def load_bounds(spark, folder):
    """First and last hour straight from the raw rows: deduplication cannot change them."""
    return cal.time_bounds(raw.raw_load(spark, folder), "interval_start_utc")


def energy(spark, folder):
    """Energy features. The staged series are one row per hour, far smaller than
    the raw rows they come from, and are read several times, so they are settled."""
    series = settle(features.stacked_series(stg_load(spark, folder), stg_price(spark, folder)))
    calendar = cal.calendar_hourly(cal.time_bounds(series.where("series = 'load'"), "timestamp_utc"))
    return features.energy_features(calendar, series)


def snapshot_features(spark, folder):
    return (
        features.weather_features(stg_weather(spark, folder)),
        features.generation_features(stg_generation(spark, folder)),
        features.intertie_features(stg_intertie(spark, folder)),
    )


def training(spark, folder):
    return marts.training_set(energy(spark, folder), *snapshot_features(spark, folder))


query("stg_load", "timestamp_utc:ts load_mw:num source:text ingested_at:ts", "stg_load")(stg_load)
query("stg_price", "timestamp_utc:ts pool_price_cad_mwh:num source:text ingested_at:ts", "stg_price")(stg_price)
query("stg_weather", "forecast_issue_utc:ts forecast_target_utc:ts forecast_horizon_hours:int region:text temperature_c:num wind_speed_mps:num relative_humidity_pct:num precipitation_mm:num heating_degree_c:num cooling_degree_c:num source:text ingested_at:ts", "stg_weather")(stg_weather)
query("stg_generation", "availability_issue_utc:ts availability_target_utc:ts availability_horizon_hours:int fuel_type:text unit_id:text available_capacity_mw:num derated_capacity_mw:num outage_capacity_mw:num source:text ingested_at:ts", "stg_generation")(stg_generation)
query("stg_intertie", "schedule_issue_utc:ts schedule_target_utc:ts schedule_horizon_hours:int intertie_id:text scheduled_import_mw:num scheduled_export_mw:num transfer_limit_import_mw:num transfer_limit_export_mw:num constraint_mw:num source:text ingested_at:ts", "stg_intertie")(stg_intertie)

# --- calendar -------------------------------------------------------------------

CALENDAR = "timestamp_utc:ts date:day hour:int day_of_week:int month:int year:int is_weekend:bool local_date:day local_hour:int local_day_of_week:int is_local_weekend:bool holiday_name:text is_alberta_stat_holiday:bool is_canada_stat_holiday:bool is_stat_holiday:bool is_long_weekend:bool is_non_workday:bool is_workday:bool"


@query("calendar_hourly", CALENDAR, "ev_calendar")
def calendar_hourly(spark, folder):
    return cal.calendar_hourly(load_bounds(spark, folder))


def order_bounds(spark, folder):
    return cal.time_bounds(raw.daily_series(spark, folder), "timestamp_utc")


@query("holiday_dim", "year:int holiday_name:text actual_date:day observed_date:day is_alberta_stat_holiday:bool is_canada_stat_holiday:bool", "od_holidays")
def holiday_dim(spark, folder):
    return cal.holiday_dates(cal.holiday_years(order_bounds(spark, folder)))


@query("holiday_by_date", "local_date:day holiday_name:text is_alberta_stat_holiday:bool is_canada_stat_holiday:bool", "od_by_date")
def holiday_by_date(spark, folder):
    return cal.holidays_by_date(holiday_dim(spark, folder))


@query("long_weekend_days", "local_date:day", "od_weekends")
def long_weekend_days(spark, folder):
    return cal.long_weekend_days(holiday_dim(spark, folder))


# --- features -------------------------------------------------------------------

LOAD_FEATURES = "timestamp_utc:ts load_mw:num source:text ingested_at:ts load_lag_1h:num load_lag_24h:num load_lag_168h:num load_rolling_24h_avg:num load_rolling_168h_avg:num"
PRICE_FEATURES = "timestamp_utc:ts pool_price_cad_mwh:num source:text ingested_at:ts price_lag_24h:num price_rolling_24h_avg:num"
ENERGY = CALENDAR + " load_mw:num load_lag_1h:num load_lag_24h:num load_lag_168h:num load_rolling_24h_avg:num load_rolling_168h_avg:num pool_price_cad_mwh:num price_lag_24h:num price_rolling_24h_avg:num latest_ingestion_time:ts"
WEATHER_FEATURES = "forecast_issue_utc:ts forecast_target_utc:ts forecast_horizon_hours:int weather_forecast_region_count:int forecast_temperature_c:num forecast_wind_speed_mps:num forecast_relative_humidity_pct:num forecast_precipitation_mm:num forecast_heating_degree_c:num forecast_cooling_degree_c:num latest_weather_ingested_at:ts"
GENERATION_FEATURES = "availability_issue_utc:ts availability_target_utc:ts availability_horizon_hours:int generation_availability_fuel_type_count:int available_capacity_total_mw:num outage_capacity_total_mw:num derated_capacity_total_mw:num available_capacity_gas_mw:num available_capacity_coal_mw:num available_capacity_hydro_mw:num available_capacity_wind_mw:num available_capacity_solar_mw:num available_capacity_storage_mw:num available_capacity_other_mw:num latest_generation_availability_ingested_at:ts"
INTERTIE_FEATURES = "schedule_issue_utc:ts schedule_target_utc:ts schedule_horizon_hours:int intertie_count:int scheduled_import_mw:num scheduled_export_mw:num net_scheduled_import_mw:num import_transfer_limit_mw:num export_transfer_limit_mw:num intertie_constraint_mw:num import_headroom_mw:num export_headroom_mw:num latest_intertie_schedule_ingested_at:ts"


@query("load_features", LOAD_FEATURES, "load_feat")
def load_features(spark, folder):
    return features.load_features(settle(stg_load(spark, folder)))


@query("price_features", PRICE_FEATURES, "price_feat")
def price_features(spark, folder):
    return features.price_features(settle(stg_price(spark, folder)))


query("energy_features", ENERGY, "energy")(energy)


@query("weather_features", WEATHER_FEATURES, "weather_feat")
def weather_features(spark, folder):
    return features.weather_features(stg_weather(spark, folder))


@query("generation_features", GENERATION_FEATURES, "generation_feat")
def generation_features(spark, folder):
    return features.generation_features(stg_generation(spark, folder))


@query("intertie_features", INTERTIE_FEATURES, "intertie_feat")
def intertie_features(spark, folder):
    return features.intertie_features(stg_intertie(spark, folder))


# --- training set -----------------------------------------------------------------

TRAINING = "training_row_id:text horizon_hours:int feature_as_of_timestamp_utc:ts feature_max_source_timestamp_utc:ts target_timestamp_utc:ts target_load_mw:num actual_pool_price_cad_mwh:num hour:int day_of_week:int month:int is_weekend:bool is_alberta_stat_holiday:bool is_canada_stat_holiday:bool is_stat_holiday:bool is_long_weekend:bool is_non_workday:bool is_workday:bool load_lag_1h:num load_lag_24h:num load_lag_168h:num load_rolling_24h_avg:num load_rolling_168h_avg:num price_lag_24h:num price_rolling_24h_avg:num latest_known_pool_price_cad_mwh:num weather_forecast_issue_utc:ts weather_forecast_target_utc:ts weather_forecast_age_hours:num weather_forecast_region_count:int forecast_temperature_c:num forecast_wind_speed_mps:num forecast_relative_humidity_pct:num forecast_precipitation_mm:num forecast_heating_degree_c:num forecast_cooling_degree_c:num generation_availability_issue_utc:ts generation_availability_target_utc:ts generation_availability_age_hours:num generation_availability_fuel_type_count:int available_capacity_total_mw:num outage_capacity_total_mw:num derated_capacity_total_mw:num available_capacity_gas_mw:num available_capacity_coal_mw:num available_capacity_hydro_mw:num available_capacity_wind_mw:num available_capacity_solar_mw:num available_capacity_storage_mw:num available_capacity_other_mw:num intertie_schedule_issue_utc:ts intertie_schedule_target_utc:ts intertie_schedule_age_hours:num intertie_count:int scheduled_import_mw:num scheduled_export_mw:num net_scheduled_import_mw:num import_transfer_limit_mw:num export_transfer_limit_mw:num intertie_constraint_mw:num import_headroom_mw:num export_headroom_mw:num latest_ingestion_time:ts"

part("targets", """
select t.timestamp_utc as target_timestamp_utc, h.horizon_hours, i.timestamp_utc as as_of_utc, t.*,
  i.load_rolling_24h_avg as i_roll24, i.load_rolling_168h_avg as i_roll168, i.price_rolling_24h_avg as i_price24, i.pool_price_cad_mwh as i_price
from (select * from energy where load_mw is not null) t cross join (select unnest([1, 24]) as horizon_hours) h
join (select * from energy where load_mw is not null) i on i.timestamp_utc = t.timestamp_utc - to_hours(h.horizon_hours)""")


def training_sql(weather="weather_feat", generation="generation_feat", intertie="intertie_feat") -> str:
    age = lambda issue: f"cast(date_diff('second', {issue}, r.as_of_utc) / 3600.0 as decimal(10,2))"
    return f"""
select md5(strftime(r.target_timestamp_utc, '%Y-%m-%d %H:%M:%S') || ':' || r.horizon_hours) as training_row_id, r.horizon_hours,
  r.as_of_utc as feature_as_of_timestamp_utc,
  greatest(r.as_of_utc, w.forecast_issue_utc, g.availability_issue_utc, x.schedule_issue_utc) as feature_max_source_timestamp_utc,
  r.target_timestamp_utc, r.load_mw as target_load_mw, r.pool_price_cad_mwh as actual_pool_price_cad_mwh,
  r.hour, r.day_of_week, r.month, r.is_weekend, r.is_alberta_stat_holiday, r.is_canada_stat_holiday, r.is_stat_holiday,
  r.is_long_weekend, r.is_non_workday, r.is_workday,
  case when r.horizon_hours <= 1 then r.load_lag_1h end as load_lag_1h, case when r.horizon_hours <= 24 then r.load_lag_24h end as load_lag_24h,
  case when r.horizon_hours <= 168 then r.load_lag_168h end as load_lag_168h, r.i_roll24 as load_rolling_24h_avg, r.i_roll168 as load_rolling_168h_avg,
  case when r.horizon_hours <= 24 then r.price_lag_24h end as price_lag_24h, r.i_price24 as price_rolling_24h_avg, r.i_price as latest_known_pool_price_cad_mwh,
  w.forecast_issue_utc as weather_forecast_issue_utc, w.forecast_target_utc as weather_forecast_target_utc, {age('w.forecast_issue_utc')} as weather_forecast_age_hours,
  w.* exclude (forecast_issue_utc, forecast_target_utc, forecast_horizon_hours, latest_weather_ingested_at),
  g.availability_issue_utc as generation_availability_issue_utc, g.availability_target_utc as generation_availability_target_utc,
  {age('g.availability_issue_utc')} as generation_availability_age_hours,
  g.* exclude (availability_issue_utc, availability_target_utc, availability_horizon_hours, latest_generation_availability_ingested_at),
  x.schedule_issue_utc as intertie_schedule_issue_utc, x.schedule_target_utc as intertie_schedule_target_utc,
  {age('x.schedule_issue_utc')} as intertie_schedule_age_hours,
  x.* exclude (schedule_issue_utc, schedule_target_utc, schedule_horizon_hours, latest_intertie_schedule_ingested_at),
  r.latest_ingestion_time
from targets r
asof left join {weather} w on w.forecast_target_utc = r.target_timestamp_utc and w.forecast_issue_utc <= r.as_of_utc
asof left join {generation} g on g.availability_target_utc = r.target_timestamp_utc and g.availability_issue_utc <= r.as_of_utc
asof left join {intertie} x on x.schedule_target_utc = r.target_timestamp_utc and x.schedule_issue_utc <= r.as_of_utc"""


part("train_set", training_sql())
query("training_set", TRAINING, "train_set")(training)


@query("training_set_no_optional", TRAINING, training_sql(*[f"(select * from {t} where false)" for t in ("weather_feat", "generation_feat", "intertie_feat")]))
def training_set_no_optional(spark, folder):
    """The training set with all three optional feeds switched off."""
    return marts.training_set(
        energy(spark, folder),
        features.weather_features(staging.stage_weather(empty_feed(spark, WEATHER))),
        features.generation_features(staging.stage_generation(empty_feed(spark, GENERATION))),
        features.intertie_features(staging.stage_intertie(empty_feed(spark, INTERTIE))),
    )


def _asof_query(name, index, struct, issue, target, value, table):
    columns = f"target_timestamp_utc:ts horizon_hours:int as_of_utc:ts load_mw:num issue_utc:ts {value}:num"
    sql = f"""
select r.target_timestamp_utc, r.horizon_hours, r.as_of_utc, r.load_mw, f.{issue} as issue_utc, f.{value}
from targets r asof left join {table} f on f.{target} = r.target_timestamp_utc and f.{issue} <= r.as_of_utc"""

    @query(name, columns, sql)
    def build(spark, folder):
        rows = marts.target_hours(energy(spark, folder))
        feed = marts.feed_sides(*snapshot_features(spark, folder))[index]
        joined = asof_latest(rows, [feed], ["target_timestamp_utc"], F.col("feature_as_of_timestamp_utc"))
        return joined.select(
            "target_timestamp_utc", "horizon_hours", F.col("feature_as_of_timestamp_utc").alias("as_of_utc"), "load_mw",
            F.col(f"{struct}.{issue}").alias("issue_utc"), F.col(f"{struct}.{value}").alias(value),
        )


_asof_query("asof_weather", 0, "weather", "forecast_issue_utc", "forecast_target_utc", "forecast_temperature_c", "weather_feat")
_asof_query("asof_generation", 1, "generation", "availability_issue_utc", "availability_target_utc", "available_capacity_total_mw", "generation_feat")
_asof_query("asof_intertie", 2, "intertie", "schedule_issue_utc", "schedule_target_utc", "net_scheduled_import_mw", "intertie_feat")


@query(
    "asof_ship_order",
    "l_orderkey:int l_linenumber:int l_partkey:int l_shipdate:ts l_quantity:num return_shipdate:ts return_quantity:num return_price:num",
    """
select s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_shipdate, s.l_quantity,
  r.l_shipdate as return_shipdate, r.l_quantity as return_quantity, r.l_extendedprice as return_price
from (select * from lineitem where l_returnflag = 'N') s
asof left join (
  select * from lineitem where l_returnflag = 'R'
  qualify row_number() over (partition by l_partkey, l_shipdate order by l_orderkey desc, l_linenumber desc, l_quantity desc, l_extendedprice desc) = 1
) r on r.l_partkey = s.l_partkey and r.l_shipdate <= s.l_shipdate""",
)
def asof_ship_order(spark, folder):
    """Each unreturned line with the latest earlier return of its part. A part may hold any
    share of the lines, so the keys are cut into month spans."""
    lines = raw.table(spark, folder, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    fields = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity"]
    shipped = lines.where("l_returnflag = 'N'").select(*fields)
    returned = dedup_latest(
        lines.where("l_returnflag = 'R'").select(*fields, "l_extendedprice"),
        ["l_partkey", "l_shipdate"], "l_orderkey", ["l_linenumber", "l_quantity", "l_extendedprice"],
    ).select("l_partkey", F.col("l_shipdate").alias("return_shipdate"), "l_quantity", "l_extendedprice")
    joined = asof_latest(
        shipped, [Feed("back", returned, "return_shipdate")], ["l_partkey"], F.col("l_shipdate"), span="month"
    )
    return joined.select(
        *fields, F.col("back.return_shipdate"), F.col("back.l_quantity").alias("return_quantity"),
        F.col("back.l_extendedprice").alias("return_price"),
    )


# --- marts ------------------------------------------------------------------------

part("overview", """
select timestamp_utc, date, hour, day_of_week, month, year, is_weekend, local_date, local_hour, holiday_name, is_stat_holiday, is_long_weekend,
  is_non_workday, is_workday, load_mw, pool_price_cad_mwh,
  cast(sum(load_mw) over d as double) / count(load_mw) over d as daily_average_load_mw, max(load_mw) over d as daily_peak_load_mw,
  case when count(pool_price_cad_mwh) over d > 0 then cast(sum(pool_price_cad_mwh) over d as double) / count(pool_price_cad_mwh) over d end as daily_average_pool_price_cad_mwh,
  load_rolling_24h_avg, load_rolling_168h_avg, price_rolling_24h_avg, latest_ingestion_time
from energy where load_mw is not null window d as (partition by date)""")
part("peaks", """
select * from (
  select timestamp_utc, date, hour, day_of_week, month, load_mw, pool_price_cad_mwh, cume_dist() over (order by load_mw) as load_cume_dist,
    row_number() over (order by load_mw desc, timestamp_utc desc) as peak_rank, true as is_top_5pct_load
  from energy where load_mw is not null) where load_cume_dist >= 0.95""")
PEAKS = "timestamp_utc:ts date:day hour:int day_of_week:int month:int load_mw:num pool_price_cad_mwh:num load_cume_dist:num peak_rank:int is_top_5pct_load:bool"


@query("market_overview", "timestamp_utc:ts date:day hour:int day_of_week:int month:int year:int is_weekend:bool local_date:day local_hour:int holiday_name:text is_stat_holiday:bool is_long_weekend:bool is_non_workday:bool is_workday:bool load_mw:num pool_price_cad_mwh:num daily_average_load_mw:num daily_peak_load_mw:num daily_average_pool_price_cad_mwh:num load_rolling_24h_avg:num load_rolling_168h_avg:num price_rolling_24h_avg:num latest_ingestion_time:ts", "overview")
def market_overview(spark, folder):
    return marts.market_overview(energy(spark, folder))


@query("peak_events", PEAKS, "peaks")
def peak_events(spark, folder):
    """The hours are ranked from counts of their loads and then joined back, so they are settled."""
    return marts.peak_events(settle(energy(spark, folder)))


# --- reports over the marts -------------------------------------------------------

@query("market_kpis", "latest_load_mw:num average_load_mw:num peak_load_mw:num average_pool_price:num hourly_records:int", """
select arg_max(load_mw, timestamp_utc) as latest_load_mw, avg(cast(load_mw as double)) as average_load_mw, max(load_mw) as peak_load_mw,
  avg(cast(pool_price_cad_mwh as double)) as average_pool_price, count(*) as hourly_records from energy where load_mw is not null""")
def market_kpis(spark, folder):
    return reports.market_kpis(marts.market_overview(energy(spark, folder)))


@query("daily_load", "date:day daily_average_load_mw:num daily_peak_load_mw:num", """
select date, avg(cast(load_mw as double)) as daily_average_load_mw, max(load_mw) as daily_peak_load_mw from energy where load_mw is not null group by 1""")
def daily_load(spark, folder):
    return reports.daily_load(marts.market_overview(energy(spark, folder)))


@query("top_peaks", PEAKS, "select * from peaks order by peak_rank limit 200")
def top_peaks(spark, folder):
    return reports.top_peaks(peak_events(spark, folder))


@query("peak_monitor_kpis", "top_load_mw:num peak_rows:int average_peak_price:num", """
select max(load_mw) as top_load_mw, count(*) as peak_rows, avg(cast(pool_price_cad_mwh as double)) as average_peak_price
from (select * from peaks order by peak_rank limit 200)""")
def peak_monitor_kpis(spark, folder):
    return reports.peak_monitor_kpis(top_peaks(spark, folder))


_STATS = """select '{0}' as table_name, count(*) as record_count, min(interval_start_utc) as min_timestamp_utc, max(interval_start_utc) as max_timestamp_utc,
  max(ingested_at) as latest_ingestion_time, count(*) - count({1}) as null_value_count, count(*) - count(distinct interval_start_utc) as duplicate_timestamp_count from {0}"""


@query("raw_quality", "table_name:text record_count:int min_timestamp_utc:ts max_timestamp_utc:ts latest_ingestion_time:ts null_value_count:int duplicate_timestamp_count:int",
       _STATS.format("raw_load", "alberta_internal_load_mw") + " union all " + _STATS.format("raw_price", "pool_price_cad_mwh"))
def raw_quality(spark, folder):
    return reports.raw_quality({
        "raw_load": (raw.raw_load(spark, folder), "alberta_internal_load_mw"),
        "raw_price": (raw.raw_price(spark, folder), "pool_price_cad_mwh"),
    })


@query("missing_hours", "missing_hour_count:int", "select count(*) as missing_hour_count from ev_spine s where s.timestamp_utc not in (select interval_start_utc from raw_load)")
def missing_hours(spark, folder):
    return reports.missing_hours(raw.raw_load(spark, folder))


@query("asof_hot_key", "event_id:int place:text at_utc:ts known_event:int known_at:ts known_value:num", """
select * from (with moved as (
  select event_id, value, event_type, case when event_id % 3 = 0 then 'hot' else 'k' || (user_id % 50) end as place,
    case when event_id % 3 = 0 then timestamp '2024-01-10 07:00:00' + to_seconds(cast(event_id % 3600 as int)) else ts end as at_utc from events),
  known as (select * from moved where event_type in ('click', 'purchase') qualify row_number() over (partition by place, at_utc order by event_id desc) = 1)
select q.event_id, q.place, q.at_utc, f.event_id as known_event, f.at_utc as known_at, f.value as known_value
from (select * from moved where event_type not in ('click', 'purchase')) q asof left join known f on f.place = q.place and f.at_utc <= q.at_utc)""")
def asof_hot_key(spark, folder):
    """As-of over events of which a third share one key and one hour; cuts are chosen from the rows."""
    moved = raw.table(spark, folder, "events").selectExpr(
        "event_id", "value", "event_type", "if(event_id % 3 = 0, 'hot', concat('k', user_id % 50)) as place",
        "if(event_id % 3 = 0, timestamp'2024-01-10 07:00:00' + make_dt_interval(0, 0, 0, cast(event_id % 3600 as int)), cast(ts as timestamp)) as at_utc")
    offered = moved.where("event_type in ('click', 'purchase')")
    known = dedup_latest(offered, ["place", "at_utc"], "event_id").selectExpr("place", "at_utc as known_at", "event_id", "value")
    asked = moved.where("event_type not in ('click', 'purchase')").select("event_id", "place", "at_utc")
    joined = asof_latest(asked, [Feed("known", known, "known_at")], ["place"], F.col("at_utc"), hot_rows=500)
    return joined.selectExpr("event_id", "place", "at_utc", "known.event_id as known_event", "known.known_at", "known.value as known_value")
