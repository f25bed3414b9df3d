"""Data-quality queries. On sound tables the violation listings are empty."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import market
from catalog.base import query
from gridcast.plans import calendar as cal
from gridcast.plans import quality
from gridcast.sources import stand_ins as raw

# fixed values: declared rules, table -> (oracle part, not null, unique)
RULES = {
    "raw_load": ("raw_load", ["interval_start_utc", "alberta_internal_load_mw"], []),
    "raw_price": ("raw_price", ["interval_start_utc", "pool_price_cad_mwh"], []),
    "stg_load": ("stg_load", ["timestamp_utc", "load_mw"], ["timestamp_utc"]),
    "stg_price": ("stg_price", ["timestamp_utc", "pool_price_cad_mwh"], ["timestamp_utc"]),
    "stg_weather": ("stg_weather", ["forecast_issue_utc", "forecast_target_utc", "region"], []),
    "stg_generation": ("stg_generation", ["availability_issue_utc", "availability_target_utc", "fuel_type", "unit_id"], []),
    "stg_intertie": ("stg_intertie", ["schedule_issue_utc", "schedule_target_utc", "intertie_id"], []),
    "calendar": ("ev_calendar", ["timestamp_utc"], ["timestamp_utc"]),
    "load_features": ("load_feat", ["timestamp_utc"], ["timestamp_utc"]),
    "price_features": ("price_feat", ["timestamp_utc"], ["timestamp_utc"]),
    "energy_features": ("energy", ["timestamp_utc"], ["timestamp_utc"]),
    "weather_features": ("weather_feat", ["forecast_issue_utc", "forecast_target_utc"], []),
    "generation_features": ("generation_feat", ["availability_issue_utc", "availability_target_utc"], []),
    "intertie_features": ("intertie_feat", ["schedule_issue_utc", "schedule_target_utc"], []),
    "training_set": ("train_set", ["training_row_id", "horizon_hours", "feature_as_of_timestamp_utc", "target_timestamp_utc", "target_load_mw"], ["training_row_id"]),
    "market_overview": ("overview", ["timestamp_utc"], ["timestamp_utc"]),
    "peak_events": ("peaks", ["timestamp_utc"], []),
}


def _rules_sql() -> str:
    rows = []
    for name, (source, not_null, unique) in RULES.items():
        rows += [f"select '{name}' as table_name, '{c}' as column_name, 'not_null' as rule, count(*) - count({c}) as violations from {source}" for c in not_null]
        rows += [f"select '{name}' as table_name, '{c}' as column_name, 'unique' as rule, count({c}) - count(distinct {c}) as violations from {source}" for c in unique]
    return " union all ".join(rows)


@query("dq_not_null_unique", "table_name:text column_name:text rule:text violations:int", _rules_sql())
def dq_not_null_unique(spark, folder):
    """Every declared not-null and unique rule with its number of violations, one pass per table and one shuffle for all."""
    from gridcast.plans import features, marts
    from gridcast.session import settle

    load, price = settle(market.stg_load(spark, folder)), settle(market.stg_price(spark, folder))
    weather, generation, intertie = (
        settle(f(spark, folder)) for f in (market.stg_weather, market.stg_generation, market.stg_intertie)
    )
    calendar = cal.calendar_hourly(cal.time_bounds(load, "timestamp_utc"))
    energy = settle(features.energy_features(calendar, features.stacked_series(load, price)))
    snapshots = (features.weather_features(weather), features.generation_features(generation), features.intertie_features(intertie))
    tables = {
        "raw_load": raw.raw_load(spark, folder), "raw_price": raw.raw_price(spark, folder),
        "stg_load": load, "stg_price": price, "stg_weather": weather, "stg_generation": generation, "stg_intertie": intertie,
        "calendar": calendar, "load_features": features.load_features(load), "price_features": features.price_features(price),
        "energy_features": energy, "weather_features": snapshots[0], "generation_features": snapshots[1], "intertie_features": snapshots[2],
        "training_set": marts.training_set(energy, *snapshots), "market_overview": marts.market_overview(energy), "peak_events": marts.peak_events(energy),
    }
    return quality.rule_violations({name: (tables[name], not_null, unique) for name, (_, not_null, unique) in RULES.items()})


TRAINING_KEYS = "training_row_id:text horizon_hours:int feature_as_of_timestamp_utc:ts feature_max_source_timestamp_utc:ts target_timestamp_utc:ts"


@query("dq_no_leakage", TRAINING_KEYS, "select * from train_set where feature_max_source_timestamp_utc > feature_as_of_timestamp_utc")
def dq_no_leakage(spark, folder):
    return quality.future_leakage(market.training(spark, folder))


@query("dq_issue_known", TRAINING_KEYS, """select * from train_set where weather_forecast_issue_utc > feature_as_of_timestamp_utc
  or generation_availability_issue_utc > feature_as_of_timestamp_utc or intertie_schedule_issue_utc > feature_as_of_timestamp_utc""")
def dq_issue_known(spark, folder):
    return quality.issued_after_as_of(market.training(spark, folder))


@query("dq_target_aligned", TRAINING_KEYS, """select * from train_set where weather_forecast_target_utc <> target_timestamp_utc
  or generation_availability_target_utc <> target_timestamp_utc or intertie_schedule_target_utc <> target_timestamp_utc""")
def dq_target_aligned(spark, folder):
    return quality.target_mismatch(market.training(spark, folder))


_GRAIN = "select '{0}' as model_name, {2} as issue_utc, {3} as target_utc, count(*) as row_count from {1} group by 2, 3 having count(*) > 1"


@query("dq_grain", "model_name:text issue_utc:ts target_utc:ts row_count:int", " union all ".join([
    _GRAIN.format("weather_features", "weather_feat", "forecast_issue_utc", "forecast_target_utc"),
    _GRAIN.format("generation_features", "generation_feat", "availability_issue_utc", "availability_target_utc"),
    _GRAIN.format("intertie_features", "intertie_feat", "schedule_issue_utc", "schedule_target_utc"),
    _GRAIN.format("raw_weather", "raw_weather", "forecast_issue_utc", "forecast_target_utc"),
]))
def dq_grain(spark, folder):
    """Repeated (issue, target) pairs: none in the feature tables; the raw feed has one per region."""
    weather, generation, intertie = market.snapshot_features(spark, folder)
    return quality.repeated_grain({
        "weather_features": (weather, "forecast_issue_utc", "forecast_target_utc"),
        "generation_features": (generation, "availability_issue_utc", "availability_target_utc"),
        "intertie_features": (intertie, "schedule_issue_utc", "schedule_target_utc"),
        "raw_weather": (raw.raw_weather(spark, folder), "forecast_issue_utc", "forecast_target_utc"),
    })


def moved(training, column, hours):
    """A training table with a fault: one of its times is some hours off."""
    return training.withColumn(column, F.expr(f"{column} + make_dt_interval(0, {hours})"))


@query("dq_issue_known_moved", TRAINING_KEYS, """
select * from (select * replace (feature_as_of_timestamp_utc - interval 30 hour as feature_as_of_timestamp_utc) from train_set)
where weather_forecast_issue_utc > feature_as_of_timestamp_utc or generation_availability_issue_utc > feature_as_of_timestamp_utc
  or intertie_schedule_issue_utc > feature_as_of_timestamp_utc""")
def dq_issue_known_moved(spark, folder):
    """Snapshots issued after an as-of hour that is moved 30 hours back."""
    return quality.issued_after_as_of(moved(market.training(spark, folder), "feature_as_of_timestamp_utc", -30))


@query("dq_target_aligned_moved", TRAINING_KEYS, """
select * from (select * replace (target_timestamp_utc + interval 1 hour as target_timestamp_utc) from train_set)
where weather_forecast_target_utc <> target_timestamp_utc or generation_availability_target_utc <> target_timestamp_utc
  or intertie_schedule_target_utc <> target_timestamp_utc""")
def dq_target_aligned_moved(spark, folder):
    """Rows with a snapshot for another hour than their target, which is moved by an hour."""
    return quality.target_mismatch(moved(market.training(spark, folder), "target_timestamp_utc", 1))


@query("dq_grain_doubled", "model_name:text issue_utc:ts target_utc:ts row_count:int", """
select 'weather_features' as model_name, forecast_issue_utc as issue_utc, forecast_target_utc as target_utc, 2 * count(*) as row_count
from weather_feat group by 2, 3""")
def dq_grain_doubled(spark, folder):
    """Every pair of a feature table that was loaded twice."""
    weather, _, _ = market.snapshot_features(spark, folder)
    return quality.repeated_grain({"weather_features": (weather.unionAll(weather), "forecast_issue_utc", "forecast_target_utc")})


@query("dq_required_horizons", "horizon_hours:int", "select horizon_hours from (select unnest([1, 24, 48]) as horizon_hours) where horizon_hours not in (select horizon_hours from train_set)")
def dq_required_horizons(spark, folder):
    """Expected horizons the training set lacks; 48 is expected here and not built."""
    return quality.absent_horizons(market.training(spark, folder), [1, 24, 48])


# fixed values: known holiday flags; the last row is wrong on purpose so the check has work
_EXPECTED = [
    ("2024-01-01", True, True, True, True, False),
    ("2024-01-02", False, False, False, False, True),
    ("2024-01-03", True, False, False, False, True),
]
_FLAGS = ["is_stat_holiday", "is_alberta_stat_holiday", "is_canada_stat_holiday", "is_long_weekend", "is_workday"]


@query("dq_holiday_flags", "local_date:day is_stat_holiday:bool is_alberta_stat_holiday:bool is_canada_stat_holiday:bool is_long_weekend:bool is_workday:bool", f"""
select c.local_date, {', '.join('c.' + f for f in _FLAGS)} from ev_calendar c
join (values {', '.join(f"(date '{d}', {', '.join(str(v).lower() for v in flags)})" for d, *flags in _EXPECTED)}) e(local_date, {', '.join(_FLAGS)})
on c.local_date = e.local_date where {' or '.join(f'c.{f} is distinct from e.{f}' for f in _FLAGS)}""")
def dq_holiday_flags(spark, folder):
    expected = spark.createDataFrame(_EXPECTED, f"local_date string, {', '.join(f + ' boolean' for f in _FLAGS)}")
    expected = expected.selectExpr("cast(local_date as date) as local_date", *_FLAGS)
    return quality.wrong_holiday_flags(market.calendar_hourly(spark, folder), expected)
