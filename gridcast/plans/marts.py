"""Training set, market overview and peak events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.contracts import HORIZONS
from gridcast.functions.dates import hours
from gridcast.operators.asof import Feed, asof_latest
from gridcast.operators.ranks import top_share
from gridcast.operators.series import shifted_lookup

# fixed values: columns the target hour brings along, in mart order
_TARGET_DAY = [
    "hour", "day_of_week", "month", "is_weekend", "is_alberta_stat_holiday", "is_canada_stat_holiday",
    "is_stat_holiday", "is_long_weekend", "is_non_workday", "is_workday",
]
_WEATHER = [
    "weather_forecast_region_count", "forecast_temperature_c", "forecast_wind_speed_mps",
    "forecast_relative_humidity_pct", "forecast_precipitation_mm", "forecast_heating_degree_c",
    "forecast_cooling_degree_c",
]
_GENERATION = [
    "generation_availability_fuel_type_count", "available_capacity_total_mw", "outage_capacity_total_mw",
    "derated_capacity_total_mw", "available_capacity_gas_mw", "available_capacity_coal_mw",
    "available_capacity_hydro_mw", "available_capacity_wind_mw", "available_capacity_solar_mw",
    "available_capacity_storage_mw", "available_capacity_other_mw",
]
_INTERTIE = [
    "intertie_count", "scheduled_import_mw", "scheduled_export_mw", "net_scheduled_import_mw",
    "import_transfer_limit_mw", "export_transfer_limit_mw", "intertie_constraint_mw",
    "import_headroom_mw", "export_headroom_mw",
]


def known_lag(lag_hours: int, column: str) -> str:
    """A lag is usable only when its hour is not after the issue hour."""
    return f"case when horizon_hours <= {lag_hours} then {column} end as {column}"


def snapshot_columns(prefix: str, issued: str, struct: str, columns: list[str]) -> list[str]:
    """Issue, target and age of the joined snapshot, then its values; all null without one."""
    seconds = f"(unix_timestamp(feature_as_of_timestamp_utc) - unix_timestamp({issued}))"
    return [
        f"{issued} as {prefix}_issue_utc",
        f"{struct}.own_target_utc as {prefix}_target_utc",
        f"cast({seconds} / 3600 as decimal(10,2)) as {prefix}_age_hours",
        *[f"{struct}.{column}" for column in columns],
    ]


def target_hours(energy: DataFrame, horizons: list[int] = HORIZONS) -> DataFrame:
    """Rows (target hour, horizon) whose target and issue hours both have load."""
    at_issue = ["load_mw", "load_rolling_24h_avg", "load_rolling_168h_avg", "price_rolling_24h_avg", "pool_price_cad_mwh"]
    own = ["load_mw", "pool_price_cad_mwh", *_TARGET_DAY, "load_lag_1h", "load_lag_24h", "load_lag_168h",
           "price_lag_24h", "latest_ingestion_time"]
    joined = shifted_lookup(
        energy.where(F.col("load_mw").isNotNull()), "timestamp_utc", own,
        {f"{column}@{h}": (column, h) for h in horizons for column in at_issue},
    )
    issue = "struct({0} as horizon_hours, " + ", ".join(f"`{c}@{{0}}` as issue_{c}" for c in at_issue) + ")"
    issues = f"inline(array({', '.join(issue.format(h) for h in horizons)}))"
    return (
        joined.selectExpr("timestamp_utc as target_timestamp_utc", *own, issues)
        .where("issue_load_mw is not null")
        .withColumn("feature_as_of_timestamp_utc", F.col("target_timestamp_utc") - hours(F.col("horizon_hours")))
    )


def feed_sides(weather: DataFrame, generation: DataFrame, intertie: DataFrame) -> list[Feed]:
    """The three snapshot tables as right sides keyed by target hour."""
    def side(name, df, issue, target, columns):
        return Feed(name, df.selectExpr(f"{target} as target_timestamp_utc", issue, f"{target} as own_target_utc", *columns), issue)

    return [
        side("weather", weather, "forecast_issue_utc", "forecast_target_utc", _WEATHER),
        side("generation", generation, "availability_issue_utc", "availability_target_utc", _GENERATION),
        side("intertie", intertie, "schedule_issue_utc", "schedule_target_utc", _INTERTIE),
    ]


def training_set(
    energy: DataFrame, weather: DataFrame, generation: DataFrame, intertie: DataFrame, horizons: list[int] = HORIZONS
) -> DataFrame:
    """One row per (target hour, horizon) with nothing issued after the as-of hour.

    The three feeds share the target hour as key, so one shuffle serves all
    three as-of lookups. A target hour collects at most one row per issue hour.
    """
    rows = asof_latest(
        target_hours(energy, horizons), feed_sides(weather, generation, intertie),
        ["target_timestamp_utc"], F.col("feature_as_of_timestamp_utc"),
    )
    weather_at, generation_at, intertie_at = (
        "weather.forecast_issue_utc", "generation.availability_issue_utc", "intertie.schedule_issue_utc"
    )
    return rows.selectExpr(
        "md5(concat_ws(':', date_format(target_timestamp_utc, 'yyyy-MM-dd HH:mm:ss'), horizon_hours)) as training_row_id",
        "horizon_hours",
        "feature_as_of_timestamp_utc",
        f"greatest(feature_as_of_timestamp_utc, {weather_at}, {generation_at}, {intertie_at}) as feature_max_source_timestamp_utc",
        "target_timestamp_utc",
        "load_mw as target_load_mw",
        "pool_price_cad_mwh as actual_pool_price_cad_mwh",
        *_TARGET_DAY,
        known_lag(1, "load_lag_1h"),
        known_lag(24, "load_lag_24h"),
        known_lag(168, "load_lag_168h"),
        "issue_load_rolling_24h_avg as load_rolling_24h_avg",
        "issue_load_rolling_168h_avg as load_rolling_168h_avg",
        known_lag(24, "price_lag_24h"),
        "issue_price_rolling_24h_avg as price_rolling_24h_avg",
        "issue_pool_price_cad_mwh as latest_known_pool_price_cad_mwh",
        *snapshot_columns("weather_forecast", weather_at, "weather", _WEATHER),
        *snapshot_columns("generation_availability", generation_at, "generation", _GENERATION),
        *snapshot_columns("intertie_schedule", intertie_at, "intertie", _INTERTIE),
        "latest_ingestion_time",
    )


def market_overview(energy: DataFrame) -> DataFrame:
    """Hourly market rows with the day's mean and peak beside them (at most 24 rows a day)."""
    day = Window.partitionBy("date")
    mean = lambda c: F.sum(c).over(day).cast("double") / F.count(c).over(day)
    return energy.where(F.col("load_mw").isNotNull()).select(
        "timestamp_utc", "date", "hour", "day_of_week", "month", "year", "is_weekend", "local_date", "local_hour",
        "holiday_name", "is_stat_holiday", "is_long_weekend", "is_non_workday", "is_workday",
        "load_mw", "pool_price_cad_mwh",
        mean("load_mw").alias("daily_average_load_mw"),
        F.max("load_mw").over(day).alias("daily_peak_load_mw"),
        F.when(F.count("pool_price_cad_mwh").over(day) > 0, mean("pool_price_cad_mwh")).alias("daily_average_pool_price_cad_mwh"),
        "load_rolling_24h_avg", "load_rolling_168h_avg", "price_rolling_24h_avg", "latest_ingestion_time",
    )


def peak_events(energy: DataFrame, at_least: float = 0.95) -> DataFrame:
    """The top five percent of load hours with their rank."""
    hourly = energy.where(F.col("load_mw").isNotNull()).select(
        "timestamp_utc", "date", "hour", "day_of_week", "month", "load_mw", "pool_price_cad_mwh"
    )
    return top_share(hourly, "load_mw", at_least, "timestamp_utc").select(
        *hourly.columns,
        F.col("cume_dist").alias("load_cume_dist"),
        F.col("rank").alias("peak_rank"),
        F.lit(True).alias("is_top_5pct_load"),
    )
