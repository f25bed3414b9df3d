"""Intermediate hourly features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.series import lags_and_means

# fixed values: fuel classes of the capacity sums
FUEL_CLASSES = {
    "gas": ["gas", "natural_gas", "natural gas"],
    "coal": ["coal"],
    "hydro": ["hydro"],
    "wind": ["wind"],
    "solar": ["solar"],
    "storage": ["storage"],
}


def load_features(load: DataFrame) -> DataFrame:
    """Row lags and trailing means of the staged load."""
    return lags_and_means(
        load, "timestamp_utc",
        lags={f"load_lag_{n}h": ("load_mw", n) for n in (1, 24, 168)},
        means={f"load_rolling_{n}h_avg": ("load_mw", n) for n in (24, 168)},
    )


def price_features(price: DataFrame) -> DataFrame:
    return lags_and_means(
        price, "timestamp_utc",
        lags={"price_lag_24h": ("pool_price_cad_mwh", 24)},
        means={"price_rolling_24h_avg": ("pool_price_cad_mwh", 24)},
    )


def stacked_series(load: DataFrame, price: DataFrame) -> DataFrame:
    """Staged load and price as one table of two series, so one pass computes the features of both."""
    return load.selectExpr("'load' as series", "timestamp_utc", "load_mw as value", "ingested_at").unionByName(
        price.selectExpr("'price' as series", "timestamp_utc", "pool_price_cad_mwh as value", "ingested_at")
    )


def energy_features(calendar: DataFrame, series: DataFrame) -> DataFrame:
    """Calendar hours with the load and price features of `stacked_series` where known."""
    by_series = lags_and_means(
        series, "timestamp_utc",
        lags={f"lag_{n}": ("value", n) for n in (1, 24, 168)},
        means={f"mean_{n}": ("value", n) for n in (24, 168)},
        keys=["series"],
    )
    picked = {
        "load_mw": ("load", "value"), "load_lag_1h": ("load", "lag_1"), "load_lag_24h": ("load", "lag_24"),
        "load_lag_168h": ("load", "lag_168"), "load_rolling_24h_avg": ("load", "mean_24"),
        "load_rolling_168h_avg": ("load", "mean_168"), "pool_price_cad_mwh": ("price", "value"),
        "price_lag_24h": ("price", "lag_24"), "price_rolling_24h_avg": ("price", "mean_24"),
    }
    by_hour = by_series.groupBy("timestamp_utc").agg(
        *[F.expr(f"max(case when series = '{s}' then {c} end) as {name}") for name, (s, c) in picked.items()],
        *[F.expr(f"max(case when series = '{s}' then ingested_at end) as _{s}_ingested") for s in ("load", "price")],
    )
    # null unless the hour has load or price; the later of the two ingestion times otherwise
    latest = "greatest(_load_ingested, _price_ingested) as latest_ingestion_time"
    return calendar.join(by_hour, "timestamp_utc", "left").selectExpr(*calendar.columns, *picked, latest)


def _mean(column: str, kind: str, name: str) -> Column:
    """Mean of a decimal with enough digits that the final rounding is the only one."""
    return F.expr(f"cast(avg(cast({column} as decimal(20,12))) as {kind}) as {name}")


def _total(value: str, name: str, rows: str | None = None) -> Column:
    kept = f"case when {rows} then {value} end" if rows else value
    return F.expr(f"cast(sum({kept}) as decimal(14,2)) as {name}")


def weather_features(staged: DataFrame) -> DataFrame:
    return staged.groupBy("forecast_issue_utc", "forecast_target_utc", "forecast_horizon_hours").agg(
        F.expr("count(*) as weather_forecast_region_count"),
        _mean("temperature_c", "decimal(8,2)", "forecast_temperature_c"),
        _mean("wind_speed_mps", "decimal(8,2)", "forecast_wind_speed_mps"),
        _mean("relative_humidity_pct", "decimal(8,2)", "forecast_relative_humidity_pct"),
        _mean("precipitation_mm", "decimal(10,3)", "forecast_precipitation_mm"),
        _mean("heating_degree_c", "decimal(8,2)", "forecast_heating_degree_c"),
        _mean("cooling_degree_c", "decimal(8,2)", "forecast_cooling_degree_c"),
        F.expr("max(ingested_at) as latest_weather_ingested_at"),
    )


def generation_features(staged: DataFrame) -> DataFrame:
    """Capacity sums per snapshot; a fuel class with no row stays null."""
    names = {label: ", ".join(f"'{name}'" for name in fuels) for label, fuels in FUEL_CLASSES.items()}
    rules = {label: f"fuel_type in ({listed})" for label, listed in names.items()}
    rules["other"] = f"fuel_type not in ({', '.join(names.values())})"
    return staged.groupBy("availability_issue_utc", "availability_target_utc", "availability_horizon_hours").agg(
        F.expr("count(distinct fuel_type) as generation_availability_fuel_type_count"),
        _total("available_capacity_mw", "available_capacity_total_mw"),
        _total("outage_capacity_mw", "outage_capacity_total_mw"),
        _total("derated_capacity_mw", "derated_capacity_total_mw"),
        *[_total("available_capacity_mw", f"available_capacity_{label}_mw", rows) for label, rows in rules.items()],
        F.expr("max(ingested_at) as latest_generation_availability_ingested_at"),
    )


def intertie_features(staged: DataFrame) -> DataFrame:
    sums = staged.groupBy("schedule_issue_utc", "schedule_target_utc", "schedule_horizon_hours").agg(
        F.expr("count(distinct intertie_id) as intertie_count"),
        _total("scheduled_import_mw", "scheduled_import_mw"),
        _total("scheduled_export_mw", "scheduled_export_mw"),
        _total("transfer_limit_import_mw", "import_transfer_limit_mw"),
        _total("transfer_limit_export_mw", "export_transfer_limit_mw"),
        _total("constraint_mw", "intertie_constraint_mw"),
        F.expr("max(ingested_at) as latest_intertie_schedule_ingested_at"),
    )
    less = "cast({0} - {1} as decimal(14,2)) as {2}"
    return sums.selectExpr(
        "schedule_issue_utc", "schedule_target_utc", "schedule_horizon_hours", "intertie_count",
        "scheduled_import_mw", "scheduled_export_mw",
        less.format("scheduled_import_mw", "scheduled_export_mw", "net_scheduled_import_mw"),
        "import_transfer_limit_mw", "export_transfer_limit_mw", "intertie_constraint_mw",
        less.format("import_transfer_limit_mw", "scheduled_import_mw", "import_headroom_mw"),
        less.format("export_transfer_limit_mw", "scheduled_export_mw", "export_headroom_mw"),
        "latest_intertie_schedule_ingested_at",
    )
