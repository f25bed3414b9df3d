"""Column contracts, feature lists and rule settings shared by the plans.

The names and defaults in this module are fixed values: downstream tables and
saved models depend on them, so they are written out rather than derived.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

# --- fixed values: raw table columns, in contract order -------------------------
RAW_LOAD = "interval_start_utc timestamp, alberta_internal_load_mw double, source string, ingested_at timestamp"
RAW_PRICE = "interval_start_utc timestamp, pool_price_cad_mwh double, source string, ingested_at timestamp"
RAW_WEATHER = (
    "forecast_issue_utc timestamp, forecast_target_utc timestamp, region string, "
    "temperature_c double, wind_speed_mps double, relative_humidity_pct double, "
    "precipitation_mm double, source string, ingested_at timestamp"
)
RAW_GENERATION = (
    "availability_issue_utc timestamp, availability_target_utc timestamp, fuel_type string, "
    "unit_id string, available_capacity_mw double, derated_capacity_mw double, "
    "outage_capacity_mw double, source string, ingested_at timestamp"
)
RAW_INTERTIE = (
    "schedule_issue_utc timestamp, schedule_target_utc timestamp, intertie_id string, "
    "scheduled_import_mw double, scheduled_export_mw double, transfer_limit_import_mw double, "
    "transfer_limit_export_mw double, constraint_mw double, source string, ingested_at timestamp"
)

# --- fixed values: model features, in model-vector order ------------------------
BASE_FEATURES = [
    "hour", "day_of_week", "month", "is_weekend",
    "load_lag_1h", "load_lag_24h", "load_lag_168h",
    "load_rolling_24h_avg", "load_rolling_168h_avg",
    "price_lag_24h", "price_rolling_24h_avg",
]
HOLIDAY_FEATURES = [
    "is_stat_holiday", "is_alberta_stat_holiday", "is_canada_stat_holiday",
    "is_long_weekend", "is_workday", "is_non_workday",
]
WEATHER_FEATURES = [
    "weather_forecast_age_hours", "weather_forecast_region_count",
    "forecast_temperature_c", "forecast_wind_speed_mps", "forecast_relative_humidity_pct",
    "forecast_precipitation_mm", "forecast_heating_degree_c", "forecast_cooling_degree_c",
]
GENERATION_FEATURES = [
    "generation_availability_age_hours", "generation_availability_fuel_type_count",
    "available_capacity_total_mw", "outage_capacity_total_mw", "derated_capacity_total_mw",
    "available_capacity_gas_mw", "available_capacity_coal_mw", "available_capacity_hydro_mw",
    "available_capacity_wind_mw", "available_capacity_solar_mw",
    "available_capacity_storage_mw", "available_capacity_other_mw",
]
INTERTIE_FEATURES = [
    "intertie_schedule_age_hours", "intertie_count",
    "scheduled_import_mw", "scheduled_export_mw", "net_scheduled_import_mw",
    "import_transfer_limit_mw", "export_transfer_limit_mw", "intertie_constraint_mw",
    "import_headroom_mw", "export_headroom_mw",
]
OPTIONAL_FEATURES = WEATHER_FEATURES + GENERATION_FEATURES + INTERTIE_FEATURES
FEATURES = BASE_FEATURES + HOLIDAY_FEATURES + OPTIONAL_FEATURES

# --- fixed values: baselines, metrics, flags -------------------------------------
BASELINES = {
    "baseline_same_hour_yesterday": "load_lag_24h",
    "baseline_same_hour_last_week": "load_lag_168h",
    "baseline_rolling_24h_average": "load_rolling_24h_avg",
}
METRICS = [
    "mae", "rmse", "mape", "mean_error",
    "median_absolute_error", "peak_period_mae", "underprediction_rate",
]
ACCURACY_METRICS = ["mae", "rmse", "mape"]
HOLIDAY_FLAGS = [
    "is_holiday", "is_stat_holiday", "is_alberta_stat_holiday",
    "is_canada_stat_holiday", "is_long_weekend", "is_non_workday",
]
HORIZONS = [1, 24]


@dataclass(frozen=True)
class BacktestRules:
    """Which calendar months qualify as backtest windows."""

    enabled: bool = True
    mode: str = "expanding"
    min_train_days: int = 90
    rolling_train_days: int = 180
    min_test_days: int = 7
    min_train_rows: int = 168
    min_test_rows: int = 24
    max_windows: int | None = 6

    def __post_init__(self):
        if self.mode not in ("expanding", "rolling"):
            raise ValueError("mode must be 'expanding' or 'rolling'")


@dataclass(frozen=True)
class PromotionRules:
    """When a challenger may replace the champion of its horizon."""

    primary_metric: str = "mae"
    minimum_relative_improvement: float = 0.0
    max_peak_mae_regression: float = 0.05
    max_underprediction_rate_regression: float = 0.02
    minimum_win_rate: float = 0.5
    minimum_valid_windows: int = 3

    def __post_init__(self):
        if self.primary_metric not in ("mae", "rmse"):
            raise ValueError("primary_metric must be 'mae' or 'rmse'")

    def settings(self) -> dict:
        return dict(sorted(asdict(self).items()))


def require_columns(df, columns, label: str) -> None:
    """Fail while the plan is being built, naming every absent column."""
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"{label} data is missing required columns: {', '.join(absent)}")
