"""Known-as-of snapshot feeds: weather forecasts, generation availability, intertie schedules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.contracts import RAW_GENERATION, RAW_INTERTIE, RAW_WEATHER, require_columns
from gridcast.functions.coerce import key_text, optional_number, optional_text, to_utc_timestamp


@dataclass(frozen=True)
class FeedContract:
    label: str
    schema: str
    issue: str
    target: str
    entity: str
    entity_default: str
    numbers: tuple[str, ...]
    default_source: str
    unit: str | None = None


# fixed values: the three feeds
WEATHER = FeedContract(
    "Weather forecast", RAW_WEATHER, "forecast_issue_utc", "forecast_target_utc", "region", "alberta",
    ("temperature_c", "wind_speed_mps", "relative_humidity_pct", "precipitation_mm"),
    "external_weather_forecast_csv",
)
GENERATION = FeedContract(
    "Generation availability", RAW_GENERATION, "availability_issue_utc", "availability_target_utc",
    "fuel_type", "unknown",
    ("available_capacity_mw", "derated_capacity_mw", "outage_capacity_mw"),
    "external_generation_availability_csv", unit="unit_id",
)
INTERTIE = FeedContract(
    "Intertie schedule", RAW_INTERTIE, "schedule_issue_utc", "schedule_target_utc", "intertie_id", "unknown",
    ("scheduled_import_mw", "scheduled_export_mw", "transfer_limit_import_mw",
     "transfer_limit_export_mw", "constraint_mw"),
    "external_intertie_schedule_csv",
)
UNIT_DEFAULT = "unreported"


def transform_feed(
    df: DataFrame, feed: FeedContract, source: str | None = None, ingested_at: Column | None = None
) -> DataFrame:
    """Typed raw rows of one feed; rows without both times are dropped, absent columns become null."""
    require_columns(df, [feed.issue, feed.target, feed.entity], feed.label)
    stamped = F.current_timestamp() if ingested_at is None else ingested_at
    columns = [
        to_utc_timestamp(feed.issue).alias(feed.issue),
        to_utc_timestamp(feed.target).alias(feed.target),
        F.expr(key_text(feed.entity, feed.entity_default)).alias(feed.entity),
    ]
    if feed.unit:
        columns.append(optional_text(df, feed.unit, UNIT_DEFAULT).alias(feed.unit))
    columns += [optional_number(df, name).alias(name) for name in feed.numbers]
    columns += [
        optional_text(df, "source", source or feed.default_source).alias("source"),
        stamped.alias("ingested_at"),
    ]
    return df.select(*columns).dropna(subset=[feed.issue, feed.target])


def empty_feed(spark: SparkSession, feed: FeedContract) -> DataFrame:
    """Stands for a feed that is absent or switched off: no rows, full schema."""
    return spark.createDataFrame([], feed.schema)


def read_feed_csv(spark: SparkSession, path: str | None, feed: FeedContract, **options) -> DataFrame | None:
    """Transformed feed from CSV, or None when no path is configured."""
    if path is None or not path.strip():
        return None
    return transform_feed(spark.read.csv(path.strip(), header=True), feed, **options)
