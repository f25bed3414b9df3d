"""Typed, deduplicated staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridcast.functions.coerce import default_text, key_text
from gridcast.operators.dedup import dedup_crowded, dedup_latest
from gridcast.sources.feeds import GENERATION, INTERTIE, UNIT_DEFAULT, WEATHER, FeedContract

DEGREE_BASE_C = 18
MW = "decimal(12,2)"


def _hourly(df: DataFrame, value: str, name: str, tiebreak: list[str]) -> DataFrame:
    typed = df.where("interval_start_utc is not null").selectExpr(
        "cast(interval_start_utc as timestamp) as timestamp_utc", f"cast({value} as {MW}) as {name}",
        "cast(source as string) as source", "cast(ingested_at as timestamp) as ingested_at", *tiebreak,
    )
    return dedup_latest(typed, ["timestamp_utc"], "ingested_at", tiebreak).drop(*tiebreak)


def stage_load(raw: DataFrame, tiebreak: list[str] = ()) -> DataFrame:
    """One load row per hour, the last ingested. `tiebreak` settles equal ingestion times."""
    return _hourly(raw, "alberta_internal_load_mw", "load_mw", list(tiebreak))


def stage_price(raw: DataFrame, tiebreak: list[str] = ()) -> DataFrame:
    return _hourly(raw, "pool_price_cad_mwh", "pool_price_cad_mwh", list(tiebreak))


def _snapshots(
    raw: DataFrame, feed: FeedContract, horizon: str, types: dict[str, str], derived: list[str], tiebreak: list[str]
) -> DataFrame:
    """Valid snapshots of a feed, one per (issue, target, entity[, unit])."""
    keys = {feed.entity: key_text(feed.entity, feed.entity_default)}
    if feed.unit:
        keys[feed.unit] = default_text(feed.unit, UNIT_DEFAULT)
    valid = f"{feed.issue} is not null and {feed.target} is not null and {feed.target} >= {feed.issue}"
    typed = raw.where(valid).selectExpr(
        *[f"cast({c} as timestamp) as {c}" for c in (feed.issue, feed.target)],
        *[f"{text} as {name}" for name, text in keys.items()],
        *[f"cast({c} as {types.get(c, MW)}) as {c}" for c in feed.numbers],
        "cast(source as string) as source", "cast(ingested_at as timestamp) as ingested_at", *tiebreak,
    )
    newest = dedup_crowded(typed, [feed.issue, feed.target, *keys], "ingested_at", tiebreak)
    seconds = f"(unix_timestamp({feed.target}) - unix_timestamp({feed.issue}))"
    return newest.selectExpr(
        feed.issue, feed.target, f"cast(round({seconds} / 3600) as int) as {horizon}",
        *keys, *feed.numbers, *derived, "source", "ingested_at",
    )


def degrees(difference: str) -> str:
    """SQL text: positive part of a temperature difference; null stays null."""
    return f"cast(case when ({difference}) is not null then greatest({difference}, 0) end as decimal(8,2))"


def stage_weather(raw: DataFrame, tiebreak: list[str] = ()) -> DataFrame:
    types = {name: "decimal(8,2)" for name in WEATHER.numbers} | {"precipitation_mm": "decimal(10,3)"}
    derived = [
        f"{degrees(f'{DEGREE_BASE_C} - temperature_c')} as heating_degree_c",
        f"{degrees(f'temperature_c - {DEGREE_BASE_C}')} as cooling_degree_c",
    ]
    return _snapshots(raw, WEATHER, "forecast_horizon_hours", types, derived, list(tiebreak))


def stage_generation(raw: DataFrame, tiebreak: list[str] = ()) -> DataFrame:
    return _snapshots(raw, GENERATION, "availability_horizon_hours", {}, [], list(tiebreak))


def stage_intertie(raw: DataFrame, tiebreak: list[str] = ()) -> DataFrame:
    return _snapshots(raw, INTERTIE, "schedule_horizon_hours", {}, [], list(tiebreak))
