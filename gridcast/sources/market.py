"""Hourly load and price from CSV exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.contracts import require_columns
from gridcast.functions.coerce import to_number, to_utc_timestamp
from gridcast.sources.csv_parts import read_csv_parts, refused_rows

# fixed values: the export's column names
TIME, LOAD, PRICE = "Date_Begin_GMT", "ACTUAL_AIL", "ACTUAL_POOL_PRICE"


def read_market_parts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The three used columns as text, with the file and the line they come from."""
    return read_csv_parts(spark, paths, [TIME, LOAD, PRICE], "Market CSV")


def read_market_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The three used columns of one or many CSV exports, as text.

    Files may hold further columns and order theirs differently, so each is
    read by its own header.
    """
    return read_market_parts(spark, paths).select(TIME, LOAD, PRICE)


def refused_market(parts: DataFrame) -> DataFrame:
    """The rows of `read_market_parts` that transform_market leaves out: file, line, reason."""
    return refused_rows(parts, {TIME: to_utc_timestamp, LOAD: to_number, PRICE: to_number})


def transform_market(
    df: DataFrame, source: str = "market_csv", ingested_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(load, price) raw tables. A row missing its time or either value is in neither."""
    require_columns(df, [TIME, LOAD, PRICE], "Market CSV")
    stamped = F.current_timestamp() if ingested_at is None else ingested_at
    typed = df.select(
        to_utc_timestamp(TIME).alias("interval_start_utc"),
        to_number(LOAD).alias("alberta_internal_load_mw"),
        to_number(PRICE).alias("pool_price_cad_mwh"),
        F.lit(source).alias("source"),
        stamped.alias("ingested_at"),
    ).dropna(subset=["interval_start_utc", "alberta_internal_load_mw", "pool_price_cad_mwh"])
    load = typed.select("interval_start_utc", "alberta_internal_load_mw", "source", "ingested_at")
    price = typed.select("interval_start_utc", "pool_price_cad_mwh", "source", "ingested_at")
    return load, price


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Stop an ingestion that produced nothing; looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"{label} ingestion produced no valid rows")
    return df
