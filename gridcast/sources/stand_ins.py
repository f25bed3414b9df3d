"""Views of the driver's tables that stand in for the market's raw tables.

Every view keeps all rows of its event type; see FIXTURES.md for the mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.dates import hours
from gridcast.session import utc_session


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return utc_session(spark).read.parquet(f"{folder}/{name}.parquet")


def _events(spark, folder, kind: str, *columns: str) -> DataFrame:
    """Events of one type as `columns`, then their lineage and id."""
    stamped = table(spark, folder, "events").where(f"event_type = '{kind}'").selectExpr(
        "event_id", "user_id", "cast(ts as timestamp) as ts", "date_trunc('hour', ts) as hour_utc",
        "cast(value as decimal(12,2)) as amount",
    )
    return stamped.selectExpr(*columns, "'events' as source", "ts as ingested_at", "event_id")


def _pick(number: str, *names: str) -> str:
    """SQL text choosing one of `names` by a whole number."""
    quoted = ", ".join(f"'{name}'" for name in names)
    return f"element_at(array({quoted}), cast({number} % {len(names)} + 1 as int))"


def _snapshot_times(issue: str, target: str) -> list[str]:
    return [f"hour_utc as {issue}", f"hour_utc + make_dt_interval(0, cast(event_id % 49 as int)) as {target}"]


def raw_load(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "view", "hour_utc as interval_start_utc", "amount as alberta_internal_load_mw")


def raw_price(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "purchase", "hour_utc as interval_start_utc", "amount as pool_price_cad_mwh")


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    return _events(
        spark, folder, "click", *_snapshot_times("forecast_issue_utc", "forecast_target_utc"),
        _pick("user_id", "Calgary", " edmonton ", "NORTH", "south", "") + " as region",
        "amount * 0.1 - 20 as temperature_c",
        "amount % 15 as wind_speed_mps",
        "case when event_id % 11 <> 0 then amount * 0.2 end as relative_humidity_pct",
        "amount * 0.01 as precipitation_mm",
    )


def raw_generation(spark: SparkSession, folder: str) -> DataFrame:
    return _events(
        spark, folder, "signup", *_snapshot_times("availability_issue_utc", "availability_target_utc"),
        _pick("user_id", "Gas", "natural_gas", "natural gas", "coal", "hydro", "wind", "solar", "storage", "nuclear")
        + " as fuel_type",
        _pick("user_id", "", "u1", "u2", "u3") + " as unit_id",
        "amount as available_capacity_mw",
        "amount * 0.1 as derated_capacity_mw",
        "amount * 0.05 as outage_capacity_mw",
    )


def raw_intertie(spark: SparkSession, folder: str) -> DataFrame:
    return _events(
        spark, folder, "error", *_snapshot_times("schedule_issue_utc", "schedule_target_utc"),
        _pick("user_id", "BC", "sk", "MT") + " as intertie_id",
        "amount as scheduled_import_mw",
        "amount * 0.5 as scheduled_export_mw",
        "500 as transfer_limit_import_mw",
        "400 as transfer_limit_export_mw",
        "case when event_id % 7 <> 0 then amount * 0.25 end as constraint_mw",
    )


def daily_series(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals by day: the long series for splits, backtests and holidays."""
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    return (
        table(spark, folder, "orders")
        .groupBy(F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("timestamp_utc"))
        .agg(
            F.sum(amount).cast("decimal(14,2)").alias("load_mw"),
            F.max(amount).cast("decimal(12,2)").alias("pool_price_cad_mwh"),
        )
    )


def long_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Raw tables of more than six years: order totals by day as load and price, line items as snapshots that
    are issued one to four days before the day of shipping. Amounts are whole cents."""
    daily = daily_series(spark, folder)
    days = lambda n: f"make_dt_interval(cast({n} as int))"
    target = "date_trunc('day', cast(l_shipdate as timestamp))"
    tail = ["'lineitem' as source", f"{target} as ingested_at", "l_orderkey * 10 + l_linenumber as event_id"]
    lines = table(spark, folder, "lineitem")
    times = lambda issue, wanted, ahead: [f"{target} - {days(ahead)} as {issue}", f"{target} as {wanted}"]
    amount = "cast(l_quantity as decimal(12,2))"
    own = ["'orders' as source", "timestamp_utc as ingested_at"]
    return {
        "load": daily.selectExpr("timestamp_utc as interval_start_utc", "load_mw as alberta_internal_load_mw", *own),
        "price": daily.selectExpr("timestamp_utc as interval_start_utc", "pool_price_cad_mwh", *own),
        "weather": lines.selectExpr(
            *times("forecast_issue_utc", "forecast_target_utc", "1 + l_orderkey % 3"),
            _pick("l_suppkey", "Calgary", " edmonton ", "NORTH", "south", "") + " as region",
            f"{amount} - 20 as temperature_c", f"{amount} % 15 as wind_speed_mps",
            f"case when l_orderkey % 11 <> 0 then {amount} * 2 end as relative_humidity_pct", f"{amount} * 0.1 as precipitation_mm", *tail),
        "generation": lines.selectExpr(
            *times("availability_issue_utc", "availability_target_utc", "1 + l_orderkey % 4"),
            _pick("l_suppkey", "Gas", "natural_gas", "natural gas", "coal", "hydro", "wind", "solar", "storage", "nuclear") + " as fuel_type",
            _pick("l_linenumber", "", "u1", "u2", "u3") + " as unit_id", f"{amount} * 10 as available_capacity_mw",
            f"{amount} as derated_capacity_mw", f"{amount} * 0.5 as outage_capacity_mw", *tail),
        "intertie": lines.selectExpr(
            *times("schedule_issue_utc", "schedule_target_utc", "1 + l_orderkey % 2"), _pick("l_suppkey", "BC", "sk", "MT") + " as intertie_id",
            f"{amount} as scheduled_import_mw", f"{amount} * 0.5 as scheduled_export_mw", "500 as transfer_limit_import_mw",
            "400 as transfer_limit_export_mw", f"case when l_orderkey % 7 <> 0 then {amount} * 0.25 end as constraint_mw", *tail),
    }


def model_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as registered models; flags, times and JSON come as untidy text."""
    key = F.col("c_custkey")
    day_text = lambda start, span: F.date_format(F.date_add(F.lit(start).cast("date"), (key % span).cast("int")), "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "customer").select(
        F.concat(F.lit("m"), key.cast("string")).alias("model_id"),
        F.concat(F.lit("name-"), (key % 7).cast("string")).alias("model_name"),
        (key % 25 + 1).cast("int").alias("horizon_hours"),
        F.when(key % 10 != 4, F.expr(_pick("c_custkey", "Yes", " TRUE ", "1", "on", "", "no", "0", "false", "n", "x"))).alias("is_preferred"),
        F.when(key % 3 == 0, None).when(key % 7 == 0, "not a time").otherwise(day_text("2024-01-01", 300)).alias("preferred_at"),
        day_text("2023-06-01", 200).alias("trained_at"),
        F.when(key % 4 != 3, F.expr(_pick("c_custkey", '["load_lag_24h"]', '["a", "b", "c"]', "broken [", ""))).alias("feature_names"),
        F.expr(_pick("c_custkey", '{"rule": "load_lag_168h"}', "[1, 2]", "nope", '{"depth": 4}')).alias("parameters"),
        key.alias("key"),
    )


def backtest_trials(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer and year as backtest results per model and window.

    Amounts are divided by a prime and the rate is smoothed so that means do not
    fall halfway between two printed digits, where engines may round differently.
    """
    key, price = F.col("o_custkey"), F.col("o_totalprice").cast("decimal(12,2)")
    by_window = (
        table(spark, folder, "orders").groupBy(key, F.year("o_orderdate").alias("y"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(price).cast("double").alias("s"), F.min(price).cast("double").alias("lo"),
            F.max(price).cast("double").alias("hi"), F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        )
    )
    return by_window.selectExpr(
        "concat('run-', o_custkey % 3) as run_id",
        "concat('m', o_custkey) as model_id",
        "concat('name-', o_custkey % 7) as model_name",
        "cast(o_custkey % 25 + 1 as int) as horizon_hours",
        "concat('y', y) as window_id",
        "if(o_custkey % 17 = 0 and y = 1998, double('NaN'), s / n / 977) as mae",
        "s / n / 977 * 1.2D as rmse",
        "cast(n as double) as mape",
        "(lo - hi) / 977 as mean_error",
        "hi / 977 as median_absolute_error",
        "if(o_custkey % 13 = 0, null, lo / 977) as peak_period_mae",
        "f / (n + 0.031D) as underprediction_rate",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(o_custkey % 3 as int)) as evaluated_at",
    )


def untidy_market(spark: SparkSession, folder: str, *also: str) -> DataFrame:
    """Events as the text of a market CSV: two time spellings, thousands commas, bad and blank values; `also` names columns of events to keep."""
    i, amount = F.col("event_id"), F.col("value").cast("decimal(12,2)")
    return table(spark, folder, "events").select(
        F.when(i % 13 == 0, "not-a-date").when(i % 2 == 0, F.date_format("ts", "yyyy-MM-dd H:mm"))
        .otherwise(F.date_format("ts", "M/d/yyyy H:mm")).alias("Date_Begin_GMT"),
        F.when(i % 11 == 0, None).when(i % 17 == 0, "bad-load")
        .otherwise(F.concat(F.lit("9,"), F.lpad((i % 1000).cast("string"), 3, "0"))).alias("ACTUAL_AIL"),
        F.when(i % 19 == 0, None).otherwise(amount.cast("string")).alias("ACTUAL_POOL_PRICE"),
        *also,
    )


def untidy_feed(spark: SparkSession, folder: str, issue: str, target: str, entity: str, names: list[str], values: dict[str, str]) -> DataFrame:
    """Events as the text of a snapshot CSV; `values` maps a column to the SQL of its text."""
    i = F.col("event_id")
    return table(spark, folder, "events").select(
        F.when(i % 13 == 0, "bad-date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias(issue),
        F.date_format(F.col("ts") + hours((i % 49).cast("int")), "yyyy-MM-dd HH:mm:ss").alias(target),
        F.expr(_pick("user_id", *names)).alias(entity),
        *[F.expr(sql).alias(name) for name, sql in values.items()],
    )
