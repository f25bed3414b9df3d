"""Dashboard and evaluation reports as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.contracts import ACCURACY_METRICS, HOLIDAY_FLAGS
from gridcast.functions.coerce import TRUE_WORDS, TRUE_WORDS_REPORTS, truthy
from gridcast.operators.groups import join_small_groups
from gridcast.plans.calendar import hourly_spine, time_bounds
from gridcast.plans.governance import current_champions

_SLICE = ["horizon_hours", "model_name", "evaluation_split"]
_CHAMPION_ORDER = ["preferred_at", "trained_at", "created_at", "model_id"]
# fixed values: features that name the weekly baseline, and words that name the calendar
WEEKLY_FEATURES = ["baseline_same_hour_last_week", "load_lag_168h", "load_rolling_168h_avg"]
WEEKLY_WORDS = ["last_week", "168h"]
CALENDAR_WORDS = ["holiday", "workday", "long_weekend"]


def present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def accuracy_metrics(df: DataFrame) -> list[str]:
    return present(df, ACCURACY_METRICS)


def sliced(df: DataFrame, **wanted) -> DataFrame:
    """Rows equal to every given value; lists mean any of them; None means no filter."""
    for column, value in wanted.items():
        if value is None or column not in df.columns:
            continue
        options = value if isinstance(value, (list, tuple, set)) else [value]
        df = df.where(F.col(column).isin(*options))
    return df


# --- market ---------------------------------------------------------------------

def market_kpis(overview: DataFrame) -> DataFrame:
    return overview.agg(
        F.max_by("load_mw", "timestamp_utc").alias("latest_load_mw"),
        F.avg(F.col("load_mw").cast("double")).alias("average_load_mw"),
        F.max("load_mw").alias("peak_load_mw"),
        F.avg(F.col("pool_price_cad_mwh").cast("double")).alias("average_pool_price"),
        F.count(F.lit(1)).alias("hourly_records"),
    )


def daily_load(overview: DataFrame) -> DataFrame:
    return overview.groupBy("date").agg(
        F.avg(F.col("load_mw").cast("double")).alias("daily_average_load_mw"),
        F.max("load_mw").alias("daily_peak_load_mw"),
    )


def top_peaks(peaks: DataFrame, count: int = 200) -> DataFrame:
    return peaks.orderBy("peak_rank").limit(count)


def peak_monitor_kpis(peaks: DataFrame) -> DataFrame:
    return peaks.agg(
        F.max("load_mw").alias("top_load_mw"), F.count(F.lit(1)).alias("peak_rows"),
        F.avg(F.col("pool_price_cad_mwh").cast("double")).alias("average_peak_price"),
    )


def raw_quality(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row, null and duplicate counts of raw tables: name -> (table, value column).

    Rows of one table and hour are counted inside the tasks first; all tables share
    one shuffle. A table without rows has counts of 0 and no times.
    """
    stacked = None
    for number, (df, value) in enumerate(tables.values()):
        one = df.select(F.lit(number).alias("_table"), "interval_start_utc", "ingested_at", F.col(value).isNull().alias("_missing"))
        stacked = one if stacked is None else stacked.unionByName(one)
    hours = stacked.groupBy("_table", "interval_start_utc").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if("_missing").alias("_nulls"), F.max("ingested_at").alias("_latest"))
    known = F.col("interval_start_utc").isNotNull().cast("long")
    found = hours.groupBy("_table").agg(
        F.sum("_rows").alias("_rows"), F.min("interval_start_utc").alias("min_timestamp_utc"),
        F.max("interval_start_utc").alias("max_timestamp_utc"), F.max("_latest").alias("latest_ingestion_time"),
        F.sum("_nulls").alias("_nulls"), F.sum(known).alias("_hours"))
    names = stacked.sparkSession.createDataFrame(list(enumerate(tables)), "_table int, table_name string")
    # one row per table on both sides
    return names.join(found, "_table", "left").select(
        "table_name", F.coalesce("_rows", F.lit(0)).alias("record_count"), "min_timestamp_utc", "max_timestamp_utc", "latest_ingestion_time",
        F.coalesce("_nulls", F.lit(0)).alias("null_value_count"),
        F.coalesce(F.col("_rows") - F.col("_hours"), F.lit(0)).alias("duplicate_timestamp_count"))


def missing_hours(raw: DataFrame, ts: str = "interval_start_utc") -> DataFrame:
    """Number of hours between the first and last that have no row."""
    seen = raw.select(F.col(ts).alias("timestamp_utc")).distinct()
    absent = hourly_spine(time_bounds(raw, ts)).join(seen, "timestamp_utc", "left_anti")
    return absent.agg(F.count(F.lit(1)).alias("missing_hour_count"))


# --- forecasts --------------------------------------------------------------------

def forecast_kpis(results: DataFrame) -> DataFrame:
    return results.groupBy(*_SLICE).agg(
        F.avg("absolute_error_mw").alias("mae"),
        F.expr("sqrt(avg(error_mw * error_mw))").alias("rmse"),
        F.avg("absolute_percentage_error").alias("mape"),
        F.expr("avg(case when error_mw < 0 then 100D else 0D end)").alias("underprediction_pct"),
    )


def error_by(results: DataFrame, part: str) -> DataFrame:
    """MAE per slice by `hour`, `day_of_week` (name) or `month` of the target."""
    parts = {
        "hour": "hour(target_timestamp_utc)",
        "day_of_week": "date_format(target_timestamp_utc, 'EEEE')",
        "month": "month(target_timestamp_utc)",
    }
    return results.withColumn(part, F.expr(parts[part])).groupBy(*_SLICE, part).agg(F.avg("absolute_error_mw").alias("mae"))


def peak_kpis(results: DataFrame) -> DataFrame:
    """Peak-only figures per slice; null where a slice has no peak rows."""
    return results.groupBy(*_SLICE).agg(
        F.expr("avg(case when is_peak_period then absolute_error_mw end)").alias("peak_mae"),
        F.expr("avg(case when is_peak_period then if(error_mw < 0, 100D, 0D) end)").alias("peak_underprediction_pct"),
        F.expr("count_if(is_peak_period)").alias("peak_rows"),
    )


def worst_peak_errors(results: DataFrame, count: int = 50) -> DataFrame:
    return results.where("is_peak_period").orderBy(
        F.desc("absolute_error_mw"), "model_name", "horizon_hours", "target_timestamp_utc"
    ).limit(count)


def residual_histogram(results: DataFrame, bins: int = 40) -> DataFrame:
    """Counts of the error in equal-width bins per slice; the top edge belongs to the last bin."""
    ranges = results.groupBy(*_SLICE).agg(F.min("error_mw").alias("_low"), F.max("error_mw").alias("_high"))
    place = f"if(_high = _low, 0, least(cast(floor((error_mw - _low) / nullif(_high - _low, 0) * {bins}) as int), {bins - 1}))"
    return (
        join_small_groups(results, ranges, _SLICE).selectExpr(*_SLICE, f"{place} as bin")
        .groupBy(*_SLICE, "bin").agg(F.count(F.lit(1)).alias("row_count"))
    )


def model_comparison(performance: DataFrame, split: str | None = "test") -> DataFrame:
    return sliced(performance, evaluation_split=split).orderBy("horizon_hours", "mae")


def best_by(df: DataFrame, metric: str, name: str = "model_name") -> DataFrame:
    """Per horizon the row with the lowest `metric`, then name."""
    order = Window.partitionBy("horizon_hours").orderBy(F.col(metric).asc_nulls_last(), name)
    return df.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def holiday_errors(forecasts: DataFrame, training: DataFrame | None = None) -> DataFrame | None:
    """MAE of holiday and other rows, or None when no flag or error column can be found.

    The flag comes from the forecasts or else from the training rows, joined on
    horizon, as-of and target time, or without the as-of time if a side lacks it.
    """
    error = (
        "cast(absolute_error_mw as double)" if "absolute_error_mw" in forecasts.columns
        else "abs(cast(predicted_load_mw as double) - cast(target_load_mw as double))"
        if {"target_load_mw", "predicted_load_mw"} <= set(forecasts.columns) else None
    )
    if error is None:
        return None
    flag, rows, words = next(iter(present(forecasts, HOLIDAY_FLAGS)), None), forecasts, TRUE_WORDS_REPORTS
    if flag is None:
        flag = next(iter(present(training, HOLIDAY_FLAGS)), None) if training is not None else None
        wanted = ["horizon_hours", "feature_as_of_timestamp_utc", "target_timestamp_utc"]
        on = [c for c in wanted if c in forecasts.columns and training is not None and c in training.columns]
        if flag is None or not {"horizon_hours", "target_timestamp_utc"} <= set(on):
            return None
        rows, words = forecasts.join(training.select(*on, flag), on), TRUE_WORDS
    group = present(rows, _SLICE)
    grouped = rows.withColumn("_error", F.expr(error)).where("_error is not null").withColumn(
        "holiday_group", F.when(truthy(flag, words), "Holiday").otherwise("Non-holiday")
    ).groupBy(*group, "holiday_group").agg(F.avg("_error").alias("mae"), F.count(F.lit(1)).alias("row_count"))
    absent = [c for c in _SLICE if c not in group]
    return grouped.select(
        *[F.lit(None).cast("string").alias(c) if c in absent else F.col(c) for c in _SLICE],
        "holiday_group", "mae", "row_count",
    )


def holiday_columns_summary(backtests: DataFrame) -> DataFrame | None:
    """Mean of stored holiday and non-holiday MAE columns, or None when there are none."""
    pairs = {"Holiday": ["holiday_mae", "holiday_mean_absolute_error"],
             "Non-holiday": ["non_holiday_mae", "non_holiday_mean_absolute_error"]}
    found = {label: next(iter(present(backtests, names)), None) for label, names in pairs.items()}
    if None in found.values():
        return None
    group = present(backtests, ["horizon_hours", "model_name"])
    named = backtests.selectExpr(*group, *[f"try_cast({column} as double) as `{label}`" for label, column in found.items()])
    return (
        named.unpivot(group, list(found), "holiday_group", "mae").where("mae is not null and not isnan(mae)")
        .groupBy(*group, "holiday_group").agg(F.avg("mae").alias("mae"), F.count(F.lit(1)).alias("row_count"))
    )


# --- governance -------------------------------------------------------------------

def latest_runs(df: DataFrame) -> DataFrame:
    """Runs newest first, those without a time last; by name when there are no times."""
    runs = df.where("run_id is not null").withColumn("run_id", F.col("run_id").cast("string"))
    if "evaluated_at" not in df.columns:
        return runs.select("run_id").distinct().orderBy(F.desc("run_id"))
    latest = runs.groupBy("run_id").agg(F.max(F.col("evaluated_at").try_cast("timestamp")).alias("evaluated_at"))
    return latest.orderBy(F.desc_nulls_last("evaluated_at"), F.desc("run_id"))


def latest_run(df: DataFrame) -> DataFrame:
    """Rows of the run evaluated last. The run id is one value, looked up by a scalar subquery."""
    newest = df.where("evaluated_at is not null").agg(F.max(F.struct("evaluated_at", "run_id"))["run_id"].alias("r"))
    return df.where(F.col("run_id") == newest.scalar())


def run_backtest_summary(backtests: DataFrame) -> DataFrame:
    """Per model and horizon of the latest run: windows and metric means."""
    means = ["mae", "rmse", "peak_period_mae", "underprediction_rate"]
    return latest_run(backtests).groupBy("horizon_hours", "model_name").agg(
        F.count(F.lit(1)).alias("valid_windows"), *[F.avg(m).alias(f"average_{m}") for m in means]
    )


def run_decisions(decisions: DataFrame) -> DataFrame:
    return latest_run(decisions).select(
        "horizon_hours", "champion_model_name", "challenger_model_name", "decision", "reason", "valid_window_count",
        "win_rate", "champion_average_mae", "challenger_average_mae", "champion_average_rmse", "challenger_average_rmse",
    ).orderBy("horizon_hours", F.desc("decision"), F.asc_nulls_last("challenger_average_mae"))


def dashboard_champions(registry: DataFrame) -> DataFrame:
    return current_champions(registry, _CHAMPION_ORDER, TRUE_WORDS_REPORTS)


def champion_kpis(champions: DataFrame) -> DataFrame:
    """Horizons, distinct models and the latest date by the first time column that has any."""
    times = [F.max(F.col(c).try_cast("timestamp")) for c in present(champions, ["preferred_at", "trained_at", "created_at"])]
    latest = F.coalesce(*times) if times else F.lit(None).cast("timestamp")
    return champions.agg(
        F.count(F.lit(1)).alias("preferred_horizons"), F.count_distinct("model_name").alias("champion_models"),
        F.to_date(latest).alias("latest_champion_date"),
    )


def with_roles(backtests: DataFrame, champions: DataFrame) -> DataFrame:
    """Mark each backtest row as Champion or Challenger by model id."""
    ids = champions.select(F.col("model_id").cast("string").alias("model_id")).distinct().withColumn("_champion", F.lit(True))
    return (
        backtests.withColumn("model_id", F.col("model_id").cast("string")).join(ids, "model_id", "left")
        .withColumn("governance_role", F.when(F.col("_champion"), "Champion").otherwise("Challenger")).drop("_champion")
    )


def role_summary(backtests: DataFrame, metric: str = "mae") -> DataFrame:
    number = F.nanvl(F.col(metric).try_cast("double"), F.lit(None).cast("double"))
    return backtests.groupBy(*present(backtests, ["horizon_hours", "model_name", "governance_role"])).agg(
        F.avg(number).alias("average_metric"), F.count(number).alias("valid_windows")
    )


def backtest_kpis(backtests: DataFrame, metric: str = "mae") -> DataFrame:
    number = F.nanvl(F.col(metric).try_cast("double"), F.lit(None).cast("double"))
    return backtests.agg(
        F.count_distinct("window_id").alias("backtest_windows"), F.count_distinct("model_name").alias("models_evaluated"),
        F.avg(number).alias("average_metric"),
    )


def decision_kpis(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        F.count_if(F.col("decision") == "promoted").alias("promoted"),
        F.count_if(F.col("decision") == "rejected").alias("rejected"),
        F.max("evaluated_at").alias("latest_decision"),
    )


def feature_group(column: str = "feature_name"):
    name = F.lower(F.trim(F.col(column).cast("string")))
    has = lambda words: F.coalesce(*[F.when(F.contains(name, F.lit(w)), True) for w in words], F.lit(False))
    return (
        F.when(F.coalesce(name.isin(*WEEKLY_FEATURES), F.lit(False)) | has(WEEKLY_WORDS), "Weekly baseline")
        .when(has(CALENDAR_WORDS), "Holiday / calendar")
        .otherwise("Other")
    )


def tagged_features(importance: DataFrame) -> DataFrame:
    group = feature_group() if "feature_name" in importance.columns else F.lit("Other")
    return importance.withColumn("feature_group", group)


def top_features(importance: DataFrame, count: int = 15) -> DataFrame:
    """The most important features of every horizon and model; rows without a number are left out."""
    numbers = importance.withColumn("importance", F.col("importance").try_cast("double")).where(
        "importance is not null and not isnan(importance)"
    )
    order = Window.partitionBy("horizon_hours", "model_name").orderBy(F.desc("importance"), "feature_name")
    return tagged_features(
        numbers.withColumn("feature_rank", F.row_number().over(order)).where(F.col("feature_rank") <= count)
    )


def feature_group_counts(importance: DataFrame, count: int = 15) -> DataFrame:
    return top_features(importance, count).groupBy("horizon_hours", "model_name", "feature_group").agg(
        F.count(F.lit(1)).alias("features")
    )
