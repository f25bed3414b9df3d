"""Monthly backtest windows and the evaluation of models over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.contracts import BASELINES, METRICS, BacktestRules
from gridcast.functions.coerce import finite, finite_or_null
from gridcast.functions.documents import text_field
from gridcast.plans.forecasting import PEAK_SHARE, baseline_rows

_TS, _ACTUAL, _H = "target_timestamp_utc", "target_load_mw", "horizon_hours"


def _days(df: DataFrame) -> DataFrame:
    """Distinct timestamps per horizon and UTC day: count, first and last."""
    return (
        df.where(f"{_TS} is not null").select(_H, _TS).distinct()
        .groupBy(_H, F.to_date(_TS).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(_TS).alias("_first"), F.max(_TS).alias("_last"))
    )


def _merged(prefix: str) -> list[Column]:
    return [
        F.sum("_rows").alias(f"{prefix}_row_count"),
        F.min("_first").alias(f"{prefix}_start"),
        F.max("_last").alias(f"{prefix}_end"),
    ]


def backtest_windows(df: DataFrame, rules: BacktestRules) -> DataFrame:
    """Test months with the training history before them, the last `max_windows` per horizon.

    Works on per-day counts. Expanding history is a running sum over months;
    rolling history sends each day to the months whose window holds it, so no
    range join is needed.
    """
    days = _days(df)
    if not rules.enabled:
        days = days.where("false")
    months = days.groupBy(_H, F.trunc("_day", "month").alias("_month")).agg(*_merged("test"))
    if rules.mode == "rolling":
        nearby = f"""sequence(
            add_months(trunc(_day, 'month'), 1),
            greatest(trunc(date_add(_day, {rules.rolling_train_days}), 'month'), add_months(trunc(_day, 'month'), 1)),
            interval 1 month)"""
        history = (
            days.selectExpr("*", f"explode({nearby}) as _month")
            .where(f"_month <= date_add(_day, {rules.rolling_train_days})")
            .groupBy(_H, "_month").agg(*_merged("train"))
        )
        windows = months.join(history, [_H, "_month"])
    else:
        before = f"over (partition by {_H} order by _month rows between unbounded preceding and 1 preceding)"
        windows = months.selectExpr(
            "*",
            f"sum(test_row_count) {before} as train_row_count",
            f"min(test_start) {before} as train_start",
            f"max(test_end) {before} as train_end",
        ).where("train_row_count is not null")

    def spans(part, days_needed):
        return f"{part}_end >= {part}_start + make_dt_interval({days_needed}) - interval 1 hour"

    eligible = windows.where(
        f"test_row_count >= {rules.min_test_rows} and train_row_count >= {rules.min_train_rows}"
        f" and {spans('test', rules.min_test_days)} and {spans('train', rules.min_train_days)}"
    )
    if rules.max_windows is not None:
        newest = Window.partitionBy(_H).orderBy(F.col("_month").desc())
        eligible = (
            eligible.withColumn("_rank", F.row_number().over(newest))
            .where(F.col("_rank") <= rules.max_windows).drop("_rank")
        )
    stamp = "date_format({}, \"yyyyMMdd'T'HHmmss'Z'\")"
    return eligible.selectExpr(
        _H,
        f"concat_ws('_', '{rules.mode}', {stamp.format('test_start')}, {stamp.format('test_end')}) as window_id",
        f"'{rules.mode}' as backtest_mode",
        "train_start", "train_end", "test_start", "test_end",
        "cast(train_row_count as bigint) as train_row_count", "cast(test_row_count as bigint) as test_row_count",
    )


def _in_window(rows: DataFrame, windows: DataFrame, part: str) -> DataFrame:
    """Rows inside each window's train or test bounds.

    There is at most one window per calendar month and horizon, so the window
    side is bounded by the length of the history, not by the rows; it is
    broadcast and the rows stay where they are.
    """
    side = F.broadcast(windows.selectExpr(f"{_H} as _h", "window_id", f"{part}_start as _from", f"{part}_end as _to"))
    inside = (F.col(_H) == F.col("_h")) & F.col(_TS).between(F.col("_from"), F.col("_to"))
    return rows.join(side, inside).drop("_h", "_from", "_to")


def train_thresholds(frame: DataFrame, windows: DataFrame) -> DataFrame:
    """0.90 quantile of the training load per window: one value per hour of history at most."""
    return (
        _in_window(frame.select(_H, _TS, _ACTUAL), windows, "train")
        .groupBy(_H, "window_id").agg(F.percentile(F.col(_ACTUAL).cast("double"), PEAK_SHARE).alias("_threshold"))
    )


def evaluate_windows(frame: DataFrame, predictions: DataFrame, windows: DataFrame, run_id: str, evaluated_at: Column) -> DataFrame:
    """Backtest result rows of predictions that already carry model, horizon and window.

    `predictions` has model_id, model_name, model_type, horizon_hours, window_id
    and the test rows' actual and predicted load. A (model, window) group holds
    one calendar month of hours, so exact percentiles per group are bounded.
    """
    group = ["model_id", "model_name", "model_type", _H, "window_id"]
    usable = predictions.join(train_thresholds(frame, windows), [_H, "window_id"])
    own = usable.groupBy(*group).agg(
        F.max(F.col(_ACTUAL).cast("double")).alias("_top"),
        F.percentile(F.col(_ACTUAL).cast("double"), PEAK_SHARE).alias("_own"),
        F.count(F.lit(1)).alias("prediction_row_count"),
        F.first("_threshold").alias("_threshold"),
    ).selectExpr(*group, "prediction_row_count", "if(_top >= _threshold, _threshold, _own) as peak_threshold_mw")
    scored = usable.drop("_threshold").join(own, group).where(finite(_ACTUAL) & finite("predicted_load_mw")).selectExpr(
        *group, "prediction_row_count", "peak_threshold_mw",
        f"cast({_ACTUAL} as double) as _actual",
        f"predicted_load_mw - cast({_ACTUAL} as double) as _error",
        f"abs(predicted_load_mw - cast({_ACTUAL} as double)) as _size",
    )
    metrics = scored.groupBy(*group, "prediction_row_count", "peak_threshold_mw").agg(
        F.expr("avg(_size)").alias("mae"),
        F.expr("sqrt(avg(_error * _error))").alias("rmse"),
        F.expr("avg(_size / nullif(_actual, 0)) * 100").alias("mape"),
        F.expr("avg(_error)").alias("mean_error"),
        F.expr("percentile(_size, 0.5)").alias("median_absolute_error"),
        F.expr("avg(case when _error < 0 then 1D else 0D end)").alias("underprediction_rate"),
        F.expr("avg(case when _actual >= peak_threshold_mw then _size end)").alias("peak_period_mae"),
    )
    return (
        metrics.join(windows, [_H, "window_id"])
        .withColumn("evaluated_at", evaluated_at)
        .selectExpr(
            f"'{run_id}' as run_id", *group, "backtest_mode",
            "train_start as train_start_timestamp_utc", "train_end as train_end_timestamp_utc",
            "test_start as test_start_timestamp_utc", "test_end as test_end_timestamp_utc",
            "train_row_count", "test_row_count", "prediction_row_count", "peak_threshold_mw", "evaluated_at",
            "mae", "rmse", "mape", "mean_error", "median_absolute_error", "underprediction_rate", "peak_period_mae",
        )
    )


def backtest_baselines(
    frame: DataFrame, models: DataFrame, rules: BacktestRules, run_id: str, evaluated_at: Column,
    specs: dict[str, str] = BASELINES,
) -> DataFrame:
    """Every registered baseline on every window of its horizon, all models in one pass.

    A model predicts with the column its parameters name as "rule", or else the
    one `specs` gives for its name; models with neither, or with a rule
    that is no column of the frame, are left out.
    """
    windows = backtest_windows(frame, rules)
    known = ", ".join(f"'{name}', '{column}'" for name, column in specs.items())
    rule = F.expr(f"element_at(map({known}), model_name)")
    if "parameters" in models.columns:
        rule = F.coalesce(text_field("parameters", "rule"), rule)
    baselines = models.where("model_type = 'baseline'").select(
        "model_id", "model_name", "model_type", _H, rule.alias("predictor")
    )
    # at most one row per column of the frame
    asked = baselines.where(F.col("predictor").isin(*frame.columns)).select("predictor").distinct().collect()
    predictors = sorted(row.predictor for row in asked)
    if not predictors:
        predictors = list(dict.fromkeys(specs.values()))
    test = _in_window(frame.select(_H, _TS, _ACTUAL, *[F.col(c).alias(f"_rule_{c}") for c in predictors]), windows, "test")
    predictions = (
        baseline_rows(test, {column: f"_rule_{column}" for column in predictors})
        .withColumnRenamed("model_name", "predictor").join(baselines, ["predictor", _H])
    )
    return evaluate_windows(frame, predictions, windows, run_id, evaluated_at)


def backtest_summary(results: DataFrame, primary: str = "mae") -> DataFrame:
    """Distinct windows and mean of every metric per model and horizon, finite primary only.

    Metrics that are not numbers are left out of their mean, like blanks.
    """
    keys = ["model_id", "model_name", _H]
    if primary not in results.columns:
        results = results.withColumn(primary, F.lit(None).cast("double"))
    usable = results.where(finite(F.col(primary).try_cast("double")))
    window = F.col("window_id") if "window_id" in results.columns else F.monotonically_increasing_id()
    numbers = {m: F.col(m).try_cast("double") if m in results.columns else F.lit(None).cast("double") for m in METRICS}
    return usable.withColumn("window_id", window).groupBy(*keys).agg(
        F.count_distinct("window_id").alias("valid_window_count"),
        *[F.avg(F.when(~F.isnan(number), number)).alias(f"average_{m}") for m, number in numbers.items()],
    )


def candidate_summary(results: DataFrame, primary: str = "mae") -> DataFrame:
    """Valid windows and finite-only metric means per model, for candidates without a champion."""
    numbers = {m: finite_or_null(m) if m in results.columns else F.lit(None).cast("double") for m in {*METRICS, primary}}
    usable = results.where(numbers[primary].isNotNull())
    return usable.groupBy("model_id").agg(
        F.count_distinct("window_id").alias("valid_window_count"),
        *[F.avg(numbers[m]).alias(f"average_{m}") for m in METRICS],
    )
