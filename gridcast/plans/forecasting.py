"""Time splits, baseline forecasts, forecast errors and their metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.contracts import BASELINES
from gridcast.functions.coerce import finite
from gridcast.operators.groups import join_small_groups
from gridcast.operators.ranks import exact_quantile, values_at

# fixed values: shares of the distinct timestamps, and where peaks begin
TRAIN_SHARE, VALIDATION_END_SHARE = 0.70, 0.85
MINIMUM_HOURS = 30
PEAK_SHARE = 0.90
_TS, _ACTUAL, _PREDICTED = "target_timestamp_utc", "target_load_mw", "predicted_load_mw"
_GROUP = ["model_id", "model_name", "horizon_hours", "evaluation_split"]


def time_splits(df: DataFrame, keys: list[str] = ("horizon_hours",)) -> DataFrame:
    """Add `evaluation_split` by position of the timestamp among the distinct ones of its key.

    Only two cut times per key are looked up; rows are never ranked.
    """
    keys = list(keys)
    times = df.selectExpr(*keys, f"unix_micros({_TS}) as _micros").distinct()
    last = "cast(rows_total * {!r}D as bigint) - 1"
    cuts = values_at(
        times, "_micros", {"_train": last.format(TRAIN_SHARE), "_validation": last.format(VALIDATION_END_SHARE)}, keys
    ).selectExpr(
        *keys,
        f"if(rows_total < {MINIMUM_HOURS}, cast(raise_error('at least {MINIMUM_HOURS} hourly rows are required for"
        " time-based splits') as bigint), _train) as _train",
        "_validation",
    )
    micros = f"unix_micros({_TS})"
    split = f"case when {micros} <= _train then 'train' when {micros} <= _validation then 'validation' else 'test' end"
    return join_small_groups(df, cuts, keys).selectExpr(*df.columns, f"{split} as evaluation_split")


def model_id(run_id: str) -> str:
    """SQL text of a repeatable model id from the run, the model's name and its horizon."""
    return f"md5(concat_ws(':', '{run_id}', model_name, horizon_hours))"


def baseline_rows(df: DataFrame, specs: dict[str, str] = BASELINES) -> DataFrame:
    """One prediction row per baseline whose predictor column is known."""
    present = {name: column for name, column in specs.items() if column in df.columns}
    entries = ", ".join(
        f"struct('{name}' as model_name, cast({column} as double) as {_PREDICTED})" for name, column in present.items()
    )
    kept = [c for c in df.columns if c not in present.values()]
    return df.selectExpr(*kept, f"inline(array({entries}))").where(f"{_PREDICTED} is not null")


def baseline_forecasts(split: DataFrame, run_id: str, specs: dict[str, str] = BASELINES) -> DataFrame:
    """Baseline predictions of the validation and test rows."""
    held_out = split.where("evaluation_split in ('validation', 'test')").selectExpr(
        "horizon_hours", "evaluation_split", "feature_as_of_timestamp_utc", _TS, _ACTUAL, "actual_pool_price_cad_mwh",
        *specs.values(),
    )
    return baseline_rows(held_out, specs).withColumn("model_id", F.expr(model_id(run_id)))


def peak_thresholds(frame: DataFrame, keys: list[str] = ("horizon_hours",)) -> DataFrame:
    """0.90 quantile of the actual load over a horizon's whole frame."""
    return exact_quantile(frame, _ACTUAL, PEAK_SHARE, list(keys), "peak_threshold_mw")


def with_peak_flag(rows: DataFrame, thresholds: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """Add `peak_threshold_mw` and `is_peak_period`.

    A group none of whose rows reaches the threshold of its `keys` uses the 0.90
    quantile of its own rows instead.
    """
    reached = rows.groupBy(*group).agg(F.max(F.col(_ACTUAL).cast("double")).alias("_top")).join(thresholds, keys)
    below = reached.where("_top < peak_threshold_mw").select(*group)
    own = exact_quantile(rows.join(below, group, "left_semi"), _ACTUAL, PEAK_SHARE, group, "_own")
    effective = reached.join(own, group, "left").selectExpr(
        *group, "coalesce(_own, peak_threshold_mw) as peak_threshold_mw"
    )
    return join_small_groups(rows, effective, group).withColumn("is_peak_period", F.expr(f"{_ACTUAL} >= peak_threshold_mw"))


def forecast_results(predictions: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Forecast rows with error, absolute error, percentage error and peak flag."""
    return with_peak_flag(predictions, thresholds, ["horizon_hours"], _GROUP).selectExpr(
        "horizon_hours", "evaluation_split", "feature_as_of_timestamp_utc", _TS, _ACTUAL,
        "actual_pool_price_cad_mwh", "model_id", "model_name", _PREDICTED,
        f"{_PREDICTED} - {_ACTUAL} as error_mw",
        f"abs({_PREDICTED} - {_ACTUAL}) as absolute_error_mw",
        f"abs({_PREDICTED} - {_ACTUAL}) / nullif(cast({_ACTUAL} as double), 0) * 100 as absolute_percentage_error",
        "is_peak_period",
        "peak_threshold_mw",
    )


def forecast_metrics(
    rows: DataFrame,
    keys: list[str],
    actual: str = _ACTUAL,
    predicted: str = _PREDICTED,
    threshold: str | None = "peak_threshold_mw",
    checked: bool = False,
) -> DataFrame:
    """The seven accuracy metrics per `keys`, over pairs whose both values are finite.

    `threshold` names the column with the group's peak threshold; None takes the
    0.90 quantile of the group's own actuals. A group without a finite pair
    gives no row, or fails the job when `checked`.
    """
    keys = list(keys)
    if checked:
        pairs = rows.groupBy(*keys).agg(F.count_if(finite(actual) & finite(predicted)).alias("_pairs"))
        guard = "if(_pairs = 0, raise_error('No finite actual/predicted pairs'), null) is null"
        rows = rows.join(pairs.where(guard).drop("_pairs"), keys, "left_semi")
    usable = rows.where(finite(actual) & finite(predicted)).selectExpr(
        *keys,
        f"cast({actual} as double) as _actual",
        f"cast({predicted} as double) - cast({actual} as double) as _error",
        f"abs(cast({predicted} as double) - cast({actual} as double)) as _size",
        *([f"{threshold} as _peak"] if threshold else []),
    )
    medians = exact_quantile(usable, "_size", 0.5, keys, "median_absolute_error")
    if threshold is None:
        usable = join_small_groups(usable, exact_quantile(usable, "_actual", PEAK_SHARE, keys, "_peak"), keys)
    averages = usable.groupBy(*keys).agg(
        F.expr("avg(_size)").alias("mae"),
        F.expr("sqrt(avg(_error * _error))").alias("rmse"),
        F.expr("avg(_size / nullif(_actual, 0)) * 100").alias("mape"),
        F.expr("avg(_error)").alias("mean_error"),
        F.expr("avg(case when _error < 0 then 1D else 0D end)").alias("underprediction_rate"),
        F.expr("avg(case when _actual >= _peak then _size end)").alias("peak_period_mae"),
    )
    return averages.join(medians, keys).select(
        *keys, "mae", "rmse", "mape", "mean_error", "median_absolute_error", "underprediction_rate", "peak_period_mae"
    )


def model_performance(results: DataFrame, evaluated_at) -> DataFrame:
    """Metrics of every (model, horizon, split) of a forecast result table."""
    return forecast_metrics(results, _GROUP).withColumn("evaluated_at", evaluated_at)
