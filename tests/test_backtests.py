from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridcast.contracts import BacktestRules
from gridcast.plans import backtests
from tests.conftest import rows


def half_year(spark):
    return spark.range(182 * 24).selectExpr(
        "1 as horizon_hours", "timestamp'2024-01-01' + make_dt_interval(0, cast(id as int)) as target_timestamp_utc")


def windows(spark, df=None, **rules):
    defaults = dict(min_train_days=60, rolling_train_days=90, min_test_days=25, min_train_rows=24, min_test_rows=24, max_windows=None)
    found = backtests.backtest_windows(half_year(spark) if df is None else df, BacktestRules(**(defaults | rules)))
    return [tuple(str(v) for v in r) for r in found.orderBy("test_start").select(
        "train_start", "train_end", "test_start", "test_end", "train_row_count", "test_row_count").collect()]


def test_expanding_windows(spark):
    found = windows(spark)
    assert found[0] == ("2024-01-01 00:00:00", "2024-02-29 23:00:00", "2024-03-01 00:00:00", "2024-03-31 23:00:00", "1440", "744")
    assert found[1][:3] == ("2024-01-01 00:00:00", "2024-03-31 23:00:00", "2024-04-01 00:00:00")
    assert len(found) == 4


def test_rolling_windows(spark):
    found = windows(spark, mode="rolling", min_train_days=30, rolling_train_days=31)
    assert found[0][2] == "2024-02-01 00:00:00"
    assert found[1][2] == "2024-03-01 00:00:00"
    assert found[1][0] == "2024-01-30 00:00:00"
    assert len(found) == 5


@pytest.mark.parametrize("days", [1, 10, 28, 45, 90, 200])
def test_rolling_history_equals_brute_force(spark, days):
    holes = half_year(spark).where("pmod(hash(target_timestamp_utc), 5) > 0")
    found = windows(spark, holes, mode="rolling", min_train_days=0, rolling_train_days=days, min_test_days=0, min_train_rows=1, min_test_rows=1)
    times = sorted(r[0] for r in holes.select("target_timestamp_utc").collect())
    from datetime import datetime, timedelta

    expected = []
    for month in range(1, 8):
        start = datetime(2024, month, 1)
        test = [t for t in times if (t.year, t.month) == (2024, month)]
        train = [t for t in times if test and start - timedelta(days=days) <= t < test[0]]
        if test and train:
            expected.append(tuple(str(v) for v in (train[0], train[-1], test[0], test[-1], len(train), len(test))))
    assert found == expected


def test_last_windows_and_switch(spark):
    assert [w[2] for w in windows(spark, max_windows=2)] == ["2024-05-01 00:00:00", "2024-06-01 00:00:00"]
    assert windows(spark, enabled=False) == []
    one = backtests.backtest_windows(half_year(spark), BacktestRules(min_train_days=60, max_windows=1)).first()
    assert one.window_id == "expanding_20240601T000000Z_20240630T230000Z"
    with pytest.raises(ValueError):
        BacktestRules(mode="sideways")


def metric_rows(spark, values):
    return spark.createDataFrame(
        [(m, f"{m}_model", 1, f"w{i}", v, v * 1.2, 1.0, 0.0, v, 100.0, 0.2) for m, vs in values.items() for i, v in enumerate(vs)],
        "model_id string, model_name string, horizon_hours int, window_id string, mae double, rmse double, mape double, "
        "mean_error double, median_absolute_error double, peak_period_mae double, underprediction_rate double")


def test_summary_averages_windows(spark):
    got = backtests.backtest_summary(metric_rows(spark, {"candidate": [10.0, 14.0, 18.0], "other": [20.0, 22.0, float("nan")]}))
    assert [(r.model_id, r.valid_window_count, r.average_mae, round(r.average_rmse, 9)) for r in got.orderBy("model_id").collect()] == [
        ("candidate", 3, 14.0, 16.8), ("other", 2, 21.0, 25.2)]


def test_summary_without_the_primary_metric_is_empty(spark):
    assert backtests.backtest_summary(metric_rows(spark, {"a": [1.0]}).drop("mae")).count() == 0


def test_backtest_of_a_baseline_matches_hand_computation(spark):
    frame = half_year(spark).selectExpr(
        "*", "cast(unix_timestamp(target_timestamp_utc) / 3600 as double) as target_load_mw", "cast(null as double) as load_lag_168h",
        "cast(null as double) as load_rolling_24h_avg").withColumn("load_lag_24h", F.col("target_load_mw") - 24)
    models = spark.createDataFrame([("id-1", "baseline_same_hour_yesterday", "baseline", 1)], "model_id string, model_name string, model_type string, horizon_hours int")
    rules = BacktestRules(min_train_days=60, max_windows=2)
    got = backtests.backtest_baselines(frame, models, rules, "run", F.lit(None).cast("timestamp"))
    assert rows(got, "model_id", "mae", "mean_error", "underprediction_rate", "prediction_row_count") == [
        ("id-1", 24.0, -24.0, 1.0, 720), ("id-1", 24.0, -24.0, 1.0, 744)]

    ruled = spark.createDataFrame(
        [("id-2", "own_name", "baseline", 1, '{"rule": "load_lag_24h"}'), ("id-3", "own_name", "baseline", 1, "nope")],
        "model_id string, model_name string, model_type string, horizon_hours int, parameters string")
    got = backtests.backtest_baselines(frame, ruled, rules, "run", F.lit(None).cast("timestamp"))
    assert rows(got, "model_id", "mae") == [("id-2", 24.0), ("id-2", 24.0)]

    # any column of the frame may be a rule
    wide = frame.withColumn("load_lag_1h", F.col("target_load_mw") - 1).withColumn("load_rolling_168h_avg", F.col("target_load_mw") + 2)
    names = {"a": "load_lag_24h", "b": "load_lag_1h", "c": "load_rolling_168h_avg", "d": "no_column"}
    ruled = spark.createDataFrame(
        [(k, "own_name", "baseline", 1, f'{{"rule": "{v}"}}') for k, v in names.items()],
        "model_id string, model_name string, model_type string, horizon_hours int, parameters string")
    got = backtests.backtest_baselines(wide, ruled, rules, "run", F.lit(None).cast("timestamp"))
    assert rows(got, "model_id", "mae") == [("a", 24.0), ("a", 24.0), ("b", 1.0), ("b", 1.0), ("c", 2.0), ("c", 2.0)]
