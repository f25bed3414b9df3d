from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from gridcast.plans import forecasting as fc
from tests.conftest import rows


def pairs(spark, values, group="m"):
    return spark.createDataFrame([(group, a, p, 300.0) for a, p in values], "g string, a double, p double, t double")


def test_metrics(spark):
    df = pairs(spark, [(100.0, 90.0), (200.0, 210.0), (300.0, 330.0), (400.0, 360.0)])
    m = fc.forecast_metrics(df, ["g"], "a", "p", "t").first()
    assert (m.mae, m.mape, m.mean_error, m.median_absolute_error, m.underprediction_rate, m.peak_period_mae) == (22.5, 8.75, -2.5, 20.0, 0.5, 35.0)
    assert m.rmse == pytest.approx(math.sqrt(675))


def test_metrics_use_finite_pairs_only(spark):
    nan, inf = float("nan"), float("inf")
    df = pairs(spark, [(100.0, 90.0), (nan, 1.0), (5.0, inf), (None, 3.0), (0.0, 10.0)])
    m = fc.forecast_metrics(df, ["g"], "a", "p", "t").first()
    assert (m.mae, m.mape, m.peak_period_mae) == (10.0, 10.0, None)


def test_group_without_finite_pair_is_absent_or_fails_when_checked(spark):
    df = pairs(spark, [(float("nan"), float("nan"))]).unionByName(pairs(spark, [(1.0, 2.0)], "ok"))
    assert rows(fc.forecast_metrics(df, ["g"], "a", "p", "t"), "g") == [("ok",)]
    with pytest.raises(Exception, match="No finite"):
        fc.forecast_metrics(df, ["g"], "a", "p", "t", checked=True).collect()
    fine = fc.forecast_metrics(df.where("g = 'ok'"), ["g"], "a", "p", "t", checked=True)
    assert rows(fine, "g", "mae") == [("ok", 1.0)]


def test_threshold_defaults_to_the_groups_own_quantile(spark):
    df = pairs(spark, [(float(v), float(v + v // 10)) for v in range(1, 101)])
    m = fc.forecast_metrics(df, ["g"], "a", "p", threshold=None).first()
    assert m.peak_period_mae == pytest.approx(sum(v // 10 for v in range(91, 101)) / 10)


def hourly(spark, count, horizon=1):
    return spark.range(count).selectExpr(
        f"{horizon} as horizon_hours", "timestamp'2024-01-01' + make_dt_interval(0, cast(id as int)) as target_timestamp_utc",
        "timestamp'2024-01-01' as feature_as_of_timestamp_utc", "cast(id as double) as target_load_mw",
        "1D as actual_pool_price_cad_mwh", "cast(id - 1 as double) as load_lag_24h",
        "cast(null as double) as load_lag_168h", "cast(id as double) as load_rolling_24h_avg")


def test_splits_cut_at_70_and_85_percent(spark):
    split = fc.time_splits(hourly(spark, 40).unionByName(hourly(spark, 100, 24)))
    counted = {(r.horizon_hours, r.evaluation_split): r["count"] for r in split.groupBy("horizon_hours", "evaluation_split").count().collect()}
    assert counted == {(1, "train"): 28, (1, "validation"): 6, (1, "test"): 6, (24, "train"): 70, (24, "validation"): 15, (24, "test"): 15}


def test_splits_need_thirty_hours(spark):
    with pytest.raises(Exception, match="at least 30"):
        fc.time_splits(hourly(spark, 29)).collect()


def test_forecast_rows_and_own_threshold_when_none_reach_it(spark):
    split = fc.time_splits(hourly(spark, 100))
    made = fc.baseline_forecasts(split, "run")
    assert sorted({r.model_name for r in made.collect()}) == ["baseline_rolling_24h_average", "baseline_same_hour_yesterday"]
    thresholds = split.select("horizon_hours").distinct().withColumn("peak_threshold_mw", F.lit(90.0))
    out = fc.forecast_results(made, thresholds).where("model_name = 'baseline_same_hour_yesterday'")
    test = out.where("evaluation_split = 'test'")
    assert test.where("is_peak_period").count() == 10
    assert rows(test.select("error_mw", "absolute_error_mw").distinct()) == [(-1.0, 1.0)]
    validation = out.where("evaluation_split = 'validation'")
    assert validation.first().peak_threshold_mw == pytest.approx(70 + 14 * 0.9)
    assert validation.where("is_peak_period").count() == 2


def test_zero_actual_has_no_percentage_error(spark):
    made = fc.baseline_forecasts(
        hourly(spark, 1).withColumn("evaluation_split", F.lit("test")).withColumn("load_lag_24h", F.lit(5.0)), "run")
    thresholds = spark.createDataFrame([(1, 0.0)], "horizon_hours int, peak_threshold_mw double")
    got = fc.forecast_results(made, thresholds).where("model_name = 'baseline_same_hour_yesterday'").first()
    assert (got.absolute_error_mw, got.absolute_percentage_error, got.is_peak_period) == (5.0, None, True)
