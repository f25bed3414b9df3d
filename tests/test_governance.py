from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridcast.contracts import PromotionRules
from gridcast.plans import governance as gov
from tests.conftest import rows
from tests.test_backtests import metric_rows

NOW = "2024-05-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def registry(spark, *models):
    """(id, preferred) pairs as registry rows of horizon 1."""
    return spark.createDataFrame(
        [(m, f"{m}_model", 1, "baseline", "2024-01-01 00:00:00", p, "2024-04-01 00:00:00" if p else None) for m, p in models],
        "model_id string, model_name string, horizon_hours int, model_type string, trained_at string, is_preferred boolean, preferred_at string")


def decide(spark, existing, candidates, values, rules=PromotionRules(), peak=None, under=None):
    results = metric_rows(spark, values)
    for column, changes in (("peak_period_mae", peak or {}), ("underprediction_rate", under or {})):
        for model, value in changes.items():
            results = results.withColumn(column, F.when(F.col("model_id") == model, value).otherwise(F.col(column)))
    return gov.decide_promotions(existing, candidates, results, rules, "run-1", now())


def test_better_challenger_is_promoted_and_champion_retires(spark):
    existing, candidates = registry(spark, ("champion", True)), registry(spark, ("challenger", False))
    decisions = decide(spark, existing, candidates, {"champion": [100.0, 110.0, 120.0], "challenger": [90.0, 105.0, 119.0]}).cache()
    row = decisions.first()
    assert (row.decision, row.promoted_model_id, row.reason, row.win_count, row.win_rate) == (
        "promoted", "challenger", "challenger passed promotion rules", 3, 1.0)
    after = gov.apply_decisions(gov.append_registry(existing, candidates), decisions, now())
    state = {r.model_id: (r.is_preferred, r.preferred_at, r.retired_at, r.promotion_decision_id) for r in after.collect()}
    moment = datetime(2024, 5, 1)
    assert state["challenger"] == (True, moment, None, row.decision_id)
    assert state["champion"] == (False, datetime(2024, 4, 1), moment, None)


def test_peak_regression_rejects(spark):
    got = decide(spark, registry(spark, ("champion", True)), registry(spark, ("rival", False)),
                 {"champion": [100.0] * 3, "rival": [90.0] * 3}, peak={"rival": 130.0}).first()
    assert got.decision == "rejected" and got.reason == "peak-period MAE regression exceeded tolerance (130.000000 > 105.000000)"


def test_all_broken_rules_are_listed(spark):
    got = decide(spark, registry(spark, ("champion", True)), registry(spark, ("rival", False)),
                 {"champion": [100.0] * 4, "rival": [110.0, 110.0, 110.0, 100.0]}, peak={"rival": 200.0}, under={"rival": 0.5}).first()
    assert got.reason.split("; ") == [
        "average mae did not improve enough (107.500000 vs 100.000000)", "won or tied 1 windows", "2 required",
        "peak-period MAE regression exceeded tolerance (200.000000 > 105.000000)",
        "underprediction-rate regression exceeded tolerance (0.500000 > 0.220000)"]
    assert (got.valid_window_count, got.required_window_count) == (4, 2)


def test_too_few_windows_change_nothing(spark):
    existing, candidates = registry(spark, ("champion", True)), registry(spark, ("rival", False), ("absent", False))
    decisions = decide(spark, existing, candidates, {"champion": [100.0] * 2, "rival": [80.0] * 2})
    assert rows(decisions, "challenger_model_id", "decision", "reason", "win_count", "required_window_count") == [
        ("absent", "rejected", "only 0 comparable backtest windows; 3 required", 0, 3),
        ("rival", "rejected", "only 2 comparable backtest windows; 3 required", 0, 3)]
    after = gov.apply_decisions(gov.append_registry(existing, candidates), decisions, now())
    assert rows(after, "model_id", "is_preferred") == [("absent", False), ("champion", True), ("rival", False)]


def test_no_windows_needed_but_none_shared(spark):
    got = decide(spark, registry(spark, ("champion", True)), registry(spark, ("rival", False)), {"other": [1.0]},
                 PromotionRules(minimum_valid_windows=0)).first()
    assert got.reason == "mae comparison is unavailable"


def test_first_champion_is_the_best_of_those_with_enough_windows(spark):
    candidates = registry(spark, ("a", False), ("b", False), ("c", False))
    got = decide(spark, registry(spark, ("old", False)), candidates, {"a": [10.0] * 3, "b": [9.0] * 3, "c": [1.0] * 2})
    assert rows(got, "challenger_model_id", "decision", "reason", "win_count") == [
        ("a", "rejected", "initial champion bootstrap selected another challenger", None),
        ("b", "promoted", "no existing champion; selected as initial champion after backtests", None),
        ("c", "rejected", "only 2 backtest windows; 3 required", None)]


def test_only_the_best_passing_challenger_wins(spark):
    got = decide(spark, registry(spark, ("champion", True)), registry(spark, ("a", False), ("b", False)),
                 {"champion": [100.0] * 3, "a": [80.0] * 3, "b": [70.0] * 3})
    assert rows(got, "challenger_model_id", "decision", "reason") == [
        ("a", "rejected", "passed rules but another challenger had better average mae"),
        ("b", "promoted", "challenger passed promotion rules")]


def test_decision_documents_are_json_with_sorted_keys(spark):
    row = decide(spark, registry(spark, ("x", False)), registry(spark, ("a", False)), {"a": [1.0] * 3}).first()
    rules, detail = json.loads(row.rules), json.loads(row.comparison_details)
    assert list(rules) == sorted(rules) and rules["minimum_win_rate"] == 0.5
    assert list(detail) == sorted(detail) and len(detail) == 20
    assert detail["champion_average_mae"] is None and detail["challenger_average_mae"] == 1.0 and detail["passed"] is True


def test_champions_by_time_then_id_nulls_first(spark):
    df = spark.createDataFrame(
        [("old-h1", 1, "true", "2024-01-01"), ("new-h1", 1, " Yes ", "2024-02-01"), ("none-h1", 1, "t", None),
         ("h24", 24, "1", None), ("no", 24, "no", "2024-03-01")],
        "model_id string, horizon_hours int, is_preferred string, preferred_at string")
    assert rows(gov.current_champions(df), "horizon_hours", "model_id") == [(1, "new-h1"), (24, "h24")]
    assert gov.current_champions(df.drop("is_preferred")).count() == 0
    assert rows(gov.current_champions(df.drop("horizon_hours")), "model_id") == [("new-h1",)]


def test_registry_gains_governance_columns(spark):
    got = gov.normalize_registry(spark.createDataFrame([("m", "2024-01-01", "x")], "model_id string, trained_at string, retired_at string"))
    assert set(gov.GOVERNANCE_COLUMNS) < set(got.columns)
    row = got.first()
    assert (row.is_preferred, row.trained_at, row.retired_at, row.run_id) == (False, datetime(2024, 1, 1), None, None)


def test_rules_are_checked():
    with pytest.raises(ValueError):
        PromotionRules(primary_metric="mape")


def test_two_promotions_of_a_horizon_apply_in_order(spark):
    whole = registry(spark, ("champion", True), ("first", False), ("second", False))
    decisions = spark.createDataFrame(
        [("d1", 1, "promoted", "first", "2024-04-20 00:00:00"), ("d2", 1, "promoted", "second", "2024-04-21 00:00:00"),
         ("d3", 1, "rejected", None, "2024-04-22 00:00:00"), ("d0", 1, "promoted", "second", "2024-04-01 00:00:00")],
        "decision_id string, horizon_hours int, decision string, promoted_model_id string, evaluated_at string")
    got = gov.apply_decisions(whole, decisions, now())
    moment = datetime(2024, 5, 1)
    assert {r.model_id: (r.is_preferred, r.retired_at, r.promotion_decision_id) for r in got.collect()} == {
        "champion": (False, moment, None), "first": (False, moment, "d1"), "second": (True, None, "d2")}
    assert got.count() == 3


def test_candidates_without_a_horizon_get_no_decision(spark):
    candidates = registry(spark, ("rival", False), ("lost", False)).withColumn(
        "horizon_hours", F.when(F.col("model_id") == "rival", F.col("horizon_hours")))
    got = decide(spark, registry(spark, ("champion", True)), candidates, {"champion": [100.0] * 3, "rival": [90.0] * 3, "lost": [1.0] * 3})
    assert [r.challenger_model_id for r in got.collect()] == ["rival"]
