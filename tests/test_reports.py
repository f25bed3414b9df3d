from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.plans import quality, reports
from tests.conftest import rows


def test_feature_groups(spark):
    df = spark.createDataFrame([("load_lag_168h", 0.5), ("is_stat_holiday", 0.3), ("hour", 0.2), (None, 0.1)], "feature_name string, importance double")
    assert rows(reports.tagged_features(df), "feature_group") == [("Holiday / calendar",), ("Other",), ("Other",), ("Weekly baseline",)]
    assert rows(reports.tagged_features(df.drop("feature_name")).select("feature_group").distinct()) == [("Other",)]


def test_holiday_errors_from_stored_errors(spark):
    df = spark.createDataFrame(
        [(1, "m", "test", 10.0, True), (1, "m", "test", 30.0, False), (1, "m", "test", 20.0, False), (1, "m", "test", None, False)],
        "horizon_hours int, model_name string, evaluation_split string, absolute_error_mw double, is_stat_holiday boolean")
    assert rows(reports.holiday_errors(df), "holiday_group", "mae", "row_count") == [("Holiday", 10.0, 1), ("Non-holiday", 25.0, 2)]


def test_holiday_errors_from_loads_with_partial_keys(spark):
    df = spark.createDataFrame([(100.0, 90.0, "yes"), (100.0, 130.0, "no")], "target_load_mw double, predicted_load_mw double, is_holiday string")
    assert rows(reports.holiday_errors(df)) == [(None, None, None, "Holiday", 10.0, 1), (None, None, None, "Non-holiday", 30.0, 1)]
    assert reports.holiday_errors(df.drop("predicted_load_mw")) is None
    assert reports.holiday_errors(df.drop("is_holiday")) is None


def test_holiday_errors_join_falls_back_to_horizon_and_target(spark):
    made = spark.createDataFrame([(1, "a", 5.0), (1, "b", 7.0)], "horizon_hours int, target_timestamp_utc string, absolute_error_mw double")
    flags = spark.createDataFrame([(1, "a", "x", True), (1, "b", "x", False)], "horizon_hours int, target_timestamp_utc string, feature_as_of_timestamp_utc string, is_long_weekend boolean")
    assert rows(reports.holiday_errors(made, flags), "holiday_group", "mae") == [("Holiday", 5.0), ("Non-holiday", 7.0)]


def test_runs_newest_first(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01"), ("b", None), ("c", None), (None, "2025-01-01")], "run_id string, evaluated_at string")
    assert [r.run_id for r in reports.latest_runs(df).collect()] == ["b", "a", "c"]
    assert [r.run_id for r in reports.latest_runs(df.drop("evaluated_at")).collect()] == ["c", "b", "a"]


def test_champion_date_falls_back(spark):
    df = spark.createDataFrame([("m", None, "2024-03-01"), ("n", None, "2024-02-01")], "model_name string, preferred_at string, trained_at string")
    assert [str(v) for v in reports.champion_kpis(df).first()] == ["2", "2", "2024-03-01"]


def test_slices_filter_only_what_is_given(spark):
    df = spark.createDataFrame([(1, "a"), (24, "a"), (24, "b")], "horizon_hours int, model_name string")
    assert reports.sliced(df).count() == 3
    assert reports.sliced(df, horizon_hours=24, model_name=None, absent=1).count() == 2
    assert reports.sliced(df, horizon_hours=[1, 24], model_name="a").count() == 2


def test_histogram_keeps_every_row_and_the_top_edge(spark):
    df = spark.range(101).selectExpr("1 as horizon_hours", "'m' as model_name", "'test' as evaluation_split", "cast(id as double) as error_mw")
    got = reports.residual_histogram(df, 10).orderBy("bin").collect()
    assert [(r.bin, r.row_count) for r in got] == [(i, 10) for i in range(9)] + [(9, 11)]


def test_accuracy_metrics_in_order(spark):
    assert reports.accuracy_metrics(spark.createDataFrame([(1, 1)], "mape int, mae int")) == ["mae", "mape"]


def test_violations_are_found(spark):
    df = spark.createDataFrame([(1, "2024-01-02", "2024-01-01"), (2, "2024-01-01", "2024-01-01")], "horizon_hours int, feature_max_source_timestamp_utc string, feature_as_of_timestamp_utc string")
    assert rows(quality.future_leakage(df), "horizon_hours") == [(1,)]
    assert rows(quality.absent_horizons(df, [1, 24])) == [(24,)]
    counted = quality.null_and_duplicate_counts("t", spark.createDataFrame([(1,), (1,), (None,)], "c int"), ["c"], ["c"])
    assert rows(counted) == [("t", "c", "not_null", 1), ("t", "c", "unique", 1)]


def test_rules_of_many_tables_share_one_shuffle(spark):
    first = spark.createDataFrame(
        [(1, 0.0, "x", b"a", [1]), (1, -0.0, "x", b"a", [1]), (2, float("nan"), None, b"b", [None]), (None, float("nan"), "", None, [])],
        "i int, d double, s string, b binary, a array<int>")
    second = spark.range(1000).selectExpr("if(id < 400, 0, id) as i", "timestamp'2024-01-01' + make_dt_interval(0, cast(id div 2 as int)) as t")
    unique = ["i", "d", "s", "b", "a"]
    tables = {"first": (first, ["i", "s"], unique), "second": (second, ["t"], ["i", "t"]), "empty": (second.limit(0), ["i"], ["i"])}
    checked = quality.rule_violations(tables)
    expected = []
    for name, (df, not_null, distinct) in tables.items():
        expected += [(name, c, "not_null", df.where(F.col(c).isNull()).count()) for c in not_null]
        expected += [(name, c, "unique", df.agg((F.count(c) - F.count_distinct(c)).alias("n")).first()["n"]) for c in distinct]
    assert sorted(rows(checked)) == sorted(expected)
    only = quality.rule_violations({"second": (second, ["t"], ["i", "t"])})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in only and only.count("Exchange hashpartitioning") == 1


def test_raw_quality_counts_all_tables_in_one_shuffle(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "2024-01-05", 1), ("2024-01-01", "2024-01-06", None), (None, "2024-01-07", 3)],
        "interval_start_utc string, ingested_at string, v int")
    got = reports.raw_quality({"a": (df, "v"), "none": (df.limit(0), "v")})
    assert sorted(rows(got)) == [
        ("a", 3, "2024-01-01", "2024-01-01", "2024-01-07", 1, 2), ("none", 0, None, None, None, 0, 0)]
    plan = reports.raw_quality({"a": (df, "v")})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
