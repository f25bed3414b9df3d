"""A whole training run: tables, champions beside new models, and retries that change nothing."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from gridcast.contracts import FEATURES, BacktestRules
from gridcast.plans import training, trees
from gridcast.sources import tables

SETTINGS = trees.TreeSettings(rounds=15, depth=2, step=0.3, features=["hour", "load_lag_24h"])
RULES = BacktestRules(min_train_days=30, max_windows=4)


def frame(spark, days=180, noise=5):
    load = f"cast(id % 24 as double) * 10 + 100 + hash(id) % {noise}"
    own = {"hour": "cast(id % 24 as int)", "load_lag_24h": "cast((id - 24) % 24 as double) * 10 + 100", "load_lag_168h": "if(id < 168, null, 150D)", "load_rolling_24h_avg": "215D"}
    return spark.range(24 * days).selectExpr(
        "24 as horizon_hours", "timestamp'2024-01-01' + make_dt_interval(0, cast(id as int)) as target_timestamp_utc",
        "timestamp'2023-12-31' + make_dt_interval(0, cast(id as int)) as feature_as_of_timestamp_utc", f"{load} as target_load_mw",
        "cast(null as double) as actual_pool_price_cad_mwh", *[f"{own.get(c, 'cast(null as double)')} as {c}" for c in FEATURES])


@pytest.fixture()
def layer(spark, tmp_path):
    name = f"train_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def run(tmp_path, run_id, day, **how):
    return training.TrainingRun(run_id, F.lit(f"2024-08-0{day} 00:00:00").cast("timestamp"), f"{tmp_path}/models", windows=RULES, settings=SETTINGS, **how)


def settled(value):
    """A value but for the last digits of means, whose rows arrive in any order."""
    if isinstance(value, float):
        return round(value, 7) + 0.0
    return re.sub(r"-?\d+\.\d{7,}(e-\d+)?", lambda m: f"{float(m[0]) + 0.0:.6f}", value) if isinstance(value, str) else value


def content(found):
    return {name: sorted((tuple(sorted(((k, settled(v)) for k, v in r.asDict().items()), key=str)) for r in df.collect()), key=str)
            for name, df in found.items()}


def test_runs_and_retries(spark, tmp_path, layer):
    data = frame(spark)
    first = content(training.store_run(data, layer, run(tmp_path, "r1", 1)))
    assert {name: len(rows) for name, rows in first.items()} == {
        "model_registry": 4, "forecast_results": 4 * 1296, "model_performance": 8, "feature_importance": 2,
        "model_backtest_results": 4 * 4, "model_promotion_decisions": 4}
    assert content(training.store_run(data, layer, run(tmp_path, "r1", 1))) == first
    champion = [dict(r) for r in first["model_registry"] if dict(r)["is_preferred"]]
    assert len(champion) == 1
    # a second run: its champion is tested beside the new models; promoted or not, a retry gives the same tables
    second = content(training.store_run(data, layer, run(tmp_path, "r2", 2)))
    tested = {dict(r)["model_id"] for r in second["model_backtest_results"] if dict(r)["run_id"] == "r2"}
    assert champion[0]["model_id"] in tested and len(tested) == 5
    assert sum(dict(r)["is_preferred"] for r in second["model_registry"]) == 1 and len(second["model_registry"]) == 8
    assert content(training.store_run(data, layer, run(tmp_path, "r2", 2))) == second


def test_a_promotion_is_taken_back_before_a_retry(spark, tmp_path, layer):
    poor = run(tmp_path, "r1", 1, baselines={"flat": "load_lag_168h"})
    object.__setattr__(poor, "settings", trees.TreeSettings(rounds=1, depth=1, step=0.01, features=["hour"]))
    training.store_run(frame(spark), layer, poor)
    before = content(training.store_run(frame(spark), layer, run(tmp_path, "r2", 2)))
    decisions = [dict(r) for r in before["model_promotion_decisions"] if dict(r)["run_id"] == "r2"]
    assert any(d["decision"] == "promoted" and d["previous_champion_model_id"] for d in decisions)
    assert content(training.store_run(frame(spark), layer, run(tmp_path, "r2", 2))) == before


def test_append_replaces_its_own_run(spark, layer):
    one = spark.createDataFrame([("a", 1, "r1"), ("b", 2, "r1")], "k string, n int, run_id string")
    assert tables.append_run(one, f"{layer}.runs") and tables.append_run(one.withColumn("run_id", F.lit("r2")), f"{layer}.runs")
    assert tables.append_run(one.where("n = 2").select("run_id", "n", "k"), f"{layer}.runs")
    assert not tables.append_run(one.where("false"), f"{layer}.runs")
    assert sorted(map(tuple, spark.table(f"{layer}.runs").select("k", "n", "run_id").collect())) == [("a", 1, "r2"), ("b", 2, "r1"), ("b", 2, "r2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
