from __future__ import annotations

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.contracts import BacktestRules
from gridcast.plans import trees
from gridcast.plans.forecasting import time_splits

SETTINGS = trees.TreeSettings(rounds=20, depth=3, step=0.3, features=["hour", "lag", "absent"])


def nowhen():
    return F.lit(None).cast("timestamp")


def frame(spark, hours=200):
    return spark.range(hours).selectExpr(
        "24 as horizon_hours", "timestamp'2024-01-01' + make_dt_interval(0, cast(id as int)) as target_timestamp_utc",
        "cast(id % 24 as int) as hour", "if(id % 9 = 0, double('NaN'), if(id % 7 = 0, null, cast(id % 24 as double) * 10)) as lag",
        "cast(null as double) as absent", "cast(id % 24 as double) * 10 + 100 as target_load_mw")


def plain_boost(x, y, rounds, depth, step):
    """Trees by trying every split of every node, rows in Python lists: the forecasts of the rows."""
    forecast = [sum(y) / len(y)] * len(y)

    def grow(rows, left_depth):
        gradient = lambda some: sum(forecast[i] - y[i] for i in some)
        gain_of = lambda some: gradient(some) ** 2 / (len(some) + trees.SHRINK)
        best = (1e-9, None)
        for unknown in (1, 0) if left_depth else ():
            for j in range(len(x[0])):
                for t in sorted({x[i][j] for i in range(len(x)) if not math.isnan(x[i][j])}):
                    left = [i for i in rows if (not unknown if math.isnan(x[i][j]) else x[i][j] <= t)]
                    right = [i for i in rows if i not in set(left)]
                    if left and right:
                        gain = gain_of(left) + gain_of(right) - gain_of(rows)
                        if gain > best[0] + 1e-7:
                            best = (gain, (left, right))
        if best[1] is None:
            value = -step * gradient(rows) / (len(rows) + trees.SHRINK)
            return [(i, value) for i in rows]
        return grow(best[1][0], left_depth - 1) + grow(best[1][1], left_depth - 1)

    for _ in range(rounds):
        for i, value in grow(list(range(len(y))), depth):
            forecast[i] += value
    return forecast


def walked(nodes, row):
    """The forecast of one row by following rows of the table of nodes."""
    by = {(n["tree"], n["node"]): n for n in nodes}
    total = 0.0
    for tree in {n["tree"] for n in nodes}:
        n = by[tree, 0]
        while n["left"] is not None:
            v = row.get(n["feature"])
            right = n["unknown_right"] if v is None or math.isnan(v) else v > n["threshold"]
            n = by[tree, n["right"] if right else n["left"]]
        total += n["value"]
    return total


def test_boosting_equals_exhaustive_search():
    draw = random.Random(3)
    x = [[draw.choice([draw.randrange(8), draw.random(), math.nan]) * 1.0 for _ in range(3)] for _ in range(40)]
    y = [10 * (0 if math.isnan(r[0]) else r[0] > 0.5) + draw.gauss(0, 1) for r in x]
    own = trees.TreeSettings(rounds=6, depth=3, step=0.3, row_share=1.1, column_share=1.0, features=["a", "b", "c"])
    found = trees.boost(np.array(x), np.array(y), np.arange(40), own)
    names = ["tree", "node", "level", "feature", "threshold", "unknown_right", "left", "right", "value", "gain", "row_count"]
    nodes = [dict(zip(names, (*n[:3], None if n[3] is None else own.features[n[3]], *n[4:]))) for n in found]
    got = [walked(nodes, dict(zip(own.features, r))) for r in x]
    assert got == pytest.approx(plain_boost(x, y, 6, 3, 0.3))
    assert all(n["row_count"] == sum(c["row_count"] for c in nodes if c["tree"] == n["tree"] and c["node"] in (n["left"], n["right"]))
               for n in nodes if n["left"] is not None)


def test_bins_are_exact_quantiles_and_unknown_is_apart():
    x = np.concatenate([np.arange(1000.0), [np.nan, np.inf]])[:, None]
    bins, (bounds,) = trees.binned(x)
    assert (bins[1000:] == trees.UNKNOWN).all() and bins[:1000].max() == trees.BINS - 1
    assert set(np.bincount(bins[:1000, 0])) <= {15, 16} and (np.diff(bounds) > 0).all()
    few, (own,) = trees.binned(np.array([[3.0], [1.0], [np.nan], [3.0]]))
    assert few[:, 0].tolist() == [1, 0, trees.UNKNOWN, 1] and own.tolist() == [1.0]


def test_rows_are_drawn_by_hash():
    y = np.random.default_rng(1).normal(size=300)
    x, at = np.random.default_rng(2).normal(size=(300, 10)), np.arange(300) * 3600
    own = trees.TreeSettings(rounds=30, features=[str(i) for i in range(10)])
    turned = np.random.default_rng(3).permutation(300)
    first = trees.boost(x, y, at, own)
    assert first == trees.boost(x[turned], y[turned], at[turned], own)
    roots = [n[-1] for n in first if n[1] == 0 and n[0]]
    assert 240 < sum(roots) / len(roots) < 300 and len(set(roots)) > 5


def test_trees_learn_with_nan_null_and_empty_features(spark):
    predictions, nodes = trees.tree_forecasts(time_splits(frame(spark)), "run", SETTINGS)
    assert predictions.count() == 60
    errors = predictions.select(F.avg(F.abs(F.col("predicted_load_mw") - F.col("target_load_mw")))).first()[0]
    assert errors < 10
    assert {r.evaluation_split for r in predictions.collect()} == {"validation", "test"}
    models = trees.tree_models(frame(spark), "run", SETTINGS)
    importances = {r.feature_name: r.importance for r in trees.importance_table(nodes, models, nowhen(), SETTINGS.features).collect()}
    assert set(importances) == {"hour", "lag", "absent"} and sum(importances.values()) == pytest.approx(1.0)
    assert importances["hour"] > importances["lag"] > importances["absent"] == 0


def test_scores_follow_the_nodes(spark):
    split = time_splits(frame(spark))
    predictions, nodes = trees.tree_forecasts(split, "run", SETTINGS)
    table = [n.asDict() for n in nodes.collect()]
    for row in predictions.collect():
        assert row.predicted_load_mw == pytest.approx(walked(table, {"hour": row.hour * 1.0, "lag": row.lag, "absent": None}))


def test_fits_of_one_job_equal_single_fits(spark):
    """All windows together against the plain fit of each window's rows."""
    long = frame(spark, 24 * 120).withColumn("target_load_mw", F.col("target_load_mw") + F.expr("month(target_timestamp_utc) * 7 + hash(target_timestamp_utc) % 5"))
    rules = BacktestRules(min_train_days=30, max_windows=2)
    got = sorted(trees.backtest_trees(long, rules, "run", nowhen(), SETTINGS).collect(), key=lambda r: r.window_id)
    rows = [r.asDict() for r in long.collect()]
    assert len(got) == 2
    for r in got:
        picked = [x for x in rows if r.train_start_timestamp_utc <= x["target_timestamp_utc"] <= r.train_end_timestamp_utc]
        matrix = np.array([[math.nan if x[c] is None else float(x[c]) for c in SETTINGS.features] for x in picked])
        at = np.array([int(x["target_timestamp_utc"].timestamp() * 1_000_000) for x in picked])
        found = trees.boost(matrix, np.array([x["target_load_mw"] for x in picked], float), at, SETTINGS)
        names = ["tree", "node", "level", "feature", "threshold", "unknown_right", "left", "right", "value", "gain", "row_count"]
        nodes = [dict(zip(names, (*n[:3], None if n[3] is None else SETTINGS.features[n[3]], *n[4:]))) for n in found]
        tested = [x for x in rows if r.test_start_timestamp_utc <= x["target_timestamp_utc"] <= r.test_end_timestamp_utc]
        errors = [abs(walked(nodes, {c: x[c] for c in SETTINGS.features}) - x["target_load_mw"]) for x in tested]
        assert r.mae == pytest.approx(sum(errors) / len(errors)) and r.prediction_row_count == r.test_row_count == len(tested)


def test_default_size():
    # fixed values
    assert trees.TreeSettings().parameters() == {
        "n_estimators": 300, "max_depth": 4, "learning_rate": 0.05, "subsample": 0.9, "colsample_bytree": 0.9, "random_state": 42}
    assert len(trees.TreeSettings().features) == 47


def test_saved_and_refitted_from_the_registry(spark, tmp_path):
    long = frame(spark, 24 * 120)
    split = time_splits(long)
    predictions, nodes = trees.tree_forecasts(split, "run", SETTINGS)
    for _ in range(2):  # a retried run replaces its own parts
        registry = trees.register_trees(split, nodes, "run", nowhen(), str(tmp_path), SETTINGS)
    row = registry.first()
    assert row.model_type == "gbt" and trees.TreeSettings.registered(row.feature_names, row.parameters) == SETTINGS
    saved = trees.saved_trees(spark, registry)
    assert saved.count() == nodes.count()
    again = trees.predict(split.where("evaluation_split = 'test'"), registry, saved, SETTINGS.features)
    key = lambda df: sorted((r.target_timestamp_utc, r.predicted_load_mw) for r in df.collect())
    assert key(again) == key(predictions.where("evaluation_split = 'test'"))
    assert trees.saved_trees(spark, registry.withColumn("artifact_path", F.lit(None).cast("string"))).count() == 0
    older = registry.withColumn("model_id", F.lit("older")).withColumn("model_name", F.lit("small_trees")).withColumn(
        "parameters", F.lit('{"n_estimators": 2, "max_depth": 1}')).withColumn("feature_names", F.lit('["hour"]'))
    lost = older.withColumn("model_id", F.lit("lost")).withColumn("feature_names", F.lit('["no_such_feature"]'))
    rules = BacktestRules(min_train_days=30, max_windows=2)
    got = trees.backtest_trees(long, rules, "next", nowhen(), registry=registry.unionByName(older).unionByName(lost)).collect()
    assert {(r.model_id, r.model_name) for r in got} == {(row.model_id, trees.MODEL_NAME), ("older", "small_trees")}
    assert len(got) == 4 and len({(r.model_name, r.mae) for r in got}) == 4


def test_registered_settings():
    assert trees.TreeSettings.registered(None, None) == trees.TreeSettings()
    own = trees.TreeSettings.registered('["hour"]', json.dumps({"n_estimators": 5.0, "objective": "x", "max_depth": None}))
    assert own.rounds == 5 and own.depth == 4 and own.features == ["hour"]


def test_no_rows(spark):
    empty = frame(spark, 0)
    assert trees.backtest_trees(empty, BacktestRules(), "run", nowhen(), SETTINGS).count() == 0
