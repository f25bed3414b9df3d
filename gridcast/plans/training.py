"""One training run: from the training set to the applied registry and the tables that reports read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.contracts import BASELINES, BacktestRules, PromotionRules
from gridcast.plans import backtests, forecasting, governance, trees
from gridcast.session import settle
from gridcast.sources import tables


@dataclass(frozen=True)
class TrainingRun:
    """What a run is called, when it counts as run, and its rules; the same run gives the same tables."""

    run_id: str
    trained_at: Column
    artifacts: str  # a folder that driver and executors share
    windows: BacktestRules = field(default_factory=BacktestRules)
    promotion: PromotionRules = field(default_factory=PromotionRules)
    settings: trees.TreeSettings = field(default_factory=trees.TreeSettings)
    baselines: dict[str, str] = field(default_factory=lambda: dict(BASELINES))


def before_run(registry: DataFrame, decisions: DataFrame | None, run_id: str) -> DataFrame:
    """The registry as it was before `run_id` was stored: without its models, its promotions undone."""
    older = governance.normalize_registry(registry).where(F.col("run_id").isNull() | (F.col("run_id") != run_id))
    if decisions is None:
        return older
    own = decisions.where((F.col("run_id") == run_id) & (F.col("decision") == "promoted") & F.col("previous_champion_model_id").isNotNull())
    held = own.select(F.col("previous_champion_model_id").alias("model_id")).distinct().withColumn("_held", F.lit(True))
    return older.join(held, "model_id", "left").withColumn(
        "is_preferred", F.col("is_preferred") | F.col("_held").isNotNull()).withColumn(
        "retired_at", F.when(F.col("_held").isNull(), F.col("retired_at"))).select(*older.columns)


def train(frame: DataFrame, existing: DataFrame | None, run: TrainingRun) -> dict[str, DataFrame]:
    """All tables of a run over `frame` (a training set): model_registry, forecast_results, model_performance,
    feature_importance, model_backtest_results, model_promotion_decisions.

    `existing` is the registry before the run; its champions are backtested beside the new models and may keep
    their place. The fits of the run are two jobs, one over the horizons and one over all their windows.
    """
    split = settle(forecasting.time_splits(frame))
    specs = {name: {"type": "baseline", "features": [rule], "parameters": {"rule": rule}} for name, rule in run.baselines.items()}
    guessed, nodes = trees.tree_forecasts(split, run.run_id, run.settings)
    simple = forecasting.baseline_forecasts(split, run.run_id, run.baselines)
    forecasts = simple.unionByName(guessed.select(*simple.columns))
    results = settle(forecasting.forecast_results(settle(forecasts), forecasting.peak_thresholds(split)).withColumn("run_id", F.lit(run.run_id)))
    registry = settle(governance.registry_rows(split, specs, run.run_id, run.trained_at).unionByName(
        trees.register_trees(split, nodes, run.run_id, run.trained_at, run.artifacts, run.settings)))

    held = registry if existing is None else governance.append_registry(
        governance.current_champions(governance.normalize_registry(existing)), registry)
    held = settle(held)
    measured = settle(backtests.backtest_baselines(split, held, run.windows, run.run_id, run.trained_at, run.baselines).unionByName(
        trees.backtest_trees(split, run.windows, run.run_id, run.trained_at, registry=held)))
    past = settle(registry.where("false") if existing is None else governance.normalize_registry(existing))
    decisions = settle(governance.decide_promotions(past, registry, measured, run.promotion, run.run_id, run.trained_at))
    return {
        "model_registry": governance.apply_decisions(governance.append_registry(past, registry), decisions, run.trained_at),
        "forecast_results": results,
        "model_performance": forecasting.model_performance(results, run.trained_at).withColumn("run_id", F.lit(run.run_id)),
        "feature_importance": trees.importance_table(
            nodes, registry.where(F.col("model_type") == trees.MODEL_TYPE), run.trained_at, run.settings.features),
        "model_backtest_results": measured,
        "model_promotion_decisions": decisions,
    }


def store_run(frame: DataFrame, layer: str, run: TrainingRun) -> dict[str, DataFrame]:
    """Train on `frame` and store the run in `layer`, which holds the earlier runs: the registry and the tables of the
    latest forecasts are replaced, backtests and decisions are kept by run. The registry is written
    last, and a run that is stored again first takes back what it stored before, so retries give the same tables."""
    spark = frame.sparkSession
    stored = lambda name: tables.read_optional_table(spark, f"{layer}.{name}")
    existing = stored("model_registry")
    if existing is not None:
        existing = settle(before_run(existing, stored("model_promotion_decisions"), run.run_id))
    made = train(frame, existing, run)
    for name in ("forecast_results", "model_performance", "feature_importance"):
        tables.replace_table(made[name], f"{layer}.{name}")
    for name in ("model_backtest_results", "model_promotion_decisions"):
        tables.append_run(made[name], f"{layer}.{name}")
    tables.replace_table(settle(made["model_registry"]), f"{layer}.model_registry")
    return {name: spark.table(f"{layer}.{name}") for name in made}
