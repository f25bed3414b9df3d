"""Champions, challenger comparison, promotion decisions and the model registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.contracts import METRICS, PromotionRules
from gridcast.functions.coerce import TRUE_WORDS, finite_or_null, truthy
from gridcast.functions.documents import object_text
from gridcast.plans.backtests import candidate_summary

_H = "horizon_hours"
# fixed values: governance columns a registry may lack, with their types
GOVERNANCE_COLUMNS = {
    "run_id": "string", "is_preferred": "boolean", "preferred_at": "timestamp",
    "retired_at": "timestamp", "promotion_decision_id": "string",
}
_TIMES = ["trained_at", "preferred_at", "retired_at"]


def normalize_registry(registry: DataFrame) -> DataFrame:
    """Registry with all governance columns, boolean flags and real timestamps."""
    absent = [f"cast(null as {kind}) as {name}" for name, kind in GOVERNANCE_COLUMNS.items() if name not in registry.columns]
    result = registry.selectExpr("*", *absent).withColumn("is_preferred", truthy("is_preferred"))
    for name in _TIMES:
        if name in result.columns:
            result = result.withColumn(name, F.col(name).try_cast("timestamp"))
    return result


def current_champions(
    registry: DataFrame, order: list[str] = ("preferred_at", "trained_at", "model_id"), words: list[str] = TRUE_WORDS
) -> DataFrame:
    """Per horizon the preferred model that comes last by `order`, nulls first.

    Columns of `order` that the registry lacks are skipped; without a horizon
    column there is one champion overall; without a preferred flag there is none.
    """
    if "is_preferred" not in registry.columns:
        return registry.where("false")
    known = [c for c in order if c in registry.columns]
    preferred = registry.where(truthy("is_preferred", words)).withColumn("is_preferred", F.lit(True))
    for column in known:
        if column != "model_id":
            preferred = preferred.withColumn(column, F.col(column).try_cast("timestamp"))
    keys = [_H] if _H in registry.columns else []
    last = Window.partitionBy(*keys).orderBy(*([F.col(c).desc_nulls_last() for c in known] or [F.lit(1)]))
    return preferred.withColumn("_last", F.row_number().over(last)).where("_last = 1").drop("_last")


def compare_challengers(
    champions: DataFrame, candidates: DataFrame, results: DataFrame, rules: PromotionRules
) -> DataFrame:
    """Every candidate of a horizon with a champion, measured on the windows both have.

    One equi join on (horizon, window) serves all challengers at once. The
    champion side holds one model per horizon; Spark measures it at run time and
    splits skewed windows otherwise.
    """
    numbers = [finite_or_null(m).alias(m) if m in results.columns else F.lit(None).cast("double").alias(m) for m in METRICS]
    measured = results.select("model_id", "window_id", *numbers)
    champion = champions.selectExpr(f"{_H}", "model_id as champion_model_id", "model_name as champion_model_name")
    holder = champion.join(measured, champion["champion_model_id"] == measured["model_id"]).select(
        _H, "window_id", *[F.col(m).alias(f"champion_{m}") for m in METRICS]
    ).where(f"champion_{rules.primary_metric} is not null")
    rivals = candidates.select("model_id", "model_name", _H)
    rounds = (
        rivals.join(measured, "model_id").where(f"{rules.primary_metric} is not null")
        .join(holder, [_H, "window_id"])
    )
    primary = rules.primary_metric
    tallies = rounds.groupBy(_H, "model_id").agg(
        F.count(F.lit(1)).alias("valid_window_count"),
        F.count_if(F.col(primary) <= F.col(f"champion_{primary}")).alias("_wins"),
        *[F.avg(f"champion_{m}").alias(f"champion_average_{m}") for m in METRICS],
        *[F.avg(m).alias(f"challenger_average_{m}") for m in METRICS],
    )
    return _judged(rivals.join(champion, _H).join(tallies, [_H, "model_id"], "left"), rules)


def _judged(rows: DataFrame, rules: PromotionRules) -> DataFrame:
    """Apply the promotion rules; the reasons of all broken rules are joined with '; '."""
    p, least = rules.primary_metric, rules.minimum_valid_windows
    rows = rows.withColumn("valid_window_count", F.expr("coalesce(valid_window_count, 0)")).withColumn(
        "_enough", F.expr(f"valid_window_count >= {least}")
    )
    ours, theirs = f"challenger_average_{p}", f"champion_average_{p}"
    peak, peak_limit = "challenger_average_peak_period_mae", f"champion_average_peak_period_mae * {1 + rules.max_peak_mae_regression!r}D"
    under = "challenger_average_underprediction_rate"
    under_limit = f"(champion_average_underprediction_rate + {rules.max_underprediction_rate_regression!r}D)"
    needed = f"cast(ceil(valid_window_count * {rules.minimum_win_rate!r}D) as bigint)"
    # fixed values: the texts of the reasons
    broken = [
        f"case when not _enough then format_string('only %d comparable backtest windows; {least} required', valid_window_count) end",
        f"case when _enough and ({ours} is null or {theirs} is null) then '{p} comparison is unavailable' end",
        f"""case when _enough and {ours} >= {theirs} - abs({theirs}) * {rules.minimum_relative_improvement!r}D
            then format_string('average {p} did not improve enough (%.6f vs %.6f)', {ours}, {theirs}) end""",
        f"case when _enough and _wins < {needed} then format_string('won or tied %d windows; %d required', _wins, {needed}) end",
        f"""case when _enough and {peak} > {peak_limit}
            then format_string('peak-period MAE regression exceeded tolerance (%.6f > %.6f)', {peak}, {peak_limit}) end""",
        f"""case when _enough and {under} > {under_limit}
            then format_string('underprediction-rate regression exceeded tolerance (%.6f > %.6f)', {under}, {under_limit}) end""",
    ]
    return (
        rows.withColumn("_wins", F.expr("coalesce(_wins, 0)"))
        .withColumn("_broken", F.expr(f"concat_ws('; ', {', '.join(broken)})"))
        .selectExpr(
            _H, "champion_model_id", "champion_model_name", "model_id", "model_name", "valid_window_count",
            f"if(_enough, {needed}, {least}) as required_window_count",
            "if(_enough, _wins, 0) as win_count",
            "if(_enough and valid_window_count > 0, _wins / valid_window_count, 0D) as win_rate",
            *[f"{side}_average_{m}" for side in ("champion", "challenger") for m in METRICS],
            "_broken = '' as passed",
            "if(_broken = '', 'passed all promotion rules', _broken) as reason",
        )
    )


def _bootstrap(candidates: DataFrame, champions: DataFrame, results: DataFrame, rules: PromotionRules) -> DataFrame:
    """Candidates of horizons without a champion, measured on their own windows."""
    alone = candidates.join(champions.select(_H), _H, "left_anti").select("model_id", "model_name", _H)
    summary = candidate_summary(results, rules.primary_metric)
    least = rules.minimum_valid_windows
    return alone.join(summary, "model_id", "left").withColumn(
        "valid_window_count", F.expr("coalesce(valid_window_count, 0)")
    ).selectExpr(
        _H, "cast(null as string) as champion_model_id", "cast(null as string) as champion_model_name",
        "model_id", "model_name", "valid_window_count", f"cast({least} as bigint) as required_window_count",
        "cast(null as bigint) as win_count", "cast(null as double) as win_rate",
        *[f"cast(null as double) as champion_average_{m}" for m in METRICS],
        *[f"average_{m} as challenger_average_{m}" for m in METRICS],
        f"valid_window_count >= {least} as passed",
        f"""if(valid_window_count >= {least}, 'eligible for initial champion bootstrap',
            format_string('only %d backtest windows; {least} required', valid_window_count)) as reason""",
    )


def decide_promotions(
    existing: DataFrame, candidates: DataFrame, results: DataFrame, rules: PromotionRules, run_id: str, evaluated_at: Column
) -> DataFrame:
    """One decision row per candidate; at most one promotion per horizon.

    A candidate without a horizon can neither win nor lose one and gets no decision.
    The best passing candidate is found with a minimum per horizon, combined
    before the shuffle, so a horizon with very many candidates is never sorted
    in one place.
    """
    champions = current_champions(normalize_registry(existing))
    candidates = candidates.where(F.col(_H).isNotNull())
    judged = compare_challengers(champions, candidates, results, rules).unionByName(
        _bootstrap(candidates, champions, results, rules)
    )
    # struct order: null last, then the value, for primary metric and rmse, then name and id
    better = F.struct(*[
        part
        for metric in (rules.primary_metric, "rmse")
        for part in (F.col(f"challenger_average_{metric}").isNull(), F.col(f"challenger_average_{metric}"))
    ], "model_name", "model_id")
    best = judged.where("passed").groupBy(_H).agg(F.min(better)["model_id"].alias("_best"))
    chosen = "passed and model_id = _best"
    # fixed values: the texts of the reasons
    reason = f"""case
        when not passed then reason
        when champion_model_id is null and {chosen} then 'no existing champion; selected as initial champion after backtests'
        when champion_model_id is null then 'initial champion bootstrap selected another challenger'
        when {chosen} then 'challenger passed promotion rules'
        else 'passed rules but another challenger had better average {rules.primary_metric}' end"""
    decided = judged.join(best, _H, "left").selectExpr(
        "*", f"{reason} as _reason", f"coalesce({chosen}, false) as _chosen"
    ).drop("reason").withColumnRenamed("_reason", "reason")

    averages = [f"{side}_average_{m}" for side in ("champion", "challenger") for m in METRICS]
    detail = ["valid_window_count", "required_window_count", "win_count", "win_rate", *averages, "passed", "reason"]
    settings = object_text({k: F.lit(v) for k, v in rules.settings().items()})
    return decided.select(
        F.md5(F.concat_ws(":", F.lit(run_id), F.col(_H).cast("string"), "model_id")).alias("decision_id"),
        F.lit(run_id).alias("run_id"),
        _H, "champion_model_id", "champion_model_name",
        F.col("model_id").alias("challenger_model_id"), F.col("model_name").alias("challenger_model_name"),
        F.when(F.col("_chosen"), F.col("model_id")).alias("promoted_model_id"),
        F.col("champion_model_id").alias("previous_champion_model_id"),
        F.when(F.col("_chosen"), "promoted").otherwise("rejected").alias("decision"),
        "reason", "valid_window_count", "required_window_count", "win_count", "win_rate",
        *[f"{side}_average_{m}" for m in ("mae", "rmse", "peak_period_mae", "underprediction_rate")
          for side in ("champion", "challenger")],
        settings.alias("rules"),
        object_text({name: F.col(name) for name in detail}, floats=[*averages, "win_rate"]).alias("comparison_details"),
        evaluated_at.alias("evaluated_at"),
    )


def apply_decisions(registry: DataFrame, decisions: DataFrame, decided_at: Column) -> DataFrame:
    """Registry after the promotions: the new champion is marked, others of its horizon retire.

    Promotions take effect in the order of evaluated_at, then decision_id. Of several
    of one horizon the last one stands; a model promoted before it keeps its own
    decision and retires. Each side of the joins has one row per horizon or model.
    """
    current = normalize_registry(registry)
    promoted = decisions.where(f"decision = 'promoted' and promoted_model_id is not null and {_H} is not null")
    last = F.max(F.struct("evaluated_at", "decision_id", "promoted_model_id"))
    horizons = promoted.groupBy(_H).agg(last["promoted_model_id"].alias("_winner"))
    standing = horizons.select(F.col("_winner").alias("model_id")).distinct().withColumn("_stands", F.lit(True))
    own = promoted.groupBy(F.col("promoted_model_id").alias("model_id")).agg(last["decision_id"].alias("_decision"))
    joined = (
        current.join(horizons, _H, "left").join(own.join(standing, "model_id", "left"), "model_id", "left")
        .withColumn("_now", decided_at)
    )
    won = "_decision is not null"
    stands = f"({won} and _stands is not null)"
    retires = f"not {stands} and ({won} or (_winner is not null and is_preferred))"
    changed = {
        "is_preferred": f"case when {stands} then true when {retires} then false else is_preferred end",
        "preferred_at": f"case when {won} then _now else preferred_at end",
        "retired_at": f"case when {stands} then null when {retires} then _now else retired_at end",
        "promotion_decision_id": "coalesce(_decision, promotion_decision_id)",
    }
    return joined.selectExpr(*[f"{changed[c]} as {c}" if c in changed else c for c in current.columns])


def append_registry(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old and new registry rows together, columns missing on a side null."""
    fresh = normalize_registry(new)
    return fresh if existing is None else normalize_registry(existing).unionByName(fresh, allowMissingColumns=True)


def registry_rows(split: DataFrame, models: dict[str, dict], run_id: str, trained_at: Column) -> DataFrame:
    """Registry rows of one run: every model on every horizon with its training bounds.

    `models` maps a model name to `type`, `features` (list) and `parameters` (dict).
    """
    bounds = split.where("evaluation_split = 'train'").groupBy(_H).agg(
        F.min("target_timestamp_utc").alias("train_start_timestamp_utc"),
        F.max("target_timestamp_utc").alias("train_end_timestamp_utc"),
    )
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("model_name"),
            F.lit(spec["type"]).alias("model_type"),
            F.to_json(F.array(*[F.lit(f) for f in spec["features"]])).alias("feature_names"),
            object_text({k: F.lit(v) for k, v in spec["parameters"].items()}).alias("parameters"),
        )
        for name, spec in models.items()
    ])
    listed = bounds.select(_H, "train_start_timestamp_utc", "train_end_timestamp_utc", F.inline(entries))
    return normalize_registry(
        listed.withColumn("trained_at", trained_at).selectExpr(
            f"md5(concat_ws(':', '{run_id}', model_name, {_H})) as model_id", "model_name", _H, "model_type",
            "cast(null as string) as artifact_path", "feature_names", "parameters", "trained_at",
            "train_start_timestamp_utc", "train_end_timestamp_utc", f"'{run_id}' as run_id",
            "false as is_preferred",
        )
    )
