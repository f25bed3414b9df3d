"""Queries over a training set of several years: trees, their saved tables, backtests, and a whole run.

The trees' numbers have no SQL. The queries with an oracle give what SQL can say about them: keys, actuals and counts,
and whether every forecast is there and the mean error stays within BOUND times that of the best baseline.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from catalog.base import query
from catalog.forecasting import DAILY_RULES, evaluated_at, windows_sql
from catalog.market import TIE
from catalog.parts import PARTS, part
from gridcast.contracts import BASELINES, FEATURES
from gridcast.plans import backtests, features, forecasting, governance, marts, staging, training, trees
from gridcast.plans import calendar as cal
from gridcast.session import settle, shared_folder
from gridcast.sources import stand_ins as raw

RUN = "run-2"
HORIZONS = [24, 48]
BOUND = 1.5


def long_training_set(spark, folder):
    """The training set of the long feeds; hours are the days of the orders."""
    feeds = raw.long_feeds(spark, folder)
    series = settle(features.stacked_series(staging.stage_load(feeds["load"]), staging.stage_price(feeds["price"])))
    calendar = cal.calendar_hourly(cal.time_bounds(series.where("series = 'load'"), "timestamp_utc"))
    return marts.training_set(
        features.energy_features(calendar, series),
        features.weather_features(staging.stage_weather(feeds["weather"], TIE)),
        features.generation_features(staging.stage_generation(feeds["generation"], TIE)),
        features.intertie_features(staging.stage_intertie(feeds["intertie"], TIE)),
        HORIZONS,
    )


def split_set(spark, folder):
    return settle(forecasting.time_splits(settle(long_training_set(spark, folder))))


part("long_rows", """
select h.horizon_hours, t.timestamp_utc as target_timestamp_utc, t.timestamp_utc - to_hours(h.horizon_hours) as as_of_utc, t.load_mw as target_load_mw,
  t.lag as load_lag_168h, i.pool_price_cad_mwh as latest_known_pool_price_cad_mwh
from (select *, lag(load_mw, 168) over (order by timestamp_utc) as lag from daily) t
cross join (values (24), (48)) h(horizon_hours)
join daily i on i.timestamp_utc = t.timestamp_utc - to_hours(h.horizon_hours)""")
part("long_weather", """
select target, issue, count(distinct l_suppkey % 5) as regions
from (select date_trunc('day', l_shipdate) as target, date_trunc('day', l_shipdate) - to_days(cast(1 + l_orderkey % 3 as int)) as issue, l_suppkey from lineitem)
group by 1, 2""")
# the frame and its splits under their own names, by the same SQL
for name in ("hsplit", "month_stats"):
    part(f"long_{name}", PARTS[name].replace("hframe", "long_rows"))
part("long_windows", windows_sql("expanding", "", "qualify row_number() over (partition by horizon_hours order by m desc) <= 6")
     .replace("month_stats", "long_month_stats").replace("hframe", "long_rows"))
_MODEL = "md5('run-2:gbt_regressor:' || horizon_hours)"


@query("training_set_long", "horizon_hours:int target_timestamp_utc:ts feature_as_of_timestamp_utc:ts target_load_mw:num load_lag_168h:num latest_known_pool_price_cad_mwh:num weather_forecast_issue_utc:ts weather_forecast_region_count:int", """
select r.horizon_hours, r.target_timestamp_utc, r.as_of_utc as feature_as_of_timestamp_utc, r.target_load_mw, r.load_lag_168h, r.latest_known_pool_price_cad_mwh,
  w.issue as weather_forecast_issue_utc, w.regions as weather_forecast_region_count
from long_rows r asof left join long_weather w on w.target = r.target_timestamp_utc and w.issue <= r.as_of_utc""")
def training_set_long(spark, folder):
    return long_training_set(spark, folder)


def _errors(rows, keys):
    return rows.groupBy(*keys).agg(F.avg(F.abs(F.col("predicted_load_mw") - F.col("target_load_mw").cast("double"))).alias("mae"))


def _near_best(own, others, keys):
    """(keys, near_best): whether the error of a model is at most BOUND times the least of the baselines."""
    best = others.groupBy(*keys).agg(F.min("mae").alias("best"))
    return own.join(best, keys).select(*keys, (F.col("mae") <= F.col("best") * BOUND).alias("near_best"))


@query("gbt_forecast", "horizon_hours:int evaluation_split:text target_timestamp_utc:ts target_load_mw:num model_id:text model_name:text split_rows:int predicted:bool near_best:bool", f"""
select horizon_hours, evaluation_split, target_timestamp_utc, target_load_mw, {_MODEL} as model_id, 'gbt_regressor' as model_name,
  count(*) over (partition by horizon_hours, evaluation_split) as split_rows, true as predicted, true as near_best
from long_hsplit where evaluation_split in ('validation', 'test')""")
def gbt_forecast(spark, folder):
    """Tree forecasts from known-as-of features: rows, actuals, and an error bound against the best baseline."""
    split = split_set(spark, folder)
    forecasts = settle(trees.tree_forecasts(split, RUN)[0])
    keys = ["horizon_hours", "evaluation_split"]
    baselines = _errors(forecasting.baseline_forecasts(split, RUN), [*keys, "model_name"])
    bounded = _near_best(_errors(forecasts, keys), baselines, keys).join(forecasts.groupBy(*keys).agg(F.count("*").alias("split_rows")), keys)
    finite = F.col("predicted_load_mw").isNotNull() & ~F.isnan("predicted_load_mw")
    return forecasts.withColumn("predicted", finite).join(F.broadcast(bounded), keys)  # two rows per horizon


@query("gbt_predictions", "horizon_hours:int evaluation_split:text target_timestamp_utc:ts target_load_mw:num model_id:text model_name:text predicted_load_mw:num")
def gbt_predictions(spark, folder):
    return trees.tree_forecasts(split_set(spark, folder), RUN)[0]


@query("gbt_importance", "horizon_hours:int model_id:text model_name:text feature_name:text is_share:bool total:num known_used:bool created_at:ts", f"""
select horizon_hours, {_MODEL} as model_id, 'gbt_regressor' as model_name, feature_name, true as is_share, 1.0::double as total, true as known_used,
  timestamp '2024-06-01 00:00:00' as created_at
from (select distinct horizon_hours from long_rows) cross join (select unnest({FEATURES!r}) as feature_name)""")
def gbt_importance(spark, folder):
    """Shares of gain: one row for each feature and horizon, that sum to 1; snapshot features take part."""
    split = split_set(spark, folder)
    _, nodes = trees.tree_forecasts(split, RUN)
    table = settle(trees.importance_table(nodes, trees.tree_models(split, RUN), evaluated_at()))
    sums = table.groupBy("horizon_hours").agg(
        F.sum("importance").alias("total"),
        (F.sum(F.when(F.col("feature_name") == "forecast_temperature_c", F.col("importance"))) > 0).alias("known_used"))
    return table.join(sums, "horizon_hours").withColumn("is_share", F.col("importance").between(0, 1))


@query("gbt_backtest", "run_id:text model_id:text model_name:text model_type:text horizon_hours:int window_id:text backtest_mode:text train_start_timestamp_utc:ts train_end_timestamp_utc:ts test_start_timestamp_utc:ts test_end_timestamp_utc:ts train_row_count:int test_row_count:int prediction_row_count:int peak_threshold_mw:num scored:bool near_best:bool evaluated_at:ts", f"""
select 'run-2' as run_id, {_MODEL} as model_id, 'gbt_regressor' as model_name, 'gbt' as model_type, w.horizon_hours, w.window_id, w.backtest_mode,
  w.train_start as train_start_timestamp_utc, w.train_end as train_end_timestamp_utc, w.test_start as test_start_timestamp_utc, w.test_end as test_end_timestamp_utc,
  w.train_row_count, w.test_row_count, w.test_row_count as prediction_row_count,
  case when t.top >= l.q then l.q else t.q end as peak_threshold_mw, true as scored, true as near_best, timestamp '2024-06-01 00:00:00' as evaluated_at
from long_windows w
join (select w.horizon_hours, w.window_id, quantile_cont(cast(f.target_load_mw as double), 0.9) as q
  from long_windows w join long_rows f on f.horizon_hours = w.horizon_hours and f.target_timestamp_utc between w.train_start and w.train_end group by 1, 2) l using (horizon_hours, window_id)
join (select w.horizon_hours, w.window_id, quantile_cont(cast(f.target_load_mw as double), 0.9) as q, max(cast(f.target_load_mw as double)) as top
  from long_windows w join long_rows f on f.horizon_hours = w.horizon_hours and f.target_timestamp_utc between w.test_start and w.test_end group by 1, 2) t using (horizon_hours, window_id)""")
def gbt_backtest(spark, folder):
    """Six windows a horizon, each with its own fit of the stated size, and an error bound against the best baseline."""
    split = split_set(spark, folder)
    measured = settle(trees.backtest_trees(split, DAILY_RULES, RUN, evaluated_at()))
    specs = {name: {"type": "baseline", "features": [rule], "parameters": {"rule": rule}} for name, rule in BASELINES.items()}
    baselines = backtests.backtest_baselines(split, governance.registry_rows(split, specs, RUN, evaluated_at()), DAILY_RULES, RUN, evaluated_at())
    # over all windows of a horizon: one month is too short to compare on
    average = lambda rows, keys: rows.groupBy(*keys).agg(F.avg("mae").alias("mae"))
    bounded = _near_best(average(measured, ["horizon_hours"]), average(baselines, ["horizon_hours", "model_name"]), ["horizon_hours"])
    complete = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("mae", "rmse", "mape", "mean_error", "median_absolute_error", "underprediction_rate")]
    scored = complete[0]
    for one in complete[1:]:
        scored = scored & one
    return measured.withColumn("scored", scored).join(bounded, "horizon_hours")


@query("tree_registry", "model_id:text model_name:text horizon_hours:int model_type:text feature_names:text parameters:text has_artifact:bool forecast_rows:int same_forecasts:bool train_start_timestamp_utc:ts train_end_timestamp_utc:ts run_id:text", f"""
select * from (with b as (select horizon_hours, min(target_timestamp_utc) as lo, max(target_timestamp_utc) as hi from long_hsplit where evaluation_split = 'train' group by 1),
  held as (select horizon_hours, count(*) as n from long_hsplit where evaluation_split <> 'train' group by 1)
select md5('run-2:' || m.model_name || ':' || b.horizon_hours) as model_id, m.model_name, b.horizon_hours, m.model_type, m.feature_names, m.parameters,
  m.model_type = 'gbt' as has_artifact, case when m.model_type = 'gbt' then held.n else 0 end as forecast_rows, true as same_forecasts,
  b.lo as train_start_timestamp_utc, b.hi as train_end_timestamp_utc, 'run-2' as run_id
from b join held using (horizon_hours) cross join (
  values {', '.join(f"""('{name}', 'baseline', '["{rule}"]', '{{"rule":"{rule}"}}')""" for name, rule in BASELINES.items())},
    ('gbt_regressor', 'gbt', '{json.dumps(FEATURES, separators=(",", ":"))}', '{json.dumps(trees.TreeSettings().parameters(), separators=(",", ":"), sort_keys=True)}')
) m(model_name, model_type, feature_names, parameters))""")
def tree_registry(spark, folder):
    """Baselines and saved trees in one registry; the trees, read back by the registry's paths, forecast as the fitted ones did."""
    split, settings = split_set(spark, folder), trees.TreeSettings()
    forecasts, nodes = trees.tree_forecasts(split, RUN)
    specs = {name: {"type": "baseline", "features": [rule], "parameters": {"rule": rule}} for name, rule in BASELINES.items()}
    rows = settle(governance.registry_rows(split, specs, RUN, evaluated_at()).unionByName(
        trees.register_trees(split, nodes, RUN, evaluated_at(), f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}")))
    held_out = split.where("evaluation_split <> 'train'")
    again = trees.predict(held_out, rows.where("model_type = 'gbt'"), trees.saved_trees(spark, rows), settings.features)
    keys = ["model_id", "target_timestamp_utc"]
    both = forecasts.select(*keys, "predicted_load_mw").join(again.select(*keys, F.col("predicted_load_mw").alias("again")), keys, "full")
    told = both.groupBy("model_id").agg(F.count("again").alias("n"), F.every(F.col("again").eqNullSafe(F.col("predicted_load_mw"))).alias("same"))
    return rows.join(told, "model_id", "left").select(
        *rows.columns, F.col("artifact_path").isNotNull().alias("has_artifact"), F.coalesce("n", F.lit(0)).alias("forecast_rows"),
        F.coalesce("same", F.lit(True)).alias("same_forecasts"))


@query("training_run", "attempt:int table_name:text run_id:text row_count:int model_count:int promoted:int", """
select * from (with held as (select horizon_hours, evaluation_split, count(*) as n, count(load_lag_168h) as lagged from long_hsplit where evaluation_split <> 'train' group by 1, 2),
  w as (select count(*) as windows, sum(prediction_rows) as n from (select w.window_id, w.horizon_hours,
      (select count(*) from long_rows r where r.horizon_hours = w.horizon_hours and r.target_timestamp_utc between w.test_start and w.test_end and r.load_lag_168h is not null) as prediction_rows from long_windows w)),
  h as (select count(distinct horizon_hours) as n from long_rows)
select a.attempt, t.table_name, 'run-2' as run_id, t.row_count, t.model_count, t.promoted from (values (1), (2)) a(attempt) cross join (
  select 'model_registry' as table_name, (select 3 * n from h) as row_count, (select 3 * n from h) as model_count, (select n from h) as promoted
  union all select 'forecast_results', (select sum(2 * n + lagged) from held), (select 3 * n from h), 0
  union all select 'model_performance', (select 6 * n from h), (select 3 * n from h), 0
  union all select 'feature_importance', (select 47 * n from h), (select n from h), 0
  union all select 'model_backtest_results', (select 3 * windows from w), (select 3 * n from h), 0
  union all select 'model_promotion_decisions', (select 3 * n from h), (select 3 * n from h), (select n from h)) t)""")
def training_run(spark, folder):
    """A run stored twice: the second attempt leaves the tables as the first did."""
    frame = settle(long_training_set(spark, folder))
    layer = f"gridcast_{uuid.uuid4().hex[:12]}"
    base = shared_folder(spark)
    spark.sql(f"CREATE DATABASE {layer} LOCATION '{base}/{layer}'")
    # two baselines whose values are known for every horizon, and the trees, at a tenth of their rounds
    run = training.TrainingRun(
        RUN, evaluated_at(), f"{base}/trees-{uuid.uuid4().hex}", windows=DAILY_RULES, settings=trees.TreeSettings(rounds=30),
        baselines={k: v for k, v in BASELINES.items() if v != "load_lag_24h"})
    counted = None
    for attempt in (1, 2):
        for name, stored in training.store_run(frame, layer, run).items():
            promoted = F.count_if("is_preferred") if name == "model_registry" else (
                F.count_if(F.col("decision") == "promoted") if name == "model_promotion_decisions" else F.lit(0))
            model = "challenger_model_id" if name == "model_promotion_decisions" else "model_id"
            one = settle(stored.agg(F.count("*").alias("row_count"), F.count_distinct(model).alias("model_count"), promoted.alias("promoted")).select(
                F.lit(attempt).alias("attempt"), F.lit(name).alias("table_name"), F.lit(RUN).alias("run_id"), "row_count", "model_count", "promoted"))
            counted = one if counted is None else counted.unionByName(one)
    return counted
