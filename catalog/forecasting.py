"""Queries over horizon frames, splits, baselines, forecast errors and backtest windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from catalog.parts import part
from gridcast.contracts import BASELINES, BacktestRules
from gridcast.plans import backtests, forecasting, governance, horizon, reports
from gridcast.session import settle
from gridcast.sources import stand_ins as raw
from gridcast.sources import tables

RUN = "run-1"
HORIZONS = [1, 24]
DAILY_RULES = BacktestRules(min_train_days=90, min_test_days=7, min_train_rows=60, min_test_rows=20, max_windows=6)
DAILY_ROLLING = BacktestRules(mode="rolling", rolling_train_days=180, min_train_days=90, min_test_days=7,
                              min_train_rows=60, min_test_rows=20, max_windows=None)


def evaluated_at():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def daily(spark, folder):
    """One row per day of orders: far smaller than the orders, read several times."""
    return settle(raw.daily_series(spark, folder))


def frame(spark, folder):
    return horizon.horizon_frame(daily(spark, folder), HORIZONS)


def split_frame(spark, folder):
    return forecasting.time_splits(settle(frame(spark, folder)))


def results(spark, folder):
    split = settle(split_frame(spark, folder))
    return forecasting.forecast_results(forecasting.baseline_forecasts(split, RUN), forecasting.peak_thresholds(split))


def registry(spark, folder, split=None):
    models = {name: {"type": "baseline", "features": [rule], "parameters": {"rule": rule}} for name, rule in BASELINES.items()}
    return governance.registry_rows(split or split_frame(spark, folder), models, RUN, evaluated_at())


# --- horizon frame ----------------------------------------------------------------

def _roll(column, rows):
    over = f"over (order by timestamp_utc rows between {rows - 1} preceding and current row)"
    return f"cast(sum({column}) {over} as double) / count({column}) {over}"


part("rolled", f"""
select timestamp_utc, load_mw, pool_price_cad_mwh, {_roll('load_mw', 24)} as r24, {_roll('load_mw', 168)} as r168, {_roll('pool_price_cad_mwh', 24)} as p24
from daily""")
part("hframe", """
select h.horizon_hours, t.timestamp_utc - to_hours(h.horizon_hours) as feature_as_of_timestamp_utc,
  t.timestamp_utc - to_hours(h.horizon_hours) as feature_max_source_timestamp_utc, t.timestamp_utc as target_timestamp_utc,
  t.load_mw as target_load_mw, t.pool_price_cad_mwh as actual_pool_price_cad_mwh, f.* exclude (timestamp_utc),
  case when 1 >= h.horizon_hours then l1.load_mw end as load_lag_1h, case when 24 >= h.horizon_hours then l24.load_mw end as load_lag_24h,
  case when 168 >= h.horizon_hours then l168.load_mw end as load_lag_168h, i.r24 as load_rolling_24h_avg, i.r168 as load_rolling_168h_avg,
  case when 24 >= h.horizon_hours then l24.pool_price_cad_mwh end as price_lag_24h, i.p24 as price_rolling_24h_avg
from rolled t cross join (select unnest([1, 24]) as horizon_hours) h join od_flags f on f.timestamp_utc = t.timestamp_utc
left join rolled l1 on l1.timestamp_utc = t.timestamp_utc - interval 1 hour
left join rolled l24 on l24.timestamp_utc = t.timestamp_utc - interval 24 hour
left join rolled l168 on l168.timestamp_utc = t.timestamp_utc - interval 168 hour
left join rolled i on i.timestamp_utc = t.timestamp_utc - to_hours(h.horizon_hours)""")
part("hsplit", """
select f.*, case when target_timestamp_utc <= train_end then 'train' when target_timestamp_utc <= val_end then 'validation' else 'test' end as evaluation_split
from hframe f join (
  select horizon_hours, max(case when k <= cast(trunc(n * cast(0.70 as double)) as int) then target_timestamp_utc end) as train_end,
    max(case when k <= cast(trunc(n * cast(0.85 as double)) as int) then target_timestamp_utc end) as val_end
  from (select horizon_hours, target_timestamp_utc, row_number() over (partition by horizon_hours order by target_timestamp_utc) as k,
      count(*) over (partition by horizon_hours) as n from (select distinct horizon_hours, target_timestamp_utc from hframe))
  group by 1) c using (horizon_hours)""")
FRAME = "horizon_hours:int feature_as_of_timestamp_utc:ts feature_max_source_timestamp_utc:ts target_timestamp_utc:ts target_load_mw:num actual_pool_price_cad_mwh:num hour:int day_of_week:int month:int is_weekend:bool load_lag_1h:num load_lag_24h:num load_lag_168h:num load_rolling_24h_avg:num load_rolling_168h_avg:num price_lag_24h:num price_rolling_24h_avg:num is_stat_holiday:bool is_alberta_stat_holiday:bool is_canada_stat_holiday:bool is_long_weekend:bool is_workday:bool is_non_workday:bool"

query("horizon_frame", FRAME, "hframe")(frame)


@query("time_lags", "timestamp_utc:ts load_mw:num lag_24h:num lag_168h:num", """
select t.timestamp_utc, t.load_mw, a.load_mw as lag_24h, b.load_mw as lag_168h from stg_load t
left join stg_load a on a.timestamp_utc = t.timestamp_utc - interval 24 hour
left join stg_load b on b.timestamp_utc = t.timestamp_utc - interval 168 hour""")
def time_lags(spark, folder):
    from catalog.market import stg_load

    staged = stg_load(spark, folder).select("timestamp_utc", "load_mw")
    return horizon.time_lags(staged, "timestamp_utc", {"lag_24h": ("load_mw", 24), "lag_168h": ("load_mw", 168)})


part("first_view", """
select date_trunc('hour', ts) as h, arg_min(cast(value as decimal(12,2)), event_id) as load_mw, arg_min(user_id, event_id) as user_id
from events where event_type = 'view' group by 1""")


@query("horizon_first_kept", "horizon_hours:int target_timestamp_utc:ts target_load_mw:num actual_pool_price_cad_mwh:num load_lag_24h:num price_lag_24h:num load_lag_168h:num load_rolling_24h_avg:num", """
select 24 as horizon_hours, t.h as target_timestamp_utc, t.load_mw as target_load_mw, t.user_id as actual_pool_price_cad_mwh, a.load_mw as load_lag_24h,
  a.user_id as price_lag_24h, b.load_mw as load_lag_168h, a.mean as load_rolling_24h_avg
from first_view t
left join (select *, cast(sum(load_mw) over w as double) / count(load_mw) over w as mean from first_view window w as (order by h rows between 23 preceding and current row)) a on a.h = t.h - interval 24 hour
left join first_view b on b.h = t.h - interval 168 hour""")
def horizon_first_kept(spark, folder):
    """The horizon frame of events that repeat their hour: the first of each hour in the file is kept (ids follow the file)."""
    events = tables.in_file_order(spark, f"{folder}/events.parquet").where("event_type = 'view'").selectExpr(
        "cast(date_trunc('hour', ts) as timestamp) as timestamp_utc", "cast(value as decimal(12,2)) as load_mw", "user_id as pool_price_cad_mwh", *tables.FILE_ORDER)
    return horizon.horizon_frame(events, 24, order=tables.FILE_ORDER)


@query("time_splits", "horizon_hours:int target_timestamp_utc:ts target_load_mw:num evaluation_split:text", "hsplit")
def time_splits(spark, folder):
    return split_frame(spark, folder)


# --- forecasts --------------------------------------------------------------------

part("baseline_preds", """
select horizon_hours, evaluation_split, feature_as_of_timestamp_utc, target_timestamp_utc, target_load_mw, actual_pool_price_cad_mwh,
  model_name, predicted_load_mw, md5('run-1:' || model_name || ':' || horizon_hours) as model_id
from (
  select *, 'baseline_same_hour_yesterday' as model_name, cast(load_lag_24h as double) as predicted_load_mw from hsplit
  union all select *, 'baseline_same_hour_last_week', cast(load_lag_168h as double) from hsplit
  union all select *, 'baseline_rolling_24h_average', load_rolling_24h_avg from hsplit)
where evaluation_split in ('validation', 'test') and predicted_load_mw is not null""")
part("thresholds", "select horizon_hours, quantile_cont(cast(target_load_mw as double), 0.9) as peak_threshold_mw from hframe group by 1")
part("effective", """
select model_id, model_name, horizon_hours, evaluation_split,
  case when max(cast(target_load_mw as double)) >= any_value(peak_threshold_mw) then any_value(peak_threshold_mw)
    else quantile_cont(cast(target_load_mw as double), 0.9) end as peak_threshold_mw
from baseline_preds join thresholds using (horizon_hours) group by 1, 2, 3, 4""")
part("results", """
select p.*, e.peak_threshold_mw, predicted_load_mw - cast(target_load_mw as double) as error_mw,
  abs(predicted_load_mw - cast(target_load_mw as double)) as absolute_error_mw,
  abs(predicted_load_mw - cast(target_load_mw as double)) / nullif(cast(target_load_mw as double), 0) * 100 as absolute_percentage_error,
  cast(target_load_mw as double) >= e.peak_threshold_mw as is_peak_period
from baseline_preds p join effective e using (model_id, model_name, horizon_hours, evaluation_split)""")
part("performance", """
select model_id, model_name, horizon_hours, evaluation_split, avg(absolute_error_mw) as mae, sqrt(avg(error_mw * error_mw)) as rmse,
  avg(absolute_percentage_error) as mape, avg(error_mw) as mean_error, quantile_cont(absolute_error_mw, 0.5) as median_absolute_error,
  avg(case when error_mw < 0 then 1.0::double else 0.0::double end) as underprediction_rate,
  avg(case when is_peak_period then absolute_error_mw end) as peak_period_mae, timestamp '2024-06-01 00:00:00' as evaluated_at
from results group by 1, 2, 3, 4""")
KEYS = "horizon_hours:int model_name:text evaluation_split:text "
PERFORMANCE = KEYS + "model_id:text mae:num rmse:num mape:num mean_error:num median_absolute_error:num underprediction_rate:num peak_period_mae:num evaluated_at:ts"
RESULTS = "horizon_hours:int evaluation_split:text feature_as_of_timestamp_utc:ts target_timestamp_utc:ts target_load_mw:num actual_pool_price_cad_mwh:num model_id:text model_name:text predicted_load_mw:num error_mw:num absolute_error_mw:num absolute_percentage_error:num is_peak_period:bool"


@query("baseline_forecasts", "horizon_hours:int evaluation_split:text target_timestamp_utc:ts target_load_mw:num model_id:text model_name:text predicted_load_mw:num", "baseline_preds")
def baseline_forecasts(spark, folder):
    return forecasting.baseline_forecasts(split_frame(spark, folder), RUN)


query("forecast_errors", RESULTS, "results")(results)


@query("peak_threshold", "horizon_hours:int peak_threshold_mw:num", "thresholds")
def peak_threshold(spark, folder):
    return forecasting.peak_thresholds(settle(frame(spark, folder)))


def performance(spark, folder):
    return forecasting.model_performance(settle(results(spark, folder)), evaluated_at())


query("model_metrics", PERFORMANCE, "performance")(performance)


@query("model_metrics_bulk", "l_returnflag:text l_linestatus:text mae:num rmse:num mape:num mean_error:num median_absolute_error:num underprediction_rate:num peak_period_mae:num", """
select l_returnflag, l_linestatus, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse, avg(abs(e) / nullif(a, 0)) * 100 as mape, avg(e) as mean_error,
  quantile_cont(abs(e), 0.5) as median_absolute_error, avg(case when e < 0 then 1.0::double else 0.0::double end) as underprediction_rate,
  avg(case when a >= t then abs(e) end) as peak_period_mae
from (select *, quantile_cont(a, 0.9) over (partition by l_returnflag, l_linestatus) as t
  from (select l_returnflag, l_linestatus, l_extendedprice as a, l_quantity * 1500.0::double - l_extendedprice as e from lineitem))
group by 1, 2""")
def model_metrics_bulk(spark, folder):
    """The metrics over every line item: few groups, each holding a large share of all rows."""
    lines = raw.table(spark, folder, "lineitem").selectExpr(
        "l_returnflag", "l_linestatus", "l_extendedprice as actual", "l_quantity * 1500D as predicted"
    )
    return forecasting.forecast_metrics(lines, ["l_returnflag", "l_linestatus"], "actual", "predicted", threshold=None)


@query("model_comparison", PERFORMANCE, "select * from performance where evaluation_split = 'test'")
def model_comparison(spark, folder):
    return reports.model_comparison(performance(spark, folder))


@query("best_test_models", KEYS + "mae:num rmse:num mape:num", "select * from performance where evaluation_split = 'test' qualify row_number() over (partition by horizon_hours order by mae, model_name) = 1")
def best_test_models(spark, folder):
    return reports.best_by(reports.sliced(performance(spark, folder), evaluation_split="test"), "mae")


@query("forecast_kpis", KEYS + "mae:num rmse:num mape:num underprediction_pct:num", """
select horizon_hours, model_name, evaluation_split, avg(absolute_error_mw) as mae, sqrt(avg(error_mw * error_mw)) as rmse,
  avg(absolute_percentage_error) as mape, avg(case when error_mw < 0 then 100.0::double else 0.0::double end) as underprediction_pct from results group by 1, 2, 3""")
def forecast_kpis(spark, folder):
    return reports.forecast_kpis(results(spark, folder))


def _error_query(name, column, kind, sql):
    @query(name, KEYS + f"{column}:{kind} mae:num", f"""
select horizon_hours, model_name, evaluation_split, {sql} as {column}, avg(absolute_error_mw) as mae from results group by 1, 2, 3, 4""")
    def build(spark, folder):
        return reports.error_by(results(spark, folder), column)


_error_query("error_by_hour", "hour", "int", "hour(target_timestamp_utc)")
_error_query("error_by_day", "day_of_week", "text", "dayname(target_timestamp_utc)")
_error_query("error_by_month", "month", "int", "month(target_timestamp_utc)")


@query("peak_kpis", KEYS + "peak_mae:num peak_underprediction_pct:num peak_rows:int", """
select horizon_hours, model_name, evaluation_split, avg(absolute_error_mw) filter (where is_peak_period) as peak_mae,
  avg(case when error_mw < 0 then 100.0::double else 0.0::double end) filter (where is_peak_period) as peak_underprediction_pct,
  count(*) filter (where is_peak_period) as peak_rows from results group by 1, 2, 3""")
def peak_kpis(spark, folder):
    return reports.peak_kpis(results(spark, folder))


@query("worst_peak_errors", RESULTS, "select * from results where is_peak_period order by absolute_error_mw desc, model_name, horizon_hours, target_timestamp_utc limit 50")
def worst_peak_errors(spark, folder):
    return reports.worst_peak_errors(results(spark, folder))


@query("forecast_slice", RESULTS, "select * from results where horizon_hours = 24 and evaluation_split = 'test' and model_name = 'baseline_same_hour_yesterday'")
def forecast_slice(spark, folder):
    return reports.sliced(results(spark, folder), horizon_hours=24, evaluation_split="test", model_name="baseline_same_hour_yesterday")


@query("residual_histogram", KEYS + "bin:int row_count:int", """
select horizon_hours, model_name, evaluation_split, bin, count(*) as row_count from (
  select *, case when hi = lo then 0 else least(cast(floor((error_mw - lo) / (hi - lo) * 40) as int), 39) end as bin from (
    select *, min(error_mw) over g as lo, max(error_mw) over g as hi from results window g as (partition by horizon_hours, model_name, evaluation_split)))
group by 1, 2, 3, 4""")
def residual_histogram(spark, folder):
    return reports.residual_histogram(settle(results(spark, folder)))


@query("holiday_error", KEYS + "holiday_group:text mae:num row_count:int", """
select r.horizon_hours, r.model_name, r.evaluation_split, case when h.is_stat_holiday then 'Holiday' else 'Non-holiday' end as holiday_group,
  avg(r.absolute_error_mw) as mae, count(*) as row_count
from results r join hframe h using (horizon_hours, feature_as_of_timestamp_utc, target_timestamp_utc) group by 1, 2, 3, 4""")
def holiday_error(spark, folder):
    split = settle(split_frame(spark, folder))
    rows = forecasting.forecast_results(forecasting.baseline_forecasts(split, RUN), forecasting.peak_thresholds(split))
    return reports.holiday_errors(rows, split)


@query("model_registry", "model_id:text model_name:text horizon_hours:int model_type:text artifact_path:text feature_names:text parameters:text trained_at:ts train_start_timestamp_utc:ts train_end_timestamp_utc:ts run_id:text is_preferred:bool preferred_at:ts retired_at:ts promotion_decision_id:text", """
select md5('run-1:' || m.model_name || ':' || b.horizon_hours) as model_id, m.model_name, b.horizon_hours, 'baseline' as model_type,
  null as artifact_path, '["' || m.rule || '"]' as feature_names, '{"rule":"' || m.rule || '"}' as parameters,
  timestamp '2024-06-01 00:00:00' as trained_at, b.lo as train_start_timestamp_utc, b.hi as train_end_timestamp_utc, 'run-1' as run_id,
  false as is_preferred, null as preferred_at, null as retired_at, null as promotion_decision_id
from (select horizon_hours, min(target_timestamp_utc) as lo, max(target_timestamp_utc) as hi from hsplit where evaluation_split = 'train' group by 1) b
cross join (values ('baseline_same_hour_yesterday', 'load_lag_24h'), ('baseline_same_hour_last_week', 'load_lag_168h'),
  ('baseline_rolling_24h_average', 'load_rolling_24h_avg')) m(model_name, rule)""")
def model_registry(spark, folder):
    return registry(spark, folder)


# --- backtests --------------------------------------------------------------------

part("month_stats", """
select horizon_hours, date_trunc('month', target_timestamp_utc) as m, count(*) as n, min(target_timestamp_utc) as lo, max(target_timestamp_utc) as hi
from (select distinct horizon_hours, target_timestamp_utc from hframe) group by 1, 2""")


def windows_sql(mode: str, floor: str, limit: str) -> str:
    return f"""
select horizon_hours, '{mode}_' || strftime(test_start, '%Y%m%dT%H%M%SZ') || '_' || strftime(test_end, '%Y%m%dT%H%M%SZ') as window_id,
  '{mode}' as backtest_mode, train_start, train_end, test_start, test_end, train_row_count, test_row_count
from (
  select t.horizon_hours, t.m, t.n as test_row_count, t.lo as test_start, t.hi as test_end, count(*) as train_row_count,
    min(f.target_timestamp_utc) as train_start, max(f.target_timestamp_utc) as train_end
  from month_stats t join hframe f on f.horizon_hours = t.horizon_hours and f.target_timestamp_utc < t.lo {floor}
  group by all)
where test_row_count >= 20 and train_row_count >= 60 and test_end >= test_start + interval 7 day - interval 1 hour
  and train_end >= train_start + interval 90 day - interval 1 hour {limit}"""


part("windows", windows_sql("expanding", "", "qualify row_number() over (partition by horizon_hours order by m desc) <= 6"))
part("rolling_windows", windows_sql("rolling", "and f.target_timestamp_utc >= t.m - interval 180 day", ""))
WINDOWS = "horizon_hours:int window_id:text backtest_mode:text train_start:ts train_end:ts test_start:ts test_end:ts train_row_count:int test_row_count:int"


@query("backtest_windows", WINDOWS, "windows")
def backtest_windows(spark, folder):
    return backtests.backtest_windows(frame(spark, folder), DAILY_RULES)


@query("backtest_windows_rolling", WINDOWS, "rolling_windows")
def backtest_windows_rolling(spark, folder):
    return backtests.backtest_windows(frame(spark, folder), DAILY_ROLLING)


part("window_thresholds", """
select w.horizon_hours, w.window_id, quantile_cont(cast(f.target_load_mw as double), 0.9) as t
from windows w join hframe f on f.horizon_hours = w.horizon_hours and f.target_timestamp_utc between w.train_start and w.train_end group by 1, 2""")
part("window_preds", """
select w.window_id, p.* from (
  select *, 'baseline_same_hour_yesterday' as model_name, cast(load_lag_24h as double) as predicted from hframe
  union all select *, 'baseline_same_hour_last_week', cast(load_lag_168h as double) from hframe
  union all select *, 'baseline_rolling_24h_average', load_rolling_24h_avg from hframe) p
join windows w on w.horizon_hours = p.horizon_hours and p.target_timestamp_utc between w.test_start and w.test_end
where predicted is not null""")
part("window_scores", """
select p.horizon_hours, p.model_name, p.window_id, cast(p.target_load_mw as double) as a, predicted - cast(p.target_load_mw as double) as e,
  count(*) over g as prediction_row_count,
  case when max(cast(p.target_load_mw as double)) over g >= t.t then t.t else quantile_cont(cast(p.target_load_mw as double), 0.9) over g end as peak_threshold_mw
from window_preds p join window_thresholds t using (horizon_hours, window_id) window g as (partition by p.horizon_hours, p.model_name, p.window_id)""")
part("backtest_rows", """
select 'run-1' as run_id, md5('run-1:' || s.model_name || ':' || s.horizon_hours) as model_id, s.model_name, 'baseline' as model_type, s.horizon_hours, s.window_id,
  any_value(w.backtest_mode) as backtest_mode, any_value(w.train_start) as train_start_timestamp_utc, any_value(w.train_end) as train_end_timestamp_utc,
  any_value(w.test_start) as test_start_timestamp_utc, any_value(w.test_end) as test_end_timestamp_utc,
  any_value(w.train_row_count) as train_row_count, any_value(w.test_row_count) as test_row_count,
  any_value(prediction_row_count) as prediction_row_count, any_value(peak_threshold_mw) as peak_threshold_mw,
  timestamp '2024-06-01 00:00:00' as evaluated_at, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse, avg(abs(e) / nullif(a, 0)) * 100 as mape,
  avg(e) as mean_error, quantile_cont(abs(e), 0.5) as median_absolute_error, avg(case when e < 0 then 1.0::double else 0.0::double end) as underprediction_rate,
  avg(case when a >= peak_threshold_mw then abs(e) end) as peak_period_mae
from window_scores s join windows w using (horizon_hours, window_id) group by s.model_name, s.horizon_hours, s.window_id""")
BACKTESTS = "run_id:text model_id:text model_name:text model_type:text horizon_hours:int window_id:text backtest_mode:text train_start_timestamp_utc:ts train_end_timestamp_utc:ts test_start_timestamp_utc:ts test_end_timestamp_utc:ts train_row_count:int test_row_count:int prediction_row_count:int peak_threshold_mw:num evaluated_at:ts mae:num rmse:num mape:num mean_error:num median_absolute_error:num underprediction_rate:num peak_period_mae:num"


def baseline_backtests(spark, folder):
    split = settle(split_frame(spark, folder))
    return backtests.backtest_baselines(split, registry(spark, folder, split), DAILY_RULES, RUN, evaluated_at())


query("backtest_baselines", BACKTESTS, "backtest_rows")(baseline_backtests)
