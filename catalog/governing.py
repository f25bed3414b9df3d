"""Queries over registries, champions, promotion decisions and their reports.

Customers stand in for registered models and their orders per year for backtest
results, so the work grows with both tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from catalog.parts import part
from gridcast.contracts import METRICS, PromotionRules
from gridcast.functions.coerce import TRUE_WORDS_REPORTS, truthy
from gridcast.functions.documents import text_field, text_list
from gridcast.plans import backtests, governance, reports
from gridcast.session import settle
from gridcast.sources import stand_ins as raw

RULES = PromotionRules()
RUN = "run-9"
_AVERAGES = [f"{side}_average_{m}" for side in ("champion", "challenger") for m in METRICS]


def decided_at():
    return F.lit("2024-07-01 00:00:00").cast("timestamp")


def registry(spark, folder):
    return raw.model_registry(spark, folder)


def existing(spark, folder):
    return registry(spark, folder).where("key % 10 < 5").drop("key")


def candidates(spark, folder):
    return registry(spark, folder).where("key % 10 >= 5").drop("key")


def trials(spark, folder):
    return raw.backtest_trials(spark, folder)


def decisions(spark, folder):
    return governance.decide_promotions(
        existing(spark, folder), candidates(spark, folder), settle(trials(spark, folder)), RULES, RUN, decided_at()
    )


part("registry", """
select 'm' || c_custkey as model_id, 'name-' || (c_custkey % 7) as model_name, cast(c_custkey % 25 + 1 as int) as horizon_hours,
  case when c_custkey % 10 <> 4 then list_value('Yes', ' TRUE ', '1', 'on', '', 'no', '0', 'false', 'n', 'x')[c_custkey % 10 + 1] end as is_preferred,
  case when c_custkey % 3 = 0 then null when c_custkey % 7 = 0 then 'not a time' else strftime(timestamp '2024-01-01' + to_days(cast(c_custkey % 300 as int)), '%Y-%m-%d %H:%M:%S') end as preferred_at,
  strftime(timestamp '2023-06-01' + to_days(cast(c_custkey % 200 as int)), '%Y-%m-%d %H:%M:%S') as trained_at,
  case when c_custkey % 4 <> 3 then list_value('["load_lag_24h"]', '["a", "b", "c"]', 'broken [', '')[c_custkey % 4 + 1] end as feature_names,
  list_value('{"rule": "load_lag_168h"}', '[1, 2]', 'nope', '{"depth": 4}')[c_custkey % 4 + 1] as parameters, c_custkey as key
from customer""")
part("normal", """
select model_id, model_name, horizon_hours, coalesce(lower(trim(is_preferred)) in ('1', 'true', 't', 'yes', 'y'), false) as is_preferred,
  try_cast(preferred_at as timestamp) as preferred_at, cast(trained_at as timestamp) as trained_at, feature_names, parameters, key from registry""")
part("trials", """
select 'run-' || (k % 3) as run_id, 'm' || k as model_id, 'name-' || (k % 7) as model_name, cast(k % 25 + 1 as int) as horizon_hours, 'y' || y as window_id,
  case when k % 17 = 0 and y = 1998 then 'nan'::double else s / n / 977 end as mae, s / n / 977 * 1.2::double as rmse, cast(n as double) as mape,
  (lo - hi) / 977 as mean_error, hi / 977 as median_absolute_error, case when k % 13 = 0 then null else lo / 977 end as peak_period_mae,
  f::double / (n + 0.031::double) as underprediction_rate, timestamp '2024-01-01' + to_days(cast(k % 3 as int)) as evaluated_at
from (select o_custkey as k, year(o_orderdate) as y, count(*) as n, cast(sum(cast(o_totalprice as decimal(12,2))) as double) as s,
    min(o_totalprice) as lo, max(o_totalprice) as hi, count(*) filter (where o_orderstatus = 'F') as f from orders group by 1, 2)""")
part("champions", """
select * from normal where is_preferred and key % 10 < 5
qualify row_number() over (partition by horizon_hours order by preferred_at desc nulls last, trained_at desc nulls last, model_id desc) = 1""")
part("rivals", "select model_id, model_name, horizon_hours from registry where key % 10 >= 5")
_both = ", ".join(f"h.{m} as c_{m}, t.{m} as r_{m}" for m in METRICS)
part("rounds", f"""
select r.horizon_hours, r.model_id, t.window_id, {_both} from rivals r join trials t using (model_id)
join champions c on c.horizon_hours = r.horizon_hours join trials h on h.model_id = c.model_id and h.window_id = t.window_id
where isfinite(t.mae) and isfinite(h.mae)""")
_means = ", ".join(f"avg(c_{m}) as champion_average_{m}, avg(r_{m}) as challenger_average_{m}" for m in METRICS)
part("tallies", f"select horizon_hours, model_id, count(*) as v, count(*) filter (where r_mae <= c_mae) as w, {_means} from rounds group by 1, 2")
part("compared_rows", f"""
select r.horizon_hours, c.model_id as champion_model_id, c.model_name as champion_model_name, r.model_id, r.model_name, coalesce(t.v, 0) as v, coalesce(t.w, 0) as w,
  cast(ceil(coalesce(t.v, 0) * 0.5::double) as bigint) as needed, t.* exclude (horizon_hours, model_id, v, w)
from rivals r join champions c using (horizon_hours) left join tallies t on t.horizon_hours = r.horizon_hours and t.model_id = r.model_id""")
part("compared", f"""
select horizon_hours, champion_model_id, champion_model_name, model_id, model_name, v as valid_window_count,
  case when v >= 3 then needed else 3 end as required_window_count, case when v >= 3 then w else 0 end as win_count,
  case when v >= 3 then w::double / v else 0.0::double end as win_rate, {', '.join(_AVERAGES)},
  concat_ws('; ', case when v < 3 then printf('only %d comparable backtest windows; 3 required', v) end,
    case when v >= 3 and challenger_average_mae >= champion_average_mae then printf('average mae did not improve enough (%.6f vs %.6f)', challenger_average_mae, champion_average_mae) end,
    case when v >= 3 and w < needed then printf('won or tied %d windows; %d required', w, needed) end,
    case when v >= 3 and challenger_average_peak_period_mae > champion_average_peak_period_mae * 1.05::double
      then printf('peak-period MAE regression exceeded tolerance (%.6f > %.6f)', challenger_average_peak_period_mae, champion_average_peak_period_mae * 1.05::double) end,
    case when v >= 3 and challenger_average_underprediction_rate > champion_average_underprediction_rate + 0.02::double
      then printf('underprediction-rate regression exceeded tolerance (%.6f > %.6f)', challenger_average_underprediction_rate, champion_average_underprediction_rate + 0.02::double) end) as broken
from compared_rows""")
part("solo", f"""
select model_id, count(distinct window_id) as v, {', '.join(f'avg(case when isfinite({m}) then {m} end) as average_{m}' for m in METRICS)}
from trials where isfinite(mae) group by 1""")
part("judged", f"""
select horizon_hours, champion_model_id, champion_model_name, model_id, model_name, valid_window_count, required_window_count, win_count, win_rate,
  {', '.join(_AVERAGES)}, broken = '' as passed, case when broken = '' then 'passed all promotion rules' else broken end as reason from compared
union all
select r.horizon_hours, null, null, r.model_id, r.model_name, coalesce(s.v, 0), 3, null, null, {', '.join(['null'] * len(METRICS))},
  {', '.join(f's.average_{m}' for m in METRICS)}, coalesce(s.v, 0) >= 3,
  case when coalesce(s.v, 0) >= 3 then 'eligible' else printf('only %d backtest windows; 3 required', coalesce(s.v, 0)) end
from rivals r left join solo s using (model_id) where r.horizon_hours not in (select horizon_hours from champions)""")
part("chosen", """
select * from judged where passed
qualify row_number() over (partition by horizon_hours order by challenger_average_mae nulls last, challenger_average_rmse nulls last, model_name, model_id) = 1""")
part("decided", f"""
select md5('run-9:' || j.horizon_hours || ':' || j.model_id) as decision_id, 'run-9' as run_id, j.horizon_hours, j.champion_model_id, j.champion_model_name,
  j.model_id as challenger_model_id, j.model_name as challenger_model_name, c.model_id as promoted_model_id, j.champion_model_id as previous_champion_model_id,
  case when c.model_id is not null then 'promoted' else 'rejected' end as decision,
  case when not j.passed then j.reason
    when j.champion_model_id is null and c.model_id is not null then 'no existing champion; selected as initial champion after backtests'
    when j.champion_model_id is null then 'initial champion bootstrap selected another challenger'
    when c.model_id is not null then 'challenger passed promotion rules' else 'passed rules but another challenger had better average mae' end as reason,
  j.valid_window_count, j.required_window_count, j.win_count, j.win_rate, {', '.join('j.' + a for a in _AVERAGES)},
  timestamp '2024-07-01 00:00:00' as evaluated_at, cast(j.valid_window_count as varchar) as detail_windows, '0.05' as rule_peak
from judged j left join chosen c on c.horizon_hours = j.horizon_hours and c.model_id = j.model_id""")

# --- registry ---------------------------------------------------------------------

REGISTRY = "model_id:text model_name:text horizon_hours:int is_preferred:bool preferred_at:ts trained_at:ts"


@query("registry_normalized", REGISTRY + " run_id:text retired_at:ts promotion_decision_id:text",
       "select *, null as run_id, null as retired_at, null as promotion_decision_id from normal")
def registry_normalized(spark, folder):
    return governance.normalize_registry(registry(spark, folder))


@query("registry_json", "model_id:text feature_count:int first_feature:text rule:text depth:int", """
select model_id, len(f) as feature_count, f[1] as first_feature, case when json_type(p) = 'OBJECT' then json_extract_string(p, '$.rule') end as rule,
  try_cast(case when json_type(p) = 'OBJECT' then json_extract_string(p, '$.depth') end as int) as depth
from (select model_id, p, coalesce(case when json_type(n) = 'ARRAY' then from_json(n, '["VARCHAR"]') end, ['load_lag_24h', 'hour']) as f
  from (select model_id, case when json_valid(parameters) then parameters end as p, case when json_valid(feature_names) then feature_names end as n from registry))""")
def registry_json(spark, folder):
    names = text_list("feature_names", ["load_lag_24h", "hour"])
    return registry(spark, folder).select(
        "model_id", F.size(names).alias("feature_count"), F.element_at(names, 1).alias("first_feature"),
        text_field("parameters", "rule").alias("rule"), text_field("parameters", "depth").try_cast("int").alias("depth"),
    )


@query("truthy_flags", "model_id:text strict:bool dashboard:bool", """
select model_id, coalesce(lower(trim(is_preferred)) in ('1', 'true', 't', 'yes', 'y'), false) as strict,
  coalesce(lower(trim(is_preferred)) in ('1', 'true', 't', 'yes', 'y', 'on'), false) as dashboard from registry""")
def truthy_flags(spark, folder):
    return registry(spark, folder).select(
        "model_id", truthy("is_preferred").alias("strict"), truthy("is_preferred", TRUE_WORDS_REPORTS).alias("dashboard")
    )


@query("current_champions", REGISTRY, """
select * from normal where is_preferred
qualify row_number() over (partition by horizon_hours order by preferred_at desc nulls last, trained_at desc nulls last, model_id desc) = 1""")
def current_champions(spark, folder):
    return governance.current_champions(governance.normalize_registry(registry(spark, folder)))


_DASHBOARD = """select model_id, model_name, horizon_hours, try_cast(preferred_at as timestamp) as preferred_at, cast(trained_at as timestamp) as trained_at
from registry where lower(trim(is_preferred)) in ('1', 'true', 't', 'yes', 'y', 'on')
qualify row_number() over (partition by horizon_hours order by try_cast(preferred_at as timestamp) desc nulls last, cast(trained_at as timestamp) desc nulls last, model_id desc) = 1"""
part("dashboard_champions", _DASHBOARD)


@query("champion_kpis", "preferred_horizons:int champion_models:int latest_champion_date:day", """
select count(*) as preferred_horizons, count(distinct model_name) as champion_models, cast(coalesce(max(preferred_at), max(trained_at)) as date) as latest_champion_date from dashboard_champions""")
def champion_kpis(spark, folder):
    return reports.champion_kpis(reports.dashboard_champions(registry(spark, folder)))


# --- backtest reports ---------------------------------------------------------------

_AVERAGE_COLUMNS = " ".join(f"average_{m}:num" for m in METRICS)


@query("backtest_summary", "model_id:text model_name:text horizon_hours:int valid_window_count:int " + _AVERAGE_COLUMNS, f"""
select model_id, model_name, horizon_hours, count(distinct window_id) as valid_window_count, {', '.join(f'avg(case when not isnan({m}) then {m} end) as average_{m}' for m in METRICS)}
from trials where isfinite(mae) group by 1, 2, 3""")
def backtest_summary(spark, folder):
    return backtests.backtest_summary(trials(spark, folder))


@query("candidate_summary", "model_id:text valid_window_count:int " + _AVERAGE_COLUMNS, "select *, v as valid_window_count from solo")
def candidate_summary(spark, folder):
    return backtests.candidate_summary(trials(spark, folder))


part("run_trials", "select * from trials where run_id = (select run_id from trials order by evaluated_at desc, run_id desc limit 1)")
part("run_summary", """
select horizon_hours, model_name, count(*) as valid_windows, avg(mae) as average_mae, avg(rmse) as average_rmse,
  avg(peak_period_mae) as average_peak_period_mae, avg(underprediction_rate) as average_underprediction_rate from run_trials group by 1, 2""")
SUMMARY = "horizon_hours:int model_name:text valid_windows:int average_mae:num average_rmse:num average_peak_period_mae:num average_underprediction_rate:num"


@query("eval_backtest_summary", SUMMARY, "run_summary")
def eval_backtest_summary(spark, folder):
    return reports.run_backtest_summary(trials(spark, folder))


@query("best_backtest_models", SUMMARY, "select * from run_summary qualify row_number() over (partition by horizon_hours order by average_mae, model_name) = 1")
def best_backtest_models(spark, folder):
    return reports.best_by(eval_backtest_summary(spark, folder), "average_mae")


@query("latest_runs", "run_id:text evaluated_at:ts", "select run_id, max(evaluated_at) as evaluated_at from trials group by 1")
def latest_runs(spark, folder):
    return reports.latest_runs(trials(spark, folder))


@query("backtest_roles", "horizon_hours:int model_name:text governance_role:text average_metric:num valid_windows:int", """
select t.horizon_hours, t.model_name, case when c.model_id is not null then 'Champion' else 'Challenger' end as governance_role,
  avg(case when not isnan(mae) then mae end) as average_metric, count(case when not isnan(mae) then 1 end) as valid_windows
from trials t left join dashboard_champions c on c.model_id = t.model_id group by 1, 2, 3""")
def backtest_roles(spark, folder):
    champions = reports.dashboard_champions(registry(spark, folder))
    return reports.role_summary(reports.with_roles(trials(spark, folder), champions))


@query("backtest_kpis", "backtest_windows:int models_evaluated:int average_metric:num", """
select count(distinct window_id) as backtest_windows, count(distinct model_name) as models_evaluated, avg(case when not isnan(mae) then mae end) as average_metric from trials""")
def backtest_kpis(spark, folder):
    return reports.backtest_kpis(trials(spark, folder))


@query("holiday_unpivot", "horizon_hours:int model_name:text holiday_group:text mae:num row_count:int", """
select horizon_hours, model_name, holiday_group, avg(mae) as mae, count(*) as row_count from (
  select horizon_hours, model_name, 'Holiday' as holiday_group, mae from trials union all
  select horizon_hours, model_name, 'Non-holiday', rmse from trials) where not isnan(mae) group by 1, 2, 3""")
def holiday_unpivot(spark, folder):
    stored = trials(spark, folder).withColumnsRenamed({"mae": "holiday_mae", "rmse": "non_holiday_mae"})
    return reports.holiday_columns_summary(stored)


# --- promotion ----------------------------------------------------------------------

@query("promotion_compare", "horizon_hours:int champion_model_id:text champion_model_name:text model_id:text model_name:text valid_window_count:int required_window_count:int win_count:int win_rate:num passed:bool reason:text " + " ".join(f"{a}:num" for a in _AVERAGES),
       "select *, broken = '' as passed, case when broken = '' then 'passed all promotion rules' else broken end as reason from compared")
def promotion_compare(spark, folder):
    champions = governance.current_champions(governance.normalize_registry(existing(spark, folder)))
    return governance.compare_challengers(champions, candidates(spark, folder), settle(trials(spark, folder)), RULES)


_DECISION = "decision_id:text run_id:text horizon_hours:int champion_model_id:text champion_model_name:text challenger_model_id:text challenger_model_name:text promoted_model_id:text previous_champion_model_id:text decision:text reason:text valid_window_count:int required_window_count:int win_count:int win_rate:num champion_average_mae:num challenger_average_mae:num champion_average_rmse:num challenger_average_rmse:num champion_average_peak_period_mae:num challenger_average_peak_period_mae:num champion_average_underprediction_rate:num challenger_average_underprediction_rate:num evaluated_at:ts"


@query("promotion_decisions", _DECISION + " detail_windows:text rule_peak:text", "decided")
def promotion_decisions(spark, folder):
    """Decision rows; the two JSON documents are read back for one field each."""
    return decisions(spark, folder).selectExpr(
        "*", "get_json_object(comparison_details, '$.valid_window_count') as detail_windows",
        "get_json_object(rules, '$.max_peak_mae_regression') as rule_peak",
    )


@query("eval_decisions", "horizon_hours:int champion_model_name:text challenger_model_name:text decision:text reason:text valid_window_count:int win_rate:num champion_average_mae:num challenger_average_mae:num champion_average_rmse:num challenger_average_rmse:num", "decided")
def eval_decisions(spark, folder):
    return reports.run_decisions(settle(decisions(spark, folder)))


@query("decision_kpis", "promoted:int rejected:int latest_decision:ts", """
select count(*) filter (where decision = 'promoted') as promoted, count(*) filter (where decision = 'rejected') as rejected, max(evaluated_at) as latest_decision from decided""")
def decision_kpis(spark, folder):
    return reports.decision_kpis(decisions(spark, folder))


@query("registry_apply", "model_id:text horizon_hours:int is_preferred:bool preferred_at:ts retired_at:ts promotion_decision_id:text", """
select n.model_id, n.horizon_hours, case when d.decision_id is not null then true when h.horizon_hours is not null then false else n.is_preferred end as is_preferred,
  case when d.decision_id is not null then timestamp '2024-07-01 00:00:00' else n.preferred_at end as preferred_at,
  case when d.decision_id is null and h.horizon_hours is not null and n.is_preferred then timestamp '2024-07-01 00:00:00' end as retired_at,
  d.decision_id as promotion_decision_id
from normal n left join (select * from decided where decision = 'promoted') d on d.promoted_model_id = n.model_id
left join (select distinct horizon_hours from decided where decision = 'promoted') h on h.horizon_hours = n.horizon_hours""")
def registry_apply(spark, folder):
    made = settle(decisions(spark, folder))
    whole = governance.append_registry(existing(spark, folder), candidates(spark, folder))
    return governance.apply_decisions(whole, made, decided_at())


# --- feature importance reports -------------------------------------------------------

# Parts stand in for features: names cover the three groups, importance is the price share.
_FEATURE_COLUMNS = [
    "cast(p_partkey % 2 * 23 + 1 as int) as horizon_hours",
    "concat('model-', p_partkey % 3) as model_name",
    """case when p_partkey % 5 = 0 then ' Load_Lag_168h' when p_partkey % 5 = 1 then concat('holiday_', p_partkey)
    when p_partkey % 5 = 2 then 'is_workday' when p_partkey % 5 = 3 then 'same_last_week' else concat('part_', p_partkey) end as feature_name""",
    "case when p_partkey % 37 = 0 then null else p_retailprice / 10000 end as importance",
]
part("part_features", f"select {', '.join(_FEATURE_COLUMNS)} from part")
part("tagged", """
select *, case when lower(trim(feature_name)) in ('baseline_same_hour_last_week', 'load_lag_168h', 'load_rolling_168h_avg') or feature_name like '%last_week%' or feature_name like '%168h%' then 'Weekly baseline'
  when feature_name like '%holiday%' or feature_name like '%workday%' or feature_name like '%long_weekend%' then 'Holiday / calendar' else 'Other' end as feature_group from part_features""")
part("top_feats", """
select * from (select *, row_number() over (partition by horizon_hours, model_name order by importance desc, feature_name) as feature_rank
  from tagged where importance is not null) where feature_rank <= 15""")


def importance(spark, folder):
    return raw.table(spark, folder, "part").selectExpr(*_FEATURE_COLUMNS)


@query("feature_groups", "horizon_hours:int model_name:text feature_name:text importance:num feature_group:text", "tagged")
def feature_groups(spark, folder):
    return reports.tagged_features(importance(spark, folder))


@query("top_features", "horizon_hours:int model_name:text feature_name:text importance:num feature_group:text feature_rank:int", "top_feats")
def top_features(spark, folder):
    return reports.top_features(importance(spark, folder))


@query("feature_group_counts", "horizon_hours:int model_name:text feature_group:text features:int", "select horizon_hours, model_name, feature_group, count(*) as features from top_feats group by 1, 2, 3")
def feature_group_counts(spark, folder):
    return reports.feature_group_counts(importance(spark, folder))
