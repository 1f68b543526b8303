"""The registered queries again in plain SQL, written independently of the Spark code."""

from __future__ import annotations

from riskflow import constants as C
from riskflow.plans import testdata

_TX = """
tx as (
  select event_id as txn_id,
         cast(date_diff('day', date '2024-01-01', ts) * 24 + hour(ts) as bigint) as step,
         case event_type when 'view' then 'CASH_IN' when 'purchase' then 'CASH_OUT'
                         when 'error' then 'DEBIT' when 'click' then 'PAYMENT'
                         when 'signup' then 'TRANSFER' end as type,
         value as amount,
         concat('C', cast(user_id as varchar)) as nameOrig,
         concat('M', json_extract_string(props, '$.k')) as nameDest,
         value * 2 as oldbalanceOrg, value as newbalanceOrig,
         0::double as oldbalanceDest, value as newbalanceDest,
         case when event_type in ('signup', 'purchase') and (event_id * 7919) % 100 < 6
              then 1 else 0 end as isFraud,
         case when event_type = 'signup' and value > 200 then 1 else 0 end as isFlaggedFraud
  from events
)"""
_SCORED = f"""{_TX},
scored as (
  select txn_id, step, cast(floor(step / 24) as integer) as day, type, amount, isFraud,
         ((txn_id * 104729) % 600 + 390 * isFraud) / 1000::double as score
  from tx
)"""
_CONTRIB = f"""{_SCORED},
contrib as (
  select s.*, f.feature,
         ((s.txn_id * f.p) % 201 - 100) / 100::double as shap_impact,
         cast(s.amount * f.m as double) as actual_value
  from scored s cross join (values ('amount', 101, 1), ('hour', 103, 2), ('is_night', 107, 3),
    ('avg_amount_24h', 109, 4), ('is_transfer', 113, 5)) f(feature, p, m)
),
drivers as (
  select *, row_number() over (partition by txn_id order by abs(shap_impact) desc, feature) as rank
  from contrib
)"""
_CHECKED = f"""
narratives as (
  select doc_id as txn_id, text as narrative,
         cast((doc_id * 7919) % 60000 as bigint) as latency_ms,
         case when doc_id % 20 = 0 then 'connection refused' end as error
  from documents
),
checked as (
  select *, error is null and not contains(lower(narrative), 'license') as guardrail_passed
  from narratives
)"""
_AUDIT = f"""{_SCORED},{_CHECKED},
audit as (
  select s.txn_id as transaction_index, s.score as risk_score,
         case when s.score >= 0.09 then 'DECLINE' else 'APPROVE' end as decision,
         c.latency_ms as llm_latency_ms, c.guardrail_passed, c.error,
         'xgb_v1.joblib' as model_version, 'paysim_behavior_only_v1' as policy_version,
         'v1.0' as prompt_version
  from scored s join checked c using (txn_id)
)"""
_SWEEP = f"""{_SCORED},
test as (select *, cast(amount as decimal(28, 8)) as money from scored where day >= 26),
loss as (
  select coalesce(cast(sum(money) as double) / count(*), 0) as avg_loss from test where isFraud = 1
),
grid as (select i / 100::double as threshold from range(1, 100) t(i)),
counts as (
  select threshold,
         count(*) filter (where score >= threshold and isFraud = 1) as tp,
         count(*) filter (where score >= threshold and isFraud = 0) as fp,
         count(*) filter (where score < threshold and isFraud = 0) as tn,
         count(*) filter (where score < threshold and isFraud = 1) as fn,
         coalesce(sum(money) filter (where score < threshold and isFraud = 0), 0) as tn_amount,
         coalesce(sum(money) filter (where score < threshold and isFraud = 1), 0) as fn_amount
  from grid cross join test group by threshold
),
sweep as (
  select threshold,
         round(cast(tn_amount * 0.02 - fn_amount - fp * 5.0 as double), 4) + 0.0 as net_profit_tx,
         round(tn * avg_loss * 1.5::double * 0.02::double - fn * avg_loss * 1.5::double - fp * 5.0::double, 4)
           + 0.0 as net_profit_proxy,
         round(cast(tn_amount * 0.02 as double), 4) as revenue_kept_tx,
         round(cast(fn_amount as double), 4) as fraud_losses_tx,
         round(tn * avg_loss * 1.5::double * 0.02::double, 4) as revenue_kept_proxy,
         round(fn * avg_loss * 1.5::double, 4) as fraud_losses_proxy,
         cast(fp * 5.0 as double) as fp_penalties,
         round(100.0::double * (tn + fn) / (tp + fp + tn + fn), 4) as approval_rate_pct,
         round(case when tp + fn > 0 then 100.0::double * tp / (tp + fn) else 0 end, 4) as fraud_caught_pct,
         round(case when tp + fp > 0 then 100.0::double * tp / (tp + fp) else 0 end, 4) as precision_pct,
         fp as good_users_blocked
  from counts cross join loss
)"""


_SKEWED = """
skew as (
  select * replace (case when txn_id % 3 = 0 then 'C0' when txn_id % 50 > 1 then nameOrig end as nameOrig,
                    step * 30 as step)
  from tx
)"""


def _hash(column: str) -> str:
    return f"sha256({column} || '_{C.DEFAULT_SALT}')"


_ROLL = "partition by nameOrig order by step, txn_id rows between 23 preceding and current row"
_HOURS = "partition by nameOrig order by step range between 23 preceding and current row"
_ONE_HOT = ", ".join(
    f"cast(coalesce(type = '{t}', false) as tinyint) as txn_type_{t}" for t in C.TXN_TYPES
)
_TIME = (
    "cast(((step % 24) + 24) % 24 as integer) as hour, cast(floor(step / 24) as integer) as day, "
    "cast(((step % 24) + 24) % 24 between 0 and 5 as integer) as is_night"
)
_FEATURES = f"""{_TX},
rolled as (
  select *, {_TIME}, {_ONE_HOT},
         count(*) over ({_ROLL}) as txn_count_24h, avg(amount) over ({_ROLL}) as mean24,
         step - lag(step) over (partition by nameOrig order by step, txn_id) as gap,
         last_value(case when type = 'TRANSFER' then step end ignore nulls) over (
           partition by nameOrig order by step, txn_id
           rows between unbounded preceding and current row) as last_transfer
  from tx
),
featured as (
  select *, round(mean24, 6) as avg_amount_24h,
         round(amount - mean24, 6) + 0.0 as amount_deviation,
         cast(case when gap is null then 0 when gap > 168 then 168 else gap end as integer)
           as time_since_last_txn_hr,
         round(cast(cast(amount / (mean24 + 1e-6) as float) as double), 4) as amount_ratio_24h,
         txn_type_TRANSFER as is_transfer, txn_type_CASH_OUT as is_cash_out,
         cast(coalesce(step - last_transfer <= 6, false) as tinyint) as transfer_in_last_6h,
         cast(case when step - last_transfer <= 6 and type = 'CASH_OUT' then 1 else 0 end as tinyint)
           as transfer_then_cashout_6h
  from rolled
)"""
_RAW_COLUMNS = (
    "txn_id, step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, "
    "oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud"
)
_SPLIT = "case when day <= 20 then 'train' when day <= 25 then 'val' else 'test' end as split"
_EXPLAINED = (
    "select txn_id as transaction_index, score as predicted_risk_score, "
    "isFraud as actual_is_fraud_label, cast(rank - 1 as integer) as position, feature, "
    "shap_impact, actual_value"
)
_TOP_RISK = "select txn_id, score, isFraud from scored where day >= 26 order by score desc, txn_id limit 200"
_RANKED = f"""{_SCORED},
by_score as (
  select {_SPLIT}, score, sum(isFraud) as pos, count(*) - sum(isFraud) as neg
  from scored group by 1, 2
),
running as (
  select *, sum(pos) over (partition by split order by score desc) as tp,
         sum(neg) over (partition by split order by score desc) as fp,
         sum(pos) over (partition by split) as all_pos, sum(neg) over (partition by split) as all_neg
  from by_score
)"""
_INFERENCE_MODEL = C.MODEL_ARTIFACT.rsplit("/", 1)[-1]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _insight_log() -> str:
    """Results that came more than 30 seconds after their inference count for nothing."""
    return f"""with {_CONTRIB},{_CHECKED},
        tops as (select txn_id, string_agg(feature, ',' order by rank) as top_features
          from drivers where rank <= 5 group by txn_id),
        in_time as (select * from checked where latency_ms <= 30000)
        select sha256(s.txn_id || '|{_INFERENCE_MODEL}|{C.POLICY_NAME}') as request_id,
          1704067200 + s.step * 3600 as timestamp, s.txn_id,
          '{_INFERENCE_MODEL}' as model_version, '{C.POLICY_NAME}' as policy_version,
          s.score as risk_score, top_features,
          case when score >= 0.09 then 'DECLINE' else 'APPROVE' end as recommended_action,
          c.txn_id is not null and c.error is null as insight_generated,
          coalesce(c.guardrail_passed, false) as insight_valid
        from scored s join tops using (txn_id) left join in_time c using (txn_id)"""


def _frozen() -> str:
    """Scores by walking the nodes, and leaves with the interval each feature of their path admits.

    A feature with gaps counts as one: each of its columns sends a missing value its own way."""
    nodes = ", ".join(
        "(" + ", ".join("null" if v is None else _text(v) if isinstance(v, str) else repr(v) for v in row) + ")"
        for row in testdata.frozen_nodes()
    )
    feats = ", ".join(f"({_text(f)}, cast({f} as double))" for f in C.FEATURES_V1 if f != "amount_ratio_24h")
    return f"""recursive {_FEATURES},
gappy as (
  select * replace (case when txn_id % 13 > 0 then amount_ratio_24h end as amount_ratio_24h) from featured
),
nodes as (
  select tree, weight, node, replace(replace(feature, '__low', ''), '__high', '') as feature,
         case when feature like '%__low' then -8e307::double when feature like '%__high' then 8e307::double
              else 'infinity'::double end as gap,
         threshold, lo, hi, prediction, cover
  from (values {nodes}) n(tree, weight, node, feature, threshold, lo, hi, prediction, cover)
),
vals as (
  select txn_id, day, f.feature, f.value
  from gappy, lateral (values {feats}, ('amount_ratio_24h', amount_ratio_24h)) f(feature, value)
),
walk as (
  select g.txn_id, n.tree, n.node, n.feature, n.threshold, n.gap, n.lo, n.hi, n.weight * n.prediction as value
  from gappy g cross join nodes n where n.node = 0
  union all
  select w.txn_id, n.tree, n.node, n.feature, n.threshold, n.gap, n.lo, n.hi, n.weight * n.prediction
  from walk w join vals v on v.txn_id = w.txn_id and v.feature = w.feature
  join nodes n on n.tree = w.tree
    and n.node = case when coalesce(v.value, w.gap) <= w.threshold then w.lo else w.hi end
),
frozen as (
  select txn_id, any_value(day) as day, any_value(isFraud) as isFraud,
         1 / (1 + exp(-2 * sum(value))) as score
  from walk join gappy using (txn_id) where lo < 0 group by txn_id
),
paths as (
  select tree, node, 2 * weight * prediction as value, lo as l, hi as h, feature as f, threshold as t, gap as g,
         cover, cast([] as struct(feature varchar, low double, high double, gone boolean, share double)[]) as path
  from nodes where node = 0
  union all
  select n.tree, n.node, 2 * n.weight * n.prediction, n.lo, n.hi, n.feature, n.threshold, n.gap, n.cover,
         list_append(p.path, case when n.node = p.l
           then row(p.f, '-infinity'::double, p.t, p.g <= p.t, n.cover / p.cover)
           else row(p.f, p.t, 'infinity'::double, p.g > p.t, n.cover / p.cover) end)
  from paths p join nodes n on n.tree = p.tree and n.node in (p.l, p.h)
),
steps as (
  select tree, node, value, s.feature as feature, max(s.low) as low, min(s.high) as high,
         bool_and(s.gone) as gone, product(s.share) as share
  from (select tree, node, value, unnest(path) as s from paths where l < 0) group by 1, 2, 3, 4
),
leaves as (
  select *, row_number() over (partition by tree, node order by feature) - 1 as place,
         count(*) over (partition by tree, node) as m
  from steps
),
base as (
  select sum(value * share) as base_value from
    (select tree, node, any_value(value) as value, product(share) as share from steps group by 1, 2)
)"""


_FROZEN_DRIVERS = """,
admitted as (
  select v.txn_id, l.*, case when v.value is null then l.gone else v.value > l.low and v.value <= l.high end as ok
  from leaves l join vals v using (feature) where v.day >= 26
),
subsets as (
  select a.txn_id, a.tree, a.node, any_value(a.value) as value, any_value(a.m) as m, s.bits,
         product(case when (s.bits >> a.place) & 1 = 1 then (case when a.ok then 1.0 else 0.0 end) else a.share end) as worth
  from admitted a join range(0, 16) s(bits) on s.bits < (1 << a.m) group by a.txn_id, a.tree, a.node, s.bits
),
shares as (
  select a.txn_id, a.feature,
         sum(a.value * (w.worth - o.worth) * gamma(bit_count(o.bits) + 1) * gamma(a.m - bit_count(o.bits)) / gamma(a.m + 1)) as impact
  from admitted a
  join subsets o on (o.txn_id, o.tree, o.node) = (a.txn_id, a.tree, a.node) and (o.bits >> a.place) & 1 = 0
  join subsets w on (w.txn_id, w.tree, w.node) = (a.txn_id, a.tree, a.node) and w.bits = o.bits + (1 << a.place)
  group by 1, 2
),
impacts as (
  select v.txn_id, v.feature, round(coalesce(s.impact, 0), 9) + 0.0 as shap_impact
  from vals v left join shares s using (txn_id, feature) where v.day >= 26
)"""


def _frozen_metrics() -> str:
    """Ranks by counting: the area under the curve from midranks, precision from running counts."""
    return f"""with {_frozen()},
        ranked as (select {_SPLIT}, * from frozen),
        by_score as (select split, score, sum(isFraud) as pos, count(*) - sum(isFraud) as neg
          from ranked group by 1, 2),
        running as (
          select *, sum(pos) over up as tp, sum(neg) over up as fp,
                 sum(pos) over (partition by split) as p, sum(neg) over (partition by split) as n
          from by_score window up as (partition by split order by score desc)),
        figures as (
          select split, round(sum(neg * (tp - pos / 2.0::double)) / any_value(p * n), 9) as roc,
                 round(sum(pos * tp / (tp + fp)::double) / any_value(p), 9) as pr, sum(pos + neg) as rows_
          from running group by split)
        select max(roc) filter (where split = 'val') as val_auc_roc,
          max(pr) filter (where split = 'val') as val_auc_pr,
          max(roc) filter (where split = 'test') as test_auc_roc,
          max(pr) filter (where split = 'test') as test_auc_pr,
          {len(testdata.FROZEN_TREES) - 1} as best_iteration, {C.POS_WEIGHT!r}::double as scale_pos_weight,
          cast(max(rows_) filter (where split = 'train') as bigint) as n_train,
          cast(max(rows_) filter (where split = 'val') as bigint) as n_val,
          cast(max(rows_) filter (where split = 'test') as bigint) as n_test,
          17 as feature_count
        from figures"""


_DIRTY = """
dirty as (
  select * replace (
    case when txn_id % 19 = 0 then -amount - 1 when txn_id % 23 = 0 then 'nan'::double
         when txn_id % 29 = 0 then null else amount end as amount,
    case when txn_id % 31 = 0 then 2 when txn_id % 37 = 0 then null else isFraud end as isFraud,
    case when txn_id % 41 = 0 then -1 - step when txn_id % 43 = 0 then null else step end as step,
    case when txn_id % 47 = 0 then 'OTHER' when txn_id % 53 = 0 then null else type end as type,
    case when txn_id % 59 > 0 then nameOrig end as nameOrig,
    case when txn_id % 61 > 0 then nameDest end as nameDest)
  from tx
)"""


def _dq_report(views: str, source: str) -> str:
    return f"""with {views},
            n as (select count(*) as total,
              count(*) filter (where amount < 0 or isnan(amount)) as negative_amount,
              count(*) filter (where amount is null) as null_amount,
              count(*) filter (where isFraud not in (0, 1)) as invalid_label,
              count(*) filter (where step < 0) as negative_step,
              count(*) filter (where step is null) as null_step,
              count(*) filter (where type is null or type not in
                ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')) as unknown_type,
              count(*) filter (where nameOrig is null) as null_origin,
              count(*) filter (where nameDest is null) as null_target
              from {source})
            select check_name, violations, total as "rows" from
              (unpivot n on columns(* exclude (total)) into name check_name value violations)"""


def all_sql() -> dict[str, str]:
    return {
        "src_csv_roundtrip": f"with {_TX} select {_RAW_COLUMNS} from tx",
        "src_parquet_roundtrip": f"with {_TX} select {_RAW_COLUMNS}, {_TIME} from tx",
        "test_window_scan": f"with {_SCORED} select txn_id, day, amount, score from scored where day >= 26",
        "sweep_csv_roundtrip": f"with {_SWEEP} select * from sweep",
        "explanations_json": f"with {_CONTRIB} {_EXPLAINED} from drivers where rank <= 5",
        "stage_report": "select 'processed' as stage, count(*) as row_count, 18 as column_count from events",
        "dq_report": _dq_report(_TX, "tx"),
        "column_report": f"""with {_TX} select c as column_name, c <> 'nameDest' as present,
            case when c not in ('nameDest', 'type') then n else 0 end as known, n as "rows"
            from (values {', '.join(f'({_text(c)})' for c in C.REQUIRED_COLUMNS)}) r(c)
            cross join (select count(*) as n from tx)""",
        "dq_report_dirty": _dq_report(f"{_TX},{_DIRTY}", "dirty"),
        "type_report": f"""with {_TX} select unnest(['amount', 'step', 'isFraud']) as column_name,
            unnest([count(*) filter (where txn_id % 17 = 0), count(*) filter (where txn_id % 13 = 0),
              count(*) filter (where txn_id % 11 = 0)]) as failed from tx
            union all select c, 0 from (values ('txn_id'), ('oldbalanceOrg'), ('newbalanceOrig'),
              ('oldbalanceDest'), ('newbalanceDest'), ('isFlaggedFraud')) z(c)""",
        "quarantine": f"""with {_TX} select txn_id, concat_ws(',', case when txn_id % 17 = 0 then 'amount' end,
              case when txn_id % 11 = 0 then 'isFraud' end, case when txn_id % 13 = 0 then 'step' end) as misfits
            from tx where txn_id % 17 = 0 or txn_id % 13 = 0 or txn_id % 11 = 0""",
        "split_sanity": f"""with {_SCORED} select {_SPLIT}, count(*) as total,
            cast(sum(isFraud) as bigint) as frauds,
            round(100 * sum(isFraud) / count(*)::double, 6) as fraud_rate_pct
            from scored group by 1""",
        "preprocess": f"""with {_FEATURES} select txn_id, step, {', '.join(f'txn_type_{t}' for t in C.TXN_TYPES)},
            amount, isFraud, isFlaggedFraud, {_hash('nameOrig')} as account_id,
            {_hash('nameDest')} as counterparty_id, hour, day, is_night, txn_count_24h,
            avg_amount_24h, amount_deviation from featured""",
        "hash_ids": f"""with {_TX} select txn_id, {_hash('nameOrig')} as account_id,
            {_hash('nameDest')} as counterparty_id from tx""",
        "identifier_map": f"""with {_TX}, names as (select nameOrig as name from tx union select nameDest from tx)
            select name, {_hash('name')} as hashed_id from names where name is not null""",
        "identifier_join": f"""with {_TX},
            names as (select nameOrig as name from tx union select nameDest from tx),
            ids as (select name, {_hash('name')} as hashed_id from names)
            select txn_id, a.hashed_id as account_id, b.hashed_id as counterparty_id
            from tx left join ids a on nameOrig = a.name left join ids b on nameDest = b.name""",
        "time_features": f"with {_TX} select txn_id, step, {_TIME} from tx",
        "one_hot_types": f"with {_TX} select txn_id, {_ONE_HOT} from tx",
        "rolling_features": f"""with {_FEATURES} select txn_id, txn_count_24h, avg_amount_24h,
            amount_deviation from featured""",
        "rolling_features_hours": f"""with {_TX},
            rolled as (select txn_id, amount, count(*) over ({_HOURS}) as txn_count_24h,
              avg(amount) over ({_HOURS}) as mean24 from tx)
            select txn_id, txn_count_24h, round(mean24, 6) as avg_amount_24h,
              round(amount - mean24, 6) + 0.0 as amount_deviation from rolled""",
        "behavior_features": f"""with {_FEATURES} select txn_id, time_since_last_txn_hr,
            amount_ratio_24h, is_transfer, is_cash_out from featured""",
        "sequence_features": f"""with {_FEATURES} select txn_id, {_hash('nameOrig')} as account_id, step,
            transfer_in_last_6h, transfer_then_cashout_6h from featured""",
        "rolling_features_skewed": f"""with {_TX},{_SKEWED},
            rolled as (select txn_id, amount, count(*) over ({_ROLL}) as txn_count_24h,
              avg(amount) over ({_ROLL}) as mean24 from skew)
            select txn_id, txn_count_24h, round(mean24, 6) as avg_amount_24h,
              round(amount - mean24, 6) + 0.0 as amount_deviation from rolled""",
        "rolling_features_hours_skewed": f"""with {_TX},{_SKEWED},
            rolled as (select txn_id, amount, count(*) over ({_HOURS}) as txn_count_24h,
              avg(amount) over ({_HOURS}) as mean24 from skew)
            select txn_id, txn_count_24h, round(mean24, 6) as avg_amount_24h,
              round(amount - mean24, 6) + 0.0 as amount_deviation from rolled""",
        "sequence_features_skewed": f"""with {_FEATURES.replace("  from tx\n", "  from skew\n").replace("rolled as", _SKEWED.strip() + ",\nrolled as", 1)}
            select txn_id, step, time_since_last_txn_hr, transfer_in_last_6h, transfer_then_cashout_6h
            from featured""",
        "feature_matrix": f"""with {_FEATURES} select txn_id, day, isFraud, {', '.join(C.FEATURES_V1)}
            from featured""",
        "time_split": f"with {_SCORED} select txn_id, day, {_SPLIT} from scored",
        "class_balance": f"""with {_SCORED} select cast(sum(isFraud) as bigint) as pos,
            cast(count(*) - sum(isFraud) as bigint) as neg,
            round((count(*) - sum(isFraud)) / greatest(sum(isFraud), 1)::double, 6) as neg_per_pos
            from scored where day <= 20""",
        "avg_fraud_loss": f"""with {_SCORED} select
            round(coalesce(cast(sum(cast(amount as decimal(28, 8))) as double) / count(*), 0), 6) + 0.0
              as avg_fraud_loss
            from scored where day >= 26 and isFraud = 1""",
        "threshold_confusion": f"""with {_SCORED},
            grid as (select i / 100::double as threshold from range(1, 100) t(i))
            select threshold,
              count(*) filter (where score >= threshold and isFraud = 1) as tp,
              count(*) filter (where score >= threshold and isFraud = 0) as fp,
              count(*) filter (where score < threshold and isFraud = 0) as tn,
              count(*) filter (where score < threshold and isFraud = 1) as fn
            from grid cross join scored group by threshold""",
        "threshold_sweep": f"with {_SWEEP} select * from sweep",
        "optimal_threshold": f"with {_SWEEP} select * from sweep order by net_profit_tx desc, threshold limit 1",
        "top5_thresholds_tx": f"with {_SWEEP} select * from sweep order by net_profit_tx desc, threshold limit 5",
        "top5_thresholds_proxy": f"""with {_SWEEP} select * from sweep
            order by net_profit_proxy desc, threshold limit 5""",
        "fp_fn_curve": f"""with {_SWEEP} select threshold, fp as good_users_blocked,
            fn as fraud_missed from counts""",
        "econ_assumptions": f"""with {_SWEEP} select 0.02::double as MARGIN_RATE, 5.0::double as REVIEW_COST,
            true as USE_TRANSACTION_AMOUNTS, round(max(avg_loss), 6) + 0.0 as AVG_FRAUD_LOSS,
            1.5::double as FRAUD_MULTIPLIER, {_text(C.MODEL_ARTIFACT)} as model_artifact,
            {_text(','.join(C.FEATURES_V1))} as feature_set, 'day >= 26' as test_window,
            count(*) as num_test_transactions from test cross join loss""",
        "roc_auc": f"""with {_SCORED},
            ranked as (select {_SPLIT}, isFraud,
              rank() over (partition by {_SPLIT.removesuffix(' as split')} order by score)
                + (count(*) over (partition by {_SPLIT.removesuffix(' as split')}, score) - 1) / 2.0::double as r
              from scored)
            select split, round(
              (sum(r) filter (where isFraud = 1) - sum(isFraud) * (sum(isFraud) + 1) / 2.0::double)
              / nullif(sum(isFraud) * (count(*) - sum(isFraud)), 0)::double, 9) as roc_auc
            from ranked group by split""",
        "average_precision": f"""with {_RANKED} select split,
            round(coalesce(sum(pos * tp / (tp + fp)::double) / nullif(max(all_pos), 0)::double, 0), 9)
              as average_precision
            from running group by split""",
        "policy_decisions": f"""with {_SWEEP},
            policies as (
              select 'paysim_behavior_only_v1' as policy_version, 0.09::double as threshold
              union all
              (select 'net_value_v1', threshold from sweep order by net_profit_tx desc, threshold limit 1))
            select txn_id, score, policy_version, threshold,
              case when score >= threshold then 'DECLINE' else 'APPROVE' end as decision
            from scored cross join policies""",
        "decision_report": f"""with {_SCORED} select txn_id,
            'TXN-' || txn_id || ' (Score: ' || printf('%.2f', score) || ')' as queue_label,
            case when score >= 0.09 then 'DECLINE' else 'APPROVE' end as decision,
            printf('%.3f', score) as score_text,
            case when score >= 0.09 then printf('%.3f', score - 0.09::double) || ' over threshold'
                 else printf('%.3f', 0.09::double - score) || ' under threshold' end as distance_text,
            case when isFraud = 1 then 'Fraudulent' else 'Legitimate' end as ground_truth
            from scored""",
        "freeze_policy": f"""with {_SWEEP} select {_text(C.POLICY_NAME)} as policy_name,
            {_text(C.MODEL_ARTIFACT)} as model_artifact, threshold, 'DECLINE' as block_label,
            'APPROVE' as allow_label, {_text(C.POLICY_NOTES)} as notes
            from sweep order by net_profit_tx desc, threshold limit 1""",
        "inference_log": f"""with {_CONTRIB},
            tops as (select txn_id, string_agg(feature, ',' order by rank) as top_features
              from drivers where rank <= 5 group by txn_id)
            select sha256(s.txn_id || '|{_INFERENCE_MODEL}|{C.POLICY_NAME}') as request_id,
              true as timestamp, s.txn_id, '{_INFERENCE_MODEL}' as model_version,
              '{C.POLICY_NAME}' as policy_version, s.score as risk_score, top_features,
              case when score >= 0.09 then 'DECLINE'
                   when score >= 0.09::double - 0.04::double then 'REVIEW'
                   else 'APPROVE' end as recommended_action,
              false as insight_generated, false as insight_valid
            from scored s join tops using (txn_id)""",
        "inference_insights": _insight_log(),
        "inference_insights_stream": _insight_log(),
        "frozen_score": f"""with {_frozen()} select txn_id, day, isFraud, round(score, 9) as score from frozen""",
        "frozen_contributions": f"""with {_frozen()}{_FROZEN_DRIVERS}
            select txn_id, round(base_value, 9) as base_value, feature, shap_impact from impacts cross join base""",
        "frozen_top_drivers": f"""with {_frozen()}{_FROZEN_DRIVERS},
            ordered as (select *, cast(row_number() over (
              partition by txn_id order by abs(shap_impact) desc, feature) as integer) as rank from impacts)
            select txn_id, rank, feature, shap_impact,
              case when shap_impact > 0 then 'up' when shap_impact < 0 then 'down' else 'none' end as direction
            from ordered where rank <= 5""",
        "frozen_importance": f"""with {_frozen()}{_FROZEN_DRIVERS}
            select feature, round(avg(abs(shap_impact)), 9) as mean_abs_shap
            from impacts group by feature order by 2 desc, 1 limit 20""",
        "frozen_metrics": _frozen_metrics(),
        "top_risk": f"with {_SCORED} {_TOP_RISK}",
        "explain_sample": f"""with {_SCORED},
            risky as (select txn_id, score from scored where day >= 26 order by score desc, txn_id limit 200),
            drawn as (select txn_id, score from scored where day >= 26 order by md5(txn_id || '_42'), txn_id limit 2000)
            select * from risky union select * from drawn""",
        "top_drivers": f"""with {_CONTRIB} select txn_id, cast(rank as integer) as rank, feature,
            shap_impact, actual_value,
            case when shap_impact > 0 then 'up' when shap_impact < 0 then 'down' else 'none' end as direction
            from drivers where rank <= 5 and score >= 0.09""",
        "explanations": f"""with {_CONTRIB}, queue as ({_TOP_RISK})
            {_EXPLAINED} from drivers where rank <= 5 and txn_id in (select txn_id from queue)""",
        "global_importance": f"""with {_CONTRIB} select feature,
            round(avg(abs(shap_impact)), 9) as mean_abs_shap from contrib group by feature
            order by 2 desc, 1 limit 20""",
        "riskiest_txn": f"""with {_CONTRIB} {_EXPLAINED} from drivers where rank <= 5 and
            txn_id = (select txn_id from scored order by score desc, txn_id limit 1)""",
        "driver_table": f"""with {_CONTRIB} select txn_id as transaction_index,
            cast(row_number() over (partition by txn_id order by shap_impact, feature) - 1 as integer) as position,
            feature, shap_impact, actual_value, printf('%.2f', shap_impact) as shap_text,
            printf('%.2f', actual_value) as value_text from drivers where rank <= 5""",
        "queue_summary": f"""with {_SCORED}, queue as ({_TOP_RISK}) select count(*) as queue_size,
            round(coalesce(avg(score), 0), 9) as avg_risk_score from queue""",
        "render_prompts": f"""with {_CONTRIB}, lines as (
              select txn_id, any_value(score) as score,
                string_agg('- ' || feature || ': actual value is ' || printf('%.2f', actual_value)
                  || ' (SHAP Risk Impact: ' || printf('%.2f', shap_impact) || ')', chr(10) order by rank)
                  as text
              from drivers where rank <= 5 group by txn_id),
            decided as (select *, case when score >= 0.09 then 'DECLINE' else 'APPROVE' end as decision from lines)
            select txn_id as transaction_index, decision,
              {_text(C.PROMPT_HEAD)} || decision || {_text(C.PROMPT_SCORE)} || printf('%.2f', score)
              || {_text(C.PROMPT_DRIVERS)} || text || {_text(C.PROMPT_TAIL)} as prompt
            from decided""",
        "guardrail_check": f"""with {_CHECKED} select txn_id,
            case when error is not null then {_text(C.CONNECTION_MESSAGE)}
                 when guardrail_passed then trim(narrative, {_text(C.STRIP_CHARS)})
                 else {_text(C.GUARDRAIL_MESSAGE)} end as narrative,
            latency_ms, guardrail_passed, error,
            case when error is null and not guardrail_passed then 'license' else '' end as violations
            from checked""",
        "guardrail_terms": f"""with {_CHECKED},
            told as (select txn_id, latency_ms, error,
              trim(narrative || ' ' || ([{', '.join(_text(t) for t in testdata.GUARDED_TEXTS)}])[
                txn_id % {len(testdata.GUARDED_TEXTS)} + 1], {_text(C.STRIP_CHARS)}) as body from narratives),
            found as (select *, list_filter([{', '.join(_text(t) for t in C.FORBIDDEN_TERMS)}],
              lambda term : error is null and contains(lower(body), term)) as terms from told)
            select txn_id, case when error is not null then {_text(C.CONNECTION_MESSAGE)}
                when len(terms) = 0 then body else {_text(C.GUARDRAIL_MESSAGE)} end as narrative,
              latency_ms, error is null and len(terms) = 0 as guardrail_passed, error,
              array_to_string(terms, ',') as violations from found""",
        "audit_records": f"with {_AUDIT} select *, true as timestamp from audit",
        "audit_stream": f"with {_AUDIT} select *, true as timestamp from audit",
        "audit_telemetry": f"""with {_AUDIT} select model_version, policy_version, prompt_version,
            count(*) as generations, count(error) as errors,
            count(*) filter (where guardrail_passed) as passed,
            count(*) filter (where error is null and not guardrail_passed) as guardrail_failures,
            round(100.0::double * count(*) filter (where guardrail_passed)
              / count(*) filter (where error is null), 6) as pass_rate_pct,
            round(avg(llm_latency_ms) filter (where error is null), 6) as avg_latency_ms,
            min(llm_latency_ms) filter (where error is null) as min_latency_ms,
            max(llm_latency_ms) filter (where error is null) as max_latency_ms,
            cast(quantile_cont(llm_latency_ms, 0.5) filter (where error is null) as double) as median_latency_ms
            from audit group by 1, 2, 3""",
    }
