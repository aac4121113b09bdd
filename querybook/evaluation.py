"""Classifier evaluation, splits, samples, scenario comparison, run history."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadpulse.functions.risk import infer_severity
from roadpulse.operators import evaluate as ev
from roadpulse.operators import features, keyed, sampling, scenarios
from roadpulse.operators.backfill import backfill_candidates, backfill_updates
from roadpulse.schemas import MODEL_FEATURES
from roadpulse.session import shared_folder
from roadpulse.sources import files

from . import views as v
from .cleaning import HEURISTIC_CLASS
from .registry import Registry

query = Registry()
A, P = "true_severity", "predicted_severity"

PAIRS = """
pairs as (select true_severity as a, cast(predicted_severity as int) as p, count(*) as n from replay
  where predicted_severity is not null group by 1, 2),
labels_ as (select a as c from pairs union select p from pairs),
sums as (select c, coalesce((select sum(n) from pairs where a = c), 0) as support,
  coalesce((select sum(n) from pairs where p = c), 0) as said,
  coalesce((select sum(n) from pairs where a = c and p = c), 0) as tp, (select sum(n) from pairs) as total from labels_),
report as (select *, case when said = 0 then 0e0 else tp::double / said end as prec, case when support = 0 then 0e0 else tp::double / support end as rec,
  case when total = support then 0e0 else (total - support - (said - tp))::double / (total - support) end as spec from sums),
scored as (select *, case when prec + rec = 0 then 0e0 else 2 * prec * rec / (prec + rec) end as f from report)"""


def _r(df, *columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _evaluated(spark, sf_dir):
    return v.replay(spark, sf_dir).where("predicted_severity is not null")


@query(
    "class_factors",
    v.with_views(
        ["features"],
        """
select true_severity as class_label, count(*) as class_count,
  round(least(max(count(*)) over () / count(*), 100e0), 6) as factor from features group by 1""",
    ),
)
def class_factors(spark, sf_dir):
    return ev.class_factors(v.feature_table(spark, sf_dir), A)


@query(
    "label_set",
    v.with_views(["replay"], f"with {PAIRS} select c as class_label from labels_"),
)
def label_set(spark, sf_dir):
    return ev.label_set(_evaluated(spark, sf_dir), A, P)


@query(
    "confusion",
    v.with_views(
        ["replay"],
        f"""
with {PAIRS}
select c as actual, {', '.join(f"cast(coalesce(sum(n) filter (where p = {k}), 0) as bigint) as predicted_{k}" for k in (1, 2, 3, 4))}
from (select unnest([1, 2, 3, 4]) as c) left join pairs on a = c group by c""",
    ),
)
def confusion(spark, sf_dir):
    return ev.confusion(_evaluated(spark, sf_dir), A, P, [1, 2, 3, 4])


@query(
    "class_report",
    v.with_views(
        ["replay"],
        f"""
with {PAIRS}
select c as class_label, round(prec, 9) as precision, round(rec, 9) as recall, round(spec, 9) as specificity, round(f, 9) as f1,
  cast(support as bigint) as support, cast(said as bigint) as predicted, cast(tp as bigint) as tp from scored""",
    ),
)
def class_report(spark, sf_dir):
    return _r(ev.class_report(_evaluated(spark, sf_dir), A, P), "precision", "recall", "specificity", "f1")


@query(
    "binary_report",
    """
with s as (select quality as a, toxic as p, count(*) as n from labels group by 1, 2)
select c as class_label, cast(coalesce(sum(n) filter (where a = c), 0) as bigint) as support,
  cast(coalesce(sum(n) filter (where p = c), 0) as bigint) as predicted,
  cast(coalesce(sum(n) filter (where a = c and p = c), 0) as bigint) as tp
from s, (select unnest([0, 1]) as c) group by c""",
)
def binary_report(spark, sf_dir):
    report = ev.class_report(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", "toxic")
    return report.select("class_label", "support", "predicted", "tp")


@query(
    "scalar_metrics",
    v.with_views(
        ["replay"],
        f"""
with {PAIRS}
select round(sum(tp)::double / sum(support), 9) as accuracy, round(avg(prec), 9) as macro_precision, round(avg(rec), 9) as macro_recall,
  round(avg(f), 9) as macro_f1, round(avg(spec), 9) as macro_specificity, round(sum(prec * support) / sum(support), 9) as weighted_precision,
  round(sum(rec * support) / sum(support), 9) as weighted_recall, round(sum(f * support) / sum(support), 9) as weighted_f1,
  round(sum(spec * support) / sum(support), 9) as weighted_specificity from scored""",
    ),
)
def scalar_metrics(spark, sf_dir):
    out = ev.scalar_metrics(_evaluated(spark, sf_dir), A, P)
    return _r(out, *out.columns)


@query(
    "agreement_metrics",
    v.with_views(
        ["replay"],
        f"""
with {PAIRS},
t as (select sum(support)::double as n, sum(tp)::double as hits, sum(support::double * said) as x, sum(support::double * support) as a2,
  sum(said::double * said) as p2, avg(rec) filter (where support > 0) as bal, 1 - avg(rec) as err from scored)
select round(bal, 9) as balanced_accuracy, round(err, 9) as mean_per_class_error,
  round((hits / n - x / (n * n)) / (1 - x / (n * n)), 9) as cohen_kappa,
  round((hits * n - x) / (sqrt(n * n - p2) * sqrt(n * n - a2)), 9) as matthews_corrcoef from t""",
    ),
)
def agreement_metrics(spark, sf_dir):
    out = ev.agreement_metrics(_evaluated(spark, sf_dir), A, P)
    return _r(out, *out.columns)


@query(
    "ordinal_metrics",
    v.with_views(
        ["replay"],
        """
select round(avg((a - p) * (a - p)), 9) as mse, round(sqrt(avg((a - p) * (a - p))), 9) as rmse, round(avg(abs(a - p)), 9) as mae,
  round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)), 9) as r2, round(sqrt(avg(power(ln(1 + a) - ln(1 + p), 2))), 9) as rmsle
from (select true_severity::double as a, predicted_severity::double as p from replay where predicted_severity is not null)""",
    ),
)
def ordinal_metrics(spark, sf_dir):
    out = ev.ordinal_metrics(_evaluated(spark, sf_dir), A, P)
    return _r(out, *out.columns)


PROBA_SQL = """
proba as (select true_severity as a, w1 / (w1 + w2 + w3 + w4) as p1, w2 / (w1 + w2 + w3 + w4) as p2, w3 / (w1 + w2 + w3 + w4) as p3,
    w4 / (w1 + w2 + w3 + w4) as p4 from (
  select true_severity, 1e0 + k % 7 as w1, 1e0 + k % 11 + case when true_severity = 2 then 4 else 0 end as w2,
    1e0 + k % 5 + case when true_severity = 3 then 2 else 0 end as w3, 1e0 + k % 3 as w4 from features)),
ranked as (
  select c, a = c as pos, rank() over (partition by c order by s) + (count(*) over (partition by c, s) - 1) / 2e0 as r from (
    select 1 as c, a, p1 as s from proba union all select 2, a, p2 from proba union all select 3, a, p3 from proba
    union all select 4, a, p4 from proba)),
aucs as (select c, count(*) filter (where pos) as np, count(*) filter (where not pos) as nn,
  (sum(r) filter (where pos) - count(*) filter (where pos) * (count(*) filter (where pos) + 1) / 2e0)
    / (count(*) filter (where pos) * (count(*) filter (where not pos))::double) as auc from ranked group by c)"""


def probabilities(spark, sf_dir):
    """Feature rows with made class probabilities that lean towards the true class."""
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    lean = lambda c, w: F.when(F.col(A) == c, F.lit(w)).otherwise(F.lit(0))
    rows = v.feature_table(spark, sf_dir).select(
        "event_id", A, (F.lit(1.0) + k % 7).alias("w1"), (F.lit(1.0) + k % 11 + lean(2, 4)).alias("w2"),
        (F.lit(1.0) + k % 5 + lean(3, 2)).alias("w3"), (F.lit(1.0) + k % 3).alias("w4"),
    )
    total = F.col("w1") + F.col("w2") + F.col("w3") + F.col("w4")
    return rows.select("event_id", A, *[(F.col(f"w{c}") / total).alias(f"p{c}") for c in (1, 2, 3, 4)])


COLUMNS = {c: f"p{c}" for c in (1, 2, 3, 4)}


@query(
    "proba_metrics",
    v.with_views(
        ["features"],
        f"""
with {PROBA_SQL},
g as (select avg(auc) as m, sum(auc * np) / sum(np) as w from aucs)
select round((select avg(-ln(case a when 1 then p1 when 2 then p2 when 3 then p3 else p4 end)) from proba), 9) as logloss,
  round(m, 9) as auc_macro_ovr, round(w, 9) as auc_weighted_ovr, round(2 * m - 1, 9) as gini_macro_ovr, round(2 * w - 1, 9) as gini_weighted_ovr
from g""",
    ),
)
def proba_metrics(spark, sf_dir):
    out = ev.proba_metrics(probabilities(spark, sf_dir), A, COLUMNS)
    return _r(out, *out.columns)


@query(
    "class_auc",
    v.with_views(
        ["features"], f"with {PROBA_SQL} select c as class_label, round(auc, 9) as auc, np as support from aucs"
    ),
)
def class_auc(spark, sf_dir):
    return _r(ev.class_auc(probabilities(spark, sf_dir), A, COLUMNS), "auc")


HASH = "('0x' || substr(md5(event_id), 1, 8))::BIGINT"


@query(
    "hash_split",
    v.with_views(
        ["features"],
        f"select event_id, case when {HASH} % 100 < 80 then 'train' else 'test' end as side from features",
    ),
)
def hash_split(spark, sf_dir):
    train, test = sampling.hash_split(v.feature_table(spark, sf_dir).select("event_id"), "event_id", 80)
    return train.withColumn("side", F.lit("train")).union(test.withColumn("side", F.lit("test")))


@query(
    "temporal_split",
    v.with_views(
        ["features"],
        f"select case when event_year < {v.SPLIT_YEAR} then 'before' else 'after' end as side, count(*) as n from features group by 1",
    ),
)
def temporal_split(spark, sf_dir):
    before, after = sampling.temporal_split(v.feature_table(spark, sf_dir), v.SPLIT_YEAR)
    count = lambda df, side: df.agg(F.count("*").alias("n")).withColumn("side", F.lit(side))
    return count(before, "before").unionByName(count(after, "after"))


@query(
    "stratified_cap",
    v.with_views(
        ["features"],
        f"""
with n as (select true_severity as c, count(*) as n, count(*) * 3000e0 / sum(count(*)) over () as e from features group by 1),
q as (select c, case when sum(n) over () <= 3000 then n else floor(e) + cast(row_number() over (order by round(e - floor(e), 9) desc, c)
  <= 3000 - sum(floor(e)) over () as int) end as quota from n)
select event_id, true_severity from features join q on true_severity = c
qualify row_number() over (partition by true_severity order by {HASH}, event_id) <= quota""",
    ),
)
def stratified_cap(spark, sf_dir):
    rows = v.feature_table(spark, sf_dir).select("event_id", A)
    return sampling.stratified_cap(rows, A, "event_id", 3000)


@query(
    "sample_per_period",
    v.with_views(
        ["features"],
        f"""
select event_id, period from (
  select event_id, case when event_year < {v.SPLIT_YEAR} then 'before' else 'after' end as period from features)
qualify row_number() over (partition by period order by {HASH}, event_id) <= 500""",
    ),
)
def sample_per_period(spark, sf_dir):
    period = F.when(F.col("event_year") < v.SPLIT_YEAR, F.lit("before")).otherwise(F.lit("after"))
    rows = v.feature_table(spark, sf_dir).select("event_id", period.alias("period"))
    return sampling.sample_per_group(rows, "period", "event_id", 500)


CANDIDATE = """(predicted_severity is null or coalesce(model_status, '') <> 'ok' or risk_score is null or risk_score < 0)
  and coalesce(model_status, '') <> 'backfill_failed'"""


@query(
    "backfill_candidates",
    v.with_views(
        ["replay"],
        f"select event_id, risk_score, model_status from replay where {CANDIDATE} order by processed_time nulls last, event_id limit 500",
    ),
)
def candidates(spark, sf_dir):
    table = v.replay(spark, sf_dir).withColumn("created_at", F.col("processed_time"))
    return backfill_candidates(table, 500).select("event_id", "risk_score", "model_status")


@query(
    "backfill",
    v.with_views(
        ["replay"],
        f"""
with c as (select event_id as e, case when k % 3 = 0 then null else 1 + k % 4 end as s from replay where {CANDIDATE})
select event_id, cast(case when e is not null then s else predicted_severity end as int) as predicted_severity,
  case when e is not null then {v.write_risk_sql('coalesce(s, true_severity)')} else risk_score end as risk_score,
  case when e is not null then case when s is null then 'backfill_failed' else 'ok' end else model_status end as model_status
from replay left join c on event_id = e""",
    ),
)
def backfill(spark, sf_dir):
    """All candidates filled from a stand-in scorer that fails on every third row."""
    table = v.replay(spark, sf_dir).withColumn("created_at", F.col("processed_time"))
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    stub = lambda df: df.withColumn("predicted_severity", F.when(k % 3 != 0, 1 + k % 4).cast("int"))
    updates = backfill_updates(backfill_candidates(table), stub)
    columns = ["predicted_severity", "risk_score", "model_status"]
    return keyed.update_from(table, updates, "event_id", columns).select("event_id", *columns)


SCENARIO = f"""
base as (select event_id, p, {v.write_risk_sql('p')} as r from (select *, {HEURISTIC_CLASS} as p from features)),
changed as (select event_id, p, {v.write_risk_sql('p')} as r from (select *, {HEURISTIC_CLASS} as p from (
  select * replace (1 as is_night, 4 as weather_code, 1 as is_rush_hour) from features)))"""


@query(
    "predict_scenarios",
    v.with_views(
        ["features"],
        f"""
with {SCENARIO} select event_id, p as predicted_severity, 'heuristic_fallback' as model_status, r as risk_score,
  case when r >= 0.7e0 then 'high' when r >= 0.4e0 then 'medium' else 'low' end as risk_level from base""",
    ),
)
def predict_scenarios(spark, sf_dir):
    scored = scenarios.predict_scenarios(v.feature_table(spark, sf_dir))
    return scored.select("event_id", "predicted_severity", "model_status", "risk_score", "risk_level")


@query(
    "scenario_compare",
    v.with_views(
        ["features"],
        f"""
with {SCENARIO}
select b.event_id, b.p as baseline_predicted_severity, b.r as baseline_risk_score, c.p as scenario_predicted_severity,
  c.r as scenario_risk_score, {v.round_sql('c.r - b.r', 4)} as risk_score_change,
  {v.round_sql('case when b.r <> 0 then (c.r - b.r) / b.r * 100 else 0e0 end', 2)} as risk_percent_change, c.p - b.p as severity_change
from base b join changed c using (event_id)""",
    ),
)
def scenario_compare(spark, sf_dir):
    rows = v.feature_table(spark, sf_dir)
    changed = rows.withColumns({"is_night": F.lit(1), "weather_code": F.lit(4), "is_rush_hour": F.lit(1)})
    return scenarios.compare_scenarios(
        scenarios.predict_scenarios(rows), scenarios.predict_scenarios(changed), "event_id"
    )


RUNS = """
runs as (select 'run-' || o_custkey as run_id, max(o_orderdate) as start_time,
  case when o_custkey % 7 = 0 then null else round(sum(cents) % 1000 / 1000, 6) end as weighted_f1,
  round(sum(cents) % 777 / 777, 6) as macro_f1, round(sum(cents) % 333 / 100, 6) as logloss
  from (select *, cast(round(o_totalprice * 100) as bigint) as cents from orders) group by o_custkey)"""


def runs(spark, sf_dir):
    """A run history made of the customers' orders."""
    total = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("start_time"), F.round(total % 1000 / 1000, 6).alias("weighted_f1"),
        F.round(total % 777 / 777, 6).alias("macro_f1"), F.round(total % 333 / 100, 6).alias("logloss"),
    ).select(
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id"), "start_time",
        F.when(F.col("o_custkey") % 7 != 0, F.col("weighted_f1")).alias("weighted_f1"), "macro_f1", "logloss",
    )


@query(
    "best_run",
    f"""
with {RUNS}, recent as (select * from runs order by start_time desc, run_id limit 30)
select run_id, start_time, weighted_f1, macro_f1, logloss,
  'weighted_f1' as selection_metric from recent order by coalesce(weighted_f1, -1) desc, start_time desc, run_id limit 1""",
)
def best_run(spark, sf_dir):
    return ev.best_run(runs(spark, sf_dir), 30)


@query(
    "model_trend",
    f"""
with {RUNS} select run_id, start_time, weighted_f1, macro_f1, logloss
from runs order by start_time desc, run_id limit 20""",
)
def model_trend(spark, sf_dir):
    return ev.metric_trend(runs(spark, sf_dir), 20)


@query(
    "leaderboard",
    f"""
with {RUNS} select run_id as model, macro_f1, logloss
from runs order by macro_f1 desc, logloss, run_id limit 10""",
)
def leaderboard(spark, sf_dir):
    models = runs(spark, sf_dir).select(F.col("run_id").alias("model"), "macro_f1", "logloss")
    return ev.leaderboard(models)


@query(
    "infer_from_probabilities",
    v.with_views(
        ["features"],
        f"""
with {PROBA_SQL}
select severity, count(*) as n from (select case when p1 >= p2 and p1 >= p3 and p1 >= p4 then 1 when p2 >= p3 and p2 >= p4 then 2
  when p3 >= p4 then 3 else 4 end as severity from proba) group by 1""",
    ),
)
def infer_from_probabilities(spark, sf_dir):
    none = F.lit(None).cast("int")
    rows = probabilities(spark, sf_dir)
    severity = infer_severity(none, none, none, none, [F.col(f"p{c}") for c in (1, 2, 3, 4)])
    return rows.select(severity.alias("severity")).groupBy("severity").agg(F.count("*").alias("n"))


VECTOR = ", ".join(MODEL_FEATURES)


@query(
    "preset_severity",
    v.with_views(
        ["features"],
        f"""
with presets as (select {VECTOR}, min(k) as name, 1 + min(k) % 4 as s from features where k % 50 = 0 group by {VECTOR}),
hits as (select f.* exclude (predicted_severity), s as predicted_severity, name from features f join presets using ({VECTOR}))
select event_id, 'P-' || name as preset_name, cast(predicted_severity as int) as predicted_severity,
  {v.write_risk_sql('predicted_severity')} as risk_score, 'preset_rule_based' as model_status from hits""",
    ),
)
def preset_severity(spark, sf_dir):
    """Vectors equal to one of the presets; every 50th row serves as a preset."""
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    rows = v.feature_table(spark, sf_dir).withColumn("k", k)
    presets = rows.where(F.col("k") % 50 == 0).groupBy(*MODEL_FEATURES).agg(F.min("k").alias("k")).select(
        F.concat(F.lit("P-"), F.col("k").cast("string")).alias("preset_name"),
        (1 + F.col("k") % 4).cast("int").alias("preset_severity"), *MODEL_FEATURES,
    )
    found = scenarios.preset_severity(rows.drop("k"), presets)
    return found.select("event_id", "preset_name", "predicted_severity", "risk_score", "model_status")


@query(
    "complete_features",
    v.with_views(["features"], "select event_id from features where k % 5 <> 0 and k % 7 <> 0"),
)
def complete_features(spark, sf_dir):
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    holed = v.feature_table(spark, sf_dir).withColumns(
        {"humidity": F.when(k % 5 != 0, F.col("humidity")), "hour": F.when(k % 7 != 0, F.col("hour"))}
    )
    return features.complete_features(holed).select("event_id")


@query(
    "compare_models",
    f"""
with {RUNS}, m as (select run_id as model, case when weighted_f1 is null then 'failed' else 'ok' end as status, macro_f1 from runs)
select model, status, macro_f1, cast(row_number() over (order by case status when 'ok' then 0 else 2 end, macro_f1 desc nulls last, model) as int)
  as place from m""",
)
def compare_models(spark, sf_dir):
    models = runs(spark, sf_dir).select(
        F.col("run_id").alias("model"), F.when(F.col("weighted_f1").isNull(), F.lit("failed")).otherwise(F.lit("ok")).alias("status"), "macro_f1"
    )
    top = ev.compare_models(models)
    order = Window.orderBy(F.when(F.col("status") == "ok", 0).otherwise(2), F.col("macro_f1").desc_nulls_last(), F.col("model"))
    return top.withColumn("place", F.row_number().over(order))


@query(
    "metric_log",
    """
select 'M_' || r as model, round(n % 97 / 97, 4) as accuracy, round((n % 13 + 1) / 10, 4) as logloss, cast(null as double) as macro_f1
from (select substr(o_orderpriority, 1, 1) as r, count(*) as n from orders group by 1)""",
)
def metric_log(spark, sf_dir):
    """Text logs made of the orders, one per priority, read back as metrics."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    counts = orders.groupBy(F.substr("o_orderpriority", F.lit(1), F.lit(1)).alias("r")).agg(F.count("*").alias("n"))
    text = lambda c: F.round(c, 4).cast("decimal(9,4)").cast("string")
    name = F.concat(F.lit("M_"), F.col("r").cast("string"))
    log = F.concat(
        F.lit("Best model ID: "), name, F.lit("\nEvaluating model rank 1: X_0 (x)\n  accuracy: 0.1\nEvaluating model rank 2: "),
        name, F.lit(" (m)\n  Logloss: "), text((F.col("n") % 13 + 1) / 10), F.lit("\n  accuracy: "), text(F.col("n") % 97 / 97),
        F.lit("\n  macro_f1: N/A\nEvaluating model rank 3: X_0 (x)\n  accuracy: 0.2\n"),
    )
    folder = f"{shared_folder(spark, 'logs')}/logs"
    # A row of several lines is several lines of the file, so a log is written by one row.
    counts.select(log.alias("value"), F.col("r").alias("run")).write.partitionBy("run").text(folder)
    return files.read_metric_log(spark, f"{folder}/*").select("model", "accuracy", "logloss", "macro_f1")


@query(
    "class_log",
    """
with p as (select o_orderpriority as model, o_orderstatus as class_label, count(*) as support from orders group by 1, 2)
select replace(model, ' ', '_') as model, class_label, round(support % 89 / 89, 4) as precision, round(support % 83 / 83, 4) as recall,
  round(support % 79 / 79, 4) as f1, support from p""",
)
def class_log(spark, sf_dir):
    """Text logs made of the orders, one per priority, each with the reports of three models; that of the best one is read back."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    counts = orders.groupBy(F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("model"), "o_orderstatus").agg(F.count("*").alias("n"))
    share = lambda by: F.format_string("%.4f", F.round(F.col("n") % by / by, 4))
    line = F.concat_ws("  ", F.lit(" 0"), "o_orderstatus", share(89), share(83), share(79), F.col("n").cast("string"))
    text = counts.groupBy("model").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("report"))
    other = "  Per-class classification report:\n  0  X  0.5  0.5  0.5  7\n  Confusion matrix table:\n  0  9  9  9  9  9\n"
    log = F.concat(
        F.lit("Best model ID: "), "model", F.lit(f"\nEvaluating model rank 1: A_0 (x)\n{other}Evaluating model rank 2: "), "model",
        F.lit(" (m)\n  accuracy: 0.5\n  Per-class classification report:\n  class_label  precision  recall  f1  support\n"), "report",
        F.lit(f"\n  Confusion matrix table:\n  1  9  9  9  9  9\nEvaluating model rank 3: B_0 (x)\n{other}"))
    folder = f"{shared_folder(spark, 'logs')}/logs"
    text.select(log.alias("value"), F.col("model").alias("run")).write.partitionBy("run").text(folder)
    return files.read_class_log(spark, f"{folder}/*").drop("file")


@query(
    "compare_with_reference",
    f"""
with {RUNS}, m as (select run_id as model, 'ok' as status, macro_f1, weighted_f1 from runs where macro_f1 is not null order by macro_f1 desc, model limit 1)
select model, status, macro_f1, weighted_f1, cast(null as double) as accuracy from m
union all select 'majority class', 'reference', null, null, (select max(n) / sum(n) from (select count(*) as n from orders group by o_orderstatus))""",
)
def compare_with_reference(spark, sf_dir):
    """The best run next to a reference: always the most frequent class."""
    models = runs(spark, sf_dir).select(F.col("run_id").alias("model"), F.lit("ok").alias("status"), "macro_f1", "weighted_f1")
    counts = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    reference = counts.agg((F.max("n") / F.sum("n")).alias("accuracy")).select(F.lit("majority class").alias("model"), F.lit("reference").alias("status"), "accuracy")
    return ev.compare_with_reference(models, reference)
