"""Queries over the chart datasets, the summary outputs and the sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from govlens.operators import anomaly as A, charts as CH, patterns as P, risk as R, scoring as S, usage as U
from govlens.plans import oracle as O
from govlens.plans.context import AS_OF, LOW_FREQ_MIN_RATE
from govlens.plans.q_insights import DECISION_SQL, LOW_USAGE_SQL, UNUSED_SQL, BOUNDS, _flagged
from govlens.plans.q_models import CLUSTERED, SCORED, clustered, scored
from govlens.plans.queries import query
from govlens.sources.sinks import write_insights_json

W = O.w
FL = O.FEATURES_LIST
HIST_FLOATS = ["bin_lo", "bin_hi"]


def hist_sql(src: str, value: str, by: str | None = None) -> str:
    """CTE chain + final select of a 30-bin histogram of ``value`` in ``src``."""
    g = f"{by}, " if by else ""
    gr = f"r.{by}, " if by else ""
    nn = f" and {by} is not null" if by else ""
    grp = f" group by {by}" if by else ""
    on = f"d.{by} = r.{by}" if by else "true"
    cj = f" and c.{by} = r.{by}" if by else ""
    return f""",
hd AS (select {g}cast({value} as double) as x from {src} where {value} is not null{nn}),
hr AS (select {g}case when min(x) = max(x) then min(x) - 0.5 else min(x) end as lo,
         case when min(x) = max(x) then max(x) + 0.5 else max(x) end as hi from hd{grp}),
hc AS (select {gr}cast(least(floor((d.x - r.lo) * (30.0 / (r.hi - r.lo))), 29) as integer) as bin, count(*) as n
       from hd d join hr r on {on} group by all)
select {gr}cast(g.bin as integer) as bin, r.lo + g.bin * ((r.hi - r.lo) / 30) as bin_lo,
  r.lo + (g.bin + 1) * ((r.hi - r.lo) / 30) as bin_hi, coalesce(c.n, 0) as n
from hr r cross join range(30) g(bin) left join hc c on c.bin = g.bin{cj}"""


@query("hist_risk", O.r6(HIST_FLOATS, W(*O.MERGE).rstrip() + hist_sql("merged", "risk_score")))
def q_hist_risk(ctx):
    return CH.histogram(ctx.merged, "risk_score")


@query("hist_frequency", O.r6(HIST_FLOATS, W(*O.MERGE).rstrip() + hist_sql("merged", "frequency")))
def q_hist_frequency(ctx):
    return CH.histogram(ctx.merged, "frequency")


@query("hist_risk_by_decision", O.r6(HIST_FLOATS, W(*O.MERGE).rstrip() + hist_sql("merged", "risk_score", "decision")))
def q_hist_risk_by_decision(ctx):
    return CH.histogram(ctx.merged, "risk_score", by="decision")


UNPIVOT = (",\nuv AS (unpivot (select * from features) on " + ", ".join(FL) + " into name feature value x),"
           "\ntop6 AS (select feature from (select feature, var_samp(x) as v from uv group by 1) t "
           "order by v desc nulls last, feature limit 6),"
           "\nsrc AS (select feature, x from uv where feature in (select feature from top6))")


def _by_variance(ctx) -> list[str]:
    """Feature names by sample variance, largest first (one aggregate per
    session, shared by the variance-driven charts)."""
    if "by_variance" not in ctx.extra:
        cols = ctx.ff.feature_columns
        ctx.extra["by_variance"] = CH.top_variance_columns(ctx.features, cols, len(cols))
    return ctx.extra["by_variance"]


@query("hist_top_features", O.r6(HIST_FLOATS, W(*O.FEAT).rstrip() + UNPIVOT + hist_sql("src", "x", "feature")))
def q_hist_top_features(ctx):
    f = ctx.features
    top = _by_variance(ctx)[:6]
    long = f.select(*top).unpivot([], top, "feature", "x")
    return CH.histogram(long, "x", by="feature")


@query("hist_class_probability", O.r6(HIST_FLOATS, W(*O.FEAT, SCORED) + """,
cp AS (select 0 as class_index, p0 as p from scored union all select 1, p1 from scored)""" +
                                       hist_sql("cp", "p", "class_index")))
def q_hist_class_probability(ctx):
    return CH.histogram(CH.class_probability_long(scored(ctx)), "p", by="class_index")


@query("hist_confidence", O.r6(HIST_FLOATS, W(*O.FEAT, SCORED).rstrip() + hist_sql("scored", "conf")))
def q_hist_confidence(ctx):
    return CH.histogram(scored(ctx).withColumn("conf", F.array_max("probability")), "conf")


def share_sql(src: str, col: str, name: str | None = None) -> str:
    name = name or col
    return (f"select {col} as {name}, count(*) as n, count(*) * 100.0 / sum(count(*)) over () as pct "
            f"from {src} where {col} is not null group by 1")


@query("target_share", O.r6(["pct"], W(*O.FEAT) + share_sql("features", "label")))
def q_target_share(ctx):
    return CH.share(ctx.features, "label")


def mean_sql(col: str, value: str, name: str, top: int | None) -> str:
    lim = f" limit {top}" if top else ""
    return O.r6([name], W(*O.MERGE) + f"select {col}, avg({value}) as {name} from merged where {col} is not null "
                f"group by 1 order by {name} desc nulls last, {col}{lim}")


@query("risk_mean_by_role", mean_sql("role", "risk_score", "mean_risk", 10))
def q_risk_mean_by_role(ctx):
    return CH.mean_by(ctx.merged, "role", "risk_score", 10, "mean_risk")


@query("risk_mean_by_department", mean_sql("department", "risk_score", "mean_risk", None))
def q_risk_mean_by_department(ctx):
    return CH.mean_by(ctx.merged, "department", "risk_score", None, "mean_risk")


@query("frequency_by_role", mean_sql("role", "frequency", "mean_frequency", 10))
def q_frequency_by_role(ctx):
    return CH.mean_by(ctx.merged, "role", "frequency", 10, "mean_frequency")


@query("risk_box_by_decision", O.r6(["q1", "median", "q3", "whisker_low", "whisker_high"], W(*O.MERGE) + """,
q AS (select decision, quantile_cont(risk_score, 0.25) as q1, quantile_cont(risk_score, 0.5) as median,
        quantile_cont(risk_score, 0.75) as q3 from merged where risk_score is not null and decision is not null group by 1)
select q.decision, q1, median, q3,
  min(case when m.risk_score >= q1 - 1.5 * (q3 - q1) and m.risk_score <= q3 + 1.5 * (q3 - q1) then m.risk_score end) as whisker_low,
  max(case when m.risk_score >= q1 - 1.5 * (q3 - q1) and m.risk_score <= q3 + 1.5 * (q3 - q1) then m.risk_score end) as whisker_high,
  cast(count_if(not (m.risk_score >= q1 - 1.5 * (q3 - q1) and m.risk_score <= q3 + 1.5 * (q3 - q1))) as bigint) as n_outliers
from merged m join q on m.decision = q.decision where m.risk_score is not null group by 1, 2, 3, 4"""))
def q_risk_box_by_decision(ctx):
    return CH.box_stats(ctx.merged, "risk_score", "decision")


@query("cluster_share", O.r6(["pct"], W(*O.FEAT, CLUSTERED) + share_sql("cl", "cluster")))
def q_cluster_share(ctx):
    return CH.share(clustered(ctx), "cluster")


@query("top_access_items", W(*O.MERGE) + """
select access_item, count(*) as n from merged where access_item is not null group by 1 order by n desc, access_item limit 15""")
def q_top_access_items(ctx):
    return CH.top_counts(ctx.merged, "access_item", 15)


@query("access_type_share", O.r6(["pct"], W(*O.MERGE) + share_sql("merged", "access_type")))
def q_access_type_share(ctx):
    return CH.share(ctx.merged, "access_type")


VAR_SQL = W(*O.FEAT) + (", vr AS (select feature, variance, row_number() over (order by variance desc nulls last, feature) "
                        "as rank from (" + " union all ".join(
                            f"select '{c}' as feature, var_samp({c}) as variance from features" for c in FL) + ") t)")


@query("variance_rank", O.r6(["variance"], VAR_SQL + " select feature, variance, cast(rank as integer) as rank from vr where rank <= 20"))
def q_variance_rank(ctx):
    return CH.variance_rank(ctx.features, ctx.ff.feature_columns, 20).withColumn("rank", F.col("rank").cast("int"))


CORR_SQL = VAR_SQL + """,
uv AS (unpivot (select * from features) on """ + ", ".join(FL) + """ into name feature value x),
top AS (select feature from vr where rank <= 20),
pairs AS (select a.request_id, a.feature as feature_a, b.feature as feature_b, a.x as xa, b.x as xb
          from uv a join uv b on a.request_id = b.request_id
          where a.feature in (select feature from top) and b.feature in (select feature from top))
select feature_a, feature_b,
  case when stddev_pop(xa) * stddev_pop(xb) = 0 then null else covar_pop(xa, xb) / (stddev_pop(xa) * stddev_pop(xb)) end as corr
from pairs group by 1, 2"""


@query("correlation_matrix", O.r6(["corr"], CORR_SQL))
def q_correlation_matrix(ctx):
    top = _by_variance(ctx)[:20]
    return CH.correlation_matrix(ctx.features, top)


def _first(sql: str, n: int, floats: list[str], order: str) -> str:
    return O.r6(floats, f"select * from ({sql}) t order by {order} limit {n}")


@query("removal_candidates", _first(LOW_USAGE_SQL, 15, ["avg_frequency"], "user_count desc, access_item"))
def q_removal_candidates(ctx):
    return U.low_usage_items(ctx.merged).orderBy(F.desc("user_count"), "access_item").limit(15)


@query("removal_unused", _first(UNUSED_SQL, 15, ["avg_days_since_use"], "user_count desc, access_item"))
def q_removal_unused(ctx):
    return U.unused_items(ctx.merged, AS_OF).orderBy(F.desc("user_count"), "access_item").limit(15)


@query("removal_impact", _first(LOW_USAGE_SQL, 10, ["avg_frequency"], "user_count desc, access_item"))
def q_removal_impact(ctx):
    return U.low_usage_items(ctx.merged).orderBy(F.desc("user_count"), "access_item").limit(10)


@query("confidence_zones", O.r6(["pct"], W(*O.FEAT, SCORED) + """
select zone, n, n * 100.0 / tot as pct from (
  select 'low' as zone, cast(count_if(conf < 0.6) as bigint) as n, count(*) as tot from scored
  union all select 'medium', cast(count_if(conf >= 0.6 and conf < 0.8) as bigint), count(*) from scored
  union all select 'high', cast(count_if(conf >= 0.8) as bigint), count(*) from scored) t"""))
def q_confidence_zones(ctx):
    return CH.confidence_zones(scored(ctx))


@query("confidence_errors", W(*O.FEAT, SCORED) + """
select cast(count_if(conf >= 0.8 and label = prediction) as bigint) as high_correct,
  cast(count_if(conf >= 0.8 and label <> prediction) as bigint) as high_wrong,
  cast(count_if(conf < 0.8 and label = prediction) as bigint) as low_correct,
  cast(count_if(conf < 0.8 and label <> prediction) as bigint) as low_wrong from scored""")
def q_confidence_errors(ctx):
    return CH.confidence_errors(scored(ctx))


@query("pattern_top4", O.r6(["probability"], W(*O.LAB) + f"select * from ({DECISION_SQL}) d order by abs(probability - 50) desc, rule, pattern limit 4"))
def q_pattern_top4(ctx):
    d = P.decision_patterns(ctx.labeled, "request_ts", low_freq_min_rate=LOW_FREQ_MIN_RATE, grid=ctx.grid)
    return d.orderBy(F.desc(F.abs(F.col("probability") - 50)), "rule", "pattern").limit(4)


@query("importance_chart", "select model, 10::bigint as n_bars, true as are_shares from (values ('random_forest'), ('gradient_boosting')) m(model)")
def q_importance_chart(ctx):
    """The ten bars of each model that has importances; all of them shares of one."""
    from govlens.plans.q_models import importances
    return S.top_features(importances(ctx)).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_bars"), F.every(F.col("importance").between(0, 1)).alias("are_shares"))


# ---------------------------------------------------------------- summaries and sinks

HIGH_RISK_USERS_SQL = W(*O.MERGE) + """
select user_id, avg(risk_score) as avg_risk from merged where risk_score > 0.7 and user_id is not null
group by 1 order by avg_risk desc, user_id limit 20"""


@query("insight_summary", O.r6(["value"], f"""
select 'access_reduction' as insight_type, 'low_usage' as category, access_item as item, avg_frequency as value,
  cast(user_count as varchar) as impact from ({LOW_USAGE_SQL}) a
union all
select 'risk', 'high_risk_user', cast(user_id as varchar), avg_risk, 'high' from (
  select * from ({HIGH_RISK_USERS_SQL}) h order by avg_risk desc, user_id limit 10) b"""))
def q_insight_summary(ctx):
    from govlens.operators.summary import insight_summary
    m = ctx.merged
    return insight_summary(U.low_usage_items(m), R.high_risk_users(m))


@query("report_metrics", O.r6(["value"], W(*O.FEAT, BOUNDS) + f"""
select 'access_reduction' as section, 'total_opportunities' as metric,
  cast((select count(*) from ({LOW_USAGE_SQL})) + (select count(*) from ({UNUSED_SQL})) as double) as value
union all select 'risk', 'mean_risk', (select avg(risk_score) from merged)
union all select 'risk', 'high_risk_count', (select count_if(risk_score > 0.7)::double from merged)
union all select 'risk', 'high_risk_percentage', (select 100.0 * count_if(risk_score > 0.7) / count(*) from merged)
union all select 'anomalies', 'outlier_count', (select count_if(is_outlier)::double from flagged)
union all select 'anomalies', 'outlier_percentage', (select 100.0 * count_if(is_outlier) / count(*) from flagged)
union all select 'feature_importance', model, 1.0 from (values ('random_forest'), ('gradient_boosting')) m(model)"""))
def q_report_metrics(ctx):
    from govlens.operators.summary import report_metrics
    m = ctx.merged
    from govlens.plans.q_models import importances
    out = report_metrics(U.access_reduction_total(U.low_usage_items(m), U.unused_items(m, AS_OF)),
                         R.risk_overall(m), A.iqr_outliers(_flagged(ctx)), importances(ctx))
    # of a top predictor, SQL knows the model, and that it has a share of the importance
    predictor = F.col("section") == "feature_importance"
    return out.select("section", F.when(predictor, F.element_at(F.split("metric", ":"), 1)).otherwise(F.col("metric")).alias("metric"),
                      F.when(predictor, F.ceil("value").cast("double")).otherwise(F.col("value")).alias("value"))


@query("sink_insights_json", f"""
select 'low_usage_items' as insight, count(*) as n_rows from ({LOW_USAGE_SQL})
union all select 'unused_items', count(*) from ({UNUSED_SQL})
union all select 'high_risk_users', count(*) from ({HIGH_RISK_USERS_SQL})""")
def q_sink_insights_json(ctx):
    """Insights written as JSON (a folder per insight) and read back."""
    m = ctx.merged
    written = write_insights_json(ctx.spark, {"low_usage_items": U.low_usage_items(m),
                                              "unused_items": U.unused_items(m, AS_OF),
                                              "high_risk_users": R.high_risk_users(m)})
    parts = [ctx.spark.read.json(p).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("insight"), "n_rows")
             for n, p in written.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
