"""Queries over the usage, risk, anomaly and decision-pattern insights."""

from __future__ import annotations

from govlens.operators import anomaly as A, patterns as P, risk as R, usage as U
from govlens.plans import oracle as O
from govlens.plans.context import AS_OF, IT_DEPARTMENT, LOW_FREQ_MIN_RATE
from govlens.plans.queries import query

W = O.w
DAYS = f"cast(floor((epoch_us({O.AS_OF}) - epoch_us(last_used_date)) / 86400000000) as bigint)"

# ---------------------------------------------------------------- usage

LOW_USAGE_SQL = W(*O.MERGE) + """
select access_item, count(user_id) as user_count, avg(frequency) as avg_frequency from merged
where frequency < 5 and access_item is not null group by 1 order by user_count desc, access_item limit 20"""

UNUSED_SQL = W(*O.MERGE) + f"""
select access_item, count(user_id) as user_count, avg(days) as avg_days_since_use
from (select *, {DAYS} as days from merged) m
where days > 90 and access_item is not null group by 1 order by user_count desc, access_item limit 20"""


@query("low_usage_items", O.r6(["avg_frequency"], LOW_USAGE_SQL))
def q_low_usage_items(ctx):
    return U.low_usage_items(ctx.merged, ctx.spec.insights.low_usage_threshold)


@query("days_since_use", W(*O.MERGE) + f"select request_id, {DAYS} as days_since_use from merged")
def q_days_since_use(ctx):
    return ctx.merged.select("request_id", U.days_since_use(ctx.merged, AS_OF).alias("days_since_use"))


@query("unused_items", O.r6(["avg_days_since_use"], UNUSED_SQL))
def q_unused_items(ctx):
    return U.unused_items(ctx.merged, AS_OF)


@query("access_reduction_total", f"""
select a.n as n_low_usage, b.n as n_unused, a.n + b.n as total_opportunities
from (select count(*) as n from ({LOW_USAGE_SQL})) a, (select count(*) as n from ({UNUSED_SQL})) b""")
def q_access_reduction_total(ctx):
    m = ctx.merged
    return U.access_reduction_total(U.low_usage_items(m), U.unused_items(m, AS_OF))


# ---------------------------------------------------------------- risk

@query("risk_overall", O.r6(["mean_risk", "median_risk", "high_risk_percentage"], W(*O.MERGE) + """
select avg(risk_score) as mean_risk, median(risk_score) as median_risk,
  cast(count_if(risk_score > 0.7) as bigint) as high_risk_count, 100.0 * count_if(risk_score > 0.7) / count(*) as high_risk_percentage
from merged"""))
def q_risk_overall(ctx):
    return R.risk_overall(ctx.merged, ctx.spec.insights.risk_threshold)


def _by(col: str) -> str:
    return O.r6(["avg_risk"], W(*O.MERGE) + f"""
select {col}, avg(risk_score) as avg_risk, count(risk_score) as "count" from merged where {col} is not null
group by 1 order by avg_risk desc nulls last, {col} limit 10""")


@query("risk_by_role", _by("role"))
def q_risk_by_role(ctx):
    return R.risk_by_group(ctx.merged, "role")


@query("risk_by_department", _by("department"))
def q_risk_by_department(ctx):
    return R.risk_by_group(ctx.merged, "department")


@query("high_risk_users", O.r6(["avg_risk"], W(*O.MERGE) + """
select user_id, avg(risk_score) as avg_risk from merged where risk_score > 0.7 and user_id is not null
group by 1 order by avg_risk desc, user_id limit 20"""))
def q_high_risk_users(ctx):
    return R.high_risk_users(ctx.merged, ctx.spec.insights.risk_threshold)


# ---------------------------------------------------------------- anomalies

F_ = O.FEATURES_LIST
BOUNDS = ("\nbq AS (select " + ", ".join(
    f"quantile_cont({c}, 0.25) as q1_{c}, quantile_cont({c}, 0.75) as q3_{c}" for c in F_) + " from features),"
    "\nflagged AS (select f.*, (" + " or ".join(
        f"f.{c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) or f.{c} > q3_{c} + 1.5 * (q3_{c} - q1_{c})" for c in F_)
    + ") as is_outlier from features f, bq)")


@query("iqr_bounds", O.r6(["q1", "q3", "lower", "upper"], W(*O.FEAT) + "select feature, q1, q3, q1 - 1.5 * (q3 - q1) as lower, "
       "q3 + 1.5 * (q3 - q1) as upper from (" + " union all ".join(
           f"select '{c}' as feature, quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from features"
           for c in F_) + ")"))
def q_iqr_bounds(ctx):
    return A.iqr_bounds(ctx.features, ctx.ff.feature_columns, filled=ctx.ff.filled)


def _flagged(ctx):
    key = ("iqr_flagged",)
    if key not in ctx.extra:
        ctx.extra[key] = A.outlier_flag(ctx.features, A.iqr_bounds(ctx.features, ctx.ff.feature_columns,
                                                                  filled=ctx.ff.filled))
    return ctx.extra[key]


@query("iqr_outliers", O.r6(["outlier_percentage"], W(*O.FEAT, BOUNDS) + """
select cast(count_if(is_outlier) as bigint) as outlier_count, 100.0 * count_if(is_outlier) / count(*) as outlier_percentage
from flagged"""))
def q_iqr_outliers(ctx):
    return A.iqr_outliers(_flagged(ctx))


@query("outlier_users", W(*O.FEAT, BOUNDS) + """
select f.request_id, m.user_id from (select request_id from flagged where is_outlier order by request_id limit 10) f
join merged m on f.request_id = m.request_id""")
def q_outlier_users(ctx):
    return A.outlier_users(_flagged(ctx), ctx.merged, "request_id")


# ---------------------------------------------------------------- patterns

RATE = "avg(case when label = {c} then 1.0::double else 0.0::double end) * 100.0"
REJ, APP = RATE.format(c=1), RATE.format(c=0)
PAT_FLOAT = ["probability"]

TOP_DEPT = f"""
select 'High Risk (>0.7) + ' || department || ' Dept' as pattern, 'Rejection' as outcome,
  round_even(rate, 1) as probability, n as sample_size
from (select department, {REJ} as rate, count(*) as n from labeled where risk_score > 0.7 and department is not null
      group by 1 order by rate desc, department limit 1) t where rate > 0"""
AFTER_LOW = f"""
select 'After Hours (Before 6AM/After 8PM) + Low Frequency' as pattern, 'Rejection' as outcome,
  round_even(rate, 1) as probability, n as sample_size
from (select {REJ} as rate, count(*) as n from labeled
      where (request_ts_hour < 6 or request_ts_hour > 20) and frequency < 10) t where n > 10"""
MANAGER = f"""
select 'Manager Role + Low Risk (<0.3)' as pattern, 'Approval' as outcome, round_even(rate, 1) as probability,
  n as sample_size
from (select {APP} as rate, count(*) as n from labeled where requester_role = 'Manager' and risk_score < 0.3) t
where n > 10"""
BUSINESS = f"""
select 'Business Hours (9-17) + {O.IT_DEPARTMENT} Dept' as pattern, 'Approval' as outcome,
  round_even(rate, 1) as probability, n as sample_size
from (select {APP} as rate, count(*) as n from labeled
      where request_ts_hour >= 9 and request_ts_hour <= 17 and department = '{O.IT_DEPARTMENT}') t where n > 10"""

DEPT_REJ = f"""
select 'High Risk (>0.7) + ' || department || ' Dept' as pattern, 'Rejection' as outcome, rate as probability,
  n as sample_size
from (select department, {REJ} as rate, count(*) as n from labeled where risk_score > 0.7 and department is not null
      group by 1) t where n >= 10 and rate > 60"""
AFTER = f"""
select 'After-hours requests (10PM-6AM)' as pattern, 'Rejection' as outcome, rate as probability, n as sample_size
from (select {REJ} as rate, count(*) as n from labeled where hour(request_ts) < 6 or hour(request_ts) > 22) t
where n >= 10"""
ROLE = f"""
select requester_role || ' Role + Low Risk (<0.3)' as pattern, 'Approval' as outcome, rate as probability,
  n as sample_size
from (select requester_role, {APP} as rate, count(*) as n from labeled
      where risk_score < 0.3 and requester_role is not null group by 1) t where n >= 10 and rate > 80"""
LOWF = f"""
select 'Low Usage Frequency (<5)' as pattern, 'Rejection' as outcome, rate as probability, n as sample_size
from (select {REJ} as rate, count(*) as n from labeled where frequency < 5) t
where n >= 10 and rate > {LOW_FREQ_MIN_RATE}"""


def _pat(sql: str) -> str:
    return O.r6(PAT_FLOAT, W(*O.LAB) + sql)


@query("pat_top_dept_reject", _pat(TOP_DEPT))
def q_pat_top_dept_reject(ctx):
    return P.pat_top_dept_reject(ctx.labeled, grid=ctx.grid)


@query("pat_after_hours_low_freq", _pat(AFTER_LOW))
def q_pat_after_hours_low_freq(ctx):
    return P.pat_after_hours_low_freq(ctx.labeled, "request_ts", grid=ctx.grid)


@query("pat_manager_low_risk", _pat(MANAGER))
def q_pat_manager_low_risk(ctx):
    return P.pat_manager_low_risk(ctx.labeled, grid=ctx.grid)


@query("pat_business_hours_it", _pat(BUSINESS))
def q_pat_business_hours_it(ctx):
    return P.pat_business_hours_dept(ctx.labeled, IT_DEPARTMENT, "request_ts", grid=ctx.grid)


def _union(parts: list[str]) -> str:
    return " union all ".join(f"select *, {i + 1} as rule from ({p})" for i, p in enumerate(parts))


@query("approval_patterns", _pat(f"""
select *, count(*) over () as n_patterns from ({_union([TOP_DEPT, AFTER_LOW, MANAGER, BUSINESS])}) u"""))
def q_approval_patterns(ctx):
    return P.approval_patterns(ctx.labeled, "request_ts", IT_DEPARTMENT, grid=ctx.grid)


@query("pat_dept_reject", _pat(DEPT_REJ))
def q_pat_dept_reject(ctx):
    return P.pat_dept_reject(ctx.labeled, grid=ctx.grid)


@query("pat_after_hours", _pat(AFTER))
def q_pat_after_hours(ctx):
    return P.pat_after_hours(ctx.labeled, "request_ts", grid=ctx.grid)


@query("pat_role_low_risk", _pat(ROLE))
def q_pat_role_low_risk(ctx):
    return P.pat_role_low_risk(ctx.labeled, grid=ctx.grid)


@query("pat_low_frequency", _pat(LOWF))
def q_pat_low_frequency(ctx):
    return P.pat_low_frequency(ctx.labeled, min_rate=LOW_FREQ_MIN_RATE, grid=ctx.grid)


DECISION_SQL = f"""
select * from (select *, count(*) over () as total_patterns from ({_union([DEPT_REJ, AFTER, ROLE, LOWF])}) u) v
order by abs(probability - 50) desc, rule, pattern limit 10"""


@query("decision_patterns", _pat(DECISION_SQL))
def q_decision_patterns(ctx):
    return P.decision_patterns(ctx.labeled, "request_ts", low_freq_min_rate=LOW_FREQ_MIN_RATE, grid=ctx.grid)
