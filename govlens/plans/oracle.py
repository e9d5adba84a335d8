"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the raw test tables as views; each statement below
re-derives the four bound tables, the cleaned and merged frames, the label
encoding and the feature frame in plain SQL, then answers the query.  Float
outputs are rounded to 6 decimals on both sides (see ``queries.ROUND``).
"""

from __future__ import annotations

K = "cast(json_extract_string(e.props, '$.k') as bigint)"
AS_OF = "TIMESTAMP '2001-12-01 12:30:00'"
IT_DEPARTMENT = "NATION_7"

BIND = f"""
decision_history AS (
  select e.event_id as request_id, e.user_id, concat('item_', cast({K} as varchar)) as access_item,
    case when e.event_id % 10 < (case when e.value > 70 then 7 else 1 end) then 'reject' else 'approve' end as decision,
    e.ts as request_ts,
    case e.user_id % 4 when 0 then 'Developer' when 1 then 'Manager' when 2 then 'Admin' else 'Analyst' end as requester_role,
    (e.user_id * 7 + 3) % 150 as approver_id, least(e.value / 100.0, 1.0) as risk_score,
    e.event_id % 7 = 0 as sod_conflict, {K} % 3 = 0 as is_privileged_access
  from events e),
access_usage AS (
  select o.o_custkey as user_id, concat('item_', cast(l.l_partkey % 100 as varchar)) as access_item,
    max(l.l_shipdate) as last_used_date, cast(sum(l.l_quantity) as bigint) as frequency,
    max(l.l_returnflag) as access_type
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey group by 1, 2),
peer_group AS (
  select c.c_custkey as user_id,
    concat(n.n_name, '_', r.r_name, '_L', cast(1 + c.c_custkey % 5 as varchar)) as peer_group_id,
    c.c_mktsegment as role, n.n_name as department, 1 + c.c_custkey % 5 as seniority_level, r.r_name as location,
    case when c.c_acctbal < 0 then 'Contractor' else 'FTE' end as employment_type
  from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey),
recertification_history AS (
  select user_id, access_item, last_certified_date, certification_outcome, certified_by from (
    select o_custkey as user_id, concat('item_', cast(o_orderkey % 100 as varchar)) as access_item,
      o_orderdate as last_certified_date,
      case o_orderstatus when 'F' then 'approved' when 'P' then 'revoked' else 'deferred' end as certification_outcome,
      o_orderpriority as certified_by,
      row_number() over (partition by o_custkey, o_orderkey % 100 order by o_orderdate desc, o_orderkey) as rn
    from orders) t where rn = 1)"""


def parts(c: str, prefix: str = "") -> str:
    """The five date parts of column ``c`` (Monday = 0; whole days since 2020-01-01)."""
    x = f"{prefix}{c}"
    return (f"cast(year({x}) as bigint) as {c}_year, cast(month({x}) as bigint) as {c}_month, "
            f"cast(isodow({x}) - 1 as bigint) as {c}_day_of_week, cast(hour({x}) as bigint) as {c}_hour, "
            f"cast(date_diff('day', DATE '2020-01-01', cast({x} as date)) as bigint) as {c}_days_since")


CLEAN = f"""
dh_c AS (select distinct *, {parts('request_ts')} from decision_history),
au_c AS (select distinct *, {parts('last_used_date')} from access_usage),
pg_c AS (select distinct * from peer_group),
rh_c AS (select distinct *, {parts('last_certified_date')} from recertification_history)"""

MERGED = """
merged AS (
  select d.*, u.* exclude (user_id, access_item), p.* exclude (user_id), r.* exclude (user_id, access_item)
  from dh_c d
  left join au_c u on d.user_id is not distinct from u.user_id and d.access_item is not distinct from u.access_item
  left join pg_c p on d.user_id is not distinct from p.user_id
  left join rh_c r on d.user_id is not distinct from r.user_id and d.access_item is not distinct from r.access_item)"""

CATEGORICAL = ["access_item", "requester_role", "access_type", "role", "department", "location", "decision",
               "employment_type", "certification_outcome", "sod_conflict", "is_privileged_access"]


def code(c: str) -> str:
    return f"(dense_rank() over (order by coalesce(cast({c} as varchar), 'nan')) - 1)"


ENCODED = "\nencoded AS (select * replace (" + ", ".join(f"{code(c)} as {c}" for c in CATEGORICAL) + ") from merged)"
LABELED = f"\nlabeled AS (select *, {code('decision')} as label from merged)"

FEATURES_LIST = [
    "user_id", "access_item", "requester_role", "risk_score", "sod_conflict", "is_privileged_access",
    "request_ts_year", "request_ts_month", "request_ts_day_of_week", "request_ts_hour", "request_ts_days_since",
    "frequency", "access_type",
    "last_used_date_year", "last_used_date_month", "last_used_date_day_of_week", "last_used_date_hour",
    "last_used_date_days_since",
    "role", "department", "seniority_level", "location", "employment_type", "certification_outcome",
    "last_certified_date_year", "last_certified_date_month", "last_certified_date_day_of_week",
    "last_certified_date_hour", "last_certified_date_days_since",
]

FEATURES = ("\nfeat0 AS (select request_id, decision as label, "
            + ", ".join(f"cast({c} as double) as {c}" for c in FEATURES_LIST) + " from encoded),"
            + "\nfeatures AS (select request_id, label, "
            + ", ".join(f"coalesce({c}, median({c}) over ()) as {c}" for c in FEATURES_LIST) + " from feat0)")

# gaps injected for the imputation queries
GAPS = """
dh_gaps AS (
  select request_id, user_id, access_item, decision,
    case when request_id % 19 = 0 then null else request_ts end as request_ts,
    case when request_id % 13 = 0 then null else requester_role end as requester_role,
    approver_id,
    case when request_id % 11 = 0 then null else risk_score end as risk_score,
    case when request_id % 17 = 0 then null else sod_conflict end as sod_conflict,
    is_privileged_access
  from decision_history)"""


def mode_of(c: str, src: str) -> str:
    """Most frequent value, smallest on ties."""
    return (f"(select v from (select {c} as v, count(*) as n from {src} where {c} is not null group by 1) "
            f"order by n desc, v limit 1)")


GAPS_FILLED = f"""
dh_filled AS (
  select request_id, user_id, access_item, decision,
    coalesce(request_ts, {mode_of('request_ts', 'dh_gaps')}) as request_ts,
    coalesce(requester_role, {mode_of('requester_role', 'dh_gaps')}) as requester_role,
    approver_id,
    coalesce(risk_score, (select median(risk_score) from dh_gaps)) as risk_score,
    coalesce(sod_conflict, {mode_of('sod_conflict', 'dh_gaps')}) as sod_conflict,
    is_privileged_access
  from dh_gaps)"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (BIND,)
CLEANED = (BIND, CLEAN)
MERGE = (BIND, CLEAN, MERGED)
ENC = (BIND, CLEAN, MERGED, ENCODED)
FEAT = (BIND, CLEAN, MERGED, ENCODED, FEATURES)
LAB = (BIND, CLEAN, MERGED, LABELED)


def r6(cols: list[str], sql: str) -> str:
    """Round the named float columns of ``sql`` to 6 decimals."""
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, 6) as {c}" for c in cols)
    return f"select * replace ({rep}) from (\n{sql}\n) q"
