"""Queries over sources, cleaning, merging and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from govlens.functions.dates import parse_dates
from govlens.operators import clean as C
from govlens.operators.encode import label_encode_apply, standard_scale
from govlens.operators.merge import join_step, merge_tables
from govlens.plans import oracle as O
from govlens.plans.queries import query
from govlens.session import shared_path
from govlens.sources import catalog, files

W = O.w

# ---------------------------------------------------------------- sources

@query("src_profile", W(*O.BASE) + """
select 'decision_history' as table_name, count(*) as n_rows, cast(10 as bigint) as n_cols from decision_history
union all select 'access_usage', count(*), 5 from access_usage
union all select 'peer_group', count(*), 7 from peer_group
union all select 'recertification_history', count(*), 5 from recertification_history""")
def q_src_profile(ctx):
    return catalog.profile(ctx.tables)


PROJECTED = ["request_id", "user_id", "access_item", "decision", "risk_score"]


@query("src_project", W(*O.BASE) + "select request_id, user_id, access_item, decision, risk_score from decision_history")
def q_src_project(ctx):
    return catalog.project(ctx.tables["decision_history"], PROJECTED + ["not_a_column"])


@query("src_head", O.r6(["risk_score"], W(*O.BASE) + "select * from decision_history order by request_id limit 5"))
def q_src_head(ctx):
    return catalog.head(ctx.tables["decision_history"], 5, "request_id")


@query("src_csv", W(*O.CLEANED) + "select * from au_c")
def q_src_csv(ctx):
    """access_usage written as CSV to the shared folder, read back with
    pandas-style type inference, then cleaned (dates parsed)."""
    path = shared_path(ctx.spark, "src_csv")
    files.write_csv(ctx.tables["access_usage"], path)
    back = files.read_csv(ctx.spark, path)
    return C.clean_table(back, ["last_used_date"])


@query("src_all_tables", W(*O.BASE) + """
select 'decision_history' as table_name, count(*) as n_rows from decision_history
union all select 'access_usage', count(*) from access_usage
union all select 'peer_group', count(*) from peer_group
union all select 'recertification_history', count(*) from recertification_history""")
def q_src_all_tables(ctx):
    """Load every configured table from a folder; a missing one is dropped."""
    from govlens.spec import TableSpec
    base = shared_path(ctx.spark, "src_all")
    for name, df in ctx.tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}.parquet")
    specs = {n: TableSpec(n) for n in (*ctx.tables, "missing_table")}
    loaded = catalog.load_all_tables(ctx.spark, base, specs)
    return catalog.profile(loaded).select("table_name", "n_rows")


# ---------------------------------------------------------------- cleaning

def _gaps(ctx):
    d = ctx.tables["decision_history"]
    rid = F.col("request_id")
    def gap(c, m):
        return F.when(rid % m == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
    return d.select("request_id", "user_id", "access_item", "decision", gap("request_ts", 19),
                    gap("requester_role", 13), "approver_id", gap("risk_score", 11), gap("sod_conflict", 17),
                    "is_privileged_access")


GAP_COLS = ["request_id", "user_id", "access_item", "decision", "request_ts", "requester_role", "approver_id",
            "risk_score", "sod_conflict", "is_privileged_access"]


@query("null_counts", W(*O.BASE, O.GAPS) + " union all ".join(
    f"select '{c}' as column_name, cast(count_if({c} is null) as bigint) as n_missing from dh_gaps" for c in GAP_COLS))
def q_null_counts(ctx):
    return C.null_counts(_gaps(ctx))


@query("impute_median", O.r6(["risk_score"], W(*O.BASE, O.GAPS, O.GAPS_FILLED) +
                             "select request_id, risk_score from dh_filled"))
def q_impute_median(ctx):
    return C.impute(_gaps(ctx)).select("request_id", "risk_score")


@query("impute_mode", W(*O.BASE, O.GAPS, O.GAPS_FILLED) +
       "select request_id, requester_role, sod_conflict, request_ts from dh_filled")
def q_impute_mode(ctx):
    return C.impute(_gaps(ctx)).select("request_id", "requester_role", "sod_conflict", "request_ts")


@query("parse_dates", W(*O.BASE) + f"""
select request_id, {O.parts('request_ts')}, request_ts from (
  select request_id, try_cast(case when request_id % 13 = 0 then 'not a date' else cast(request_ts as varchar) end
                              as timestamp) as request_ts
  from decision_history)""")
def q_parse_dates(ctx):
    d = ctx.tables["decision_history"]
    s = d.select("request_id", F.when(F.col("request_id") % 13 == 0, F.lit("not a date"))
                 .otherwise(F.col("request_ts").cast("string")).alias("request_ts"))
    return parse_dates(s, ["request_ts"])


@query("date_parts", W(*O.BASE) + f"select request_id, {O.parts('request_ts')} from decision_history")
def q_date_parts(ctx):
    return parse_dates(ctx.tables["decision_history"], ["request_ts"]).select(
        "request_id", *[f"request_ts{s}" for s in ("_year", "_month", "_day_of_week", "_hour", "_days_since")])


@query("days_since_anchor", W(*O.BASE) + """
select user_id, access_item,
  cast(date_diff('day', DATE '2020-01-01', cast(last_certified_date as date)) as bigint) as last_certified_date_days_since
from recertification_history""")
def q_days_since_anchor(ctx):
    return parse_dates(ctx.tables["recertification_history"], ["last_certified_date"]).select(
        "user_id", "access_item", "last_certified_date_days_since")


@query("drop_duplicates", O.r6(["risk_score"], W(*O.BASE) + """
select distinct * from (select * from decision_history union all select * from decision_history)"""))
def q_drop_duplicates(ctx):
    """Every request twice (a whole second copy of the table), then whole-row distinct."""
    d = ctx.tables["decision_history"]
    return C.drop_duplicates(d.unionByName(d))


@query("dedupe_by_key", """
select user_id, access_item, l_shipdate, l_orderkey, l_linenumber, l_quantity from (
  select o.o_custkey as user_id, concat('item_', cast(l.l_partkey % 100 as varchar)) as access_item,
    l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_quantity,
    row_number() over (partition by o.o_custkey, l.l_partkey % 100
                       order by l.l_shipdate, l.l_orderkey, l.l_linenumber) as rn
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey) t where rn = 1""")
def q_dedupe_by_key(ctx):
    sp, d = ctx.spark, ctx.sf_dir
    l = sp.read.parquet(f"{d}/lineitem.parquet")
    o = sp.read.parquet(f"{d}/orders.parquet")
    rows = l.join(o, l.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("item_"), (F.col("l_partkey") % 100).cast("string")).alias("access_item"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return C.dedupe_by_key(rows, ["user_id", "access_item"], ["l_shipdate", "l_orderkey", "l_linenumber"])


@query("clean_table", O.r6(["risk_score"], W(*O.BASE, O.GAPS, O.GAPS_FILLED) +
                           f"select distinct *, {O.parts('request_ts')} from dh_filled"))
def q_clean_table(ctx):
    return C.clean_table(_gaps(ctx), ["request_ts"])


@query("target_extract", W(*O.FEAT) + "select request_id, label from features")
def q_target_extract(ctx):
    return C.target_extract(ctx.ff.encoded, "decision", ["request_id"])


@query("target_distribution", W(*O.FEAT) + "select label, count(*) as n from features group by 1")
def q_target_distribution(ctx):
    return C.value_counts(ctx.features, "label")


@query("exclude_columns", O.r6(["risk_score"], W(*O.ENC) +
                               "select * exclude (request_id, request_ts, approver_id, decision) from encoded"))
def q_exclude_columns(ctx):
    f = ctx.spec.features
    return C.exclude_columns(ctx.ff.encoded, f.target_column, f.exclude_columns)


@query("numeric_only", O.r6(["risk_score"], W(*O.ENC) + "select " + ", ".join(O.FEATURES_LIST) + " from encoded"))
def q_numeric_only(ctx):
    f = ctx.spec.features
    return C.numeric_only(C.exclude_columns(ctx.ff.encoded, f.target_column, f.exclude_columns))


@query("clean_numeric", O.r6(["risk_score", "approver_id"], W(*O.BASE) + """,
g AS (select request_id, case when request_id % 11 < 4 then null else risk_score end as risk_score,
        case when request_id % 7 = 0 then null else approver_id::double end as approver_id from decision_history)
select request_id, coalesce(risk_score, (select median(risk_score) from g)) as risk_score,
  coalesce(approver_id, (select median(approver_id) from g)) as approver_id from g"""))
def q_clean_numeric(ctx):
    """NaN, both infinities and NULL in the risk score, NULL in another column: all become the median."""
    d, rid, x = ctx.tables["decision_history"], F.col("request_id"), F.col("risk_score")
    odd = (F.when(rid % 11 == 0, F.lit(None).cast("double")).when(rid % 11 == 1, F.lit(float("nan")))
            .when(rid % 11 == 2, F.lit(float("inf"))).when(rid % 11 == 3, F.lit(float("-inf"))).otherwise(x))
    g = d.select("request_id", odd.alias("risk_score"),
                 F.when(rid % 7 == 0, F.lit(None)).otherwise(F.col("approver_id")).cast("double").alias("approver_id"))
    return C.clean_numeric(g, ["risk_score", "approver_id"])


@query("process_pipeline", O.r6(O.FEATURES_LIST, W(*O.FEAT) + "select * from features"))
def q_process_pipeline(ctx):
    return ctx.features


# ---------------------------------------------------------------- joins

MERGED_FLOATS = ["risk_score"]


@query("merge_tables", O.r6(MERGED_FLOATS, W(*O.MERGE) + "select * from merged"))
def q_merge_tables(ctx):
    return ctx.merged


@query("join_left", O.r6(MERGED_FLOATS, W(*O.CLEANED) + """
select d.*, p.* exclude (user_id) from dh_c d left join pg_c p on d.user_id is not distinct from p.user_id"""))
def q_join_left(ctx):
    c = ctx.cleaned()
    return join_step(c["decision_history"], c["peer_group"], ["user_id"], "left", "_peer_group")


def _join_sql(how: str) -> str:
    if how == "full":
        keys = ("coalesce(d.user_id, u.user_id) as user_id, coalesce(d.access_item, u.access_item) as access_item, "
                "d.* exclude (user_id, access_item)")
    elif how == "right":
        keys = "u.user_id, u.access_item, d.* exclude (user_id, access_item)"
    else:
        keys = "d.*"
    return O.r6(MERGED_FLOATS, W(*O.CLEANED) + f"""
select {keys}, u.* exclude (user_id, access_item) from dh_c d {how} join au_c u
  on d.user_id is not distinct from u.user_id and d.access_item is not distinct from u.access_item""")


def _join(ctx, how):
    c = ctx.cleaned()
    return join_step(c["decision_history"], c["access_usage"], ["user_id", "access_item"], how, "_access_usage")


@query("join_inner", _join_sql("inner"))
def q_join_inner(ctx):
    return _join(ctx, "inner")


@query("join_right", _join_sql("right"))
def q_join_right(ctx):
    return _join(ctx, "right")


@query("join_outer", _join_sql("full"))
def q_join_outer(ctx):
    return _join(ctx, "outer")


def _with_gaps(ctx):
    """Requests and peers, each without some of its keys, and with a column of the same name."""
    d = ctx.tables["decision_history"].select("request_id", F.when(F.col("request_id") % 50 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
                                              F.col("requester_role").alias("role"))
    p = ctx.tables["peer_group"].select(F.when(F.col("user_id") % 400 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"), "role", "location")
    return d, p


GAP_JOIN_SQL = W(*O.BASE) + """,
d AS (select request_id, case when request_id % 50 = 0 then null else user_id end as user_id, requester_role as role from decision_history),
p AS (select case when user_id % 400 = 0 then null else user_id end as user_id, role, location from peer_group)
"""


@query("join_null_safe", GAP_JOIN_SQL + """
select d.user_id, count(*) as n_rows, count(p.location) as n_matched from d left join p on d.user_id is not distinct from p.user_id group by 1""")
def q_join_null_safe(ctx):
    """Missing keys match each other, as in pandas; the fan-out of the missing key is kept."""
    d, p = _with_gaps(ctx)
    j = join_step(d, p, ["user_id"], "left", "_peer_group")
    return j.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count("location").alias("n_matched"))


@query("join_suffix", GAP_JOIN_SQL + """
select d.request_id, d.user_id, d.role, p.role as role_peer_group, p.location from d join p on d.user_id = p.user_id""")
def q_join_suffix(ctx):
    """A column that both sides have keeps its name on the left and gets the suffix on the right."""
    d, p = _with_gaps(ctx)
    return join_step(d.where("user_id is not null"), p.where("user_id is not null"), ["user_id"], "inner", "_peer_group")


# ---------------------------------------------------------------- encoding

@query("label_encode_fit", W(*O.MERGE) + " union all ".join(
    f"select '{c}' as column_name, value, dense_rank() over (order by value) - 1 as code from "
    f"(select distinct coalesce(cast({c} as varchar), 'nan') as value from merged)" for c in O.CATEGORICAL))
def q_label_encode_fit(ctx):
    return ctx.ff.encoding.mapping


def _apply_sql() -> str:
    def m(c):
        return (f"(select value, dense_rank() over (order by value) - 1 as code from "
                f"(select distinct coalesce(cast({c} as varchar), 'nan') as value from merged))")
    cols = ["role", "department", "location", "employment_type"]
    joins = " ".join(f"left join {m(c)} m_{c} on coalesce(cast(p.{c} as varchar), 'nan') = m_{c}.value" for c in cols)
    sel = ", ".join(f"coalesce(m_{c}.code, -1) as {c}" for c in cols)
    return W(*O.MERGE) + f"select p.user_id, p.peer_group_id, p.seniority_level, {sel} from pg_c p {joins}"


@query("label_encode_apply", _apply_sql())
def q_label_encode_apply(ctx):
    """Encoders fitted on the merged frame, applied to the whole peer table
    (users without requests included)."""
    return label_encode_apply(ctx.cleaned()["peer_group"], ctx.ff.encoding)


@query("standard_scale", O.r6(O.FEATURES_LIST, W(*O.FEAT) + "select request_id, " + ", ".join(
    f"({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1) as {c}" for c in O.FEATURES_LIST)
    + " from features"))
def q_standard_scale(ctx):
    return standard_scale(ctx.features.drop("label"), ctx.ff.feature_columns)
