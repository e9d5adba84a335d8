"""Decision-pattern mining: which combinations of conditions lead to
rejection or approval.  Input: the merged (unencoded) frame with ``label``,
the encoded decision (approve = 0, reject = 1 by alphabetical encoding).

Every rule is one filtered aggregate (per group where the rule has a group),
so the work is a single pass per rule whatever the data size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from govlens.session import cut_lineage

SCHEMA = "pattern string, outcome string, probability double, sample_size bigint"

# Outcome names and pattern labels of the rules (the numbers
# inside labels are filled from the rule parameters, defaults shown).
REJECTION = "Rejection"
APPROVAL = "Approval"
LABEL_TOP_DEPT = "High Risk (>{thr}) + {dept} Dept"
LABEL_AFTER_HOURS_LOW_FREQ = "After Hours (Before 6AM/After 8PM) + Low Frequency"
LABEL_MANAGER_LOW_RISK = "Manager Role + Low Risk (<{thr})"
LABEL_BUSINESS_HOURS_DEPT = "Business Hours (9-17) + {dept} Dept"
LABEL_DEPT_REJECT = "High Risk (>{thr}) + {dept} Dept"
LABEL_AFTER_HOURS = "After-hours requests (10PM-6AM)"
LABEL_ROLE_LOW_RISK = "{role} Role + Low Risk (<{thr})"
LABEL_LOW_FREQUENCY = "Low Usage Frequency (<{thr})"

# What the decision column calls the two outcomes, and their codes where nothing else is told.
REJECT_VALUE, APPROVE_VALUE = "reject", "approve"
REJECT_CODE = 1
APPROVE_CODE = 0


def outcome_codes(enc, target: str, reject_value: str = REJECT_VALUE, approve_value: str = APPROVE_VALUE) -> dict[str, int]:
    """``RuleParams`` fields for a fitted ``LabelEncoding``: the codes that it gave to the two outcomes.

    With a third decision value the codes move; a value that was never seen
    has the code of none (-1) and no row counts for it.
    """
    found = {r["value"]: r["code"] for r in enc.mapping.where(
        (F.col("column_name") == target) & F.col("value").isin(reject_value, approve_value)).collect()}
    return {"reject_code": int(found.get(reject_value, -1)), "approve_code": int(found.get(approve_value, -1))}


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], SCHEMA)


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def _num(x: float) -> str:
    return f"{x:g}"


def _label(template: str, **kw) -> Column:
    """Pattern label; ``{dept}``/``{role}`` come from a column, numbers are text."""
    parts, rest = [], template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts.append(F.lit(pre))
        v = kw[name]
        parts.append(v if isinstance(v, Column) else F.lit(_num(v) if isinstance(v, (int, float)) else str(v)))
    parts.append(F.lit(rest))
    return F.concat(*parts)


def _out(df: DataFrame, pattern: Column, outcome: str, prob: Column, n: Column) -> DataFrame:
    return df.select(pattern.alias("pattern"), F.lit(outcome).alias("outcome"),
                     prob.cast("double").alias("probability"), n.cast("bigint").alias("sample_size"))


def _hour(df: DataFrame, time_col: str) -> Column:
    part = f"{time_col}_hour"
    return F.col(part) if part in df.columns else F.hour(F.col(time_col).cast("string").try_cast("timestamp_ntz"))


@dataclass(frozen=True)
class RuleParams:
    """Thresholds of all rules (the reference's literals as defaults)."""
    high_risk: float = 0.7          # department rules
    low_risk: float = 0.3           # role rules
    early: int = 6                  # after-hours: hour < early ...
    late_low_freq: int = 20         # ... or hour > late (with low frequency)
    late: int = 22                  # ... or hour > late (decision rule)
    low_freq_after_hours: float = 10
    low_freq: float = 5
    business_start: int = 9
    business_end: int = 17
    reject_code: int = REJECT_CODE  # see ``outcome_codes``
    approve_code: int = APPROVE_CODE


def pattern_counts(df: DataFrame, time_col: str = "timestamp", p: RuleParams = RuleParams()) -> DataFrame:
    """ONE scan for every rule: conditional counts per (department,
    requester_role).  Each rule is a sum over this grid (one row per
    department x role, NULL groups included), so the data is read and
    shuffled once - as map-side partial aggregates - whatever the number of
    rules.  Counts of rules whose input columns are missing are 0 and the
    rule reports nothing (see ``_has``)."""
    cols = set(df.columns)
    lab = F.col("label")
    rej, app = lab == p.reject_code, lab == p.approve_code
    risk = F.col("risk_score") if "risk_score" in cols else F.lit(None).cast("double")
    freq = F.col("frequency") if "frequency" in cols else F.lit(None).cast("double")
    has_hour = f"{time_col}_hour" in cols or time_col in cols
    h = _hour(df, time_col) if has_hour else F.lit(None).cast("int")
    if time_col in cols:
        t = F.col(time_col)
        raw_h = F.hour(t.cast("string").try_cast("timestamp_ntz")) if dict(df.dtypes)[time_col] == "string" else F.hour(t)
    else:
        raw_h = F.lit(None).cast("int")
    conds = {
        "hr": risk > p.high_risk,
        "ahlf": ((h < p.early) | (h > p.late_low_freq)) & (freq < p.low_freq_after_hours),
        "lr": risk < p.low_risk,
        "bh": (h >= p.business_start) & (h <= p.business_end),
        "ah": (raw_h < p.early) | (raw_h > p.late),
        "lf": freq < p.low_freq,
    }
    aggs = []
    for k, c in conds.items():
        c = F.coalesce(c, F.lit(False))
        aggs += [F.count_if(c).alias(f"{k}_n"), F.count_if(c & rej).alias(f"{k}_rej"), F.count_if(c & app).alias(f"{k}_app")]
    dept = F.col("department") if "department" in cols else F.lit(None).cast("string")
    role = F.col("requester_role") if "requester_role" in cols else F.lit(None).cast("string")
    return df.groupBy(dept.alias("department"), role.alias("requester_role")).agg(*aggs)


def written_grid(df: DataFrame, time_col: str = "timestamp", p: RuleParams = RuleParams()) -> DataFrame:
    """``pattern_counts``, written: a row per department and role that any number of rules can read."""
    return cut_lineage(pattern_counts(df, time_col, p), "table", "pattern-grid")


def _grid(df: DataFrame, grid: DataFrame | None, time_col: str, p: RuleParams) -> DataFrame:
    return grid if grid is not None else pattern_counts(df, time_col, p)


def _rate_of(num: str, den: str) -> Column:
    return F.col(num) / F.col(den) * 100.0


def _total(g: DataFrame, k: str, cond: Column | None = None) -> DataFrame:
    g = g.where(cond) if cond is not None else g
    return g.agg(F.sum(f"{k}_n").alias(f"{k}_n"), F.sum(f"{k}_rej").alias(f"{k}_rej"), F.sum(f"{k}_app").alias(f"{k}_app"))


def _by(g: DataFrame, key: str, k: str) -> DataFrame:
    return (g.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.sum(f"{k}_n").alias(f"{k}_n"), F.sum(f"{k}_rej").alias(f"{k}_rej"), F.sum(f"{k}_app").alias(f"{k}_app"))
             .where(F.col(f"{k}_n") > 0))


# ---- the four "approval pattern" rules (rounded to 1 dp, half to even) ----

def pat_top_dept_reject(df: DataFrame, p: RuleParams = RuleParams(), grid: DataFrame | None = None,
                        time_col: str = "timestamp") -> DataFrame:
    """Among rows over the risk threshold, the department with the highest
    rejection share (name breaks ties), kept when that share is above 0."""
    if not _has(df, "risk_score", "department"):
        return _empty(df)
    d = _by(_grid(df, grid, time_col, p), "department", "hr").withColumn("rate", _rate_of("hr_rej", "hr_n"))
    top = d.orderBy(F.desc("rate"), F.asc("department")).limit(1).where(F.col("rate") > 0)
    return _out(top, _label(LABEL_TOP_DEPT, thr=p.high_risk, dept=F.col("department")), REJECTION,
                F.bround("rate", 1), F.col("hr_n"))


def _one_row(g: DataFrame, k: str, code: int, min_n: int, inclusive: bool, label: str, outcome: str,
             cond: Column | None = None, rounded: bool = True, min_rate: float | None = None) -> DataFrame:
    t = _total(g, k, cond)
    num = f"{k}_rej" if code == REJECT_CODE else f"{k}_app"
    t = t.withColumn("rate", _rate_of(num, f"{k}_n"))
    keep = (F.col(f"{k}_n") >= min_n) if inclusive else (F.col(f"{k}_n") > min_n)
    if min_rate is not None:
        keep = keep & (F.col("rate") > min_rate)
    t = t.where(F.coalesce(keep, F.lit(False)))
    return _out(t, F.lit(label), outcome, F.bround("rate", 1) if rounded else F.col("rate"), F.col(f"{k}_n"))


def pat_after_hours_low_freq(df: DataFrame, time_col: str = "timestamp", p: RuleParams = RuleParams(),
                             min_n: int = 10, grid: DataFrame | None = None) -> DataFrame:
    if not (_has(df, "frequency") and (_has(df, f"{time_col}_hour") or _has(df, time_col))):
        return _empty(df)
    return _one_row(_grid(df, grid, time_col, p), "ahlf", REJECT_CODE, min_n, False,
                    LABEL_AFTER_HOURS_LOW_FREQ, REJECTION)


def pat_manager_low_risk(df: DataFrame, role: str = "Manager", p: RuleParams = RuleParams(), min_n: int = 10,
                         grid: DataFrame | None = None, time_col: str = "timestamp") -> DataFrame:
    if not _has(df, "requester_role", "risk_score"):
        return _empty(df)
    label = LABEL_MANAGER_LOW_RISK.replace("Manager", role).format(thr=_num(p.low_risk))
    return _one_row(_grid(df, grid, time_col, p), "lr", APPROVE_CODE, min_n, False, label, APPROVAL,
                    F.col("requester_role") == role)


def pat_business_hours_dept(df: DataFrame, department: str = "IT", time_col: str = "timestamp",
                            p: RuleParams = RuleParams(), min_n: int = 10, grid: DataFrame | None = None) -> DataFrame:
    if not ((_has(df, f"{time_col}_hour") or _has(df, time_col)) and _has(df, "department")):
        return _empty(df)
    return _one_row(_grid(df, grid, time_col, p), "bh", APPROVE_CODE, min_n, False,
                    LABEL_BUSINESS_HOURS_DEPT.format(dept=department), APPROVAL, F.col("department") == department)


def approval_patterns(df: DataFrame, time_col: str = "timestamp", department: str = "IT",
                      p: RuleParams = RuleParams(), grid: DataFrame | None = None) -> DataFrame:
    """The four rules in order, with the rule number and the number found;
    all four read one shared grid of counts: ``grid``, or one scan of ``df``."""
    g = grid if grid is not None else written_grid(df, time_col, p)
    parts = [pat_top_dept_reject(df, p, g), pat_after_hours_low_freq(df, time_col, p, grid=g),
             pat_manager_low_risk(df, p=p, grid=g), pat_business_hours_dept(df, department, time_col, p, grid=g)]
    u = reduce(lambda a, b: a.unionByName(b),
               [q.withColumn("rule", F.lit(i + 1)) for i, q in enumerate(parts)])
    # at most four rows: the global window is over a bounded frame
    return u.withColumn("n_patterns", F.count(F.lit(1)).over(Window.partitionBy()))


# ---- the four "decision pattern" rules (unrounded, thresholds inclusive on n) ----

def pat_dept_reject(df: DataFrame, p: RuleParams = RuleParams(), min_n: int = 10, min_rate: float = 60,
                    grid: DataFrame | None = None, time_col: str = "timestamp") -> DataFrame:
    """Per department, among high-risk rows: n >= min_n and reject % > min_rate."""
    if not _has(df, "risk_score", "department"):
        return _empty(df)
    d = (_by(_grid(df, grid, time_col, p), "department", "hr").withColumn("rate", _rate_of("hr_rej", "hr_n"))
           .where((F.col("hr_n") >= min_n) & (F.col("rate") > min_rate)))
    return _out(d, _label(LABEL_DEPT_REJECT, thr=p.high_risk, dept=F.col("department")), REJECTION,
                F.col("rate"), F.col("hr_n"))


def pat_after_hours(df: DataFrame, time_col: str = "timestamp", p: RuleParams = RuleParams(), min_n: int = 10,
                    grid: DataFrame | None = None) -> DataFrame:
    """Hour < early or > late (the reference's label says 10PM but tests > 22)."""
    if time_col not in df.columns:
        return _empty(df)
    return _one_row(_grid(df, grid, time_col, p), "ah", REJECT_CODE, min_n, True, LABEL_AFTER_HOURS, REJECTION,
                    rounded=False)


def pat_role_low_risk(df: DataFrame, p: RuleParams = RuleParams(), min_n: int = 10, min_rate: float = 80,
                      grid: DataFrame | None = None, time_col: str = "timestamp") -> DataFrame:
    """Per requester role, among low-risk rows: n >= min_n and approve % > min_rate."""
    if not _has(df, "requester_role", "risk_score"):
        return _empty(df)
    d = (_by(_grid(df, grid, time_col, p), "requester_role", "lr").withColumn("rate", _rate_of("lr_app", "lr_n"))
           .where((F.col("lr_n") >= min_n) & (F.col("rate") > min_rate)))
    return _out(d, _label(LABEL_ROLE_LOW_RISK, role=F.col("requester_role"), thr=p.low_risk), APPROVAL,
                F.col("rate"), F.col("lr_n"))


def pat_low_frequency(df: DataFrame, p: RuleParams = RuleParams(), min_n: int = 10, min_rate: float = 60,
                      grid: DataFrame | None = None, time_col: str = "timestamp") -> DataFrame:
    """frequency < low_freq (only when access_type exists): n >= min_n and reject % > min_rate."""
    if not _has(df, "frequency", "access_type"):
        return _empty(df)
    return _one_row(_grid(df, grid, time_col, p), "lf", REJECT_CODE, min_n, True,
                    LABEL_LOW_FREQUENCY.format(thr=_num(p.low_freq)), REJECTION, rounded=False, min_rate=min_rate)


def decision_patterns(df: DataFrame, time_col: str = "timestamp", top: int = 10,
                      low_freq_min_rate: float = 60, p: RuleParams = RuleParams(), grid: DataFrame | None = None) -> DataFrame:
    """All four rules, strongest first (distance of the share from 50 %),
    first ``top``; ``total_patterns`` is the number found before the cut.
    They read ``grid``, or one scan of ``df`` builds it; the union has one row
    per department/role at most, so the final sort and count are bounded."""
    g = grid if grid is not None else written_grid(df, time_col, p)
    parts = [pat_dept_reject(df, p, grid=g), pat_after_hours(df, time_col, p, grid=g),
             pat_role_low_risk(df, p, grid=g), pat_low_frequency(df, p, min_rate=low_freq_min_rate, grid=g)]
    u = reduce(lambda a, b: a.unionByName(b),
               [q.withColumn("rule", F.lit(i + 1)) for i, q in enumerate(parts)])
    u = u.withColumn("total_patterns", F.count(F.lit(1)).over(Window.partitionBy()))
    return (u.orderBy(F.desc(F.abs(F.col("probability") - 50)), F.asc("rule"), F.asc("pattern"))
             .limit(top))
