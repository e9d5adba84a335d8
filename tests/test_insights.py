"""Insights on hand-made frames: IQR, patterns, metrics, clusters, elbow."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from govlens.operators import anomaly as A, charts as CH, metrics as M, patterns as P, risk as R, usage as U


def test_iqr_strict_bounds_and_count_once(spark):
    vals = [(float(i), float(i)) for i in range(1, 10)] + [(100.0, 100.0)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(vals)], "id int, a double, b double")
    b = A.iqr_bounds(df, ["a", "b"])
    s = pd.Series([v[0] for v in vals])
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    row = {r["feature"]: r for r in b.collect()}["a"]
    assert row["q1"] == q1 and row["q3"] == q3
    flagged = A.outlier_flag(df, b)
    out = A.iqr_outliers(flagged).first()
    assert out["outlier_count"] == 1 and out["outlier_percentage"] == 10.0


def _pattern_frame(spark):
    # 40 rows: department D1 high risk 11 rows (7 rejects), D2 high risk 10 rows (6 rejects = 60%)
    rows = []
    for i in range(11):
        rows.append((i, "D1", 0.9, 1 if i < 7 else 0, 3, "Manager", 50))
    for i in range(10):
        rows.append((100 + i, "D2", 0.8, 1 if i < 6 else 0, 12, "Analyst", 3))
    for i in range(19):
        rows.append((200 + i, "D3", 0.1, 0, [6, 20, 22, 23][i % 4], "Manager", 2))
    return spark.createDataFrame(rows, "request_id int, department string, risk_score double, label int, "
                                       "timestamp_hour int, requester_role string, frequency int") \
        .withColumn("access_type", F.lit("Role"))


def test_pattern_thresholds(spark):
    df = _pattern_frame(spark)
    dept = {r["pattern"]: r for r in P.pat_dept_reject(df).collect()}
    assert list(dept) == ["High Risk (>0.7) + D1 Dept"]      # D2 at exactly 60 % is not > 60
    assert dept["High Risk (>0.7) + D1 Dept"]["sample_size"] == 11
    top = P.pat_top_dept_reject(df).first()
    assert top["probability"] == round(7 / 11 * 100, 1)
    mgr = P.pat_manager_low_risk(df).first()              # 19 low-risk managers, all approved
    assert mgr["probability"] == 100.0 and mgr["sample_size"] == 19
    role = P.pat_role_low_risk(df).collect()
    assert [r["pattern"] for r in role] == ["Manager Role + Low Risk (<0.3)"]
    lowf = P.pat_low_frequency(df).collect()             # 10 + 19 rows, 6 rejects -> 20.7 %, not > 60
    assert lowf == []


def test_after_hours_boundaries(spark):
    df = _pattern_frame(spark)
    out = P.pat_after_hours_low_freq(df, "timestamp").collect()
    # hours 22 and 23 (and 3 from D1 rows with frequency >= 10 excluded): 5 + 4 = 9 rows, n must exceed 10
    assert out == []


def test_metrics_zero_division_weighted(spark):
    rows = [(0, 0), (0, 0), (1, 1), (1, 0), (2, 1), (2, 1), (0, 0), (1, 1), (2, 1), (0, 1), (1, 1), (2, 1)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = M.classification_metrics(df, binary=False).first()
    y = np.array([r[0] for r in rows]); p = np.array([r[1] for r in rows])
    prec, rec, f1, sup = [], [], [], []
    for c in (0, 1, 2):
        tp = ((y == c) & (p == c)).sum(); npred = (p == c).sum(); s = (y == c).sum()
        prec.append(tp / npred if npred else 0.0); rec.append(tp / s if s else 0.0)
        f1.append(2 * tp / (s + npred) if (s + npred) else 0.0); sup.append(s)
    w = np.array(sup) / sum(sup)
    assert m["accuracy"] == pytest.approx((y == p).mean())
    assert m["precision"] == pytest.approx(float((np.array(prec) * w).sum()))
    assert m["f1_score"] == pytest.approx(float((np.array(f1) * w).sum()))
    cm = M.confusion_matrix(df).collect()
    assert len(cm) == 9 and {(r["label"], r["prediction"]) for r in cm if r["n"] == 0} == {(0, 2), (1, 2), (2, 0), (2, 2)}


def test_regression_metrics_closed_form(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.0)], "label double, prediction double")
    r = M.regression_metrics(df).first()
    y = np.array([1.0, 2, 3, 4]); p = np.array([1.5, 1.5, 3.5, 3.0])
    assert r["mse"] == pytest.approx(((y - p) ** 2).mean())
    assert r["r2_score"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def _clusters(spark):
    pts = [(0.0, 0.0, 0), (0.0, 1.0, 0), (1.0, 0.0, 0), (5.0, 5.0, 1), (5.0, 6.0, 1), (6.0, 5.0, 1),
           (10.0, 0.0, 2), (10.0, 1.0, 2), (11.0, 0.0, 2)]
    return pts, spark.createDataFrame(pts, "x double, y double, cluster int")


def test_silhouette_and_davies_bouldin_by_hand(spark):
    pts, df = _clusters(spark)
    X = np.array([p[:2] for p in pts]); lab = np.array([p[2] for p in pts])
    d2 = ((X[:, None] - X[None]) ** 2).sum(-1)
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert M.silhouette_sq(df, ["x", "y"]).first()[0] == pytest.approx(np.mean(s))
    cen = np.array([X[lab == c].mean(0) for c in range(3)])
    si = np.array([np.sqrt(((X[lab == c] - cen[c]) ** 2).sum(1)).mean() for c in range(3)])
    db = np.mean([max((si[i] + si[j]) / np.linalg.norm(cen[i] - cen[j]) for j in range(3) if j != i) for i in range(3)])
    assert M.davies_bouldin(df, ["x", "y"]).first()[0] == pytest.approx(db)
    inert = sum(((X[lab == c] - cen[c]) ** 2).sum() for c in range(3))
    assert M.inertia(df, ["x", "y"]).first()[0] == pytest.approx(inert)


def test_elbow(spark):
    f = spark.createDataFrame([(2, 100.0), (3, 60.0), (4, 10.0), (5, 9.0)], "k long, inertia double")
    assert M.elbow_k(f).first()["best_k"] == 3
    one = spark.createDataFrame([(2, 100.0)], "k long, inertia double")
    assert M.elbow_k(one).first()["best_k"] == 2


def test_histogram_constant_and_sum(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "x double")
    h = CH.histogram(df, "x").toPandas()
    assert len(h) == 30 and h["n"].sum() == 5 and h.loc[h["n"] > 0, "bin"].tolist() == [15]
    vals = spark.createDataFrame([(float(i),) for i in range(31)], "x double")
    hv = CH.histogram(vals, "x").toPandas()
    ref, _ = np.histogram(np.arange(31.0), bins=30)
    assert hv.sort_values("bin")["n"].tolist() == ref.tolist()


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    out = {(r["feature_a"], r["feature_b"]): r["corr"] for r in CH.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert out[("a", "c")] is None and out[("c", "c")] is None
    assert out[("a", "b")] == pytest.approx(pd.Series([1.0, 2, 3]).corr(pd.Series([2.0, 4.1, 5.9])))


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "access_item string, user_id string, frequency double, risk_score double, "
                                  "last_used_date timestamp_ntz, department string, role string")
    assert U.low_usage_items(e).count() == 0
    assert U.unused_items(e, "2001-01-01 00:00:00").count() == 0
    ov = R.risk_overall(e).first()
    assert ov["mean_risk"] is None and ov["high_risk_percentage"] is None
    assert R.risk_by_group(e, "role").count() == 0
    missing = spark.createDataFrame([(1,)], "x int")
    assert U.low_usage_items(missing).count() == 0 and R.risk_overall(missing).count() == 0


def test_box_stats_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 400), "x": rng.normal(size=400)})
    got = {r["g"]: r for r in CH.box_stats(spark.createDataFrame(pdf), "x", "g").collect()}
    for g in ("a", "b"):
        x = pdf.loc[pdf.g == g, "x"]
        q1, q2, q3 = x.quantile([0.25, 0.5, 0.75])
        inside = x.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        r = got[g]
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, q2, q3], abs=1e-12)
        assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (x[inside].min(), x[inside].max(), (~inside).sum())
