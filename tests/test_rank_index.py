"""The rank index: any quantile from one build, filled columns without another, hot columns spread."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from govlens.functions.rank_index import RankIndex
from govlens.operators import clean as C
from govlens.operators.anomaly import iqr_bounds

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(size=2000), "b": rng.integers(0, 5, 2000).astype(float), "c": np.nan, "d": 7.0})
    pdf.loc[::3, "a"] = np.nan
    pdf.loc[::4, "b"] = np.nan
    pdf.loc[5, "a"] = np.inf
    return spark.createDataFrame(pdf).repartition(4), pdf


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_columns(data, parts):
    df, pdf = data
    index = RankIndex.of_columns(df, list("abcd"), parts)
    got = index.quantiles(list("abcd"), QS)
    for c in "abd":
        assert np.allclose(got[c], pdf[c].quantile(QS).tolist(), rtol=0, atol=1e-12, equal_nan=True)
    assert got["c"] == [None] * len(QS) and index.count("c") == 0 and index.count("d") == 2000
    # the running weights of the written index, and a column in several parts
    rows = index.table.join(index.spans, ["c", "part"]).select("c", "v", (F.col("off") + F.col("upto")).alias("cum")).toPandas()
    for c in "abd":
        own = rows[rows.c == c].sort_values("v")
        assert own["cum"].tolist() == [(pdf[c] <= v).sum() for v in own["v"]]
    if parts == 17:
        assert index.spans.where("c = 'a'").count() > 5


def test_one_build_answers_for_filled_columns(data, monkeypatch):
    df, pdf = data
    filled, how = C.fill_numeric(df, list("abcd"))
    clean = pdf.replace([np.inf, -np.inf], np.nan)
    want = clean.fillna(clean.median())
    monkeypatch.setattr(RankIndex, "build", classmethod(lambda *a: pytest.fail("built again")))
    got = how.quantiles(list("abcd"), QS)
    for c in "abd":
        assert np.allclose(got[c], want[c].quantile(QS).tolist(), rtol=0, atol=1e-12)
    out = filled.toPandas()
    assert out["c"].isna().all() and np.allclose(np.sort(out["a"]), np.sort(want["a"]))
    b = {r.feature: (r.q1, r.q3) for r in iqr_bounds(filled, list("abcd"), filled=how).collect()}
    assert b["c"] == (None, None) and b["b"] == pytest.approx(tuple(want["b"].quantile([0.25, 0.75])))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float)), min_size=1, max_size=12))
def test_filled_ranks(spark, values):
    index = RankIndex.of_columns(spark.createDataFrame([(v,) for v in values], "x double"), ["x"], 3)
    own = pd.Series([v for v in values if v is not None], dtype=float)
    if own.empty:
        assert index.quantiles(["x"], QS) == {"x": [None] * len(QS)}
        return
    for value in (own.median(), own.min() - 1, own.max() + 0.5):
        gaps = len(values) - len(own) + 2
        got = index.quantiles(["x"], QS, {"x": (value, gaps)})["x"]
        assert np.allclose(got, pd.concat([own, pd.Series([value] * gaps)]).quantile(QS).tolist())


def test_medians_of_all_tables_from_one_build(spark, monkeypatch):
    a = spark.createDataFrame([(1, 2.0), (None, 4.0), (5, None)], "k int, v double")
    b = spark.createDataFrame([(1.0, "x"), (None, "x"), (3.0, None)], "v double, s string")
    c = spark.createDataFrame([(1,)], "v int")
    built = []
    real = RankIndex.build.__func__
    monkeypatch.setattr(RankIndex, "build", classmethod(lambda cls, *x: built.append(1) or real(cls, *x)))
    fits = C.fit_impute_all({"a": a, "b": b, "c": c})
    assert fits["a"].medians == {"k": 3.0, "v": 3.0} and fits["b"].medians == {"v": 2.0} and fits["b"].modes == {"s": "x"}
    assert fits["c"].medians == {} and len(built) == 1


def test_groups_of_any_type_and_none(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 9.0), (2, None), (3, 5.0)], "g int, v double")
    got = {r.c: list(r.q) for r in RankIndex.of_groups(df, "g", "v").group_quantiles([0.5, 1.0]).collect()}
    assert got == {1: [1.5, 2.0], 3: [5.0, 5.0]}
    assert RankIndex.of_groups(df.limit(0), "g", "v").group_quantiles([0.5]).count() == 0


def test_workers_need_no_copy_of_the_library(tmp_path):
    """A driver that finds the library by its own path, started elsewhere."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from govlens.session import build_session
from govlens.functions.rank_index import RankIndex
spark = build_session("local[1]", shuffle_partitions=2)
print("median", RankIndex.of_columns(spark.createDataFrame([(1.0,), (2.0,), (9.0,)], "x double"), ["x"]).quantiles(["x"], [0.5])["x"][0])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "median 2.0" in out.stdout, out.stderr[-2000:]
