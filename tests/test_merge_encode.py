"""Joins (fan-out, null-safe keys, suffixes, skip rules) and encoders."""

import pandas as pd
import pytest

from govlens.operators.encode import label_encode_apply, label_encode_fit, standard_scale
from govlens.operators.merge import join_step, merge_tables
from govlens.spec import MergeSpec


def test_fanout_nullsafe_suffix(spark):
    left = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (None, "z", 3.0)], "k int, a string, v double")
    right = spark.createDataFrame([(1, 10.0), (1, 11.0), (None, 12.0), (4, 13.0)], "k int, v double")
    out = join_step(left, right, ["k"], "left", "_right").toPandas()
    ref = pd.DataFrame({"k": [1, 2, None], "a": ["x", "y", "z"], "v": [1.0, 2.0, 3.0]}).merge(
        pd.DataFrame({"k": [1, 1, None, 4], "v": [10.0, 11.0, 12.0, 13.0]}), on="k", how="left", suffixes=("", "_right"))
    assert sorted(out.columns) == sorted(ref.columns)
    key = lambda d: sorted(map(tuple, d[["a", "v", "v_right"]].fillna(-1).values.tolist()))
    assert key(out) == key(ref)
    assert len(out) == 4                                   # fan-out kept, NULL keys matched
    outer = join_step(left, right, ["k"], "outer", "_right")
    assert outer.count() == 5


def test_suffix_collision_raises(spark):
    left = spark.createDataFrame([(1, 1.0, 2.0)], "k int, v double, v_r double")
    right = spark.createDataFrame([(1, 3.0)], "k int, v double")
    with pytest.raises(ValueError):
        join_step(left, right, ["k"], "left", "_r")


def test_merge_skip_rules(spark):
    base = spark.createDataFrame([(1, "a")], "k int, s string")
    other = spark.createDataFrame([(1, 5)], "k int, n int")
    spec = MergeSpec.from_dict({"base_table": "b", "joins": [
        {"table": "missing", "on": ["k"]}, {"table": "o", "on": ["nokey"]}, "junk", {"table": "o", "on": ["k"]}]})
    out = merge_tables({"b": base, "o": other}, spec)
    assert out.columns == ["k", "s", "n"]
    assert merge_tables({"b": base}, MergeSpec("zzz")).count() == 0
    assert merge_tables({"b": base}, None).columns == ["k", "s"]


def test_unseen_and_nan_class(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "c string")
    enc = label_encode_fit(fit, ["c"], "persist")
    codes = {r["value"]: r["code"] for r in enc.mapping.collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, "nan": 3}     # sorted by code point, missing -> 'nan'
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    assert [r["c"] for r in label_encode_apply(new, enc).collect()] == [0, -1, 3]


def test_booleans_encode_in_order(spark):
    df = spark.createDataFrame([(True,), (False,), (True,)], "b boolean")
    enc = label_encode_fit(df, ["b"], "persist")
    assert [r["b"] for r in label_encode_apply(df, enc).collect()] == [1, 0, 1]


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (5.0, 5.0)], "x double, c double")
    out = standard_scale(df, ["x", "c"]).toPandas()
    x = pd.Series([1.0, 2, 3, 4, 5])
    assert out["x"].round(9).tolist() == ((x - x.mean()) / x.std(ddof=0)).round(9).tolist()
    assert out["c"].tolist() == [0.0] * 5


def test_distributed_dense_index_path(spark):
    import govlens.operators.encode as EN
    rows = [(f"v{i % 37}", f"w{(i * 7) % 11}") for i in range(300)] + [(None, "w1")]
    df = spark.createDataFrame(rows, "a string, b string")
    old = EN.SMALL_TOTAL_CLASSES
    EN.SMALL_TOTAL_CLASSES = 0                      # force the range-partitioned dense rank
    try:
        enc = label_encode_fit(df, ["a", "b"], "persist")
    finally:
        EN.SMALL_TOTAL_CLASSES = old
    got = {(r["column_name"], r["value"]): r["code"] for r in enc.mapping.collect()}
    for col in ("a", "b"):
        vals = sorted({("nan" if r[0 if col == "a" else 1] is None else r[0 if col == "a" else 1]) for r in rows})
        assert [got[(col, v)] for v in vals] == list(range(len(vals)))
    assert enc.sizes == {"a": 38, "b": 11}
    out = label_encode_apply(df, enc).collect()
    assert out[-1]["a"] == got[("a", "nan")]
