"""Property tests (few examples each: every example runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings, strategies as st

from govlens.operators import charts as CH, clean as C
from govlens.operators.encode import label_encode_apply, label_encode_fit
from govlens.operators.merge import join_step

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
vals = st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.sampled_from("abc"))),
                min_size=1, max_size=12)


@SETTINGS
@given(vals)
def test_imputation_leaves_no_gaps(spark, rows):
    df = spark.createDataFrame(rows, "x long, s string")
    out = C.impute(df).collect()
    xs = [r[0] for r in rows]
    for r in out:
        assert r["s"] is not None
        assert (r["x"] is None) == all(x is None for x in xs)


@SETTINGS
@given(vals, vals)
def test_left_join_keeps_every_base_row(spark, left, right):
    l = spark.createDataFrame(left, "k long, a string")
    r = spark.createDataFrame(right, "k long, b string")
    out = join_step(l, r, ["k"], "left", "_r")
    matches = {}
    for k, _ in right:
        matches[k] = matches.get(k, 0) + 1
    assert out.count() == sum(max(1, matches.get(k, 0)) for k, _ in left)


@SETTINGS
@given(vals)
def test_encoder_codes_dense_and_ordered(spark, rows):
    df = spark.createDataFrame(rows, "x long, s string")
    enc = label_encode_fit(df, ["s"], "persist")
    classes = sorted({"nan" if s is None else s for _, s in rows})
    got = {r["value"]: r["code"] for r in enc.mapping.collect()}
    assert [got[c] for c in classes] == list(range(len(classes)))
    assert sorted(r["s"] for r in label_encode_apply(df, enc).collect()) == \
        sorted(classes.index("nan" if s is None else s) for _, s in rows)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False)), min_size=1, max_size=30))
def test_histogram_counts_sum_to_non_missing(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    h = CH.histogram(df, "x").collect()
    n = sum(x is not None for x in xs)
    assert sum(r["n"] for r in h) == n
    assert len(h) == (30 if n else 0)
