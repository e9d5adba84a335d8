"""The dictionary pass of the encoder: same codes, one move of the frame, hot values spread."""

import pytest
from pyspark.sql import functions as F

from govlens.operators import encode

LONG = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    """600 rows; a third of them share one value of every long column."""
    rows = [(i, "hot" if i % 3 == 0 else f"a{i % 151}", "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"b{i % 113}"),
             i if i % 3 else 0, f"s{i % 3}", float(i)) for i in range(600)]
    return spark.createDataFrame(rows, "id int, a string, b string, c int, s string, x double")


@pytest.fixture
def passes(monkeypatch):
    """Every column of more than five classes takes the dictionary pass."""
    monkeypatch.setattr(encode, "SMALL_TOTAL_CLASSES", 0)
    monkeypatch.setattr(encode, "INLINE_MAX_CLASSES", 5)


def plain(frame, columns, unseen=()):
    rows = [r.asDict() for r in frame.collect()]
    out = {}
    for c in columns:
        classes = sorted({"nan" if r[c] is None else str(r[c]) for r in rows})
        out[c] = {v: i for i, v in enumerate(classes)}
    return {(r["id"], *[out[c].get("nan" if r[c] is None else str(r[c]), -1) for c in columns]) for r in rows}


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_codes(frame, passes):
    enc = encode.label_encode_fit(frame, [*LONG, "s"])
    out = encode.label_encode_apply(frame, enc)
    assert out.columns == frame.columns and [t for _, t in out.dtypes] == ["int"] + ["bigint"] * 4 + ["double"]
    assert {(r.id, r.a, r.b, r.c, r.s) for r in out.collect()} == plain(frame, [*LONG, "s"])


def test_unseen_repeated_and_empty(spark, frame, passes):
    enc = encode.label_encode_fit(frame, LONG)
    new = spark.createDataFrame([(1, "hot", "nowhere", -5), (1, "hot", "nowhere", -5), (2, None, None, None)], "id int, a string, b string, c int")
    hot = {r.value: r.code for r in enc.mapping.where("column_name = 'a'").collect()}["hot"]
    none = {r.value: r.code for r in enc.mapping.where("column_name = 'b'").collect()}["nan"]
    assert sorted(map(tuple, encode.label_encode_apply(new, enc).collect())) == [(1, hot, -1, -1)] * 2 + [(2, -1, none, -1)]
    assert encode.label_encode_apply(new.limit(0), enc).count() == 0


def test_the_frame_moves_once_whatever_the_columns(spark, frame, passes):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        path = encode.cut_lineage(frame, "table", "test")
        counts = []
        for columns in (LONG[:1], LONG[:2], LONG):
            out = encode.label_encode_apply(path, encode.label_encode_fit(path, columns))
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == 1                # the frame's; hot keys come by broadcast
            counts.append(exchanges(out))
        assert counts == [2, 2, 2]                                 # the frame and the codes it meets
        # a third of all rows has one value in each column: it is dealt over all partitions
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 600 / 4 * 1.4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_listed_classes_come_by_broadcast(frame, monkeypatch):
    monkeypatch.setattr(encode, "INLINE_MAX_CLASSES", 5)
    enc = encode.label_encode_fit(frame, LONG)
    listed = encode.label_encode_apply(frame, enc)
    assert exchanges(listed) == 0
    monkeypatch.setattr(encode, "BROADCAST_MAX_CHARS", 10)
    assert sorted(map(tuple, encode.label_encode_apply(frame, enc).collect())) == sorted(map(tuple, listed.collect()))
