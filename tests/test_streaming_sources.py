"""Micro-batch adapter, CSV source, JDBC options."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from govlens.operators import risk as R
from govlens.sources import files, jdbc
from govlens.streaming.microbatch import run_per_batch, stream_table


def test_microbatch_runs_operator(spark):
    d = tempfile.mkdtemp()
    src, sink, ck = os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ck")
    df = spark.createDataFrame([("A", 0.9), ("A", 0.5), ("B", 0.8)], "department string, risk_score double")
    df.write.parquet(src)
    q = run_per_batch(stream_table(spark, src, df.schema), lambda b: R.risk_by_group(b, "department"), sink, ck)
    q.awaitTermination(120)
    out = spark.read.parquet(sink).orderBy("department").collect()
    assert [(r["department"], r["count"]) for r in out] == [("A", 2), ("B", 1)]


def test_csv_na_tokens_and_types(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write("a,b,c,d\n1,x,True,2.5\nNA,N/A,False,\n3,null,True,nan\n")
    df = files.read_csv(spark, p)
    types = dict(df.dtypes)
    assert types == {"a": "bigint", "b": "string", "c": "boolean", "d": "double"}
    rows = df.orderBy(F.col("a").asc_nulls_last()).collect()
    assert rows[2]["a"] is None and rows[1]["b"] is None and rows[1]["d"] is None


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:mysql://h/db", "decision_history", user="u", password="p",
                          partition_column="request_id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["partitionColumn"] == "request_id" and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", partition_column="k")


def test_load_spec_yaml_layout(tmp_path):
    from govlens.spec import load_spec
    p = tmp_path / "schema.yaml"
    # fixed values: the keys that a configuration file has
    p.write_text("""
tables:
  decision_history:
    columns: [request_id, user_id, decision]
    primary_key: request_id
merge_strategy:
  base_table: decision_history
  joins:
    - table: access_usage
      "on": [user_id, access_item]
      how: left
    - not_a_dict
ml_config:
  target_column: decision
  models:
    classification: {enabled: false}
insights_config:
  risk_threshold: 0.8
""")
    spec = load_spec(str(p))
    assert spec.tables["decision_history"].columns == ["request_id", "user_id", "decision"]
    assert spec.merge.joins[0].on == ["user_id", "access_item"] and spec.merge.joins[1] is None
    assert spec.models.classification_enabled is False and spec.insights.risk_threshold == 0.8


def test_forms_keep_every_number(spark):
    """Whatever casts to a number passes the form that is asked for first; dates and words don't, and cost no failed cast."""
    tried = ["1", " 7", "+5", "-3 ", "\t12\n", "1.5", ".5", "5.", "-.5e-3", "1E+9", "1e5d", "2f", "3D", "NaN", "nan", "Infinity", "-inf", "+INF", "0x1.8p1",
             "0x1p-3", "00012", "9223372036854775808", "\u00011\u0001", "item_12", "2001-01-01", "2001-01-01 10:00:00", "A", "F", "1-2", "", "--", "e5"]
    df = spark.createDataFrame([(x,) for x in tried], "v string")
    rows = df.select("v", F.expr("try_cast(v as bigint)").isNotNull().alias("long"), F.expr("try_cast(v as double)").isNotNull().alias("double"),
                     F.col("v").rlike(files._WHOLE).alias("may_long"), (F.col("v").rlike(files._NUMBER) & ~F.col("v").rlike("[0-9][+-]")).alias("may_double")).collect()
    assert all(r.may_long or not r.long for r in rows) and all(r.may_double or not r.double for r in rows)
    never = {r.v for r in rows if not r.may_double}
    assert {"item_12", "2001-01-01", "2001-01-01 10:00:00", "A", "F", "1-2"} <= never and all(not r.may_long for r in rows if r.v in never)
    kinds = files.infer_types(spark.createDataFrame([(" 1", "1e3", "2001-01-01", "True", "A")], "a string, b string, c string, d string, e string"))
    assert [t for _, t in kinds.dtypes] == ["bigint", "double", "string", "boolean", "string"]
