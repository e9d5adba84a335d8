"""Rows that must not be lost, switches that must not change results, and plans that must stay cheap."""

import logging
import math
import tempfile
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from govlens import session
from govlens.functions.quantiles import grouped_quantiles
from govlens.models.split import cv_folds, random_split, stratified_split
from govlens.operators import charts, encode, metrics, patterns, usage
from govlens.sources import catalog, jdbc
from govlens.spec import PipelineSpec, TableSpec, load_spec


def test_rows_without_a_class_stay(spark):
    df = spark.range(40).select(F.col("id"), F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("label"))
    out = stratified_split(df, ["id"], "label", test_fraction=0.2).collect()
    assert len(out) == 40 and len({r.id for r in out}) == 40
    assert sum(r.is_test for r in out if r.label is None) == 2            # a tenth of a class of its own
    folds = cv_folds(df, ["id"], "label", 5).groupBy("label", "fold").count().collect()
    assert sum(r["count"] for r in folds) == 40 and {r["count"] for r in folds if r.label is None} == {2}


def test_a_split_needs_a_key(spark):
    df = spark.range(4).withColumn("label", F.lit(1))
    for call in (lambda: stratified_split(df, []), lambda: random_split(df, []), lambda: cv_folds(df, [])):
        with pytest.raises(ValueError, match="key"):
            call()


def test_no_local_folder_on_a_cluster():
    def fake(master, conf=None):
        ctx = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=ctx, conf=SimpleNamespace(get=lambda k, d=None: conf))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake(master))
        assert session.ensure_checkpoint_dir(fake(master, "hdfs://x/c")) == "hdfs://x/c"
    assert session.ensure_checkpoint_dir(fake("local[4]"), "/tmp/some") == "/tmp/some"


@pytest.mark.parametrize("columns,expected", [
    ({"a": [1.0, 1, 1, 1], "b": [1.0, 2, 3, 5]}, {("a", "a"): None, ("a", "b"): None, ("b", "b"): 1.0}),
    ({"a": [2.0, 2, 2, 2]}, {("a", "a"): None}),
    ({"b": [1.0, 2, 3, 5]}, {("b", "b"): 1.0}),
    ({"a": [1.0, 1, 1, 1], "c": [3.0, 3, 3, 3]}, {("a", "a"): None, ("a", "c"): None, ("c", "c"): None}),
    ({"b": [1.0, 2, 3, 4], "c": [8.0, 6, 4, 2], "a": [0.0, 0, 0, 0]}, {("b", "c"): -1.0, ("a", "b"): None, ("b", "b"): 1.0, ("c", "c"): 1.0}),
])
def test_constants_have_no_correlation(spark, columns, expected):
    df = spark.createDataFrame(pd.DataFrame(columns))
    got = {(r.feature_a, r.feature_b): r["corr"] for r in charts.correlation_matrix(df, list(columns)).collect()}
    assert len(got) == len(columns) ** 2
    for k, v in expected.items():
        assert got[k] is None if v is None else math.isclose(got[k], v)


def test_grouped_quantiles_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"c": rng.integers(0, 300, 20_000), "v": rng.random(20_000)})
    pdf.loc[:3000, "c"] = 7                                                 # a large group
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([(7, None), (999, None), (1000, 3.0)], "c long, v double"))
    got = {r.c: list(r.q) for r in grouped_quantiles(df, [0.25, 0.5, 0.75]).collect()}
    want = pdf.groupby("c").v.quantile([0.25, 0.5, 0.75]).unstack()
    assert set(got) == set(want.index) | {1000} and got[1000] == [3.0] * 3
    assert all(np.allclose(got[c], want.loc[c]) for c in want.index)


def test_encoding_agrees_on_both_sides_of_the_switch(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"v{i % 130:03d}" if i % 7 else None) for i in range(400)], "id int, c string")
    enc = encode.label_encode_fit(df, ["c"])
    joined = sorted(map(tuple, encode.label_encode_apply(df, enc).collect()))
    assert enc.sizes["c"] > encode.INLINE_MAX_CLASSES
    monkeypatch.setattr(encode, "INLINE_MAX_CLASSES", 1000)
    assert sorted(map(tuple, encode.label_encode_apply(df, enc).collect())) == joined


def test_unused_items_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql("""select * from values (1, 'a', timestamp_ntz'2001-01-01 10:00:00'), (2, 'a', timestamp_ntz'2001-08-31 12:00:00'),
                 (3, 'b', timestamp_ntz'2001-11-30 00:00:00'), (4, 'b', null), (5, 'c', timestamp_ntz'2001-09-01 13:00:00') as t(user_id, access_item, last_used_date)""") \
        .write.parquet(path)
    df = spark.read.parquet(path)
    out = usage.unused_items(df, "2001-12-01 12:30:00")
    assert "LessThanOrEqual(last_used_date" in out._jdf.queryExecution().executedPlan().toString()
    as_text = usage.unused_items(df.withColumn("last_used_date", F.col("last_used_date").cast("string")), "2001-12-01 12:30:00")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, as_text.collect()))
    assert {r.access_item: r.user_count for r in out.collect()} == {"a": 2}


def test_outcome_codes_follow_the_encoding(spark):
    rows = [(i, d, "Sales", 0.9) for i, d in enumerate(["approve"] * 4 + ["escalate"] * 3 + ["reject"] * 13)]
    df = spark.createDataFrame(rows, "id int, decision string, department string, risk_score double")
    enc = encode.label_encode_fit(df, ["decision"])
    codes = patterns.outcome_codes(enc, "decision")
    assert codes == {"reject_code": 2, "approve_code": 0}
    labeled = encode.label_encode_apply(df.withColumn("label", F.col("decision")), encode.LabelEncoding(
        enc.mapping.withColumn("column_name", F.lit("label")), {"label": 3}))
    r = patterns.pat_top_dept_reject(labeled, patterns.RuleParams(**codes)).first()
    assert r.probability == 65.0


def test_the_best_of_a_run_that_only_clusters(spark):
    from govlens.models.train import TrainResult
    from govlens.plans.pipeline import best_trained
    found = {n: TrainResult(n, "clustering", None, {"silhouette": v}) for n, v in (("a", 0.2), ("b", 0.5), ("c", 0.5))}
    assert tuple(best_trained(spark, found).first()) == ("b", "silhouette", 0.5)
    assert best_trained(spark, {"r": TrainResult("r", "regressor", None, {"r2_score": -1.0}), **found}).first().model == "r"
    assert best_trained(spark, {}) is None


def test_confusion_matrix_cells(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (2, 2.0), (2, 2.0)], "label int, prediction double")
    full = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()}
    assert full == {(a, b): {(0, 0): 1, (0, 1): 1, (2, 2): 2}.get((a, b), 0) for a in (0, 1, 2) for b in (0, 1, 2)}
    assert {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df, zero_cells=False).collect()} == {(0, 0): 1, (0, 1): 1, (2, 2): 2}
    assert metrics.confusion_matrix(df.limit(0)).count() == 0


def test_one_pass_over_the_rows_for_metrics(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([(0, 0.0), (1, 0.0), (1, 1.0)], "label int, prediction double").write.parquet(path)
    plan = metrics.classification_metrics(spark.read.parquet(path), True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1, plan


def test_jdbc_table_spec(spark, monkeypatch):
    spec = PipelineSpec.from_dict({"tables": {"t": {"format": "jdbc", "columns": ["a", "b"], "options": {
        "url": "jdbc:x", "user": "u", "partition_column": "a", "lower_bound": 0, "upper_bound": 9, "num_partitions": 3}}}}).tables["t"]
    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = catalog.load_table(SimpleNamespace(read=Reader()), "/nowhere", spec)
    assert out.columns == ["a", "b"] and out.count() == 1
    assert seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u", "fetchsize": "10000", "partitionColumn": "a",
                    "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    with pytest.raises(ValueError):
        jdbc.jdbc_options("u", "t", partition_column="a")


def test_a_spec_file_means_csv(tmp_path):
    p = tmp_path / "s.json"
    p.write_text('{"tables": {"t": {"columns": ["a"]}, "u": {"format": "parquet"}}}')
    tables = load_spec(str(p)).tables
    assert (tables["t"].format, tables["u"].format, TableSpec("x").format) == ("csv", "parquet", "parquet")


def test_replayed_batches_are_written_once(spark, tmp_path):
    from govlens.streaming.microbatch import run_per_batch, stream_table
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(src)
    for attempt in range(2):                                              # a new checkpoint replays batch 0
        run_per_batch(stream_table(spark, src, "id long"), lambda b: b, out, str(tmp_path / f"c{attempt}")).awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 3, 4] and {r.batch_id for r in rows} == {0}


def test_insights_mode_gives_what_full_mode_gives(spark):
    from govlens.plans.pipeline import run_pipeline
    from govlens.sources.bindings import load_bound_tables
    from govlens.spec import binding_spec
    logging.disable(logging.ERROR)
    spec, sf, as_of = binding_spec(), "/root/testdata/sf0.001", "2001-12-01 12:30:00"
    spec.models.classification_algorithms = ["random_forest"]
    spec.features.key_columns = []                                        # the base table's primary key is taken
    tables, models = load_bound_tables(spark, sf), tempfile.mkdtemp()
    from govlens.plans import pipeline as PL
    full = run_pipeline(spark, spec, sf, as_of, "full", models_dir=models, tables=tables, n_trees=5)
    assert full.ff.key_columns == ["request_id"]
    km = PL.TR.kmeans_fit(full.ff.features, full.ff.feature_columns, 3, n_init=2)
    assigned = km.transform(full.ff.features).select("request_id", F.col("cluster").cast("int"))
    clusters = PL.TR.TrainResult("kmeans", "clustering", km, {}, None, {"assignments": assigned})
    PL.TR.save_model(km, f"{models}/kmeans_clustering")
    assigned.write.mode("overwrite").parquet(f"{models}/kmeans_clustering{PL.ASSIGNMENTS}")
    want = PL.insights_stage(full.ff, spec, as_of, {**full.models, "kmeans_clustering": clusters})
    again = run_pipeline(spark, spec, sf, as_of, "insights", models_dir=models, tables=tables)
    assert set(want) - set(again.insights) == {"best_model"}              # nothing was trained, so nothing is the best
    for name, df in again.insights.items():
        # sums of doubles differ in their last digits with the order of the rows
        a, b = (sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in x.collect()) for x in (want[name], df))
        assert a == b, name
    assert [r.model for r in want["best_model"].collect()] == ["random_forest"]
    # k-means saved without its assignments: no cluster insights, and the rest as before
    bare = PL.insights_stage(full.ff, spec, as_of, {"kmeans_clustering": PL.TR.TrainResult("kmeans", "clustering", km, {})})
    assert not {"cluster_distribution", "cluster_profiles", "best_model"} & set(bare) and "anomalies" in bare
    assert any(r.section == "feature_importance" for r in again.insights["report_metrics"].collect())
