"""Splits, folds, registry, a model quality floor and persistence."""

import os
import tempfile

from pyspark.sql import functions as F

from govlens.models import registry as REG
from govlens.models import train as TR
from govlens.models.split import cv_folds, stratified_split


def _separable(spark, n=200):
    rows = [(i, float(i % 2), float(i % 2) * 3 + (i % 7) * 0.1, float(i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "request_id long, label double, f1 double, f2 double")


def test_split_exact_sizes_and_disjoint(spark):
    df = _separable(spark, 203)
    s = stratified_split(df, ["request_id"], "label").toPandas()
    for c, g in s.groupby("label"):
        assert g["is_test"].sum() == int(len(g) * 0.2 + 0.5)
    assert s["request_id"].is_unique and len(s) == 203
    folds = cv_folds(df, ["request_id"], "label", 5).toPandas()
    assert set(folds["fold"]) == {0, 1, 2, 3, 4}
    sizes = folds.groupby(["label", "fold"]).size()
    assert sizes.max() - sizes.min() <= 1


def test_registry_skips_unavailable():
    got = REG.resolve(["random_forest", "xgboost", "nope", "logistic_regression"], REG.CLASSIFIERS)
    names = [n for n, f, st in got if f is not None]
    assert names[0] == "random_forest" and names[-1] == "logistic_regression" and "nope" not in names
    assert REG.pick_saved_classifier(["logistic_regression_classifier", "gradient_boosting_classifier"]) \
        == "gradient_boosting_classifier"
    assert REG.pick_saved_classifier([]) is None


def test_quality_floor_and_persistence(spark):
    df = _separable(spark)
    res, split = TR.train_classifiers(df, ["f1", "f2"], ["request_id"], ["logistic_regression", "random_forest"],
                                      n_trees=10)
    assert [r.name for r in res] == ["logistic_regression", "random_forest"]
    for r in res:
        assert r.metrics["accuracy"] >= 0.5
    rf = res[1]
    assert rf.importances is not None and rf.importances.count() == 2
    path = os.path.join(tempfile.mkdtemp(), "rf")
    TR.save_model(rf.model, path)
    loaded = TR.load_model(path)
    a = TR.score_all(rf.model, df, ["request_id"]).orderBy("request_id").select("prediction").collect()
    b = TR.score_all(loaded, df, ["request_id"]).orderBy("request_id").select("prediction").collect()
    assert a == b
    assert TR.load_model(path + "-missing") is None


def test_task_detect(spark):
    df = _separable(spark)
    assert TR.detect_task(df).first()["task"] == "classification"
    reg = df.withColumn("label", F.col("request_id").cast("double"))
    assert TR.detect_task(reg).first()["task"] == "regression"
    assert TR.detect_task(df.drop("label")).first()["task"] == "clustering"
