"""Forests and boosted trees: MLlib's own trees where no chance is involved, whole rows, small messages, and files."""

from types import SimpleNamespace as NS

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from govlens.models import train as TR
from govlens.models import trees as T

COLS = ["a", "b", "c", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "a": rng.normal(size=n).round(2), "b": rng.integers(0, 7, n).astype(float), "c": rng.normal(size=n).round(1), "same": 1.0})
    pull = pdf.a + 0.3 * pdf.b + rng.normal(size=n)
    pdf["two"], pdf["three"], pdf["number"] = (pull > 1).astype(float), pull.clip(0, 2.9).astype(int).astype(float), pdf.a * pdf.b + pdf.c
    return TR.assembler(COLS).transform(spark.createDataFrame(pdf).repartition(6)).cache()


def answers(model, df, *cols):
    got = model.transform(df).orderBy("id").select(*cols).toPandas()
    return [np.array([v.toArray() if hasattr(v, "toArray") else v for v in got[c]]) for c in cols]


@pytest.mark.parametrize("label, mine, theirs", [("two", T.ForestClassifier, RandomForestClassifier), ("three", T.ForestClassifier, RandomForestClassifier),
                                                 ("number", T.ForestRegressor, RandomForestRegressor)])
def test_a_tree_of_all_rows_is_mllibs(rows, label, mine, theirs):
    kw = {"numTrees": 1, "bootstrap": False, "maxDepth": 3, "featuresCol": "features", "labelCol": label}
    a, b = (c(**kw).fit(rows) for c in (mine, theirs))
    assert a.totalNumNodes == b.totalNumNodes
    cols = ["prediction"] if label == "number" else ["prediction", "probability", "rawPrediction"]
    for x, y in zip(answers(a, rows, *cols), answers(b, rows, *cols)):
        assert np.allclose(x, y, rtol=0, atol=1e-12)
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())


def test_boosting_is_mllibs(rows):
    """More rounds than go into the blocks' margins at once."""
    kw = {"maxIter": 2 * T.ROUNDS + 3, "maxDepth": 3, "stepSize": 0.1, "featuresCol": "features", "labelCol": "two"}
    a, b = (c(**kw).fit(rows) for c in (T.BoostedClassifier, GBTClassifier))
    for x, y in zip(*(answers(m, rows, "prediction", "probability", "rawPrediction") for m in (a, b))):
        assert np.allclose(x, y, rtol=0, atol=1e-9)
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())
    assert len(a.trees) == 2 * T.ROUNDS + 3 and a.treeWeights[:2] == [1.0, 0.1]


def test_a_forest_is_as_good_as_mllibs(rows):
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    for label, mine, theirs, loss in (("two", T.ForestClassifier, RandomForestClassifier, "cast(prediction <> two as double)"),
                                      ("number", T.ForestRegressor, RandomForestRegressor, "pow(prediction - number, 2)")):
        a, b = (c(numTrees=15, maxDepth=8, seed=42, featuresCol="features", labelCol=label).fit(train) for c in (mine, theirs))
        x, y = (m.transform(test).agg(F.avg(F.expr(loss))).first()[0] for m in (a, b))
        assert x <= 1.25 * y, (label, x, y)
        assert len({t.toDebugString for t in a.trees}) == 15                     # bags and columns differ by tree
        again = mine(numTrees=15, maxDepth=8, seed=42, featuresCol="features", labelCol=label).fit(train)
        assert [t.toDebugString for t in again.trees] == [t.toDebugString for t in a.trees]


def test_steps_and_chunks_leave_the_trees_alone(rows, monkeypatch):
    fit = lambda: [t.toDebugString for t in T.ForestClassifier(numTrees=3, maxDepth=7, featuresCol="features", labelCol="three").fit(rows).trees]
    whole = fit()
    for name, value in (("STEP", 64), ("BLOCK", 100), ("NODES", 3), ("CELLS", 1000)):
        monkeypatch.setattr(T, name, value)
    assert fit() == whole


def test_rows_are_a_byte_a_column_on_as_many_partitions_as_cores(spark, rows):
    """A pass shuffled the statistics of all nodes once for each partition, in doubles, and kept a weight and a node of each row for each tree."""
    many = rows.repartition(40)
    b = T.binned(many, "features", "two", 32, True)
    kept = b.blocks.collect()
    assert b.blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sum(len(r.y) for r in kept) == 8 * 3000 and sum(len(r.bins) for r in kept) == 3000 * b.stride == 3000 * 4
    b.blocks.unpersist()
    assert [T._smallest(np.array([0.0, v])).itemsize for v in (255, 256, 65536, 2.0 ** 32)] == [1, 2, 4, 8]


def test_thresholds():
    v = np.arange(10.0)
    assert T.thresholds(v, np.ones(10), 31).tolist() == (v[1:] - 0.5).tolist()
    assert T.thresholds(v, np.array([100.0] + [1] * 9), 3).tolist() == [0.5, 1.5, 2.5]       # a heavy value has one threshold above it
    assert len(T.thresholds(np.arange(1000.0), np.ones(1000), 31)) == 31
    assert len(T.thresholds(v[:1], np.ones(1), 31)) == len(T.thresholds(v[:0], np.ones(0), 31)) == 0
    got, w = T.thinned(np.arange(100_000.0), np.ones(100_000), 1000)
    assert len(got) == 1000 and w.sum() == pytest.approx(100_000) and np.abs(got - (np.arange(1000) + 0.5) * 100).max() <= 1


def test_bags_hold_each_row_once_on_average():
    w = np.concatenate([T.bag(42, t, p, 20_000) for t in range(5) for p in range(2)])
    assert abs(w.mean() - 1) < 0.01 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert (T.bag(42, 1, 0, 50) != T.bag(42, 2, 0, 50)).any() and (T.bag(42, 1, 0, 50) == T.bag(42, 1, 0, 50)).all()


def test_gaps_constants_and_odd_labels(spark):
    """A value that is no number goes right, with the largest; nothing to split gives one leaf; labels must be classes."""
    df = spark.createDataFrame([(i, float("nan") if i % 4 == 0 else float(i % 4), 5.0, float(i % 4 in (0, 3))) for i in range(80)], "id long, a double, b double, label double")
    at = TR.assembler(["a", "b"]).transform(df)
    kw = {"featuresCol": "features", "labelCol": "label"}
    m = T.ForestClassifier(numTrees=1, bootstrap=False, **kw).fit(at)
    x, y = answers(m, at, "prediction", "probability")
    assert x.tolist() == y[:, 1].tolist() == [float(i % 4 in (0, 3)) for i in range(80)] and y.shape == (80, 2)
    flat = TR.assembler(["b"]).transform(df)
    for est in (T.ForestClassifier(numTrees=2, **kw), T.ForestRegressor(numTrees=2, **kw), T.BoostedClassifier(maxIter=2, **kw)):
        m = est.fit(flat)
        assert [t.numNodes for t in m.trees] == [1, 1] and m.featureImportances.toArray().tolist() == [0] and m.transform(flat).count() == 80
    for bad in ("label + 0.5", "label - 1", "nullif(label, 0)"):
        with pytest.raises(ValueError):
            T.ForestClassifier(**kw).fit(at.withColumn("label", F.expr(bad)))
    with pytest.raises(ValueError):
        T.ForestClassifier(**kw).fit(at.limit(0))


def test_models_come_back_from_their_files(rows, tmp_path):
    for i, (est, cols) in enumerate(((T.ForestClassifier(numTrees=4, labelCol="three"), ["prediction", "probability"]), (T.ForestRegressor(numTrees=3, labelCol="number"), ["prediction"]),
                                     (T.BoostedClassifier(maxIter=4, labelCol="two", predictionCol="said"), ["said", "probability"]))):
        m = est.fit(rows)
        m.write().save(str(tmp_path / str(i)))
        again = type(m).load(str(tmp_path / str(i)))
        assert all((x == y).all() for x, y in zip(answers(m, rows, *cols), answers(again, rows, *cols)))
        assert again.uid == m.uid and again.totalNumNodes == m.totalNumNodes and again.featureImportances == m.featureImportances


def test_both_models_score_a_row_in_one_scan(spark, monkeypatch):
    """The trained and the reloaded model each scanned all rows; what they say still meets by the id, which may repeat or be missing."""
    from govlens.plans import q_models as Q
    df = spark.createDataFrame([(None if i % 10 == 0 else i % 37, float(i % 5), float(i % 3), float(i % 2)) for i in range(60)], "request_id long, a double, b double, label double").cache()
    monkeypatch.setattr(Q, "N_TREES", 3)
    ctx = NS(spark=spark, extra={}, features=df, ff=NS(feature_columns=["a", "b"]), spec=NS(models=NS(settings={"max_depth": 4})))
    got = Q.q_sink_model(ctx)
    p = TR.score_all(Q.classifier(ctx, "random_forest").model, df, Q.KEYS).toPandas().dropna(subset="request_id")
    both = p.merge(p, on="request_id")
    assert tuple(got.first()) == ("random_forest", len(both), (both.prediction_x == both.prediction_y).sum()) and len(both) > 54
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and plan.count("Relation [") == 2 and len(got.inputFiles()) >= 1
