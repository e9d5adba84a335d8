"""k-means from many starts in shared scans; boosting for three classes through scoring, confidence and importances."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F

from govlens.models import manystart as MS
from govlens.models import registry as REG
from govlens.models import train as TR
from govlens.operators import scoring as S

COLS = ["x", "y"]


@pytest.fixture(scope="module")
def blobs(spark):
    """Four groups of 60 rows about far-apart points, a copied row and a constant third column."""
    rng = np.random.default_rng(5)
    at = np.repeat([(0, 0), (40, 0), (0, 40), (40, 40)], 60, axis=0) + rng.normal(size=(240, 2))
    pdf = pd.DataFrame({"id": range(240), "x": at[:, 0], "y": at[:, 1], "z": 1.0})
    pdf.loc[1, COLS] = pdf.loc[0, COLS]
    return spark.createDataFrame(pdf).repartition(3).cache(), pdf


def lloyd(x, centres, steps=MS.MAX_ITER, tol=MS.TOL):
    """One run alone; its number of steps."""
    c = centres.copy()
    for n in range(1, steps + 1):
        own = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        done = ((new - c) ** 2).sum(axis=1).max() <= tol ** 2
        c = new
        if done:
            break
    return c, ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum(), n


def test_every_run_is_its_own_lloyd(blobs, monkeypatch):
    df, pdf = blobs
    begun = []
    real = MS.first_centres

    def keep(*a):
        runs = real(*a)
        begun.extend((r.k, r.seed, r.centres.copy()) for r in runs)
        return runs

    monkeypatch.setattr(MS, "first_centres", keep)
    monkeypatch.setattr(MS, "_BLOCK", 7)
    scanned = []
    count = MS.partial_sums
    monkeypatch.setattr(MS, "partial_sums", lambda *a: scanned.append(len(a[2])) or count(*a))
    runs, scans = MS.many_kmeans(df, COLS, [2, 3, 4, 7], n_init=3)
    assert [(r.k, r.seed) for r in runs] == [(k, s) for k in (2, 3, 4, 7) for s in (42, 43, 44)]       # every start is kept
    steps = []
    for r, (k, seed, c) in zip(runs, begun):
        want, cost, n = lloyd(pdf[COLS].to_numpy(), c)
        assert np.allclose(r.centres, want) and np.isclose(r.cost, cost) and r.steps == n and len(c) == k
        steps.append(n)
    assert scans == max(steps) + 1 == len(scanned)              # not one per run and step
    assert MS.best(runs, 4).cost < 700 < MS.best(runs, 3).cost
    # all rows took part, not only those that the first centres came from
    few, _ = MS.many_kmeans(df, COLS, [4], n_init=2, init_rows=60)
    assert np.isclose(MS.best(few, 4).cost, MS.best(runs, 4).cost)


def test_model_saves_and_assigns(blobs, tmp_path):
    df, pdf = blobs
    model = TR.kmeans_fit(df, COLS, 4, n_init=4)
    out = model.transform(df).toPandas().sort_values("id")
    centres = model.stages[-1].clusterCenters()
    own = ((pdf[COLS].to_numpy()[:, None] - np.array(centres)) ** 2).sum(axis=2).argmin(axis=1)
    assert out["cluster"].tolist() == own.tolist() and pd.Series(own).value_counts().tolist() == [60] * 4
    TR.save_model(model, str(tmp_path / "m"))
    assert TR.load_model(str(tmp_path / "m")).transform(df).toPandas().sort_values("id")["cluster"].tolist() == own.tolist()


def test_clustering_takes_its_model_from_the_elbow_runs(blobs):
    df, _ = blobs
    r = TR.train_clustering(df, [*COLS, "z"], ["id"], n_init=3, max_k=6)
    inertia = {x.k: x.inertia for x in r.extra["inertias"].collect()}
    assert sorted(inertia) == [2, 3, 4, 5, 6] and r.extra["runs"] == 15 and r.extra["scans"] <= MS.MAX_ITER + 1
    assert all(inertia[k + 1] <= inertia[k] * 1.001 for k in range(2, 6))
    a = r.extra["assignments"]
    assert a.count() == 240 and a.select("cluster").distinct().count() == r.metrics["n_clusters"]
    assert TR.elbow_ks(7) == [2, 3] and TR.elbow_ks(3) == []


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(3)
    y = np.arange(360) % 3
    pdf = pd.DataFrame({"id": range(360), "label": y.astype(float), "f1": y * 2 + rng.normal(size=360) * 0.7,
                        "f2": (y == 2) * 3 + rng.normal(size=360), "f3": rng.normal(size=360)})
    return spark.createDataFrame(pdf).cache()


def test_three_class_boosting(spark, classes, tmp_path):
    cols = ["f1", "f2", "f3"]
    (r,), _ = TR.train_classifiers(classes, cols, ["id"], ["gradient_boosting"], n_trees=8)
    assert r.metrics["accuracy"] > 0.75
    scored = TR.score_all(r.model, classes, ["id"])
    assert scored.columns == ["id", "label", "prediction", "probability"]
    rows = scored.collect()
    assert len(rows) == 360 and all(len(x.probability) == 3 and abs(sum(x.probability) - 1) < 1e-12 for x in rows)
    assert all(x.prediction == max(range(3), key=lambda i: x.probability[i]) for x in rows)
    # each share is the part's own probability over the sum of all parts'
    parts = [m.transform(TR.assembler(cols).transform(classes)).select("id", "probability").collect() for m in r.model.stages[-1].models]
    for x, *own in zip(sorted(rows, key=lambda x: x.id), *[sorted(p, key=lambda x: x.id) for p in parts]):
        p = [float(o.probability[1]) for o in own]
        assert np.allclose(x.probability, np.array(p) / sum(p))
    c = S.prediction_confidence(scored).first()
    assert 1 / 3 <= c.mean_confidence <= 1 and c.mean_confidence == pytest.approx(np.mean([max(x.probability) for x in rows]))
    top = S.top_features(r.importances).orderBy("rank").collect()
    assert len(top) == 3 and top[0].feature == "f1" and sum(t.importance for t in top) == pytest.approx(1) and top[-1].feature == "f3"
    path = TR.save_model(r.model, str(tmp_path / "gbt"))
    again = TR.score_all(TR.load_model(path), classes, ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_three_classes_cross_validate(classes):
    from govlens.models import registry as REG
    scores = TR.cross_validate(REG.CLASSIFIERS["gradient_boosting"], classes, ["f1", "f2"], ["id"], 2, 42, {"n_trees": 2, "n_classes": 3})
    assert [r.n_test for r in scores.orderBy("fold").collect()] == [180, 180]


def test_shares_without_any_probability(spark):
    """All parts at zero: equal shares, the first class."""
    from govlens.models.multiclass import BoostedClassesModel

    class Part:
        rawPredictionCol, probabilityCol, predictionCol = "raw", "p", "c"
        def copy(self):
            new = Part()
            new.to = {}
            return new

        def set(self, param, name):
            self.to[param] = name

        def transform(self, df):
            from pyspark.ml.functions import array_to_vector
            return df.withColumn(self.to["p"], array_to_vector(F.array(F.lit(1.0), F.lit(0.0)))) \
                .withColumn(self.to["raw"], F.lit(0)).withColumn(self.to["c"], F.lit(0))

    row = BoostedClassesModel([Part(), Part(), Part()]).transform(spark.range(1)).first()
    assert row.prediction == 0 and np.allclose(row.probability.toArray(), 1 / 3)


def test_fit_partitions_follow_the_cores(spark):
    """Every partition shuffles the statistics of all tree nodes of a pass: there are as many as cores, not as rows ask for."""
    assert [TR.fit_partitions(n, 12) for n in (0, 10, 50_000, 600_000, 6_000_000, 36_000_000)] == [1, 1, 3, 12, 12, 72]
    cores = spark.sparkContext.defaultParallelism
    assert TR._compact(spark.range(0, 10_000_000, 1, 300), 5_000_000).rdd.getNumPartitions() == max(cores, 10)
    assert TR._compact(spark.range(0, 100, 1, 2), 10_000_000).rdd.getNumPartitions() == 2


def test_fits_at_once_share_the_cores():
    """Folds are fitted side by side: each has its share of the cores, and no partition more rows than one should hold."""
    assert [TR.fit_partitions(n, 12, 5) for n in (0, 10, 50_000, 600_000, 6_000_000)] == [1, 1, 3, 3, 12]


def test_forests_keep_rows_nodes_and_have_the_same_trees(spark):
    """Tasks don't send each row down all trees so far again in every pass."""
    df = TR.assembler(["a", "b"]).transform(spark.range(0, 600, 1, 2).selectExpr(
        "id % 97 as a", "id % 31 as b", "cast(id % 97 + id % 31 > 60 as double) as label")).persist()
    for table in (REG.CLASSIFIERS, REG.REGRESSORS):
        forest = table["random_forest"]({"n_trees": 3, "max_depth": 6})
        assert forest.getCacheNodeIds()
        plain = forest.copy({forest.cacheNodeIds: False})
        kept, sent = ([t.toDebugString.split("\n", 1)[1] for t in f.fit(df).trees] for f in (forest, plain))
        assert kept == sent and len(kept) == 3
    df.unpersist()


class _Seen(Estimator):
    """Notes how many rows each partition of its fit has, then fits a plain model."""

    def __init__(self, sizes):
        super().__init__()
        self.sizes = sizes

    def _fit(self, dataset):
        self.sizes.append(dataset.select("label").rdd.glom().map(len).collect())
        return REG.CLASSIFIERS["logistic_regression"]({"n_train": 100}).setMaxIter(1).fit(dataset)


@pytest.fixture
def lumpy(spark):
    """400 rows in two partitions, one of them with nine tenths of the rows; keys that repeat, some of them null."""
    big, small = (spark.range(a, b, 1, 1) for a, b in ((0, 360), (360, 400)))
    return big.union(small).selectExpr("nullif(id % 40, 7) as id", "id % 5 as a", "cast(id % 2 as double) as label")


def test_fits_get_even_partitions(spark, lumpy, monkeypatch):
    """A pass lasts as long as its largest partition; a split's own are uneven and may be fewer than the cores."""
    monkeypatch.setattr(TR, "ROWS_PER_TASK", 100)
    sizes = []
    monkeypatch.setitem(REG.CLASSIFIERS, "seen", lambda ctx: _Seen(sizes))
    (r,), split = TR.train_classifiers(lumpy, ["a"], ["id"], ["seen"])
    TR.cross_validate(lambda ctx: _Seen(sizes), lumpy, ["a"], ["id"], 2, parallelism=1)
    assert len(sizes) == 3 and all(len(s) == TR.fit_partitions(400, spark.sparkContext.defaultParallelism) for s in sizes)
    assert all(max(s) <= 1.5 * min(s) for s in sizes) and split.count() == 400
    dealt = TR._dealt(lumpy, 400, ["id"])
    assert sorted(dealt.rdd.glom().map(len).collect()) == [100] * 4
    assert sorted(map(tuple, dealt.fillna(-1).collect())) == sorted(map(tuple, lumpy.fillna(-1).collect()))
    assert all(p == sorted(p) for p in dealt.fillna(-1).rdd.map(lambda x: x.id).glom().collect())


def test_metrics_read_written_answers(lumpy, monkeypatch):
    """The stages of the metrics aren't sent the model: they read what it answered, every test row once."""
    read = []
    for name in ("classification_metrics", "regression_metrics"):
        real = getattr(TR.M, name)
        monkeypatch.setattr(TR.M, name, lambda df, *a, _real=real, **k: read.append((df.count(), len(df.inputFiles()))) or _real(df, *a, **k))
    TR.train_classifiers(lumpy, ["a"], ["id"], ["logistic_regression"])
    TR.train_regressors(lumpy, ["a"], ["id"], ["linear_regression"])
    assert [n for n, _ in read] == [80, 80] and all(files for _, files in read)


def test_classifiers_of_a_query_share_one_split(monkeypatch):
    from govlens.plans import q_models as Q
    from types import SimpleNamespace as NS
    asked = []
    monkeypatch.setattr(TR, "train_classifiers", lambda f, c, k, names, **kw: (asked.append(names) or [NS(name=n) for n in names if n != "b"], None))
    ctx = NS(extra={}, features=None, ff=NS(feature_columns=[]), spec=NS(models=NS(settings={})))
    assert Q.trained(ctx, ["a", "b"])["b"] is None and Q.classifier(ctx, "a").name == "a"
    assert list(Q.trained(ctx, ["c", "a", "b"])) == ["c", "a", "b"] and asked == [["a", "b"], ["c"]]
