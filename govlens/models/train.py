"""Training, evaluation, clustering and persistence with MLlib.

Every model is a ``PipelineModel`` (VectorAssembler + estimator) so a saved
model scores any feature frame directly.  Model outputs are comparable to
scikit-learn's in quality, not in value: tree growth, boosting and seeding
differ between the libraries.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from govlens.models import manystart as MS, registry as REG
from govlens.models.split import cv_folds, random_split, stratified_split
from govlens.operators import metrics as M
from govlens.session import cut_lineage

log = logging.getLogger(__name__)


@dataclass
class TrainResult:
    name: str
    kind: str                       # classifier / regressor / clustering
    model: PipelineModel
    metrics: dict
    importances: DataFrame | None = None
    extra: dict = field(default_factory=dict)


def assembler(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


def detect_task(features: DataFrame, target_is_string: bool = False, label: str = "label",
                ratio: float = 0.05) -> DataFrame:
    """(n_distinct, n_rows, task): no label -> clustering; a string target or
    distinct/rows < ratio -> classification; else regression.  One aggregate."""
    if label not in features.columns:
        return features.sparkSession.createDataFrame([(0, 0, "clustering")], "n_distinct long, n_rows long, task string")
    a = features.agg(F.count_distinct(F.col(label)).alias("n_distinct"), F.count(F.lit(1)).alias("n_rows"))
    task = (F.when(F.col("n_rows") == 0, F.lit("clustering"))
             .when(F.lit(target_is_string) | (F.col("n_distinct") / F.col("n_rows") < ratio), F.lit("classification"))
             .otherwise(F.lit("regression")))
    return a.select("n_distinct", "n_rows", task.alias("task"))


def importances_frame(spark: SparkSession, model_name: str, cols: list[str], est_model) -> DataFrame | None:
    """(model, feature, importance) most important first; None when the model has none."""
    imp = getattr(est_model, "featureImportances", None)
    if imp is None:
        return None
    vals = imp.toArray().tolist()
    # one value per feature column: bounded by the schema width
    df = spark.createDataFrame([(model_name, c, float(v)) for c, v in zip(cols, vals)],
                               "model string, feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature"))


def _label_double(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("label").cast("double"))


def _parallel(fn, items, parallelism: int):
    """Run independent Spark fits from several driver threads (Spark schedules
    their jobs side by side, like CrossValidator's ``parallelism``)."""
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(fn, items))


#: Rows that make a partition worth a task of its own in a fit, which starts hundreds of jobs, and the most that one should hold.
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 20_000, 500_000


def fit_partitions(rows: int, cores: int, at_once: int = 1) -> int:
    """As many partitions as ``ROWS_PER_TASK`` asks for, but no more than the cores unless ``MOST_ROWS_PER_TASK`` needs them.

    Fits that run ``at_once`` share the cores.

    In every pass of a tree fit each partition makes, and shuffles, the
    statistics of all nodes of the pass, however few of its rows they get: the
    shuffle grows with the partitions and not with the rows.
    """
    return max(1, min(-(-rows // ROWS_PER_TASK), max(-(-cores // at_once), -(-rows // MOST_ROWS_PER_TASK))))


def _compact(df: DataFrame, rows: int, at_once: int = 1) -> DataFrame:
    """Fewer partitions where there are more than ``fit_partitions`` asks for; never more."""
    return df.coalesce(fit_partitions(rows, df.sparkSession.sparkContext.defaultParallelism, at_once))


def _dealt(df: DataFrame, rows: int, keys: list[str], at_once: int = 1) -> DataFrame:
    """``fit_partitions`` partitions of about equally many rows, each in the order of the keys.

    A pass over the rows lasts as long as its largest partition, and a fit
    makes hundreds of them; a split's own partitions differ in size (those of
    its ranked rows are almost empty) and may be fewer than the cores. Rows are
    dealt in turn, so that keys that repeat or are missing don't gather; their
    order makes the bags of a recomputed partition the same.
    """
    return df.repartition(fit_partitions(rows, df.sparkSession.sparkContext.defaultParallelism, at_once)).sortWithinPartitions(*keys)


def _answers(model: PipelineModel, test: DataFrame) -> DataFrame:
    """(label, prediction) of the test part, written: every stage above a transform would be sent the whole model again."""
    return cut_lineage(model.transform(test).select("label", "prediction"), "table", "answers")


def cross_validate(factory, train: DataFrame, cols: list[str], keys: list[str], k: int = 5, seed: int = 42,
                   ctx: dict | None = None, parallelism: int = 5) -> DataFrame:
    """(fold, n_test, accuracy) over ``k`` stratified folds of the training part.

    The vectors are assembled once, and each fit knows the size of its own
    training part.
    """
    folded = assembler(cols).transform(_dealt(cv_folds(train, keys, "label", k, seed), train.count(), keys, max(1, min(k, parallelism)))) \
        .select("fold", "label", "features").persist()
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}       # k rows

    def one(f: int):
        tr, te = folded.where(F.col("fold") != f), folded.where(F.col("fold") == f)
        n = sum(v for fold, v in sizes.items() if fold != f)
        model = factory({**(ctx or {}), "n_train": n}).fit(tr)
        acc = model.transform(te).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        return (f, sizes.get(f, 0), acc)

    rows = _parallel(one, list(range(k)), parallelism)
    folded.unpersist()
    return train.sparkSession.createDataFrame(rows, "fold int, n_test long, accuracy double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and POPULATION standard deviation of the fold accuracies."""
    return scores.agg(F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"))


def train_classifiers(features: DataFrame, cols: list[str], keys: list[str], algorithms: list[str],
                      seed: int = 42, test_fraction: float = 0.2, cv: int = 0, n_trees: int | None = None,
                      settings: dict | None = None) -> tuple[list[TrainResult], DataFrame]:
    """Train every available configured classifier on a stratified split.

    Returns the results and the split frame (``is_test``).  A failing model
    is logged and skipped; the others still train.
    """
    data = _label_double(features)
    split = _dealt(stratified_split(data, keys, "label", seed, test_fraction), data.count(), keys).persist()
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    n_classes = split.select("label").distinct().limit(3).count()     # only "two or more" matters
    ctx = {**(settings or {}), "n_train": train.count(), "n_classes": n_classes}
    if n_trees:
        ctx["n_trees"] = n_trees
    out = []
    for name, factory, status in REG.resolve(algorithms, REG.CLASSIFIERS):
        if factory is None:
            continue
        try:
            model = Pipeline(stages=[assembler(cols), factory(ctx)]).fit(train)
            m = M.classification_metrics(_answers(model, test), binary=n_classes == 2).first().asDict()
            if cv:
                scores = cross_validate(factory, train, cols, keys, cv, seed, ctx)
                m.update(cv_summary(scores).first().asDict())
            imp = importances_frame(features.sparkSession, name, cols, model.stages[-1])
            out.append(TrainResult(name, "classifier", model, m, imp))
        except Exception as e:  # noqa: BLE001 - one failing model must not stop the rest
            log.error("training %s failed: %s", name, e)
    split.unpersist()
    return out, split


def train_regressors(features: DataFrame, cols: list[str], keys: list[str], algorithms: list[str],
                     seed: int = 42, test_fraction: float = 0.2, n_trees: int | None = None,
                     settings: dict | None = None) -> list[TrainResult]:
    data = _label_double(features)
    split = _dealt(random_split(data, keys, seed, test_fraction), data.count(), keys).persist()
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    ctx = {**(settings or {}), **({"n_trees": n_trees} if n_trees else {})}
    out = []
    for name, factory, status in REG.resolve(algorithms, REG.REGRESSORS):
        if factory is None:
            continue
        try:
            model = Pipeline(stages=[assembler(cols), factory(ctx)]).fit(train)
            m = M.regression_metrics(_answers(model, test)).first().asDict()
            imp = importances_frame(features.sparkSession, name, cols, model.stages[-1])
            out.append(TrainResult(name, "regressor", model, m, imp))
        except Exception as e:  # noqa: BLE001
            log.error("training %s failed: %s", name, e)
    split.unpersist()
    return out


def kmeans_fit(data: DataFrame, cols: list[str], k: int, seed: int = 42, n_init: int = 10) -> PipelineModel:
    """Best of ``n_init`` seeded k-means runs by cost (earliest seed on ties); see ``manystart``."""
    runs, _ = MS.many_kmeans(data, cols, [k], n_init, seed)
    return MS.as_model(data.sparkSession, cols, MS.best(runs, k).centres)


def elbow_ks(n_rows: int, max_k: int = 10) -> list[int]:
    return list(range(2, min(max_k, n_rows // 2) + 1))


def inertias_frame(spark: SparkSession, runs: list[MS.Run]) -> DataFrame:
    """(k, inertia): the least cost for each k."""
    rows = [(k, MS.best(runs, k).cost) for k in sorted({r.k for r in runs})]
    return spark.createDataFrame(rows, "k long, inertia double")


def elbow_inertias(data: DataFrame, cols: list[str], max_k: int = 10, seed: int = 42, n_init: int = 10,
                   n_rows: int | None = None) -> DataFrame:
    """(k, inertia) for k = 2..min(max_k, n // 2), from one set of scans for all of them."""
    n = n_rows if n_rows is not None else data.count()
    return inertias_frame(data.sparkSession, MS.many_kmeans(data, cols, elbow_ks(n, max_k), n_init, seed, n_rows=n)[0])


def train_clustering(features: DataFrame, cols: list[str], keys: list[str], seed: int = 42, n_init: int = 10,
                     max_k: int = 10) -> TrainResult:
    """k by the elbow of the inertias, and the best run of that k: the same runs serve both."""
    data = features.select(*keys, *[c for c in cols if c not in keys])
    n = data.count()
    held = _compact(data, n).persist()
    runs, scans = MS.many_kmeans(held, cols, elbow_ks(n, max_k), n_init, seed, n_rows=n)
    held.unpersist()
    inertias = inertias_frame(features.sparkSession, runs)
    k = M.elbow_k(inertias).first()["best_k"]
    model = MS.as_model(features.sparkSession, cols, MS.best(runs, k).centres)
    assigned = model.transform(data).select(*keys, *[c for c in cols if c not in keys], F.col("cluster").cast("int").alias("cluster"))
    metrics = {"n_clusters": k,
               "silhouette": M.silhouette_sq(assigned, cols).first()[0],
               "davies_bouldin": M.davies_bouldin(assigned, cols).first()[0]}
    return TrainResult("kmeans", "clustering", model, metrics, None,
                       {"assignments": assigned.select(*keys, "cluster"), "inertias": inertias, "scans": scans, "runs": len(runs)})


def score_all(model: PipelineModel, features: DataFrame, keys: list[str]) -> DataFrame:
    """prediction and class probabilities for every row (training rows included)."""
    s = model.transform(features)
    cols = [*keys, *(["label"] if "label" in features.columns else []), "prediction"]
    if "probability" in s.columns:
        s = s.withColumn("probability", vector_to_array("probability"))
        cols.append("probability")
    return s.select(*cols)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | None:
    """The saved model, or None when nothing is saved there."""
    try:
        return PipelineModel.load(path)
    except Exception as e:  # noqa: BLE001
        log.error("model not found at %s: %s", path, e)
        return None
