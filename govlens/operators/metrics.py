"""Model-quality metrics as aggregates over (label, prediction) frames.

Per-class statistics come from ONE shuffle that yields a row per class;
everything after that runs on that bounded frame.  Cluster metrics use
per-cluster sums (a row per cluster) and never pair points.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from govlens.session import cut_lineage


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (sklearn ``zero_division=0``)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): the one pass over the rows; what follows reads a row per pair of classes."""
    return df.groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def class_stats(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(cls, support, n_pred, tp) for every class seen as a label or a prediction."""
    none = F.lit(0).cast("bigint")
    pairs = pair_counts(df, label, prediction).select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("t"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none).alias("tp"), none.alias("p")),
        F.struct(F.col("prediction").alias("cls"), none.alias("t"), none.alias("tp"), F.col("n").alias("p")))).alias("s")).select("s.*")
    return pairs.groupBy("cls").agg(F.sum("t").cast("bigint").alias("support"),
                                    F.sum("p").cast("bigint").alias("n_pred"),
                                    F.sum("tp").cast("bigint").alias("tp"))


def _per_class(stats: DataFrame) -> DataFrame:
    return stats.select("cls", "support", "tp",
                        _div0(F.col("tp"), F.col("n_pred")).alias("precision"),
                        _div0(F.col("tp"), F.col("support")).alias("recall"),
                        _div0(2 * F.col("tp"), F.col("support") + F.col("n_pred")).alias("f1_score"))


def classification_metrics(df: DataFrame, binary: bool, label: str = "label", prediction: str = "prediction",
                           positive: float = 1.0) -> DataFrame:
    """accuracy, precision, recall, f1_score: positive class only when
    ``binary`` (the target has two classes), else support-weighted means."""
    st = class_stats(df, label, prediction)
    pc = _per_class(st)
    # accuracy = correct / rows = sum of per-class true positives / sum of supports
    acc = F.try_divide(F.sum("tp").cast("double"), F.sum("support"))
    if binary:
        pos = F.col("cls") == positive
        return pc.agg(acc.alias("accuracy"),
                      *[F.coalesce(F.max(F.when(pos, F.col(c))), F.lit(0.0)).alias(c)
                        for c in ("precision", "recall", "f1_score")])
    tot = F.sum("support")
    return pc.agg(acc.alias("accuracy"),
                  *[_div0(F.sum(F.col(c) * F.col("support")), tot).alias(c) for c in ("precision", "recall", "f1_score")])


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support, then 'accuracy', 'macro avg' and
    'weighted avg' rows (classes are labelled by their value as text)."""
    pc = cut_lineage(_per_class(class_stats(df, label, prediction)), "checkpoint")
    rows = pc.select(F.format_string("%s", F.col("cls").cast("bigint").cast("string")).alias("class_name"),
                     "precision", "recall", "f1_score", "support")
    tot = F.sum("support")
    macro = pc.agg(F.lit("macro avg").alias("class_name"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"), tot.alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("class_name"),
                      *[_div0(F.sum(F.col(c) * F.col("support")), tot).alias(c) for c in ("precision", "recall", "f1_score")],
                      tot.alias("support"))
    acc = pc.agg(F.lit("accuracy").alias("class_name"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 F.try_divide(F.sum("tp").cast("double"), tot).alias("f1_score"), tot.alias("support"))
    return reduce(lambda a, b: a.unionByName(b), [rows, acc, macro, weighted]).withColumn(
        "support", F.col("support").cast("bigint"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     zero_cells: bool = True) -> DataFrame:
    """Long form (label, prediction, n) over the class pairs.

    ``zero_cells`` lists every pair of the k classes (k x k rows, the matrix);
    without it only the pairs that occur come back.  The grid is made from the
    frame of classes, and the observed counts are joined in.
    """
    counts = cut_lineage(pair_counts(df, label, prediction), "checkpoint")
    whole = lambda c: F.col(c).cast("bigint").alias(c)
    if not zero_cells:
        return counts.select(whole("label"), whole("prediction"), "n")
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).where("c is not null")
    one = classes.agg(F.collect_set("c").alias("cs"))     # the k classes, in one row
    grid = one.select("cs", F.explode("cs").alias("label")).select("label", F.explode("cs").alias("prediction"))
    return (grid.join(counts, ["label", "prediction"], "left")
                .select(F.col("label").cast("bigint").alias("label"), F.col("prediction").cast("bigint").alias("prediction"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """mse, rmse, mae, r2_score in one aggregate (r2: 1 when both sums of
    squares are 0, 0 when only the total is 0, as sklearn)."""
    err = F.col(label) - F.col(prediction)
    a = df.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
               F.sum(err * err).alias("ss_res"), (F.var_pop(F.col(label)) * F.count(F.col(label))).alias("ss_tot"))
    r2 = (F.when(F.col("ss_tot") == 0, F.when(F.col("ss_res") == 0, 1.0).otherwise(0.0))
           .otherwise(1 - F.col("ss_res") / F.col("ss_tot")))
    return a.select("mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2_score"))


# ---------------------------------------------------------------- clusters

def centroids(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"),
                                   *[F.avg(F.col(f"`{c}`")).alias(f"m_{i}") for i, c in enumerate(cols)])


def _with_centroid(df: DataFrame, cols: list[str], cluster: str) -> DataFrame:
    cen = centroids(df, cols, cluster)
    # one row per cluster; the planner sizes it
    return df.join(cen, cluster)


def inertia(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    """Within-cluster sum of squared distances to the cluster means (one row)."""
    j = _with_centroid(df, cols, cluster)
    sq = reduce(lambda a, b: a + b, [(F.col(f"`{c}`") - F.col(f"m_{i}")) ** 2 for i, c in enumerate(cols)])
    return j.agg(F.sum(sq).alias("inertia"))


def davies_bouldin(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d(c_i, c_j), s_i the mean
    distance of a cluster's points to its centroid.  One pass for centroids,
    one for s_i; the k x k part runs on the k collected centroid rows."""
    j = _with_centroid(df, cols, cluster)
    dist = F.sqrt(reduce(lambda a, b: a + b, [(F.col(f"`{c}`") - F.col(f"m_{i}")) ** 2 for i, c in enumerate(cols)]))
    per = j.groupBy(cluster, *[f"m_{i}" for i in range(len(cols))]).agg(F.avg(dist).alias("s"))
    rows = per.collect()   # one row per cluster
    spark = df.sparkSession
    if len(rows) < 2:
        return spark.createDataFrame([(None,)], "davies_bouldin double")
    cen = np.array([[r[f"m_{i}"] for i in range(len(cols))] for r in rows], dtype=float)
    s = np.array([r["s"] for r in rows], dtype=float)
    d = np.sqrt(((cen[:, None, :] - cen[None, :, :]) ** 2).sum(-1))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = (s[:, None] + s[None, :]) / np.where(d == 0, np.inf, d)
    np.fill_diagonal(ratio, -np.inf)
    score = float(np.mean(ratio.max(axis=1))) if not np.allclose(s, 0) else 0.0
    return spark.createDataFrame([(score,)], "davies_bouldin double")


def silhouette_sq(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with SQUARED Euclidean distance, in linear time, by
    MLlib's ``ClusteringEvaluator``: per-cluster sums (a row per cluster)
    replace all point pairs, since the sum over y in C of |x - y|^2 is
    n_C |x|^2 - 2 x.S_C + Q_C.  Own cluster: mean over the other n_A - 1
    points; a point alone in its cluster scores 0."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    spark = df.sparkSession
    k = df.select(cluster).distinct().limit(2).count()
    if k < 2:
        return spark.createDataFrame([(None,)], "silhouette double")
    vec = (VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="keep").transform(df)
           .select("_features", F.col(cluster).cast("double").alias("_cluster")))
    ev = ClusteringEvaluator(featuresCol="_features", predictionCol="_cluster", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return spark.createDataFrame([(float(ev.evaluate(vec)),)], "silhouette double")


def elbow_k(inertias: DataFrame, k: str = "k", value: str = "inertia", default: int = 2) -> DataFrame:
    """The k just before the largest drop of inertia (smaller k on ties);
    ``default`` when fewer than two k were tried.  Runs on the small (k,
    inertia) frame."""
    w = Window.orderBy(k)
    d = inertias.withColumn("drop", F.lead(value).over(w) - F.col(value)).where(F.col("drop").isNotNull())
    best = d.orderBy(F.asc("drop"), F.asc(k)).limit(1).select(F.col(k).cast("bigint").alias("best_k"))
    fallback = inertias.sparkSession.range(1).select(F.lit(default).cast("bigint").alias("best_k"), F.lit(1).alias("o"))
    return (best.withColumn("o", F.lit(0)).unionByName(fallback).orderBy("o").limit(1).select("best_k"))


def best_model(metrics: DataFrame, order: str = "model_order") -> DataFrame:
    """Highest accuracy, else R2, else silhouette - whichever metric the
    frame carries; ties go to the earliest registered model."""
    for m in ("accuracy", "r2_score", "silhouette"):
        if m in metrics.columns:
            return (metrics.orderBy(F.desc_nulls_last(m), F.asc(order)).limit(1)
                           .select("model", F.lit(m).alias("metric"), F.col(m).alias("value")))
    raise ValueError("no known metric column")
