"""Insights over model outputs: predictions, confidence, clusters, importances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def confidence(col: str = "probability") -> Column:
    """Largest class probability (vector or array column)."""
    return F.array_max(F.col(col))


def as_array(df: DataFrame, col: str = "probability") -> DataFrame:
    if col in df.columns and not isinstance(df.schema[col].dataType, T.ArrayType):
        from pyspark.ml.functions import vector_to_array
        return df.withColumn(col, vector_to_array(col))
    return df


def prediction_distribution(scored: DataFrame) -> DataFrame:
    """(prediction, n)."""
    return scored.groupBy(F.col("prediction").cast("bigint").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def prediction_confidence(scored: DataFrame, low: float = 0.6) -> DataFrame:
    """mean_confidence, low_confidence_count (< low), low_confidence_percentage."""
    c = confidence()
    n_low = F.count_if(c < low)
    return as_array(scored).agg(F.avg(c).alias("mean_confidence"), n_low.cast("bigint").alias("low_confidence_count"),
                                F.try_divide(n_low * F.lit(100.0), F.count(F.lit(1))).alias("low_confidence_percentage"))


def cluster_distribution(assign: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, n) by cluster id."""
    return assign.groupBy(F.col(cluster).cast("bigint").alias("cluster")).agg(F.count(F.lit(1)).alias("n")).orderBy("cluster")


def cluster_profiles(features: DataFrame, assign: DataFrame, cols: list[str], keys: list[str],
                     cluster: str = "cluster") -> DataFrame:
    """Per cluster: size and the mean of every feature (rows matched by key,
    not by position).  When the assignment already carries the features no
    join is needed."""
    j = assign if all(c in assign.columns for c in cols) else features.join(assign.select(*keys, cluster), keys)
    return (j.groupBy(F.col(cluster).cast("bigint").alias("cluster"))
             .agg(F.count(F.lit(1)).alias("size"), *[F.avg(F.col(f"`{c}`")).alias(c) for c in cols]))


def top_features(importances: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` features per model by importance (name breaks ties); the
    window is per model over one row per feature."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), F.asc("feature"))
    return importances.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def rule_scores(features: DataFrame, score_col: str = "risk_score", keys: list[str] | None = None) -> DataFrame:
    """A rule-made binary scorer: P(class 1) = the score column.  Used to
    exercise the prediction insights with an exactly reproducible input."""
    p = F.col(score_col)
    keys = keys or []
    lab = ["label"] if "label" in features.columns else []
    return features.select(*keys, *lab, F.when(p > 0.5, 1.0).otherwise(0.0).alias("prediction"),
                           F.array(1 - p, p).alias("probability"))
