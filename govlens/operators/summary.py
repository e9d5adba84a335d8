"""Flat summaries of the insights (the reference's CSV summary and report numbers)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def insight_summary(low_usage: DataFrame, high_risk_users: DataFrame, n_users: int = 10) -> DataFrame:
    """(insight_type, category, item, value, impact): every low-usage
    candidate, then the first ``n_users`` high-risk users.  ``impact`` is text
    because it holds a user count for one kind and 'high' for the other."""
    a = low_usage.select(F.lit("access_reduction").alias("insight_type"), F.lit("low_usage").alias("category"),
                         F.col("access_item").cast("string").alias("item"), F.col("avg_frequency").cast("double").alias("value"),
                         F.col("user_count").cast("string").alias("impact"))
    top = high_risk_users.orderBy(F.desc("avg_risk"), F.asc("user_id")).limit(n_users)
    b = top.select(F.lit("risk").alias("insight_type"), F.lit("high_risk_user").alias("category"),
                   F.col("user_id").cast("string").alias("item"), F.col("avg_risk").cast("double").alias("value"),
                   F.lit("high").alias("impact"))
    return a.unionByName(b)


def report_metrics(reduction: DataFrame, risk: DataFrame, anomalies: DataFrame,
                   importances: DataFrame | None = None) -> DataFrame:
    """(section, metric, value) rows of the text report; with ``importances``
    the top predictor of each model is added (value = its importance)."""
    def rows(df, section, cols):
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(section).alias("section"), F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in cols])))
    parts = [rows(reduction, "access_reduction", ["total_opportunities"]),
             rows(risk, "risk", ["mean_risk", "high_risk_count", "high_risk_percentage"]),
             rows(anomalies, "anomalies", ["outlier_count", "outlier_percentage"])]
    if importances is not None:
        from pyspark.sql import Window
        w = Window.partitionBy("model").orderBy(F.desc("importance"), F.asc("feature"))
        top = importances.withColumn("_r", F.row_number().over(w)).where("_r = 1")
        parts.append(top.select(F.lit("feature_importance").alias("section"),
                                F.concat(F.col("model"), F.lit(":"), F.col("feature")).alias("metric"),
                                F.col("importance").alias("value")))
    return reduce(lambda a, b: a.unionByName(b), parts)
