"""Risk insights: overall statistics, by group, high-risk users."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

OVERALL_SCHEMA = "mean_risk double, median_risk double, high_risk_count bigint, high_risk_percentage double"


def risk_overall(merged: DataFrame, threshold: float = 0.7, exact: bool = True) -> DataFrame:
    """Mean, median, rows over the threshold and their share of ALL rows (a
    missing score is not high).  One aggregate."""
    if "risk_score" not in merged.columns:
        return merged.sparkSession.createDataFrame([], OVERALL_SCHEMA)
    r = F.col("risk_score")
    if exact:
        from govlens.functions.quantiles import exact_quantiles
        med = F.lit(exact_quantiles(merged, ["risk_score"], [0.5])["risk_score"][0])
    else:
        med = F.percentile_approx(r, 0.5, 100_000)
    high = F.count_if(r > threshold)
    return merged.agg(
        F.avg(r).alias("mean_risk"), med.cast("double").alias("median_risk"),
        high.cast("bigint").alias("high_risk_count"),
        F.try_divide(high * F.lit(100.0), F.count(F.lit(1))).alias("high_risk_percentage"))


def risk_by_group(merged: DataFrame, group_col: str, top: int | None = 10,
                  avg_name: str = "avg_risk", count_name: str = "count") -> DataFrame:
    """Mean and count of risk per group, highest mean first; a missing group
    is dropped (pandas groupby); ties broken by group name."""
    schema = f"{group_col} string, {avg_name} double, `{count_name}` bigint"
    if "risk_score" not in merged.columns or group_col not in merged.columns:
        return merged.sparkSession.createDataFrame([], schema)
    g = (merged.where(F.col(group_col).isNotNull()).groupBy(group_col)
               .agg(F.avg("risk_score").alias(avg_name), F.count("risk_score").alias(count_name)))
    g = g.orderBy(F.desc_nulls_last(avg_name), F.asc(group_col))
    return g.limit(top) if top else g


def high_risk_users(merged: DataFrame, threshold: float = 0.7, top: int = 20) -> DataFrame:
    """Users with rows over the threshold, by their mean risk over those rows."""
    if "risk_score" not in merged.columns or "user_id" not in merged.columns:
        return merged.sparkSession.createDataFrame([], "user_id string, avg_risk double")
    g = (merged.where((F.col("risk_score") > threshold) & F.col("user_id").isNotNull())
               .groupBy("user_id").agg(F.avg("risk_score").alias("avg_risk")))
    return g.orderBy(F.desc("avg_risk"), F.asc("user_id")).limit(top)
