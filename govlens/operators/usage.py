"""Access-reduction insights: rarely used and long-unused access."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from govlens.functions.dates import whole_days_between

LOW_USAGE_SCHEMA = "access_item string, user_count bigint, avg_frequency double"
_TIMES = ("timestamp", "timestamp_ntz", "date")
UNUSED_SCHEMA = "access_item string, user_count bigint, avg_days_since_use double"


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _top_items(df: DataFrame, value: Column, value_name: str, top: int) -> DataFrame:
    """Per access_item: rows with a user (count of non-missing user_id) and the
    mean of ``value``; most users first (item name breaks ties), first ``top``.
    A missing item is not a group.  ``orderBy+limit`` plans as a top-k
    (TakeOrderedAndProject): each partition keeps ``top`` rows, no full sort."""
    g = (df.where(F.col("access_item").isNotNull())
           .groupBy("access_item")
           .agg(F.count("user_id").alias("user_count"), F.avg(value).alias(value_name)))
    return g.orderBy(F.desc("user_count"), F.asc("access_item")).limit(top)


def low_usage_items(merged: DataFrame, threshold: float = 5, top: int = 20) -> DataFrame:
    """Rows used fewer than ``threshold`` times, grouped by item."""
    if "frequency" not in merged.columns or "access_item" not in merged.columns:
        return _empty(merged.sparkSession, LOW_USAGE_SCHEMA)
    low = merged.where(F.col("frequency") < threshold)
    return _top_items(low, F.col("frequency"), "avg_frequency", top).select(
        "access_item", "user_count", F.col("avg_frequency").cast("double"))


def days_since_use(merged: DataFrame, as_of: str, col: str = "last_used_date") -> Column:
    """Whole days from the last use to ``as_of`` (the reference uses the wall
    clock; a parameter keeps results reproducible)."""
    kind = dict(merged.dtypes)[col]
    ts = F.col(col).cast("timestamp_ntz") if kind in _TIMES else F.col(col).cast("string").try_cast("timestamp_ntz")
    return whole_days_between(ts, F.lit(as_of).cast("timestamp_ntz"))


def unused_items(merged: DataFrame, as_of: str, days: int = 90, top: int = 20) -> DataFrame:
    """Rows not used for more than ``days`` days, grouped by item."""
    if "last_used_date" not in merged.columns or "access_item" not in merged.columns:
        return _empty(merged.sparkSession, UNUSED_SCHEMA)
    kind = dict(merged.dtypes)["last_used_date"]
    d = merged
    if kind in _TIMES:
        # more than ``days`` whole days ago, as a bound on the column itself: it reaches the scan
        latest = datetime.fromisoformat(as_of) - timedelta(days=days + 1)
        d = d.where(F.col("last_used_date") <= F.lit(latest.isoformat(sep=" ")).cast(kind))
    d = d.withColumn("days_since_use", days_since_use(merged, as_of))
    return _top_items(d.where(F.col("days_since_use") > days), F.col("days_since_use"),
                      "avg_days_since_use", top)


def access_reduction_total(low: DataFrame, unused: DataFrame) -> DataFrame:
    """Counts of the two candidate lists and their sum (one row)."""
    tagged = (low.select(F.lit(1).alias("a"), F.lit(0).alias("b"))
                 .unionByName(unused.select(F.lit(0).alias("a"), F.lit(1).alias("b"))))
    return tagged.agg(F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("n_low_usage"),
                      F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("n_unused")).select(
        "n_low_usage", "n_unused", (F.col("n_low_usage") + F.col("n_unused")).alias("total_opportunities"))
