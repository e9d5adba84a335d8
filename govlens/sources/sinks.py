"""Writers: insights as JSON (a folder per insight), tables as CSV/parquet."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from govlens.session import shared_path


def write_insights_json(spark: SparkSession, insights: dict[str, DataFrame], base: str | None = None,
                        stamp: str | None = None) -> dict[str, str]:
    """Write each insight frame as JSON under ``base/insights_<stamp>/<name>``
    (``base`` defaults to the shared checkpoint folder); returns the paths."""
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    root = (base.rstrip("/") if base else shared_path(spark, "insights")) + f"/insights_{stamp}"
    out = {}
    for name, df in insights.items():
        path = f"{root}/{name}"
        df.write.mode("overwrite").json(path)
        out[name] = path
    return out


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
