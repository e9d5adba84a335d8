"""Seeded, exact, distributed train/test splits and cross-validation folds.

The order inside a class is md5(key | seed) (then the key); a row is in the
test part when its rank in that order is within round(fraction * class
size).  ``ranked_segments`` places whole hash-prefix buckets by their
offsets and ranks only the buckets that straddle a boundary, so the data is
never globally sorted and a huge class never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from govlens.functions.ranking import hash_key, ranked_segments


def _segmented(df: DataFrame, key_cols: list[str], class_col: str | None, seed: int, segment) -> DataFrame:
    if not key_cols:
        raise ValueError("a split needs key columns: without a key its order cannot be repeated")
    h = df.withColumn("_h", hash_key(key_cols, seed))
    return ranked_segments(h, class_col, "_h", key_cols, segment).drop("_h")


def _n_test(n: "F.Column", fraction: float) -> "F.Column":
    # round half up of fraction * n, computed in integers to avoid float ties
    scale = 1_000_000
    return F.floor((n * F.lit(int(round(fraction * scale))) + F.lit(scale // 2)) / F.lit(scale))


def stratified_split(df: DataFrame, key_cols: list[str], class_col: str = "label", seed: int = 42,
                     test_fraction: float = 0.2) -> DataFrame:
    """Adds boolean ``is_test``; per class, round(test_fraction * n) rows are test."""
    seg = lambda rank, n: (rank > _n_test(n, test_fraction)).cast("int")   # 0 = test, 1 = train
    return _segmented(df, key_cols, class_col, seed, seg).withColumn("is_test", F.col("_seg") == 0).drop("_seg")


def random_split(df: DataFrame, key_cols: list[str], seed: int = 42, test_fraction: float = 0.2) -> DataFrame:
    """Same without classes (regression)."""
    seg = lambda rank, n: (rank > _n_test(n, test_fraction)).cast("int")
    return _segmented(df, key_cols, None, seed, seg).withColumn("is_test", F.col("_seg") == 0).drop("_seg")


def cv_folds(df: DataFrame, key_cols: list[str], class_col: str = "label", k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0..k-1: each class is cut into k contiguous runs of its
    hash order, so every fold holds each class in proportion."""
    seg = lambda rank, n: F.floor((rank - 1) * F.lit(k) / n).cast("int")
    return _segmented(df, key_cols, class_col, seed, seg).withColumnRenamed("_seg", "fold")
