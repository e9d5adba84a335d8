"""Distributed ranks without a global single-partition window.

``dense_index`` gives every distinct value of a column its 0-based position
in ascending order; ``ranked_segments`` cuts every class, in hash order,
into rank segments (test/train, folds).  Both are two-level: a small table
of per-bucket counts is prefix-summed (its size is bounded by the number of
buckets, not by the data) and row numbers are taken only inside buckets, so
no task ever holds a whole class or a whole column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def dense_index(values: DataFrame, group_col: str, value_col: str, n_buckets: int | None = None,
                out_col: str = "code", materialize: str = "checkpoint") -> DataFrame:
    """(group, value) distinct pairs -> (group, value, code 0..k-1 per group).

    Values are range-partitioned by (group, value) so partition ids follow the
    sort order; per-(group, partition) counts are prefix-summed, and a row
    number inside each partition completes the rank.  Range bounds come from
    a sample, so the partitioned values are materialised once: counts and
    row numbers then always describe the same partitioning, even when a
    lost executor forces a recomputation.
    """
    from govlens.session import cut_lineage

    spark = values.sparkSession
    n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = values.select(group_col, value_col).distinct()
    ranged = (d.repartitionByRange(n, group_col, value_col)
               .withColumn("_part", F.spark_partition_id()))
    ranged = cut_lineage(ranged, materialize)
    counts = ranged.groupBy(group_col, "_part").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(group_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group_col, "_part",
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    local = Window.partitionBy(group_col, "_part").orderBy(value_col)
    ranked = ranged.withColumn("_rn", F.row_number().over(local))
    # offsets has one row per (group, bucket); the planner sizes it
    return (ranked.join(offsets, [group_col, "_part"])
                  .select(group_col, value_col, (F.col("_off") + F.col("_rn") - 1).cast("bigint").alias(out_col)))


def hash_key(key_cols: list[str], seed: int) -> "F.Column":
    """Deterministic pseudo-random order key: md5 of the key and the seed.

    md5 exists in DuckDB as well, so the oracle reproduces the order exactly.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def ranked_segments(df: DataFrame, class_col: str | None, order_col: str, tie_cols: list[str],
                    segment, prefix_len: int = 4) -> DataFrame:
    """Add ``_seg`` = segment(rank, class size) without ranking most rows.

    ``segment(rank, n)`` maps a 1-based rank inside the class to a segment
    (test/train, fold number) and must be non-decreasing in rank.  Bucket
    offsets come from a small table of per-(class, bucket) counts; a bucket
    whose first and last ranks fall in the same segment takes it wholesale.
    Only the few buckets that
    straddle a segment boundary (at most one per boundary and class) are
    ranked row by row.  Rows without a class form a class of their own: as
    many rows come out as went in.
    """
    b = df.withColumn("_bucket", F.substring(F.col(order_col), 1, prefix_len))
    keys = ([class_col] if class_col else []) + ["_bucket"]
    counts = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bn"))
    w_cls = Window.partitionBy(class_col) if class_col else Window.partitionBy()
    w_off = w_cls.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bn", F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_boff"),
                            F.sum("_bn").over(w_cls).alias("_class_n"))
    offsets = (offsets.withColumn("_s0", segment(F.col("_boff") + 1, F.col("_class_n")))
                      .withColumn("_s1", segment(F.col("_boff") + F.col("_bn"), F.col("_class_n")))
                      .drop("_bn"))
    # offsets: at most classes x 16**prefix_len rows, written so that the planner knows their size and, where they are
    # small, leaves the rows where they are; null-safe, so that a missing class keeps its rows
    from govlens.session import cut_lineage
    offsets = cut_lineage(offsets, "table", "split-offsets")
    right = offsets.select(*[F.col(k).alias(f"_o_{i}") for i, k in enumerate(keys)], "_boff", "_class_n", "_s0", "_s1")
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_o_{i}")) for i, k in enumerate(keys)])
    j = b.join(right, match).drop(*[f"_o_{i}" for i in range(len(keys))])
    whole = j.where(F.col("_s0") == F.col("_s1")).withColumn("_seg", F.col("_s0"))
    local = Window.partitionBy(*keys).orderBy(order_col, *tie_cols)
    edge = (j.where(F.col("_s0") != F.col("_s1"))
             .withColumn("_seg", segment(F.col("_boff") + F.row_number().over(local), F.col("_class_n"))))
    return whole.unionByName(edge).drop("_bucket", "_boff", "_class_n", "_s0", "_s1")
