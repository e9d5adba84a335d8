"""Many-to-one lookups that move each row once and whose hot keys stay spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot with more than one row in this many times the number of shuffle partitions.
HOT_SHARE = 4


def key_hashes(*cols: Column) -> list[Column]:
    """A 128-bit key of some values, as two 64-bit hashes."""
    return [F.xxhash64(F.lit(1), *cols), F.xxhash64(F.lit(2), *cols)]


def hot_keys(counts: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Keys that hold more than one row in ``HOT_SHARE`` x shuffle partitions of all, from a row per key with its count ``n``.

    There are fewer of them than ``HOT_SHARE`` x partitions, whatever the data.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) > total / (HOT_SHARE * parts)).select(*keys)


def spread_lookup(df: DataFrame, lookup: DataFrame, keys: list[str], values: list[str], hot: DataFrame,
                  spread: list[str]) -> DataFrame:
    """``df`` and, for each row, the ``values`` that ``lookup`` (one row per key) has for it; NULL without one.

    ``keys`` are columns of 64-bit numbers, never NULL.  Rows of ``hot``
    keys (see ``hot_keys``) are answered where they are, from a broadcast of
    as many rows; in the one exchange that all rows take part in, they go by
    the hash of their ``spread`` columns, so no task gets a hot key's rows.
    """
    few = lookup.join(F.broadcast(hot), keys, "left_semi") \
        .select(*[F.col(k).alias(f"_near_{k}") for k in keys], F.struct(*values).alias("_near"))
    near = df.join(F.broadcast(few), [F.col(k) == F.col(f"_near_{k}") for k in keys], "left").drop(*[f"_near_{k}" for k in keys])
    cold = F.col("_near").isNull()
    first = F.when(cold, F.col(keys[0])).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in spread]))
    far = lookup.select(*[F.col(k).alias(f"_far_{k}") for k in keys], F.lit(True).alias("_far_cold"), F.struct(*values).alias("_far"))
    out = near.withColumn("_to", first).withColumn("_cold", cold) \
        .join(far, [F.col("_to") == F.col(f"_far_{keys[0]}"), *[F.col(k) == F.col(f"_far_{k}") for k in keys[1:]],
                    F.col("_cold") == F.col("_far_cold")], "left")
    found = F.coalesce("_near", "_far")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[found[v].alias(v) for v in values])
