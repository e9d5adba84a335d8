"""IQR outliers over the feature frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from govlens.functions.quantiles import exact_quantiles
from govlens.functions.stats import quantile_expr, _chunks
from govlens.operators.clean import Filled


def iqr_bounds(features: DataFrame, columns: list[str], k: float = 1.5, exact: bool = True,
               filled: Filled | None = None) -> DataFrame:
    """(feature, q1, q3, lower, upper) per column; quartiles by linear
    interpolation, all columns from one rank index: that of ``filled`` (the
    build that filled ``features``) or one made here."""
    if exact:
        qv = filled.quantiles(columns, [0.25, 0.75]) if filled else exact_quantiles(features, columns, [0.25, 0.75])
        b = features.sparkSession.createDataFrame(
            [(c, qv[c][0], qv[c][1]) for c in columns], "feature string, q1 double, q3 double")
    else:
        rows = []
        for chunk in _chunks(columns):
            one = features.agg(*[quantile_expr(c, [0.25, 0.75], exact).alias(f"q{i}") for i, c in enumerate(chunk)])
            rows.append(one.select(F.inline(F.array(*[
                F.struct(F.lit(c).alias("feature"), F.col(f"q{i}")[0].alias("q1"), F.col(f"q{i}")[1].alias("q3"))
                for i, c in enumerate(chunk)]))))
        b = reduce(lambda a, c: a.unionByName(c), rows)
    iqr = F.col("q3") - F.col("q1")
    return b.select("feature", "q1", "q3", (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))


def outlier_flag(features: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add ``is_outlier``: outside the strict bounds in ANY column (a row
    flagged by several columns counts once).  The bounds are a handful of
    numbers per column, inlined as literals so the test stays in codegen."""
    b = {r["feature"]: (r["lower"], r["upper"]) for r in bounds.collect()}
    tests = [(F.col(f"`{c}`") < F.lit(lo)) | (F.col(f"`{c}`") > F.lit(hi))
             for c, (lo, hi) in b.items() if lo is not None and hi is not None]
    flag = F.coalesce(reduce(lambda a, c: a | c, tests), F.lit(False)) if tests else F.lit(False)
    return features.withColumn("is_outlier", flag)


def iqr_outliers(flagged: DataFrame) -> DataFrame:
    """One row: outlier_count and outlier_percentage (NULL on an empty frame)."""
    n = F.count_if(F.col("is_outlier"))
    return flagged.agg(n.cast("bigint").alias("outlier_count"),
                       F.try_divide(n * F.lit(100.0), F.count(F.lit(1))).alias("outlier_percentage"))


def outlier_users(flagged: DataFrame, merged: DataFrame, key: str, n: int = 10) -> DataFrame:
    """user_id of the first ``n`` flagged rows by primary key.  The top-n keys
    are found first (a per-partition top-k), so only ``n`` rows meet the join."""
    first = flagged.where("is_outlier").select(key).orderBy(key).limit(n)
    # ``first`` has at most n rows: a proven bound for the broadcast
    return F.broadcast(first).join(merged.select(key, "user_id"), key).select(key, "user_id")
