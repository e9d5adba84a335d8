"""The data behind every chart (drawing itself is out of scope)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from govlens.session import cut_lineage

BINS = 30


def histogram(df: DataFrame, value: str, bins: int = BINS, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] (per group when ``by``), the last bin
    closed; a constant column uses [v - 0.5, v + 0.5]; every bin is listed,
    empty ones with n = 0.  Two scans: one for the ranges, one for the counts."""
    keys = [by] if by else []
    v = F.col(f"`{value}`").cast("double")
    data = df.select(*[F.col(k) for k in keys], v.alias("x")).where(F.col("x").isNotNull())
    # no value at all -> no bins (a global aggregate of nothing yields one NULL row)
    rng = data.groupBy(*keys).agg(F.min("x").alias("lo0"), F.max("x").alias("hi0")).where(F.col("lo0").isNotNull())
    rng = rng.select(*keys, F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    # one row per group: no hint - the planner/AQE broadcasts it once its
    # measured size is under the threshold (a group column of unbounded
    # cardinality then falls back to a shuffle join); the ungrouped range is
    # a single row
    if keys:
        rng = cut_lineage(rng, "checkpoint")             # read by the counts and by the grid
        j = data.join(rng, keys)
    else:
        r = rng.first()                      # the whole range is two numbers
        if r is None:
            return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
        j = data.select("x", F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi"))
        rng = df.sparkSession.createDataFrame([(r["lo"], r["hi"])], "lo double, hi double")
    idx = F.least(F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))),
                  F.lit(bins - 1)).cast("int")
    counts = j.groupBy(*keys, idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(counts, [*keys, "bin"], "left")
                .select(*keys, "bin", (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
                        (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def share(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """(value, n, pct) of non-missing values; the total is a one-row aggregate."""
    name = name or col
    counts = cut_lineage(
        df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(name)).agg(F.count(F.lit(1)).alias("n")), "checkpoint")
    total = counts.agg(F.sum("n")).first()[0]            # one number, from the counts that are already there
    return counts.withColumn("pct", F.col("n") * 100.0 / F.lit(total))


def top_counts(df: DataFrame, col: str, top: int) -> DataFrame:
    """Most frequent values (value name breaks ties)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(col)).limit(top))


def mean_by(df: DataFrame, group: str, value: str, top: int | None, name: str) -> DataFrame:
    g = (df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias(name))
           .orderBy(F.desc_nulls_last(name), F.asc(group)))
    return g.limit(top) if top else g


def variance_rank(features: DataFrame, cols: list[str], top: int | None = 20) -> DataFrame:
    """(feature, variance, rank) by sample variance, largest first; the first
    ``top`` only when there are more than ``top`` columns."""
    one = features.agg(*[F.var_samp(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(cols)])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"))
                                        for i, c in enumerate(cols)])))
    ranked = long.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc_nulls_last("variance"), F.asc("feature"))))
    return ranked.where(F.col("rank") <= top) if top and len(cols) > top else ranked


def top_variance_columns(features: DataFrame, cols: list[str], top: int) -> list[str]:
    """Names of the ``top`` highest-variance columns (one small collect)."""
    return [r["feature"] for r in variance_rank(features, cols, top).orderBy("rank").collect()][:top]


def correlation_matrix(features: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (feature_a, feature_b, corr), Pearson, from MLlib's
    ``Correlation`` (one distributed tree-aggregate of the Gram matrix).

    A constant column (by its variance) has no correlation, not even with
    itself: NULL, where MLlib gives NaN (and 1.0 on the diagonal) and a SQL
    ``corr`` would raise under ANSI mode.  Only the d x d matrix (d = number
    of columns) reaches the driver.
    """
    import math

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    schema = "feature_a string, feature_b string, corr double"
    if not cols:
        return features.sparkSession.createDataFrame([], schema)
    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="keep").transform(features).select("_v")
    mat = Correlation.corr(vec, "_v").first()[0].toArray()
    spread = features.agg(*[F.var_samp(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    const = [not v for v in spread]                      # 0, or NULL for fewer than two rows
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = 1.0 if i == j else float(mat[i][j])
            rows.append((a, b, None if (const[i] or const[j] or math.isnan(v)) else v))
    return features.sparkSession.createDataFrame(rows, schema)


def box_stats(df: DataFrame, value: str, by: str, k: float = 1.5) -> DataFrame:
    """Per group: q1, median, q3, whiskers (farthest points within k*IQR of
    the box) and the number of points outside them."""
    from govlens.functions.rank_index import RankIndex
    v = F.col(value)
    q = RankIndex.of_groups(df, by, value).group_quantiles([0.25, 0.5, 0.75]) \
        .select(F.col("c").alias(by), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    # one row per group, joined without a hint: AQE broadcasts it when measured small
    j = df.where(v.isNotNull()).join(q, by)
    inside = (v >= lo) & (v <= hi)
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"))


def confidence_zones(scored: DataFrame, low: float = 0.6, high: float = 0.8) -> DataFrame:
    """(zone, n, pct) for < low, [low, high), >= high; every zone listed."""
    c = F.array_max("probability")
    a = scored.agg(F.count_if(c < low).alias("z0"), F.count_if((c >= low) & (c < high)).alias("z1"),
                   F.count_if(c >= high).alias("z2"), F.count(F.lit(1)).alias("n"))
    return a.select(F.inline(F.array(*[
        F.struct(F.lit(z).alias("zone"), F.col(f"z{i}").cast("bigint").alias("n"),
                 F.try_divide(F.col(f"z{i}") * F.lit(100.0), F.col("n")).alias("pct"))
        for i, z in enumerate(("low", "medium", "high"))])))


def confidence_errors(scored: DataFrame, high: float = 0.8) -> DataFrame:
    """Counts of (high / low confidence) x (correct / wrong)."""
    c = F.array_max("probability")
    ok = F.col("label").cast("double") == F.col("prediction").cast("double")
    a = scored.agg(F.count_if((c >= high) & ok).alias("high_correct"), F.count_if((c >= high) & ~ok).alias("high_wrong"),
                   F.count_if((c < high) & ok).alias("low_correct"), F.count_if((c < high) & ~ok).alias("low_wrong"))
    return a.select(*[F.col(x).cast("bigint").alias(x) for x in a.columns])


def class_probability_long(scored: DataFrame) -> DataFrame:
    """(class_index, p): one row per row and class."""
    return scored.select(F.posexplode("probability").alias("class_index", "p"))

