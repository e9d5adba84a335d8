"""One-pass column statistics (medians, quantiles, modes, null counts).

Each function runs ONE Spark job over the input whatever the number of
columns, and returns a small driver-side dict (one value per column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Spark generates one method per aggregate; past a few hundred expressions
# the generated code hits the JVM method-size limit, so very wide frames are
# aggregated in chunks.
AGG_CHUNK = 200


def _chunks(items: list, n: int = AGG_CHUNK):
    for i in range(0, len(items), n):
        yield items[i:i + n]


def null_count_map(df: DataFrame, columns: list[str] | None = None) -> dict[str, int]:
    cols = columns or df.columns
    out: dict[str, int] = {}
    for chunk in _chunks(cols):
        row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in chunk]).first()
        out.update(row.asDict())
    return out


def quantile_expr(c: str, qs: list[float] | float, exact: bool = True, accuracy: int = 100_000):
    """Linear-interpolation quantiles (pandas ``quantile``/``median``).

    exact=True uses ``percentile``: its buffer is a value->count map, so memory
    grows with DISTINCT values (small for codes, date parts, 4-dp scores).
    exact=False uses ``percentile_approx`` (bounded sketch) for continuous,
    high-cardinality columns at large scale.
    """
    col = F.col(f"`{c}`").cast("double")
    if exact:
        return F.percentile(col, qs if isinstance(qs, float) else F.array(*[F.lit(q) for q in qs]))
    return F.percentile_approx(col, qs if isinstance(qs, float) else list(qs), accuracy)


def median_map(df: DataFrame, columns: list[str], exact: bool = True) -> dict[str, float | None]:
    """Medians of all columns; exact ones from a rank index."""
    if exact and columns:
        from govlens.functions.quantiles import exact_quantiles
        return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}
    out: dict[str, float | None] = {}
    for chunk in _chunks(columns):
        if not chunk:
            continue
        row = df.agg(*[quantile_expr(c, 0.5, exact).alias(c) for c in chunk]).first()
        out.update(row.asDict())
    return out


def mode_map(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column, smallest on ties, as a string.

    All columns are unpivoted into (column, value) and counted with one
    partial (map-side) aggregation, so a hot value is collapsed before the
    shuffle; the winner per column is a streaming min over (-count, value).
    Only for columns whose string form orders like the value (strings,
    booleans, dates, timestamps) - numeric columns use medians.
    """
    if not columns:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns
    ])).alias("p")).select("p.col", "p.v").where(F.col("v").isNotNull())
    counted = long.groupBy("col", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("col").agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("v"))).alias("b"))
    found = {r["col"]: r["b"]["v"] for r in best.collect()}   # one row per column
    return {c: found.get(c) for c in columns}
