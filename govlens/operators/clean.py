"""Per-table cleaning: impute -> parse dates -> drop duplicate rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from govlens.functions import stats
from govlens.functions.dates import append_parts, parse_only
from govlens.functions.nulls import is_numeric, nan_to_null
from govlens.functions.rank_index import RankIndex

# Fixed value: fill for a non-numeric column with no value at all.
UNKNOWN = "Unknown"


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) for every column, from one aggregate."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("bigint").alias("n_missing"))
                      for c in df.columns])
    return one.select(F.inline(pairs))


@dataclass
class ImputeFit:
    """Fill values found for one table (numeric -> median, other -> mode)."""
    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)


def fit_impute(df: DataFrame, exact: bool = True) -> ImputeFit:
    """Statistics for the columns that have gaps (two small jobs at most)."""
    df = nan_to_null(df)
    gaps = {c: n for c, n in stats.null_count_map(df).items() if n}
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in gaps if is_numeric(types[c])]
    other = [c for c in gaps if c not in num]
    return ImputeFit(stats.median_map(df, num, exact) if num else {},
                     stats.mode_map(df, other) if other else {})


def apply_impute(df: DataFrame, fit: ImputeFit) -> DataFrame:
    """Numeric gaps take the median (the column becomes double; an all-missing
    numeric column stays missing); other gaps take the mode, or 'Unknown'
    when the column has no value at all (the column then becomes a string)."""
    df = nan_to_null(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in fit.medians:
            m = fit.medians[c]
            out.append(F.coalesce(col.cast("double"), F.lit(m).cast("double")).alias(c))
        elif c in fit.modes:
            m = fit.modes[c]
            if m is None:
                out.append(F.coalesce(col.cast("string"), F.lit(UNKNOWN)).alias(c))
            else:
                out.append(F.coalesce(col, F.lit(m).cast(types[c])).alias(c))
        else:
            out.append(col)
    return df.select(*out)


def fit_impute_all(tables: dict[str, DataFrame], exact: bool = True) -> dict[str, ImputeFit]:
    """``fit_impute`` for many tables with ONE job for all null counts (the
    per-table one-row aggregates are unioned), one rank index for the medians
    of all tables' gap columns, and a mode job for tables with other gaps."""
    if not tables:
        return {}
    longs = []
    for name, df in tables.items():
        df = nan_to_null(df)
        one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
        longs.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("t"), F.lit(c).alias("c"), F.col(f"c{i}").cast("bigint").alias("n"))
            for i, c in enumerate(df.columns)]))))
    counts = reduce(lambda a, b: a.unionByName(b), longs).where("n > 0").collect()   # <= total column count
    gaps: dict[str, list[str]] = {}
    for r in counts:
        gaps.setdefault(r["t"], []).append(r["c"])
    types = {name: {f.name: f.dataType for f in df.schema.fields} for name, df in tables.items()}
    num = {name: [c for c in cols if is_numeric(types[name][c])] for name, cols in gaps.items()}
    medians = _medians(tables, {name: cols for name, cols in num.items() if cols}, exact)
    return {name: ImputeFit(medians.get(name, {}), stats.mode_map(nan_to_null(tables[name]), other) if (
        other := [c for c in gaps.get(name, []) if c not in num[name]]) else {}) for name in tables}


def _medians(tables: dict[str, DataFrame], columns: dict[str, list[str]], exact: bool) -> dict[str, dict[str, float | None]]:
    """Medians of the listed columns of all tables, from one rank index."""
    if not exact or not columns:
        return {name: stats.median_map(nan_to_null(tables[name]), cols, exact) for name, cols in columns.items()}
    names = {f"{i}.{j}": (name, c) for i, (name, cols) in enumerate(columns.items()) for j, c in enumerate(cols)}
    own = {v: k for k, v in names.items()}
    long = [tables[name].select(F.explode(F.array(*[
        F.struct(F.lit(own[(name, c)]).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])).alias("p")).select("p.c", "p.v")
        for name, cols in columns.items()]
    found = RankIndex.build(reduce(lambda a, b: a.unionByName(b), long)).quantiles(list(names), [0.5])
    return {name: {c: found[own[(name, c)]][0] for c in cols} for name, cols in columns.items()}


def impute(df: DataFrame, exact: bool = True) -> DataFrame:
    return apply_impute(df, fit_impute(df, exact))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct; NULL equals NULL.  Copies collapse in the map-side
    partial aggregate, so a heavily copied row costs no shuffle volume."""
    return df.dropDuplicates()


def distinct_with_dates(df: DataFrame, date_columns: list[str]) -> DataFrame:
    """``parse_dates``, then ``drop_duplicates``: rows are compared and moved without the parts, which follow from their dates."""
    return append_parts(drop_duplicates(parse_only(df, date_columns)), date_columns)


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (ascending; default all other
    columns).  An aggregate min over a struct, not a window, so a hot key is
    reduced map-side."""
    rest = [c for c in df.columns if c not in keys]
    order = order or rest
    tail = [c for c in rest if c not in order]
    s = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)],
                 *[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(tail)])
    g = df.groupBy(*keys).agg(F.min(s).alias("_s"))
    names = {c: f"_s.o{i}" for i, c in enumerate(order)} | {c: f"_s.t{i}" for i, c in enumerate(tail)}
    return g.select(*[F.col(c) if c in keys else F.col(names[c]).alias(c) for c in df.columns])


def clean_table(df: DataFrame, date_columns: list[str], exact: bool = True) -> DataFrame:
    """The reference's order: fill gaps, parse dates (+ parts), drop duplicates."""
    return distinct_with_dates(impute(df, exact), date_columns)


def target_extract(df: DataFrame, target: str | None, key_columns: list[str]) -> DataFrame | None:
    """(key..., label) or None when no target is configured or present."""
    if not target or target not in df.columns:
        return None
    return df.select(*[k for k in key_columns if k in df.columns], F.col(f"`{target}`").alias("label"))


def value_counts(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """(value, n) over non-missing values (pandas ``value_counts``)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(name or col))
              .agg(F.count(F.lit(1)).alias("n")))


def exclude_columns(df: DataFrame, target: str | None, excluded: list[str]) -> DataFrame:
    drop = set(excluded) | ({target} if target else set())
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in drop])


def numeric_only(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Numeric columns only (booleans are not numeric), plus ``keep`` columns."""
    keep = keep or []
    cols = [f.name for f in df.schema.fields if f.name in keep or is_numeric(f.dataType)]
    return df.select(*[F.col(f"`{c}`") for c in cols])


@dataclass
class Filled:
    """The rank index of columns before their gaps were filled, and what filled them: {column: (median, rows)}."""
    ranks: RankIndex
    fills: dict[str, tuple[float | None, int]]

    def quantiles(self, columns: list[str], qs: list[float]) -> dict[str, list[float | None]]:
        """Of the filled columns."""
        return self.ranks.quantiles(columns, qs, self.fills)


def fill_numeric(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Filled | None]:
    """``clean_numeric`` by a rank index of all ``columns``, which goes on to answer any quantile of the result."""
    df = nan_to_null(df, also_inf=True)
    if not columns:
        return df, None
    ranks = RankIndex.of_columns(df, columns)
    n = df.count()
    gaps = {c: n - ranks.count(c) for c in columns if ranks.count(c) < n}
    medians = ranks.quantiles(list(gaps), [0.5])
    fills = {c: (medians[c][0], k) for c, k in gaps.items()}
    return _filled(df, columns, {c: m for c, (m, _) in fills.items()}), Filled(ranks, fills)


def clean_numeric(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """+-Inf and NaN -> missing, then each column's median; an all-missing
    column stays missing.  The listed columns are cast to double (the model
    stages need doubles)."""
    if exact:
        return fill_numeric(df, columns)[0]
    df = nan_to_null(df, also_inf=True)
    return _filled(df, columns, stats.median_map(df, columns, False))


def _filled(df: DataFrame, columns: list[str], medians: dict[str, float | None]) -> DataFrame:
    cols = set(columns)
    return df.select(*[
        F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(medians.get(c)).cast("double")).alias(c) if c in cols
        else F.col(f"`{c}`") for c in df.columns])
