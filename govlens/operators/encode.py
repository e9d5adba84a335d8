"""Label encoding (sorted classes -> 0..k-1, unseen -> -1) and standard scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from govlens.functions.lookup import hot_keys, key_hashes, spread_lookup
from govlens.functions.nulls import as_string_or_nan
from govlens.functions.ranking import dense_index
from govlens.session import cut_lineage

# How a fitted mapping meets the data, with the same result each way: up to
# INLINE_MAX_CLASSES classes a literal map inside the projection (a linear
# search, so only for short lists); class lists that the driver numbered and
# that are small together, a broadcast each; all others, one dictionary pass.
INLINE_MAX_CLASSES = 100
SMALL_TOTAL_CLASSES = 50_000    # all columns together, numbered on the driver
BROADCAST_MAX_CHARS = 4_000_000


@dataclass
class LabelEncoding:
    """Fitted encoders: one DataFrame (column_name, value, code) for all columns."""
    mapping: DataFrame
    sizes: dict[str, int]          # classes per column (one small job)
    classes: dict[str, list[str]] | None = None   # sorted classes, when numbered on the driver

    @property
    def columns(self) -> list[str]:
        return list(self.sizes)


def label_encode_fit(df: DataFrame, columns: list[str], materialize: str = "checkpoint") -> LabelEncoding:
    """Classes of every listed column present: the string form of each value,
    a missing value being the class 'nan', sorted by code point (Python and
    Spark string order agree), numbered from 0.  One distinct over all
    columns at once (unpivoted), then a distributed dense rank."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        empty = df.sparkSession.createDataFrame([], "column_name string, value string, code bigint")
        return LabelEncoding(empty, {})
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), as_string_or_nan(F.col(f"`{c}`")).alias("value")) for c in cols
    ])).alias("p")).select("p.column_name", "p.value")
    distinct = long.distinct()
    # Small class sets (the usual case) are numbered on the driver after a
    # bounded fetch: at most SMALL_TOTAL_CLASSES + 1 rows are ever pulled.
    # Larger ones take the distributed dense rank.
    head = distinct.limit(SMALL_TOTAL_CLASSES + 1).collect()
    if len(head) <= SMALL_TOTAL_CLASSES:
        by_col: dict[str, list[str]] = {}
        for r in head:
            by_col.setdefault(r["column_name"], []).append(r["value"])
        rows = [(c, v, i) for c in cols for i, v in enumerate(sorted(by_col.get(c, [])))]
        mapping = df.sparkSession.createDataFrame(rows, "column_name string, value string, code bigint")
        return LabelEncoding(mapping, {c: len(by_col.get(c, [])) for c in cols},
                             {c: sorted(by_col.get(c, [])) for c in cols})
    mapping = cut_lineage(dense_index(distinct, "column_name", "value", materialize=materialize), "persist")
    sizes = {r["column_name"]: r["n"] for r in mapping.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    return LabelEncoding(mapping, {c: sizes.get(c, 0) for c in cols})


def label_encode_apply(df: DataFrame, enc: LabelEncoding) -> DataFrame:
    """Replace each encoded column by its code; unseen values get -1; columns
    without a fitted encoder are left untouched."""
    cols = [c for c in enc.columns if c in df.columns]
    small = [c for c in cols if enc.sizes.get(c, 0) <= INLINE_MAX_CLASSES]
    maps = {}
    if small and enc.classes is not None:
        for c in small:
            maps[c] = [x for i, v in enumerate(enc.classes.get(c, [])) for x in (F.lit(v), F.lit(i))]
    elif small:
        # class lists of the small columns only: bounded by the check above
        for r in enc.mapping.where(F.col("column_name").isin(small)).collect():
            maps.setdefault(r["column_name"], []).extend([F.lit(r["value"]), F.lit(r["code"])])
    out = df.select(*[
        F.coalesce(F.try_element_at(F.create_map(*maps[c]), as_string_or_nan(F.col(f"`{c}`"))) if maps.get(c) else F.lit(None),
                   F.lit(-1)).cast("bigint").alias(c) if c in small else F.col(f"`{c}`")
        for c in df.columns])
    long = [c for c in cols if c not in small]
    listed = sum(len(v) for c in long for v in enc.classes.get(c, [])) if enc.classes is not None else None
    if long and (listed is None or listed > BROADCAST_MAX_CHARS):
        return dictionary_codes(out, enc, long)
    for c in long:
        m = (enc.mapping.where(F.col("column_name") == c)
                .select(F.col("value").alias("__v"), F.col("code").alias("__code")))
        out = (out.withColumn("__v", as_string_or_nan(F.col(f"`{c}`")))
                  .join(F.broadcast(m), "__v", "left")         # SMALL_TOTAL_CLASSES rows at most
                  .withColumn(c, F.coalesce(F.col("__code"), F.lit(-1)).cast("bigint"))
                  .drop("__v", "__code"))
    return out.select(*df.columns)


def dictionary_codes(df: DataFrame, enc: LabelEncoding, cols: list[str]) -> DataFrame:
    """Codes of all ``cols`` in one pass, however many values they have.

    The distinct combinations of the columns' values are taken first (copies
    collapse before the shuffle), and one lookup of (column, value) pairs
    gives all their codes; the frame itself moves once, to meet the
    combinations.  Values and combinations that many rows share are answered
    from small broadcasts, so neither gathers in one task.
    """
    text = [as_string_or_nan(F.col(f"`{c}`")) for c in cols]
    whole = key_hashes(*text)
    values = [f"_v{i}" for i in range(len(cols))]
    combos = df.select(*[k.alias(n) for k, n in zip(whole, ("_k1", "_k2"))], *[t.alias(v) for t, v in zip(text, values)]) \
        .groupBy("_k1", "_k2", *values).agg(F.count(F.lit(1)).alias("_n"))
    combos = cut_lineage(combos, "table", "encode-combinations")
    pairs = combos.select("_k1", "_k2", F.posexplode(F.array(*values)).alias("_i", "_value")) \
        .withColumns(dict(zip(("_p1", "_p2"), key_hashes(F.col("_i"), F.col("_value"))))).drop("_value")
    at = (F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("column_name")) - 1).cast("int")
    codes_of = enc.mapping.where(F.col("column_name").isin(cols)) \
        .select(*[k.alias(n) for k, n in zip(key_hashes(at, F.col("value")), ("_p1", "_p2"))], F.col("code").alias("_code"))
    often = hot_keys(pairs.groupBy("_p1", "_p2").agg(F.count(F.lit(1)).alias("_n")), ["_p1", "_p2"], "_n")
    coded = spread_lookup(pairs, codes_of, ["_p1", "_p2"], ["_code"], often, ["_k1", "_k2", "_i"])
    found = [f"_c{i}" for i in range(len(cols))]
    table = coded.groupBy("_k1", "_k2").agg(*[F.max(F.when(F.col("_i") == i, F.col("_code"))).alias(c) for i, c in enumerate(found)])
    table = cut_lineage(table, "table", "encode-codes")
    rows = df.withColumns(dict(zip(("_k1", "_k2"), whole)))
    out = spread_lookup(rows, table, ["_k1", "_k2"], found, hot_keys(combos, ["_k1", "_k2"], "_n"), df.columns)
    code = {c: F.coalesce(F.col(f), F.lit(-1)).cast("bigint").alias(c) for c, f in zip(cols, found)}
    return out.select(*[code.get(c, F.col(f"`{c}`")) for c in df.columns])


def label_encode(df: DataFrame, columns: list[str], materialize: str = "checkpoint"):
    enc = label_encode_fit(df, columns, materialize)
    return label_encode_apply(df, enc), enc


@dataclass
class ScalerFit:
    means: dict[str, float | None]
    stds: dict[str, float]


def standard_scale_fit(df: DataFrame, columns: list[str]) -> ScalerFit:
    """Mean and POPULATION standard deviation of each column (one aggregate);
    a zero deviation is replaced by 1."""
    aggs = []
    for c in columns:
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"m{len(aggs)}"), F.stddev_pop(F.col(f"`{c}`")).alias(f"s{len(aggs)+1}")]
    row = list(df.agg(*aggs).first()) if aggs else []
    means, stds = {}, {}
    for i, c in enumerate(columns):
        means[c] = row[2 * i]
        s = row[2 * i + 1]
        stds[c] = 1.0 if not s else s
    return ScalerFit(means, stds)


def standard_scale_apply(df: DataFrame, fit: ScalerFit) -> DataFrame:
    return df.select(*[
        ((F.col(f"`{c}`") - F.lit(fit.means[c])) / F.lit(fit.stds[c])).alias(c) if c in fit.means
        else F.col(f"`{c}`") for c in df.columns])


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    return standard_scale_apply(df, standard_scale_fit(df, columns))
