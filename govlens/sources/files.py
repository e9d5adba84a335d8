"""File sources: parquet and CSV with pandas-compatible missing-value tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from govlens.functions.nulls import nan_to_null

# The strings pandas.read_csv treats as missing by default
# (pandas documentation, ``na_values``).
CSV_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: Forms that every whole number and every number has, whatever white space or control characters are about it.
_WHOLE = r"^[^0-9A-Za-z+-]*[+-]?[0-9]+[^0-9A-Za-z]*$"
_NUMBER = r"(?i)^[^0-9a-z]*(nan|inf|infinity|[a-fxp.+-]*[0-9][0-9a-fxp.+-]*)[^0-9a-z]*$"


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    return nan_to_null(df)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             schema: T.StructType | None = None) -> DataFrame:
    """Read a headered CSV; NA tokens become NULL, column types are inferred
    like pandas (integer, float, boolean, else string) in one statistics pass.
    Dates stay strings here, as in the reference; ``parse_dates`` converts them.
    """
    if schema is not None:
        df = spark.read.csv(path, header=True, schema=schema, nullValue="", nanValue="NaN")
        return nan_to_null(df.select(*columns) if columns else df)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if columns:
        raw = raw.select(*[c for c in columns if c in raw.columns])
    tokens = F.array(*[F.lit(t) for t in CSV_NA_TOKENS])
    cleaned = raw.select(*[
        F.when(F.array_contains(tokens, F.col(c)) | F.col(c).isNull(), F.lit(None).cast("string"))
         .otherwise(F.col(c)).alias(c) for c in raw.columns])
    return infer_types(cleaned)


def infer_types(df: DataFrame) -> DataFrame:
    """Cast string columns to bigint / double / boolean when every non-null
    value parses as such (one aggregate over all columns)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df
    checks = []
    for c in cols:
        v = F.col(c)
        # a failed try_cast costs an exception a value: what can't be a number is known by its form
        for kind, may_be, parsed in (("long", v.rlike(_WHOLE), F.expr(f"try_cast(`{c}` as bigint)")),
                                     ("double", v.rlike(_NUMBER) & ~v.rlike("[0-9][+-]"), F.expr(f"try_cast(`{c}` as double)"))):
            checks.append(F.bool_and(v.isNull() | (may_be & parsed.isNotNull())).alias(f"{c}\u0001{kind}"))
        checks.append(F.bool_and(v.isNull() | v.isin("True", "False", "true", "false")).alias(f"{c}\u0001bool"))
        checks.append(F.count(v).alias(f"{c}\u0001n"))
    row = df.agg(*checks).first().asDict()
    out = []
    for c in cols:
        if not row[f"{c}\u0001n"]:
            # all missing: pandas reads float64 NaN
            out.append(F.col(c).cast("double").alias(c))
        elif row[f"{c}\u0001long"]:
            out.append(F.expr(f"try_cast(`{c}` as bigint)").alias(c))
        elif row[f"{c}\u0001double"]:
            out.append(F.expr(f"try_cast(`{c}` as double)").alias(c))
        elif row[f"{c}\u0001bool"]:
            out.append((F.lower(F.col(c)) == "true").alias(c))
        else:
            out.append(F.col(c))
    keep = {c: e for c, e in zip(cols, out)}
    return nan_to_null(df.select(*[keep.get(c, F.col(c)) for c in df.columns]))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
