"""Missing-value model.

pandas treats NaN as missing (comparisons false, skipped by means, dropped
by groupby).  Spark treats NaN as a value (``NaN > 0.7`` is true), so every
float column is normalised to NULL at ingest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOAT_TYPES = (T.DoubleType, T.FloatType)
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def nan_to_null(df: DataFrame, also_inf: bool = False) -> DataFrame:
    out = []
    changed = False
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, FLOAT_TYPES):
            bad = F.isnan(c)
            if also_inf:
                bad = bad | (F.abs(c) == F.lit(float("inf")))
            out.append(F.when(bad, F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
            changed = True
        else:
            out.append(c)
    return df.select(*out) if changed else df


def as_string_or_nan(c: Column) -> Column:
    """String form used by the label encoder: a missing value is the class 'nan'."""
    return F.coalesce(c.cast("string"), F.lit("nan"))
