"""Date parsing and date-part features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Anchor of the "days since" feature and the suffixes of the
# derived date columns.
DAYS_SINCE_ANCHOR = "2020-01-01"
PART_SUFFIXES = ("_year", "_month", "_day_of_week", "_hour", "_days_since")


def to_timestamp_or_null(c: Column, dt: T.DataType) -> Column:
    """Parse to a zone-less timestamp; unparsable values become NULL (never raise)."""
    if isinstance(dt, T.TimestampNTZType):
        return c
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return c.cast("string").try_cast("timestamp_ntz")


def date_parts(c: Column, name: str) -> list[Column]:
    """Year, month, weekday (Monday = 0), hour and whole days since the anchor.

    ``weekday`` (not ``dayofweek``, which starts at Sunday = 1).  The anchor
    is a midnight, so ``datediff`` of the date equals the floor of the
    fractional day difference, negative before the anchor.
    """
    return [
        F.year(c).cast("bigint").alias(f"{name}_year"),
        F.month(c).cast("bigint").alias(f"{name}_month"),
        F.weekday(c).cast("bigint").alias(f"{name}_day_of_week"),
        F.hour(c).cast("bigint").alias(f"{name}_hour"),
        F.datediff(F.to_date(c), F.lit(DAYS_SINCE_ANCHOR).cast("date")).cast("bigint").alias(f"{name}_days_since"),
    ]


def parse_only(df: DataFrame, date_columns: list[str]) -> DataFrame:
    """Each configured date column present as a timestamp, without its parts (those that are there are left out)."""
    present = [c for c in date_columns if c in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    names = {f"{c}{s}" for c in present for s in PART_SUFFIXES}
    return df.select(*[to_timestamp_or_null(F.col(f"`{c}`"), types[c]).alias(c) if c in present else F.col(f"`{c}`")
                       for c in df.columns if c not in names])


def append_parts(df: DataFrame, date_columns: list[str]) -> DataFrame:
    """The five parts of each parsed date column present."""
    present = [c for c in date_columns if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *[e for c in present for e in date_parts(F.col(f"`{c}`"), c)])


def parse_dates(df: DataFrame, date_columns: list[str]) -> DataFrame:
    """Parse each configured date column present and append its five parts.

    A part column already present (re-parsing) is replaced, not duplicated.
    """
    if not any(c in df.columns for c in date_columns):
        return df
    return append_parts(parse_only(df, date_columns), date_columns)


def whole_days_between(start: Column, end: Column) -> Column:
    """floor((end - start) / 1 day) on zone-less timestamps (calendar-free)."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")
