"""Registered queries: one Spark plan per operator of the inventory, each
paired with its DuckDB oracle statement (``None`` = rows-only check).

Every query reads the bound test tables of ``sf_dir`` (or frames Spark
derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from govlens.plans.context import context

ROUND = 6
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def round_floats(df: DataFrame, digits: int = ROUND) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def query(name: str, sql: str | None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_floats(fn(context(spark, sf_dir)))
        run.__name__ = name
        REGISTRY[name] = (run, sql)
        return fn
    return deco

