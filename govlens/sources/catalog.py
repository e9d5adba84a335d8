"""Table catalog: load every configured table, project, profile, peek."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from govlens.sources import files
from govlens.sources.jdbc import read_jdbc
from govlens.spec import TableSpec

log = logging.getLogger(__name__)


def table_path(base_dir: str, spec: TableSpec) -> str:
    if spec.path:
        return spec.path if "/" in spec.path else f"{base_dir.rstrip('/')}/{spec.path}"
    return f"{base_dir.rstrip('/')}/{spec.name}.{spec.format}"


def load_table(spark: SparkSession, base_dir: str, spec: TableSpec) -> DataFrame | None:
    """One table, or None (with a warning) when its file is missing.

    Each source reads only the configured columns.  A ``jdbc`` table takes its
    connection from ``spec.options`` (see ``jdbc_options``).
    """
    if spec.format == "jdbc":
        return read_jdbc(spark, spec.columns, **{"table": spec.name, **(spec.options or {})})
    path = table_path(base_dir, spec)
    try:
        if spec.format == "csv":
            return files.read_csv(spark, path, spec.columns)
        return files.read_parquet(spark, path, spec.columns)
    except AnalysisException as e:
        log.warning("table %s not loaded from %s: %s", spec.name, path, e)
        return None


def load_all_tables(spark: SparkSession, base_dir: str, specs: dict[str, TableSpec],
                    loader: Callable[[SparkSession, str, TableSpec], DataFrame | None] = load_table
                    ) -> dict[str, DataFrame]:
    """Every configured table that loads; failures are dropped, not raised."""
    out = {}
    for name, spec in specs.items():
        try:
            df = loader(spark, base_dir, spec)
        except Exception as e:  # noqa: BLE001 - a failing table must not stop the rest
            log.warning("table %s failed: %s", name, e)
            df = None
        if df is not None:
            out[name] = df
    return out


def project(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """The configured column list (every column when unset); unknown names are ignored."""
    if not columns:
        return df
    return df.select(*[c for c in columns if c in df.columns])


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_cols): one count per table, unioned into one plan."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(name).alias("table_name"), F.col("n_rows"),
                        F.lit(len(df.columns)).cast("bigint").alias("n_cols"))
              for name, df in tables.items()]
    return files.union_all(frames)


def head(df: DataFrame, n: int = 5, order_by: list[str] | str | None = None) -> DataFrame:
    """First ``n`` rows by the primary key (a top-k: partial sort per partition)."""
    if order_by:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        df = df.orderBy(*keys)
    return df.limit(n)
