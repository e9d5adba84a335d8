"""Exact quantiles (linear interpolation, as pandas) from a rank index, whatever the number of distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from govlens.functions.rank_index import RankIndex


def exact_quantiles(df: DataFrame, columns: list[str], qs: list[float]) -> dict[str, list[float | None]]:
    """Quantiles of every column (None if it has no value), from one build for all of them."""
    return RankIndex.of_columns(df, columns).quantiles(columns, qs) if columns else {}


def grouped_quantiles(long: DataFrame, qs: list[float], n_parts: int | None = None) -> DataFrame:
    """``c, q``: the exact quantiles ``qs`` of ``v`` for every group ``c`` of a long (c, v) frame."""
    return RankIndex.build(long, n_parts).group_quantiles(qs)
