"""Configured merge: the base table, then each join step in order."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from govlens.spec import JoinStep, MergeSpec

log = logging.getLogger(__name__)

_HOW = {"left": "left", "right": "right", "inner": "inner", "outer": "full", "full": "full"}


def join_step(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
              suffix: str = "_right") -> DataFrame:
    """Equi-join on ``on`` with pandas ``merge`` semantics.

    * missing keys match each other (null-safe equality, still planned as an
      equi-join: sort-merge or broadcast hash, never a nested loop);
    * one key column in the output: left keys for left/inner, right keys for
      right, coalesced for outer;
    * a right column whose name is taken on the left is renamed ``name+suffix``;
    * repeated right keys multiply rows (fan-out is kept).

    Strategy is left to the planner: a right side under the broadcast
    threshold (size-checked from statistics, and again at run time by AQE)
    is broadcast, otherwise both sides shuffle on the key; AQE splits skewed
    key partitions.
    """
    if how not in _HOW:
        raise ValueError(f"unsupported join type {how!r}")
    lcols = set(left.columns)
    rename = {}
    for c in right.columns:
        if c in on:
            continue
        if c in lcols:
            new = f"{c}{suffix}"
            if new in lcols or new in right.columns:
                raise ValueError(f"suffixed column {new!r} already exists")
            rename[c] = new
    rkeys = {k: f"__rk_{i}" for i, k in enumerate(on)}
    r = right.select(*[F.col(f"`{c}`").alias(rkeys.get(c) or rename.get(c, c)) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(r[rkeys[k]]) for k in on])
    j = left.join(r, cond, _HOW[how])
    out = []
    for c in left.columns:
        if c in on:
            if how == "right":
                out.append(F.col(rkeys[c]).alias(c))
            elif how in ("outer", "full"):
                out.append(F.coalesce(left[f"`{c}`"], F.col(rkeys[c])).alias(c))
            else:
                out.append(left[f"`{c}`"].alias(c))
        else:
            out.append(left[f"`{c}`"].alias(c))
    out += [F.col(f"`{rename.get(c, c)}`") for c in right.columns if c not in on]
    return j.select(*out)


def merge_tables(tables: dict[str, DataFrame], spec: MergeSpec | None) -> DataFrame:
    """Fold the configured joins over the base table.

    Skipped (with a warning), never raised: an invalid step, an unknown
    table, a key missing on either side.  No spec -> the first table; base
    table missing -> an empty frame.
    """
    if not tables:
        raise ValueError("no tables to merge")
    if spec is None:
        log.warning("no merge strategy; using the first table")
        return next(iter(tables.values()))
    if spec.base_table not in tables:
        log.error("base table %s not found", spec.base_table)
        any_df = next(iter(tables.values()))
        return any_df.sparkSession.createDataFrame([], T.StructType([]))
    merged = tables[spec.base_table]
    for step in spec.joins:
        if not isinstance(step, JoinStep):
            log.warning("invalid join step %r skipped", step)
            continue
        if step.table not in tables:
            log.warning("table %s not found; join skipped", step.table)
            continue
        right = tables[step.table]
        if not all(k in merged.columns for k in step.on) or not all(k in right.columns for k in step.on):
            log.warning("join keys %s missing; join with %s skipped", step.on, step.table)
            continue
        merged = join_step(merged, right, step.on, step.how, suffix=f"_{step.table}")
    return merged
