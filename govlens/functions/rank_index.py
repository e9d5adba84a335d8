"""A written rank index that answers any quantile of many columns or groups.

The index holds each (column, value) once, with its weight (how many rows have
it) and the weight up to it, in files that follow the order of (column, value).
It is built by one pass over the rows: copies collapse before the shuffle, range
partitions keep a large column or group spread, and the running weights are
taken within a partition; what came before is a row per column and partition.
A quantile then reads the one or two partitions that hold its ranks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from govlens.session import cut_lineage


class RankIndex:
    """Ranks of ``v`` for every ``c`` (a column's name or a group's value)."""

    def __init__(self, table: DataFrame, spans: DataFrame):
        self.table = table          # c, part, v, w, upto (the weight up to and with v in its part)
        self.spans = spans          # c, part, off (weight in earlier parts), pw (weight in this one), n (of c)
        self._listed: dict | None = None

    @classmethod
    def build(cls, long: DataFrame, parts: int | None = None) -> RankIndex:
        """From rows (c, v); missing and NaN values, and rows without ``c``, count for nothing."""
        parts = parts or int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        kept = long.where(F.col("c").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
        weighted = kept.groupBy("c", "v").agg(F.count(F.lit(1)).alias("w"))
        # range bounds come from a sample: one evaluation is written, and all answers read that one
        ordered = weighted.repartitionByRange(parts, "c", "v").sortWithinPartitions("c", "v") \
            .select("c", F.spark_partition_id().alias("part"), "v", "w")
        kind = ordered.schema["c"].dataType.simpleString()
        table = cut_lineage(ordered.mapInPandas(_running, f"c {kind}, part int, v double, w long, upto long"), "table", "ranks")
        by = Window.partitionBy("c")
        spans = table.groupBy("c", "part").agg(F.max("upto").alias("pw")).select(
            "c", "part", (F.sum("pw").over(by.orderBy("part")) - F.col("pw")).alias("off"), "pw", F.sum("pw").over(by).alias("n"))
        return cls(table, cut_lineage(spans, "table", "rank-spans"))

    @classmethod
    def of_columns(cls, df: DataFrame, columns: list[str], parts: int | None = None) -> RankIndex:
        return cls.build(df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns])).alias("p")).select("p.c", "p.v"), parts)

    @classmethod
    def of_groups(cls, df: DataFrame, by: str, value: str, parts: int | None = None) -> RankIndex:
        return cls.build(df.select(F.col(f"`{by}`").alias("c"), F.col(f"`{value}`").cast("double").alias("v")), parts)

    # ---------------------------------------------------------------- columns: a few names, answers on the driver

    def _spans(self) -> dict:
        """Per column its (off, pw, part) in order: as many rows as parts and columns together, as the ranges are contiguous."""
        if self._listed is None:
            found = defaultdict(list)
            for r in self.spans.select("c", "off", "pw", "part").collect():
                found[r["c"]].append((r["off"], r["pw"], r["part"]))
            self._listed = {c: sorted(v) for c, v in found.items()}
        return self._listed

    def count(self, c) -> int:
        """Rows of ``c`` that have a value."""
        return sum(pw for _, pw, _ in self._spans().get(c, []))

    def at(self, wanted: dict) -> dict:
        """``{(c, rank): value}`` for 0-based ranks ``{c: [rank, ...]}``."""
        asked = []
        for c, ranks in wanted.items():
            for rank in set(ranks):
                off, _, part = next(s for s in reversed(self._spans()[c]) if s[0] <= rank)
                asked.append((c, part, rank - off, rank))
        if not asked:
            return {}
        spark = self.table.sparkSession
        few = spark.createDataFrame(asked, f"c {self.table.schema['c'].dataType.simpleString()}, part int, place long, rank long")
        rows = self.table.where(F.col("part").isin(sorted({a[1] for a in asked}))).join(F.broadcast(few), ["c", "part"]) \
            .where((F.col("place") >= F.col("upto") - F.col("w")) & (F.col("place") < F.col("upto")))
        return {(r["c"], r["rank"]): r["v"] for r in rows.select("c", "rank", "v").collect()}

    def below(self, values: dict) -> dict:
        """``{c: (rows below the value, rows equal to it)}`` for ``{c: value}``."""
        if not values:
            return {}
        spark = self.table.sparkSession
        few = spark.createDataFrame([(c, float(v)) for c, v in values.items()], f"c {self.table.schema['c'].dataType.simpleString()}, m double")
        got = self.table.join(F.broadcast(few), "c").groupBy("c").agg(
            F.sum(F.when(F.col("v") < F.col("m"), F.col("w")).otherwise(0)).alias("less"),
            F.sum(F.when(F.col("v") == F.col("m"), F.col("w")).otherwise(0)).alias("same"))
        return {r["c"]: (r["less"], r["same"]) for r in got.collect()}

    def quantiles(self, columns: list, qs: list[float], filled: dict | None = None) -> dict[str, list[float | None]]:
        """Quantiles by linear interpolation for each of ``columns``; None for one without a value.

        ``filled`` ({c: (value, rows)}) answers for the columns as they are after so
        many gaps were filled with that value, without building anything anew.
        """
        filled = {c: f for c, f in (filled or {}).items() if f[0] is not None and f[1]}
        placed = self.below({c: f[0] for c, f in filled.items()})
        plan, wanted = {}, defaultdict(list)
        for c in columns:
            own, (value, more) = self.count(c), filled.get(c, (None, 0))
            if own + more == 0:
                continue
            ends = []
            for q in qs:
                x = (own + more - 1) * q
                lo = math.floor(x)
                ends.append((lo, min(lo + 1, own + more - 1), x - lo))
            less, same = placed.get(c, (0, 0))

            def place(rank, value=value, more=more, less=less, same=same):
                """The value itself where it is the filled one, else a rank among the column's own."""
                if more and less <= rank < less + same + more:
                    return None, value
                return (rank - more if more and rank >= less else rank), None
            plan[c] = [(place(lo), place(hi), frac) for lo, hi, frac in ends]
            wanted[c] = [p[0] for e in plan[c] for p in e[:2] if p[0] is not None]
        found = self.at(wanted)

        def value_of(c, p):
            return p[1] if p[0] is None else found[(c, p[0])]
        out = {}
        for c in columns:
            out[c] = [value_of(c, lo) + (value_of(c, hi) - value_of(c, lo)) * frac for lo, hi, frac in plan[c]] if c in plan else [None] * len(qs)
        return out

    # ---------------------------------------------------------------- groups: any number of them, answers as a frame

    def group_quantiles(self, qs: list[float]) -> DataFrame:
        """``c, q``: the quantiles ``qs`` of every group; nothing of a group reaches the driver."""
        at = lambda q: (F.col("n") - 1) * F.lit(float(q))
        ends = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"),
                     F.least(F.floor(at(q)) + side, F.col("n") - 1).alias("rank"), (at(q) - F.floor(at(q))).alias("frac"))
            for i, q in enumerate(qs) for side in (0, 1)]))
        wanted = self.spans.select("*", ends.alias("x")) \
            .where((F.col("x.rank") >= F.col("off")) & (F.col("x.rank") < F.col("off") + F.col("pw"))) \
            .groupBy("c", "part").agg(F.collect_list(F.struct("x.i", "x.side", "x.frac", (F.col("x.rank") - F.col("off")).alias("place"))).alias("xs"))
        hits = self.table.join(cut_lineage(wanted, "table", "ranks-wanted"), ["c", "part"]) \
            .select("c", "v", "w", "upto", F.explode("xs").alias("x")) \
            .where((F.col("x.place") >= F.col("upto") - F.col("w")) & (F.col("x.place") < F.col("upto")))
        value = lambda i, s: F.max(F.when((F.col("x.i") == i) & (F.col("x.side") == s), F.col("v")))
        frac = lambda i: F.max(F.when(F.col("x.i") == i, F.col("x.frac")))
        return hits.groupBy("c").agg(F.array(*[value(i, 0) + (value(i, 1) - value(i, 0)) * frac(i) for i in range(len(qs))]).alias("q"))


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running weights within (c, part) of rows in order; a partition's rows have one part."""
    last, held = None, 0
    for batch in batches:
        if not len(batch):
            continue
        upto = batch.groupby("c", sort=False)["w"].cumsum()
        first = batch["c"].iloc[0]
        if last is not None and first == last:
            upto = upto.where(batch["c"] != first, upto + held)
        last, held = batch["c"].iloc[-1], int(upto.iloc[-1])
        yield batch.assign(upto=upto)[["c", "part", "v", "w", "upto"]]

