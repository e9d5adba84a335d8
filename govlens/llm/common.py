"""Helpers shared by the corpus operators: table access, row keys, written intermediate tables."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from govlens.session import shared_path

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def row_key(*cols: str) -> list[Column]:
    """A 128-bit key of a row's content, as two independent 64-bit hashes.

    Rows that repeat get equal keys, so whatever is derived from the content
    and joined back by this key is right for each of them, even where an id
    is null or used twice.
    """
    c = [F.col(x) for x in cols]
    return [F.xxhash64(F.lit(1), *c).alias("_k1"), F.xxhash64(F.lit(2), *c).alias("_k2")]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the
    measured size of the table for its choice of joins.
    """
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with the place of each row in its group (_index, from 0) and the group's size (_size).

    ``group`` and ``order`` together tell all rows apart, and ``group`` has no
    null.  Rows are range-partitioned by both and written, so a large group is
    spread; a row's place is its group's count in the partitions before and its
    place in its own.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *group, *order).sortWithinPartitions(*group, *order)
                     .withColumn("_at", F.monotonically_increasing_id()), name).withColumn("_part", F.shiftright("_at", 33))
    spans = ranged.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    by = Window.partitionBy(*group)                              # a row per partition that holds the group
    spans = spans.select("_part", *group, "_first", F.sum("_n").over(by).alias("_size"),
                         (F.sum("_n").over(by.orderBy("_part")) - F.col("_n")).alias("_before"))
    return ranged.join(spans, ["_part", *group]) \
        .withColumn("_index", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def bounded_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of a batch, unless the session says otherwise: texts can be very long."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "1000"),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def per_worker(key, make):
    """One object for all tasks of a Python worker process, made by the first of them that asks.

    Functions travel with the job, so their module's globals are new in each
    task; this state belongs to the process.
    """
    state = sys.modules.setdefault("_govlens_llm_worker", types.ModuleType("_govlens_llm_worker")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def held(docs: DataFrame, **named: str) -> DataFrame:
    """``docs`` as one struct column ``_row``, and the columns that are worked on under names of their own.

    Whatever else ``docs`` has, no name of an operator's own can clash with it.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[F.col(f"`{c}`").alias(n) for n, c in named.items()])


def released(columns: list[str], **outputs: Column) -> list[Column]:
    """The columns of ``_row`` again, and the outputs; an output takes the place of a column of its name."""
    return [outputs.pop(c).alias(c) if c in outputs else F.col("_row").getField(c).alias(c) for c in columns] \
        + [v.alias(k) for k, v in outputs.items()]


def hashed_sample(docs: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows of ``docs``, those with the least hash of ``columns``; rows of equal content count once.

    Only hashes are sorted, so what isn't taken isn't moved.
    """
    keyed = docs.withColumn("_hash", F.xxhash64(*columns))
    cut = keyed.select("_hash").distinct().orderBy("_hash").limit(rows).agg(F.max("_hash")).first()[0]
    return keyed.where(F.col("_hash") <= F.lit(cut)).dropDuplicates(["_hash"]).drop("_hash")
