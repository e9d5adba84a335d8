"""JDBC source: ``SELECT <columns> FROM table`` (``SELECT *`` when no list).

Spark pushes the projection (and any later filter) into the database query.
``partition_column`` splits the read across executors: by given bounds, or by
key ranges of about equal size that the source works out from the key's own
least and largest value and counts.  No database is reachable in the test
environment, so the queries, predicates and options are unit-tested and the
read itself is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from govlens.functions.nulls import nan_to_null
from govlens.sources import key_ranges


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("without a plan of key ranges, partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def partition_plan(spark: SparkSession, options: dict[str, str], key: str, num_partitions: int) -> list[str]:
    """A predicate per partition for an integer key, each for about as many rows as any other.

    Only aggregates are read: the key's least and largest value and its count,
    and counts per step of ranges that hold more than their share.
    """
    table = options["dbtable"]
    common = {k: v for k, v in options.items() if k != "dbtable"}

    def ask(query: str):
        return spark.read.format("jdbc").options(**common, query=query).load().collect()

    low, high, n, total = ask(key_ranges.bounds_query(table, key))[0]
    if n and (int(low) != low or int(high) != high):
        raise ValueError(f"{key} isn't an integer key")

    def counts(a: int, b: int, step: int) -> dict[int, int]:
        return {int(r[0]): int(r[1]) for r in ask(key_ranges.counts_query(table, key, a, b, step))}

    ranges = key_ranges.balanced_ranges(int(low), int(high), int(n), counts, num_partitions) if n else []
    return key_ranges.predicates(key, ranges, total > n)


def read_jdbc(spark: SparkSession, columns: list[str] | None = None, partition_column: str | None = None,
              num_partitions: int | None = None, **kw) -> DataFrame:
    """``partition_column`` and ``num_partitions`` without bounds make a plan of key ranges."""
    if partition_column and num_partitions and kw.get("lower_bound") is None and kw.get("upper_bound") is None:
        opts = jdbc_options(**{k: v for k, v in kw.items() if k not in ("lower_bound", "upper_bound")})
        plan = partition_plan(spark, opts, partition_column, num_partitions)
        rest = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        df = spark.read.jdbc(opts["url"], opts["dbtable"], predicates=plan, properties=rest)
    else:
        df = spark.read.format("jdbc").options(**jdbc_options(partition_column=partition_column, num_partitions=num_partitions, **kw)).load()
    if columns:
        df = df.select(*columns)
    return nan_to_null(df)
