"""Binding of the driver's test tables to the four access-governance tables.

The driver ships TPC-H-like tables and an event stream, not IAM data, so the
four inputs of the pipeline are derived from them (the same definitions are
written as SQL for the DuckDB oracle in ``govlens.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from govlens.functions.nulls import nan_to_null

TABLES = ("decision_history", "access_usage", "peer_group", "recertification_history")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def decision_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    uid = F.col("user_id")
    return nan_to_null(e.select(
        F.col("event_id").alias("request_id"),
        uid.alias("user_id"),
        F.concat(F.lit("item_"), k.cast("string")).alias("access_item"),
        F.when(F.col("event_id") % 10 < F.when(F.col("value") > 70, 7).otherwise(1), "reject")
         .otherwise("approve").alias("decision"),
        F.col("ts").alias("request_ts"),
        F.when(uid % 4 == 0, "Developer").when(uid % 4 == 1, "Manager")
         .when(uid % 4 == 2, "Admin").otherwise("Analyst").alias("requester_role"),
        ((uid * 7 + 3) % 150).alias("approver_id"),
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("risk_score"),
        (F.col("event_id") % 7 == 0).alias("sod_conflict"),
        (k % 3 == 0).alias("is_privileged_access"),
    ))


def access_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate",
                                                 "l_returnflag")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias("user_id"),
                      F.concat(F.lit("item_"), (F.col("l_partkey") % 100).cast("string")).alias("access_item"))
             .agg(F.max("l_shipdate").alias("last_used_date"),
                  F.sum("l_quantity").cast("bigint").alias("frequency"),
                  F.max("l_returnflag").alias("access_type")))


def peer_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    lvl = (1 + F.col("c_custkey") % 5)
    return j.select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.col("n_name"), F.lit("_"), F.col("r_name"), F.lit("_L"), lvl.cast("string")).alias("peer_group_id"),
        F.col("c_mktsegment").alias("role"),
        F.col("n_name").alias("department"),
        lvl.alias("seniority_level"),
        F.col("r_name").alias("location"),
        F.when(F.col("c_acctbal") < 0, "Contractor").otherwise("FTE").alias("employment_type"),
    )


def recertification_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per (customer, item) as the last recertification.

    "Latest per key" is an aggregate (max of a struct ordered by date, then
    smallest order key), not a window: partial aggregation collapses a hot key
    map-side instead of sorting the whole group in one task.
    """
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                              "o_orderpriority")
    best = F.max(F.struct(F.col("o_orderdate"), (-F.col("o_orderkey")).alias("neg_key"),
                          F.col("o_orderstatus"), F.col("o_orderpriority"))).alias("b")
    g = o.groupBy(F.col("o_custkey").alias("user_id"),
                  F.concat(F.lit("item_"), (F.col("o_orderkey") % 100).cast("string")).alias("access_item")).agg(best)
    status = F.col("b.o_orderstatus")
    return g.select(
        "user_id", "access_item",
        F.col("b.o_orderdate").alias("last_certified_date"),
        F.when(status == "F", "approved").when(status == "P", "revoked").otherwise("deferred")
         .alias("certification_outcome"),
        F.col("b.o_orderpriority").alias("certified_by"),
    )


def load_bound_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "decision_history": decision_history(spark, sf_dir),
        "access_usage": access_usage(spark, sf_dir),
        "peer_group": peer_group(spark, sf_dir),
        "recertification_history": recertification_history(spark, sf_dir),
    }
