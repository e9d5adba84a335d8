"""Session helpers: building a session, the shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library relies on.  AQE re-plans joins and
# shuffles at run time (broadcast when a side is measured small, skew splits,
# partition coalescing); UTC keeps timestamp arithmetic zone-free.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "govlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.ui.enabled", "false")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/govlens-checkpoints") -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The folder named by the cluster is always used when set; ``fallback`` is
    only for a ``local`` master (tests, one machine).  On a cluster every
    executor would write to a folder of its own machine, so a missing setting
    raises there.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not conf_dir and not _single_machine(master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
    d = conf_dir or fallback
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def _single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/govlens/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, how: str = "checkpoint", name: str = "table") -> DataFrame:
    """Materialise ``df`` so later jobs do not recompute (or re-sample) it.

    ``table``      writes parquet under the shared checkpoint folder and reads
                   it back: later plans get a columnar scan with column
                   pruning and filter pushdown (the choice for wide frames
                   many queries read a few columns of);
    ``checkpoint`` reliable RDD checkpoint in the same folder (row-wise);
    ``persist``    executor memory/disk (recomputed from lineage if lost).
    All but ``persist`` survive lost executors.
    """
    if how == "persist":
        return df.persist()
    if how == "table":
        path = shared_path(df.sparkSession, name)
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
