"""k-means from many starts and for many k, with one scan of the data a step.

Every run (a number of clusters and a seed) gets its first centres from
MLlib's k-means||, and all runs take their steps together: a scan assigns each
row to its nearest centre in every run, partitions hand over partial sums per
centre, and one small aggregate moves all centres.  So what the data are read
for depends on the steps, not on the runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

#: MLlib's own defaults.
MAX_ITER, TOL = 20, 1e-4
#: About so many rows, drawn evenly, are what k-means|| chooses first centres from; every step reads all rows.
INIT_ROWS = 10_000
#: Rows whose distances to all centres are held at a time.
_BLOCK = 2048


@dataclass
class Run:
    k: int
    seed: int
    centres: np.ndarray
    cost: float = float("nan")
    steps: int = 0


def first_centres(data: DataFrame, cols: list[str], ks: list[int], seeds: list[int], rows: int, n: int | None,
                  init_rows: int, parallelism: int) -> list[Run]:
    """MLlib's k-means|| (without a step after it) for every number of clusters and seed."""
    n = data.count() if n is None else n
    share = min(1.0, init_rows / max(n, 1))
    some = data if share == 1.0 else data.sample(share, seeds[0])
    held = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(some) \
        .select("features").coalesce(max(1, -(-min(n, init_rows) // rows))).persist()
    held.count()

    def one(job: tuple[int, int]) -> Run:
        k, seed = job
        model = KMeans(k=k, seed=seed, maxIter=0, initMode="k-means||", featuresCol="features").fit(held)
        return Run(k, seed, np.array(model.clusterCenters(), dtype=np.float64))

    with ThreadPoolExecutor(parallelism) as pool:
        runs = list(pool.map(one, [(k, s) for k in ks for s in seeds]))
    held.unpersist()
    return runs


def partial_sums(data: DataFrame, cols: list[str], runs: list[Run]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per centre of all runs, in order: rows, squared distances and sums of the rows nearest to it.  One scan."""
    centres = np.concatenate([r.centres for r in runs])
    ends = np.cumsum([len(r.centres) for r in runs]).tolist()
    spans = list(zip([0, *ends], ends))
    shift = centres.mean(axis=0)                       # distances are taken near the origin, where little cancels out
    near = centres - shift
    norms = (near ** 2).sum(axis=1)
    width, pull = len(cols), -2 * near

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, cost, sums = np.zeros(len(near)), np.zeros(len(near)), np.zeros((len(near), width))
        for batch in batches:
            whole = batch.to_numpy(dtype=np.float64)
            for x in (whole[i:i + _BLOCK] for i in range(0, len(whole), _BLOCK)):
                y = x - shift
                far = pull @ y.T                       # less the row's own square, which is the same for all centres
                far += norms[:, None]
                own = np.empty((len(spans), len(x)), dtype=np.intp)
                least = np.empty(own.shape)
                for i, (a, b) in enumerate(spans):
                    at, best = np.full(len(x), a), far[a].copy()
                    for c in range(a + 1, b):          # of equal distances the first
                        at[far[c] < best] = c
                        np.minimum(best, far[c], out=best)
                    own[i], least[i] = at, best
                one = np.zeros(far.shape)
                one[own, np.arange(len(x))] = 1
                rows += np.bincount(own.ravel(), minlength=len(near))
                cost += np.bincount(own.ravel(), np.maximum(least + (y ** 2).sum(axis=1), 0).ravel(), len(near))
                sums += one @ x
        used = np.flatnonzero(rows)
        yield pd.DataFrame(np.column_stack([used, rows[used], cost[used], sums[used]]), columns=names)

    names = ["centre", "n", "cost", *[f"s{i}" for i in range(width)]]
    part = data.select(*[F.col(f"`{c}`").cast("double") for c in cols]).mapInPandas(scan, ", ".join(f"{c} double" for c in names))
    total = part.groupBy("centre").agg(*[F.sum(c).alias(c) for c in names[1:]]).toPandas()      # a row per centre
    out = np.zeros((len(near), len(names) - 1))
    out[total["centre"].to_numpy(dtype=np.int64)] = total[names[1:]].to_numpy()
    return out[:, 0], out[:, 1], out[:, 2:]


def many_kmeans(data: DataFrame, cols: list[str], ks: list[int], n_init: int = 10, seed: int = 42, max_iter: int = MAX_ITER,
                tol: float = TOL, n_rows: int | None = None, init_rows: int = INIT_ROWS, parallelism: int = 8) -> tuple[list[Run], int]:
    """``(runs, scans)``: a finished run for each of ``ks`` and ``n_init`` seeds from ``seed`` on, and the scans they took.

    A run ends when no centre moved by more than ``tol``, or after ``max_iter``
    steps; a centre without rows stays where it is.  ``cost`` is the sum of
    squared distances to the final centres.  ``data`` is read once a step, once
    more for the costs, and once for the first centres; persist or write it.
    """
    runs = first_centres(data, cols, ks, list(range(seed, seed + n_init)), 20_000, n_rows, init_rows, parallelism)
    active, scans = list(runs), 0
    while active and scans < max_iter:
        n, _, sums = partial_sums(data, cols, active)
        scans += 1
        at, moving = 0, []
        for r in active:
            own = slice(at, at + len(r.centres))
            at += len(r.centres)
            moved = np.where(n[own, None] > 0, sums[own] / np.maximum(n[own, None], 1), r.centres)
            step = ((moved - r.centres) ** 2).sum(axis=1).max()
            r.centres, r.steps = moved, r.steps + 1
            if step > tol ** 2:
                moving.append(r)
        active = moving
    _, cost, _ = partial_sums(data, cols, runs)
    ends = np.cumsum([len(r.centres) for r in runs])
    for r, end in zip(runs, ends):
        r.cost = float(cost[end - len(r.centres):end].sum())
    return runs, scans + 1


def best(runs: list[Run], k: int) -> Run:
    """The run of least cost, the earliest seed on ties."""
    return min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.seed))


def as_model(spark: SparkSession, cols: list[str], centres: np.ndarray, prediction: str = "cluster") -> PipelineModel:
    """A saveable MLlib model (vectors and nearest centre) with these centres."""
    from pyspark.mllib.common import _py2java
    from pyspark.mllib.linalg import DenseVector as OldVector

    sc = spark.sparkContext
    # MLlib makes a KMeansModel from given centres in its JVM classes only
    clusterings = sc._jvm.org.apache.spark.mllib.clustering.KMeansModel(_py2java(sc, [OldVector(c) for c in centres]))
    java = sc._jvm.org.apache.spark.ml.clustering.KMeansModel(f"KMeans_{uuid.uuid4().hex[:12]}", clusterings)
    model = KMeansModel(java)
    model._resetUid(java.uid())
    model.set(model.featuresCol, "features")
    model.set(model.predictionCol, prediction)
    model.set(model.k, len(centres))
    return PipelineModel(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"), model])
