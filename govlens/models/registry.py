"""Estimator registry: configured names -> estimator factories (MLlib's, and ``trees`` with MLlib's parameters).

Order is the configured order; unknown or unavailable names are skipped
with a warning, never raised.
"""

from __future__ import annotations

import importlib
import logging
from collections.abc import Callable

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression

from govlens.models.multiclass import BoostedClasses
from govlens.models.trees import BoostedClassifier, ForestClassifier, ForestRegressor

log = logging.getLogger(__name__)

# Estimator settings matching the reference's choices
# (100 trees / rounds, seed 42, 1000 iterations, plain least squares).
N_TREES = 100
SEED = 42
LOGREG_MAX_ITER = 1000
GBT_DEPTH = 3
GBT_STEP = 0.1
# Defaults of ``ModelSpec.rf_max_depth`` (trees are grown level by level, so their depth is bounded) and
# ``ModelSpec.rf_max_memory_mb``. ``trees`` takes the latter and the next as the other parameters of MLlib's forests that
# make passes smaller or larger and leave the trees the same, and doesn't need them.
RF_MAX_DEPTH = 15
RF_MAX_MEMORY_MB = 256
RF_CACHE_NODES = True

Factory = Callable[[dict], Estimator]


def _rf(ctx: dict) -> Estimator:
    return ForestClassifier(numTrees=ctx.get("n_trees", N_TREES), seed=SEED,
                            maxDepth=ctx.get("max_depth", RF_MAX_DEPTH),
                            maxMemoryInMB=ctx.get("max_memory_mb", RF_MAX_MEMORY_MB), cacheNodeIds=RF_CACHE_NODES,
                            featuresCol="features", labelCol="label")


def _gbt(ctx: dict) -> Estimator:
    g = BoostedClassifier(maxIter=ctx.get("n_trees", N_TREES), maxDepth=GBT_DEPTH, stepSize=GBT_STEP, seed=SEED,
                          featuresCol="features", labelCol="label")
    return g if ctx.get("n_classes", 2) <= 2 else BoostedClasses(classifier=g)


def _logreg(ctx: dict) -> Estimator:
    # scikit-learn: C * sum(loss) + 0.5 |w|^2 with C = 1; MLlib: mean(loss) + reg * 0.5 |w|^2
    n = max(int(ctx.get("n_train", 1)), 1)
    return LogisticRegression(maxIter=LOGREG_MAX_ITER, regParam=1.0 / n, elasticNetParam=0.0,
                              standardization=False, featuresCol="features", labelCol="label")


def _optional(module: str, cls: str, **kw) -> Factory | None:
    try:
        mod = importlib.import_module(module)
    except Exception:  # noqa: BLE001 - optional package absent
        return None
    est = getattr(mod, cls, None)
    if est is None:
        return None
    return lambda ctx: est(**kw)


CLASSIFIERS: dict[str, Factory | None] = {
    "random_forest": _rf,
    "gradient_boosting": _gbt,
    "logistic_regression": _logreg,
    "xgboost": _optional("xgboost.spark", "SparkXGBClassifier", n_estimators=N_TREES, random_state=SEED,
                         features_col="features", label_col="label"),
    "lightgbm": _optional("synapse.ml.lightgbm", "LightGBMClassifier", numIterations=N_TREES, seed=SEED,
                          featuresCol="features", labelCol="label"),
}

REGRESSORS: dict[str, Factory | None] = {
    "linear_regression": lambda ctx: LinearRegression(regParam=0.0, featuresCol="features", labelCol="label"),
    "random_forest": lambda ctx: ForestRegressor(numTrees=ctx.get("n_trees", N_TREES), seed=SEED,
                                                 maxDepth=ctx.get("max_depth", RF_MAX_DEPTH),
                                                 maxMemoryInMB=ctx.get("max_memory_mb", RF_MAX_MEMORY_MB),
                                                 cacheNodeIds=RF_CACHE_NODES,
                                                 featuresCol="features", labelCol="label"),
}


# Preference when a single saved classifier is needed (by name, not by metric).
SAVED_CLASSIFIER_PRIORITY = ["random_forest", "gradient_boosting", "logistic_regression"]


def resolve(names: list[str], table: dict[str, Factory | None]) -> list[tuple[str, Factory | None, str]]:
    """(name, factory or None, status) in configured order."""
    out = []
    for n in names:
        if n not in table:
            log.warning("algorithm %s is not implemented; skipped", n)
            out.append((n, None, "unknown"))
        elif table[n] is None:
            log.warning("algorithm %s requested but its package is not installed; skipped", n)
            out.append((n, None, "unavailable"))
        else:
            out.append((n, table[n], "available"))
    return out


def pick_saved_classifier(saved: list[str]) -> str | None:
    """random_forest, then gradient_boosting, then logistic_regression, else
    the first saved one; None when nothing is saved."""
    for p in SAVED_CLASSIFIER_PRIORITY:
        for s in saved:
            if p in s:
                return s
    return saved[0] if saved else None
