"""The end-to-end pipeline: full / train / insights modes.

full     = load -> clean -> merge -> encode -> features -> train -> insights
train    = load ... features -> train (models + importances saved)
insights = load ... features -> insights, using models saved by an earlier run
           (no saved models -> the model-based insights are simply absent)
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from govlens.models import registry as REG, train as TR
from govlens.operators import anomaly as A, metrics as M, patterns as P, risk as R, scoring as S, summary as SU, usage as U
from govlens.operators.features import FeatureFrame, process_pipeline, with_label
from govlens.session import shared_path
from govlens.sources.catalog import load_all_tables
from govlens.sources.sinks import write_insights_json
from govlens.spec import PipelineSpec

log = logging.getLogger(__name__)


@dataclass
class PipelineResult:
    ff: FeatureFrame
    models: dict[str, TR.TrainResult] = field(default_factory=dict)
    insights: dict[str, DataFrame] = field(default_factory=dict)
    written: dict[str, str] = field(default_factory=dict)


def train_stage(ff: FeatureFrame, spec: PipelineSpec, models_dir: str, n_trees: int | None = None,
                cv: int = 5, clustering: bool | None = None) -> dict[str, TR.TrainResult]:
    """Classification or regression by the detected task of the label (each
    when enabled); clustering when there is no label or when asked; each
    model saved under ``models_dir``."""
    out: dict[str, TR.TrainResult] = {}
    m = spec.models
    task = "clustering"
    if ff.has_label:
        target_is_string = spec.features.target_column in ff.encoding.sizes  # encoded from text classes
        task = TR.detect_task(ff.features, target_is_string).first()["task"]
    if task == "classification" and m.classification_enabled:
        res, _ = TR.train_classifiers(ff.features, ff.feature_columns, ff.key_columns, m.classification_algorithms,
                                      m.seed, m.test_fraction, cv, n_trees, m.settings)
        out.update({f"{r.name}_classifier": r for r in res})
    elif task == "regression" and m.regression_enabled:
        res = TR.train_regressors(ff.features, ff.feature_columns, ff.key_columns, m.regression_algorithms,
                                  m.seed, m.test_fraction, n_trees, m.settings)
        out.update({f"{r.name}_regressor": r for r in res})
    if (clustering if clustering is not None else not ff.has_label) and m.clustering_enabled:
        out["kmeans_clustering"] = TR.train_clustering(ff.features, ff.feature_columns, ff.key_columns, m.seed)
    for name, r in out.items():
        TR.save_model(r.model, f"{models_dir.rstrip('/')}/{name}")
        if r.importances is not None:
            r.importances.write.mode("overwrite").parquet(f"{models_dir.rstrip('/')}/{name}{IMPORTANCE}")
        if "assignments" in r.extra:
            r.extra["assignments"].write.mode("overwrite").parquet(f"{models_dir.rstrip('/')}/{name}{ASSIGNMENTS}")
    return out


IMPORTANCE, ASSIGNMENTS = "_importance", "_assignments"


def saved_models(spark: SparkSession, models_dir: str) -> dict[str, TR.TrainResult]:
    """Everything that an earlier run saved under ``models_dir``: every model,
    whatever its name, with its importances and cluster assignments."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(models_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    out: dict[str, TR.TrainResult] = {}
    base = models_dir.rstrip("/")
    for name in names:
        kind = next((k for k in ("classifier", "regressor", "clustering") if name.endswith(f"_{k}")), None)
        model = TR.load_model(f"{base}/{name}") if kind else None
        if model is None:
            continue
        r = TR.TrainResult(name.removesuffix(f"_{kind}"), kind, model, {})
        if name + IMPORTANCE in names:
            r.importances = spark.read.parquet(f"{base}/{name}{IMPORTANCE}")
        if name + ASSIGNMENTS in names:
            r.extra["assignments"] = spark.read.parquet(f"{base}/{name}{ASSIGNMENTS}")
        out[name] = r
    return out


def best_trained(spark: SparkSession, models: dict[str, TR.TrainResult]) -> DataFrame | None:
    """The best classifier (else regressor, else clustering) by its metric; None when nothing was trained in this run."""
    for kind, metric in (("classifier", "accuracy"), ("regressor", "r2_score"), ("clustering", "silhouette")):
        rows = [(r.name, i, float(r.metrics[metric])) for i, r in enumerate(models.values())
                if r.kind == kind and r.metrics.get(metric) is not None]
        if rows:
            return M.best_model(spark.createDataFrame(rows, f"model string, model_order int, {metric} double"))
    return None


def insights_stage(ff: FeatureFrame, spec: PipelineSpec, as_of: str, models: dict[str, TR.TrainResult],
                   department: str = "IT") -> dict[str, DataFrame]:
    ins = spec.insights
    fs = spec.features
    merged = ff.merged
    out: dict[str, DataFrame] = {}
    if ins.identify_access_reduction:
        out["low_usage_items"] = U.low_usage_items(merged, ins.low_usage_threshold)
        out["unused_items"] = U.unused_items(merged, as_of, ins.unused_days)
        out["access_reduction_total"] = U.access_reduction_total(out["low_usage_items"], out["unused_items"])
    if "risk_score" in merged.columns:
        out["risk_overall"] = R.risk_overall(merged, ins.risk_threshold)
        out["risk_by_role"] = R.risk_by_group(merged, "role")
        out["risk_by_department"] = R.risk_by_group(merged, "department")
        out["high_risk_users"] = R.high_risk_users(merged, ins.risk_threshold)
    if ins.detect_anomalies:
        flagged = A.outlier_flag(ff.features, A.iqr_bounds(ff.features, ff.feature_columns,
                                                           filled=ff.filled))
        out["anomalies"] = A.iqr_outliers(flagged)
        if ff.key_columns and "user_id" in merged.columns:
            out["sample_anomalies"] = A.outlier_users(flagged, merged, ff.key_columns[0])
    saved = [n for n in models if n.endswith("_classifier")]
    best = REG.pick_saved_classifier(saved)
    if best and ff.has_label:
        scored = TR.score_all(models[best].model, ff.features, ff.key_columns)
        out["prediction_distribution"] = S.prediction_distribution(scored)
        out["prediction_confidence"] = S.prediction_confidence(scored)
    assign = models["kmeans_clustering"].extra.get("assignments") if "kmeans_clustering" in models else None
    if assign is not None:                                  # a model saved without its assignments has no clusters to tell of
        out["cluster_distribution"] = S.cluster_distribution(assign)
        out["cluster_profiles"] = S.cluster_profiles(ff.features, assign, ff.feature_columns, ff.key_columns)
    imps = [r.importances for r in models.values() if r.importances is not None]
    if imps and ins.generate_feature_importance:
        from functools import reduce
        imps = reduce(lambda a, b: a.unionByName(b), imps)
        out["feature_importance"] = S.top_features(imps)
    best_of_run = best_trained(merged.sparkSession, models)
    if best_of_run is not None:
        out["best_model"] = best_of_run
    if all(k in out for k in ("access_reduction_total", "risk_overall", "anomalies")):
        out["report_metrics"] = SU.report_metrics(out["access_reduction_total"], out["risk_overall"], out["anomalies"],
                                                  imps if isinstance(imps, DataFrame) else None)
    if ff.has_label:
        labeled = with_label(merged, ff.encoding, fs.target_column)
        codes = P.outcome_codes(ff.encoding, fs.target_column) if fs.target_column in ff.encoding.sizes else {}
        rules = P.RuleParams(**codes)
        grid = P.written_grid(labeled, fs.time_column, rules)
        out["decision_patterns"] = P.decision_patterns(labeled, fs.time_column, p=rules, grid=grid)
        out["approval_patterns"] = P.approval_patterns(labeled, fs.time_column, department, p=rules, grid=grid)
    if "low_usage_items" in out and "high_risk_users" in out:
        out["insight_summary"] = SU.insight_summary(out["low_usage_items"], out["high_risk_users"])
    return out


def run_pipeline(spark: SparkSession, spec: PipelineSpec, data_dir: str, as_of: str, mode: str = "full",
                 models_dir: str | None = None, output_dir: str | None = None,
                 tables: dict[str, DataFrame] | None = None, n_trees: int | None = None) -> PipelineResult:
    if mode not in ("full", "train", "insights"):
        raise ValueError(f"unknown mode {mode!r}")
    tables = tables if tables is not None else load_all_tables(spark, data_dir, spec.tables)
    features = spec.features
    if not features.key_columns:
        # rows are told apart by the base table's primary key
        base = spec.tables.get(spec.merge.base_table) if spec.merge else None
        key = base.primary_key if base else None
        features = replace(features, key_columns=[key] if isinstance(key, str) else list(key or []))
    ff = process_pipeline(tables, spec.merge, features, materialize="table")
    models_dir = models_dir or shared_path(spark, "models")
    res = PipelineResult(ff)
    if mode in ("full", "train"):
        res.models = train_stage(ff, spec, models_dir, n_trees)
    else:
        res.models = saved_models(spark, models_dir)
    if mode in ("full", "insights"):
        res.insights = insights_stage(ff, spec, as_of, res.models)
        res.written = write_insights_json(spark, res.insights, output_dir)
    return res
