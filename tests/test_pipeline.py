"""End-to-end modes on the smallest bound tables."""

import tempfile

from govlens.plans.pipeline import run_pipeline
from govlens.sources.bindings import load_bound_tables
from govlens.spec import binding_spec

SF = "/root/testdata/sf0.001"


def test_full_then_insights_mode(spark):
    spec = binding_spec()
    spec.models.classification_algorithms = ["logistic_regression", "xgboost"]
    tables = load_bound_tables(spark, SF)
    models = tempfile.mkdtemp()
    full = run_pipeline(spark, spec, SF, "2001-12-01 12:30:00", "full", models_dir=models, tables=tables)
    assert "logistic_regression_classifier" in full.models
    assert full.ff.features.count() == full.ff.merged.count()
    assert len(full.ff.feature_columns) == 29
    for name in ("low_usage_items", "risk_overall", "decision_patterns", "anomalies", "prediction_confidence"):
        assert name in full.insights
    assert full.insights["risk_overall"].count() == 1
    again = run_pipeline(spark, spec, SF, "2001-12-01 12:30:00", "insights", models_dir=models, tables=tables)
    assert "logistic_regression_classifier" in again.models and "prediction_distribution" in again.insights
    empty = run_pipeline(spark, spec, SF, "2001-12-01 12:30:00", "insights", models_dir=tempfile.mkdtemp(),
                         tables=tables)
    assert empty.models == {} and "prediction_distribution" not in empty.insights
