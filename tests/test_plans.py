"""Plan guards: no cartesian / nested-loop joins in any oracle-checked query,
and pushdown + pruning on the shared tables."""

import contextlib
import io

import __spark_entry__ as E
from govlens.plans.registry import REGISTRY

FITS = {"rf_classifier", "gbt_classifier", "logistic_regression", "cross_validate", "score_all", "top_features", "sink_importance",
        "importance_chart", "report_metrics", "linear_regression", "rf_regressor", "kmeans", "sink_clusters", "sink_model", "best_trained_model"}
SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cartesian_or_nested_loop_joins(spark):
    bad = []
    for name, (run, sql) in REGISTRY.items():
        if sql is None or name in FITS:                    # fitting is eager; what it returns is a few facts
            continue
        p = _plan(run(spark, SF))
        if "CartesianProduct" in p or "NestedLoopJoin" in p:
            bad.append(name)
    assert bad == []


def test_pushdown_and_pruning_on_shared_tables(spark):
    p = _plan(E.queries()["low_usage_items"](spark, SF))
    assert "LessThan(frequency,5)" in p
    assert "ReadSchema: struct<user_id:bigint,access_item:string,frequency:bigint>" in p
    assert "TakeOrderedAndProject" in p
