"""Declarative specifications (the reference keeps these in a YAML file).

All specs are plain dataclasses built from dicts with ``from_dict`` so a
YAML/JSON document with the reference's layout can be passed straight in.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass
class TableSpec:
    name: str
    columns: list[str] | None = None      # projection; None = every column
    primary_key: str | list[str] | None = None
    join_keys: list[str] | None = None
    path: str | None = None               # file source; default "{name}.{format}"
    format: str = "parquet"               # parquet, csv or jdbc; a table of a spec file that names none is csv
    options: dict | None = None           # jdbc: url, user, driver, partition column and bounds ...


@dataclass
class JoinStep:
    table: str
    on: list[str]
    how: str = "left"


@dataclass
class MergeSpec:
    base_table: str
    joins: list[JoinStep] = field(default_factory=list)

    @staticmethod
    def from_dict(d: dict | None) -> "MergeSpec | None":
        if not d:
            return None
        steps = []
        for j in d.get("joins", []) or []:
            # invalid entries are kept as None and skipped by merge_tables,
            # like the reference's "skip with a warning"
            if isinstance(j, dict) and "on" not in j and True in j:
                j = {**j, "on": j[True]}          # YAML 1.1 reads an unquoted `on:` key as true
            if not isinstance(j, dict) or not j.get("table") or not j.get("on"):
                steps.append(None)
                continue
            on = j["on"] if isinstance(j["on"], list) else [j["on"]]
            steps.append(JoinStep(j["table"], list(on), j.get("how", "left")))
        return MergeSpec(d.get("base_table"), steps)


@dataclass
class FeatureSpec:
    target_column: str | None = "decision"
    exclude_columns: list[str] = field(default_factory=lambda: ["request_id", "timestamp", "approver_id"])
    date_columns: list[str] = field(default_factory=lambda: ["timestamp", "last_used_date", "last_certified_date"])
    categorical_columns: list[str] = field(default_factory=lambda: [
        "access_item", "requester_role", "access_type", "role", "department", "location",
        "decision", "employment_type", "certification_outcome", "sod_conflict",
        "is_privileged_access"])
    numerical_columns: list[str] = field(default_factory=lambda: ["frequency", "risk_score", "seniority_level"])
    key_columns: list[str] = field(default_factory=lambda: ["request_id"])
    # name of the request time column (hour rules of the pattern miners)
    time_column: str = "timestamp"

    @staticmethod
    def from_dict(d: dict) -> "FeatureSpec":
        f = FeatureSpec()
        for k in ("target_column", "exclude_columns", "date_columns", "categorical_columns",
                  "numerical_columns", "key_columns", "time_column"):
            if k in d:
                setattr(f, k, d[k])
        return f


@dataclass
class ModelSpec:
    classification_enabled: bool = True
    classification_algorithms: list[str] = field(default_factory=lambda: [
        "random_forest", "gradient_boosting", "lightgbm", "xgboost", "logistic_regression"])
    clustering_enabled: bool = True
    clustering_algorithms: list[str] = field(default_factory=lambda: ["kmeans"])
    regression_enabled: bool = False
    regression_algorithms: list[str] = field(default_factory=lambda: ["linear_regression", "random_forest"])
    seed: int = 42
    test_fraction: float = 0.2
    cv_folds: int = 5
    rf_max_depth: int = 15
    rf_max_memory_mb: int = 256

    @property
    def settings(self) -> dict:
        """What the estimator factories take from the spec."""
        return {"max_depth": self.rf_max_depth, "max_memory_mb": self.rf_max_memory_mb}

    @staticmethod
    def from_dict(d: dict | None) -> "ModelSpec":
        m = ModelSpec()
        d = d or {}
        for kind in ("classification", "clustering", "regression"):
            sub = d.get(kind) or {}
            if "enabled" in sub:
                setattr(m, f"{kind}_enabled", bool(sub["enabled"]))
            if sub.get("algorithms"):
                setattr(m, f"{kind}_algorithms", list(sub["algorithms"]))
        for k in ("seed", "test_fraction", "cv_folds", "rf_max_depth", "rf_max_memory_mb"):
            if k in d:
                setattr(m, k, d[k])
        return m


@dataclass
class InsightSpec:
    generate_feature_importance: bool = True
    identify_access_reduction: bool = True
    detect_anomalies: bool = True
    risk_threshold: float = 0.7
    low_usage_threshold: float = 5
    unused_days: int = 90

    @staticmethod
    def from_dict(d: dict | None) -> "InsightSpec":
        s = InsightSpec()
        for k, v in (d or {}).items():
            if hasattr(s, k):
                setattr(s, k, v)
        return s


@dataclass
class PipelineSpec:
    tables: dict[str, TableSpec]
    merge: MergeSpec | None
    features: FeatureSpec
    models: ModelSpec
    insights: InsightSpec

    @staticmethod
    def from_dict(d: dict[str, Any], default_format: str = "parquet") -> "PipelineSpec":
        tables = {}
        for name, t in (d.get("tables") or {}).items():
            t = t or {}
            tables[name] = TableSpec(name, t.get("columns"), t.get("primary_key"), t.get("join_keys"),
                                     t.get("path"), t.get("format", default_format), t.get("options"))
        ml = d.get("ml_config") or {}
        return PipelineSpec(tables, MergeSpec.from_dict(d.get("merge_strategy")),
                            FeatureSpec.from_dict(ml), ModelSpec.from_dict(ml.get("models")),
                            InsightSpec.from_dict(d.get("insights_config")))


def load_spec(path: str) -> PipelineSpec:
    """A spec file with the reference's layout (tables / merge_strategy /
    ml_config / insights_config): YAML when PyYAML is installed, else JSON."""
    with open(path) as fh:
        text = fh.read()
    try:
        import yaml
        data = yaml.safe_load(text)
    except ImportError:
        import json
        data = json.loads(text)
    return PipelineSpec.from_dict(data or {}, default_format="csv")


# The default configuration. Lists that the dataclasses above already hold are taken from them.
def default_spec_dict() -> dict:
    """The default configuration, as a dict."""
    return {
        "tables": {
            "decision_history": {"columns": ["request_id", "user_id", "access_item", "decision", "timestamp",
                                             "requester_role", "approver_id", "risk_score", "sod_conflict",
                                             "is_privileged_access"],
                                 "primary_key": "request_id", "join_keys": ["user_id", "access_item"]},
            "access_usage": {"columns": ["user_id", "access_item", "last_used_date", "frequency", "access_type"],
                             "join_keys": ["user_id", "access_item"]},
            "peer_group": {"columns": ["user_id", "peer_group_id", "role", "department", "seniority_level",
                                       "location", "employment_type"],
                           "primary_key": "user_id", "join_keys": ["user_id"]},
            "recertification_history": {"columns": ["user_id", "access_item", "last_certified_date",
                                                    "certification_outcome", "certified_by"],
                                        "join_keys": ["user_id", "access_item"]},
        },
        "merge_strategy": {
            "base_table": "decision_history",
            "joins": [
                {"table": "access_usage", "on": ["user_id", "access_item"], "how": "left"},
                {"table": "peer_group", "on": ["user_id"], "how": "left"},
                {"table": "recertification_history", "on": ["user_id", "access_item"], "how": "left"},
            ],
        },
        "ml_config": {
            "target_column": "decision",
            "exclude_columns": ["request_id", "timestamp", "approver_id"],
            "date_columns": ["timestamp", "last_used_date", "last_certified_date"],
            "categorical_columns": FeatureSpec().categorical_columns,
            "numerical_columns": ["frequency", "risk_score", "seniority_level"],
            "models": {
                "classification": {"enabled": True, "algorithms": ModelSpec().classification_algorithms},
                "clustering": {"enabled": True, "algorithms": ["kmeans"]},
                "regression": {"enabled": False, "algorithms": ["linear_regression", "random_forest"]},
            },
        },
        "insights_config": {"generate_feature_importance": True, "identify_access_reduction": True,
                            "detect_anomalies": True, "risk_threshold": 0.7, "low_usage_threshold": 5},
    }


def binding_spec() -> PipelineSpec:
    """The default spec with the test binding's request-time column name."""
    d = default_spec_dict()
    d["tables"]["decision_history"]["columns"][4] = "request_ts"
    ml = d["ml_config"]
    ml["exclude_columns"] = ["request_id", "request_ts", "approver_id"]
    ml["date_columns"] = ["request_ts", "last_used_date", "last_certified_date"]
    ml["time_column"] = "request_ts"
    ml["models"]["rf_max_memory_mb"] = 64       # the registered queries also run in a 1 GB heap; the trees are the same
    return PipelineSpec.from_dict(d)
