"""From cleaned tables to the model-ready feature frame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from govlens.functions.nulls import is_numeric
from govlens.operators import clean as C
from govlens.operators.encode import LabelEncoding, ScalerFit, label_encode_apply, label_encode_fit, \
    standard_scale_apply, standard_scale_fit
from govlens.operators.merge import merge_tables
from govlens.session import cut_lineage
from govlens.spec import FeatureSpec, MergeSpec


@dataclass
class FeatureFrame:
    """Everything the insight and model stages read.

    ``merged`` is the cleaned, merged, unencoded frame (the reference's
    "original data"); ``features`` holds the key columns, ``label`` (when a
    target exists) and the numeric feature columns, row-aligned by key.
    """
    merged: DataFrame
    encoded: DataFrame
    features: DataFrame
    feature_columns: list[str]
    key_columns: list[str]
    has_label: bool
    encoding: LabelEncoding
    scaler: ScalerFit | None = None
    cleaned: dict[str, DataFrame] = field(default_factory=dict)
    filled: C.Filled | None = None      # answers quantiles of ``features`` from the build that filled them; None if scaled


def feature_columns(encoded: DataFrame, spec: FeatureSpec) -> list[str]:
    """Every numeric column that is not the target, not excluded (booleans are
    not numeric; encoded categories are)."""
    drop = set(spec.exclude_columns) | ({spec.target_column} if spec.target_column else set())
    return [f.name for f in encoded.schema.fields if f.name not in drop and is_numeric(f.dataType)]


def prepare_features(encoded: DataFrame, spec: FeatureSpec, exact: bool = True
                     ) -> tuple[DataFrame, list[str], bool, C.Filled | None]:
    """(keys..., label?, features...) with +-Inf -> missing and median fill; what filled it, if exactly."""
    cols = feature_columns(encoded, spec)
    keys = [k for k in spec.key_columns if k in encoded.columns]
    has_label = bool(spec.target_column) and spec.target_column in encoded.columns
    lab = [F.col(f"`{spec.target_column}`").alias("label")] if has_label else []
    # keys may also be feature columns; they are carried once under a prefix
    framed = encoded.select(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys], *lab,
                            *[F.col(f"`{c}`") for c in cols])
    filled, how = C.fill_numeric(framed, cols) if exact else (C.clean_numeric(framed, cols, False), None)
    out = filled.select(*[F.col(f"__key_{k}").alias(k) for k in keys if k not in cols],
                        *[F.col(f"__key_{k}").alias(f"__key_{k}") for k in keys if k in cols],
                        *(["label"] if has_label else []), *cols)
    return out, cols, has_label, how


def clean_all(tables: dict[str, DataFrame], spec: FeatureSpec, exact: bool = True) -> dict[str, DataFrame]:
    """``clean_table`` for every table; the gap statistics of all tables are
    found together (one job when no table has gaps)."""
    fits = C.fit_impute_all(tables, exact)
    return {name: C.distinct_with_dates(C.apply_impute(df, fits[name]), spec.date_columns) for name, df in tables.items()}


def process_pipeline(tables: dict[str, DataFrame], merge: MergeSpec | None, spec: FeatureSpec,
                     scale: bool = False, materialize: str = "persist", exact: bool = True) -> FeatureFrame:
    """clean every table -> merge -> label-encode -> numeric features -> optional scaling.

    The merged and feature frames are materialised once because every insight
    and model reads them again; ``materialize="table"`` writes them as parquet
    in the shared folder so later scans prune columns and push filters.
    """
    cleaned = clean_all(tables, spec, exact)
    merged = merge_tables(cleaned, merge)
    if materialize != "none":
        merged = cut_lineage(merged, materialize, "merged")
    enc = label_encode_fit(merged, spec.categorical_columns,
                           "persist" if materialize in ("persist", "none") else "checkpoint")
    encoded = label_encode_apply(merged, enc)
    feats, cols, has_label, filled = prepare_features(encoded, spec, exact)
    scaler = None
    if scale:
        scaler = standard_scale_fit(feats, cols)
        feats = standard_scale_apply(feats, scaler)
    if materialize != "none":
        feats = cut_lineage(feats, materialize, "features")
    return FeatureFrame(merged, encoded, feats, cols, [k for k in spec.key_columns if k in merged.columns],
                        has_label, enc, scaler, cleaned, None if scale else filled)


def with_label(merged: DataFrame, enc: LabelEncoding, target: str | None) -> DataFrame:
    """The merged (unencoded) frame plus ``label``, the encoded target (the
    raw target when it is not a categorical column).

    Only the target's class list meets the frame (inlined or broadcast by
    its checked size), so the merged frame is not shuffled.
    """
    if not target or target not in merged.columns:
        return merged
    if target not in enc.sizes:
        return merged.withColumn("label", F.col(f"`{target}`"))
    m = enc.mapping.where(F.col("column_name") == target).withColumn("column_name", F.lit("label"))
    classes = {"label": enc.classes[target]} if enc.classes and target in enc.classes else None
    return label_encode_apply(merged.withColumn("label", F.col(f"`{target}`")),
                              LabelEncoding(m, {"label": enc.sizes[target]}, classes))
