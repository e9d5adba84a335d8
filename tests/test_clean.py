"""Cleaning: imputation, NaN model, dates, duplicates (hand-made frames)."""

import datetime as dt
import math

import pandas as pd
from pyspark.sql import functions as F

from govlens.functions.dates import parse_dates
from govlens.operators import clean as C


def test_gaps_median_mode_unknown(spark):
    # 'gaps': even-count median, mode tie -> smallest, all-missing text -> 'Unknown',
    # all-missing number stays missing
    rows = [(1.0, "b", None, None), (None, "a", None, None), (3.0, "b", None, None), (4.0, "a", None, None),
            (None, None, None, None), (10.0, "c", None, None), (2.0, None, None, None), (7.0, None, None, None)]
    df = spark.createDataFrame(rows, "x double, s string, t string, y double")
    out = C.impute(df).toPandas()
    med = pd.Series([1.0, 3.0, 4.0, 10.0, 2.0, 7.0]).median()
    assert out["x"].tolist() == [1.0, med, 3.0, 4.0, med, 10.0, 2.0, 7.0]
    assert out["s"].tolist() == ["b", "a", "b", "a", "a", "c", "a", "a"]
    assert set(out["t"]) == {"Unknown"}
    assert out["y"].isna().all()


def test_nan_inf_are_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (0.9,), (float("inf"),), (0.1,), (float("-inf"),), (0.8,)], "r double")
    from govlens.functions.nulls import nan_to_null
    n = nan_to_null(df)
    assert n.where(F.col("r") > 0.7).count() == 3          # inf still counts before the feature step
    assert nan_to_null(df, also_inf=True).where(F.col("r") > 0.7).count() == 2
    filled = C.clean_numeric(df, ["r"]).toPandas()["r"].tolist()
    assert filled == [0.8, 0.9, 0.8, 0.1, 0.8, 0.8]


def test_bad_dates(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("not a date",), ("2019-12-31 12:00:00",),
                                ("2024-01-07 23:59:59",), (None,)], "d string")
    out = parse_dates(df, ["d"]).toPandas()
    assert out["d"].isna().tolist() == [False, True, False, False, True]
    assert out["d_day_of_week"].tolist()[0] == 0            # a Monday
    assert out["d_days_since"].tolist()[2] == -1            # before the anchor, floored
    assert out["d_hour"].tolist()[3] == 23
    ref = (pd.Timestamp("2019-12-31 12:00") - pd.Timestamp("2020-01-01")).days
    assert ref == -1


def test_drop_duplicates_and_dedupe_by_key(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", 1.0), (2, "b", 1.0), (2, "c", 2.0)],
                               "k int, v string, x double")
    assert C.drop_duplicates(df).count() == 3
    d = C.dedupe_by_key(df, ["k"], ["v"]).orderBy("k").toPandas()
    assert d["v"].tolist() == ["a", "b"]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a int, b string")
    out = {r["column_name"]: r["n_missing"] for r in C.null_counts(df).collect()}
    assert out == {"a": 2, "b": 2}


def test_mode_of_timestamps_smallest_on_tie(spark):
    t1, t2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t1,), (t2,), (None,)], "t timestamp_ntz")
    out = C.impute(df).toPandas()["t"].tolist()
    assert out[2] == pd.Timestamp(t2)


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert C.impute(df).count() == 0
    assert C.null_counts(df).count() == 2
    assert math.isnan(float("nan"))


def test_distributed_quantiles_match_pandas(spark):
    import numpy as np
    from govlens.functions.nulls import nan_to_null
    from govlens.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=801), "b": rng.integers(0, 9, 801).astype(float)})
    pdf.loc[::5, "a"] = np.nan
    df = nan_to_null(spark.createDataFrame(pdf))
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["a", "b"], qs)
    for c in "ab":
        assert np.allclose(got[c], pdf[c].quantile(qs).tolist(), rtol=0, atol=1e-12)


def test_rows_are_compared_without_date_parts(spark):
    """Two spellings of one time are one row, and what is exchanged holds no part of a date."""
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-01 00:00:00"), (2, None), (2, "no date"), (3, "2024-02-29 23:00:00")], "id long, d string")
    out = C.clean_table(df.withColumn("d_year", F.lit(7)), ["d"])
    plain = C.drop_duplicates(parse_dates(C.impute(df), ["d"]))
    assert out.columns == plain.columns == ["id", "d", "d_year", "d_month", "d_day_of_week", "d_hour", "d_days_since"]
    assert sorted(out.collect(), key=str) == sorted(plain.collect(), key=str)
    plan = C.clean_table(df, ["d"])._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all("d_year" not in line for line in moved)
