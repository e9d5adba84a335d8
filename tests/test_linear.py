"""The facts of the linear regression query."""

from types import SimpleNamespace as NS

from pyspark.sql import functions as F


def test_a_column_that_is_constant_on_the_training_part(spark):
    """Its correlation was a division by zero, as its spread over all rows (or by rounding) isn't zero."""
    from govlens.models.split import random_split
    from govlens.plans import q_models as Q
    df = spark.createDataFrame([(i, float(i % 7) / 7 + (i % 3) * 0.01, float(i % 7), float(i % 5)) for i in range(100)], "request_id long, risk_score double, a double, b double")
    some = random_split(df, Q.KEYS).where("is_test").agg(F.min("request_id")).first()[0]
    df = df.withColumn("rare", (F.col("request_id") == some).cast("double")).withColumn("same", F.lit(0.1)).cache()
    ctx = NS(spark=spark, extra={}, features=df, ff=NS(feature_columns=["risk_score", "a", "b", "rare", "same"]), spec=NS(models=NS(settings={})))
    got = Q.q_linear_regression(ctx).first()
    assert got.n_test == 20 and got.meets_normal_equations and got.mse >= 0
    # a fit that leaves something over that a column explains is still told
    model = ctx.extra["linear"].model
    ctx.extra["linear"].model = NS(transform=lambda d: model.transform(d).withColumn("prediction", F.col("prediction") + 0.01 * F.col("a") - 0.03))
    assert not Q.q_linear_regression(ctx).first().meets_normal_equations
