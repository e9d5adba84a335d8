"""Queries over metrics, splits and models.

Metric operators are checked exactly on rule-made predictions and clusters
(a prediction from the risk score, clusters from the encoded requester role
or item); the MLlib models themselves by facts that must hold of their outputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from govlens.models import train as TR
from govlens.models.split import cv_folds, random_split, stratified_split
from govlens.operators import metrics as M, scoring as S
from govlens.plans import oracle as O
from govlens.plans.queries import query
from govlens.session import cut_lineage, shared_path

W = O.w
FL = O.FEATURES_LIST
KEYS = ["request_id"]

SCORED = """
scored AS (select request_id, label, case when risk_score > 0.5 then 1.0 else 0.0 end as prediction,
  1 - risk_score as p0, risk_score as p1, greatest(1 - risk_score, risk_score) as conf from features)"""
CLUSTERED = "\ncl AS (select cast(requester_role as bigint) as cluster, * from features)"


def scored(ctx):
    if "scored" not in ctx.extra:
        ctx.extra["scored"] = S.rule_scores(ctx.features, keys=KEYS)
    return ctx.extra["scored"]


def clustered(ctx):
    return ctx.features.withColumn("cluster", F.col("requester_role").cast("bigint"))


# ---------------------------------------------------------------- classification metrics

@query("classification_metrics", O.r6(["accuracy", "precision", "recall", "f1_score"], W(*O.FEAT, SCORED) + """
select acc as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_score
from (select avg(case when label = prediction then 1.0 else 0.0 end)::double as acc,
        count_if(label = 1 and prediction = 1)::double as tp, count_if(label <> 1 and prediction = 1)::double as fp,
        count_if(label = 1 and prediction <> 1)::double as fn from scored) t"""))
def q_classification_metrics(ctx):
    return M.classification_metrics(scored(ctx), binary=True)


REPORT_SQL = W(*O.FEAT, SCORED) + """,
cls AS (select label::double as c from scored union select prediction from scored),
pc AS (select c, (select count(*) from scored where label = c) as support,
          (select count(*) from scored where prediction = c) as n_pred,
          (select count(*) from scored where label = c and prediction = c) as tp from cls),
m AS (select c, support, coalesce(tp::double / nullif(n_pred, 0), 0) as precision,
        coalesce(tp::double / nullif(support, 0), 0) as recall,
        coalesce(2.0 * tp / nullif(support + n_pred, 0), 0) as f1_score from pc)
select cast(cast(c as bigint) as varchar) as class_name, precision, recall, f1_score, support from m
union all select 'accuracy', null, null, (select avg(case when label = prediction then 1.0 else 0.0 end)::double from scored),
  (select count(*) from scored)
union all select 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) from m
union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), sum(support) from m"""


@query("classification_report", O.r6(["precision", "recall", "f1_score"],
                                     f"select class_name, precision, recall, f1_score, cast(support as bigint) as support from ({REPORT_SQL}) r"))
def q_classification_report(ctx):
    return M.classification_report(scored(ctx))


@query("confusion_matrix", W(*O.FEAT, SCORED) + """,
cls AS (select label::double as c from scored union select prediction from scored)
select cast(a.c as bigint) as label, cast(b.c as bigint) as prediction,
  cast((select count(*) from scored s where s.label = a.c and s.prediction = b.c) as bigint) as n
from cls a, cls b""")
def q_confusion_matrix(ctx):
    return M.confusion_matrix(scored(ctx))


@query("regression_metrics", O.r6(["mse", "rmse", "mae", "r2_score"], W(*O.FEAT) + """,
rp AS (select risk_score as label, 0.2 + 0.5 * is_privileged_access as prediction from features)
select mse, sqrt(mse) as rmse, mae, 1 - ss_res / ss_tot as r2_score from (
  select avg((label - prediction) ^ 2) as mse, avg(abs(label - prediction)) as mae,
    sum((label - prediction) ^ 2) as ss_res, var_pop(label) * count(label) as ss_tot from rp) t"""))
def q_regression_metrics(ctx):
    rp = ctx.features.select(F.col("risk_score").alias("label"),
                             (F.lit(0.2) + 0.5 * F.col("is_privileged_access")).alias("prediction"))
    return M.regression_metrics(rp)


@query("prediction_distribution", W(*O.FEAT, SCORED) +
       "select cast(prediction as bigint) as prediction, count(*) as n from scored group by 1")
def q_prediction_distribution(ctx):
    return S.prediction_distribution(scored(ctx))


@query("prediction_confidence", O.r6(["mean_confidence", "low_confidence_percentage"], W(*O.FEAT, SCORED) + """
select avg(conf) as mean_confidence, cast(count_if(conf < 0.6) as bigint) as low_confidence_count,
  100.0 * count_if(conf < 0.6) / count(*) as low_confidence_percentage from scored"""))
def q_prediction_confidence(ctx):
    return S.prediction_confidence(scored(ctx))


# ---------------------------------------------------------------- clusters

@query("cluster_distribution", W(*O.FEAT, CLUSTERED) + "select cluster, count(*) as n from cl group by 1")
def q_cluster_distribution(ctx):
    return S.cluster_distribution(clustered(ctx))


@query("cluster_profiles", O.r6(FL, W(*O.FEAT, CLUSTERED) + "select cluster, count(*) as size, " +
                                ", ".join(f"avg({c}) as {c}" for c in FL) + " from cl group by 1"))
def q_cluster_profiles(ctx):
    return S.cluster_profiles(ctx.features, clustered(ctx), ctx.ff.feature_columns, KEYS)


def _inertia_sql(k: int) -> str:
    cen = ", ".join(f"avg({c}) as m_{c}" for c in FL)
    sq = " + ".join(f"(x.{c} - m.m_{c}) ^ 2" for c in FL)
    return (f"select {k} as k, sum({sq}) as inertia from (select cast(access_item as bigint) % {k} as cluster, * from features) x "
            f"join (select cast(access_item as bigint) % {k} as cluster, {cen} from features group by 1) m on x.cluster = m.cluster")


INERTIA_SQL = W(*O.FEAT) + " union all ".join(_inertia_sql(k) for k in range(2, 11))


def _inertias(ctx):
    if "inertias" not in ctx.extra:
        f, cols = ctx.features, ctx.ff.feature_columns
        parts = [M.inertia(f.withColumn("cluster", F.col("access_item").cast("bigint") % k), cols)
                 .select(F.lit(k).cast("bigint").alias("k"), "inertia") for k in range(2, 11)]
        ctx.extra["inertias"] = reduce(lambda a, b: a.unionByName(b), parts)
    return ctx.extra["inertias"]


@query("cluster_inertia", f"select cast(k as bigint) as k, round(inertia, 1) as inertia from ({INERTIA_SQL}) i")
def q_cluster_inertia(ctx):
    """Within-cluster sum of squares of the item-code-modulo-k clusterings,
    k = 2..10.  Sums near 1e9 carry ~1e-6 of summation-order noise, so they
    are compared at 0.1."""
    return _inertias(ctx).withColumn("inertia", F.round("inertia", 1))


@query("elbow_k", f"""
select cast(k as bigint) as best_k from (select k, lead(inertia) over (order by k) - inertia as d from ({INERTIA_SQL}) i) t
where d is not null order by d, k limit 1""")
def q_elbow_k(ctx):
    return M.elbow_k(_inertias(ctx))


SIL_SQL = W(*O.FEAT, CLUSTERED) + f""",
st AS (select cluster, count(*) as n, {", ".join(f"sum({c}) as s_{c}" for c in FL)},
         sum({" + ".join(f"{c} * {c}" for c in FL)}) as q from cl group by 1),
pd AS (select c.request_id, c.cluster as own, s.cluster as other, s.n,
         s.n * ({" + ".join(f"c.{x} * c.{x}" for x in FL)}) - 2 * ({" + ".join(f"c.{x} * s.s_{x}" for x in FL)}) + s.q as tot
       from cl c, st s),
per AS (select request_id, max(case when own = other then tot / (n - 1) end) as a,
          min(case when own <> other then tot / n end) as b, max(case when own = other then n end) as n_own
        from pd group by 1)
select avg(case when n_own <= 1 then 0 else coalesce((b - a) / nullif(greatest(a, b), 0), 0) end) as silhouette from per"""


@query("silhouette", O.r6(["silhouette"], SIL_SQL))
def q_silhouette(ctx):
    return M.silhouette_sq(clustered(ctx), ctx.ff.feature_columns)


DB_SQL = W(*O.FEAT, CLUSTERED) + f""",
cen AS (select cluster, {", ".join(f"avg({c}) as m_{c}" for c in FL)} from cl group by 1),
s AS (select x.cluster, avg(sqrt({" + ".join(f"(x.{c} - m.m_{c}) ^ 2" for c in FL)})) as s
      from cl x join cen m on x.cluster = m.cluster group by 1),
pairs AS (select a.cluster as i, (sa.s + sb.s) / sqrt({" + ".join(f"(a.m_{c} - b.m_{c}) ^ 2" for c in FL)}) as r
          from cen a join cen b on a.cluster <> b.cluster join s sa on sa.cluster = a.cluster join s sb on sb.cluster = b.cluster)
select avg(mx) as davies_bouldin from (select i, max(r) as mx from pairs group by 1) t"""


@query("davies_bouldin", O.r6(["davies_bouldin"], DB_SQL))
def q_davies_bouldin(ctx):
    return M.davies_bouldin(clustered(ctx), ctx.ff.feature_columns)


# ---------------------------------------------------------------- selection and splits

RULES = [("risk_rule", "risk_score > 0.5"), ("privilege_rule", "is_privileged_access = 1"),
         ("conflict_rule", "sod_conflict = 1")]


@query("best_model", O.r6(["value"], W(*O.FEAT) + """,
acc AS (""" + " union all ".join(
    f"select '{n}' as model, {i} as model_order, avg(case when (case when {cond} then 1 else 0 end) = label "
    f"then 1.0 else 0.0 end)::double as accuracy from features" for i, (n, cond) in enumerate(RULES)) + """)
select model, 'accuracy' as metric, accuracy as value from acc order by accuracy desc, model_order limit 1"""))
def q_best_model(ctx):
    f = ctx.features
    parts = [f.agg(F.lit(n).alias("model"), F.lit(i).alias("model_order"),
                   F.avg((F.when(F.expr(cond), 1).otherwise(0) == F.col("label")).cast("double")).alias("accuracy"))
             for i, (n, cond) in enumerate(RULES)]
    return M.best_model(reduce(lambda a, b: a.unionByName(b), parts))


@query("task_detect", W(*O.FEAT) + """
select count(distinct label) as n_distinct, count(*) as n_rows,
  case when count(*) = 0 then 'clustering' when count(distinct label) / count(*) < 0.05 then 'classification'
       else 'regression' end as task from features""")
def q_task_detect(ctx):
    return TR.detect_task(ctx.features)


HASH = "md5(concat_ws('|', cast(request_id as varchar), '42'))"
NTEST = "floor((n * 200000 + 500000) / 1000000)"


@query("stratified_split", W(*O.FEAT) + f"""
select request_id, rn <= {NTEST} as is_test from (
  select request_id, row_number() over (partition by label order by {HASH}, request_id) as rn,
    count(*) over (partition by label) as n from features) t""")
def q_stratified_split(ctx):
    return stratified_split(ctx.features, KEYS, "label").select("request_id", "is_test")


@query("random_split", W(*O.FEAT) + f"""
select request_id, rn <= {NTEST} as is_test from (
  select request_id, row_number() over (order by {HASH}, request_id) as rn, count(*) over () as n from features) t""")
def q_random_split(ctx):
    return random_split(ctx.features, KEYS).select("request_id", "is_test")


@query("cv_folds", W(*O.FEAT) + f"""
select request_id, cast(floor((rn - 1) * 5 / n) as integer) as fold from (
  select request_id, row_number() over (partition by label order by {HASH}, request_id) as rn,
    count(*) over (partition by label) as n
  from (select * from (
          select *, row_number() over (partition by label order by {HASH}, request_id) as r0,
            count(*) over (partition by label) as n0 from features) s
        where r0 > {NTEST.replace('n *', 'n0 *')}) tr) t""")
def q_cv_folds(ctx):
    tr = stratified_split(ctx.features, KEYS, "label").where(~F.col("is_test"))
    return cv_folds(tr, KEYS, "label", 5).select("request_id", "fold")


# ---------------------------------------------------------------- MLlib models
#
# A model's numbers can't be stated in SQL, but facts that must hold about its
# whole output can: these queries run the full operators and return the facts.

N_TREES = 100
MODELS = ["random_forest", "gradient_boosting", "logistic_regression"]      # those whose packages are here
NAMED = "(values " + ", ".join(f"('{m}')" for m in MODELS) + ") m(model)"
TEST_SQL = f"""(select *, row_number() over (partition by label order by {HASH}, request_id) as rn,
    count(*) over (partition by label) as n from features)"""
TEST_SIZE = f"(select count(*) from {TEST_SQL} s where rn <= {NTEST})"
IMPORTANCE_MODELS = ["random_forest", "gradient_boosting"]


def trained(ctx, names: list[str]) -> dict:
    """The named classifiers, those not trained yet (once per session) on one stratified split; None for one that is
    unavailable or fails."""
    cache = ctx.extra.setdefault("classifiers", {})
    missing = [n for n in names if n not in cache]
    if missing:
        res, _ = TR.train_classifiers(ctx.features, ctx.ff.feature_columns, KEYS, missing, n_trees=N_TREES,
                                      settings=ctx.spec.models.settings)
        cache.update({n: None for n in missing} | {r.name: r for r in res})
    return {n: cache[n] for n in names}


def classifier(ctx, name: str):
    return trained(ctx, [name])[name]


def classifiers(ctx):
    """The models that have importances."""
    return {n: r for n, r in trained(ctx, IMPORTANCE_MODELS).items() if r is not None}


def importances(ctx):
    return reduce(lambda a, b: a.unionByName(b), [r.importances for r in classifiers(ctx).values()])


def _classifier_facts(ctx, name):
    """Rows of the test part, and that every metric is a share and the accuracy no worse than always
    answering the class that the training part holds most of (less one point in a hundred)."""
    r = classifier(ctx, name)
    split = stratified_split(ctx.features, KEYS, "label")
    test = split.where("is_test").groupBy("label").count()
    top = test.agg(F.sum("count").alias("n_test"), (F.max("count") / F.sum("count")).alias("share"))
    m = r.metrics
    shares = all(0 <= m[k] <= 1 for k in ("accuracy", "precision", "recall", "f1_score"))
    return top.select(F.lit(name).alias("model"), "n_test", F.lit(shares).alias("metrics_are_shares"),
                      (F.lit(float(m["accuracy"])) >= F.col("share") - 0.01).alias("not_below_majority"))


def _classifier_sql(name):
    return W(*O.FEAT) + f"select '{name}' as model, {TEST_SIZE}::bigint as n_test, true as metrics_are_shares, true as not_below_majority"


@query("rf_classifier", _classifier_sql("random_forest"))
def q_rf_classifier(ctx):
    return _classifier_facts(ctx, "random_forest")


@query("gbt_classifier", _classifier_sql("gradient_boosting"))
def q_gbt_classifier(ctx):
    return _classifier_facts(ctx, "gradient_boosting")


@query("logistic_regression", _classifier_sql("logistic_regression"))
def q_logistic_regression(ctx):
    return _classifier_facts(ctx, "logistic_regression")


FOLD_SQL = W(*O.FEAT) + f""",
tr AS (select request_id, label from {TEST_SQL} s where rn > {NTEST}),
f AS (select cast(floor((rn - 1) * 5 / n) as integer) as fold from (
  select row_number() over (partition by label order by {HASH}, request_id) as rn, count(*) over (partition by label) as n from tr) t)
select model, fold, count(*) as n_test, true as accuracy_is_share, true as mean_is_within from f, {NAMED} group by 1, 2"""


@query("cross_validate", FOLD_SQL)
def q_cross_validate(ctx):
    """5 stratified folds of the training part for every available classifier: the fold sizes, and
    that the mean of each classifier lies within its folds' accuracies."""
    from govlens.models import registry as REG
    tr = stratified_split(ctx.features.withColumn("label", F.col("label").cast("double")), KEYS, "label") \
        .where(~F.col("is_test"))
    settings = {**ctx.spec.models.settings, "n_trees": N_TREES}
    parts = []
    for name, factory, _ in REG.resolve(ctx.spec.models.classification_algorithms, REG.CLASSIFIERS):
        if factory is not None:
            scores = TR.cross_validate(factory, tr, ctx.ff.feature_columns, KEYS, 5, 42, settings)
            mean = TR.cv_summary(scores).first()["cv_mean"]
            low, high = scores.agg(F.min("accuracy"), F.max("accuracy")).first()
            parts.append(scores.select(F.lit(name).alias("model"), "fold", "n_test", F.col("accuracy").between(0, 1).alias("accuracy_is_share"),
                                       F.lit(low - 1e-12 <= mean <= high + 1e-12).alias("mean_is_within")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("score_all", W(*O.FEAT) + "select request_id, true as sums_to_one, true as is_most_probable from features")
def q_score_all(ctx):
    s = TR.score_all(classifier(ctx, "random_forest").model, ctx.features, KEYS)
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    best = F.array_position("probability", F.array_max("probability")) - 1
    return s.select("request_id", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), (F.col("prediction") == best).alias("is_most_probable"))


IMPORTED = "(values " + ", ".join(f"('{m}')" for m in IMPORTANCE_MODELS) + ") m(model)"


@query("top_features", f"select model, cast(r as integer) as rank, true as in_order from {IMPORTED}, range(1, 11) t(r)")
def q_top_features(ctx):
    """Ten ranks for each model, the importances in falling order."""
    w = Window.partitionBy("model").orderBy("rank")
    before = F.lag("importance").over(w)
    return S.top_features(importances(ctx)).select("model", "rank", F.coalesce(F.col("importance") <= before, F.lit(True)).alias("in_order"))


def _importance_facts(imp):
    return imp.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("feature").alias("n_features"),
                                    (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))


IMPORTANCE_SQL = f"select model, {len(FL)}::bigint as n_rows, {len(FL)}::bigint as n_features, true as sums_to_one from {IMPORTED}"


@query("sink_importance", IMPORTANCE_SQL)
def q_sink_importance(ctx):
    """Importances of each model written to the shared folder and read back: every feature once."""
    base = shared_path(ctx.spark, "importance")
    for name, r in classifiers(ctx).items():
        r.importances.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{base}/{name}")
    return _importance_facts(ctx.spark.read.option("header", True).option("inferSchema", True).csv(f"{base}/*"))


def _regression_features(ctx):
    """Regression on the risk score from the other features."""
    cols = [c for c in ctx.ff.feature_columns if c != "risk_score"]
    return ctx.features.select(*KEYS, F.col("risk_score").alias("label"), *cols), cols


def regressors(ctx):
    if "regressors" not in ctx.extra:
        f, cols = _regression_features(ctx)
        ctx.extra["regressors"] = {r.name: r for r in TR.train_regressors(
            f, cols, KEYS, ctx.spec.models.regression_algorithms, n_trees=N_TREES, settings=ctx.spec.models.settings)}
    return ctx.extra["regressors"]


def _linear_sql() -> str:
    """Least squares over all feature columns by elimination on the training part's normal equations, and its errors on the test part.

    Columns are scaled; one that the columns before it determine gets no coefficient.
    """
    cols = [c for c in FL if c != "risk_score"]
    n = len(cols)
    cov = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in [*cols, "risk_score"]) + "]" for a in cols)
    return W(*O.FEAT).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
sp AS (select *, rn <= {NTEST} as is_test from (
  select *, row_number() over (order by {HASH}, request_id) as rn, count(*) over () as n from features) t),
st AS (select avg(risk_score) as my, [{", ".join(f"avg({c})" for c in cols)}] as mx, [{", ".join(f"stddev_pop({c})" for c in cols)}, 1.0] as sx,
  [{cov}] as cov from sp where not is_test),
el AS (
  select 1 as k, list_transform(cov, lambda row, i: list_transform(row, lambda x, j: case when sx[i] * sx[j] = 0 then 0 else x / (sx[i] * sx[j]) end)) as m from st
  union all
  select k + 1, case when m[k][k] < 1e-9
    then list_transform(m, lambda row, i: case when i = k then list_transform(row, lambda x: 0.0) else row end)
    else list_transform(m, lambda row, i: case when i = k then list_transform(row, lambda x: x / row[k])
      else list_transform(row, lambda x, j: x - row[k] * m[k][j] / m[k][k]) end) end
  from el where k <= {n}),
fit AS (select my, mx, sx, list_transform(range(1, {n + 1}), lambda i: case when m[i][i] = 0 then 0 else m[i][{n + 1}] end) as b
  from el, st where k = {n + 1}),
rp AS (select risk_score as label, my + list_sum(list_transform([{", ".join(cols)}],
    lambda x, i: case when sx[i] = 0 then 0 else b[i] * (x - mx[i]) / sx[i] end)) as prediction from sp, fit where is_test)
select 'linear_regression' as model, n_test, mse, sqrt(mse) as rmse, mae, 1 - ss_res / ss_tot as r2_score, true as meets_normal_equations from (
  select count(*) as n_test, avg((label - prediction) ^ 2) as mse, avg(abs(label - prediction)) as mae, sum((label - prediction) ^ 2) as ss_res,
    var_pop(label) * count(label) as ss_tot from rp) e"""


@query("linear_regression", O.r6(["mse", "rmse", "mae", "r2_score"], _linear_sql()))
def q_linear_regression(ctx):
    """Least squares of the risk score on all other features: the errors on the test part, and that no
    feature is correlated with what the fit leaves over on the training part."""
    f, cols = _regression_features(ctx)
    if "linear" not in ctx.extra:
        ctx.extra["linear"] = TR.train_regressors(f, cols, KEYS, ["linear_regression"], settings=ctx.spec.models.settings)[0]
    r = ctx.extra["linear"]
    parts = random_split(f, KEYS)
    left = r.model.transform(parts.where("not is_test").withColumn("label", F.col("label").cast("double")))
    over = F.col("label") - F.col("prediction")
    # a correlation below 1e-4, without the division: a column that is constant on the training part may have any spread
    # elsewhere, or one by rounding
    ok = reduce(lambda a, b: a & b, [(F.max(F.col(f"`{c}`")) <= F.min(F.col(f"`{c}`")))
                                     | (F.abs(F.covar_pop(over, F.col(f"`{c}`"))) <= 1e-4 * F.stddev_pop(over) * F.stddev_pop(F.col(f"`{c}`")))
                                     for c in cols]) & (F.abs(F.avg(over)) < 1e-6)
    return left.agg(F.lit(r.name).alias("model"), F.lit(parts.where("is_test").count()).cast("bigint").alias("n_test"),
                    *[F.lit(float(r.metrics[m])).alias(m) for m in ("mse", "rmse", "mae", "r2_score")], ok.alias("meets_normal_equations"))


@query("rf_regressor", W(*O.FEAT) + f"""
select 'random_forest' as model, count(*) filter (rn <= {NTEST}) as n_test, true as errors_agree from (
  select row_number() over (order by {HASH}, request_id) as rn, count(*) over () as n from features) t""")
def q_rf_regressor(ctx):
    """The forest on the risk score: the rows of its test part, and errors that fit together."""
    m = regressors(ctx)["random_forest"].metrics
    ok = abs(m["rmse"] ** 2 - m["mse"]) < 1e-9 and 0 <= m["mae"] <= m["rmse"] + 1e-12 and m["r2_score"] <= 1
    test = random_split(_regression_features(ctx)[0], KEYS).where("is_test")
    return test.agg(F.lit("random_forest").alias("model"), F.count(F.lit(1)).alias("n_test"), F.lit(ok).alias("errors_agree"))


def clustering(ctx):
    if "kmeans" not in ctx.extra:
        ctx.extra["kmeans"] = TR.train_clustering(ctx.features, ctx.ff.feature_columns, KEYS)
    return ctx.extra["kmeans"]


@query("kmeans", W(*O.FEAT) + "select count(*) as n_rows, true as k_in_range, true as none_empty, true as inertia_falls from features")
def q_kmeans(ctx):
    """Ten starts for each k: every row in a cluster, k from 2 to 10, no cluster empty, inertia falling with k."""
    r = clustering(ctx)
    sizes = S.cluster_distribution(r.extra["assignments"])
    k = r.metrics["n_clusters"]
    inertia = [x["inertia"] for x in r.extra["inertias"].orderBy("k").collect()]            # nine rows at most
    falls = all(b <= a * 1.001 for a, b in zip(inertia, inertia[1:]))
    return sizes.agg(F.sum("n").alias("n_rows"), F.lit(2 <= k <= 10).alias("k_in_range"),
                     ((F.count(F.lit(1)) == k) & (F.min("n") > 0)).alias("none_empty"), F.lit(falls).alias("inertia_falls"))


@query("sink_clusters", W(*O.FEAT) + "select request_id, true as in_range from features")
def q_sink_clusters(ctx):
    """Assignments written and read back: every row once, with one of the k clusters."""
    path = shared_path(ctx.spark, "clusters")
    r = clustering(ctx)
    r.extra["assignments"].write.mode("overwrite").parquet(path)
    return ctx.spark.read.parquet(path).select("request_id", F.col("cluster").between(0, r.metrics["n_clusters"] - 1).alias("in_range"))


@query("sink_model", W(*O.FEAT) + "select 'random_forest' as model, count(*) as n_scored, count(*) as n_same from features")
def q_sink_model(ctx):
    """The random forest saved to the shared folder, loaded back and used to
    score every row: (model, n_scored, n_same) - the reloaded model must
    predict exactly what the trained one does.  Both score a row in one scan,
    whose answers are written and then meet by the id."""
    r = classifier(ctx, "random_forest")
    path = shared_path(ctx.spark, "model-random_forest")
    TR.save_model(r.model, path)
    loaded = TR.load_model(path)
    a = TR.score_all(r.model, ctx.features, [*KEYS, *ctx.ff.feature_columns]).withColumnRenamed("prediction", "p1").drop("probability")
    said = cut_lineage(TR.score_all(loaded, a, [*KEYS, "p1"]).select(*KEYS, "p1", F.col("prediction").alias("p2")), "table", "said")
    return said.select(*KEYS, "p1").join(said.select(*KEYS, "p2"), "request_id").agg(
        F.lit("random_forest").alias("model"), F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col("p1") == F.col("p2")).alias("n_same"))


STATUS = [("random_forest", "available"), ("gradient_boosting", "available"), ("lightgbm", "unavailable"), ("xgboost", "unavailable"),
          ("logistic_regression", "available")]


@query("model_registry", W(*O.FEAT) + """
select n_rows, t.* from (select count(*) as n_rows, count(distinct label) / count(*) < 0.05 as classes from features) f, (values """ + ", ".join(
    f"({i}, '{n}', '{s}')" for i, (n, s) in enumerate(STATUS)) + ") t(model_order, model, status) where classes")
def q_model_registry(ctx):
    """The configured models for the task that the table poses, in order, and whether each can be trained here."""
    from govlens.models import registry as REG
    task = TR.detect_task(ctx.features)
    m = ctx.spec.models
    names = {"classification": (m.classification_algorithms, REG.CLASSIFIERS), "regression": (m.regression_algorithms, REG.REGRESSORS)}
    rows = [(t, i, n, status) for t, (algorithms, table) in names.items() for i, (n, _, status) in enumerate(REG.resolve(algorithms, table))]
    known = ctx.spark.createDataFrame(rows, "task string, model_order int, model string, status string")
    return task.join(known, "task").select("n_rows", "model_order", "model", "status")


@query("pick_saved_classifier", W(*O.FEAT) + "select 3::bigint as n_saved, 'random_forest_classifier' as picked, count(*) as n_scored from features")
def q_pick_saved_classifier(ctx):
    """The trained classifiers saved, found again by their folder, and all rows scored by the one that is preferred."""
    from govlens.models import registry as REG
    from govlens.plans.pipeline import saved_models
    base = shared_path(ctx.spark, "models")
    for name, r in trained(ctx, MODELS).items():
        TR.save_model(r.model, f"{base}/{name}_classifier")
    found = saved_models(ctx.spark, base)
    picked = REG.pick_saved_classifier(list(found))
    return TR.score_all(found[picked].model, ctx.features, KEYS).agg(
        F.lit(len(found)).cast("bigint").alias("n_saved"), F.lit(picked).alias("picked"), F.count("prediction").alias("n_scored"))


@query("best_trained_model", "select true as is_the_most_accurate")
def q_best_trained_model(ctx):
    """``best_model`` over the trained classifiers picks the one of highest test accuracy."""
    from govlens.plans.pipeline import best_trained
    found = trained(ctx, MODELS)
    best = best_trained(ctx.spark, {n: r for n, r in found.items() if r is not None})
    top = max(r.metrics["accuracy"] for r in found.values() if r is not None)
    return best.select((F.abs(F.col("value") - F.lit(float(top))) < 1e-12).alias("is_the_most_accurate"))
