from pyspark.sql import functions as F

from basketflow.operators import labels as lab
from basketflow.operators import model as M
from basketflow.sources.tables import order_products, orders_view


def test_logistic_regression_recovers_known_coefficients(spark):
    # labels drawn from a known model: logit = 0.5 * x1 - 1.0 * x2 (+ 0 for the rest)
    n = 20000
    df = spark.range(n).select(
        F.col("id").alias("user_id"), F.lit(1).alias("product_id"),
        *[(F.randn(seed=10 + i)).alias(f) for i, f in enumerate(lab.MODEL_FEATURES)])
    z = 0.5 * F.col(lab.MODEL_FEATURES[0]) - 1.0 * F.col(lab.MODEL_FEATURES[1])
    df = df.withColumn("label", (F.rand(seed=99) < 1 / (1 + F.exp(-z))).cast("int"))
    model = M.fit(df).model
    w = model.coefficients.toArray()
    assert abs(w[0] - 0.5) < 0.08 and abs(w[1] + 1.0) < 0.08
    assert all(abs(x) < 0.08 for x in w[2:]) and abs(model.intercept) < 0.08
    assert len(model.summary.objectiveHistory) <= M.MAX_ITER + 1


def test_exact_auc_small_case(spark):
    # scores with a tie between a positive and a negative
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1), (0.05, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    auc = M.roc_auc(M.roc_points(df)).first().auc
    pos = [s for s, l in rows if l == 1]
    neg = [s for s, l in rows if l == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(auc - want) < 1e-15
    pts = M.roc_points(df).orderBy(F.col("threshold").desc()).collect()
    assert pts[-1].tpr == 1.0 and pts[-1].fpr == 1.0


def test_frame_auc_near_spark_evaluator(spark, sf):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    o = orders_view(spark, sf)
    scored = M.logistic_score(lab.training_set(o, order_products(spark, sf, o)))
    ours = M.roc_auc(M.roc_points(scored)).first().auc
    data = scored.withColumn("label_d", F.col("label").cast("double"))
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label_d",
                                          metricName="areaUnderROC", numBins=0).evaluate(data)
    binned = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label_d",
                                           metricName="areaUnderROC").evaluate(data)
    assert abs(ours - exact) < 1e-12   # same curve, no binning
    assert abs(ours - binned) < 1e-3   # Spark's default down-samples to 1000 bins


def test_auc_without_overflow_and_with_missing_classes(spark):
    big = 4_000_000_000
    pts = spark.createDataFrame([(0.9, big, 0, big, 0), (0.1, 0, big, big, big)],
                                "threshold double, pos long, neg long, tp long, fp long")
    assert M.roc_auc(pts).first().auc == 1.0
    for rows in ([(0.5, 1)], [(0.5, 0), (0.2, 0)], []):
        df = spark.createDataFrame(rows, "score double, label int")
        assert M.roc_auc(M.roc_points(df)).first().auc is None
    one = M.roc_points(spark.createDataFrame([(0.5, 1)], "score double, label int")).first()
    assert one.tpr == 1.0 and one.fpr is None


def test_fitted_model_scores_rows_without_labels(spark, sf):
    o = orders_view(spark, sf)
    op = order_products(spark, sf, o)
    train = lab.training_set(o, op)
    fitted = M.fit(train)
    a = M.predict(fitted, lab.score_candidates(o, op))
    assert "label" not in a.columns and a.count() == lab.score_candidates(o, op).count()
    # the formula is the one fitted on the training rows: same p1 with and without a label, on any subset
    with_label = {(r.user_id, r.product_id): r.p1 for r in M.predict(fitted, train.filter("user_id % 2 = 0")).collect()}
    without = {(r.user_id, r.product_id): r.p1 for r in M.predict(fitted, train.drop("label")).collect()}
    assert all(without[k] == v for k, v in with_label.items())


def test_loss_starts_at_the_entropy_of_the_labels(spark, sf):
    """Iteration 0 has zero weights and the intercept of the label rate."""
    import math
    o = orders_view(spark, sf)
    train = lab.training_set(o, order_products(spark, sf, o))
    n, pos = train.agg(F.count("*"), F.sum("label")).first()
    p = pos / n
    first = M.fit(train).model.summary.objectiveHistory[0]
    assert abs(first + p * math.log(p) + (1 - p) * math.log(1 - p)) < 1e-9
