"""Next-purchase model: formula, logistic regression, scoring, ROC.

Training is Spark ML (distributed gradient aggregation per iteration).
Scoring with given coefficients and the ROC curve are plain DataFrame
expressions, so they can be checked in SQL; the ROC's cumulative sums are
distributed running totals, not a single-task window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators.labels import MODEL_FEATURES
from basketflow.operators.prefix import running_totals
from basketflow.session import cut_lineage

FORMULA = "label ~ " + " + ".join(MODEL_FEATURES)
MAX_ITER = 10
REG_PARAM = 0.0
SCORE_DIGITS = 9

# Fixed scoring model (used where results must be checkable without a fit):
# intercept first, then one weight per feature in MODEL_FEATURES order.
FIXED_INTERCEPT = -3.0
FIXED_WEIGHTS = (-0.01, 0.05, -0.002, 0.02, 0.1, 2.0, 0.01)


@dataclass
class Fitted:
    """A fitted formula with the model fitted on its features."""

    formula: object
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        """Features by the fitted formula (no label needed), then predictions."""
        return self.model.transform(self.formula.transform(df))


def formula(train: DataFrame):
    """M4: RFormula -> ``features`` vector and ``label_d``, fitted on the training rows."""
    from pyspark.ml.feature import RFormula
    return RFormula(formula=FORMULA, featuresCol="features", labelCol="label_d").fit(_with_double_label(train))


def _with_double_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("label").cast("double"))


def fit(train: DataFrame) -> Fitted:
    """LogisticRegression(maxIter=10, regParam=0); the assembled
    matrix is cached only for the iterations of ``fit``."""
    from pyspark.ml.classification import LogisticRegression
    f = formula(train)
    data = f.transform(_with_double_label(train)).select("features", F.col("label_d").alias("label")).persist()
    try:
        model = LogisticRegression(maxIter=MAX_ITER, regParam=REG_PARAM).fit(data)
        # touch the summary while the data is cached
        _ = model.summary.objectiveHistory
        return Fitted(f, model)
    finally:
        data.unpersist()


def coefficients_frame(spark, fitted: Fitted) -> DataFrame:
    """M7: one row per term (features in formula order, then the intercept)."""
    rows = [(name, float(w)) for name, w in zip(MODEL_FEATURES, fitted.model.coefficients.toArray())]
    rows.append(("intercept", float(fitted.model.intercept)))
    return spark.createDataFrame(rows, "term string, value double")


def loss_frame(spark, fitted: Fitted) -> DataFrame:
    """M9: loss per iteration."""
    hist = fitted.model.summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def predict(fitted: Fitted, df: DataFrame) -> DataFrame:
    """M8: score a frame with the fitted model; ``p1`` = P(label = 1).  The
    label column is optional and carried along if there."""
    from pyspark.ml.functions import vector_to_array
    label = ["label"] if "label" in df.columns else []
    src = df.withColumnRenamed("label", "label_in") if label else df
    return fitted.transform(src).select("user_id", "product_id", *[F.col("label_in").alias("label") for _ in label],
                                        "prediction", vector_to_array("probability").getItem(1).alias("p1"))


def logistic_score(df: DataFrame, intercept: float = FIXED_INTERCEPT,
                   weights=FIXED_WEIGHTS) -> DataFrame:
    """M8 with given coefficients: ``1 / (1 + exp(-(b + sum w_i x_i)))``,
    added left to right (same order as the SQL check), rounded."""
    z = F.lit(float(intercept))
    for name, w in zip(MODEL_FEATURES, weights):
        z = z + F.lit(float(w)) * F.col(name).cast("double")
    return df.withColumn("score", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), SCORE_DIGITS))


def roc_points(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One point per distinct score, thresholds descending:
    ``threshold, tp, fp, tpr, fpr`` (a rate is NULL if its class is missing).  Counts per score are aggregated first,
    then running totals over the distinct scores (distributed)."""
    per = cut_lineage(scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg")))
    # counts per distinct score are materialised once: the totals, the range
    # sampling of the running totals and the curve all read that copy
    tot = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    run = running_totals(per, [F.col("threshold").desc()], count_col="_k",
                         sums={"tp": F.col("pos"), "fp": F.col("neg")})
    p, n = tot.first()
    share = lambda c, t: F.try_divide(F.col(c).cast("double"), F.lit(t).cast("double"))
    return run.select("threshold", "pos", "neg", "tp", "fp", share("tp", p).alias("tpr"), share("fp", n).alias("fpr"))


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids, exactly: with
    ``tp_prev = tp - pos`` the area is ``sum(neg * (tp + tp_prev)) / (2 P N)``
    -- integers summed as decimals (no overflow), one division.  NULL when a
    class is missing or there are no rows."""
    big = lambda c: F.col(c).cast("decimal(19,0)")
    agg = points.agg(F.sum((big("neg") * (2 * big("tp") - big("pos"))).cast("decimal(38,0)")).alias("num"),
                     F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    return agg.select(F.try_divide(F.col("num").cast("double"), F.lit(2.0) * F.col("P") * F.col("N")).alias("auc"))
