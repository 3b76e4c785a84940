"""Model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.operators import labels as lab
from basketflow.operators import model as M
from basketflow.plans.catalog import query
from basketflow.plans.q_features import sql
from basketflow.plans.q_labels import TRAINSET_CTES, VIEWS3, _o
from basketflow.session import cut_by_rows, cut_lineage, partitions_of
from basketflow.sources.tables import table

_Z = " + ".join([f"cast({M.FIXED_INTERCEPT!r} as double)"]
                + [f"cast({w!r} as double) * cast({f} as double)" for f, w in zip(lab.MODEL_FEATURES,
                                                                                M.FIXED_WEIGHTS)])
_SCORE = f"round(1.0 / (1.0 + exp(-({_Z}))), {M.SCORE_DIGITS})"
_PER = ("v_per", f"""
select score as threshold, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
from (select label, {_SCORE} as score from v_trainset) s group by score""")
_RUN = ("v_run", """
select threshold, pos, neg,
       cast(sum(pos) over (order by threshold desc rows between unbounded preceding and current row) as bigint) as tp,
       cast(sum(neg) over (order by threshold desc rows between unbounded preceding and current row) as bigint) as fp
from v_per""")


def _rows(spark, sf) -> int:
    return table(spark, sf, "lineitem").count()


def _split(spark, sf, tables=None):
    """The split training set, written once to the shared folder: the fit's
    iterations, its summary and the hold-out scoring all read that copy
    instead of recomputing the feature joins."""
    rows = _rows(spark, sf)
    split = lab.train_test_split(lab.training_set(*(tables or _o(spark, sf)), rows))
    return cut_lineage(split, free=True, partitions=partitions_of(spark, rows))


@query("score_candidates", sql(f"""
select p.user_id, p.product_id, {_SCORE} as score
from (select user_id, product_id from v_bad
      where user_id in (select user_id from v_orders where eval_set = 'test')) p
join v_uf u on p.user_id = u.user_id join v_prod pr on p.product_id = pr.product_id""",
                                *TRAINSET_CTES, views=VIEWS3))
def q_score_candidates(spark, sf):
    """J10 + M8: test users' prior pairs scored with the fixed model."""
    rows = _rows(spark, sf)
    scored = M.logistic_score(lab.score_candidates(*_o(spark, sf), rows)).select("user_id", "product_id", "score")
    return cut_by_rows(scored, rows)


@query("roc_points", sql("""
select threshold, pos, neg, tp, fp, tp / (select cast(sum(pos) as double) from v_per) as tpr,
       fp / (select cast(sum(neg) as double) from v_per) as fpr
from v_run""", *TRAINSET_CTES, _PER, _RUN, views=VIEWS3))
def q_roc_points(spark, sf):
    return M.roc_points(M.logistic_score(lab.training_set(*_o(spark, sf))))


@query("roc_auc", sql("""
select cast(sum(neg * (2 * tp - pos)) as double) / (2.0 * sum(pos) * sum(neg)) as auc from v_run""",
                      *TRAINSET_CTES, _PER, _RUN, views=VIEWS3))
def q_roc_auc(spark, sf):
    return M.roc_auc(M.roc_points(M.logistic_score(lab.training_set(*_o(spark, sf)))))


@query("lr_model")
def q_lr_model(spark, sf):
    """Rows-only: fitted coefficients and intercept (70 % part)."""
    d = _split(spark, sf)
    model = M.fit(d.filter(F.col("split") == "train"))
    return M.coefficients_frame(spark, model)


@query("lr_loss")
def q_lr_loss(spark, sf):
    """Rows-only: loss per iteration of the fit."""
    d = _split(spark, sf)
    return M.loss_frame(spark, M.fit(d.filter(F.col("split") == "train")))


@query("lr_holdout")
def q_lr_holdout(spark, sf):
    """Rows-only: the 30 % hold-out scored by the fitted model."""
    d = _split(spark, sf)
    model = M.fit(d.filter(F.col("split") == "train"))
    return M.predict(model, d.filter(F.col("split") == "test"))


@query("lr_score_test_users")
def q_lr_score_test_users(spark, sf):
    """Rows-only: the test users' prior pairs scored by the fitted model."""
    tables = _o(spark, sf)                       # orders are numbered once for both frames
    d = _split(spark, sf, tables)
    fitted = M.fit(d.filter(F.col("split") == "train"))
    rows = _rows(spark, sf)
    return M.predict(fitted, cut_by_rows(lab.score_candidates(*tables, rows), rows))


@query("lr_auc")
def q_lr_auc(spark, sf):
    """Rows-only: area under the ROC curve of the fitted model, training part and hold-out."""
    d = _split(spark, sf)
    fitted = M.fit(d.filter(F.col("split") == "train"))
    out = None
    for part in ("train", "test"):
        points = M.roc_points(M.predict(fitted, d.filter(F.col("split") == part)), score="p1")
        row = M.roc_auc(points).select(F.lit(part).alias("part"), "auc")
        out = row if out is None else out.unionByName(row)
    return out
