"""Label, split and set queries."""

from __future__ import annotations

from basketflow.operators import labels as lab
from basketflow.plans.catalog import query
from basketflow.plans.q_features import BASKET, CLEAN, GAP, ORDCNT, PRODUCT, sql
from basketflow.sources.tables import numbered_orders, order_products, orders_view

PAIRS = [("v_good", """
select distinct o.user_id, p.product_id from v_orders o join v_train p on o.order_id = p.order_id"""),
         ("v_bad", """
select distinct o.user_id, p.product_id from v_orders o join v_prior p on o.order_id = p.order_id""")]
LABELS = ("v_labels", """
select coalesce(g.user_id, b.user_id) as user_id, coalesce(g.product_id, b.product_id) as product_id,
       case when g.user_id is null then 0 else 1 end as label
from v_good g full outer join v_bad b on g.user_id = b.user_id and g.product_id = b.product_id""")
UF7 = ("v_uf", """
select g.user_id, g.u_avg_day_gap, c.user_ord_cnt, s.u_prod_dist_cnt, b.u_avg_ord_prods
from v_gap g join v_ordcnt c on g.user_id = c.user_id
     join (select user_id, count(*) as u_prod_dist_cnt from v_bad group by user_id) s on g.user_id = s.user_id
     join v_basket b on g.user_id = b.user_id""")
TRAINSET = ("v_trainset", """
select l.user_id, l.product_id, l.label, u.u_avg_day_gap, u.user_ord_cnt, u.u_prod_dist_cnt,
       u.u_avg_ord_prods, p.prod_sum_rod, p.prod_rod_rate, p.prod_cnt
from v_labels l join v_uf u on l.user_id = u.user_id join v_prod p on l.product_id = p.product_id""")
TRAINSET_CTES = [*PAIRS, LABELS, CLEAN, GAP, ORDCNT, BASKET, UF7, PRODUCT, TRAINSET]
VIEWS3 = ("v_orders", "v_prior", "v_train")


def _o(spark, sf, reordered=True):
    o = numbered_orders(spark, sf)
    return o, order_products(spark, sf, o, users=True, reordered=reordered)


@query("users_by_split", sql("select distinct eval_set, user_id from v_orders", views=("v_orders",)))
def q_users_by_split(spark, sf):
    return lab.users_by_split(orders_view(spark, sf))


@query("split_coverage", sql("""
select cast(sum(prior) as bigint) as n_prior, cast(sum(train) as bigint) as n_train,
       cast(sum(test) as bigint) as n_test,
       cast(sum(case when prior = 1 and greatest(train, test) = 0 then 1 else 0 end) as bigint) as n_prior_only,
       cast(sum(case when prior = 0 and greatest(train, test) = 1 then 1 else 0 end) as bigint) as n_train_test_only
from (select user_id, max(case when eval_set = 'prior' then 1 else 0 end) as prior,
             max(case when eval_set = 'train' then 1 else 0 end) as train,
             max(case when eval_set = 'test' then 1 else 0 end) as test
      from v_orders group by user_id) u""", views=("v_orders",)))
def q_split_coverage(spark, sf):
    return lab.split_coverage(orders_view(spark, sf))


@query("prior_train_intersect", sql("""
select o.user_id, p.product_id from v_orders o join v_prior p on o.order_id = p.order_id
intersect
select o.user_id, p.product_id from v_orders o join v_train p on o.order_id = p.order_id""", views=VIEWS3))
def q_prior_train_intersect(spark, sf):
    return lab.prior_train_intersect(*_o(spark, sf, reordered=False))


@query("label_pairs", sql("select * from v_labels", *PAIRS, LABELS, views=VIEWS3))
def q_label_pairs(spark, sf):
    return lab.label_pairs(*_o(spark, sf, reordered=False))


@query("training_set", sql("select * from v_trainset", *TRAINSET_CTES, views=VIEWS3))
def q_training_set(spark, sf):
    return lab.training_set(*_o(spark, sf))


@query("train_test_split", sql(f"""
select *, case when ((user_id * {lab.SPLIT_MULTIPLIER} + product_id) % {lab.SPLIT_BUCKETS}
                     + {lab.SPLIT_BUCKETS}) % {lab.SPLIT_BUCKETS} < {lab.SPLIT_TRAIN_BUCKETS}
               then 'train' else 'test' end as split
from v_trainset""", *TRAINSET_CTES, views=VIEWS3))
def q_train_test_split(spark, sf):
    return lab.train_test_split(lab.training_set(*_o(spark, sf)))
