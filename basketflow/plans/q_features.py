"""Feature queries over the purchase views (A1-A3, A6-A9, A16, A17, J1, J5,
P3, P4, F2, F7, W3, W5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.functions.columns import int_sum
from basketflow.operators import features as feat
from basketflow.plans.catalog import query
from basketflow.plans.oracle_views import with_views
from basketflow.session import cut_by_rows
from basketflow.sources.tables import numbered_orders, order_products, orders_base, orders_view, split_products, table


def _ov(spark, sf):
    o = numbered_orders(spark, sf)
    return o, split_products(order_products(spark, sf, o), "prior")


def _lines(spark, sf):
    """Orders, and the prior lines with their order's user and number."""
    o = numbered_orders(spark, sf)
    return o, split_products(order_products(spark, sf, o, users=True, reordered=False), "prior")


CLEAN = ("v_clean", """
select order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
       coalesce(cast(trunc(try_cast(nullif(days_since_prior_order, '') as double)) as integer), 0) as dspo
from v_orders""")
PRODUCT = ("v_prod", """
select product_id, count(product_id) as prod_cnt,
       cast(sum(cast(reordered as integer)) as bigint) as prod_sum_rod,
       avg(cast(reordered as integer)) as prod_rod_rate
from v_prior group by product_id""")
GAP = ("v_gap", "select user_id, avg(dspo) as u_avg_day_gap from v_clean group by user_id")
ORDCNT = ("v_ordcnt", "select user_id, count(*) as user_ord_cnt from v_orders group by user_id")
PSET = ("v_pset", """
select user_id, count(*) as u_prod_dist_cnt,
       string_agg(cast(product_id as varchar), ',' order by product_id) as u_prod_records
from (select distinct o.user_id, p.product_id from v_orders o join v_prior p on o.order_id = p.order_id) t
group by user_id""")
BASKET = ("v_basket", """
select o.user_id, avg(c.n_items) as u_avg_ord_prods
from v_orders o join (select order_id, count(*) as n_items from v_prior group by order_id) c
  on o.order_id = c.order_id
group by o.user_id""")
USERF = ("v_userf", """
select g.user_id, g.u_avg_day_gap, c.user_ord_cnt, s.u_prod_dist_cnt, s.u_prod_records, b.u_avg_ord_prods
from v_gap g join v_ordcnt c on g.user_id = c.user_id join v_pset s on g.user_id = s.user_id
     join v_basket b on g.user_id = b.user_id""")
USER_PARTS = [CLEAN, GAP, ORDCNT, PSET, BASKET, USERF]


def sql(body, *ctes, views=("v_orders", "v_prior")):
    return with_views(body, *views, extra=list(ctes))


@query("orders_clean", sql("select * from v_clean", CLEAN, views=("v_orders",)))
def q_orders_clean(spark, sf):
    return feat.clean_orders(orders_view(spark, sf))


@query("order_lines", sql("""
select o.order_id, o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day,
       o.days_since_prior_order, p.product_id, p.add_to_cart_order, p.reordered
from v_orders o join v_prior p on o.order_id = p.order_id"""))
def q_order_lines(spark, sf):
    o, prior = _ov(spark, sf)
    return feat.order_lines(o, prior)


@query("product_features", sql("select * from v_prod", PRODUCT))
def q_product_features(spark, sf):
    return feat.product_features(_ov(spark, sf)[1])


@query("user_day_gap", sql("select * from v_gap", CLEAN, GAP, views=("v_orders",)))
def q_user_day_gap(spark, sf):
    return feat.user_day_gap(orders_view(spark, sf))


@query("user_order_count", sql("select * from v_ordcnt", ORDCNT, views=("v_orders",)))
def q_user_order_count(spark, sf):
    return feat.user_order_count(orders_base(spark, sf))


@query("user_product_set", sql("select * from v_pset", PSET))
def q_user_product_set(spark, sf):
    return feat.user_product_set(*_lines(spark, sf))


@query("user_product_list", sql("""
select o.user_id, count(distinct p.product_id) as u_prod_dist_cnt, min(p.product_id) as first_product,
       max(p.product_id) as last_product
from v_orders o join v_prior p on o.order_id = p.order_id group by o.user_id"""))
def q_user_product_list(spark, sf):
    """The set as an array column, read by its size and ends."""
    x = feat.user_product_list(*_lines(spark, sf))
    return x.select("user_id", "u_prod_dist_cnt", F.element_at("u_prod_list", 1).alias("first_product"),
                    F.element_at("u_prod_list", -1).alias("last_product"))


@query("user_basket_size", sql("select * from v_basket", BASKET))
def q_user_basket_size(spark, sf):
    return feat.user_basket_size(*_lines(spark, sf))


@query("user_features", sql("select * from v_userf", *USER_PARTS))
def q_user_features(spark, sf):
    return feat.user_features(*_lines(spark, sf))


@query("user_product_features", sql("""
select user_id, product_id, up_orders, up_avg_cart, up_last_order, up_cnt,
       up_cnt / sum(up_cnt) over (partition by user_id) as up_rate
from (select o.user_id, p.product_id, count(distinct o.order_id) as up_orders,
             sum(p.add_to_cart_order) / count(*) as up_avg_cart,
             arg_max(o.order_id, o.order_number) as up_last_order,
             count(*) as up_cnt
      from v_orders o join v_prior p on o.order_id = p.order_id
      group by o.user_id, p.product_id) t"""))
def q_user_product_features(spark, sf):
    return cut_by_rows(feat.user_product_features(*_lines(spark, sf)), table(spark, sf, "lineitem").count())


@query("dow_pivot", sql(
    "select user_id, "
    + ", ".join(f"cast(sum(case when order_dow = {d} then 1 else 0 end) as bigint) as dow_{d}"
                for d in feat.DOW_DAYS)
    + " from v_orders group by user_id", views=("v_orders",)))
def q_dow_pivot(spark, sf):
    return feat.dow_counts(orders_base(spark, sf))


@query("user_top3_orders", sql("""
select user_id, rank, order_number, order_hour_of_day from (
  select user_id, order_number, order_hour_of_day,
         cast(row_number() over (partition by user_id order by order_hour_of_day, order_number) as integer) as rank
  from v_orders) t where rank <= 3""", views=("v_orders",)))
def q_user_top3_orders(spark, sf):
    return feat.first_orders_by_hour(orders_view(spark, sf), 3)


@query("user_top3_products", sql("""
select user_id, product_id, cnt, rank from (
  select user_id, product_id, cnt,
         cast(row_number() over (partition by user_id order by cnt desc, product_id) as integer) as rank
  from (select o.user_id, p.product_id, count(*) as cnt
        from v_orders o join v_prior p on o.order_id = p.order_id group by o.user_id, p.product_id) c
) t where rank <= 3"""))
def q_user_top3_products(spark, sf):
    return feat.top_products(*_lines(spark, sf), 3)


@query("plus_columns", sql("select order_id, order_number + order_dow as plus from v_orders",
                           views=("v_orders",)))
def q_plus_columns(spark, sf):
    """integer sum of two columns (the generic UDF form is
    ``functions.columns.plus_udf``, a pandas UDF, checked in the tests)."""
    o = orders_view(spark, sf)
    return o.select("order_id", int_sum(F.col("order_number"), F.col("order_dow")).alias("plus"))
