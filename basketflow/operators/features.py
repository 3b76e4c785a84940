"""Purchase features per user, product and (user, product) (A1-A3, A6-A9,
A16, A17, P3, P4, F7, J1, J5, W3, W5).

Inputs are the ``orders`` view and an order-products frame (``priors``).
Every feature is a map-side-combined aggregate; sets are de-duplicated
before they are collected, so a user's collected list is bounded by the
distinct products the user bought, never by the user's row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.cf import top_k

DOW_DAYS = range(7)  # fixed: order_dow codes 0 (Sunday) .. 6


def days_since_prior(c: Column) -> Column:
    """D6: '' -> 0, '15.0' -> 15, junk -> 0; ANSI-safe (no CAST_INVALID_INPUT)."""
    return F.coalesce(F.nullif(c, F.lit("")).try_cast("double").cast("int"), F.lit(0))


def clean_orders(orders: DataFrame) -> DataFrame:
    """``*`` plus integer ``dspo``, without ``days_since_prior_order``."""
    return orders.withColumn("dspo", days_since_prior(F.col("days_since_prior_order"))) \
                 .drop("days_since_prior_order")


def order_lines(orders: DataFrame, priors: DataFrame) -> DataFrame:
    """Orders joined with their product lines on ``order_id``."""
    return orders.join(priors, "order_id")


def product_features(priors: DataFrame) -> DataFrame:
    """A2: prod_cnt, prod_sum_rod, prod_rod_rate in one aggregate."""
    rod = F.col("reordered").cast("int")
    return priors.groupBy("product_id").agg(
        F.count("product_id").alias("prod_cnt"),
        F.sum(rod).cast("long").alias("prod_sum_rod"),
        F.avg(rod).alias("prod_rod_rate"))


def user_day_gap(orders: DataFrame) -> DataFrame:
    """A3: mean days between orders over all of a user's orders."""
    o = orders if "dspo" in orders.columns else clean_orders(orders)
    return o.groupBy("user_id").agg(F.avg("dspo").alias("u_avg_day_gap"))


def user_order_count(orders: DataFrame) -> DataFrame:
    """A1: orders per user (all splits)."""
    return orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_ord_cnt"))


def lines_with(orders: DataFrame, priors: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of the order lines.  Columns that ``priors`` lacks come from ``orders``; lines that carry them
    already (``order_products(..., users=True)``) are not joined a second time."""
    missing = [c for c in cols if c not in priors.columns]
    if not missing:
        return priors.select(*cols)
    own = [c for c in cols if c in priors.columns and c != "order_id"]
    return order_lines(orders.select("order_id", *missing), priors.select("order_id", *own)).select(*cols)


def user_products(orders: DataFrame, priors: DataFrame) -> DataFrame:
    """Distinct (user_id, product_id) of the prior lines."""
    return lines_with(orders, priors, "user_id", "product_id").distinct()


def user_product_set(orders: DataFrame, priors: DataFrame, with_set: bool = True) -> DataFrame:
    """Distinct product count and the sorted set joined by ','."""
    up = user_products(orders, priors)
    aggs = [F.count(F.lit(1)).alias("u_prod_dist_cnt")]
    if with_set:
        aggs.append(F.array_join(F.sort_array(F.collect_list("product_id")), ",").alias("u_prod_records"))
    return up.groupBy("user_id").agg(*aggs)


def user_product_list(orders: DataFrame, priors: DataFrame) -> DataFrame:
    """The distinct products as a sorted array column ``u_prod_list``, with its size."""
    return user_products(orders, priors).groupBy("user_id").agg(
        F.sort_array(F.collect_list("product_id")).alias("u_prod_list")) \
        .withColumn("u_prod_dist_cnt", F.size("u_prod_list").cast("long"))


def user_basket_size(orders: DataFrame, priors: DataFrame) -> DataFrame:
    """Items per order, then the mean per user.  Counted on the same
    order-lines join as the product set, so the shuffles under that join are
    shared when both are in one plan."""
    lines = lines_with(orders, priors, "order_id", "user_id")
    per_order = lines.groupBy("user_id", "order_id").agg(F.count(F.lit(1)).alias("n_items"))
    return per_order.groupBy("user_id").agg(F.avg("n_items").alias("u_avg_ord_prods"))


def user_order_stats(orders: DataFrame) -> DataFrame:
    """A1 + A3 in one aggregate over all of a user's orders."""
    o = orders if "dspo" in orders.columns else clean_orders(orders)
    return o.groupBy("user_id").agg(F.avg("dspo").alias("u_avg_day_gap"),
                                    F.count(F.lit(1)).alias("user_ord_cnt"))


def user_features(orders: DataFrame, priors: DataFrame, with_set: bool = True) -> DataFrame:
    """The user parts, inner-joined by user (D7).  Day gap, order count and
    basket size are one aggregate over the orders with their number of prior
    lines; users without prior lines fall out with the product set."""
    o = orders if "dspo" in orders.columns else clean_orders(orders)
    per_order = priors.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    users = o.select("order_id", "user_id", "dspo").join(per_order, "order_id", "left").groupBy("user_id").agg(
        F.avg("dspo").alias("u_avg_day_gap"), F.count(F.lit(1)).alias("user_ord_cnt"),
        F.avg("n_items").alias("u_avg_ord_prods"))
    return users.join(user_product_set(orders, priors, with_set), "user_id").select(
        "user_id", "u_avg_day_gap", "user_ord_cnt", "u_prod_dist_cnt",
        *(["u_prod_records"] if with_set else []), "u_avg_ord_prods")


def user_product_features(orders: DataFrame, priors: DataFrame) -> DataFrame:
    """Per (user, product): distinct orders, mean cart position, last
    order id, and the pair's share of the user's purchased lines."""
    lines = lines_with(orders, priors, "order_id", "user_id", "order_number", "product_id", "add_to_cart_order")
    per_order = lines.groupBy("user_id", "product_id", "order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("add_to_cart_order").alias("cart"),
        F.max("order_number").alias("order_number"))
    up = per_order.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("up_orders"),
        (F.sum("cart") / F.sum("n")).alias("up_avg_cart"),
        F.max_by("order_id", "order_number").alias("up_last_order"),
        F.sum("n").alias("up_cnt"))
    user_tot = up.groupBy("user_id").agg(F.sum("up_cnt").alias("u_cnt"))
    return up.join(user_tot, "user_id").select(
        "user_id", "product_id", "up_orders", "up_avg_cart", "up_last_order", "up_cnt",
        (F.col("up_cnt") / F.col("u_cnt")).alias("up_rate"))


def dow_counts(orders: DataFrame) -> DataFrame:
    """Orders per weekday as columns dow_0..dow_6 (conditional sums
    generated from the day list; one pass, no pivot-value discovery job)."""
    return orders.groupBy("user_id").agg(*[
        F.sum(F.when(F.col("order_dow") == d, 1).otherwise(0)).cast("long").alias(f"dow_{d}")
        for d in DOW_DAYS])


def first_orders_by_hour(orders: DataFrame, k: int = 3) -> DataFrame:
    """Each user's first k orders by hour (numeric, D20), ties by number."""
    return top_k(orders.select("user_id", "order_number", "order_hour_of_day"), "user_id",
                 [F.col("order_hour_of_day").asc(), F.col("order_number").asc()], k, rank_col="rank")


def top_products(orders: DataFrame, priors: DataFrame, k: int = 3) -> DataFrame:
    """Each user's k most bought products (lines), ties by product id."""
    cnt = lines_with(orders, priors, "user_id", "product_id") \
        .groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("cnt"))
    return top_k(cnt, "user_id", [F.col("cnt").desc(), F.col("product_id").asc()], k, rank_col="rank")
