"""Label building and split bookkeeping for the next-purchase model
(M1-M3, M5, J4, J10, P6, P8, P11, P12, U1, U3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators import features as feat
from basketflow.session import cut_lineage, partitions_of

MODEL_FEATURES = ("u_avg_day_gap", "user_ord_cnt", "u_prod_dist_cnt", "u_avg_ord_prods",
                  "prod_sum_rod", "prod_rod_rate", "prod_cnt")
# Fixed: a pair lands in the training part when its hash bucket is below 7 of 10.
SPLIT_BUCKETS = 10
SPLIT_TRAIN_BUCKETS = 7
SPLIT_MULTIPLIER = 1000003


def users_by_split(orders: DataFrame) -> DataFrame:
    """M1: distinct users of each split, ``eval_set, user_id``."""
    return orders.select("eval_set", "user_id").distinct()


def users_of(orders: DataFrame, eval_set: str) -> DataFrame:
    return orders.filter(F.col("eval_set") == eval_set).select("user_id").distinct()


def split_coverage(orders: DataFrame) -> DataFrame:
    """Tests the claim "prior users = train users + test users".

    One row of counts: users per split and both set differences of prior
    versus train+test.  Flags per user (one shuffle by user, map-side
    combined), then a global sum: no joins, no driver round trip."""
    flag = lambda s: F.max(F.when(F.col("eval_set") == s, 1).otherwise(0)).alias(s)
    u = orders.groupBy("user_id").agg(flag("prior"), flag("train"), flag("test"))
    tt = F.greatest("train", "test")
    return u.agg(F.sum("prior").cast("long").alias("n_prior"),
                 F.sum("train").cast("long").alias("n_train"),
                 F.sum("test").cast("long").alias("n_test"),
                 F.sum(F.when((F.col("prior") == 1) & (tt == 0), 1).otherwise(0)).cast("long").alias("n_prior_only"),
                 F.sum(F.when((F.col("prior") == 0) & (tt == 1), 1).otherwise(0)).cast("long").alias("n_train_test_only"))


def split_pairs(orders: DataFrame, op: DataFrame, eval_set: str) -> DataFrame:
    """Distinct (user_id, product_id) bought in orders of one split."""
    return feat.lines_with(orders, op.filter(F.col("eval_set") == eval_set), "user_id", "product_id").distinct()


def prior_train_intersect(orders: DataFrame, op: DataFrame) -> DataFrame:
    """Pairs bought both in prior and in train orders."""
    a, b = (feat.lines_with(orders, op.filter(F.col("eval_set") == s), "user_id", "product_id")
            for s in ("prior", "train"))
    return a.intersect(b)


def label_pairs(orders: DataFrame, op: DataFrame) -> DataFrame:
    """M2 (D11): 1 for pairs bought in a train order, 0 for every other
    prior pair (full outer join on the pair, NULL label filled with 0)."""
    good = split_pairs(orders, op, "train").withColumn("label", F.lit(1))
    bad = split_pairs(orders, op, "prior")
    return good.join(bad, ["user_id", "product_id"], "full_outer").na.fill(0, ["label"])


def training_set(orders: DataFrame, op: DataFrame, rows: int = 0) -> DataFrame:
    """M3 (D22): labels joined with user and product features (inner).

    The order lines are joined with their users once and written; one
    aggregate by (user, product) holds everything else: the label (bought in a
    train order), the prior lines and their reorders.  User and product
    features are sums over that small frame.  ``rows`` as in :func:`score_candidates`."""
    wanted = op.filter(F.col("eval_set").isin("prior", "train")).withColumn("rod", F.col("reordered").cast("int"))
    lines = cut_lineage(feat.lines_with(
        orders.select("order_id", "user_id"), wanted, "order_id", "user_id", "product_id", "eval_set", "rod"),
        free=True, partitions=partitions_of(op.sparkSession, rows))
    prior = F.col("eval_set") == "prior"
    pairs = lines.groupBy("user_id", "product_id").agg(
        F.max(F.when(prior, 0).otherwise(1)).alias("label"), F.count_if(prior).alias("n"),
        F.coalesce(F.sum(F.when(prior, F.col("rod"))), F.lit(0)).cast("long").alias("rod"))
    bought = pairs.filter("n > 0")
    baskets = lines.filter(prior).select("user_id", "order_id").distinct().groupBy("user_id") \
        .agg(F.count(F.lit(1)).alias("orders"))
    users = bought.groupBy("user_id").agg(F.count(F.lit(1)).alias("u_prod_dist_cnt"), F.sum("n").alias("lines")) \
        .join(baskets, "user_id").join(feat.user_order_stats(orders), "user_id") \
        .withColumn("u_avg_ord_prods", F.col("lines") / F.col("orders"))
    products = bought.groupBy("product_id").agg(
        F.sum("n").alias("prod_cnt"), F.sum("rod").alias("prod_sum_rod"),
        (F.sum("rod") / F.sum("n")).alias("prod_rod_rate"))
    return (pairs.select("user_id", "product_id", "label").join(users, "user_id").join(products, "product_id")
            .select("user_id", "product_id", "label", *MODEL_FEATURES))


def split_bucket(df: DataFrame) -> F.Column:
    return F.pmod(F.col("user_id") * SPLIT_MULTIPLIER + F.col("product_id"), F.lit(SPLIT_BUCKETS))


def train_test_split(df: DataFrame) -> DataFrame:
    """M5 (D12): a repeatable 70/30 split by a hash of (user, product)."""
    return df.withColumn("split", F.when(split_bucket(df) < SPLIT_TRAIN_BUCKETS, F.lit("train"))
                         .otherwise(F.lit("test")))


def score_candidates(orders: DataFrame, op: DataFrame, rows: int = 0) -> DataFrame:
    """J10 + M8 input: prior pairs of the test users with their features.

    The prior lines are written once and read by pairs, user and product features; ``rows``: about how many lines
    there are, for the partitions of that write."""
    own = [c for c in ("order_id", "user_id", "product_id", "reordered") if c in op.columns]
    priors = cut_lineage(op.filter(F.col("eval_set") == "prior").select(*own), free=True,
                         partitions=partitions_of(op.sparkSession, rows))
    test_users = users_of(orders, "test")
    pairs = feat.user_products(orders, priors).join(test_users, "user_id", "left_semi")
    uf = feat.user_features(orders, priors, with_set=False)
    pf = feat.product_features(priors)
    return pairs.join(uf, "user_id").join(pf, "product_id") \
        .select("user_id", "product_id", *MODEL_FEATURES)
