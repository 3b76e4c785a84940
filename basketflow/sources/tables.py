"""Table loaders and the logical views the operators work on.

The driver ships TPC-H-like tables; the operators speak the purchase /
rating / sentence vocabulary.  Each view below is a plain DataFrame plan
over the parquet scan, so Catalyst prunes columns and pushes filters into
the reader whatever the caller selects afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.session import cut_lineage, partitions_of

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()

# The view definitions below must agree with the SQL oracle.
# 1995-01-01 is a Sunday, so day offsets modulo 7 give 0=Sunday .. 6=Saturday.
DOW_ANCHOR = "1995-01-01"
LABEL_SEPARATOR = "##@@##"
EVAL_SETS = ("prior", "train", "test")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (parquet scan, nothing read yet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, item_id, rating``: one row per (customer, part) pair.

    rating = 1 + floor((quantity - 1) / 10), the best rating of the pair.
    A rating needs a user and an item: the not-null filters are stated here,
    so every branch that reads the ratings has the same plan and the
    aggregate's exchange is computed once and reused.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter(F.col("o_custkey").isNotNull())
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity") \
        .filter(F.col("l_partkey").isNotNull())
    r = (o.join(li, o.o_orderkey == li.l_orderkey)
         .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
         .agg(F.max(F.floor((F.col("l_quantity") - 1) / 10).cast("int") + 1).alias("rating")))
    return r


def _days_between(a: Column, b: Column) -> Column:
    return F.datediff(b.cast("date"), a.cast("date"))


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, user_id, order_dow: the order columns that need no numbering."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                    _order_dow(F.col("o_orderdate")).alias("order_dow"))


def _order_dow(date: Column) -> Column:
    return F.pmod(_days_between(F.lit(DOW_ANCHOR), date), F.lit(7)).cast("int")


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase-order table: order_id, user_id, eval_set, order_number,
    order_dow (0=Sunday), order_hour_of_day, days_since_prior_order ('' or 'N.0').

    A user's last order is ``train`` or ``test`` (by user id modulo 3), all
    earlier ones ``prior``.  Numbering orders per user must not put a user
    with a huge share of the orders into one task, so the user's orders are
    sliced by order day (monotone in the order ``(date, order key)``):

    * per (user, day): count and last date -- a map-side-combined aggregate;
    * per user over those small rows: orders before the day, the user's
      total, and the previous day's last date;
    * per (user, day): ``row_number`` plus the offset, ``lag`` or the previous
      day's last date.

    No window ever spans more than one (user, day) of orders, and nothing is
    checkpointed or sampled: the slices are a plain function of the row.
    """
    day = F.col("o_orderdate").cast("date")
    # orders without a customer or a date are one user's, one day's: the keys are made non-null
    # once, so aggregate, join and windows share one partitioning
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.coalesce("o_custkey", F.lit(0)).alias("_k"),
        F.col("o_custkey").isNull().alias("_nk"), F.coalesce(day, F.lit("0001-01-01").cast("date")).alias("_d"),
        day.isNull().alias("_nd"))
    keys = ["_k", "_nk", "_d", "_nd"]
    tot = o.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.max("o_orderdate").alias("_last"))
    by_user = Window.partitionBy("_k", "_nk").orderBy(F.col("_nd").desc(), "_d")
    off = tot.select(
        *keys,
        F.coalesce(F.sum("_c").over(by_user.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"),
        F.sum("_c").over(Window.partitionBy("_k", "_nk")).alias("cnt"),
        F.lag("_last").over(by_user).alias("_prev_last"))
    in_day = Window.partitionBy(*keys).orderBy("o_orderdate", "o_orderkey")
    s = (o.join(off, keys)
          .withColumn("n", F.row_number().over(in_day) + F.col("_o"))
          .withColumn("p", F.coalesce(F.lag("o_orderdate").over(in_day), F.col("_prev_last"))))
    return s.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("n") < F.col("cnt"), F.lit("prior"))
         .when(F.col("o_custkey") % 3 == 0, F.lit("test"))
         .otherwise(F.lit("train")).alias("eval_set"),
        F.col("n").cast("int").alias("order_number"),
        _order_dow(F.col("o_orderdate")).alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
        F.when(F.col("p").isNull(), F.lit(""))
         .otherwise(F.concat(_days_between(F.col("p"), F.col("o_orderdate")).cast("string"),
                             F.lit(".0"))).alias("days_since_prior_order"),
    )


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders view, written: numbered once, read by every branch.  Its windows hold several copies of the orders, so
    a task takes a quarter of the usual rows."""
    n = partitions_of(spark, 4 * table(spark, sf_dir, "orders").count())
    return cut_lineage(orders_view(spark, sf_dir), free=True, partitions=n)


def order_products(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, users: bool = False,
                   reordered: bool = True) -> DataFrame:
    """order_id, product_id, add_to_cart_order, eval_set, reordered ('0'/'1').

    ``users``: the lines keep their order's user_id and order_number, so features
    need no second join; ``reordered=False`` spares that column and its join.

    reordered = the product was bought by the same user in an earlier order.
    ``min(order_number)`` per (user, product) is an aggregate joined back
    rather than a window, so a user or product holding a large share of the
    rows is pre-aggregated map-side and the join can be split by AQE.
    """
    ov = orders if orders is not None else orders_view(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    lines = (li.join(ov.select("order_id", "user_id", "eval_set", "order_number"),
                     li.l_orderkey == F.col("order_id"))
             .select("order_id", "user_id", F.col("l_partkey").alias("product_id"),
                     F.col("l_linenumber").alias("add_to_cart_order"), "eval_set", "order_number"))
    cols = ["order_id", "product_id", "add_to_cart_order", "eval_set", *(["user_id", "order_number"] if users else [])]
    if not reordered:
        return lines.select(*cols)
    first = lines.groupBy("user_id", "product_id").agg(F.min("order_number").alias("first_no"))
    return (lines.join(first, ["user_id", "product_id"])
            .select(*cols, F.when(F.col("order_number") > F.col("first_no"), F.lit("1"))
                            .otherwise(F.lit("0")).alias("reordered")))


def split_products(op: DataFrame, eval_set: str) -> DataFrame:
    """``order_products_prior`` / ``order_products_train`` style subsets."""
    return op.filter(F.col("eval_set") == eval_set).drop("eval_set")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by ``key`` if the scan has fewer splits than the cluster has cores (a table in one row group);
    any larger table is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def clean_text(c: Column) -> Column:
    """Whitespace-normalised text: the words split on runs of white space,
    empties dropped, joined by one blank -- one codegen'd split (a single pass
    of the regex), no per-word lambda."""
    return F.array_join(F.array_remove(F.split(c, r"\s+"), ""), " ")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sentence (= words by blank + separator + label), label."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    return d.select("doc_id",
                    F.concat(clean_text(F.col("text")), F.lit(LABEL_SEPARATOR), F.col("lang")).alias("sentence"),
                    F.col("lang").alias("label"))


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-like messages: event_id (offset), part (partition 0..3), msg (JSON)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return e.select(
        "event_id",
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("part"),
        F.to_json(F.struct(F.col("event_id").alias("order_id"), F.col("user_id"),
                           F.col("event_type").alias("eval_set"))).alias("msg"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as a zoned timestamp (watermarks need one)."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))
