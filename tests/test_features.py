from pyspark.sql import functions as F

from basketflow.operators import features as feat
from basketflow.operators import labels as lab
from basketflow.session import cut_lineage
from basketflow.sources.tables import order_products, orders_view


def test_days_since_prior_ansi_safe(spark):
    df = spark.createDataFrame([("",), ("15.0",), ("junk",), (None,), ("7",)], "d string")
    got = [r[0] for r in df.select(feat.days_since_prior(F.col("d"))).collect()]
    assert got == [0, 15, 0, 0, 7]


def test_product_set_sorted_and_distinct(spark):
    orders = spark.createDataFrame([(1, 10), (2, 10)], "order_id long, user_id long")
    priors = spark.createDataFrame([(1, 30, 1, "0"), (1, 4, 2, "0"), (2, 30, 1, "1")],
                                   "order_id long, product_id long, add_to_cart_order int, reordered string")
    row = feat.user_product_set(orders, priors).collect()[0]
    assert row.u_prod_dist_cnt == 2 and row.u_prod_records == "4,30"


def test_views_shape(spark, sf):
    o = orders_view(spark, sf)
    assert set(r.eval_set for r in o.select("eval_set").distinct().collect()) <= {"prior", "train", "test"}
    assert o.filter((F.col("order_dow") < 0) | (F.col("order_dow") > 6)).count() == 0
    op = order_products(spark, sf, o)
    assert op.filter(~F.col("reordered").isin("0", "1")).count() == 0


def test_split_is_repeatable(spark, sf):
    o = orders_view(spark, sf)
    ts = lab.training_set(o, order_products(spark, sf, o))
    a = lab.train_test_split(ts).select("user_id", "product_id", "split")
    b = lab.train_test_split(ts).select("user_id", "product_id", "split")
    assert a.exceptAll(b).count() == 0
    share = a.filter(F.col("split") == "train").count() / a.count()
    assert 0.6 < share < 0.8


def test_label_pairs_cover_both_sets(spark, sf):
    o = orders_view(spark, sf)
    op = order_products(spark, sf, o)
    lp = lab.label_pairs(o, op)
    assert lp.filter(F.col("label").isNull()).count() == 0
    good = lab.split_pairs(o, op, "train").count()
    assert lp.filter(F.col("label") == 1).count() == good


def test_lines_that_carry_their_user_are_not_joined_again(spark, sf):
    """Features are the same from lines with and without the order's columns; the plan joins lines and orders once
    in each branch (Spark reuses the repeated exchanges when it runs)."""
    o = cut_lineage(orders_view(spark, sf))
    plain = order_products(spark, sf, o).filter("eval_set = 'prior'")
    rich = order_products(spark, sf, o, users=True, reordered=False).filter("eval_set = 'prior'")
    for f in (feat.user_features, feat.user_product_features, feat.user_product_set, feat.user_basket_size,
              feat.top_products):
        a, b = f(o, plain), f(o, rich)
        assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).isEmpty(), f.__name__
    plan = feat.user_features(o, rich)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 8
    assert "reordered" not in rich.columns


class _FileWriter:
    """Test double for an external store: one JSON-lines file per task."""

    def __init__(self, base, pid):
        import os
        os.makedirs(base, exist_ok=True)
        self.f = open(f"{base}/part-{pid}.jsonl", "w")
        self.batches = 0

    def put(self, rows):
        import json
        self.batches += 1
        for r in rows:
            self.f.write(json.dumps(r.asDict()) + "\n")

    def close(self):
        self.f.close()


def test_partition_batched_writer(spark, sf):
    import glob
    import json

    from basketflow.session import scratch_path
    from basketflow.sinks.writers import latest_per_key, write_partitions
    o = orders_view(spark, sf).select(F.col("user_id").cast("string").alias("rowkey"), "order_number",
                                      F.col("order_id").alias("id_order_id"),
                                      F.col("order_dow").alias("num_order_dow"))
    latest = latest_per_key(o, "rowkey", "order_number", ["id_order_id", "num_order_dow"])
    base = scratch_path(spark, "t-puts")
    write_partitions(latest, lambda pid: _FileWriter(base, pid), batch_size=7)
    got = [json.loads(line) for p in glob.glob(f"{base}/part-*.jsonl") for line in open(p)]
    assert len(got) == latest.count() == len({g["rowkey"] for g in got})


def test_orders_view_with_a_dominant_user(spark, sf):
    """One user holds a third of all orders: numbering, totals and gaps must
    equal the plain per-user window definition."""
    from pyspark.sql import Window

    from basketflow.session import scratch_path
    src = spark.read.parquet(f"{sf}/orders.parquet")
    hot = src.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
    base = scratch_path(spark, "t-hotuser")
    hot.write.mode("overwrite").parquet(f"{base}/orders.parquet")
    got = orders_view(spark, base)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    want = hot.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.row_number().over(w).cast("int").alias("order_number"),
        F.count(F.lit(1)).over(Window.partitionBy("o_custkey")).alias("cnt"),
        F.datediff(F.col("o_orderdate").cast("date"),
                   F.lag("o_orderdate").over(w).cast("date")).alias("gap"))
    want = want.select("order_id", "user_id", "order_number",
                       F.when(F.col("order_number") < F.col("cnt"), "prior")
                        .when(F.col("user_id") % 3 == 0, "test").otherwise("train").alias("eval_set"),
                       F.when(F.col("gap").isNull(), "").otherwise(F.concat(F.col("gap").cast("string"), F.lit(".0")))
                        .alias("days_since_prior_order"))
    a = got.select(*want.columns)
    assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0
    assert got.filter(F.col("user_id") == 7).count() == src.filter(F.col("o_orderkey") % 3 == 0).count() + \
        src.filter((F.col("o_orderkey") % 3 != 0) & (F.col("o_custkey") == 7)).count()


def test_compaction_writes_the_requested_number_of_files(spark, sf):
    import glob

    from basketflow.session import scratch_path
    from basketflow.sinks.writers import compact
    ev = spark.read.parquet(f"{sf}/events.parquet").repartition(7)
    path = scratch_path(spark, "t-compact")
    compact(ev, 2).write.mode("overwrite").parquet(path)
    files = [f for f in glob.glob(f"{path}/*.parquet")]
    assert len(files) == 2
    assert spark.read.parquet(path).count() == ev.count()


def test_more_rows_get_more_partitions(spark, sf, monkeypatch):
    """Shuffles follow the table's size, results stay; the session's own settings are left as they were."""
    import __spark_entry__ as E
    from basketflow import session
    before = {k: spark.conf.get(k) for k in (session.SHUFFLE_PARTITIONS, session.MERGING)}
    names = ("user_product_features", "score_candidates", "lr_score_test_users")
    plain = {n: sorted(map(str, E.queries()[n](spark, sf).drop("p1").collect())) for n in names}
    monkeypatch.setattr(session, "PARTITION_ROWS", 500)
    for n in names:
        df = E.queries()[n](spark, sf)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()    # the last step is written, too
        assert sorted(map(str, df.drop("p1").collect())) == plain[n]
    assert session.partitions_of(spark, 6000) == 12 and session.partitions_of(spark, 3000) is None
    assert {k: spark.conf.get(k) for k in before} == before


def test_prior_lines_of_candidates_are_joined_once(spark, sf):
    from basketflow.operators import labels as lab
    from basketflow.plans.q_labels import _o
    plan = lab.score_candidates(*_o(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan
