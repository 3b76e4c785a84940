"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.operators import text as X
from basketflow.plans.catalog import query
from basketflow.plans.oracle_views import with_views
from basketflow.plans.q_text import _SEGS, _TOKS
from basketflow.session import cut_lineage, scratch_path
from basketflow.sinks.keyed import KeyedTable
from basketflow.sinks import writers as W
from basketflow.sources.tables import orders_view, table

ORDERS_CSV_SCHEMA = ("order_id long, user_id long, eval_set string, order_number int, order_dow int, "
                     "order_hour_of_day int, days_since_prior_order string")


@query("scan_limit", with_views("""
select order_id, user_id, order_dow from v_orders order by order_id limit 300""", "v_orders"))
def q_scan_limit(spark, sf):
    """A repeatable sample -- ordered by key, then limited (the limit is
    the feature; TakeOrderedAndProject keeps 300 rows per task)."""
    return orders_view(spark, sf).select("order_id", "user_id", "order_dow").orderBy("order_id").limit(300)


@query("text_scan", "select unnest(string_split(text, chr(10))) as value from documents")
def q_text_scan(spark, sf):
    """S3: documents stored as text files, read back line by line."""
    path = scratch_path(spark, "textscan")
    table(spark, sf, "documents").select(F.col("text").alias("value")).write.mode("overwrite").text(path)
    return spark.read.text(path)


@query("csv_scan", with_views("select * from v_orders", "v_orders"))
def q_csv_scan(spark, sf):
    """A delimited file read back with an explicit schema (no inference)."""
    path = scratch_path(spark, "csvscan")
    opts = {"header": "true", "nullValue": "\\N", "emptyValue": '""'}
    orders_view(spark, sf).write.mode("overwrite").options(**opts).csv(path)
    return spark.read.schema(ORDERS_CSV_SCHEMA).options(**{**opts, "emptyValue": ""}).csv(path)


@query("text_sink_roundtrip", f"""
select word, count(*) as cnt from (select unnest({_TOKS.format(c='text')}) as word from documents) t
group by word""")
def q_text_sink_roundtrip(spark, sf):
    """K2: word counts saved as ``(word,count)`` text lines and parsed back."""
    path = scratch_path(spark, "pairs")
    W.save_pairs_text(X.word_count(table(spark, sf, "documents"), "text"), "word", "cnt", path)
    return W.read_pairs_text(spark, path, "word", "cnt")


@query("table_overwrite_roundtrip", "select doc_id, array_to_string(" + _SEGS.format(c="text")
       + ", '/') as seg from documents")
def q_table_overwrite(spark, sf):
    """K4: segmented documents written with ``saveAsTable`` (overwrite) and read back."""
    path = scratch_path(spark, "segtable")
    seg = X.segment(table(spark, sf, "documents"), "text").select("doc_id", "seg")
    return W.overwrite_table(seg, "documents_seg", path)


@query("compact_files", "select event_id, user_id, event_type, value from events")
def q_compact_files(spark, sf):
    """K8: rewrite into as many files as the table's size fills; rows unchanged."""
    path = scratch_path(spark, "compact")
    files = W.files_for(spark, f"{sf.rstrip('/')}/events.parquet")
    W.compact(table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), files) \
        .write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("keyed_upsert", with_views("""
select cast(user_id as varchar) as rowkey, arg_max(order_id, order_number) as id_order_id,
       arg_max(order_dow, order_number) as num_order_dow, max(order_number) as order_number
from v_orders group by user_id""", "v_orders"))
def q_keyed_upsert(spark, sf):
    """A snapshot keyed by user built from prior orders, then the
    train/test orders upserted; the newest order per user wins."""
    o = orders_view(spark, sf).select(F.col("user_id").cast("string").alias("rowkey"), "order_number",
                                      F.col("order_id").alias("id_order_id"),
                                      F.col("order_dow").alias("num_order_dow"), "eval_set")
    base = scratch_path(spark, "upsert")
    cols = ["id_order_id", "num_order_dow"]
    snap = W.keyed_upsert(None, o.filter(F.col("eval_set") == "prior"), "rowkey", "order_number", cols,
                          f"{base}/v1")
    return W.keyed_upsert(snap, o.filter(F.col("eval_set") != "prior"), "rowkey", "order_number", cols,
                          f"{base}/v2")


@query("bucket_upsert", with_views("""
select cast(user_id as varchar) as rowkey, arg_max(order_id, order_number) as id_order_id,
       arg_max(order_dow, order_number) as num_order_dow, max(order_number) as order_number
from v_orders group by user_id""", "v_orders"))
def q_bucket_upsert(spark, sf):
    """K6: the same snapshot as a keyed table: prior orders, a compaction, then two small deltas merged on read."""
    o = orders_view(spark, sf).select(F.col("user_id").cast("string").alias("rowkey"), "order_number",
                                      F.col("order_id").alias("id_order_id"),
                                      F.col("order_dow").alias("num_order_dow"), "eval_set")
    o = cut_lineage(o)
    t = KeyedTable(spark, scratch_path(spark, "keyed"), o.schema, "rowkey", "order_number", ["id_order_id", "num_order_dow"], 16)
    t.put(o.filter(F.col("eval_set") == "prior"))
    t.compact()
    for part in ("train", "test"):
        t.put(o.filter(F.col("eval_set") == part))
    return t.read().select("rowkey", "id_order_id", "num_order_dow", "order_number")


@query("compact_packed", "select event_id, user_id, event_type, value from events")
def q_compact_packed(spark, sf):
    """K8: many small files packed into few by the scan itself, without a shuffle; rows unchanged."""
    path = scratch_path(spark, "packed")
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").repartition(24).write.parquet(f"{path}/small")
    W.compact_files(spark, f"{path}/small", f"{path}/large")
    return spark.read.parquet(f"{path}/large")
