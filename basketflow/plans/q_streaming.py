"""Streaming queries.

Where the order of arrival does not matter, the stream reads the table's own
files.  Where it does, the rows are written once in order chunks below the
shared folder (``spark.checkpoint.dir``) and handed to the stream chunk by
chunk, one micro-batch each.  Jobs run with ``availableNow``; the sink is read
back as a batch frame.  Several of them are the streaming twin
of a batch query and are checked against the same SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.plans.catalog import query
from basketflow.plans.oracle_views import with_views
from basketflow.plans.q_text import _TOKS
from basketflow.session import scratch_path
from basketflow.sinks.keyed import KeyedTable
from basketflow.sources.tables import event_json, table
from basketflow.streaming import offsets as OFF
from basketflow.streaming import sinks as SK
from basketflow.streaming import state as ST
from basketflow.streaming import windows as WIN
from basketflow.streaming.sources import as_kafka_frame, file_stream, kafka_values, reveal, stage_chunks, table_stream
from basketflow.functions.text import tokens

N_FILES = 4  # micro-batches per staged stream
HOUR_US = 3_600_000_000
TUMBLE = "2 hours"
SLIDE_LEN, SLIDE_STEP = "10 hours", "2 hours"
WATERMARK = "1 day"
GROUP = "g1"
TOPIC = "events"

_CHUNK_CTE = ("v_b", "select min(event_id) as lo, max(event_id) - min(event_id) + 1 as span from events")
_CHUNK = f"cast(((e.event_id - v_b.lo) * {N_FILES}) // v_b.span as integer)"


def _table_stream(spark, sf, name, *cols):
    """The table's own files as a stream of the given columns."""
    return table_stream(spark, f"{sf.rstrip('/')}/{name}.parquet", table(spark, sf, name).schema).select(*cols)


def _by_chunks(spark, df, label, start, order_col="event_id"):
    """Run ``start(stream, base)`` once per order chunk; returns the base folder."""
    base = scratch_path(spark, label)
    stage_chunks(df, f"{base}/staged", N_FILES, order_col)
    for k in range(N_FILES):
        reveal(spark, f"{base}/staged", f"{base}/in", k)
        start(file_stream(spark, f"{base}/in/*", df.schema), base)
    return base


def _events(spark, sf, *cols):
    return table(spark, sf, "events").select(*cols)


def _fmt(expr_us: str) -> str:
    return f"strftime(make_timestamp({expr_us}), '%Y-%m-%d %H:%M:%S')"


# --- event-time windows ---------------------------------------------------------

@query("stream_tumbling_count", f"""
select {_fmt(f'b * {2 * HOUR_US}')} as window_start, {_fmt(f'(b + 1) * {2 * HOUR_US}')} as window_end,
       event_type, count(*) as cnt
from (select event_type, epoch_us(ts) // {2 * HOUR_US} as b from events) t group by b, event_type""")
def q_stream_tumbling(spark, sf):
    base, s = scratch_path(spark, "tumbling"), _table_stream(spark, sf, "events", "ts", "event_type")
    out = f"{base}/out"
    SK.run(WIN.tumbling_counts(s, "ts", "event_type", TUMBLE, WATERMARK), SK.overwrite_result(out),
           f"{base}/ckpt", "tumbling_" + base[-12:], output_mode="complete")
    return spark.read.parquet(out)


@query("stream_sliding_count", f"""
select {_fmt(f'(b - k) * {2 * HOUR_US}')} as window_start,
       {_fmt(f'(b - k) * {2 * HOUR_US} + {10 * HOUR_US}')} as window_end, event_type, count(*) as cnt
from (select event_type, epoch_us(ts) // {2 * HOUR_US} as b, unnest(range(0, 5)) as k from events) t
group by 1, 2, 3""")
def q_stream_sliding(spark, sf):
    base, s = scratch_path(spark, "sliding"), _table_stream(spark, sf, "events", "ts", "event_type")
    out = f"{base}/out"
    SK.run(WIN.sliding_counts(s, "ts", "event_type", SLIDE_LEN, SLIDE_STEP, WATERMARK), SK.overwrite_result(out),
           f"{base}/ckpt", "sliding_" + base[-12:], output_mode="complete")
    return spark.read.parquet(out)


@query("stream_total_count", f"""
select word, count(*) as cnt from (select unnest({_TOKS.format(c='text')}) as word from documents) t
group by word""")
def q_stream_total(spark, sf):
    """Running word totals over a stream of documents = batch word count."""
    base, s = scratch_path(spark, "totals"), _table_stream(spark, sf, "documents", "text")
    words = s.select(F.explode(tokens(F.col("text"))).alias("word"))
    out = f"{base}/out"
    SK.run(WIN.total_counts(words, "word"), SK.overwrite_result(out), f"{base}/ckpt",
           "totals_" + base[-12:], output_mode="complete")
    return spark.read.parquet(out)


@query("stream_restart", "select event_type, count(*) as cnt from events group by event_type")
def q_stream_restart(spark, sf):
    """Stop after every chunk, add the next, restart from the same
    checkpoint; the totals continue instead of starting over."""
    base = _by_chunks(spark, _events(spark, sf, "event_id", "event_type"), "restart", lambda s, base: SK.run(
        WIN.total_counts(s, "event_type"), SK.overwrite_result(f"{base}/out"), f"{base}/ckpt",
        "restart_" + base[-12:], output_mode="complete"))
    return spark.read.parquet(f"{base}/out")


@query("stream_batch_files", with_views(f"""
select {_CHUNK} as batch_id, e.event_type, count(*) as cnt
from events e join v_b on true group by 1, 2""", extra=[_CHUNK_CTE]))
def q_stream_batch_files(spark, sf):
    """K3 + T1: counts per micro-batch, one directory per batch."""
    def start(s, base):
        write = SK.per_batch_dirs(f"{base}/out")
        # counted inside the batch: no state carried from one batch to the next
        SK.run(s, lambda df, bid: write(WIN.total_counts(df, "event_type"), bid), f"{base}/ckpt", "perbatch_" + base[-12:])

    base = _by_chunks(spark, _events(spark, sf, "event_id", "event_type"), "perbatch", start)
    return spark.read.schema("event_type string, cnt long, batch_id int").parquet(f"{base}/out")


@query("stream_file_source", "select event_id, user_id, event_type, value from events")
def q_stream_file_source(spark, sf):
    """Rows arriving as files, written by the exactly-once file sink."""
    base = scratch_path(spark, "filesrc")
    s = _table_stream(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    out = f"{base}/out"
    SK.run(s, None, f"{base}/ckpt", "filesrc_" + base[-12:], sink_path=out)
    return spark.read.parquet(out)


# --- windows that close, totals that are merged, batches that are committed ---------

CLOSE_DELAY, CLOSE_WINDOW = "1 day", "2 hours"
# every tenth event arrives one chunk late
_ARRIVAL = f"""
select e.*, least({_CHUNK} + case when e.event_id % 10 = 0 then 1 else 0 end, {N_FILES - 1}) as arrival,
       epoch_us(e.ts) // {2 * HOUR_US} as b
from events e join v_b on true"""
_SEEN = f"""
select c.k, max(epoch_us(a.ts)) - {24 * HOUR_US} as mark
from (select unnest(range(1, {N_FILES + 1})) as k) c join v_a a on a.arrival < c.k group by c.k"""
_LATE = f"""
select a.*, coalesce((a.b + 1) * {2 * HOUR_US} <= s.mark // 1000 * 1000, false) as late
from v_a a left join v_s s on s.k = a.arrival"""


def _late_arrivals(spark, sf, label, start):
    """Chunks in order of arrival, handed to ``start(stream, base)`` one by one."""
    ev = _events(spark, sf, "event_id", "event_type", "ts")
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    chunk = F.expr(f"least(cast(((cast(event_id as decimal(20,0)) - {lo or 0}) * {N_FILES}) div {(hi or 0) - (lo or 0) + 1} as int)"
                   f" + if(event_id % 10 = 0, 1, 0), {N_FILES - 1})")
    return _by_chunks(spark, ev.withColumn("arrival", chunk), label, start, "arrival")


def _closed_windows(spark, sf):
    """Windowed counts that close (append) and the late rows beside them; returns the folder."""
    marks = [None]

    def start(s, base):
        # rows that the counting query will drop: its watermark of the last run decides
        SK.run(s, SK.late_rows(f"{base}/late", "ts", CLOSE_WINDOW, marks[-1]), f"{base}/ckpt-late", "late_" + base[-12:])
        q = SK.run(WIN.tumbling_counts(s, "ts", "event_type", CLOSE_WINDOW, CLOSE_DELAY), None, f"{base}/ckpt",
                   "closed_" + base[-12:], sink_path=f"{base}/out")
        seen = [p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in (p["eventTime"] or {})]
        marks.append(max(seen, default=marks[-1]))

    return _late_arrivals(spark, sf, "closed", start)


@query("stream_closed_windows", with_views(f"""
select {_fmt(f'b * {2 * HOUR_US}')} as window_start, {_fmt(f'(b + 1) * {2 * HOUR_US}')} as window_end, event_type, count(*) as cnt
from v_l where not late and (b + 1) * {2 * HOUR_US} <= (select mark // 1000 * 1000 from v_s where k = {N_FILES})
group by b, event_type""", extra=[_CHUNK_CTE, ("v_a", _ARRIVAL), ("v_s", _SEEN), ("v_l", _LATE)]))
def q_stream_closed_windows(spark, sf):
    """A window's count is written once, when the watermark has passed its end, and its state is freed."""
    return spark.read.schema("window_start string, window_end string, event_type string, cnt long") \
        .parquet(_closed_windows(spark, sf) + "/out")


@query("stream_late_rows", with_views("select event_id, event_type from v_l where late",
                                      extra=[_CHUNK_CTE, ("v_a", _ARRIVAL), ("v_s", _SEEN), ("v_l", _LATE)]))
def q_stream_late_rows(spark, sf):
    """Rows that came after their window had closed."""
    return spark.read.schema("event_id long, event_type string, batch_id int") \
        .parquet(_closed_windows(spark, sf) + "/late").select("event_id", "event_type")


@query("stream_total_merge", f"""
select word, count(*) as cnt from (select unnest({_TOKS.format(c='text')}) as word from documents) t
group by word""")
def q_stream_total_merge(spark, sf):
    """Each batch's changed totals go into a keyed table as a delta; nothing else is rewritten."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    box = {}

    def start(s, base):
        words = s.select(F.explode(tokens(F.col("text"))).alias("word"))
        box["t"] = box.get("t") or KeyedTable(spark, f"{base}/table", "word string, batch long, cnt long", "word", "batch", ["cnt"])
        SK.run(WIN.total_counts(words, "word"), SK.merge_totals(box["t"], "word", "cnt"), f"{base}/ckpt",
               "merge_" + base[-12:], output_mode="update")

    _by_chunks(spark, docs, "merge", start, "doc_id")
    return box["t"].read().select("word", "cnt")


@query("append_once", """
select cast(event_id as varchar) as order_id, cast(user_id as varchar) as user_id, strftime(ts, '%Y%m%d') as dt
from events""")
def q_append_once(spark, sf):
    """K5: every batch is run twice, and after each a batch breaks off before its commit; every row is there once."""
    def start(s, base):
        once = SK.append_once(f"{base}/table")

        def twice(df, batch_id):
            once(df, batch_id)
            once(df, batch_id)
            df.limit(5).write.parquet(f"{base}/table/rows/broken-{batch_id}")

        SK.run(s.select("order_id", "user_id", "dt"), twice, f"{base}/ckpt", "once_" + base[-12:])

    ev = _events(spark, sf, "event_id", "user_id", "ts").select(
        "event_id", F.col("event_id").cast("string").alias("order_id"), F.col("user_id").cast("string").alias("user_id"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd").alias("dt"))
    base = _by_chunks(spark, ev, "once", start)
    return SK.committed(spark, f"{base}/table", "order_id string, user_id string, dt string")


@query("stream_state_read", "select event_type, count(*) as cnt from events group by event_type")
def q_stream_state_read(spark, sf):
    """The state of a stopped stream, read from its checkpoint, is the count of all it has seen."""
    base = _by_chunks(spark, _events(spark, sf, "event_id", "event_type"), "state", lambda s, base: SK.run(
        WIN.total_counts(s, "event_type"), SK.per_batch_dirs(f"{base}/out"), f"{base}/ckpt", "state_" + base[-12:],
        output_mode="update"))
    return spark.read.format("statestore").load(f"{base}/ckpt").select("key.event_type", F.col("value.count").alias("cnt"))


RATE_FILES, RATE_LIMIT = 8, 2


@query("stream_rate_limit", with_views(f"""
select nth, sum(n) as files_rows from (
  select (row_number() over (order by f) - 1) // {RATE_LIMIT} as nth, n from (
    select cast(((e.event_id - v_b.lo) * {RATE_FILES}) // v_b.span as integer) as f, count(*) as n
    from events e join v_b on true group by 1) x) y group by nth""", extra=[_CHUNK_CTE]))
def q_stream_rate_limit(spark, sf):
    """A file stream takes at most two files a batch; the rows of every batch, from the query's own progress."""
    base = scratch_path(spark, "rate")
    ev = _events(spark, sf, "event_id", "event_type")
    stage_chunks(ev, f"{base}/staged", RATE_FILES, "event_id")
    one_file = spark.read.parquet(f"{base}/staged").repartition(1, "_chunk")
    for k in range(RATE_FILES):                       # files come one after another, each complete
        rows = one_file.filter(F.col("_chunk") == k).drop("_chunk").coalesce(1)
        if not rows.isEmpty():
            rows.write.parquet(f"{base}/in/{k:05d}")
    q = SK.run(file_stream(spark, f"{base}/in/*", ev.schema, max_files_per_trigger=RATE_LIMIT), SK.per_batch_dirs(f"{base}/out"),
               f"{base}/ckpt", "rate_" + base[-12:])
    taken = [(p["batchId"], p["numInputRows"]) for p in q.recentProgress if p["numInputRows"]]
    seen = spark.read.schema("event_id long, event_type string, batch_id long").parquet(f"{base}/out") \
        .groupBy("batch_id").agg(F.count(F.lit(1)).alias("files_rows"))
    return spark.createDataFrame(taken, "batch_id long, rows long").join(seen, "batch_id") \
        .filter("rows = files_rows").select(F.col("batch_id").alias("nth"), "files_rows")


# --- order-dependent state --------------------------------------------------------

RUNNING_SQL = """
select event_id, event_type,
       count(*) over (partition by event_type order by event_id rows between unbounded preceding and current row)
       as running_cnt
from events"""
COUNT_WINDOW_SQL = """
select event_type, event_id, rn, cast(least(rn, 10) as bigint) as window_n, cast(s as double) as window_sum
from (select event_type, event_id,
             row_number() over (partition by event_type order by event_id) as rn,
             sum(cast(value as decimal(18,2))) over (partition by event_type order by event_id
                                                     rows between 9 preceding and current row) as s
      from events) t
where rn % 2 = 0"""


@query("running_count", RUNNING_SQL)
def q_running_count(spark, sf):
    return ST.running_count(_events(spark, sf, "event_id", "event_type"), "event_type", "event_id")


@query("stream_running_count", RUNNING_SQL)
def q_stream_running_count(spark, sf):
    base = _by_chunks(spark, _events(spark, sf, "event_id", "event_type"), "runcnt", lambda s, base: SK.run(
        s, ST.running_count_batches(f"{base}/out", f"{base}/state", "event_type", "event_id"), f"{base}/ckpt",
        "runcnt_" + base[-12:]))
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query("count_window", COUNT_WINDOW_SQL)
def q_count_window(spark, sf):
    return ST.count_window(_events(spark, sf, "event_id", "event_type", "value"), "event_type", "event_id", "value")


@query("stream_count_window", COUNT_WINDOW_SQL)
def q_stream_count_window(spark, sf):
    base = _by_chunks(
        spark, _events(spark, sf, "event_id", "event_type", "value"), "cntwin", lambda s, base: SK.run(
            s, ST.count_window_batches(f"{base}/out", f"{base}/state", "event_type", "event_id", "value"),
            f"{base}/ckpt", "cntwin_" + base[-12:]))
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query("count_window_all", """
select window_no, cnt, first_id, last_id, value_sum from (
  select (rn - 1) // 5 as window_no, count(*) as cnt, min(event_id) as first_id, max(event_id) as last_id,
         cast(sum(cast(value as decimal(18,2))) as double) as value_sum
  from (select event_id, value, row_number() over (order by event_id) as rn from events) t
  group by 1) g
where cnt = 5""")
def q_count_window_all(spark, sf):
    return ST.count_window_all(_events(spark, sf, "event_id", "value"), "event_id", "value", 5)


# --- messages, tables, offsets ----------------------------------------------------

ORDER_MSG_SCHEMA = ("order_id string, user_id string, eval_set string, order_number string, "
                    "order_dow string, hour string, day string")


def parse_orders(df, col: str = "msg"):
    """JSON messages -> all-string order records in ``m``; a message that
    is not JSON gives all-NULL fields and its text in ``m._corrupt``."""
    return df.withColumn("m", F.from_json(F.col(col), ORDER_MSG_SCHEMA + ", _corrupt string",
                                          {"columnNameOfCorruptRecord": "_corrupt"}))


def split_malformed(parsed):
    """Keep malformed messages aside: (good rows, malformed rows)."""
    bad = F.col("m._corrupt").isNotNull()
    return parsed.filter(~bad), parsed.filter(bad)


@query("json_orders", with_views("""
select event_id, json_extract_string(msg, '$.order_id') as order_id,
       json_extract_string(msg, '$.user_id') as user_id, json_extract_string(msg, '$.eval_set') as eval_set,
       not json_valid(msg) as malformed
from v_event_json""", "v_event_json"))
def q_json_orders(spark, sf):
    p = parse_orders(event_json(spark, sf))
    return p.select("event_id", "m.order_id", "m.user_id", "m.eval_set",
                    F.col("m._corrupt").isNotNull().alias("malformed"))


@query("partitioned_append", """
select cast(event_id as varchar) as order_id, cast(user_id as varchar) as user_id, strftime(ts, '%Y%m%d') as dt
from events""")
def q_partitioned_append(spark, sf):
    """JSON messages from a stream appended into a ``dt``-partitioned
    table, batch by batch (idempotent per batch)."""
    base = scratch_path(spark, "partappend")
    s = _table_stream(spark, sf, "events", "event_id", "user_id", "event_type", "ts")
    msgs = s.select(F.to_json(F.struct(F.col("event_id").alias("order_id"), "user_id",
                                       F.col("event_type").alias("eval_set"))).alias("msg"), "ts")
    rows = parse_orders(msgs).select("m.order_id", "m.user_id",
                                     F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd").alias("dt"))
    out = f"{base}/table"
    SK.run(rows, SK.partitioned_append(out, ["dt"]), f"{base}/ckpt", "partappend_" + base[-12:])
    return spark.read.schema("order_id string, user_id string, dt string, batch_id int").parquet(out) \
        .select("order_id", "user_id", "dt")


@query("catalog_append", """
select cast(event_id as varchar) as order_id, cast(user_id as varchar) as user_id, strftime(ts, '%Y%m%d') as dt
from events""")
def q_catalog_append(spark, sf):
    """K5: JSON messages from a stream inserted into a ``dt``-partitioned catalog table."""
    base = scratch_path(spark, "catappend")
    name = "orders_" + base[-12:]
    spark.sql(f"create table {name} (order_id string, user_id string, dt string) using parquet "
              f"partitioned by (dt) location '{base}/table'")
    s = _table_stream(spark, sf, "events", "event_id", "user_id", "event_type", "ts")
    msgs = s.select(F.to_json(F.struct(F.col("event_id").alias("order_id"), "user_id",
                                       F.col("event_type").alias("eval_set"))).alias("msg"), "ts")
    rows = parse_orders(msgs).select(F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd").alias("dt"),
                                     "m.user_id", "m.order_id")
    SK.run(rows, SK.insert_into(name), f"{base}/ckpt", "catappend_" + base[-12:])
    return spark.table(name)


def _kafka_frame(spark, sf):
    return as_kafka_frame(event_json(spark, sf), TOPIC, "part", "event_id", "msg")


@query("kafka_value_projection", with_views(f"""
select '{TOPIC}' as topic, part as "partition", event_id as "offset", msg as value from v_event_json""",
                                            "v_event_json"))
def q_kafka_value_projection(spark, sf):
    return kafka_values(_kafka_frame(spark, sf), with_meta=True)


@query("offset_ledger", with_views(f"""
select '{GROUP}' as group_id, {_CHUNK} as batch_id, '{TOPIC}' as topic, cast(e.user_id % 4 as integer) as "partition",
       min(e.event_id) as from_offset, max(e.event_id) + 1 as until_offset
from events e join v_b on true group by 1, 2, 3, 4""", extra=[_CHUNK_CTE]))
def q_offset_ledger(spark, sf):
    """K7: per batch, output first, then the consumed ranges to the ledger."""
    def start(s, base):
        kafka = as_kafka_frame(s, TOPIC, "part", "event_id", "msg")
        result = SK.per_batch_dirs(f"{base}/counts")
        counted = lambda df, bid: result(df.groupBy("partition").count(), bid)
        SK.run(kafka, SK.with_ledger(counted, f"{base}/ledger", GROUP), f"{base}/ckpt", "ledger_" + base[-12:])

    ledger = _by_chunks(spark, event_json(spark, sf), "ledger", start) + "/ledger"
    return spark.read.schema("topic string, partition int, from_offset long, until_offset long, "
                             "group_id string, batch_id int").parquet(ledger) \
        .select("group_id", "batch_id", "topic", "partition", "from_offset", "until_offset")


def _committed(bounds):
    """Committed offsets derived from the bounds by a fixed rule, so that
    every status occurs: partition % 4 == 0 inside, 1 below, 2 above, 3 none."""
    p = F.col("partition") % 4
    c = (F.when(p == 0, F.col("earliest") + (F.col("latest") - F.col("earliest")) / 2)
          .when(p == 1, F.col("earliest") - 1 - F.col("partition"))
          .when(p == 2, F.col("latest") + 1 + F.col("partition")))
    return bounds.select("topic", "partition", F.floor(c).cast("long").alias("committed")) \
                 .filter(F.col("committed").isNotNull())


_BOUNDS = ("bounds", f"""
select '{TOPIC}' as topic, part as "partition", min(event_id) as earliest, max(event_id) + 1 as latest
from v_event_json group by part""")
_COMMITTED = ("c", """
select topic, "partition",
       cast(floor(case when "partition" % 4 = 0 then earliest + (latest - earliest) / 2
                       when "partition" % 4 = 1 then earliest - 1 - "partition"
                       when "partition" % 4 = 2 then latest + 1 + "partition" end) as bigint) as committed
from bounds""")


@query("offset_resume", with_views("""
select b.topic, b."partition", b.earliest, b.latest, coalesce(c.committed, -1) as committed,
       case when c.committed is null then b.latest else greatest(b.earliest, least(c.committed, b.latest)) end
         as start_offset,
       case when c.committed is null then 'missing' when c.committed < b.earliest then 'below'
            when c.committed > b.latest then 'above' else 'ok' end as status
from bounds b left join c on b.topic = c.topic and b."partition" = c."partition"
""", "v_event_json", extra=[_BOUNDS, _COMMITTED]))
def q_offset_resume(spark, sf):
    bounds = OFF.partition_bounds(_kafka_frame(spark, sf))
    return OFF.resume_offsets(bounds, _committed(bounds), default="latest")


@query("offset_range_replay", with_views(f"""
select {_CHUNK} as batch_id, '{TOPIC}' as topic, cast(e.user_id % 4 as integer) as "partition",
       e.event_id as "offset", m.msg as value
from events e join v_b on true join v_event_json m on m.event_id = e.event_id""",
                                         "v_event_json", extra=[_CHUNK_CTE]))
def q_offset_range_replay(spark, sf):
    """Replay stored messages by per-batch offset ranges (range join)."""
    k = _kafka_frame(spark, sf)
    lo, hi = k.agg(F.min("offset"), F.max("offset")).first()
    span = hi - lo + 1
    tagged = k.withColumn("batch_id", F.expr(f"cast(((offset - {lo}) * {N_FILES}) div {span} as int)"))
    ranges = tagged.groupBy("batch_id", "topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
    msgs = kafka_values(k, with_meta=True)
    r = OFF.replay_ranges(msgs, ranges, bucket=1024)
    return r.select("batch_id", "topic", "partition", "offset", "value")
