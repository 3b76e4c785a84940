import json

from pyspark.sql import functions as F

from basketflow.operators.prefix import running_totals
from basketflow.operators.ranges import range_join
from basketflow.plans.q_streaming import ORDER_MSG_SCHEMA, parse_orders
from basketflow.session import scratch_path
from basketflow.sources.tables import table
from basketflow.streaming import offsets as OFF
from basketflow.streaming import sinks as SK
from basketflow.streaming import state as ST
from basketflow.streaming.sources import file_stream, kafka_options, reveal, stage_chunks


def test_offset_clamp_statuses(spark):
    bounds = spark.createDataFrame([("t", 0, 10, 20), ("t", 1, 10, 20), ("t", 2, 10, 20), ("t", 3, 10, 20)],
                                   "topic string, partition int, earliest long, latest long")
    committed = spark.createDataFrame([("t", 0, 15), ("t", 1, 3), ("t", 2, 99)],
                                      "topic string, partition int, committed long")
    got = {r.partition: (r.start_offset, r.status)
           for r in OFF.resume_offsets(bounds, committed, default="earliest").collect()}
    assert got == {0: (15, "ok"), 1: (10, "below"), 2: (20, "above"), 3: (10, "missing")}
    js = json.loads(OFF.starting_offsets_json(OFF.resume_offsets(bounds, committed)))
    assert js == {"t": {"0": 15, "1": 10, "2": 20, "3": 20}}


def test_kafka_options():
    o = kafka_options("b:9092", ["a", "b"], group="g", max_offsets_per_trigger=100)
    assert o["subscribe"] == "a,b" and o["kafka.group.id"] == "g" and o["maxOffsetsPerTrigger"] == "100"
    o2 = kafka_options("b:9092", "a", assign={"a": [1, 0]}, starting_offsets='{"a":{"0":5}}')
    assert json.loads(o2["assign"]) == {"a": [0, 1]} and "subscribe" not in o2


def test_json_messages(spark):
    msgs = ['{"order_id": 2398795, "user_id": 1, "eval_set": "prior", "order_number": 2, '
            '"order_dow": 3, "hour": 7, "day": 15.0}', "not json", '{"order_id": 5}']
    df = spark.createDataFrame([(m,) for m in msgs], "msg string")
    rows = parse_orders(df).select("m.*").collect()
    assert rows[0].order_id == "2398795" and rows[0].day == "15.0" and rows[0].user_id == "1"
    assert rows[1].order_id is None and rows[1]._corrupt == "not json"
    assert rows[0]._corrupt is None and rows[2]._corrupt is None
    from basketflow.plans.q_streaming import split_malformed
    good, bad = split_malformed(parse_orders(df))
    assert good.count() == 2 and bad.count() == 1
    assert rows[2].order_id == "5" and rows[2].user_id is None
    assert len(ORDER_MSG_SCHEMA.split(",")) == 7


def test_range_join_matches_bruteforce(spark):
    pts = spark.createDataFrame([(k, x) for k in (0, 1) for x in range(0, 300, 7)], "k int, x long")
    rng = spark.createDataFrame([(0, 5, 40, "a"), (0, 40, 41, "b"), (1, 0, 299, "c"), (1, 100, 100, "empty")],
                                "k int, lo long, hi long, name string")
    got = sorted((r.k, r.x, r.name) for r in range_join(pts, rng, ["k"], "x", "lo", "hi", 16).collect())
    want = sorted((k, x, n) for (k, x) in [(k, x) for k in (0, 1) for x in range(0, 300, 7)]
                  for (k2, lo, hi, n) in [(0, 5, 40, "a"), (0, 40, 41, "b"), (1, 0, 299, "c"), (1, 100, 100, "empty")]
                  if k == k2 and lo <= x < hi)
    assert got == want


def test_running_totals_match_window_with_hot_key(spark):
    from pyspark.sql import Window
    rows = [(("hot" if i % 3 else f"k{i % 7}"), i, float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, o long, v double")
    got = running_totals(df, ["o"], keys=["key"], sums={"s": F.col("v")}, slices=6, total_col="tot")
    w = Window.partitionBy("key").orderBy("o")
    want = df.select("key", "o", F.row_number().over(w).alias("rn"), F.sum("v").over(w).alias("s"),
                     F.count("*").over(Window.partitionBy("key")).alias("tot"))
    a = got.select("key", "o", F.col("rn").cast("long"), "s", "tot")
    b = want.select("key", "o", F.col("rn").cast("long"), "s", "tot")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _chunks(spark, df, base, n):
    stage_chunks(df, f"{base}/staged", n, "event_id")
    for k in range(n):
        reveal(spark, f"{base}/staged", f"{base}/in", k)
        yield k


def test_stream_state_equals_batch(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    base = scratch_path(spark, "t-state")
    for k in _chunks(spark, ev, base, 3):
        s = file_stream(spark, f"{base}/in/*", ev.schema)
        SK.run(s, ST.running_count_batches(f"{base}/o1", f"{base}/s1", "event_type", "event_id"), f"{base}/c1", "t_rc")
        SK.run(s, ST.count_window_batches(f"{base}/o2", f"{base}/s2", "event_type", "event_id", "value"), f"{base}/c2",
               "t_cw")
    rc_stream = spark.read.parquet(f"{base}/o1").drop("batch_id")
    rc_batch = ST.running_count(ev, "event_type", "event_id")
    assert rc_stream.exceptAll(rc_batch.select(rc_stream.columns)).count() == 0
    assert rc_stream.count() == ev.count()
    cw_stream = spark.read.parquet(f"{base}/o2").drop("batch_id")
    cw_batch = ST.count_window(ev, "event_type", "event_id", "value")
    assert cw_stream.exceptAll(cw_batch.select(cw_stream.columns)).count() == 0
    assert cw_batch.exceptAll(cw_stream.select(cw_batch.columns)).count() == 0


def test_partitioned_append_is_idempotent(spark):
    base = scratch_path(spark, "t-append")
    df = spark.createDataFrame([("1", "2", "20240101"), ("3", "4", "20240102")], "order_id string, user_id string, dt string")
    fn = SK.partitioned_append(f"{base}/t", ["dt"])
    fn(df, 0)
    fn(df, 0)  # retried batch
    fn(df, 1)
    assert spark.read.parquet(f"{base}/t").count() == 4


def test_sliced_totals_with_gaps_match_window(spark):
    from pyspark.sql import Window
    rows = [(("hot" if i % 4 else f"k{i % 5}"), i * 3 + 7, float(i % 13)) for i in range(2500)]
    df = spark.createDataFrame(rows, "key string, o long, v double")
    got = running_totals(df, ["o"], keys=["key"], sums={"s": F.col("v")}, slices=5)
    w = Window.partitionBy("key").orderBy("o")
    want = df.select("key", "o", F.row_number().over(w).alias("rn"), F.sum("v").over(w).alias("s"))
    a = got.select("key", "o", F.col("rn").cast("long"), "s")
    b = want.select("key", "o", F.col("rn").cast("long"), "s")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_for_other_cuts(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    batch = ST.running_count(ev, "event_type", "event_id")
    for n_files in (1, 5):
        base = scratch_path(spark, f"t-cut{n_files}")
        for k in _chunks(spark, ev, base, n_files):
            SK.run(file_stream(spark, f"{base}/in/*", ev.schema),
                   ST.running_count_batches(f"{base}/o", f"{base}/s", "event_type", "event_id"), f"{base}/c",
                   f"t_cut{n_files}")
        got = spark.read.parquet(f"{base}/o").drop("batch_id")
        assert got.exceptAll(batch.select(got.columns)).count() == 0
        assert got.count() == ev.count()


def test_sliced_totals_over_words_match_window(spark):
    from pyspark.sql import Window
    words = ["", "a", "ab", "b", "ba", "zz", "é", "éa", "Z", "a b", "aa", "abc", "ä", "中文", "中"] + \
        [f"w{i:04d}" for i in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = running_totals(df, ["word"], count_col="rn", total_col="tot")
    want = df.select("word", F.row_number().over(Window.orderBy("word")).alias("rn"))
    a = got.select("word", F.col("rn").cast("long"))
    b = want.select("word", F.col("rn").cast("long"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert {r.tot for r in got.select("tot").distinct().collect()} == {len(words)}


def test_ledger_not_written_when_output_fails(spark):
    """The ledger row of a batch is written only after its output."""
    import pytest
    base = scratch_path(spark, "t-ledger")
    df = spark.createDataFrame([("t", 0, 5, "x"), ("t", 0, 6, "y")], "topic string, partition int, offset long, value string")

    def failing(d, bid):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        SK.with_ledger(failing, f"{base}/ledger", "g")(df, 0)
    import os
    assert not os.path.exists(f"{base}/ledger")
    SK.with_ledger(lambda d, bid: None, f"{base}/ledger", "g")(df, 0)
    row = spark.read.parquet(f"{base}/ledger").first()
    assert (row.from_offset, row.until_offset) == (5, 7)


def test_scratch_follows_the_cluster_checkpoint_dir(tmp_path):
    """A session that names spark.checkpoint.dir gets its scratch data and
    lineage cuts there (run in a fresh process: one session per process)."""
    import subprocess
    import sys
    import textwrap
    shared = tmp_path / "shared"
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(__import__('os').path.dirname(__import__('os').path.dirname(__file__)))!r})
        from basketflow.session import build_session, scratch_path, shared_dir, cut_lineage
        s = build_session(master="local[2]", checkpoint_dir={str(shared)!r})
        assert shared_dir(s).startswith({str(shared)!r}), shared_dir(s)
        assert scratch_path(s, "x").startswith({str(shared)!r})
        cut_lineage(s.range(10)).count()
        print("ok")
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("ok"), out.stderr[-2000:]
    assert any(shared.iterdir())


def test_append_mode_emits_only_closed_windows(spark, sf):
    """T1/T4 with a watermark in append mode: every emitted window count
    equals the batch count, and only windows that end before the watermark
    (latest event time minus the delay) are emitted."""
    from basketflow.streaming import windows as WIN
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type")
    base = scratch_path(spark, "t-append-mode")
    for k in _chunks(spark, ev, base, 4):
        pass
    s = file_stream(spark, f"{base}/in/*", ev.schema, max_files_per_trigger=1)
    SK.run(WIN.tumbling_counts(s, "ts", "event_type", "2 hours", "2 hours"), None, f"{base}/c", "t_append",
           sink_path=f"{base}/o", output_mode="append")
    got = spark.read.parquet(f"{base}/o")
    batch = WIN.tumbling_counts(ev, "ts", "event_type", "2 hours")
    assert got.count() > 0
    assert got.exceptAll(batch.select(got.columns)).count() == 0
    latest = ev.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    import datetime
    cutoff = (latest - datetime.timedelta(hours=2)).strftime("%Y-%m-%d %H:%M:%S")
    assert got.filter(F.col("window_end") > cutoff).count() == 0
    assert batch.filter(F.col("window_end") <= cutoff).count() >= got.count()


def test_console_and_show_helpers(spark, sf, capsys):
    from basketflow.sinks.writers import show_full
    ev = table(spark, sf, "events").select("event_id", "event_type")
    show_full(ev, 3)
    base = scratch_path(spark, "t-console")
    for k in _chunks(spark, ev, base, 2):
        pass
    s = file_stream(spark, f"{base}/in/*", ev.schema, max_files_per_trigger=1)
    q = SK.run(s.groupBy("event_type").count(), None, f"{base}/c", "t_console", output_mode="complete",
               sink_path="console")
    assert q.lastProgress is not None


def test_processing_time_trigger_and_text_file_stream(spark, sf):
    """T11 + S6: lines of new text files, counted by word on a 1-second
    interval; after all files are processed the totals equal the batch count."""
    from pyspark.sql.types import StringType, StructField, StructType

    from basketflow.functions.text import tokens
    from basketflow.operators.text import word_count
    from basketflow.streaming import windows as WIN
    docs = table(spark, sf, "documents").select("doc_id", "text")
    base = scratch_path(spark, "t-textstream")
    for k, part in enumerate(docs.randomSplit([0.5, 0.5], seed=3)):
        part.select(F.col("text").alias("value")).write.mode("overwrite").text(f"{base}/in/{k:05d}")
    lines = file_stream(spark, f"{base}/in/*", StructType([StructField("value", StringType())]), fmt="text",
                        max_files_per_trigger=1)
    words = lines.select(F.explode(tokens(F.col("value"))).alias("word"))
    q = SK.run(WIN.total_counts(words, "word"), SK.overwrite_result(f"{base}/out"), f"{base}/c", "t_text",
               output_mode="complete", trigger={"processingTime": "1 second"}, wait=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(f"{base}/out")
    want = word_count(docs, "text")
    assert got.exceptAll(want.select(got.columns)).count() == 0
    assert want.exceptAll(got.select(want.columns)).count() == 0


def test_running_totals_keep_null_keys_orders_and_far_ids(spark):
    from pyspark.sql import Window
    rows = [(None, 1), (None, 2), ("a", None), ("a", 5), ("a", 0), ("a", 4 * 10**18), (None, None), ("b", -4 * 10**18)]
    df = spark.createDataFrame(rows, "key string, o long")
    got = running_totals(df, ["o"], keys=["key"], slices=3, total_col="tot")
    w = Window.partitionBy("key").orderBy("o")
    want = df.select("key", "o", F.row_number().over(w).alias("rn"), F.count("*").over(Window.partitionBy("key")).alias("tot"))
    pick = lambda d: sorted(map(repr, (tuple(r) for r in d.select("key", "o", F.col("rn").cast("long"), "tot").collect())))
    assert pick(got) == pick(want)
    counted = ST.running_count(df.withColumnsRenamed({"key": "event_type", "o": "event_id"}), "event_type", "event_id")
    assert counted.count() == len(rows)


def test_running_totals_over_words_with_one_stem(spark):
    words = [f"stem{i:05d}" for i in range(4000)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = running_totals(df, ["word"], slices=8)
    assert [r.word for r in got.orderBy("rn").collect()] == words


def test_count_window_keeps_fractions_and_null_keys(spark):
    df = spark.createDataFrame([("a", i, 0.125) for i in range(4)] + [(None, i, 1e-9) for i in range(4)],
                               "k string, o long, v double")
    got = {(r.k, r.rn): r.window_sum for r in ST.count_window(df, "k", "o", "v", 10, 2).collect()}
    assert got == {("a", 2): 0.25, ("a", 4): 0.5, (None, 2): 2e-9, (None, 4): 4e-9}


def test_stream_counts_of_one_hot_and_one_null_key(spark):
    df = spark.createDataFrame([(i, "hot" if i % 9 else None, 0.125) for i in range(2000)],
                               "event_id long, event_type string, value double")
    base = scratch_path(spark, "t-hot")
    for k in _chunks(spark, df, base, 3):
        s = file_stream(spark, f"{base}/in/*", df.schema)
        SK.run(s, ST.running_count_batches(f"{base}/o", f"{base}/s", "event_type", "event_id"), f"{base}/c", "t_hot")
        SK.run(s, ST.count_window_batches(f"{base}/o2", f"{base}/s2", "event_type", "event_id", "value"), f"{base}/c2",
               "t_hot2")
    for got, want in ((spark.read.parquet(f"{base}/o"), ST.running_count(df, "event_type", "event_id")),
                      (spark.read.parquet(f"{base}/o2"), ST.count_window(df, "event_type", "event_id", "value"))):
        pick = lambda d, c=want.columns: sorted(map(repr, (tuple(r) for r in d.select(*c).collect())))
        assert pick(got) == pick(want)


def test_append_once_counts_committed_batches_only(spark):
    base = scratch_path(spark, "t-once")
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    once = SK.append_once(f"{base}/t")
    assert SK.committed(spark, f"{base}/t", df.schema).count() == 0
    once(df, 0)
    once(df, 0)                                              # a repeated batch
    df.write.parquet(f"{base}/t/rows/0000000001-broken")     # a batch that broke off before its commit
    once(df, 1)
    assert SK.committed(spark, f"{base}/t", df.schema).count() == 4


def _files(spark, path):
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    it, out = fs.listFiles(spark._jvm.org.apache.hadoop.fs.Path(path), True), {}
    while it.hasNext():
        f = it.next()
        if f.getPath().getName().startswith("part-"):
            out[f.getPath().toString()] = f.getModificationTime()
    return out


def test_keyed_table_updates_rewrite_nothing(spark):
    from basketflow.sinks.keyed import KeyedTable
    t = KeyedTable(spark, scratch_path(spark, "t-keyed"), "k string, o long, v string", "k", "o", ["v"], 8)
    assert t.read().count() == 0 and t.compact() == []
    rows = {f"k{i}": (0, f"v{i}") for i in range(500)}
    frame = lambda d: spark.createDataFrame([(k, o, v) for k, (o, v) in d.items()], "k string, o long, v string")
    t.put(frame(rows))
    assert t.compact() == list(range(8))
    before = _files(spark, t.path)
    news = {"k1": (5, "new"), "k2": (-1, "older"), "none": (1, "x")}
    t.put(frame(news))
    after = _files(spark, t.path)
    assert before.items() <= after.items() and 0 < len(after) - len(before) <= 3     # only the deltas are new
    want = {**rows, "k1": (5, "new"), "none": (1, "x")}
    read = lambda: {r["k"]: (r["o"], r["v"]) for r in t.read().collect()}
    assert read() == want
    frame({"k3": (9, "lost")}).withColumn("bucket", F.lit(0)).write.parquet(f"{t.path}/gen=99/kind=delta/bucket=0")
    assert read() == want                                    # a generation that was never committed
    t.put(frame({k: (7, "many") for k in rows}))
    touched = t.compact(0.5)
    assert touched and read() == {**{k: (7, "many") for k in rows}, "none": (1, "x")}
    assert t.compact(0.5) == []


def test_keyed_table_takes_a_batch_once(spark):
    from basketflow.sinks.keyed import KeyedTable
    t = KeyedTable(spark, scratch_path(spark, "t-keyed"), "k string, o long, v string", "k", "o", ["v"], 2)
    df = spark.createDataFrame([("a", 1, "x")], "k string, o long, v string")
    t.put(df, 3)
    n = len(_files(spark, t.path))
    t.put(df, 3)
    assert len(_files(spark, t.path)) == n


def test_closed_windows_free_their_state(spark, sf):
    """Every row is counted once or late, and the state holds only windows that are still open."""
    from basketflow.plans import q_streaming as Q
    base = Q._closed_windows(spark, sf)
    out = spark.read.parquet(f"{base}/out")
    late = spark.read.schema("event_id long, batch_id int").parquet(f"{base}/late").count()
    state = spark.read.format("statestore").load(f"{base}/ckpt")
    held = state.select("key.window.end", F.col("value.count").alias("n"))
    counted = out.agg(F.sum("cnt")).first()[0]
    assert late > 0 and counted + late + held.agg(F.sum("n")).first()[0] == table(spark, sf, "events").count()
    last_closed = out.agg(F.max("window_end")).first()[0]
    assert held.filter(F.date_format("end", "yyyy-MM-dd HH:mm:ss") <= last_closed).count() == 0
    assert held.count() < out.count() / 5


def test_packed_compaction_has_no_exchange(spark):
    from basketflow.sinks import writers as W
    base = scratch_path(spark, "t-pack")
    df = spark.range(60_000).withColumn("p", F.col("id") % 2)
    df.repartition(30).write.parquet(f"{base}/flat")
    df.repartition(10).write.partitionBy("p").parquet(f"{base}/parts")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    size = W.files_for(spark, f"{base}/flat", 1)
    W.compact_files(spark, f"{base}/flat", f"{base}/flat2", size // 3)
    W.compact_files(spark, f"{base}/parts", f"{base}/parts2")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert 3 <= len(_files(spark, f"{base}/flat2")) <= 6 and len(_files(spark, f"{base}/parts2")) == 2
    for name in ("flat2", "parts2"):
        assert spark.read.parquet(f"{base}/{name}").select("id", "p").exceptAll(df.select("id", "p")).count() == 0
        assert spark.read.parquet(f"{base}/{name}").count() == 60_000
    plan = spark.read.parquet(f"{base}/flat")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rebalanced_append_spreads_a_hot_value(spark):
    """A value of many rows is written by as many tasks as its size fills, a small one by one."""
    base = scratch_path(spark, "t-hot")
    df = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("v"),
                                     F.when(F.col("id") < 100, "small").otherwise("hot").alias("dt")).repartition(16)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        SK.partitioned_append(f"{base}/t", ["dt"])(df, 0)
    finally:
        spark.conf.set(key, before)
    files = list(_files(spark, f"{base}/t"))
    assert sum("dt=hot" in f for f in files) > 8 and sum("dt=small" in f for f in files) == 1
    assert spark.read.parquet(f"{base}/t").count() == 400_000
