"""Stream sinks and the run helper.

``foreachBatch`` is at-least-once: a batch may run again after a failure.
Every writer here is idempotent per ``batch_id`` -- it overwrites exactly
the partitions of that batch -- so a retry leaves the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.session import hadoop_fs, move

BatchFn = Callable[[DataFrame, int], None]


def run(stream: DataFrame, batch_fn: BatchFn | None, checkpoint: str, name: str,
        output_mode: str = "append", trigger: dict | None = None, sink_path: str | None = None,
        wait: bool = True, state_partitions: int | None = None):
    """Start ``stream`` into ``batch_fn`` (or a parquet ``sink_path``, or
    ``sink_path="console"`` to print every batch).

    ``trigger`` defaults to ``availableNow`` (drain what is there, stop);
    pass ``{"processingTime": "2 seconds"}`` for a long-running job (T11).

    ``state_partitions`` fixes the number of state-store partitions of the
    query's stateful operators (default: twice the cluster's cores).  A
    stream takes the value of ``spark.sql.shuffle.partitions`` when it starts
    and keeps it in its checkpoint for life, so it is set only around
    ``start()`` -- the running query works on its own copy of the session
    settings -- and the caller's value is restored right after."""
    spark = stream.sparkSession
    parts = state_partitions or 2 * spark.sparkContext.defaultParallelism
    w = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if batch_fn is not None:
        w = w.foreachBatch(batch_fn)
    elif sink_path == "console":
        w = w.format("console").option("truncate", "false")  # K1: print each batch
    else:
        w = w.format("parquet").option("path", sink_path)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(parts))
    try:
        q = w.start()
    finally:
        spark.conf.set(key, before)
    if wait:
        q.awaitTermination()
    return q


def overwrite_result(path: str) -> BatchFn:
    """Complete-mode result: each batch replaces the table (last one wins)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(path)
    return fn


def per_batch_dirs(prefix: str) -> BatchFn:
    """K3: one output directory per micro-batch, ``prefix/batch_id=N``."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{prefix.rstrip('/')}/batch_id={batch_id}")
    return fn


def partitioned_append(path: str, partition_cols: list[str]) -> BatchFn:
    """Append each batch into a partitioned table.  The batch id is the
    innermost partition and dynamic partition overwrite replaces only that
    batch's partitions, so a retried batch does not duplicate rows.

    Rows of a partition value meet in few tasks, and a value of many rows is spread over as many as its measured
    size fills (``rebalance``: shuffle statistics decide, which needs adaptive execution, off by default in a stream's
    session)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        (df.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", *partition_cols)
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_cols, "batch_id").parquet(path))
    return fn


def append_once(path: str) -> BatchFn:
    """K5, exactly once: a batch writes its rows to a folder of its own and then one commit line that names
    the folder.  A batch that is already committed is not written again; one that broke off before its commit
    leaves a folder that no reader looks at.  Read with :func:`committed`."""
    def fn(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        commit = f"{path}/commits/{batch_id:010d}"
        if hadoop_fs(spark, commit).exists(_path(spark, commit)):
            return
        folder = f"{path}/rows/{batch_id:010d}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(folder)
        # the commit appears whole or not at all: written aside, then renamed
        aside = f"{path}/aside/{uuid.uuid4().hex[:12]}"
        spark.createDataFrame([(batch_id, folder)], "batch_id long, folder string").coalesce(1).write.parquet(aside)
        hadoop_fs(spark, commit).mkdirs(_path(spark, f"{path}/commits"))
        move(spark, aside, commit)
    return fn


def committed(spark, path: str, schema) -> DataFrame:
    """The rows of all committed batches written by :func:`append_once`."""
    if not hadoop_fs(spark, path).exists(_path(spark, f"{path}/commits")):
        return spark.createDataFrame([], schema)
    folders = [r["folder"] for r in spark.read.schema("batch_id long, folder string")
               .parquet(f"{path}/commits/*").select("folder").collect()]        # one name per batch
    return spark.read.schema(schema).parquet(*folders)


def _path(spark, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def insert_into(name: str) -> BatchFn:
    """K5: append each batch to a catalog table, columns in the table's order
    (``insertInto`` goes by position).  At least once: use
    :func:`partitioned_append` where a repeated batch must not add rows."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df.select(*df.sparkSession.table(name).columns).write.insertInto(name)
    return fn


def late_rows(path: str, ts: str, length: str, watermark: str | None) -> BatchFn:
    """Side table of a batch's late rows: those whose window had closed before the batch, which the windowed
    counts (append mode) drop.  ``watermark`` is that of the counting query when the batch begins."""
    def fn(df: DataFrame, batch_id: int) -> None:
        late = df.filter(F.window(F.col(ts).cast("timestamp"), length)["end"] <= F.lit(watermark).cast("timestamp")) \
            if watermark else df.limit(0)
        late.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return fn


def merge_totals(table, key: str, value: str) -> BatchFn:
    """The rows a batch has changed (``update`` mode) go into a keyed table as one delta."""
    def fn(df: DataFrame, batch_id: int) -> None:
        table.put(df.select(key, value, F.lit(batch_id).cast("long").alias(table.order_col)), batch_id)
    return fn


def with_ledger(result_fn: BatchFn, ledger_path: str, group: str) -> BatchFn:
    """K7 (D17 corrected): run the batch's own output first, then append the
    consumed offset ranges of the batch to the ledger, keyed by
    ``(group, batch_id)``.  The ledger is written only after the output, so a
    crash in between replays the batch rather than losing it."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            result_fn(df, batch_id)
            ranges = (df.groupBy("topic", "partition")
                        .agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
                        .withColumn("group_id", F.lit(group)).withColumn("batch_id", F.lit(batch_id)))
            (ranges.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                   .partitionBy("group_id", "batch_id").parquet(ledger_path))
        finally:
            df.unpersist()
    return fn
