"""Batch sinks (K2, K4, K6, K8) and their read-back.

Every path lives below the shared folder the caller passes in; nothing is
written to a machine-local directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.session import hadoop_fs

PAIR_LINE = r"^\((.*),(-?\d+)\)$"  # fixed: "(key,count)" text lines


def save_pairs_text(df: DataFrame, key: str, value: str, path: str) -> None:
    """K2: ``(key,value)`` lines as text files (what ``saveAsTextFile`` of a
    pair RDD prints)."""
    df.select(F.format_string("(%s,%d)", F.col(key), F.col(value)).alias("value")) \
      .write.mode("overwrite").text(path)


def read_pairs_text(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """Inverse of ``save_pairs_text`` (the key may itself contain commas)."""
    t = spark.read.text(path)
    return t.select(F.regexp_extract("value", PAIR_LINE, 1).alias(key),
                    F.regexp_extract("value", PAIR_LINE, 2).cast("long").alias(value))


def overwrite_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """K4: replace a catalog table (external, data at ``path``) and read it back."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def compact(df: DataFrame, files: int) -> DataFrame:
    """K8: fewer, larger files -- ``repartition(files)`` before the write
    (AQE also coalesces small shuffle partitions on its own)."""
    return df.repartition(files)


TARGET_FILE_BYTES = 128 << 20  # size of a compacted file, about


def files_for(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """How many files of ``target_bytes`` the data below ``path`` fills."""
    size = hadoop_fs(spark, path).getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(path)).getLength()
    return max(1, -(-size // target_bytes))


def compact_files(spark: SparkSession, path: str, out: str, target_bytes: int = TARGET_FILE_BYTES) -> None:
    """K8 without a shuffle: small files of the folder ``path`` are packed into tasks of about ``target_bytes`` by
    the scan itself, and each task writes one file.  Folders of partition values are packed value by value, so
    that no file mixes values."""
    fs = hadoop_fs(spark, path)
    p = spark._jvm.org.apache.hadoop.fs.Path
    folders = [f.getPath().getName() for f in fs.listStatus(p(path)) if f.isDirectory() and "=" in f.getPath().getName()]
    if folders:
        for name in folders:
            compact_files(spark, f"{path}/{name}", f"{out}/{name}", target_bytes)
        return
    wanted = {"spark.sql.files.maxPartitionBytes": str(target_bytes), "spark.sql.files.openCostInBytes": "0",
              "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        spark.read.parquet(path).write.parquet(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest_per_key(df: DataFrame, key: str, order_col: str, cols: list[str]) -> DataFrame:
    """The newest row per key by an explicit order column; rows of one
    order value are ranked by their other columns, a NULL order is oldest, so
    the choice never depends on arrival.  A plain maximum with a map-side
    partial: a hot key costs one small partial per task, not one big group."""
    return df.groupBy(key).agg(F.max(F.struct(order_col, *cols)).alias("_r")) \
             .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols], F.col(f"_r.{order_col}").alias(order_col))


def keyed_upsert(snapshot: DataFrame | None, updates: DataFrame, key: str, order_col: str,
                 cols: list[str], path: str) -> DataFrame:
    """K6 (re-aimed wide-column put): merge ``updates`` into ``snapshot``,
    newest row per key wins, written as a new immutable version at ``path``."""
    cols_all = [key, order_col, *cols]
    both = updates.select(*cols_all)
    if snapshot is not None:
        both = snapshot.select(*cols_all).unionByName(both)
    merged = latest_per_key(both, key, order_col, cols)
    merged.write.mode("overwrite").parquet(path)
    return merged.sparkSession.read.parquet(path)


def write_partitions(df: DataFrame, open_writer, batch_size: int = 1000) -> None:
    """K6 write path for an external keyed store: each task opens one writer
    (``open_writer(partition_id)`` returns an object with ``put(rows)`` and
    ``close()``) and sends its rows in batches of ``batch_size`` -- the
    partition-batched put of a wide-column client, with no rows on the driver.
    Pair it with ``latest_per_key`` so every key is written once."""
    from pyspark import TaskContext

    def run(rows):
        w = open_writer(TaskContext.get().partitionId())
        try:
            batch = []
            for r in rows:
                batch.append(r)
                if len(batch) >= batch_size:
                    w.put(batch)
                    batch = []
            if batch:
                w.put(batch)
        finally:
            w.close()

    df.foreachPartition(run)


def show_full(df: DataFrame, n: int = 20) -> None:
    """K1: print the first ``n`` rows with every column untruncated
    (``show(n, truncate=False)``; only ``n`` rows reach the driver)."""
    df.show(n, truncate=False)
