"""Stream readers.

File streams are the tested path here; Kafka and socket readers are option
builders over the same interface (no broker or port in this container).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketflow.session import hadoop_fs, move


def stage_chunks(df: DataFrame, path: str, n_chunks: int, order_col: str) -> None:
    """Write ``df`` once, as ``path/_chunk=0 .. n-1`` in ``order_col`` ranges.

    The chunk of a row is ``((x - min) * n) div (max - min + 1)`` in decimal
    arithmetic; NULL order values stand first.  One scan, all chunks written
    in parallel by as many tasks as the table has; :func:`reveal` hands the
    chunks to a stream one by one, so the order comes from the data."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        lo = hi = 0
    wide = "decimal(20,0)"
    chunk = F.expr(f"coalesce(cast(((cast({order_col} as {wide}) - {lo}) * {n_chunks}) div {hi - lo + 1} as int), 0)")
    df.withColumn("_chunk", chunk).write.partitionBy("_chunk").mode("overwrite").parquet(path)


def reveal(spark: SparkSession, staged: str, target: str, chunk: int) -> None:
    """Move one staged chunk into the folder that a stream reads."""
    source = f"{staged.rstrip('/')}/_chunk={chunk}"
    fs = hadoop_fs(spark, source)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(target))
    if fs.exists(path(source)):
        move(spark, source, f"{target.rstrip('/')}/{chunk:05d}")


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """New files in a directory (glob allowed) as an unbounded frame."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def table_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table (a folder, or one file) as a stream of its files."""
    fs = hadoop_fs(spark, path)
    if fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(path)).isDirectory():
        return file_stream(spark, path, schema)
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket (``value`` column).  Not exercised here."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def kafka_options(brokers: str, topics: str | list[str], group: str | None = None,
                  starting_offsets: str | None = "latest", max_offsets_per_trigger: int | None = None,
                  assign: dict | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``topics`` is a comma list (or list); ``starting_offsets`` is
    ``latest``/``earliest`` or the JSON from ``offsets.starting_offsets_json``;
    back-pressure is ``maxOffsetsPerTrigger``."""
    t = topics if isinstance(topics, str) else ",".join(topics)
    opts = {"kafka.bootstrap.servers": brokers}
    if assign:
        import json
        opts["assign"] = json.dumps({k: sorted(v) for k, v in assign.items()})
    else:
        opts["subscribe"] = t
    if group:
        opts["kafka.group.id"] = group
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka source (needs the connector package on the cluster)."""
    return spark.readStream.format("kafka").options(**options).load()


def kafka_values(df: DataFrame, with_meta: bool = False) -> DataFrame:
    """Message values as strings; with ``with_meta`` the handler's
    ``(topic, partition, offset)`` are kept alongside."""
    v = F.col("value").cast("string").alias("value")
    if with_meta:
        return df.select("topic", "partition", "offset", v)
    return df.select(v)


def as_kafka_frame(messages: DataFrame, topic: str, partition_col: str, offset_col: str,
                   value_col: str) -> DataFrame:
    """A frame with Kafka's source schema built from message rows (for
    tests and replays of stored messages)."""
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col(value_col).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col(partition_col).cast("int").alias("partition"),
        F.col(offset_col).cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))
