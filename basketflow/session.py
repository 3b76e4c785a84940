"""Session construction and shared-storage helpers.

The library never decides where a cluster keeps its durable scratch data:
``spark.checkpoint.dir`` names the shared folder, and every lineage cut or
intermediate table goes below it.  Only when the setting is missing (local
tests) do we create one of our own.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, cpus: int | None = None,
                  shuffle_partitions: int | None = None,
                  app_name: str = "basketflow", event_log_dir: str | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A session tuned for the operators in this package.

    On a cluster ``master`` stays ``None`` and the submit command decides;
    locally ``local[cpus]`` is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and cpus is not None:
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or (cpus * 2 if cpus else None)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Broadcast only on measured sizes: static estimates (file size through
        # explode / aggregate) can be off by an order of magnitude, so the
        # planner never broadcasts on them; AQE broadcasts a side whose
        # *runtime* shuffle output is below 32 MB.  Operators that broadcast
        # explicitly check their bound themselves.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if parts:
        conf["spark.sql.shuffle.partitions"] = str(parts)
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    Read from the session.  Only a ``local`` master (tests, single machine)
    gets a folder of its own when the setting is missing: on a cluster a
    folder of the driver's machine would be invisible to the executors.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="basketflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder (never reused)."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    hadoop_fs(spark, path).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path))
    return path


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` (works for any store Spark can read)."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder inside one store."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    if not hadoop_fs(spark, source).rename(p(source), p(target)):
        raise OSError(f"cannot move {source} to {target}")


#: Spark's setting that removes a statement's shuffle files when the statement ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SHUFFLE_PARTITIONS, MERGING = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
#: Rows of the largest shuffle in one task.
PARTITION_ROWS = 500_000


def cut_lineage(df, free: bool = False, partitions: int | None = None):
    """Write ``df`` as parquet below the shared folder and read it back
    (never ``localCheckpoint``): later reads keep column pruning and file
    statistics, and a lost executor re-reads instead of recomputing.

    ``free``: the write's shuffle files go when it ends, not when the driver
    happens to collect garbage, so steps one after another need the disk of one.
    ``partitions``: shuffles of this write have that many partitions and are not
    merged; the plan keeps its map-side sums and split joins."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex[:12]}"
    wanted = {SHUFFLE_CLEANUP: "true"} if free else {}
    if partitions:
        wanted |= {SHUFFLE_PARTITIONS: str(partitions), MERGING: "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def partitions_of(spark: SparkSession, rows: int) -> int | None:
    """Shuffle partitions that keep ``rows`` rows at ``PARTITION_ROWS`` a task; None if the session's are enough."""
    n = math.ceil(rows / PARTITION_ROWS)
    return n if n > int(spark.conf.get(SHUFFLE_PARTITIONS)) else None


def cut_by_rows(df, rows: int):
    """``df`` whose largest shuffle holds ``rows`` rows: as it is, while the session's partitions are enough, else written with more."""
    n = partitions_of(df.sparkSession, rows)
    return cut_lineage(df, free=True, partitions=n) if n else df
