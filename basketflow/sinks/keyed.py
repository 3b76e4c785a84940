"""A table of the newest row per key that takes small updates without being rewritten.

The rows are dealt into ``buckets`` folders by the hash of their key.  An update
appends its rows, newest per key, as one *delta* to the buckets of its keys: no
file that is there is touched.  A reader takes a bucket's last full copy and the
deltas since and keeps the newest row per key (one aggregate, map-side combined).
:meth:`KeyedTable.compact` writes a new full copy of those buckets only whose
deltas have grown beyond a share of it.

Layout: ``gen=N/kind=base|delta/bucket=B/*.parquet`` and ``commits/N``, an empty file made
after generation ``N`` is written.  Only committed generations are read, so a job that
breaks off changes nothing, and a generation number that is committed is not written
again: a repeated batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.session import hadoop_fs
from basketflow.sinks.writers import latest_per_key


class KeyedTable:
    """``key``, ``order_col`` (the newest row has the largest) and ``cols`` below ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str, order_col: str, cols: list[str],
                 buckets: int = 64):
        self.spark, self.path, self.key, self.order_col, self.cols, self.buckets = spark, path, key, order_col, cols, buckets
        fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        self.schema = T.StructType([fields[c] for c in (key, order_col, *cols)])

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def generations(self) -> list[int]:
        fs = hadoop_fs(self.spark, self.path)
        if not fs.exists(self._path("commits")):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(self._path("commits")))

    def _write(self, rows: DataFrame, kind: str, gen: int) -> None:
        rows.withColumn("bucket", self._bucket()).repartition("bucket") \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/gen={gen}/kind={kind}")
        fs = hadoop_fs(self.spark, self.path)
        fs.mkdirs(self._path("commits"))
        fs.create(self._path(f"commits/{gen}"), True).close()

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def put(self, updates: DataFrame, gen: int | None = None) -> None:
        """Merge ``updates``; ``gen`` (a stream's batch id) makes a repeated call harmless."""
        done = self.generations()
        gen = (done[-1] + 1 if done else 0) if gen is None else 2 * gen
        if gen not in done:
            self._write(latest_per_key(updates, self.key, self.order_col, self.cols), "delta", gen)

    def _stored(self) -> DataFrame:
        """All committed rows with ``gen``, ``kind`` and ``bucket``, deltas older than a bucket's full copy left out."""
        full = T.StructType([*self.schema.fields, T.StructField("gen", T.LongType()), T.StructField("kind", T.StringType()),
                             T.StructField("bucket", T.IntegerType())])
        gens = self.generations()
        if not gens:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", self.path).parquet(*[f"{self.path}/gen={g}" for g in gens])
        # folder names only: no column is read for this
        copies = rows.filter("kind = 'base'").groupBy("bucket").agg(F.max("gen").alias("from_gen"))
        since = {r["bucket"]: r["from_gen"] for r in copies.collect()}                # one row per bucket
        for g in sorted(set(since.values())):
            of = [b for b, x in since.items() if x == g]
            rows = rows.filter(~F.col("bucket").isin(of) | (F.col("gen") >= g))
        return rows

    def read(self) -> DataFrame:
        return latest_per_key(self._stored(), self.key, self.order_col, self.cols).select(*self.schema.names)

    def compact(self, ratio: float = 0.5) -> list[int]:
        """Full copies of the buckets whose deltas hold more than ``ratio`` of the rows of their full copy."""
        rows = self._stored()
        sizes = rows.groupBy("bucket").agg(F.count_if(F.col("kind") == "base").alias("base"),
                                           F.count_if(F.col("kind") == "delta").alias("delta"))
        todo = [r["bucket"] for r in sizes.filter(F.col("delta") > ratio * F.col("base")).collect()]
        if todo:
            merged = latest_per_key(rows.filter(F.col("bucket").isin(todo)), self.key, self.order_col, self.cols)
            self._write(merged, "base", self.generations()[-1] + 1)
        return sorted(todo)
