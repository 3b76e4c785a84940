"""Order-dependent running counts and count windows.

Batch forms use the distributed running totals of ``operators.prefix``, so a
hot key is spread over many tasks.  The stream forms run the same totals on
every micro-batch and carry a small table per key from batch to batch -- the
count so far, or the last ``size - 1`` rows -- in the shared folder: no
key's rows are ever collected in one Python task.  A batch's state is written
under its own batch id, so a repeated batch gives the same files.

Sums are exact: doubles are added as ``decimal(38,18)``, integral and decimal
values in their own type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from basketflow.operators.prefix import running_totals
from basketflow.session import cut_lineage


def exact(df: DataFrame, col: str) -> Column:
    """``col`` in a type whose sums do not depend on the order."""
    kind = df.schema[col].dataType
    return F.col(col).cast("decimal(38,18)") if isinstance(kind, (DoubleType, FloatType)) else F.col(col)


def _null_safe_left(df: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Left join on a key that may be NULL; ``small`` has one row per key."""
    right = small.withColumnRenamed(key, "_k")
    return df.join(right, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")


# --- stream forms ---------------------------------------------------------------

def running_count_batches(out: str, state: str, key: str, order_col: str) -> Callable[[DataFrame, int], None]:
    """Every arrival gets its key's new running count (``keyBy.sum``).

    Returns a ``foreachBatch`` function writing ``out/batch_id=N``."""
    def step(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = df.select(key, order_col)
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
        r = running_totals(rows, [order_col], keys=[key], count_col="rn")
        if batch_id > 0:
            prior = spark.read.schema(counts.schema).parquet(f"{state}/{batch_id - 1}")
            r = _null_safe_left(r, prior, key)
            counts = counts.unionByName(prior).groupBy(key).agg(F.sum("cnt").alias("cnt"))
        else:
            r = r.withColumn("cnt", F.lit(0).cast("long"))
        r.select(order_col, key, (F.col("rn") + F.coalesce("cnt", F.lit(0))).cast("long").alias("running_cnt")) \
            .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        counts.write.mode("overwrite").parquet(f"{state}/{batch_id}")

    return step


def count_window_batches(out: str, state: str, key: str, order_col: str, value_col: str,
                         size: int = 10, slide: int = 2) -> Callable[[DataFrame, int], None]:
    """Per key, every ``slide``-th element emits the sum of the last
    ``size`` values (``countWindow(size, slide)``); the state is each key's
    last ``size - 1`` rows with their position."""
    def step(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = df.select(key, order_col, value_col).withColumn("_at", F.lit(None).cast("long"))
        if batch_id > 0:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{state}/{batch_id - 1}"))
        r = cut_lineage(_totals(rows, key, order_col, value_col))
        # a key's carried rows come first: they tell how many rows came before them
        base = r.filter("_at is not null").groupBy(key).agg((F.min("_at") - 1).alias("_base"))
        r = _null_safe_left(r, base, key).withColumn("_base", F.coalesce("_base", F.lit(0)))
        w = _window_sums(r, key, order_col, size, F.col("_at").isNull() & ((F.col("rn") + F.col("_base")) % slide == 0))
        w.select(key, order_col, (F.col("rn") + F.col("_base")).cast("long").alias("rn"),
                 F.least(F.col("rn") + F.col("_base"), F.lit(size)).cast("long").alias("window_n"), "window_sum") \
            .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        last = Window.partitionBy(key).orderBy(F.col("rn").desc())
        r.withColumn("_r", F.row_number().over(last)).filter(F.col("_r") < size) \
            .select(key, order_col, value_col, (F.col("rn") + F.col("_base")).cast("long").alias("_at")) \
            .write.mode("overwrite").parquet(f"{state}/{batch_id}")

    return step


# --- batch forms ----------------------------------------------------------------

def running_count(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """T3 batch: ``count(*) over (partition by key order by o rows unbounded
    preceding)``, computed as distributed running totals."""
    r = running_totals(df.select(key, order_col), [order_col], keys=[key], count_col="running_cnt")
    return r.select(order_col, key, "running_cnt")


def _totals(rows: DataFrame, key: str, order_col: str, value_col: str) -> DataFrame:
    return running_totals(rows, [order_col], keys=[key], count_col="rn", sums={"cum": exact(rows, value_col)})


def _window_sums(r: DataFrame, key: str, order_col: str, size: int, due: Column) -> DataFrame:
    """The window sum is S(rn) - S(rn - size), found by an equi-join on
    (key, rn - size): linear and exact."""
    prev = r.select(F.col(key).alias("_k"), (F.col("rn") + size).alias("_n"), F.col("cum").alias("cum_prev"))
    j = r.filter(due).join(prev, F.col(key).eqNullSafe(F.col("_k")) & (F.col("rn") == F.col("_n")), "left")
    return j.withColumn("window_sum", (F.col("cum") - F.coalesce(F.col("cum_prev"), F.lit(0))).cast("double"))


def count_window(df: DataFrame, key: str, order_col: str, value_col: str,
                 size: int = 10, slide: int = 2) -> DataFrame:
    """T6 batch: sums of the last ``size`` values at every ``slide``-th row of a key."""
    r = _totals(df.select(key, order_col, value_col), key, order_col, value_col)
    w = _window_sums(r, key, order_col, size, F.col("rn") % slide == 0)
    return w.select(key, order_col, F.col("rn").cast("long").alias("rn"),
                    F.least(F.col("rn"), F.lit(size)).cast("long").alias("window_n"), "window_sum")


def count_window_all(df: DataFrame, order_col: str, value_col: str, size: int = 5) -> DataFrame:
    """Global windows of ``size`` consecutive elements (full ones only)."""
    r = running_totals(df.select(order_col, value_col), [order_col], count_col="rn")
    g = r.groupBy(F.expr(f"(rn - 1) div {size}").alias("window_no")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(order_col).alias("first_id"), F.max(order_col).alias("last_id"),
        F.sum(exact(r, value_col)).cast("double").alias("value_sum"))
    return g.filter(F.col("cnt") == size)
