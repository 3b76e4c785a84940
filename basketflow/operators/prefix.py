"""Distributed running counts and running sums over a total order.

A window ``over (partition by k order by o rows unbounded preceding)`` puts
each key in one task, and a window without ``partition by`` puts the whole
table in one task.  ``running_totals`` keeps the same result while splitting
the work:

1. cut the order into ``n`` slices (a hot key spans many slices): the rows are
   range-partitioned by ``(keys, order)`` -- balanced by sampling, for any
   orderable columns, whatever their distribution -- and the assignment is
   written to the shared folder, so a recomputation after executor loss sees
   the same slices;
2. total each (key, slice) -- at most keys x n small rows -- and turn the
   totals into per-slice offsets with a window over that small frame;
3. a running window inside each (key, slice) plus its offset.

The caller's order columns must be unique within a key (a total order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.session import cut_lineage


def running_totals(df: DataFrame, order: list[str | Column], keys: list[str] | None = None,
                   sums: dict[str, Column] | None = None, count_col: str = "rn",
                   slices: int | None = None, total_col: str | None = None) -> DataFrame:
    """Add ``count_col`` (1-based position in the order within ``keys``) and
    one running sum per entry of ``sums`` (name -> value column); with
    ``total_col`` also the key's row total (taken from the small frame).  NULL
    keys are one key; NULL order values stand where the sort puts them."""
    keys = list(keys or [])
    sums = dict(sums or {})
    spark = df.sparkSession
    # enough slices to spread a hot key over the whole cluster
    n = slices or 2 * spark.sparkContext.defaultParallelism
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    staged = df
    for name, c in sums.items():
        staged = staged.withColumn(f"_v_{name}", c)
    staged = staged.repartitionByRange(n, *[F.col(k) for k in keys], *order_cols)
    staged = cut_lineage(staged.withColumn("_slice", F.spark_partition_id()))

    tot_aggs = [F.count(F.lit(1)).alias("_cnt")] + [F.sum(f"_v_{s}").alias(f"_t_{s}") for s in sums]
    totals = staged.groupBy(*keys, "_slice").agg(*tot_aggs)
    before = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))) \
        .orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_slice",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_o_cnt"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *([F.sum("_cnt").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
           .alias(total_col)] if total_col else []))

    local = Window.partitionBy(*keys, "_slice").orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # null-safe: a NULL key has its own offsets
    right = offsets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_k__slice"),
                           *[c for c in offsets.columns if c not in (*keys, "_slice")])
    on = F.col("_slice") == F.col("_k__slice")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = staged.join(right, on).drop("_k__slice", *[f"_k_{k}" for k in keys])
    out = out.withColumn(count_col, F.row_number().over(
        Window.partitionBy(*keys, "_slice").orderBy(*order_cols)) + F.col("_o_cnt"))
    for s in sums:
        out = out.withColumn(s, F.sum(f"_v_{s}").over(local) + F.col(f"_o_{s}"))
    drop = ["_slice", "_o_cnt"] + [f"_v_{s}" for s in sums] + [f"_o_{s}" for s in sums]
    return out.drop(*drop)
