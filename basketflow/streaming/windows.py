"""Event-time counts (T1, T2, T4, T5) and their batch twins.

Events carry a zone-less timestamp; ``withWatermark`` needs a zoned one,
so ``ts`` is cast first (session zone UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _fmt_window(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.date_format("window.start", TS_FORMAT).alias("window_start"),
                     F.date_format("window.end", TS_FORMAT).alias("window_end"), key, "cnt")


def tumbling_counts(df: DataFrame, ts: str, key: str, length: str, watermark: str | None = None) -> DataFrame:
    """Counts per key in tumbling event-time windows."""
    src = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        src = src.withWatermark(ts, watermark)
    return _fmt_window(src.groupBy(F.window(ts, length), key).agg(F.count(F.lit(1)).alias("cnt")), key)


def sliding_counts(df: DataFrame, ts: str, key: str, length: str, slide: str,
                   watermark: str | None = None) -> DataFrame:
    """T4/T5: counts per key in sliding windows (``length``, every ``slide``)."""
    src = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        src = src.withWatermark(ts, watermark)
    return _fmt_window(src.groupBy(F.window(ts, length, slide), key).agg(F.count(F.lit(1)).alias("cnt")), key)


def total_counts(df: DataFrame, key: str) -> DataFrame:
    """Running total per key over the stream's life (state in the
    checkpoint; ``complete``/``update`` output)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
