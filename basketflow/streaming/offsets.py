"""Offset bookkeeping (S9, S11, K7) as DataFrame operations.

* ``resume_offsets``: where a consumer group starts -- its committed offset
  clamped into the partition's retained range, the default where nothing
  is committed, and a status column instead of log warnings.
* ``starting_offsets_json``: the Kafka ``startingOffsets`` option text.
* ``replay_ranges``: messages inside ``[from, until)`` ranges, as an exact
  range join.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators.ranges import range_join


def partition_bounds(messages: DataFrame) -> DataFrame:
    """``topic, partition, earliest, latest`` (latest = next offset)."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest"))


def resume_offsets(bounds: DataFrame, committed: DataFrame | None, default: str = "latest") -> DataFrame:
    """``topic, partition, earliest, latest, committed, start_offset, status``.

    status: ``ok`` (inside), ``below`` (-> earliest), ``above`` (-> latest),
    ``missing`` (no commit -> the default, ``earliest`` or ``latest``).  A
    partition without a commit reports ``committed = -1``, as Kafka's offset
    fetch does."""
    if committed is None:
        committed = bounds.select("topic", "partition", F.lit(None).cast("long").alias("committed")).limit(0)
    j = bounds.join(committed.select("topic", "partition", "committed"), ["topic", "partition"], "left")
    dflt = F.col("earliest") if default == "earliest" else F.col("latest")
    c = F.col("committed")
    return j.select(
        "topic", "partition", "earliest", "latest", F.coalesce(c, F.lit(-1).cast("long")).alias("committed"),
        F.when(c.isNull(), dflt).otherwise(F.greatest(F.col("earliest"), F.least(c, F.col("latest"))))
         .alias("start_offset"),
        F.when(c.isNull(), F.lit("missing")).when(c < F.col("earliest"), F.lit("below"))
         .when(c > F.col("latest"), F.lit("above")).otherwise(F.lit("ok")).alias("status"))


def starting_offsets_json(starts: DataFrame, max_rows: int = 100_000) -> str:
    """``{"topic": {"0": n, ...}}`` for ``startingOffsets``.  One row per
    topic partition -- a bounded, checked collect."""
    rows = starts.select("topic", "partition", "start_offset").limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("too many topic partitions for one option string")
    out: dict[str, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["topic"], {})[str(r["partition"])] = int(r["start_offset"])
    return json.dumps(out, sort_keys=True)


def replay_ranges(messages: DataFrame, ranges: DataFrame, bucket: int = 1024) -> DataFrame:
    """Messages with ``from_offset <= offset < until_offset`` of a range
    of the same (topic, partition); each message carries its range's
    ``batch_id``."""
    return range_join(messages, ranges, ["topic", "partition"], "offset",
                      "from_offset", "until_offset", bucket)
