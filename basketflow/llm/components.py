"""Connected components of a distributed edge list.

Alternating star contraction: in the *large* step every node hands its
minimum neighbour to its larger neighbours, in the *small* step to its smaller
ones; the edge list shrinks to one star per component in a logarithmic number
of rounds.  Each step is one map-side-combined ``min`` and one join; no
neighbour list is collected, so a hub never meets in one task.  Every round is
written to the shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import drop_stage, stage


def _mins(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of an edge (longs, no nulls).

    ``component`` is the smallest node reachable.  Loops and repeated edges
    are allowed; an empty edge list gives an empty frame.
    """
    e = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _mins(both).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        # in the small step every edge points from the larger node to a smaller one
        s = _mins(large)
        small = large.join(s, "u").select(F.col("v").alias("x"), "u", "m")
        out = small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("x").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.*") \
            .filter("u <> v").distinct()
        new = stage(out, "edges")
        drop_stage(e)
        e = new
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Union of links among ``n`` local items, fed in bounded batches."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        lab = self.label
        while True:
            a, b = lab[i], lab[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
            while True:                              # pointer jumping
                up = lab[lab]
                if (up == lab).all():
                    break
                lab[:] = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(item, representative) of every item that is not its own representative."""
        i = np.flatnonzero(self.label != np.arange(len(self.label)))
        return i, self.label[i]
