"""Sharding by minimax contiguous partition (law ``bytes``).

Documents with equal texts form an atomic group.  Groups stand in the order
of their texts' MD5, so neighbours have nothing in common and the order is
the same in every run.  The shards are the cuts of that sequence into at most
``shards`` contiguous runs whose largest size is smallest, and among those the
most even ones: a hot group sets the capacity, the others need not fill it.

* running sums of the group sizes, sliced by the leading bits of the digest
  (uniform by construction; a slice is ordered on its own and offset by the
  small table of slice totals);
* search for the smallest feasible capacity: the driver holds a summary of the
  running sums (first and last group end and their number in each of a bounded
  number of cells) and runs the binary search with its greedy check on it
  twice, once with the ends it knows and once as if a group could end
  anywhere inside a cell that holds more.  The answer lies between the two
  capacities.  The stretches in which a greedy cut for a capacity between them
  can lie are cut into finer cells by one job, until both agree.  Each job
  makes the cells finer by a factor of ``CELLS_MAX / shards^2`` or more, so the
  number of jobs does not depend on the number of shards (up to some 1,500
  shards; beyond, the last interval is searched by one lookup job a shard);
* within that capacity the cuts with the smallest sum of squared sizes, by
  dynamic programming on the driver over the group ends around ``POINTS``
  evenly spaced places (a large group has both its ends among them) and the
  greedy cuts.  Squared sizes are convex, so the best last cut never moves
  back and a layer of the programme is a few array operations;
* documents find their shard and slot by a join on the group.  A group is
  dealt into ``PARTS`` parts by a hash of the id, so the copies of one text
  never meet in one task.

Rules: a null text counts as empty; a null id hashes like any other value;
rows with equal id and text get different slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.common import stage

SLICES = 4096              # slices of the digest order
PARTS = 1024               # parts of a group
CELLS = 1 << 17            # least number of cells of the summary (24 bytes each on the driver)
CELLS_MAX = 1 << 22        # most cells; between the two, 16 * shards^2
PROBES = 512               # capacities tested per lookup where the summary cannot tell
POINTS = 1024              # places (two a shard at least) around which a cut may lie


def _last_within(ends: DataFrame, bounds: np.ndarray) -> np.ndarray:
    """For every bound the largest running sum that does not exceed it (0 if none)."""
    order = np.argsort(bounds, kind="stable")
    sorted_bounds = bounds[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(len(sorted_bounds), np.int64)
        for batch in batches:
            e = np.sort(batch.column(0).to_numpy())
            at = np.searchsorted(e, sorted_bounds, "right")
            best = np.maximum(best, np.where(at > 0, e[np.maximum(at, 1) - 1], 0) if len(e) else 0)
        k = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(best[k], pa.int64())], names=["k", "e"])

    out = np.zeros(len(bounds), np.int64)
    for r in ends.mapInArrow(run, "k int, e long").groupBy("k").agg(F.max("e").alias("e")).collect():
        out[order[r["k"]]] = r["e"]                     # at most one row per bound
    return out


def _summary(ends: DataFrame, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First end, last end and number of ends of the cells ``(start, stop]`` that hold any (disjoint, ascending)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = np.sort(batch.column(0).to_numpy())
            cell = np.searchsorted(stops, e)
            inside = cell < len(stops)
            e, cell = e[inside], cell[inside]
            inside = e > starts[cell]
            e, cell = e[inside], cell[inside]
            at = np.flatnonzero(np.diff(cell, prepend=-1))
            to = np.append(at[1:], len(e)) - 1 if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (cell[at], e[at], e[to], to - at + 1)],
                                             names=["cell", "first", "last", "n"])

    got = ends.mapInArrow(run, "cell long, first long, last long, n long").groupBy("cell").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).toArrow()
    order = np.argsort(got["cell"].to_numpy())
    return tuple(got[c].to_numpy()[order] for c in ("first", "last", "n"))


def _smallest(last_end, low: int, high: int, total: int, shards: int) -> int:
    """Smallest capacity in ``[low, high]`` (``high`` fits) whose greedy check, run with ``last_end``, reaches the total."""
    while low < high:
        caps = np.unique(np.append(np.linspace(low, high, 64).astype(np.int64), high))
        at = np.zeros(len(caps), np.int64)
        for _ in range(shards):
            at = last_end(at + caps)
        fits = int(np.argmax(at >= total))
        low, high = (int(caps[fits - 1]) + 1 if fits else int(caps[0])), int(caps[fits])
    return low


def _chain(last_end, capacity: int, total: int, shards: int) -> np.ndarray:
    out, at = [], np.zeros(1, np.int64)
    for _ in range(shards):
        at = np.minimum(last_end(at + capacity), total)
        out.append(int(at[0]))
    return np.array(out, np.int64)


def _split(starts: np.ndarray, stops: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint stretches cut into about ``cells`` cells of nearly one width."""
    width = max(1, -(-int((stops - starts).sum()) // cells))
    n = -(-(stops - starts) // width)
    of = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    lo = starts[of] + step * width
    return lo, np.minimum(lo + width, stops[of])


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, running sums at which the shards end).

    ``ends``: one column with the groups' inclusive running sums.
    """
    if total == 0:
        return 0, [0] * shards
    low, high = max(-(-total // shards), largest), total
    cells = min(CELLS_MAX, max(CELLS, 16 * shards * shards))
    known = np.array([0, total], np.int64)
    open_from, open_to = known[:1], known[1:]           # stretches with ends that the driver does not know
    while True:
        first, last, n = _summary(ends, *_split(open_from, open_to, cells))
        known = np.unique(np.concatenate((known, first, last)))
        more = n > 2
        a, b = first[more], last[more]

        def surely(x):
            return known[np.searchsorted(known, x, "right") - 1]

        def perhaps(x):
            if not len(a):
                return surely(x)
            k = np.maximum(np.searchsorted(a, x, "right") - 1, 0)
            return np.where((a[k] < x) & (x < b[k]), x, surely(x))

        width = high - low
        high = _smallest(surely, low, high, total, shards)
        low = _smallest(perhaps, low, high, total, shards)
        cuts = _chain(surely, high, total, shards)
        if low == high:
            return high, [int(c) for c in cuts]
        if high - low > width // 2 and width < total // 2:
            return _cuts_by_lookup(ends, total, low, high, shards)
        lower, upper = _chain(surely, low, total, shards), _chain(perhaps, high, total, shards)
        # cells a greedy cut can lie in: their stretch meets one of [lower, upper]
        touched = np.zeros(len(a) + 1, np.int64)
        np.add.at(touched, np.searchsorted(b, lower, "right"), 1)
        np.add.at(touched, np.maximum(np.searchsorted(a, upper), np.searchsorted(b, lower, "right")), -1)
        touched = np.cumsum(touched)[:-1] > 0
        open_from, open_to = a[touched], b[touched] - 1
        near = np.concatenate((lower, cuts, upper))
        keep = np.unique(np.clip(np.concatenate([np.searchsorted(known, near, "right") + d for d in (-2, -1, 0)]),
                                 0, len(known) - 1))
        inside = np.zeros(len(known) + 1, np.int64)     # known ends within a stretch stay, the others are not asked for
        np.add.at(inside, np.searchsorted(known, lower), 1)
        np.add.at(inside, np.searchsorted(known, upper, "right"), -1)
        inside = np.cumsum(inside)[:-1] > 0
        inside[keep] = True
        inside[[0, -1]] = True
        known = known[inside]


def _cuts_by_lookup(ends: DataFrame, total: int, low: int, high: int, shards: int) -> tuple[int, list[int]]:
    """As :func:`minimax_cuts` within ``[low, high]``, by a lookup job for each shard of a greedy check."""
    while True:
        caps = np.unique(np.append(np.linspace(low, high, PROBES).astype(np.int64), high)) if high - low >= PROBES \
            else np.arange(low, high + 1)
        at, cuts = np.zeros(len(caps), np.int64), []
        for _ in range(shards):
            at = _last_within(ends, at + caps)
            cuts.append(at)
            if (at >= total).all():
                break
        fits = int(np.flatnonzero(at >= total)[0])      # the highest capacity always fits
        if fits == 0 or caps[fits] - caps[fits - 1] == 1:
            got = [int(c[fits]) for c in cuts]
            return int(caps[fits]), got + [total] * (shards - len(got))
        low, high = int(caps[fits - 1]) + 1, int(caps[fits])


def even_cuts(points: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cuts of ``[0, points[-1]]`` at ``points`` into ``shards`` runs of at most ``capacity``, the sum of whose squared
    sizes is smallest; empty runs (if points are too few) come last."""
    at = np.concatenate(([0], np.asarray(points, np.int64)))
    x = at / max(1, at[-1])
    lowest = np.searchsorted(at, at - capacity)         # first point from which a run to this one fits
    cost, reach, back = np.zeros(1), 0, []              # of the points that the runs so far can reach
    for _ in range(shards):
        far = int(np.searchsorted(at, at[reach] + capacity, "right")) - 1
        came = np.zeros(far + 1, np.int64)
        best = np.full(far + 1, np.inf)
        step = 1 << max(0, far.bit_length() - 1)
        done = np.zeros(0, np.int64)                    # points whose best last cut is known, ascending
        while step:                                     # those halfway between them look between their best ones
            i = np.arange(step - 1, far + 1, 2 * step) if len(done) else np.arange(step - 1, far + 1, step)
            k = np.searchsorted(done, i)
            lo = np.where(k > 0, came[done[np.maximum(k, 1) - 1]] if len(done) else 0, 0)
            hi = np.where(k < len(done), came[done[np.minimum(k, len(done) - 1)]] if len(done) else reach, reach)
            lo, hi = np.maximum(lo, lowest[i]), np.minimum(np.minimum(hi, i), reach)
            size = hi - lo + 1
            head = np.cumsum(size) - size
            j = np.arange(size.sum()) - np.repeat(head - lo, size)
            c = cost[j] + (np.repeat(x[i], size) - x[j]) ** 2
            best[i] = np.minimum.reduceat(c, head)
            at_best = np.where(c == np.repeat(best[i], size), j, -1)
            came[i] = np.maximum.reduceat(at_best, head)    # the last of equals: empty runs at the end
            done = np.sort(np.concatenate((done, i)))
            step //= 2
        back.append(came)
        cost, reach = best, far
    assert reach == len(at) - 1
    out, i = [], reach
    for came in reversed(back):
        out.append(int(at[i]))
        i = came[i]
    return out[::-1]


def balanced_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, the most even cuts within it)."""
    capacity, greedy = minimax_cuts(ends, total, largest, shards)
    if total == 0:
        return capacity, greedy
    places = np.unique(np.linspace(0, total, max(POINTS, 2 * shards) + 1).round().astype(np.int64))[:-1]
    below = _last_within(ends, places)
    name = ends.columns[0]
    above = total - _last_within(ends.select((F.lit(total) - F.col(name)).alias(name)), total - places - 1)
    points = np.unique(np.concatenate((below, above, np.array(greedy, np.int64))))
    return capacity, even_cuts(points[points > 0], capacity, shards)


def _numbered(groups: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``g, shard``: the number of cuts before the group's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = np.searchsorted(cuts, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard, pa.int32())], names=["g", "shard"])

    return groups.select("g", "end_bytes").mapInArrow(run, "g binary, shard int")


def shard(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` of every row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    digest = F.unhex(F.md5(text.cast("binary")))
    rows = stage(df.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), digest.alias("g"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit(3)), F.lit(PARTS)).cast("int").alias("part")), "shard-rows")
    parts = rows.groupBy("g", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    lead = F.conv(F.substring(F.hex("g"), 1, 3), 16, 10).cast("int")     # 12 bits: SLICES values
    parts = stage(parts.withColumn("slice", lead), "shard-parts")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("slice").agg(F.sum("bytes").alias("b"), F.sum("n").alias("c")) \
        .select("slice", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"))   # <= SLICES rows
    inside = Window.partitionBy("slice").orderBy("g", "part").rowsBetween(Window.unboundedPreceding, 0)
    sums = parts.join(F.broadcast(offsets), "slice").select(
        "g", "part", (F.sum("bytes").over(inside) + F.col("b0")).alias("end_bytes"),
        (F.sum("n").over(inside) + F.col("c0") - F.col("n")).alias("first_row"))
    sums = stage(sums, "shard-sums")
    groups = stage(sums.groupBy("g").agg(F.max("end_bytes").alias("end_bytes")), "shard-ends")
    size = parts.groupBy("g").agg(F.sum("bytes").alias("bytes")).agg(F.sum("bytes"), F.max("bytes")).first()
    _, cuts = balanced_cuts(groups.select("end_bytes"), size[0] or 0, size[1] or 0, shards)
    named = _numbered(groups, np.array(cuts[:-1], np.int64))
    placed = stage(sums.select("g", "part", "first_row").join(named, "g"), "shard-placed")
    first = placed.groupBy("shard").agg(F.min("first_row").alias("shard_row"))       # <= shards rows
    at = placed.join(F.broadcast(first), "shard").select(
        "g", "part", "shard", (F.col("first_row") - F.col("shard_row")).alias("base"))
    rank = F.row_number().over(Window.partitionBy("g", "part").orderBy("id"))
    return rows.join(at, ["g", "part"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("base") + rank - 1).cast("long").alias("slot"))
