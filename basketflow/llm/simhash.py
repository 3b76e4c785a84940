"""SimHash near-duplicate groups by tiled exact comparison.

* Fingerprint: 64 bit majorities over the XXH64 values (seed 42) of a text's
  4-word shingles, repeats included; fewer words give one shingle of all of
  them, no word gives fingerprint zero.
* Rows with one fingerprint are one class (one row per class from here on).
* Classes are dealt into blocks by population count; a popular count is salted
  into several blocks of about ``BLOCK`` fingerprints.  A tile is a pair of
  blocks; pairs whose counts differ by more than the radius are skipped,
  because each differing bit changes the count by at most one.  Inside a tile
  the count of the upper 32 bits skips sub-tiles in the same way.
* A tile compares all its pairs exactly (exclusive-or, bit count) in bounded
  row batches and returns spanning links only, never pairs; the components of
  all tiles' links follow in :mod:`components`.

Rules: a null text counts as empty; rows with a null id take part, and the id
of a component is the smallest non-null id in it (null if there is none);
repeated ids are kept as rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import fresh, packed, stage, with_fields
from basketflow.llm.components import Forest, components

SHINGLE = 4
RADIUS = 4
BLOCK = 65536              # fingerprints per block: at most 2 * BLOCK rows per tile
CELLS = 1 << 17            # pairs compared at once inside a tile
PENDING = 1 << 20          # links held before they are merged into the forest
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text (UTF-8)."""
    words = (text or b"").translate(_LOWER).split()      # splits on U+0020 and U+0009..U+000D
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:len(words) - shingle + 1].tolist()
    stop = (ends[shingle - 1:] - 1).tolist()
    h = np.array([digest(joined[a:b], 42) for a, b in zip(begin, stop, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(h), 1 << 16):                # bounded memory for very long texts
        bits = np.unpackbits(h[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fp", shingle: int = SHINGLE,
                 keep_text: bool = True) -> DataFrame:
    """Add the fingerprint as a (signed) long."""
    schema = with_fields(df.schema, [T.StructField(out_col, T.LongType(), False)], () if keep_text else (text_col,))
    carried = [n for n in schema.names if n != out_col]
    given = fresh(df, "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_buffer().to_pybytes() if x.is_valid else None, shingle)
                            for x in batch.column(given)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(fps.view(np.int64))],
                                             names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in carried],
                     F.col(f"`{text_col}`").cast("binary").alias(given)).mapInArrow(run, schema)


def _tile(fps_a: np.ndarray, fps_b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (pairs of fingerprints) among a block, or between two blocks."""
    def ordered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.sort(x)
        high = np.bitwise_count(x >> np.uint64(32)).astype(np.int64)
        o = np.argsort(high, kind="stable")
        return x[o], high[o]

    a, ha = ordered(fps_a)
    same = fps_b is None
    b, hb = (a, ha) if same else ordered(fps_b)
    items = a if same else np.concatenate((a, b))
    forest = Forest(len(items))
    row, held, pending = 0, [], 0
    while row < len(a):
        # columns whose upper-half count can be within the radius of this row's
        lo, hi = np.searchsorted(hb, [ha[row] - radius, ha[row] + radius + 1])
        lo = max(int(lo), row) if same else int(lo)
        last = int(np.searchsorted(ha, ha[row], "right"))
        end = min(last, row + max(1, CELLS // max(1, int(hi) - lo)))
        if hi > lo:
            near = np.bitwise_count(a[row:end, None] ^ b[None, lo:hi]) <= radius
            i, j = np.nonzero(near)
            if len(i):
                held.append((i + row, j + (lo if same else lo + len(a))))
                pending += len(i)
        row = end
        if pending > PENDING or (pending and row >= len(a)):
            forest.add(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, pending = [], 0
    i, j = forest.links()
    return items[i], items[j]


def links(classes: DataFrame, fp_col: str = "fp", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``a, b``: spanning links among distinct fingerprints within ``radius`` bits."""
    fp = classes.select(F.col(fp_col).alias("fp")).withColumn("pop", F.bit_count("fp"))
    count = {r["pop"]: r["n"] for r in fp.groupBy("pop").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= 65 rows
    salts = [-(-count.get(p, 0) // block) for p in range(65)]
    first = np.concatenate(([0], np.cumsum(salts))).tolist()          # number of a count's first block
    blocks = first[-1]
    first_lit = F.array(*[F.lit(x).cast("long") for x in first])
    salt_lit = F.array(*[F.lit(max(1, x)).cast("long") for x in salts])
    # every tile this fingerprint belongs to: its block with each block of a near count
    own = (F.element_at(first_lit, F.col("pop") + 1)
           + F.pmod(F.xxhash64("fp", F.lit(7)), F.element_at(salt_lit, F.col("pop") + 1)))
    lo = F.element_at(first_lit, F.greatest(F.col("pop") - radius, F.lit(0)) + 1)
    hi = F.element_at(first_lit, F.least(F.col("pop") + radius, F.lit(64)) + 2)
    dealt = fp.withColumn("own", own).withColumn("other", F.explode(F.sequence(lo, hi - 1))) \
        .select("fp", (F.col("own") <= F.col("other")).alias("low"),
                (F.least("own", "other") * blocks + F.greatest("own", "other")).alias("tile"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fps, low = pdf["fp"].to_numpy().view(np.uint64), pdf["low"].to_numpy()
        if key[0] // blocks == key[0] % blocks:
            a, b = _tile(fps, None, radius)
        elif low.all() or not low.any():
            a = b = fps[:0]
        else:
            a, b = _tile(fps[low], fps[~low], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("tile").applyInPandas(run, "a long, b long")


def _labelled(classes: DataFrame, radius: int) -> DataFrame:
    """``fp, label`` from classes ``fp, first``: the smallest ``first`` of the fingerprint's component."""
    comp = components(links(classes, radius=radius), "a", "b")
    # only classes in a component of more than one; the others label themselves
    member = classes.join(comp, F.col("fp") == F.col("node")).select("fp", "first", "component")
    named = member.join(member.groupBy("component").agg(F.min("first").alias("smallest")), "component") \
        .select("fp", "smallest")
    return classes.join(named, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("label"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    rows = stage(fingerprints(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                              shingle=shingle, keep_text=False), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    return rows.join(_labelled(classes, radius), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("label").alias("component_id"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` that represent their group: exactly one row of each component.

    The smallest id stays (null ids last); among several rows with that id the
    one with the smallest content hash; of fully equal rows one.
    """
    content = [F.col(f"`{c}`").cast("string") for c in df.columns]
    marked = [F.coalesce(c, F.lit("")) for c in content] + [c.isNull() for c in content]
    keyed = df.select(packed(df).alias("row"), F.xxhash64(*marked).alias("k1"), F.xxhash64(F.lit(1), *marked).alias("k2"),
                      F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = stage(fingerprints(keyed.select("id", "k1", "k2", "text"), shingle=shingle, keep_text=False), "fingerprints")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    classes = stage(rows.groupBy("fp").agg(F.min(rank).alias("first")), "classes")
    kept = _labelled(classes, radius).select("label.*").select("k1", "k2").distinct()
    times = rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    kept = stage(kept.join(times, ["k1", "k2"]), "kept")
    once = keyed.join(kept.filter("n = 1"), ["k1", "k2"], "left_semi")
    repeated = keyed.join(kept.filter("n > 1"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return once.unionByName(repeated).select("row.*")
