"""Embedding near-duplicates through a pivot-permutation index.

* Reference points: a hash sample of at most ``SAMPLE`` distinct vectors,
  thinned to ``PIVOTS`` by farthest-first traversal that stops at a cosine of
  ``SPREAD``, so that a crowd of near copies gets one pivot, not all of them;
  seeded random directions fill the rest (bounded and documented; the index
  itself holds every vector).
* Vectors are looked at from the sample's middle, so that a direction they all share does not
  make all of them look alike.  A vector is described by its nearest pivots, as many
  (``PREFIXES``) as the sample needs to bring partners back (:func:`fit`).  Inverted lists per
  (label, pivot) bring together vectors that share pivots; a pair is a
  candidate if it shares ``SHARED`` of them.  Two sets of n pivots that share SHARED of them
  share one among their n - SHARED + 1 rarest, so only those lists are written.
* A long list is cut into blocks; every pair of blocks is one tile, so a list
  that holds a third of all rows is many tasks.  A tile counts shared pivots
  and verifies cosines in double precision with matrix products, and returns
  per vector its number of links and a local representative -- never pairs.
  A pair that meets in several lists counts in the list of its rarest common
  pivot only.

Rules: vectors that are null, zero, or hold null or non-finite components, and
rows with a null label link with nothing; only vectors of one label and one
length are compared; equal vectors of a label are one class with a count (told by 128 bits);
rows with a null id take part, a component's id is its smallest non-null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import stage, with_fields
from basketflow.llm.components import Forest, components

PIVOTS = 512               # reference points
SAMPLE = 4096              # distinct vectors from which they are taken, at most
PREFIXES = (10, 12, 14, 16, 20, 24, 32)    # pivots that describe a vector: the first that brings back AIM of the probes
PROBES, AIM = 512, 0.92    # sampled vectors with a made-up partner at the threshold
SHARED = 4                 # pivots that a candidate pair shares
BLOCK = 1024               # vectors of a list in one block
THRESHOLD = 0.98
SPREAD = 0.85              # no two sampled pivots are nearer than this cosine
SEED = 2


def farthest_first(x: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` rows of unit vectors ``x``, each the farthest from those before it."""
    if not len(x):
        return x
    picked, near = [0], x @ x[0]
    while len(picked) < min(count, len(x)):
        k = int(near.argmin())
        if near[k] > SPREAD:
            break
        picked.append(k)
        near = np.maximum(near, x @ x[k])
    return x[picked]


def _unit(table_column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    col = table_column.combine_chunks() if isinstance(table_column, pa.ChunkedArray) else table_column
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    """Of one vector length: the middle of the sample, the reference points seen from it, and how many describe a vector."""

    middle: np.ndarray
    pivots: np.ndarray
    prefix: int

    def describe(self, x: np.ndarray, prefix: int | None = None) -> np.ndarray:
        """The nearest pivots of unit vectors, nearest first."""
        n = prefix or self.prefix
        sim = (x - self.middle) @ self.pivots.T
        top = np.argpartition(-sim, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(sim, top, 1), axis=1, kind="stable")
        return np.take_along_axis(top, order, 1)


def _unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def fit(x: np.ndarray, dim: int, threshold: float = THRESHOLD) -> Index:
    """An index from sampled unit vectors ``x`` (none: random directions).

    Vectors with a common direction all lie near the same points, so they are looked at from
    their middle.  A vector is described by as few pivots as bring back ``AIM`` of sampled
    vectors' partners at exactly the threshold, in random directions: links are nearer.
    """
    rng = np.random.default_rng(SEED + dim)
    middle = x.mean(0) if len(x) else np.zeros(dim)
    pivots = farthest_first(_unit_rows(x - middle), PIVOTS)
    if len(pivots) < PIVOTS:
        extra = _unit_rows(rng.standard_normal((PIVOTS, dim)))
        pivots = extra if not len(pivots) else np.concatenate((pivots, extra))[:PIVOTS]
    some = x[:PROBES]
    aside = rng.standard_normal(some.shape)
    aside = _unit_rows(aside - (aside * some).sum(1, keepdims=True) * some)
    there = threshold * some + np.sqrt(1 - threshold ** 2) * aside
    index = Index(middle, pivots, PREFIXES[0])
    if not len(some):
        return index
    a, b = index.describe(some, PREFIXES[-1]), index.describe(there, PREFIXES[-1])
    for n in PREFIXES:
        shared = (a[:, :n, None] == b[:, None, :n]).sum((1, 2))
        if (shared >= SHARED).mean() >= AIM:
            break
    return Index(middle, pivots, n)


def reference_points(classes: DataFrame, threshold: float = THRESHOLD) -> dict[int, Index]:
    """The index of every vector length that the sample holds."""
    rows = classes.select("vec", "k1").orderBy("k1").limit(SAMPLE).collect()     # bounded by SAMPLE
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r["vec"]), []).append(r["vec"])
    return {dim: fit(_unit_rows(np.array(vs, np.float64)), dim, threshold) for dim, vs in by_dim.items()}


def index_of(known: dict[int, Index], dim: int) -> Index:
    """The sampled index of vectors of length ``dim``, else one of random directions."""
    return known.get(dim) or fit(np.empty((0, dim)), dim)


def pivots_of(known: dict[int, Index], dim: int) -> np.ndarray:
    return index_of(known, dim).pivots


def describe(classes: DataFrame, known: dict[int, Index]) -> DataFrame:
    """Add ``near``: the nearest pivots, nearest first."""
    schema = with_fields(classes.schema, [T.StructField("near", T.ArrayType(T.IntegerType()))])
    names = [f.name for f in classes.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            near: list = [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                index = index_of(known, int(dim))
                for k, row in zip(at, index.describe(_unit(batch.column("vec").take(pa.array(at)), int(dim))), strict=True):
                    near[k] = row
            flat = pa.array(near, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [flat], names=schema.names)

    return classes.mapInArrow(run, schema)


def _tile(rank: int, ids: np.ndarray, x: np.ndarray, near: np.ndarray, copies: np.ndarray, low: np.ndarray,
          both: bool, threshold: float) -> tuple[np.ndarray, Forest]:
    """(weighted links per row, forest of links); ``both``: two different blocks."""
    a = np.flatnonzero(low) if both else np.arange(len(ids))
    b = np.flatnonzero(~low) if both else a
    # near: pivots as rarity ranks in ascending order; compact one-hot over the ranks that occur
    used, col = np.unique(near, return_inverse=True)
    hot = np.zeros((len(ids), len(used)), np.float32)
    np.put_along_axis(hot, col.reshape(near.shape), 1, axis=1)
    indexed = np.zeros_like(hot)                    # the lists this vector is in, rarer than this one
    lists = near.shape[1] - SHARED + 1
    rare = near[:, :lists]
    np.put_along_axis(indexed, col.reshape(near.shape)[:, :lists],
                      (rare < rank).astype(np.float32), axis=1)
    links = np.zeros(len(ids), np.int64)
    forest = Forest(len(ids))
    for s in range(0, len(a), 256):                 # bounded memory per step
        r = a[s:s + 256]
        ok = (hot[r] @ hot[b].T >= SHARED) & (indexed[r] @ indexed[b].T == 0) & (x[r] @ x[b].T >= threshold)
        if not both:
            ok &= r[:, None] != b[None, :]
        links[r] += ok @ copies[b]
        if both:
            links[b] += copies[r] @ ok
        i, j = np.nonzero(ok)
        if len(i):
            forest.add(r[i], b[j])
    return links, forest


def links(described: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``h, links, rep``: per tile and vector with links, their number and a linked representative."""
    # rarity: pivots by the number of vectors they describe (at most lengths x PIVOTS rows come back)
    freq = described.select("dim", F.explode("near").alias("p")).groupBy("dim", "p").count().collect()
    rank = {(r["dim"], r["p"]): k for k, r in enumerate(sorted(freq, key=lambda r: (r["count"], r["dim"], r["p"])))}
    table = described.sparkSession.createDataFrame(
        [(d, [rank.get((d, p), 0) for p in range(PIVOTS)]) for d in sorted({d for d, _ in rank})],
        "dim int, ranks array<int>")
    ranked = described.join(F.broadcast(table), "dim").withColumn(
        "near", F.sort_array(F.transform("near", lambda p: F.element_at("ranks", p + 1)))).drop("ranks")
    listed = ranked.withColumn("list", F.explode(F.slice("near", F.lit(1), F.size("near") - (SHARED - 1))))
    sizes = ranked.select("label", "dim", F.explode(F.slice("near", F.lit(1), F.size("near") - (SHARED - 1))).alias("list")) \
        .groupBy("label", "dim", "list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
                                             F.count(F.lit(1)).alias("members")).filter("members > 1")
    tiles = listed.join(sizes.drop("members"), ["label", "dim", "list"]) \
        .withColumn("own", F.pmod(F.xxhash64("h", F.lit(11)), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("label", "dim", "list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") <= F.col("other")).alias("low"), "h", "vec", "near", "copies")

    def run(key: tuple, t: pa.Table) -> pa.Table:
        dim, rank_of, i, j = (k.as_py() for k in key[1:])
        ids = t.column("h").to_numpy()
        low = t.column("low").to_numpy()
        both = i != j
        if len(ids) < 2 or (both and (low.all() or not low.any())):
            return pa.table({"h": pa.array([], pa.int64()), "links": pa.array([], pa.int64()),
                             "rep": pa.array([], pa.int64())})
        near = t.column("near").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        got, forest = _tile(rank_of, ids, _unit(t.column("vec"), dim), near, t.column("copies").to_numpy(), low,
                            both, threshold)
        at = np.flatnonzero(got)
        return pa.table({"h": ids[at], "links": got[at], "rep": ids[forest.label[at]]})

    return tiles.groupBy("label", "dim", "list", "i", "j").applyInArrow(run, "h long, links long, rep long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row."""
    v = F.col("vec")
    sound = v.isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) \
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("vec")) \
        .withColumn("k1", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", "vec"))) \
        .withColumn("k2", F.xxhash64(F.lit(1), "vec", "label"))
    thin = stage(rows.select("id", "k1", "k2"), "vec-rows")
    # a class of equal vectors is told by 128 bits and numbered where it is written
    classes = rows.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
        F.first("vec").alias("vec")).withColumn("dim", F.size("vec"))
    classes = stage(classes.withColumn("h", F.monotonically_increasing_id()), "vec-classes")
    described = stage(describe(classes.select("h", "label", "dim", "vec", "copies"), reference_points(classes, threshold)), "vec-near")
    found = stage(links(described, threshold), "vec-links")
    comp = components(found.select("h", "rep"), "h", "rep")
    degree = found.groupBy("h").agg(F.sum("links").alias("links"))
    member = classes.select("h", "first").join(comp, F.col("h") == F.col("node")).select("h", "first", "component")
    named = member.join(member.groupBy("component").agg(F.min("first").alias("smallest")), "component") \
        .select("h", "smallest")
    label = classes.select("h", "k1", "k2", "first", "copies").join(degree, "h", "left").join(named, "h", "left").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("smallest", "first").alias("component_id"))
    linked = thin.filter("k1 is not null").join(label, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = thin.filter("k1 is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
