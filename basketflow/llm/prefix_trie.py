"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node stands for a distinct sequence of first turns.  :func:`number_turns`
orders the turns, :func:`trie` makes the nodes, :func:`subtree_totals` adds up any
weights over every node's subtree.

Nodes.  A turn at depth ``d`` gets 128 bits from its depth and the digest of its
role and text; running sums of four 32-bit limbs (whole numbers, nothing wraps) name
every prefix, so a conversation of any length is numbered in slices and never sits
in one task.  Each node checks that all its members carry the same last turn and
the same parent name, which by induction makes the names exact: a collision stops the job.

Contraction.  Rounds alternate *rake* (leaves are final and hand their totals to
their parents, summed before the shuffle) and *compress* (every chain of nodes with
one child is shortened to its bottom by pointer doubling).  After a compress each inner
node has two children or more, so a rake takes at least half of the nodes and the number of rounds is
logarithmic in the trie's size, however deep it is.  The compressed nodes are then
re-expanded, last round first: a chain node's total is that of its bottom plus what
was summed on the way.  Joins are on unique node ids on one side; rows of a popular
parent are summed first or split by the adaptive skew join.

Rules: a null role or text is empty; null turns come first; rows with the same turn are
ordered by the digest of their role and text; rows without a conversation id belong to no conversation;
an empty table has no nodes, any other has a root of depth 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import drop_stage, stage
from basketflow.operators.prefix import running_totals

KEY = ["depth", "s1", "s2", "s3", "s4"]
#: Conversation ids written into one piece of a node's list of ends.
PIECE = 1 << 16


def number_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``conv_id, depth`` (1 for the first turn), ``digest`` of role and text, ``chars`` (code points of the text)."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                      F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
                      F.length(text).cast("long").alias("chars")).filter("conv_id IS NOT NULL")
    return running_totals(turns, ["turn", "digest"], keys=["conv_id"], count_col="depth") \
        .select("conv_id", F.col("depth").cast("long").alias("depth"), "digest", "chars")


def _limbs() -> dict[str, Column]:
    out = {}
    for k in (0, 1):
        h = F.xxhash64(F.lit(k), "depth", "digest")
        out[f"s{2 * k + 1}"] = h.bitwiseAND(F.lit(0xFFFFFFFF))
        out[f"s{2 * k + 2}"] = F.shiftrightunsigned(h, 32)
    return out


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, digest, chars`` with the names ``s1`` to ``s4`` of the prefix that ends there and
    ``p1`` to ``p4`` of the one before (written below the shared folder)."""
    named = running_totals(turns, ["depth"], keys=["conv_id"], sums=_limbs(), count_col="nth").drop("nth")
    limbs = _limbs()
    return stage(named.withColumns({f"p{k}": F.col(f"s{k}") - limbs[f"s{k}"] for k in range(1, 5)}), "prefixes")


def _same(column: str) -> Column:
    return F.when(F.min(column).eqNullSafe(F.max(column)), F.max(column)) \
        .otherwise(F.raise_error(F.lit(f"two prefixes share a name ({column})")))


def trie(convs: DataFrame, prefix: DataFrame) -> DataFrame:
    """The nodes: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, chars`` (of the last turn's text) and ``KEY``.

    ``convs`` lists every conversation once (``conv_id``), ``prefix`` comes from :func:`prefixes`.
    """
    spark = convs.sparkSession
    first, count = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    root = spark.createDataFrame([(first, count)] if count else [], "conv_id long, n_convs long") \
        .select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(k) for k in KEY[1:]],
                F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(0).cast("long").alias("chars"))
    inner = stage(prefix.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        _same("digest").alias("digest"), *[_same(f"p{k}").alias(f"p{k}") for k in range(1, 5)]), "trie-nodes")
    above = inner.select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"),
                         *[F.col(f"s{k}").alias(f"p{k}") for k in range(1, 5)])
    out = ["conv_id", *KEY, "parent_conv_id", "n_convs", "chars"]
    top = inner.filter("depth = 1").withColumn("parent_conv_id", F.lit(first).cast("long")).select(out)
    rest = inner.filter("depth > 1").join(above, ["depth", "p1", "p2", "p3", "p4"]).select(out)
    return root.select(out).unionByName(top).unionByName(rest)


def _sums(prefix: str, names: list[str]) -> list[Column]:
    return [F.sum(f"{prefix}{n}").alias(f"{prefix}{n}") for n in names]


def subtree_totals(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """``id`` and, for every weight, its sum over the subtree of the node, itself included.

    ``nodes`` has unique ``id``, ``parent`` (null for roots, else an ``id`` of the table; no cycles)
    and the weights (longs).  A forest of any depth; an empty table gives an empty frame.
    """
    # a: the node's weight and what was raked below it; e: handed up with its total, of chain nodes cut out above it
    active = stage(nodes.select("id", "parent", *[F.col(w).cast("long").alias(f"a{w}") for w in weights],
                                *[F.lit(0).cast("long").alias(f"e{w}") for w in weights]), "trie-active")
    final, chains = [], []
    empty = active.isEmpty()
    while not empty:
        # rake
        parents = active.filter("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct()
        leaves = stage(active.join(parents, "id", "left_anti"), "trie-leaves")
        final.append(leaves.select("id", *[F.col(f"a{w}").alias(w) for w in weights]))
        up = leaves.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")) \
            .agg(*[F.sum(F.col(f"a{w}") + F.col(f"e{w}")).alias(f"u{w}") for w in weights])
        rest = active.join(parents, "id", "left_semi").join(up, "id", "left") \
            .withColumns({f"a{w}": F.col(f"a{w}") + F.coalesce(f"u{w}", F.lit(0)) for w in weights}) \
            .drop(*[f"u{w}" for w in weights])
        rest, old = stage(rest, "trie-active"), active
        drop_stage(old)
        empty = rest.isEmpty()
        if empty:
            break
        # compress: the only child of a node is next; total(id) = total(next) + k
        only = rest.filter("parent IS NOT NULL").groupBy("parent").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("next"), *_sums("e", weights)).filter("n = 1") \
            .select(F.col("parent").alias("id"), "next", *[F.col(f"e{w}").alias(f"x{w}") for w in weights])
        chain = stage(rest.select("id", *[f"a{w}" for w in weights]).join(only, "id").select(
            "id", "next", *[(F.col(f"a{w}") + F.col(f"x{w}")).alias(f"k{w}") for w in weights]), "trie-chain")
        if not chain.isEmpty():
            links, moved = chain, True
            while moved:
                ahead = chain.select(F.col("id").alias("next"), F.col("next").alias("far"),
                                     *[F.col(f"k{w}").alias(f"f{w}") for w in weights])
                further = stage(chain.join(ahead, "next", "left").select(
                    "id", F.coalesce("far", "next").alias("next"),
                    *[(F.col(f"k{w}") + F.coalesce(f"f{w}", F.lit(0))).alias(f"k{w}") for w in weights],
                    F.col("far").isNotNull().alias("moved")), "trie-chain")
                moved = not further.filter("moved").isEmpty()
                if chain is not links:
                    drop_stage(chain)
                chain = further
            heads = chain.join(links.select(F.col("next").alias("id")), "id", "left_anti") \
                .join(rest.select("id", "parent", *[f"e{w}" for w in weights]), "id") \
                .select(F.col("next").alias("id"), F.col("parent").alias("top"),
                        *[(F.col(f"k{w}") + F.col(f"e{w}")).alias(f"t{w}") for w in weights], F.lit(True).alias("cut"))
            kept = rest.join(chain.select("id"), "id", "left_anti").join(heads, "id", "left").select(
                "id", F.when(F.col("cut"), F.col("top")).otherwise(F.col("parent")).alias("parent"),
                *[f"a{w}" for w in weights],
                *[F.when(F.col("cut"), F.col(f"t{w}")).otherwise(F.col(f"e{w}")).alias(f"e{w}") for w in weights])
            active = stage(kept, "trie-active")
            drop_stage(rest)
            drop_stage(links)
            chains.append(chain)
        else:
            active = rest
    if not final:
        return nodes.select("id", *weights)
    totals = final[0]
    for f in final[1:]:
        totals = totals.unionByName(f)
    for chain in reversed(chains):
        below = totals.select(F.col("id").alias("next"), *weights)
        again = chain.join(below, "next").select("id", *[(F.col(f"k{w}") + F.col(w)).alias(w) for w in weights])
        totals = stage(totals.unionByName(again), "trie-totals")
    return totals


def end_digests(ends: DataFrame) -> DataFrame:
    """``KEY`` and ``ends_sha256``: the SHA-256 of a node's conversation ids, ascending and joined by commas.

    ``ends`` has a row per conversation: ``conv_id`` and the ``KEY`` of the node it ends in.  Ids are joined
    into pieces in ranges of (node, id); a node's pieces then stream through one hash, never held together.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def piece() -> pa.RecordBatch:
            cols = [pa.array([x], pa.int64()) for x in (*key, ids[0])]
            return pa.RecordBatch.from_arrays([*cols, pa.array([",".join(map(str, ids))], pa.string())],
                                              names=[*KEY, "first", "ids"])

        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True)
            for k, group in groupby(rows, lambda r: r[:5]):
                if k != key and ids:
                    yield piece()
                    ids = []
                key = k
                for r in group:
                    ids.append(r[5])
                    if len(ids) == PIECE:
                        yield piece()
                        ids = []
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *k, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
                if k != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            yield _digest_rows(done)
        if key is not None:
            yield _digest_rows([(*key, state.hexdigest())])

    kinds = ", ".join(f"{k} long" for k in KEY)
    order = [*KEY, "conv_id"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(pieces, f"{kinds}, first long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, f"{kinds}, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.string())],
                                      names=[*KEY, "ends_sha256"])


def summary(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes with their counts and subtree totals.

    ``convs`` has every conversation once (``conv_id``, also those without turns); ``turns`` is like the result of
    :func:`number_turns`, depths 1, 2, ... in every conversation.  Returns ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256`` (see ``queries.op12_prefix_trie``).
    """
    convs = stage(convs.select("conv_id"), "trie-convs")
    prefix = prefixes(turns)
    nodes = stage(trie(convs, prefix), "trie")
    me, parent = F.struct("conv_id", "depth"), F.struct(F.col("parent_conv_id").alias("conv_id"),
                                                        (F.col("depth") - 1).alias("depth"))
    named = nodes.select(me.alias("id"), F.when(F.col("parent_conv_id").isNotNull(), parent).alias("parent"), "n_convs", "chars")
    kids = named.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    known = stage(named.join(kids, "id", "left").select(
        "id", "parent", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "trie-weights")
    totals = subtree_totals(known.select("id", "parent", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"])
    last = prefix.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(F.col(f"last.{k}"), zero).alias(k) for k in KEY])
    hashes = end_digests(stage(ends, "trie-ends"))
    rows = nodes.join(hashes, KEY, "left").withColumn("id", F.struct("conv_id", "depth")) \
        .join(known.select("id", "n_children"), "id").join(totals, "id")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def share_openings(turns: DataFrame, every: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on shared openings: ``(convs, turns)`` for :func:`summary`.

    Conversation ``c`` takes the first ``h`` turns of conversation ``c - c mod every`` (what it has of them) and
    then its own turns after its first ``h``, ``h`` being the CRC-32 of its decimal id modulo ``most + 1``.
    ``turns`` is the result of :func:`number_turns`.
    """
    turns = stage(turns, "turns")
    c = F.col("conv_id")
    convs = turns.select("conv_id").distinct() \
        .withColumns({"h": F.crc32(c.cast("string").cast("binary")) % (most + 1),
                      "base": c - F.pmod(c, F.lit(every).cast("long"))})
    openings = turns.filter((F.pmod(c, F.lit(every).cast("long")) == 0) & (F.col("depth") <= most)) \
        .select(c.alias("base"), "depth", "digest", "chars")
    lengths = openings.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    convs = stage(convs.join(lengths, "base", "left")
                  .withColumn("taken", F.least("h", F.coalesce("n", F.lit(0)))).drop("n"), "convs")
    shared = convs.select("conv_id", "base", "h").join(openings, "base").filter("depth <= h") \
        .select("conv_id", "depth", "digest", "chars")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("depth > h") \
        .select("conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "digest", "chars")
    return convs.select("conv_id"), shared.unionByName(own)
