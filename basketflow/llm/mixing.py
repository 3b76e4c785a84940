"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by *membership pattern* (the set of sources they
   belong to): sizes per pattern, a small table.
2. A flow network routes size from patterns to the quotas of the sources.  A
   pattern offers its size once at cost 0, again at cost 1, a third time at
   cost 3, ... (convex repetition costs, ``repeats`` times at most), so that a
   second use starts only where first uses cannot fill the quotas.
3. The flow of a pattern says how often its documents are taken: everybody the
   full number of rounds, and for the part of a round that remains documents
   in seeded hash order.  The cut in that order is found by radix descent over
   hash bits (aggregates of 256 buckets per pattern and step, no sort of a
   pattern), then the longest document that fits the rest and the smallest ones
   close the gap.

Rules: a null source is a source of its own, after all others; a null text has
size 0 and is never taken; a document of no source (empty or null members) is
never taken and has neither target nor source size; equal rows are told apart
by nothing and so share one decision; equal inputs and seed give equal results.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.common import packed, stage

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3                # a document is taken this often at most
SEED = 20
DIGIT_BITS = 8             # hash bits per descent step
MAX_PATTERNS = 500_000     # the pattern table is solved on the driver and broadcast: more are refused


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], repeats: int = REPEATS) -> dict[str | None, float]:
    """Target size per source: weights 1, 2, 3, 1, ... by code point, null last.

    The weights share the whole size; a target stops at ``repeats`` times its
    source's size and the excess is shared again by weight.
    """
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    capped: dict[str | None, float] = {}
    left, free = float(sum(sizes.values())), list(order)
    while free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            return capped | share
        for s in over:
            capped[s] = float(repeats * sizes[s])
        left = max(0.0, left - sum(capped[s] for s in over))
        free = [s for s in free if s not in capped]
    return capped


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


def min_cost_flow(size: list[int], member: list[set[int]], quota: list[int], repeats: int = REPEATS) -> list[int]:
    """Size taken of each pattern: a minimum-cost maximum flow.

    ``size[p]``: size of pattern ``p``; ``member[p]``: the sources it counts
    for; ``quota[s]``: size wanted of source ``s``.  Successive shortest paths
    with potentials over patterns + sources + 2 nodes.
    """
    n_p, n_s = len(size), len(quota)
    graph: list[list[_Edge]] = [[] for _ in range(n_p + n_s + 2)]
    source, sink = n_p + n_s, n_p + n_s + 1

    def link(a: int, b: int, room: int, cost: int) -> None:
        graph[a].append(_Edge(b, room, cost, len(graph[b])))
        graph[b].append(_Edge(a, 0, -cost, len(graph[a]) - 1))

    for p in range(n_p):
        for k in range(repeats):
            link(source, p, size[p], k * (k + 1) // 2)      # convex: 0, 1, 3, ...
        for s in sorted(member[p]):
            link(p, n_p + s, repeats * size[p], 0)
    for s in range(n_s):
        link(n_p + s, sink, quota[s], 0)
    potential = [0] * len(graph)
    while True:
        dist = [None] * len(graph)
        via: list[tuple[int, int] | None] = [None] * len(graph)
        dist[source] = 0
        heap = [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for i, e in enumerate(graph[u]):
                nd = d + e.cost + potential[u] - potential[e.to]
                if e.room > 0 and (dist[e.to] is None or nd < dist[e.to]):
                    dist[e.to], via[e.to] = nd, (u, i)
                    heapq.heappush(heap, (nd, e.to))
        if dist[sink] is None:
            break
        far = max(d for d in dist if d is not None)
        potential = [x + (far if d is None else d) for x, d in zip(potential, dist, strict=True)]
        push, v = None, sink
        while v != source:
            u, i = via[v]
            push = graph[u][i].room if push is None else min(push, graph[u][i].room)
            v = u
        v = sink
        while v != source:
            u, i = via[v]
            e = graph[u][i]
            e.room -= push
            graph[e.to][e.back].room += push
            v = u
    left = [0] * n_p
    for e in graph[source]:
        left[e.to] += e.room
    return [repeats * n - x for n, x in zip(size, left, strict=True)]


def route(size: list[int], member: list[set[int]], quota: list[int], repeats: int = REPEATS) -> list[int]:
    """:func:`min_cost_flow`, solved apart for sources that no pattern connects."""
    root = list(range(len(quota)))

    def find(s: int) -> int:
        while root[s] != s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for m in member:
        first = min(m)
        for s in m:
            root[find(s)] = find(first)
    patterns: dict[int, list[int]] = {}
    for p, m in enumerate(member):
        patterns.setdefault(find(min(m)), []).append(p)
    out = [0] * len(size)
    for ps in patterns.values():
        if len(ps) == 1 and len(member[ps[0]]) == 1:            # an unconnected source needs no search
            out[ps[0]] = min(repeats * size[ps[0]], quota[min(member[ps[0]])])
            continue
        number = {s: i for i, s in enumerate(sorted(set().union(*(member[p] for p in ps))))}
        flow = min_cost_flow([size[p] for p in ps], [{number[s] for s in member[p]} for p in ps],
                             [quota[s] for s in number], repeats)
        for p, f in zip(ps, flow, strict=True):
            out[p] = f
    return out


def _cuts(rows: DataFrame, want: dict[str, int], bits: int = 64) -> dict[str, tuple[int, int]]:
    """Per pattern the hash bound below which documents are taken, and the size still missing.

    ``rows``: ``pattern, h`` (unsigned order of 64 bits), ``size``; ``want``:
    size wanted per pattern.  Each step looks at the next ``DIGIT_BITS`` bits
    of the hashes inside the current interval: at most 256 sums per pattern,
    of which the executors return the one where the size wanted is reached.
    """
    done: dict[str, tuple[int, int]] = {}
    spark = rows.sparkSession
    state = {p: (0, w) for p, w in want.items()}                 # interval's prefix, size missing
    shift = bits
    while state and shift > 0:
        shift -= DIGIT_BITS
        # one row per pattern: as small as the pattern table itself
        at = spark.createDataFrame([(p, pre, miss) for p, (pre, miss) in state.items()],
                                   "pattern string, pre long, miss long")
        digit = F.shiftrightunsigned("h", shift).bitwiseAND((1 << DIGIT_BITS) - 1)
        inside = rows.join(F.broadcast(at), "pattern")
        if shift + DIGIT_BITS < bits:
            inside = inside.filter(F.shiftrightunsigned("h", shift + DIGIT_BITS) == F.col("pre"))
        upto = F.sum("s").over(Window.partitionBy("pattern").orderBy("d"))
        sums = inside.groupBy("pattern", "miss", digit.alias("d")).agg(
            F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
        reached = F.min(F.when(F.col("upto") > F.col("miss"), F.struct(
            "d", "n", (F.col("upto") - F.col("s")).alias("before"))))
        got = {r["pattern"]: r for r in sums.groupBy("pattern").agg(
            reached.alias("cut"), F.max("upto").alias("all")).collect()}       # one row per pattern
        nxt = {}
        for p, (pre, miss) in state.items():
            cut, alone = 1 << DIGIT_BITS, False
            if p in got and got[p]["cut"] is not None:
                cut, alone = got[p]["cut"]["d"], got[p]["cut"]["n"] == 1
                miss -= got[p]["cut"]["before"]
            elif p in got:
                miss -= got[p]["all"]
            if cut == 1 << DIGIT_BITS:                          # the whole interval fits
                done[p] = ((pre + 1) << shift + DIGIT_BITS, miss)
            elif miss == 0 or shift == 0 or alone:
                done[p] = ((pre << DIGIT_BITS | cut) << shift, miss)
            else:
                nxt[p] = (pre << DIGIT_BITS | cut, miss)
        state = nxt
    return done


def _taken(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", members: Column | None = None,
           quotas: dict[str | None, float] | None = None, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """``row`` (the columns of ``df``), ``size``, ``pattern``, ``source_size``, ``target`` and ``copies``."""
    members = F.array(F.col("source").cast("string")) if members is None else members
    members = F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>"))))
    # a pattern's name: its sources with their lengths, so that names never run together; null apart
    name = F.array_join(F.transform(members, lambda s: F.when(
        s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s), F.lit(":"), s))), "")
    d = df.select(packed(df).alias("row"),
                  word_count(F.col(f"`{text_col}`").cast("string")).alias("size"), name.alias("pattern"),
                  members.alias("members"),
                  F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
                             ).alias("h"))
    thin = stage(d.select("pattern", "h", "size", "members"), "mix")
    pats = thin.groupBy("pattern").agg(F.sum("size").alias("size"), F.first("members").alias("members")) \
        .orderBy("pattern").limit(MAX_PATTERNS + 1).collect()    # one row per membership pattern
    if len(pats) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: merge sources first")
    pats = [r for r in pats if r["members"]]                     # documents of no source are not taken
    sizes: dict[str | None, int] = {}
    for r in pats:
        for s in set(r["members"]):
            sizes[s] = sizes.get(s, 0) + r["size"]
    goal = targets(sizes, repeats) if quotas is None else quotas
    number = {s: i for i, s in enumerate(goal)}
    flow = route([r["size"] for r in pats], [{number[s] for s in r["members"]} for r in pats],
                 [round(goal[s]) for s in goal], repeats)
    full = {r["pattern"]: (f // r["size"] if r["size"] else 0) for r, f in zip(pats, flow, strict=True)}
    part = {r["pattern"]: (f % r["size"] if r["size"] else 0) for r, f in zip(pats, flow, strict=True)}
    open_ = {p: w for p, w in part.items() if w}
    cut = _cuts(thin.select("pattern", "h", "size"), open_) if open_ else {}
    close = _closing(thin, cut)
    plan = [(r["pattern"], full[r["pattern"]], _signed(cut[r["pattern"]][0]) if r["pattern"] in cut else None,
             cut[r["pattern"]][0] >= 1 << 64 if r["pattern"] in cut else False, *close.get(r["pattern"], _NO_CLOSING),
             sizes[r["members"][0]], float(goal[r["members"][0]])) for r in pats]
    table = df.sparkSession.createDataFrame(
        plan, "pattern string, full long, cut long, every boolean, one long, two long, small long, bound long, all_small boolean, "
              "source_size long, target double")
    below = F.col("every") | _under("h", "cut")
    yes = [F.coalesce(c, F.lit(False)) for c in (
        below, F.col("h") == F.col("one"), F.col("h") == F.col("two"), F.col("size") < F.col("small"),
        (F.col("size") == F.col("small")) & (F.col("all_small") | _under("h", "bound")))]
    extra = F.when(F.col("cut").isNull(), F.lit(0)).when(yes[0] | yes[1] | yes[2] | yes[3] | yes[4], F.lit(1)) \
        .otherwise(F.lit(0))
    return d.join(F.broadcast(table), "pattern", "left") \
        .withColumn("copies", F.when((F.col("size") == 0) | F.col("full").isNull(), F.lit(0))
                    .otherwise(F.col("full") + extra).cast("long")) \
        .select("row", "size", "pattern", "source_size", "target", "copies")


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", members: Column | None = None,
           quotas: dict[str | None, float] | None = None, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """``df`` with ``size``, ``pattern``, ``source_size``, ``target`` and ``copies``.

    ``members``: array of the sources that a document belongs to (default: its
    ``source``).  ``quotas``: target per source (default :func:`targets`).
    ``source_size`` and ``target`` are those of a document's first source.
    """
    new = ("size", "pattern", "source_size", "target", "copies")
    taken = _taken(df, id_col, text_col, members, quotas, repeats, seed)
    return taken.select(*[F.col(f"row.`{c}`") for c in df.columns if c not in new], *new)


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _under(h: str, bound: str) -> Column:
    """``h`` is below ``bound`` as unsigned numbers of 64 bits."""
    flip = F.lit(-(1 << 63))
    return F.col(h).bitwiseXOR(flip) < F.col(bound).bitwiseXOR(flip)


#: Two documents, a size below which all are taken, a hash bound for those of that size, and whether all of them are.
_NO_CLOSING = (None, None, None, None, False)


def _closing(thin: DataFrame, cut: dict[str, tuple[int, int]]) -> dict[str, tuple]:
    """Per pattern the documents beyond the cut that bring the sum near to the wanted size (see ``_NO_CLOSING``).

    First the longest document that fits; what is still missing is filled with the smallest documents,
    whole sizes by running sums and of the last size as many as come nearest, in hash order; if all fit, the
    smallest of those that do not is added where that narrows the gap.  The number of jobs is the
    same for any number of documents.
    """
    spark = thin.sparkSession
    todo = {p: (c, m) for p, (c, m) in cut.items() if m and c < 1 << 64}
    if not todo:
        return {}
    at = spark.createDataFrame([(p, _signed(c), m) for p, (c, m) in todo.items()], "pattern string, cut long, miss long")
    rest = thin.join(F.broadcast(at), "pattern").filter(~_under("h", "cut") & (F.col("size") > 0))
    units = rest.groupBy("pattern", "h", "miss").agg(F.sum("size").alias("size"))      # equal rows go together
    fit = F.max(F.when(F.col("size") <= F.col("miss"), F.struct("size", "h"))).alias("fit")
    over = F.min(F.when(F.col("size") > F.col("miss"), F.struct("size", "h"))).alias("over")
    found = {r["pattern"]: r for r in units.groupBy("pattern").agg(fit, over).collect()}
    one = {p: found[p]["fit"] for p in todo if p in found and found[p]["fit"] is not None}
    left = {p: m - (one[p]["size"] if p in one else 0) for p, (_, m) in todo.items()}
    small: dict[str, tuple] = {}                                 # size, bound, all
    still = [(p, _signed(todo[p][0]), left[p], one[p]["h"]) for p in one if left[p] > 0]
    if still:
        at = spark.createDataFrame(still, "pattern string, cut long, miss long, one long")
        rest = thin.join(F.broadcast(at), "pattern") \
            .filter(~_under("h", "cut") & F.col("size").between(1, F.col("miss")) & (F.col("h") != F.col("one")))
        upto = F.sum(F.col("n") * F.col("size")).over(Window.partitionBy("pattern").orderBy("size"))
        sums = rest.groupBy("pattern", "miss", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
        last = F.min(F.when(F.col("upto") > F.col("miss"),
                            F.struct("size", (F.col("upto") - F.col("n") * F.col("size")).alias("before"))))
        wanted: dict[str, int] = {}
        for r in sums.groupBy("pattern", "miss").agg(last.alias("last"), F.max("size").alias("top"),
                                                     F.max("upto").alias("all")).collect():
            p = r["pattern"]
            if r["last"] is None:                                # all of them fit
                small[p] = (r["top"] + 1, None, False)
                left[p] -= r["all"]
            else:
                size, missing = r["last"]["size"], left[p] - r["last"]["before"]
                small[p] = (size, 0, False)
                wanted[p] = missing // size + (2 * (missing % size) > size)
                left[p] = 0
        if wanted := {p: n for p, n in wanted.items() if n}:
            sizes = spark.createDataFrame([(p, small[p][0]) for p in wanted], "pattern string, small long")
            rows = rest.join(F.broadcast(sizes), "pattern").filter("size = small") \
                .select("pattern", "h", F.lit(1).cast("long").alias("size"))
            for p, (bound, _) in _cuts(rows, wanted).items():
                small[p] = (small[p][0], _signed(bound), bound >= 1 << 64)
    out = {}
    for p in todo:
        b = found[p]["over"] if p in found else None
        two = b["h"] if b is not None and left[p] > 0 and b["size"] < 2 * left[p] else None
        out[p] = (one[p]["h"] if p in one else None, two, *small.get(p, _NO_CLOSING[2:]))
    return out


def mix(df: DataFrame, **options) -> DataFrame:
    """The mixed rows: each row as often as it is taken, with the columns of ``df`` as they are."""
    return _taken(df, **options).filter("copies > 0") \
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
