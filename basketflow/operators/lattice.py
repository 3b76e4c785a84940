"""Dictionary segmentation (F9, F10): the best path through a word lattice.

The dictionary is the corpus's own words of 2 to ``LONGEST`` characters that occur at least
``MIN_COUNT`` times.  A token's lattice has an edge for every dictionary word inside it and one for
every single character; a word costs ``ln(N / n)`` in thousandths (``N`` all occurrences), a character more than any word.  The
segmentation is the path of least cost (ties: fewer pieces, then the longer
last word), found by dynamic programming over the token's positions in built-in
expressions.  Each distinct token is cut once, whatever its occurrences; the dictionary
is joined, not shipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions import text as T
from basketflow.session import cut_lineage

LONGEST = 6
MIN_COUNT = 2
JOINER = "/"


def token_counts(df: DataFrame, col: str) -> DataFrame:
    """``tok, n``: runs of letters and digits of two characters and more, whole corpus (written once: read often)."""
    return cut_lineage(df.select(F.explode(T.segments(F.col(col))).alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("n")))


def dictionary(tokens: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, int]:
    """(``term, cost``; cost of a single character) from ``tok, n``."""
    words = tokens.filter((F.length("tok") <= longest) & (F.col("n") >= min_count))
    total = words.agg(F.sum("n")).first()[0] or 1
    cost = F.round(F.log(F.lit(float(total)) / F.col("n")) * 1000).cast("long")
    single = words.select(F.round(F.log(F.lit(float(total))) * 1000).cast("long")).first()
    return words.select(F.col("tok").alias("term"), cost.alias("cost")), (single[0] if single else 0) + 1000


def edges(tokens: DataFrame, words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``tok, start, end, term, cost``: the dictionary words inside every token (``start`` from 0)."""
    size = F.length("tok")
    spans = tokens.select("tok", F.explode(F.sequence(F.lit(0), size - 2)).alias("start"), size.alias("size"))
    spans = spans.select("tok", "start", F.explode(F.sequence(
        F.col("start") + 2, F.least(F.col("start") + longest, F.col("size")))).alias("end"))
    named = spans.withColumn("term", F.expr("substring(tok, start + 1, end - start)"))
    return named.join(words, "term").select("tok", "start", "end", "term", "cost")


def index_terms(tokens: DataFrame, words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``tok, term``: the lattice's inner words, every dictionary word inside a longer token."""
    return edges(tokens, words, longest).filter("term <> tok").select("tok", "term").distinct()


def _best(steps: Column, single: int) -> Column:
    """Per position the ``(cost, pieces, start)`` of the best path that ends there; position 0 first."""
    def add(done: Column, step: Column) -> Column:
        ways = F.transform(step["ways"], lambda e: F.struct(
            (F.get(done, e["start"])["cost"] + e["cost"]).alias("cost"),
            (F.get(done, e["start"])["pieces"] + 1).alias("pieces"), e["start"].alias("start")))
        return F.concat(done, F.array(F.array_min(ways)))

    first = F.array(F.struct(F.lit(0).cast("long").alias("cost"), F.lit(0).alias("pieces"), F.lit(0).alias("start")))
    return F.aggregate(steps, first, add)


def segment(tokens: DataFrame, words: DataFrame, single: int, longest: int = LONGEST) -> DataFrame:
    """``tok, seg`` (pieces joined by '/'), ``pieces`` and ``cost`` of every token."""
    chars = tokens.select("tok", F.explode(F.sequence(F.lit(1), F.length("tok"))).alias("end")) \
        .select("tok", (F.col("end") - 1).alias("start"), "end", F.lit(single).cast("long").alias("cost"))
    ways = edges(tokens, words, longest).select("tok", "start", "end", "cost").unionByName(chars)
    # at most ``longest`` edges end at a position; positions of one token stand in order
    steps = ways.groupBy("tok", "end").agg(F.collect_list(F.struct("start", "cost")).alias("ways")) \
        .groupBy("tok").agg(F.sort_array(F.collect_list(F.struct("end", "ways"))).alias("steps"))
    best = steps.select("tok", _best(F.col("steps"), single).alias("best"))

    def back(state: Column, end: Column) -> Column:
        start = F.get(F.col("best"), end)["start"]
        return F.when(end == state["at"], F.struct(
            start.alias("at"), F.concat(F.array(F.substring(F.col("tok"), start + 1, end - start)), state["words"]).alias("words"))) \
            .otherwise(state)

    size = F.length("tok")
    path = F.aggregate(F.sequence(size, F.lit(1), F.lit(-1)),
                       F.struct(size.alias("at"), F.array().cast("array<string>").alias("words")), back)
    last = F.element_at("best", -1)
    return best.select("tok", F.array_join(path["words"], JOINER).alias("seg"), last["pieces"].cast("long").alias("pieces"),
                       last["cost"].alias("cost"))
