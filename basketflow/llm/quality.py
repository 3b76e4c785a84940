"""Quality rules as a short-circuit cascade of native expressions.

Every rule is a DataFrame expression over a document's own text: no Python in
tasks, no shuffle.  ``plan`` runs each rule alone over a bounded sample,
measures how much it costs and how many documents it rejects, and orders the
rules by rejections per cost; a document then meets the rules in that order
and leaves at the first that rejects it.  The order changes the cost only: a
document is kept iff no rule rejects it.

Rules of this module: a null text has no words; words are runs of characters
other than U+0020 and U+0009..U+000D; a document without words fails the
length rule.  Output columns replace input columns of the same name.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import let, packed

SAMPLE_ROWS = 200          # documented bound of the sample that orders the rules
SAMPLE_BYTES = 1 << 13     # longer texts are not in that sample: it is held in a plan, on the driver

# The words' separators and the symbols counted.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN)))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SOLID + "+")), F.lit(0)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points outside the separators."""
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.regexp_count(t, F.lit(BLANK_RUN[:-1]))).cast("long")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(SOLID))


def dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Each window becomes one long: the upper bits of its hash, the lower bits
    its position (as many bits as the document's length needs).  After
    sorting, equal windows are neighbours.  Windows that share the hash bits
    with a neighbour are sorted again by their three words, so that only equal
    words count, however few hash bits a long text leaves; the words covered
    follow from the gaps between the repeated windows' positions.
    """
    def windows(w: Column, mask: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))))

    def same(x: Column, y: Column, mask: Column) -> Column:
        return x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0

    def candidates(s: Column, w: Column, mask: Column) -> Column:
        near = F.transform(
            F.filter(s, lambda x, i: ((i > 0) & same(x, s[i - 1], mask))
                     | ((i < F.size(s) - 1) & same(x, s[i + 1], mask))),
            lambda x: x.bitwiseAND(mask).cast("int"))
        return F.sort_array(F.transform(near, lambda p: F.struct(
            w[p].alias("a"), w[p + 1].alias("b"), w[p + 2].alias("c"), p.alias("at"))))

    def equal(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def repeated(c: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(c, lambda x, i: ((i > 0) & equal(x, c[i - 1])) | ((i < F.size(c) - 1) & equal(x, c[i + 1]))),
            lambda x: x["at"].cast("long")))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.when(i == 0, F.lit(3).cast("long"))
                           .otherwise(F.least(F.lit(3).cast("long"), x - at[i - 1])))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)

    def count(w: Column) -> Column:
        mask = F.pow(F.lit(2.0), F.ceil(F.log2(F.size(w).cast("double")))).cast("long") - 1
        return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(
            let(mask, lambda m: let(windows(w, m), lambda s: let(candidates(s, w, m), lambda c: let(repeated(c), covered)))))

    return let(ws, count)


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean expression over a text column."""

    name: str
    rejects: Callable[[Column], Column]


def base_rejects(n: Column, repeats: Column) -> tuple[Column, Column]:
    return n < 50, 100 * repeats > 50 * n


def rules() -> list[Rule]:
    """The production rules; the first two are the base rules."""
    return [
        Rule("few_words", lambda t: n_words(t) < 50),
        Rule("repeated_words", lambda t: let(words(t), lambda w: 100 * repeat_words(w) > 50 * F.size(w))),
        Rule("symbols", lambda t: 10 * n_symbols(t) > n_words(t)),
        Rule("word_length", lambda t: (word_chars(t) < 3 * n_words(t)) | (word_chars(t) > 10 * n_words(t))),
        Rule("repeated_lines", lambda t: let(worded_lines(t), lambda x: 2 * dup_lines(x) > F.size(x))),
    ]


def plan(df: DataFrame, text: str = "text", todo: list[Rule] | None = None) -> list[Rule]:
    """The rules by rejections per second on a sample (most first).

    The sample only decides the order.  Rules that reject nothing there go
    last, cheapest first.  It is taken from the first partitions that fill it, not from all,
    and texts of more than ``SAMPLE_BYTES`` are not timed.
    """
    todo = todo or rules()
    t = F.col(f"`{text}`").cast("string")
    taken = df.select(t.alias("text")).filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES).take(SAMPLE_ROWS)
    if not taken:
        return todo
    rows = len(taken)
    sample = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(r["text"]).cast("string") for r in taken])).alias("text")).persist()
    try:
        sample.count()
        scored = []
        for r in todo:
            t = time.monotonic()
            out = sample.filter(r.rejects(F.col("text"))).count()
            cost = max(1e-3, time.monotonic() - t)
            scored.append((-(out / rows) / cost, cost, r.name, r))
        return [s[-1] for s in sorted(scored, key=lambda s: s[:3])]
    finally:
        sample.unpersist()


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def annotate(df: DataFrame, text: str = "text", order: list[Rule] | None = None) -> DataFrame:
    """``df`` with the five measures, ``base_failed`` and ``kept``.

    The measures of the base rules are wanted for every row, so the cascade
    runs the others only on rows that the base rules pass.
    """
    new = (*MEASURES, "base_failed", "kept")
    t = F.col(f"`{text}`").cast("string")
    x = F.col("text")
    out = df.select(packed(df).alias("row"), t.alias("text"), words(t).alias("words")).select(
        "row", "text", F.size("words").cast("long").alias("n_words"),
        word_chars(x).alias("word_chars"), n_symbols(x).alias("n_symbols"),
        let(worded_lines(x), dup_lines).alias("n_dup_lines"), repeat_words(F.col("words")).alias("n_repeat_words"))
    few, repeated = base_rejects(F.col("n_words"), F.col("n_repeat_words"))
    rejected = few | repeated
    for r in order or plan(df, text):
        if r.name not in ("few_words", "repeated_words"):
            rejected = rejected | r.rejects(x)              # OR leaves at the first rejection
    out = out.withColumns({"base_failed": few | repeated, "kept": ~rejected})
    return out.select(*[F.col(f"row.`{c}`") for c in df.columns if c not in new], *new)


def keep(df: DataFrame, text: str = "text", order: list[Rule] | None = None) -> DataFrame:
    """The rows that no rule rejects, unchanged: one filter whose conjuncts stand in cascade order."""
    t = F.col(f"`{text}`").cast("string")
    for r in order or plan(df, text):
        df = df.filter(~r.rejects(t))
    return df
