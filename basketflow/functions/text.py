"""Text column functions.

All but ``lcs_length_udf`` are built-in expressions (JVM side, codegen).
Tokens come from splitting on runs of white space and dropping empty
strings (D16: the JVM ``split(" ")`` kept inner empties).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Fixed values shared with the SQL oracle.
LABEL_SEPARATOR = "##@@##"
WHITESPACE = r"\s+"
# Segment boundaries: anything that is not a letter or a digit.
NON_WORD = r"[^\p{L}\p{N}]+"
SEGMENT_JOINER = "/"


def tokens(c: Column) -> Column:
    """Words of a text: split on white space, empty strings dropped."""
    return F.array_remove(F.split(c, WHITESPACE), "")


def sentence_body(c: Column) -> Column:
    """``words##@@##label`` -> ``words`` (F8; D13: label stripped everywhere)."""
    return F.substring_index(c, LABEL_SEPARATOR, 1)


def sentence_label(c: Column) -> Column:
    return F.element_at(F.split(c, LABEL_SEPARATOR), -1)


def segments(c: Column, min_len: int = 2) -> Column:
    """letter/digit runs of at least ``min_len`` characters."""
    return F.filter(F.split(c, NON_WORD), lambda x: F.length(x) >= min_len)


def segment_string(c: Column) -> Column:
    """F9 output form: the segments joined by '/'."""
    return F.array_join(segments(c), SEGMENT_JOINER)


def inner_terms(tok: Column, sizes=(2, 3)) -> Column:
    """F10 candidates: every substring of ``sizes`` characters strictly
    inside a longer token (the dictionary filter is a join, see operators)."""
    def cut(n: int):
        return lambda s: tok.substr(s, F.lit(n))  # one-argument lambda: element only

    parts = []
    for n in sizes:
        starts = F.sequence(F.lit(1), F.length(tok) - n + 1)
        subs = F.transform(starts, cut(n))
        parts.append(F.when(F.length(tok) > n, subs).otherwise(F.array().cast("array<string>")))
    return F.concat(*parts)


# --- longest common subsequence ---------------------------------------------

def lcs_length(a: str, b: str) -> int:
    """LCS length by the bit-parallel recurrence (one big-int step per
    character of ``a``; O(len(a) * len(b) / 64) machine-word operations)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for j, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def lcs_similarity(a: str, b: str) -> float | None:
    """LCS / mean length; None when both strings are empty."""
    if a is None or b is None:
        return None
    n = len(a) + len(b)
    if n == 0:
        return None
    return lcs_length(a, b) / (n / 2)


@F.pandas_udf(IntegerType())
def lcs_length_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow-batched LCS length of two whole strings per row."""
    out = [None if (x is None or y is None) else lcs_length(x, y) for x, y in zip(a, b)]
    return pd.Series(out, dtype="Int32")


def lcs_length_expr(a: Column, b: Column) -> Column:
    """LCS length as a native expression (nested ``aggregate`` over the
    characters; quadratic arrays, so meant for short columns such as names).
    The DP row is carried as an array; an empty ``b`` gives 0."""
    bs = F.split(b, "")
    m = F.size(bs)

    def step_row(prev, ch):
        # new row r: r[0] = 0; r[j] = prev[j-1]+1 if ch == b[j-1] else max(prev[j], r[j-1])
        def cell(acc, j):
            val = F.when(F.element_at(bs, j) == ch, F.element_at(prev, j) + 1) \
                   .otherwise(F.greatest(F.element_at(prev, j + 1), F.element_at(acc, j)))
            return F.concat(acc, F.array(val))
        return F.aggregate(F.sequence(F.lit(1), m), F.array(F.lit(0)), cell)

    zero = F.transform(F.sequence(F.lit(0), m), lambda _: F.lit(0))
    last = F.aggregate(F.split(a, ""), zero, step_row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)) \
            .otherwise(F.element_at(last, -1))
