"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

:func:`count_words` counts the words of a corpus; :func:`variants` finds for every word its
near words, the commonest of them (its form) and the root that forms lead to.

Method: permuterm rotations.  A word is marked with a terminator and turned; two words that
differ by a replacement have rotations that agree up to their last, the edited, character, and a word is the
same rotation of a longer one without the inserted character.  So each word files its rotations without the
last character and its whole rotations; sorted, equal keys stand together, and one scan over each
group gives every member the number of its near words there and the best of them.  A group holds words that differ in one given place,
so it is as long as the alphabet at most, whatever the corpus.  Deletions inside a run of equal letters
give the same word, so only the run's first letter counts, and each near word is met exactly once.

Words are carried by their number in code-point order.  Rotations of more than
``PLAIN`` characters are filed under 124 bits of polynomial hashes taken from prefix sums, so a word of
length L costs L short rows, not L squared characters.

Rules: a null text has no words; a null document id alters no word; words must not hold U+0000;
an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import drop_stage, stage, strings
from basketflow.operators.prefix import running_totals

_RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words a task holds before it hands its counts on.
HELD = 400_000
#: Longest key that is filed as text.
PLAIN = 64
#: Rows of rotations made at a time.
ROWS = 1 << 18
_END = "\0"
_PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.int64)
_BASES = (1103515245, 69069 * 31, 1664525, 22695477)


def misspelt(doc_id: int | None, word: str, every: int = 97) -> str:
    """``word``, or without one letter if ``every`` divides the CRC-32 of ``<doc_id>:<word>``."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if doc_id is None or h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3,
                drop_every: int | None = None) -> DataFrame:
    """``word, n``: runs of ``[A-Za-z\\u00C0-\\u00FF]``, A to Z in lower case, of at least ``min_chars`` and ``min_count``.

    With ``drop_every`` the words of a document lose a letter as :func:`misspelt` says (a planted error).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = [(w, n) for w, n in held.items() if len(w) >= min_chars]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()),
                                               pa.array([n for _, n in out], pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                if not text:
                    continue
                words = Counter(_RUN.findall(text.encode().lower().decode()))
                if drop_every is not None and doc is not None:
                    start = zlib.crc32(f"{doc}:".encode())
                    for w in [w for w in words if zlib.crc32(w.encode(), start) % drop_every == 0]:
                        n = words.pop(w)
                        held[misspelt(doc, w, drop_every)] += n
                held.update(words)
                if len(held) > HELD:
                    yield flush()
        yield flush()

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= min_count)


def _long_keys(word: str) -> tuple[list[str], list[str]]:
    """Fingerprints of the whole rotations and of those without their last character."""
    chars = np.array([ord(c) + 1 for c in word], np.int64)
    size = len(word)
    whole, short = [], []
    for p, base in zip(_PRIMES.tolist(), _BASES, strict=True):
        power = np.ones(size + 2, np.int64)
        have, step = 1, base % p
        while have < size + 2:                                     # power[i] = base ** i
            n = min(have, size + 2 - have)
            power[have:have + n] = power[:n] * step % p
            have, step = have + n, step * step % p
        upto = np.concatenate(([0], np.cumsum(chars * power[:size] % p) % p))
        i = np.arange(size + 1)
        # front[i] * base ** i: hash of word[i:]; the rotation is word[i:], terminator, word[:i]
        back = np.array([pow(base, -1, p)], np.int64)[0]
        inverse = np.ones(size + 2, np.int64)
        have, step = 1, int(back)
        while have < size + 2:
            n = min(have, size + 2 - have)
            inverse[have:have + n] = inverse[:n] * step % p
            have, step = have + n, step * step % p
        front = (upto[size] - upto) % p * inverse[:size + 1] % p
        whole.append((front + power[size - i] + upto * power[size - i + 1]) % p)
        j = np.arange(size)
        short.append((front[1:] + power[size - 1 - j] + upto[:-1] * power[size - j]) % p)
    return [["#" + "".join(f"{int(x):08x}" for x in row) for row in zip(*h, strict=True)] for h in (whole, short)]


def _rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, kind, id, n``; kind 0: whole rotation, 1: without its last character, 2: and that begins a run."""
    for batch in batches:
        keys, kinds, ids, ns, sizes = [], [], [], [], []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(keys, pa.string()), pa.array(kinds, pa.int8()), pa.array(np.repeat(ids, sizes).astype(np.int64)),
                pa.array(np.repeat(ns, sizes).astype(np.int64))], names=["key", "kind", "id", "n"])

        for i, word, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            size = len(word)
            turned = word + _END + word
            if size <= PLAIN:
                short = [turned[k + 1:k + size + 1] for k in range(size)]
                whole = [turned[k:k + size + 1] for k in range(size + 1)] if size < PLAIN else _long_keys(word)[0]
            else:
                whole, short = _long_keys(word)
            keys += whole
            keys += short
            kinds += [0] * (size + 1)
            kinds += [2 if k == 0 or word[k] != word[k - 1] else 1 for k in range(size)]
            ids.append(i)
            ns.append(n)
            sizes.append(2 * size + 1)
            if len(keys) >= ROWS:
                yield rows()
                keys, kinds, ids, ns, sizes = [], [], [], [], []
        if keys:
            yield rows()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, n_near, best_n, best_id`` of every member of every group; rows are sorted by key, n (falling) and id."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        key = table.column("key").chunk(0) if len(table) else None
        if key is None:
            continue
        new = np.concatenate(([True], np.asarray(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False), bool)))
        last = int(np.flatnonzero(new)[-1])                        # the last group may go on
        rest = table.slice(last).combine_chunks().to_batches()[0]
        if last:
            yield _near(table.slice(0, last), new[:last])
    if rest is not None:
        yield _near(pa.Table.from_batches([rest]), np.arange(len(rest)) == 0)


def _near(table: pa.Table, new: np.ndarray) -> pa.RecordBatch:
    starts = np.flatnonzero(new)
    size = np.diff(np.append(starts, len(new)))
    keep = np.repeat(size > 1, size)
    kind, ids, ns = (table.column(c).to_numpy()[keep] for c in ("kind", "id", "n"))
    size = size[size > 1]
    if not len(size):
        return _near_rows(*[np.empty(0, np.int64)] * 4)
    starts, group, none = np.cumsum(size) - size, np.repeat(np.arange(len(size)), size), len(kind)
    at = np.arange(len(kind))

    def first(mask: np.ndarray) -> np.ndarray:
        """Best row of every group among ``mask``, ``none`` without one."""
        return np.minimum.reduceat(np.where(mask, at, none), starts)

    turned, runs, whole = kind > 0, kind == 2, kind == 0
    best = first(turned)
    second = first(turned & (at != best[group]))
    of_run, the_whole = first(runs), first(whole)
    mine = np.where(turned, np.where(at == best[group], second[group], best[group]), of_run[group])
    mine = np.where(runs, np.minimum(mine, the_whole[group]), mine)
    count = np.where(turned, np.add.reduceat(turned.astype(np.int64), starts)[group] - 1
                     + (runs & (the_whole[group] < none)), np.add.reduceat(runs.astype(np.int64), starts)[group])
    has = count > 0
    return _near_rows(ids[has], count[has], ns[mine[has]], ids[mine[has]])


def _near_rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns],
                                      names=["id", "n_near", "best_n", "best_id"])


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best_id`` of every word with near ones; ``words`` has ``id, word, n``, ids in code-point order."""
    rotations = words.select("id", "word", "n").mapInArrow(_rotations, "key string, kind byte, id long, n long")
    scanned = rotations.repartition("key").sortWithinPartitions("key", F.desc("n"), "id") \
        .mapInArrow(_scan, "id long, n_near long, best_n long, best_id long")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best_id").alias("id"))).alias("best")
    return scanned.groupBy("id").agg(F.sum("n_near").alias("n_near"), best) \
        .select("id", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.id").alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """``id, root`` of every row of ``id, form``: the end of the chain of forms, by pointer doubling (no cycles)."""
    known = stage(forms.select("id", F.col("form").alias("root")), "roots")
    moved = not known.isEmpty()
    while moved:
        ahead = known.select(F.col("id").alias("root"), F.col("root").alias("far"))
        new = stage(known.join(ahead, "root", "left").select(
            "id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        moved = not new.filter("moved").isEmpty()
        drop_stage(known)
        known = new
    return known.select("id", "root")


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``word, n`` (distinct words).

    ``form`` is the near word of largest ``n`` (ties: first in code-point order) if that is at least ``ratio`` (2 or more)
    times the word's own, else null; ``root`` is where forms lead from the word, itself if it has none.
    """
    numbered = stage(running_totals(words.select("word", F.col("n").cast("long").alias("n")), ["word"], count_col="id")
                     .select(F.col("id").cast("long").alias("id"), "word", "n"), "words")
    known = numbered.join(near_words(numbered), "id", "left") \
        .withColumn("form", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id"))) \
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form")
    known = stage(known, "near-words")
    ends = roots(known.filter("form IS NOT NULL").select("id", "form"))
    to_form = numbered.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    to_root = numbered.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    led = known.filter("form IS NOT NULL").join(to_form, "form").join(ends, "id").join(to_root, "root") \
        .select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    alone = known.filter("form IS NULL").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near",
        F.lit(None).cast("long").alias("form_n"))
    return led.unionByName(alone)
