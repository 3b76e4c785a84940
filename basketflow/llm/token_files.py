"""Token ids of a corpus as binary files of directly addressable codes.

:func:`write` sorts the documents by id, encodes them with the tokenizers
library and packs them into files; :func:`documents` reads the files back, a
row per document; :func:`tokens_at` fetches the tokens at any positions of the
corpus without decoding what lies around them.

A file (little-endian): 8 bytes ``MAGIC``, ``u64`` part, number in the part,
documents, ids; ``i64`` document ids, ``u64`` end positions in the file, ``u8``
null marks (padded to 8 bytes); then the code of all ids (:mod:`dac`) and one
newline.  Files follow one another by (part, number); a document is never split.
Spark's text writer stores the bytes, so files appear by its commit protocol
and a lost executor leaves none behind.

Rules: a null text counts as empty; every document ends with ``end_id``, so an
empty one has that id alone.  Documents without an id stand first; equal ids
are ordered by their texts' hash and text.  Strings of special tokens in a text are
ordinary text.  An empty table gives no files and no rows.

If the tokenizer lowers case, drops white space and never joins a letter with a
digit, a mark or what stands beyond a blank (tried on probes), texts are cut there into pieces,
and a worker encodes each distinct piece once; ``CACHE_PIECES`` are kept, the less
used half goes when full.  Other tokenizers get whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.bpe import _ramp
from basketflow.llm.common import strings
from basketflow.llm.dac import Codes, len_padded
from basketflow.operators.prefix import running_totals
from basketflow.operators.ranges import range_join

MAGIC = b"DACTOK1\n"
#: A file is closed when it holds this many ids (about 3 MB).
FILE_IDS = 1 << 21
#: Pieces of text a worker keeps.
CACHE_PIECES = 600_000
#: Characters encoded at a time.
CHUNK_CHARS = 1 << 20
#: Positions of one file that are fetched together.
FETCH = 1 << 16

_PROBES = ("", "a", "Word", "it's", "12", "É", "x.", ".y", "'", "中文", "--", "s", "A1b2", "\u0301", "×", "_", "\x1f", "Σ")
_MARK = "\x01"
_PLAIN = re.compile("[!-&(-~\u00DF-\u00F6\u00F8-\u00FF]*")


class WordEncoder:
    """A tokenizer with the pieces it has met (one per worker)."""

    def __init__(self, json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_str(json)
        self.tok.encode_special_tokens = True
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._start_over()
        mark = self._batch([_MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else -1
        probes = [a + gap + b for gap in ("", " ", "\n", "\t\r ") for a in _PROBES for b in _PROBES]
        self.by_piece = all((self._pieces([p])[0] == want).all() if len(self._pieces([p])[0]) == len(want) else False
                            for p, want in zip(probes, self._batch(probes), strict=True))

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _start_over(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.start = self.len = self.uses = np.empty(0, np.int64)
        self.store = np.empty(0, np.int32)

    def _make_room(self) -> None:
        """Keep the half of the pieces that most chunks had."""
        order = np.sort(np.argsort(-self.uses, kind="stable")[:CACHE_PIECES // 2])
        new = np.full(len(self.uses), -1)
        new[order] = np.arange(len(order))
        self.store = self.store[_ramp(self.start[order], self.len[order])]
        self.len, self.uses = self.len[order], self.uses[order] // 2
        self.start = np.cumsum(self.len) - self.len
        self.slot = {w: k for w, s in self.slot.items() if (k := int(new[s])) >= 0}

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces.  One of plain characters is a pre-token, so the model takes its bytes; the others
        go into common texts with a mark between, or one by one where the mark is met elsewhere."""
        texts = [p[p[:1].isspace():].decode() for p in pieces]
        plain = [_PLAIN.fullmatch(t) is not None for t in texts]
        tokenize, table = self.tok.model.tokenize, self.byte_letters
        ids: list[int] = []
        lens = np.zeros(len(pieces), np.int64)
        for k in [k for k, p in enumerate(plain) if p]:
            t = texts[k]
            got = tokenize(t if t.isascii() else t.translate(table)) if t else ()
            ids += [x.id for x in got]
            lens[k] = len(got)
        order = np.flatnonzero(plain)
        others = [k for k, p in enumerate(plain) if not p]
        for at in range(0, len(others), 64):
            some = others[at:at + 64]
            joined = np.array(self._batch([f" {_MARK} ".join(texts[k] for k in some)])[0], np.int64)
            cuts = np.flatnonzero(joined == self.mark)
            if len(cuts) == len(some) - 1:
                ids += np.delete(joined, cuts).tolist()
                lens[some] = np.diff(np.concatenate(([-1], cuts, [len(joined)]))) - 1
            else:
                each = self._batch([texts[k] for k in some])
                ids += [i for x in each for i in x]
                lens[some] = [len(x) for x in each]
        order = np.concatenate((order, np.array(others, np.int64)))
        starts = np.empty(len(pieces), np.int64)
        starts[order] = len(self.store) + np.cumsum(lens[order]) - lens[order]
        self.slot.update(zip(pieces, range(len(self.len), len(self.len) + len(pieces)), strict=True))
        self.start = np.concatenate((self.start, starts))
        self.len = np.concatenate((self.len, lens))
        self.uses = np.concatenate((self.uses, np.zeros(len(lens), np.int64)))
        self.store = np.concatenate((self.store, np.array(ids, np.int32)))

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, begin, text_begin = cut_pieces(texts)
        cuts = np.append(begin, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(data)]) \
            .dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(self.slot) + len(distinct) > CACHE_PIECES:
            self._make_room()
        slots = np.fromiter(map(self.slot.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            slots[missing] = len(self.slot) + np.arange(len(missing))
            self._learn([distinct[i] for i in missing.tolist()])
        self.uses[slots] += 1
        slots = slots[coded.indices.to_numpy()]
        lens = self.len[slots]
        upto = np.concatenate(([0], np.cumsum(lens)))
        return self.store[_ramp(self.start[slots], lens)], \
            np.diff(upto[np.append(np.searchsorted(begin, text_begin), len(begin))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per text)."""
        if self.by_piece:
            return self._pieces(texts)
        each = self._batch(texts)
        return np.array([i for x in each for i in x], np.int32), np.fromiter(map(len, each), np.int64, len(each))


# bytes: 0 blank, 1 ASCII letter, 2 ASCII digit, 3 ASCII mark, 4 any other
_CLASS = np.full(256, 4, np.uint8)
_CLASS[33:127] = 3
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[[9, 10, 13, 32]] = 0


def cut_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte of every piece, first byte of every text): texts in lower case, a newline before each.

    A piece begins at every blank.  Inside a word of ASCII characters without apostrophe and
    letters of U+00C0 to U+00FF, another begins where letters, digits and marks meet, and at every digit.
    """
    joined = ("\n" + "\n".join(texts)).encode()
    text_begin = np.cumsum([0] + [len(t.encode()) + 1 for t in texts[:-1]])
    data = np.frombuffer(joined.lower(), np.uint8).copy()
    kind = _CLASS[data]
    lead = np.flatnonzero(data == 0xC3)
    tail = data[lead + 1]
    letter = (tail != 0x97) & (tail != 0xB7)                       # neither multiplication nor division sign
    kind[lead[letter]] = kind[lead[letter] + 1] = 1
    data[lead[letter & (tail < 0x9F)] + 1] += 0x20                 # capitals
    blank = kind == 0
    word = np.cumsum(blank)
    whole = np.zeros(int(word[-1]) + 1, bool)
    whole[word[(kind == 4) | (data == 39)]] = True
    new = blank.copy()
    new[1:] |= ~blank[:-1] & ((kind[1:] != kind[:-1]) | (kind[1:] == 2)) & ~whole[word[1:]]
    return data, np.flatnonzero(new), text_begin


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(json: str) -> WordEncoder:
    """This process's encoder of a tokenizer."""
    if json not in _ENCODERS:
        _ENCODERS[json] = WordEncoder(json)
    return _ENCODERS[json]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Rows [a, b) of about ``CHUNK_CHARS`` characters."""
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > CHUNK_CHARS:
            yield a, b
            a, size = b, 0
        size += len(t)
    if len(texts) > a:
        yield a, len(texts)


def file_bytes(part: int, number: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file (see the module's layout)."""
    null = np.array([d is None for d in doc_ids], np.uint8)
    marks = null.tobytes() + bytes(-len(null) % 8)
    return b"".join([MAGIC, np.array([part, number, len(doc_ids), len(ids)], "<u8").tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.cumsum(counts).astype("<u8").tobytes(),
                     marks, Codes.to_bytes(ids)])


class TokenFile:
    """A file read back (any bytes-like object, a memory map too)."""

    def __init__(self, data):
        raw = np.frombuffer(data, np.uint8)
        if raw[:8].tobytes() != MAGIC:
            raise ValueError("no token file")
        self.part, self.number, n, self.n_ids = (int(x) for x in raw[8:40].view("<u8"))
        self.doc_ids = raw[40:40 + 8 * n].view("<i8")
        self.ends = raw[40 + 8 * n:40 + 16 * n].view("<u8").astype(np.int64)
        at = 40 + 16 * n
        self.null = raw[at:at + n] == 1
        self.codes = Codes.from_buffer(raw[at + len_padded(n, 8):])


def write(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
          file_ids: int = FILE_IDS) -> None:
    """Encode ``text_col`` of every row and write the files to the new folder ``path``, in the order of ``id_col``.

    ``tokenizer`` names a JSON file of the tokenizers library on the driver; it
    is sent to the executors.
    """
    spark = df.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        json = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = word_encoder(json.value), TaskContext.get().partitionId(), 0
        docs, counts, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, docs, counts, ids
            data = file_bytes(part, number, docs, np.concatenate(counts), np.concatenate(ids))
            number, held, docs, counts, ids = number + 1, 0, [], [], []
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in strings(batch.column(1))]
            for a, b in _chunks(texts):
                got, n = enc.encode(texts[a:b])
                ends = np.cumsum(n)
                got, n = np.insert(got, ends, end_id), n + 1
                cuts = np.cumsum(n)
                row = 0
                while row < b - a:                    # rows that fill the file
                    base = int(cuts[row - 1]) if row else 0
                    to = min(b - a, int(np.searchsorted(cuts, base + file_ids - held)) + 1)
                    docs += doc_ids[a + row:a + to]
                    counts.append(n[row:to])
                    ids.append(got[base:int(cuts[to - 1])].astype(np.uint32))
                    held += len(ids[-1])
                    row = to
                    if held >= file_ids:
                        yield flush()
        if docs:
            yield flush()

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .withColumn("mark", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_first(), "mark") \
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "mark", "text").select("id", "text")
    # the text writer stores the bytes of a string as they are
    rows.mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("value")) \
        .write.option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def documents(spark: SparkSession, path: str, ids: bool = True, id_col: str = "doc_id") -> DataFrame:
    """A row per document of the files: ``file, part, number, doc_id, at`` (in the file), ``n_tokens`` and,
    with ``ids``, ``ids_le`` (little-endian unsigned 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                f = TokenFile(batch.column(1)[k].as_buffer())
                n, begin = len(f.ends), np.concatenate(([0], f.ends[:-1])).astype(np.int64)
                cols = [pa.array([batch.column(0)[k].as_py()] * n, pa.string()),
                        pa.array(np.full(n, f.part), pa.int64()), pa.array(np.full(n, f.number), pa.int64()),
                        pa.array(f.doc_ids, pa.int64(), mask=f.null), pa.array(begin), pa.array(f.ends - begin)]
                if ids:
                    data = f.codes.slice(0, f.n_ids).astype("<u4")
                    cuts = (4 * np.concatenate(([0], f.ends))).astype(np.int64)
                    cols.append(pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
                                .cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["file", "part", "number", id_col, "at", "n_tokens"] + ["ids_le"] * ids
    schema = f"file string, part long, number long, `{id_col}` long, at long, n_tokens long" + ", ids_le binary" * ids
    return _files(spark, path).select("path", "content").mapInArrow(run, schema)


def file_starts(docs: DataFrame) -> DataFrame:
    """``file, part, number, n_ids, file_start`` from rows of :func:`documents`: ids in all files before."""
    sizes = docs.groupBy("file", "part", "number").agg(F.sum("n_tokens").alias("n_ids"))
    return running_totals(sizes, ["part", "number"], sums={"upto": F.col("n_ids")}) \
        .select("file", "part", "number", "n_ids", (F.col("upto") - F.col("n_ids")).alias("file_start"))


def with_start(docs: DataFrame) -> DataFrame:
    """Rows of :func:`documents` (written, as they are read twice) with ``start``: the ids of all documents before."""
    files = file_starts(docs).select("file", "file_start")
    return docs.join(files, "file").withColumn("start", F.col("file_start") + F.col("at")).drop("file_start")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, position: str | Column = "position") -> DataFrame:
    """``position, token`` of every distinct position in the corpus (those outside it have no row).

    A position finds its file by a range join; positions of one file are fetched
    in lists of at most ``FETCH`` by rank and chunk, nothing else is decoded.
    """
    column = F.col(position) if isinstance(position, str) else position
    asked = positions.select(column.cast("long").alias("position")).filter("position IS NOT NULL").distinct()
    files = file_starts(documents(spark, path, ids=False)).withColumn("file_end", F.col("file_start") + F.col("n_ids"))
    found = range_join(asked, files.select("file", "file_start", "file_end"), [], "position", "file_start", "file_end",
                       bucket=FILE_IDS)
    lists = found.withColumn("at", F.col("position") - F.col("file_start")) \
        .groupBy("file", "file_start", F.expr(f"at div {FETCH}").alias("stretch")).agg(F.collect_list("at").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                at = batch.column(1)[k].values.to_numpy()
                token = TokenFile(batch.column(2)[k].as_buffer()).codes.get(at).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at + batch.column(0)[k].as_py()), pa.array(token)],
                                                 names=["position", "token"])

    content = _files(spark, path).select(F.col("path").alias("file"), "content")
    return lists.join(content, "file").select("file_start", "at", "content") \
        .mapInArrow(run, "position long, token long")
