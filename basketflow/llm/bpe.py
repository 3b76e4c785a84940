"""Byte-level BPE encoding and decoding.

Texts are processed in chunks of half a megabyte per Arrow batch: boundary
arrays come from :mod:`pretokens` (class arrays and a transition-function
scan), the slices are dictionary-encoded so that every distinct pre-token is
looked up once, and pre-tokens that the per-worker cache lacks are merged
together -- grouped by length, one merge per pre-token and round, always the
leftmost pair of lowest rank.  Ids, byte offsets and decoded bytes are
gathered by array indexing.

Rules: a null text counts as empty; an empty text has no ids.  A worker's
cache is emptied when it exceeds ``CACHE_PIECES`` entries, which bounds its
memory and changes no result.  A text longer than ``CHUNK_BYTES`` is taken in
pieces that end before white space after an ASCII letter or digit, where a
boundary always lies.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm import pretokens
from basketflow.llm.common import fresh, with_fields

CHUNK_BYTES = 1 << 19
CACHE_PIECES = 300_000
MATRIX_BYTES = 48          # longer pre-tokens are merged one by one
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Lookup arrays of a rank file: pair -> merged id, id -> bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        toks = [b""] * size
        for b, i in ranks.items():
            toks[i] = b
        self.tok_len = np.array([len(b) for b in toks], np.int64)
        self.tok_start = np.concatenate(([0], np.cumsum(self.tok_len)))[:-1]
        self.tok_bytes = np.frombuffer(b"".join(toks), np.uint8)
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[b[:k]] << 32 | ranks[b[k:]], i) for b, i in ranks.items()
                 for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks]
        pairs.sort()
        self.pair_key = np.array([p[0] for p in pairs] or [-1], np.int64)
        self.pair_id = np.array([p[1] for p in pairs] or [NONE], np.int32)
        self.pair_of = dict(pairs)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the merged pair, ``NONE`` where there is no such token."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_id[at], NONE)

    # -- merging ---------------------------------------------------------------
    def merge_same_length(self, sym: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge rows of byte ids, all of one length (>= 2).

        Returns (row numbers, ids) blocks: the rows that ended with the same
        number of ids together.
        """
        out, rows = [], np.arange(len(sym))
        rank = self.merged(sym[:, :-1], sym[:, 1:])
        while len(rows):
            if not rank.shape[1]:
                out.append((rows, sym))
                break
            k = np.arange(len(rows))
            j = rank.argmin(1)
            low = rank[k, j]
            done = low == NONE
            if done.any():
                out.append((rows[done], sym[done]))
                go = ~done
                rows, sym, rank, j, low = rows[go], sym[go], rank[go], j[go], low[go]
                k = np.arange(len(rows))
            c = np.arange(sym.shape[1] - 1)[None, :]
            sym = np.where(c <= j[:, None], sym[:, :-1], sym[:, 1:])
            sym[k, j] = low
            rank = np.where(c[:, :-1] < j[:, None], rank[:, :-1], rank[:, 1:])
            left, right = np.flatnonzero(j > 0), np.flatnonzero(j < sym.shape[1] - 1)
            rank[left, j[left] - 1] = self.merged(sym[left, j[left] - 1], low[left])
            rank[right, j[right]] = self.merged(low[right], sym[right, j[right] + 1])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: a heap of pairs over a linked list, O(n log n)."""
        import heapq
        sym = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.pair_of.get
        heap = []
        for i in range(n - 1):
            r = pair(sym[i] << 32 | sym[i + 1])
            if r is not None:
                heap.append((r, i, sym[i], sym[i + 1]))
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                            # one side has been merged since
            sym[i], sym[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for x in (prv[i], i):
                if x >= 0 and nxt[x] < n:
                    q = pair(sym[x] << 32 | sym[nxt[x]])
                    if q is not None:
                        heapq.heappush(heap, (q, x, sym[x], sym[nxt[x]]))
        return np.array([s for s in sym if s >= 0], np.int32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, number of ids per piece)."""
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int32, len(pieces))
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rest = np.flatnonzero(whole < 0)
        blocks = [(np.flatnonzero(whole >= 0), whole[whole >= 0][:, None])]
        order = rest[np.argsort(size[rest], kind="stable")]
        widths, first = np.unique(size[order], return_index=True)
        for w, a, b in zip(widths, first, np.append(first, len(order))[1:], strict=True):
            at = order[a:b]
            if w > MATRIX_BYTES:
                blocks += [(np.array([i]), self.merge_long(pieces[i])[None, :]) for i in at.tolist()]
            else:
                data = b"".join([pieces[i] for i in at.tolist()])
                sym = self.byte_id[np.frombuffer(data, np.uint8).reshape(len(at), w)]
                blocks += [(at[r], s) for r, s in self.merge_same_length(sym)]
        lens = np.zeros(len(pieces), np.int64)
        for r, s in blocks:
            lens[r] = s.shape[1]
        begin = np.cumsum(lens) - lens
        ids = np.empty(int(lens.sum()), np.int32)
        for r, s in blocks:
            ids[begin[r][:, None] + np.arange(s.shape[1])] = s
        return ids, lens


def _ramp(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lens[0] of them), then the same for the next."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


class Encoder:
    """A vocabulary with the cache of merged pre-tokens (one per worker)."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.store = np.empty(1 << 16, np.int32)
        self.used = 0
        self.start = np.empty(1 << 16, np.int64)
        self.len = np.empty(1 << 16, np.int64)

    def _add(self, pieces: list[bytes]) -> None:
        ids, lens = self.v.merge(pieces)
        need, n = len(ids), len(self.slot)
        while self.used + need > len(self.store):
            self.store = np.concatenate((self.store, np.empty_like(self.store)))
        while n + len(pieces) > len(self.len):
            self.start = np.concatenate((self.start, np.empty_like(self.start)))
            self.len = np.concatenate((self.len, np.empty_like(self.len)))
        self.store[self.used:self.used + need] = ids
        self.start[n:n + len(lens)] = self.used + np.cumsum(lens) - lens
        self.len[n:n + len(lens)] = lens
        self.used += need
        self.slot.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def encode(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per text) of the texts ``data[offsets[i]:offsets[i+1]]``."""
        texts = len(offsets) - 1
        if not data:
            return np.empty(0, np.int32), np.zeros(texts, np.int64)
        raw = np.frombuffer(data, np.uint8)
        try:
            cps = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
            at = np.flatnonzero((raw & 0xC0) != 0x80)
        except UnicodeDecodeError:                  # stray bytes count as one character each
            cps = np.frombuffer(data.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"),
                                np.uint32)
            width = 1 + (cps >= 0x80) + (cps >= 0x800) + (cps >= 0x10000)
            width[(cps >= 0xDC80) & (cps <= 0xDCFF)] = 1
            at = np.cumsum(width) - width
        starts = np.zeros(len(cps), bool)
        full = offsets[:-1][np.diff(offsets) > 0]
        starts[np.searchsorted(at, full)] = True
        begin = at[pretokens.boundaries(cps, starts)]
        cuts = np.append(begin, len(raw)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.slot) + len(distinct) > CACHE_PIECES:
            self._clear()
        slots = np.fromiter(map(self.slot.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            slots[missing] = len(self.slot) + np.arange(len(missing))
            self._add([distinct[i] for i in missing.tolist()])
        slots = slots[coded.indices.to_numpy()]
        lens = self.len[slots]
        ids = self.store[_ramp(self.start[slots], lens)]
        upto = np.concatenate(([0], np.cumsum(lens)))
        return ids, np.diff(upto[np.searchsorted(begin, offsets)])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after another (uint8)."""
        return self.v.tok_bytes[_ramp(self.v.tok_start[ids], self.v.tok_len[ids])]


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line.strip())}


_ENCODERS: dict[str, Encoder] = {}


def encoder(blob: bytes) -> Encoder:
    """This process's encoder of a rank file (built once per worker)."""
    key = hashlib.sha256(blob).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary(parse_ranks(blob)))
    return _ENCODERS[key]


def _text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, rows, bytes, offsets): rows in chunks of about CHUNK_BYTES."""
    col = texts.cast(pa.large_binary())
    sizes = np.array([0 if not x.is_valid else len(x.as_buffer()) for x in col], np.int64)
    row = 0
    while row < len(sizes):
        end, size = row, 0
        while end < len(sizes) and (end == row or size + sizes[end] <= CHUNK_BYTES):
            size += int(sizes[end])
            end += 1
        part = col.slice(row, end - row).to_pylist()
        yield row, end - row, b"".join(x or b"" for x in part), np.concatenate(([0], np.cumsum(sizes[row:end])))
        row = end


_SOLID = np.zeros(256, bool)
_SOLID[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _windows(data: bytes) -> list[int]:
    """Offsets at which one long text may be cut without changing its pre-tokens."""
    raw = np.frombuffer(data, np.uint8)
    cuts, pos = [0], 0
    while len(raw) - pos > CHUNK_BYTES:
        end = pos + CHUNK_BYTES
        while True:
            hit = np.flatnonzero(_SOLID[raw[pos:end - 1]] & _BLANK[raw[pos + 1:end]])
            if len(hit) or end >= len(raw):
                break
            end = min(len(raw), end + CHUNK_BYTES)
        if not len(hit):
            break
        pos += int(hit[-1]) + 1
        cuts.append(pos)
    return [*cuts, len(raw)]


FIELDS = {
    "n_tokens": T.LongType(),                       # number of ids
    "ids": T.ArrayType(T.IntegerType()),            # the ids
    "offsets": T.ArrayType(T.LongType()),           # byte offset at which each id begins
    "ids_le": T.BinaryType(),                       # the ids as little-endian unsigned 32-bit integers
    "decoded": T.BinaryType(),                      # the bytes that the ids decode to
}


def _columns(enc: Encoder, ids: np.ndarray, counts: np.ndarray, outputs: tuple[str, ...]) -> list[pa.Array]:
    upto = np.concatenate(([0], np.cumsum(counts)))
    out = []
    for name in outputs:
        if name == "n_tokens":
            out.append(pa.array(counts, pa.int64()))
        elif name == "ids":
            out.append(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32))))
        elif name == "offsets":
            lens = enc.v.tok_len[ids]
            begin = np.concatenate(([0], np.cumsum(lens)))
            first = np.repeat(begin[upto[:-1]], counts)
            out.append(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(begin[:-1] - first)))
        elif name == "ids_le":
            out.append(_binary(ids.astype("<u4").tobytes(), upto * 4))
        else:
            begin = np.concatenate(([0], np.cumsum(enc.v.tok_len[ids])))
            out.append(_binary(enc.decode(ids).tobytes(), begin[upto]))
    return out


def _binary(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def read_ranks(path: str) -> bytes:
    """The rank file (driver side; a vocabulary of under a megabyte or so)."""
    with open(path, "rb") as f:
        return f.read()


def _shared(spark: SparkSession, ranks_path: str):
    """The rank file as a broadcast: its size is that of one vocabulary."""
    return spark.sparkContext.broadcast(read_ranks(ranks_path))


def encode(df: DataFrame, ranks_path: str, text_col: str = "text",
           outputs: tuple[str, ...] = ("n_tokens", "ids", "offsets"), keep_text: bool = True) -> DataFrame:
    """Add the encoding of ``text_col`` (see ``FIELDS`` for the possible outputs).

    Output columns replace input columns of the same name; ``keep_text=False``
    drops the text column.
    """
    fields = [T.StructField(o, FIELDS[o]) for o in outputs]
    gone = () if keep_text else (text_col,)
    schema = with_fields(df.schema, fields, gone)
    carried = [f.name for f in df.schema.fields if f.name in schema.names and f.name not in outputs]
    blob = _shared(df.sparkSession, ranks_path)
    given = fresh(df, "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(blob.value)
        for batch in batches:
            text = batch.column(given)
            for row, n, data, offsets in _text_chunks(text):
                if n == 1 and len(data) > CHUNK_BYTES:
                    cuts = _windows(data)
                    parts = [enc.encode(data[a:b], np.array([0, b - a]))[0]
                             for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    ids = np.concatenate(parts)
                    counts = np.array([len(ids)], np.int64)
                else:
                    ids, counts = enc.encode(data, offsets)
                cols = [batch.column(c).slice(row, n) for c in carried]
                yield pa.RecordBatch.from_arrays(cols + _columns(enc, ids, counts, outputs), names=schema.names)

    source = df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text_col}`").cast("string").alias(given))
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded_text") -> DataFrame:
    """Add the text that a column of ids decodes to (null ids: empty).

    Ids outside the vocabulary are an error.  Bytes that are no valid UTF-8
    (a token sequence cut inside a character) become U+FFFD.
    """
    schema = with_fields(df.schema, [T.StructField(out_col, T.StringType())])
    carried = [f.name for f in df.schema.fields if f.name != out_col]
    blob = _shared(df.sparkSession, ranks_path)
    given = fresh(df, "ids_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(blob.value)
        for batch in batches:
            texts = [enc.decode(np.asarray(x or [], np.int64)).tobytes().decode("utf-8", "replace")
                     for x in batch.column(given).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(texts, pa.string())],
                                             names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{ids_col}`").alias(given)).mapInArrow(run, schema)
