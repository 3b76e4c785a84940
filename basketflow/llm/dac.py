"""Directly addressable codes: a sequence of ids that can be read at any position.

An id is split into chunks from its low bits up.  Level ``k`` holds, side by
side and ``widths[k]`` bits each, the ``k``-th chunks of the ids that have one;
a continuation bitmap says which of them go on in the next level, and a rank
directory (ones before every block of 512 bits) turns a position in one level
into the position in the next.  Reading the id at a position touches one chunk
per level and at most eight words of a bitmap, whatever stands before it.

The widths are those of least total size for the ids at hand, found by dynamic
programming over the counts of bit lengths.

Layout of :meth:`Codes.to_bytes`, little-endian, every part padded to 8 bytes:
``u64 n, u64 levels, u64 widths[levels], u64 sizes[levels]``, then per level
its chunks, its bitmap (padded to 64 bytes) and its ``u32`` directory; the last level
has neither bitmap nor directory.
"""

from __future__ import annotations

import numpy as np

#: Bits of a bitmap between two entries of its rank directory.
BLOCK = 512
#: Ids packed at a time (a multiple of 8).
RUN = 1 << 16
#: Bits that one continuation flag costs: itself and its share of the directory.
FLAG = 1 + 32 / BLOCK


def best_widths(lengths: np.ndarray) -> list[int]:
    """Chunk widths of least total size; ``lengths[b]`` ids are ``b`` bits long."""
    top = max(1, int(np.flatnonzero(lengths).max(initial=1)))
    longer = np.concatenate((np.cumsum(lengths[::-1])[::-1], np.zeros(top + 2)))   # longer[b]: at least b bits
    cost, step = [0.0] * (top + 1), [0] * (top + 1)
    for a in range(top - 1, -1, -1):
        here = float(longer[a + 1] if a else longer[0])
        cost[a], step[a] = min((here * (b - a + (FLAG if b < top else 0)) + cost[b], b) for b in range(a + 1, top + 1))
    out, a = [], 0
    while a < top:
        out.append(step[a] - a)
        a = step[a]
    return out


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of every value, one after another."""
    shifts = np.arange(width, dtype=np.uint64)
    out = [np.packbits(((values[i:i + RUN, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little").tobytes()
           for i in range(0, len(values), RUN)]
    return b"".join(out)


def _padded(data: bytes, to: int = 8, more: int = 0) -> bytes:
    """``data`` with ``more`` zero bytes and then up to a multiple of ``to``."""
    return data + bytes(more + -(len(data) + more) % to)


class Level:
    """Chunks of one width, with bitmap and directory unless it is the last."""

    def __init__(self, n: int, width: int, chunks: np.ndarray, bitmap: np.ndarray | None, ones: np.ndarray | None):
        self.n, self.width, self.bitmap, self.ones = n, width, bitmap, ones
        # eight bytes from any byte on, read as one number
        self.at = np.ndarray((len(chunks) - 7,), "<u8", chunks, 0, (1,))
        self.words = None if bitmap is None else bitmap.view("<u8")

    def chunk(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.width
        return (self.at[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def goes_on(self, i: np.ndarray) -> np.ndarray:
        return (self.bitmap[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position ``i``: the block's entry and the words of the block before it."""
        word, block = i >> 6, i >> 9
        out = self.ones[block].astype(np.int64)
        for k in range(BLOCK // 64 - 1):
            w = block * (BLOCK // 64) + k
            before = w < word
            out[before] += np.bitwise_count(self.words[w[before]])
        inside = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(self.words[word] & inside)

    def flags(self, a: int, b: int) -> np.ndarray:
        return np.unpackbits(self.bitmap[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:(a & 7) + b - a].astype(bool)


class Codes:
    """An encoded sequence: :meth:`get` any positions, :meth:`slice` a stretch."""

    def __init__(self, n: int, levels: list[Level]):
        self.n, self.levels = n, levels

    def __len__(self) -> int:
        return self.n

    @staticmethod
    def to_bytes(ids: np.ndarray, widths: list[int] | None = None) -> bytes:
        """The code of ``ids`` (0 to 2**32 - 1)."""
        rest = np.asarray(ids).astype(np.uint64)
        if widths is None:
            lengths = np.frexp(rest.astype(np.float64))[1]
            widths = best_widths(np.bincount(lengths, minlength=2).astype(float))
        if len(rest) and int(rest.max()) >> sum(widths):
            raise ValueError(f"an id needs more than {sum(widths)} bits")
        sizes, parts = [], []
        for k, width in enumerate(widths):
            sizes.append(len(rest))
            parts.append(_padded(_pack(rest, width), more=8))
            rest = rest >> np.uint64(width)
            if k + 1 < len(widths):
                on = rest > 0
                bitmap = _padded(np.packbits(on, bitorder="little").tobytes(), BLOCK // 8, more=1)
                ones = np.bitwise_count(np.frombuffer(bitmap, "<u8")).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
                parts += [bitmap, _padded((np.cumsum(ones) - ones).astype("<u4").tobytes())]
                rest = rest[on]
        head = np.array([len(ids), len(widths), *widths, *sizes], "<u8").tobytes()
        return b"".join([head, *parts])

    @staticmethod
    def from_buffer(data) -> Codes:
        """Read back without copying; ``data`` may go on after the code."""
        raw = np.frombuffer(data, np.uint8)
        n, k = (int(x) for x in raw[:16].view("<u8"))
        head = raw[16:16 + 16 * k].view("<u8").astype(np.int64)
        at, levels = 16 + 16 * k, []

        def part(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return raw[at - size:at]

        for i in range(k):
            width, size = int(head[i]), int(head[k + i])
            chunks = part(len_padded((size * width + 7) // 8 + 8, 8))
            bitmap = ones = None
            if i + 1 < k:
                bitmap = part(len_padded((size + 7) // 8 + 1, BLOCK // 8))
                ones = part(len_padded(len(bitmap) * 8 // BLOCK * 4, 8)).view("<u4")
            levels.append(Level(size, width, chunks, bitmap, ones))
        return Codes(n, levels)

    def get(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions, in any order, repeats allowed."""
        i = np.asarray(positions, np.int64)
        if len(i) and (i.min() < 0 or i.max() >= self.n):
            raise IndexError("position outside the sequence")
        out, at, shift = np.zeros(len(i), np.uint64), np.arange(len(i)), 0
        for level in self.levels:
            if not len(i):
                break
            out[at] |= level.chunk(i) << np.uint64(shift)
            shift += level.width
            if level.bitmap is not None:
                on = level.goes_on(i)
                at, i = at[on], level.rank(i[on])
        return out

    def slice(self, a: int, b: int) -> np.ndarray:
        """The ids at positions ``a`` to ``b - 1``: one stretch of every level."""
        if not 0 <= a <= b <= self.n:
            raise IndexError("stretch outside the sequence")
        out, at, shift = np.zeros(b - a, np.uint64), None, 0
        for level in self.levels:
            if a == b:
                break
            chunks = level.chunk(np.arange(a, b)) << np.uint64(shift)
            if at is None:
                out, at = chunks, np.arange(b - a)
            else:
                out[at] |= chunks
            shift += level.width
            if level.bitmap is not None:
                on = level.flags(a, b)
                a = int(level.rank(np.array([a]))[0])
                at, b = at[on], a + int(on.sum())
        return out


def len_padded(size: int, to: int) -> int:
    return size + -size % to
