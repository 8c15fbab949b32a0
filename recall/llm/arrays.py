"""Words, shingles and rolling hashes of whole Arrow text batches, without Python strings.

A text column arrives as one UTF-8 buffer with offsets.  All functions here work on that buffer with
numpy, in pieces of bounded size, so that neither one row nor one batch needs Python objects per word.
Null texts are read as empty ones.  A single text is never cut, however long it is.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes from which on an array has pages of its own, which go back to the system with it.
MAPPED = 1 << 19
_libc = None
with contextlib.suppress(OSError, AttributeError):  # glibc: give large arrays back to the system when freed
    _libc = ctypes.CDLL("libc.so.6")
    _libc.mallopt(-3, MAPPED)
pa.set_memory_pool(pa.system_memory_pool())

Batches = Iterator[pa.RecordBatch]


_settled = False


def settle() -> None:
    """Once a process: what is there now (modules) is no garbage, and later collections need not look through it.

    They take 70 ms with it, and a worker collects twice a task (Spark's daemon does too).
    """
    global _settled
    if not _settled:
        gc.collect()
        gc.freeze()
        _settled = True


def trim() -> None:
    gc.collect()
    if _libc is not None:
        _libc.malloc_trim(0)


def limits(mapped: int, kept: int) -> None:
    """Arrays of ``mapped`` bytes have pages of their own; others leave up to ``kept`` bytes to the next ones."""
    if _libc is not None:
        _libc.mallopt(-3, mapped)
        _libc.mallopt(-1, kept)


def lean(run: Callable[[Batches], Batches], kept: int = 0) -> Callable[[Batches], Batches]:
    """``run``, and at the end of the task its memory goes back to the system: workers live on and serve later stages.

    Up to ``kept`` bytes of what is freed meanwhile stay for the next arrays, which then need no new pages.
    """

    def go(batches: Batches) -> Batches:
        settle()
        if kept:
            limits(32 << 20, kept)
        try:
            yield from run(batches)
        finally:
            if kept:
                limits(MAPPED, 128 << 10)
        trim()

    return go


#: Bytes of text handled at a time (one longer text is a piece of its own).
PIECE_BYTES = 3 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the murmur3 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1024)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def text_pieces(batch: pa.RecordBatch, column: str, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets) of runs of rows of about ``piece_bytes``."""
    got = batch.column(batch.schema.get_field_index(column))
    if got.null_count:
        got = got.fill_null("")
    if not len(got):
        return
    wide = pa.types.is_large_string(got.type) or pa.types.is_large_binary(got.type)
    _, offsets, data = got.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[got.offset : got.offset + len(got) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(got):
        last = max(first + 1, int(np.searchsorted(off, off[first] + piece_bytes, "right")) - 1)
        last = min(last, len(got))
        yield first, last, raw[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word ``[^\\x20\\x09-\\x0D]+``, and the first word of each text (n + 1 entries)."""
    n = len(buf)
    inside = ~SPACE[buf]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    edge = off[:-1][off[:-1] < n]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    edge = off[1:][off[1:] > off[:-1]] - 1
    after[edge] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off, "left")


class Rolling:
    """Prefix sums that give the 64-bit hash of any byte range in constant time."""

    def __init__(self, buf: np.ndarray):
        self.n = len(buf)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.take(_BYTE, buf, out=self.sums[1:])
        self.sums[1:] *= _power(_BASE, self.n)
        np.cumsum(self.sums[1:], out=self.sums[1:])
        self.back = _power(_INV, self.n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def window_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (len - k + 1 entries), over text borders too."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0xD1342543DE82EF95)
        out += hashes[j : j + n]
    return mix(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... of all ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.ones(total, np.int64)
    live = lengths > 0
    s, n = starts[live], lengths[live]
    at = np.cumsum(n) - n
    out[at[0]] = s[0]
    out[at[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    del ends
    return np.cumsum(out)


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(texts' row, shingle hash) without repeats, sorted by row and hash; A-Z count as a-z.

    A text of fewer than ``k`` words has its whole word sequence as one shingle; one without words has none.
    """
    low = LOWER[buf]
    starts, ends, first = words(low, off)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = Rolling(low).of(starts, ends)
    rows = np.repeat(np.arange(len(off) - 1), np.diff(first))
    count = np.diff(first)
    long = window_hash(hashes, k)
    at = np.arange(len(long))
    fits = at + k <= first[1:][rows[: len(long)]] if len(long) else np.zeros(0, bool)
    row, value = rows[: len(long)][fits], long[fits]
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        short = np.array([int(window_hash(hashes[first[i] : first[i + 1]], int(count[i]))[0]) for i in few], np.uint64)
        row, value = np.concatenate([row, few]), np.concatenate([value, mix(short + count[few].astype(np.uint64))])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]
