"""Suffix arrays by induced sorting, in numpy.

The sequential scans of the textbook method are done bucket by bucket: within the bucket of one symbol all
entries that are known induce their predecessors at once, and only entries of that same symbol need another
round.  The work stays linear in the text; the Python overhead depends on the alphabet, not on the length.

Reduced texts have as many symbols as there are different leftmost-smaller substrings, and most buckets are tiny.  There
ranges of symbols are scanned at once: a range goes as far as no suffix in it depends on one of another symbol in it,
which for n symbols in no particular order gives some square root of n ranges.
"""

from __future__ import annotations

import numpy as np

from . import arrays

#: Above this many symbols ranges of them are induced at once instead of one symbol after another.
SYMBOLS = 2048


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour (S type); the empty suffix is least."""
    n = len(t)
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1].astype(np.int64))
    rise[-1] = -1
    at = np.where(rise != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return rise[at] > 0


def _deal(out: list[list[np.ndarray]], symbols: np.ndarray, suffixes: np.ndarray) -> None:
    """Append each suffix to the list of its symbol, in the order given."""
    if not len(suffixes):
        return
    order = np.argsort(symbols, kind="stable")
    symbols, suffixes = symbols[order], suffixes[order]
    cut = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    begin = np.r_[0, cut]
    for c, i, j in zip(symbols[begin].tolist(), begin.tolist(), np.r_[cut, len(symbols)].tolist(), strict=True):
        out[c].append(suffixes[i:j])


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, induced from ``lms`` (leftmost-smaller suffixes, in their order within each symbol)."""
    none = np.zeros(0, np.int64)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(seeds, t[lms], lms)
    larger[int(t[-1])].append(np.array([len(t) - 1]))
    first: list[np.ndarray] = [none] * size
    used = np.unique(t).tolist()
    for c in used:
        done = []
        while larger[c]:
            now = np.concatenate(larger[c])
            larger[c] = []
            done.append(now)
            before = now[now > 0] - 1
            before = before[~small[before]]
            _deal(larger, t[before], before)
        first[c] = np.concatenate(done) if done else none
        if seeds[c]:
            before = np.concatenate(seeds[c]) - 1
            _deal(larger, t[before], before)
    smaller: list[list[np.ndarray]] = [[] for _ in range(size)]
    parts: list[np.ndarray] = []
    for c in reversed(used):
        done = []
        while smaller[c]:
            now = np.concatenate(smaller[c])
            smaller[c] = []
            done.append(now)
            before = now[now > 0] - 1
            before = before[small[before]]
            _deal(smaller, t[before], before)
        back = first[c][::-1]
        before = back[back > 0] - 1
        before = before[small[before]]
        _deal(smaller, t[before], before)
        parts += [*done, back]
    return np.concatenate(parts)[::-1]


def _rounds(first: np.ndarray, t: np.ndarray, small: np.ndarray, kind: bool) -> np.ndarray:
    """``first`` and, after them, round by round, the suffixes that put one more of the same symbol before them."""
    out, now = [first], first
    while len(now):
        before = now[now > 0] - 1
        now = before[(t[before] == t[before + 1]) & (small[before] == kind)]
        if len(now):
            out.append(now)
    return np.concatenate(out) if len(out) > 1 else first


def _by_symbol(t: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = suffixes[np.argsort(t[suffixes], kind="stable")]
    return own, t[own]


def _induce_ranges(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """As ``_induce``, by ranges of symbols: what a range needs lies in the ranges before, or is of the same symbol."""
    n = len(t)
    here = np.arange(n)
    seeds, seed_symbol = _by_symbol(t, lms)
    larger, larger_symbol = _by_symbol(t, here[~small])
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1  # the empty suffix is least
    end = np.r_[t, -1]
    fall = larger[end[larger + 1] < larger_symbol]  # these depend on another symbol
    reach = np.full(size + 1, size, np.int64)
    inner = fall[fall + 1 < n]
    np.minimum.at(reach, t[inner + 1], t[inner])
    reach = np.minimum.accumulate(reach[::-1])[::-1]
    fall, fall_symbol = _by_symbol(t, fall)
    done: list[np.ndarray] = []
    lo = count = 0
    while lo < size:
        hi = int(reach[lo])
        first = fall[np.searchsorted(fall_symbol, lo) : np.searchsorted(fall_symbol, hi)]
        first = first[np.lexsort((rank[first + 1], t[first]))]
        own = _rounds(first, t, small, False)
        more = seeds[np.searchsorted(seed_symbol, lo) : np.searchsorted(seed_symbol, hi)]
        both = np.concatenate([own, more])
        if len(both):
            key = 2 * t[both]
            key[len(own) :] += 1
            both = both[np.argsort(key, kind="stable")]
            rank[both] = count + np.arange(len(both))
            count += len(both)
            done.append(both)
        lo = hi
    scanned = np.concatenate(done)
    larger = scanned[~small[scanned]][::-1]  # downwards
    larger_symbol = t[larger]
    smaller, smaller_symbol = _by_symbol(t, here[small])
    rise = smaller[t[np.minimum(smaller + 1, n - 1)] > smaller_symbol]
    reach = np.full(size + 1, -1, np.int64)
    np.maximum.at(reach, t[rise + 1], t[rise])
    reach = np.maximum.accumulate(reach)
    rise, rise_symbol = _by_symbol(t, rise)
    parts: list[np.ndarray] = []
    hi, count = size, 0
    while hi > 0:
        lo = int(reach[hi - 1]) + 1
        first = rise[np.searchsorted(rise_symbol, lo) : np.searchsorted(rise_symbol, hi)]
        first = first[np.lexsort((rank[first + 1], -t[first]))]
        own = _rounds(first, t, small, True)
        more = larger[np.searchsorted(-larger_symbol, -(hi - 1)) : np.searchsorted(-larger_symbol, -lo, "right")]
        both = np.concatenate([own, more])
        if len(both):
            key = -2 * t[both]
            key[: len(own)] -= 1
            both = both[np.argsort(key, kind="stable")]
            rank[both] = count + np.arange(len(both))
            count += len(both)
            parts.append(both)
        hi = lo
    return np.concatenate(parts)[::-1]


def _doubled(t: np.ndarray) -> np.ndarray:
    """Suffix order by doubling the compared length."""
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64) + 1
    n, step = len(t), 1
    while True:
        key = rank << 32
        key[: n - step] |= rank[step:] if step < n else 0
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.r_[1, (key[order[1:]] != key[order[:-1]]).astype(np.int64)])
        if new[order[-1]] == n or step >= n:
            return order
        rank, step = new, 2 * step


def suffix_array(t: np.ndarray, size: int = 256, recurse: bool = True) -> np.ndarray:
    """Start positions of all suffixes of ``t`` (symbols 0 to size - 1) in lexicographic order.

    Without ``recurse`` reduced texts of more than ``SYMBOLS`` symbols are sorted by doubling.
    """
    n = len(t)
    if n < 2:
        return np.arange(n)
    if size > SYMBOLS and not recurse:
        return _doubled(t)
    t = t.astype(np.int64) if size > SYMBOLS else t
    induce = _induce_ranges if size > SYMBOLS else _induce
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        guess = induce(t, small, lms, size)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = guess[is_lms[guess]]
        stop = np.full(n, n, np.int64)
        stop[lms[:-1]] = lms[1:] + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(arrays.mix(t.astype(np.uint64) + np.uint64(1)) * arrays._power(arrays._BASE, n), out=sums[1:])
        end = stop[order]
        value = (sums[end] - sums[order]) * arrays._power(arrays._INV, n + 1)[order]
        value[order == lms[-1]] ^= np.uint64(0x5BF03635)
        span = end - order
        name = np.cumsum(np.r_[0, ((value[1:] != value[:-1]) | (span[1:] != span[:-1])).astype(np.int64)])
        if name[-1] + 1 < len(lms):
            of = np.zeros(n, np.int64)
            of[order] = name
            order = lms[suffix_array(of[lms], int(name[-1]) + 1, recurse)]
        lms = order
    return induce(t, small, lms, size)


def common_prefixes(t: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes: for each suffix of ``order`` but the first, by its place in the text, the
    length it shares with the suffix before it in ``order``, up to ``limit``; all must reach ``limit``."""
    out = np.zeros(len(t), np.int32)
    if len(order) < 2:
        return out
    room = np.zeros(len(t) + 16, np.uint8)
    room[: len(t)] = t
    eight = np.ndarray((len(t) + 8,), "<u8", room.tobytes(), 0, (1,))
    a, b = order[1:], order[:-1]
    live = np.arange(len(a))
    for j in range(0, limit, 8):
        x = eight[a[live] + j] ^ eight[b[live] + j]
        differ = x != 0
        gone = live[differ]
        low = x[differ]
        out[a[gone]] = np.minimum(limit, j + (np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int32) >> 3))
        live = live[~differ]
    out[a[live]] = limit
    return out
