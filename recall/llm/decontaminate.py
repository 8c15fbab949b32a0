"""Benchmark decontamination: SimHash of item-sized windows, then exact weighted-shingle similarity.

A benchmark item of m words is looked for in every window of m words of every text; a text of fewer words is one
window.  Windows that share too
little weight with all items of their size cannot reach the threshold and are skipped (a sum over the shingles
of any item).  For the others a 64-bit SimHash is taken from running sums.  Fingerprints are cut into 8 blocks
of 8 bits: if two differ in at most ``RADIUS`` = 23 bits, some block differs in at most 2, so an index of each
block's values and their neighbours at distance 2 finds all fingerprints within the radius.  Found pairs are
verified by their exact weighted Jaccard similarity.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters, one pass over the texts for each.  Every
task holds a block, and the weights of the shingles that two or more items of the whole benchmark have (all others
weigh the same), so results don't depend on blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, shared

RADIUS, BLOCKS, NEAR = 23, 8, 2
BLOCK_CHARS = 16 << 20
#: Words of a text whose running sums are held at a time.
SPAN = 20_000

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _planes(h: np.ndarray) -> np.ndarray:
    """Bits of each hash as -1 and 1 (n x 64)."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.float64) * 2 - 1


def _fixed(weight: np.ndarray) -> np.ndarray:
    """Weights as whole numbers, whose running sums are exact wherever they begin."""
    return np.rint(np.asarray(weight, float) * (1 << 20))


def _bag(text: str, k: int) -> tuple[Counter, int]:
    """Shingles of an item and its number of words."""
    buf = arrays.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = arrays.words(buf, np.array([0, len(buf)]))
    h = arrays.Rolling(buf).of(starts, ends)
    return Counter(arrays.window_hash(h, min(k, len(h))).tolist()) if len(h) else Counter(), len(h)


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


class Items:
    """Benchmark items of one block, by number of words, with their fingerprints and block index."""

    def __init__(self, ids: list, texts: list[str], k: int, common: tuple[int, np.ndarray, np.ndarray] | None = None):
        """``common``: items of the whole benchmark, its shingles that two or more of them have (sorted), and how many
        have each; without it these are all items."""
        self.k, self.ids = k, ids
        bags, lengths = zip(*(_bag(text, k) for text in texts), strict=True)
        df = Counter(x for bag in bags for x in bag)
        self.bags = bags
        self.known = np.array(sorted(df), np.uint64)
        have = np.array([df[int(x)] for x in self.known], float)
        items, self.other, others = common or (len(texts), np.zeros(0, np.uint64), np.zeros(0))
        if common:
            have = np.ones(len(self.known))
            same = np.isin(self.known, self.other)
            have[same] = others[np.searchsorted(self.other, self.known[same])]
            rest = ~np.isin(self.other, self.known)
            self.other, others = self.other[rest], others[rest]
        self.most = float(np.log(1 + items))
        self.weight = np.log(1 + items / have)
        self.other_weight = np.log(1 + items / others)
        self.total = np.array([sum(c * self.weigh(x) for x, c in bag.items()) for bag in bags])
        prints = []
        for bag in bags:
            h = np.array(list(bag), np.uint64)
            w = np.array([c * _fixed(self.weigh(x)) for x, c in bag.items()])
            prints.append(int(_pack((_planes(h) * w[:, None]).sum(0, keepdims=True))[0]) if len(h) else 0)
        self.prints = np.array(prints, np.uint64)
        self.by: dict[int, np.ndarray] = {}
        for i, n in enumerate(lengths):
            if n:
                self.by.setdefault(n, []).append(i)
        self.by = {n: np.array(x) for n, x in self.by.items()}
        self.index = {n: self._index(self.prints[x]) for n, x in self.by.items()}
        self.longest = max(self.by, default=0)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.known >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _index(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block: where the list of each of the 256 values begins, and the items whose block differs in at most NEAR bits."""
        parts = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        values = np.arange(256, dtype=np.uint8)
        out = []
        for b in range(BLOCKS):
            value, item = np.nonzero(_POP[parts[None, :, b] ^ values[:, None]] <= NEAR)
            out.append((np.searchsorted(value, np.arange(257)).astype(np.int32), item.astype(np.int32)))
        return out

    def weigh(self, h: int) -> float:
        at = int(np.searchsorted(self.known, np.uint64(h)))
        if at < len(self.known) and int(self.known[at]) == h:
            return float(self.weight[at])
        at = int(np.searchsorted(self.other, np.uint64(h)))
        return float(self.other_weight[at]) if at < len(self.other) and int(self.other[at]) == h else self.most

    def weights(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each shingle, and its weight if an item has it (else 0)."""
        hit = np.flatnonzero(self.table[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, h[hit]), max(0, len(self.known) - 1))
        same = self.known[at] == h[hit] if len(self.known) else np.zeros(len(hit), bool)
        own = np.zeros(len(h))
        own[hit[same]] = self.weight[at[same]]
        all_ = np.where(own > 0, own, self.most)
        if len(self.other):
            at = np.minimum(np.searchsorted(self.other, h), len(self.other) - 1)
            same = self.other[at] == h
            all_[same] = self.other_weight[at[same]]
        return all_, own

    def near(self, n: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all fingerprint pairs within RADIUS."""
        of, items = self.index[n], self.by[n]
        parts = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        found = []
        for (begin, held), value in zip(of, parts.T.astype(np.int64), strict=True):
            size = (begin[value + 1] - begin[value]).astype(np.int64)
            if size.sum():
                found.append(np.repeat(np.arange(len(prints)), size) * len(items) + held[arrays.ragged(begin[value].astype(np.int64), size)])
        if not found:
            return (np.zeros(0, np.int64),) * 3
        pair = np.unique(np.concatenate(found))
        window, item = pair // len(items), items[pair % len(items)]
        differ = (prints[window] ^ self.prints[item]).astype("<u8").view(np.uint8).reshape(-1, 8)
        distance = _POP[differ].sum(1).astype(np.int64)
        keep = distance <= RADIUS
        return window[keep], item[keep], distance[keep]

    def similarity(self, bag: Counter, item: int) -> float:
        """Weighted Jaccard similarity of two bags of shingles."""
        other = self.bags[item]
        both = sum(min(c, other[x]) * self.weigh(x) for x, c in bag.items() if x in other)
        union = sum(c * self.weigh(x) for x, c in bag.items()) + self.total[item] - both
        return both / union if union else 0.0


def _matches(items: Items, hashes: np.ndarray, least: float) -> dict[int, tuple[float, int, int, int]]:
    """Items found in one text (word hashes): item -> (similarity, distance, first word, words)."""
    k, out = items.k, {}
    of: dict[int, tuple[np.ndarray, ...]] = {}
    for n in sorted(items.by):
        size = min(k, n)
        words = min(n, len(hashes))
        if words < size:
            continue
        if size not in of:
            grams = arrays.window_hash(hashes, size)
            weight, own = items.weights(grams)
            of[size] = grams, _fixed(weight), np.concatenate([[0.0], np.cumsum(own)])
        grams, weight, run = of[size]
        span = words - size + 1
        starts = np.flatnonzero(run[span:] - run[:-span] >= least * items.total[items.by[n]].min() - 1e-6)
        for lo in range(0, len(starts), SPAN):
            at = starts[lo : lo + SPAN]
            group = np.cumsum(np.r_[0, np.diff(at) > span]) if len(at) else at
            for g in range(int(group[-1]) + 1 if len(group) else 0):
                own_at = at[group == g]
                first, last = own_at[0], own_at[-1] + span
                sums = np.concatenate([np.zeros((1, 64)), np.cumsum(_planes(grams[first:last]) * weight[first:last, None], 0)])
                prints = _pack(sums[own_at - first + span] - sums[own_at - first])
                window, item, distance = items.near(n, prints)
                for i in np.lexsort((own_at[window], distance, item)):
                    t = int(item[i])
                    if t in out and out[t][1] <= distance[i]:
                        continue
                    begin = int(own_at[window[i]])
                    s = items.similarity(Counter(grams[begin : begin + span].tolist()), t)
                    if s >= least:
                        out[t] = (s, int(distance[i]), begin, words)
    return out


def _texts(batch: pa.RecordBatch, items: Items) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of the rows that share a shingle with an item."""
    sizes = sorted({min(items.k, n) for n in items.by})
    for a, b, buf, off in arrays.text_pieces(batch, "text"):
        low = arrays.LOWER[buf]
        starts, ends, first = arrays.words(low, off)
        h = arrays.Rolling(low).of(starts, ends)
        live = np.zeros(b - a, bool)
        rows = np.repeat(np.arange(b - a), np.diff(first))
        for size in sizes:
            grams = arrays.window_hash(h, size)
            maybe = np.flatnonzero(items.table[(grams >> np.uint64(44)).astype(np.int64)])
            maybe = maybe[np.isin(grams[maybe], items.known)]
            live[rows[maybe]] = True
        for i in np.flatnonzero(live):
            yield a + i, h[first[i] : first[i + 1]]


def _common(rows: DataFrame, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of items, the shingles that two or more of them have, and how many have each."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.array(list(_bag(text, k)[0]), np.uint64).view(np.int64))], ["h"])

    got = rows.select("text").mapInArrow(arrays.lean(shingles), "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > 1).toArrow()
    h, n = got["h"].to_numpy().astype(np.int64).view(np.uint64), got["n"].to_numpy().astype(float)
    order = np.argsort(h)
    return rows.count(), h[order], n[order]


def _blocks(benchmark: DataFrame, k: int) -> Iterator[tuple[Items, bool]]:
    """The blocks of the benchmark, and whether there are several."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull()).distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-int(total) * 5 // (BLOCK_CHARS * 4))) if total > BLOCK_CHARS else 1
    common = _common(rows, k) if count > 1 else None
    for i in range(count):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i) if count > 1 else rows
        got = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if got:
            yield Items([x for x, _ in got], [x for _, x in got], k, common), count > 1


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.75) -> DataFrame:
    """(doc_id, item_id, similarity, distance, first_word, n_words), a row for each row of ``docs`` and item found in it.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.  An item is found where some window of as many
    words (the whole text, if it has fewer) has weighted Jaccard similarity of at least ``least`` of ``k``-word shingles (A-Z as a-z), each shingle
    weighing log(1 + items / items that have it), and fingerprints at most RADIUS bits apart; the reported window
    is the first that passes in order of distance and place.

    Items of fewer than ``k`` words are one shingle.  Null and empty texts and items match nothing.  A similarity of
    exactly ``least`` is a match.  A text is hashed in one piece, in memory of some 60 times its size.  Repeated document
    rows match each for themselves; repeated items once.  A null doc_id or item_id is returned as null.  Other columns are
    ignored, whatever their names; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = block.value
            for batch in batches:
                found = [(batch.column(0)[i].as_py(), items.ids[t], *x) for i, h in _texts(batch, items) for t, x in sorted(_matches(items, h, least).items())]
                if found:
                    types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), types, strict=True)], ["doc_id", "item_id", "similarity", "distance", "first_word", "n_words"])

        return docs.mapInArrow(arrays.lean(run), schema)

    schema = "doc_id long, item_id long, similarity double, distance long, first_word long, n_words long"
    parts: list[DataFrame] = []
    for items, more in _blocks(benchmark, k):
        block = spark.sparkContext.broadcast(items)
        part = search(block)
        if more:  # one block at a time is held by the tasks
            part = shared.save(part, "matches")
            block.destroy()
        parts.append(part)
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.75) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item of ``benchmark`` is found (see ``benchmark_matches``)."""
    spark = docs.sparkSession
    shared.ship(spark)

    def clean(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = block.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, h in _texts(batch, items):
                    keep[i] = not _matches(items, h, least)
                yield batch.filter(pa.array(keep))

        return run

    for items, more in _blocks(benchmark, k):
        block = spark.sparkContext.broadcast(items)
        docs = docs.mapInArrow(arrays.lean(clean(block)), docs.schema)
        if more:
            docs = shared.save(docs, "clean")
            block.destroy()
    return docs
