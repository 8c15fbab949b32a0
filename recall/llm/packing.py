"""Lexical retrieval packing: sequences filled with documents that a BM25 index finds alike.

The index is sharded by likeness.  Every document of the corpus is routed by the least hash of its words, which documents
with a share J of common words have in common with probability J; documents are dealt by ranges of (route, hash of the id),
so that copies meet whichever part of the input they came from, and a group of copies that is too large for a partition is
cut.  A task cuts its rows, in this order, into shards of at most ``SHARD_DOCS`` documents and about ``SHARD_TOKENS`` tokens,
so a shard's memory is bounded.  In a shard, a seed document opens a sequence; its words query the shard's inverted index,
and the best documents that are not used yet fill the sequence one after another.  The one that reaches the end is cut, and
its rest seeds the next sequence.  What is left at the end of a shard is cut into sequences whose lengths are powers of two,
which need no padding.

Texts are tokenised through the distinct parts of their words: the tokenizer's pieces never cross white space,
nor borders between letters, digits and marks, so the ids of a text are those of its parts in order.  Only ids travel; the
words of a document are read off them again, as runs of ids up to one that ends a word.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, shared

SHARD_DOCS, SHARD_TOKENS = 1024, 2_000_000
#: Parts of words whose ids a worker remembers (about 40 bytes each), from task to task; then those go that came once.
REMEMBERED = 1_200_000
#: Parts of words that are encoded at a time.
TOGETHER = 500
#: Bytes of freed memory that a task keeps for its next arrays.
KEPT = 128 << 20
K1, B = 1.2, 0.75
#: Neighbours that one query returns at least, if there are so many; a sequence that they don't fill asks again.
NEIGHBOURS = 32


# Classes of bytes: letter, digit, other mark, white space.
_KIND = np.full(256, 3, np.uint8)
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2
_KIND[arrays.SPACE] = 0
#: Bytes of words that are given to the tokenizer whole: all but ASCII and the Latin-1 letters, and the apostrophe.
_WHOLE = np.zeros(256, bool)
_WHOLE[0xC0:0xC3] = _WHOLE[0xC4:] = _WHOLE[ord("'")] = True


def _parts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of parts, whether a part is a whole word, and the first part of each text.

    A word is cut where the tokenizer cuts it (between letters, marks and single digits).  Words that hold other
    characters, an apostrophe, or both ``<`` and ``|`` (a special token) stay whole, and as they are.
    """
    starts, ends, _ = arrays.words(buf, off)
    raw = buf.tobytes()
    odd = np.frombuffer(bytearray(raw.translate(_WHOLE.tobytes())), bool)
    if b"\xc3\x97" in raw or b"\xc3\xb7" in raw:
        odd[:-1] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
    if b"<|" in raw:
        odd[:-1] |= (buf[:-1] == ord("<")) & (buf[1:] == ord("|"))
    whole = np.zeros(len(starts), bool)
    whole[np.searchsorted(starts, np.flatnonzero(odd), "right") - 1] = True
    kind = np.frombuffer(raw.translate(_KIND.tobytes()), np.uint8)
    edge = np.zeros(len(buf), bool)
    edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    low = np.frombuffer(bytearray(raw.translate(arrays.LOWER.tobytes())), np.uint8)
    if whole.any():
        inside = arrays.ragged(starts[whole], (ends - starts)[whole])
        edge[inside] = False
        low[inside] = buf[inside]
    edge[starts] = True
    edge &= kind != 0
    first = np.flatnonzero(edge)
    opens = np.zeros(len(buf), bool)
    opens[starts] = True
    word = np.cumsum(opens[first]) - 1
    stop = np.minimum(np.r_[first[1:], len(buf)], ends[word])
    return low, first, stop, whole[word], np.searchsorted(first, off, "left")


class Words:
    """Token ids of parts of words, remembered within a worker process in arrays sorted by hash."""

    _all: dict[str, Words] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True
        self.clear()

    @classmethod
    def of(cls, path: str) -> Words:
        if path not in cls._all:
            cls._all[path] = cls(path)
        return cls._all[path]

    def clear(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def forget(self) -> None:
        """Parts that came again since the last time stay, unless they are most of all."""
        keep = self.uses > 1
        if 2 * np.count_nonzero(keep) > REMEMBERED:
            self.clear()
            return
        self.flat = self.flat[arrays.ragged(self.begin[keep], self.size[keep].astype(np.int64))]
        self.hash, self.size = self.hash[keep], self.size[keep]
        self.begin = np.cumsum(self.size, dtype=np.int64) - self.size
        self.uses = np.ones(len(self.hash), np.int32)

    def encode(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts in some order, and where each part's begin and how many they are.  Parts are encoded many at a
        time: each ends with the one token that ends a word."""
        plain, single = np.flatnonzero(~whole), [np.flatnonzero(whole)]
        width = (ends - starts)[plain]
        stop = np.cumsum(width + 1)
        joined = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint8)
        joined[arrays.ragged(stop - width - 1, width)] = buf[arrays.ragged(starts[plain], width)]
        cuts = [0, *stop[TOGETHER - 1 :: TOGETHER].tolist()]
        cuts += [len(joined)] if cuts[-1] < len(joined) else []
        texts = [joined[i : j - 1].tobytes().decode("utf-8", "replace") for i, j in zip(cuts, cuts[1:], strict=False)]
        flat, of, sizes = [], [], []
        for i, got in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids, group = np.array(got.ids, np.uint32), plain[i * TOGETHER : (i + 1) * TOGETHER]
            stops = np.flatnonzero(self.last[ids]) + 1
            if len(stops) != len(group) or stops[-1] != len(ids):
                single.append(group)
                continue
            flat.append(ids)
            of.append(group)
            sizes.append(np.diff(stops, prepend=0))
        alone = np.concatenate(single)
        texts = [buf[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[alone].tolist(), ends[alone].tolist(), strict=True)]
        lists = [np.array(got.ids, np.uint32) for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size, begin = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        own = np.concatenate([*of, alone])
        size[own] = np.concatenate([*sizes, np.fromiter(map(len, lists), np.int64, len(lists))])
        begin[own] = np.cumsum(size[own]) - size[own]
        return np.concatenate([np.zeros(0, np.uint32), *flat, *lists]), begin, size

    def tokens(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after another, and the number of ids of each part."""
        order = np.argsort(hashes)
        names = hashes[order]
        head = np.ones(len(names), bool)
        head[1:] = names[1:] != names[:-1]
        at, names = order[head], names[head]
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(head) - 1
        if len(self.hash) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.hash, names)
        new = np.ones(len(names), bool)
        some = place < len(self.hash)
        new[some] = self.hash[place[some]] != names[some]
        if new.any():
            own = at[new]
            flat, begin, size = self.encode(buf, starts[own], ends[own], whole[own])
            to = place[new] + np.arange(len(own))
            old = np.ones(len(self.hash) + len(own), bool)
            old[to] = False

            def put(have: np.ndarray, more: np.ndarray | int) -> np.ndarray:
                out = np.empty(len(old), have.dtype)
                out[old], out[to] = have, more
                return out

            self.hash, self.size, self.uses = put(self.hash, names[new]), put(self.size, size), put(self.uses, 0)
            self.begin = put(self.begin, len(self.flat) + begin)
            self.flat = np.concatenate([self.flat, flat])
            place += np.cumsum(new) - new  # the new ones before each
        self.uses[place] += 1
        size = self.size[place].astype(np.int64)[back]
        return self.flat[arrays.ragged(self.begin[place][back], size)], size


def narrow(words: np.ndarray, bits: int) -> np.ndarray:
    """Words of ``terms`` with their ids in fewer bits, or numbered where these don't do; in the same order."""
    ids = [words >> np.uint64(20 * j) & np.uint64((1 << 20) - 1) for j in range(3)]
    if int(words.max()) >> 60 or max(int(x.max()) for x in ids) >> bits:
        return np.unique(words, return_inverse=True)[1]
    return ids[0] | ids[1] << np.uint64(bits) | ids[2] << np.uint64(2 * bits)


class Index:
    """BM25 inverted index of one shard over the distinct words of its documents."""

    def __init__(self, words: np.ndarray, length: np.ndarray):
        """The words of all documents, one after another, and how many each has."""
        n, length = len(length), length.astype(float)
        bits = np.uint64(max(0, n - 1).bit_length())
        if len(words) and int(words.max()).bit_length() + int(bits) > 64:
            words = narrow(words, (64 - int(bits)) // 3)
        # sorted as one number, word and document
        key = np.sort(words.astype(np.uint64) << bits | np.repeat(np.arange(n, dtype=np.uint64), length.astype(np.int64)))
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        tf = np.diff(np.r_[head, len(key)])
        doc = (key[head] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        word = key[head] >> bits
        word = np.cumsum(np.r_[False, word[1:] != word[:-1]][: len(word)])
        df = np.bincount(word)
        # a word of one document finds nothing, one of most documents has no weight (its idf is not above 0)
        idf = np.log((n - df + 0.5) / (df + 0.5))
        keep = (df[word] > 1) & (idf[word] > 0)
        word, doc, tf = word[keep], doc[keep], tf[keep]
        mean = max(1.0, length.mean()) if n else 1.0
        self.n = n
        self.doc = doc
        self.weight = idf[word] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean))
        self.begin = np.searchsorted(word, np.arange(len(df) + 1))
        order = np.argsort(doc.astype(np.uint16) if n <= 1 << 16 else doc, kind="stable")
        word = word[order]
        self.first, self.size = self.begin[word], self.begin[word + 1] - self.begin[word]
        self.of = np.searchsorted(doc[order], np.arange(n + 1))
        self.turn = np.arange(len(word))

    def scores(self, seed: int) -> np.ndarray:
        own = slice(self.of[seed], self.of[seed + 1])
        first, size = self.first[own], self.size[own]
        stop = np.cumsum(size)
        at = np.repeat(first - stop + size, size)
        at += self.turn[: len(at)]
        return np.bincount(self.doc.take(at), weights=self.weight.take(at), minlength=self.n)


def pack(sizes: np.ndarray, index: Index, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every token of the shard once."""
    out: list[list[tuple[int, int, int]]] = []
    unused = np.ones(len(sizes), bool)
    now: list[tuple[int, int, int]] = []
    room, first = window, 0

    def put(doc: int) -> None:
        nonlocal now, room
        start = 0
        while start < sizes[doc]:
            take = min(room, int(sizes[doc]) - start)
            now.append((doc, start, take))
            start += take
            room -= take
            if not room:
                out.append(now)
                now, room = [], window

    while True:
        while first < len(sizes) and not unused[first]:
            first += 1
        if first == len(sizes):
            break
        if not now:  # a seed that nothing was cut for
            unused[first] = False
            put(first)
            continue
        seed = now[0][0]
        score = np.where(unused, index.scores(seed), -1.0)
        live = np.flatnonzero(score > 0)
        if len(live) > NEIGHBOURS:
            least = np.partition(score[live], len(live) - NEIGHBOURS)[len(live) - NEIGHBOURS]
            live = live[score[live] >= least]
        best = live[np.argsort(-score[live], kind="stable")]
        if not len(best):
            best = np.array([first])
        for doc in best.tolist():
            unused[doc] = False
            put(doc)
            if not now or now[0][0] != seed:
                break
    if now:  # powers of two
        left = window - room
        bits = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        part: list[tuple[int, int, int]] = []
        need = bits.pop(0)
        for doc, start, length in now:
            while length:
                take = min(need, length)
                part.append((doc, start, take))
                start, length, need = start + take, length - take, need - take
                if not need:
                    out.append(part)
                    part = []
                    need = bits.pop(0) if bits else 0
    return out


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def terms(ids: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of documents (ids one after another, the end mark of each included) as numbers made of their first three
    ids, and how many words each document has; the end marks are no words."""
    marks = np.cumsum(sizes) - 1
    stops = last[ids]
    stops[marks] = True
    stop = np.flatnonzero(stops)
    begin = np.r_[0, stop + 1][:-1]
    size = stop - begin + 1
    size[np.searchsorted(stop, marks)] -= 1
    keep = size > 0
    begin, size = begin[keep], size[keep]
    out = ids[begin].astype(np.uint64) + np.uint64(1)
    go = np.arange(len(begin))
    for j in (1, 2):
        go = go[size[go] > j]
        out[go] |= (ids[begin[go] + j].astype(np.uint64) + np.uint64(1)) << np.uint64(20 * j)
    return out, np.diff(np.searchsorted(begin, np.r_[0, marks + 1]))


def _tokenised(rows: DataFrame, path: str, end_id: int, kind: str) -> DataFrame:
    """(route, doc_id, ids) of each row; ids as numbers of ``kind`` with the end mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.of(path)
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text", 3 * arrays.PIECE_BYTES):
                low, starts, ends, whole, first = _parts(buf, off)
                h = arrays.Rolling(low).of(starts, ends)
                flat, size = words.tokens(low, starts, ends, whole, h)
                at = np.concatenate([[0], np.cumsum(size)])[first]
                # the end mark of each row goes in after its ids
                every = np.insert(flat.astype(kind), at[1:], np.array(end_id, kind))
                stop = (at + np.arange(b - a + 1)).astype(np.int64) * every.itemsize
                route = np.full(b - a, -1, np.int64)
                some = np.flatnonzero(np.diff(first))
                if len(some):
                    route[some] = (np.minimum.reduceat(arrays.mix(h ^ np.uint64(0x51ED270B)), first[:-1][some]) >> np.uint64(1)).astype(np.int64)
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(stop), pa.py_buffer(every)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(route), batch.column(0).slice(a, b - a), ids], ["route", "doc_id", "ids"])

    return rows.mapInArrow(arrays.lean(run, KEPT), "route long, doc_id long, ids binary")


def pack_documents(docs: DataFrame, window: int = 2048, end_id: int = 1, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document is the ids of its text and then ``end_id``; its pieces cover it once.  Sequences have ``window``
    ids or, at the end of a shard, a power of two.  ids_crc32 is of the piece's ids as little-endian unsigned
    32-bit numbers; sequence_id is unique, offsets in a sequence leave no gap.

    A null or empty text is ``end_id`` alone.  Repeated rows and null ids are documents like others.  Texts of any length are
    cut into as many pieces as they need; a text is tokenised in one piece, in memory of some 40 times its size.  Of
    neighbours with equal scores the earlier row of the shard comes first.  Other columns are ignored, whatever their names;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    ends = Words.of(path).last
    last = spark.sparkContext.broadcast(ends)  # a byte for each id
    kind = "<u2" if len(ends) <= 1 << 16 and end_id < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        ids: list = []
        tokens: list[np.ndarray] = []
        held = 0

        def done() -> pa.RecordBatch:
            nonlocal sequence
            sizes = np.array([len(x) for x in tokens])
            rows: list[list] = [[] for _ in _NAMES]
            parts = []
            for pieces in pack(sizes, Index(*terms(np.concatenate(tokens), sizes, last.value)), window):
                offset = 0
                for doc, start, length in pieces:
                    part = tokens[doc][start : start + length].astype("<u4")
                    for column, x in zip(rows, (ids[doc], start, length, zlib.crc32(part.tobytes()), int(sizes[doc]), sequence, offset), strict=True):
                        column.append(x)
                    if with_ids:
                        parts.append(part.astype(np.int64))
                    offset += length
                sequence += 1
            columns = [pa.array(x, pa.int64()) for x in rows]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, [*_NAMES, "ids"] if with_ids else _NAMES)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(raw.as_buffer(), kind).copy()
                if ids and (len(ids) >= SHARD_DOCS or held + len(own) > SHARD_TOKENS):
                    yield done()
                    ids, tokens, held = [], [], 0
                ids.append(doc)
                tokens.append(own)
                held += len(own)
        if ids:
            yield done()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # written, since dealing by ranges looks at the routes first and would tokenise twice
    table = shared.save(_tokenised(rows, path, end_id, kind), "ids").withColumn("turn", F.xxhash64("doc_id"))
    dealt = table.repartitionByRange(shared.parts(spark), "route", "turn").sortWithinPartitions("route", "turn", "doc_id")
    return dealt.select("doc_id", "ids").mapInArrow(arrays.lean(run, KEPT), _SCHEMA + (", ids array<long>" if with_ids else ""))
