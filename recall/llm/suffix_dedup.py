"""Removal of repeated byte strings with shard suffix arrays.

Two equal strings of ``length`` bytes have the same minimizer (the ``GRAM``-byte string with the least hash) at
the same place.  The windows of one text that share a minimizer occurrence are a run of neighbours, its
*snippet*; all copies of a window lie in snippets of one minimizer, so a minimizer is a shard key, and every
comparison can be made within its shard:

* an equal snippet (hash of all its bytes) occurred before: every window of it did, its bytes go;
* a minimizer with several different snippets: the first occurrence of each is fetched, snippets of many
  minimizers are laid in one shard text, its suffix array is induced, and common prefixes of neighbours in the
  array give the classes of equal windows; all but the first of each class go.

Large groups.  Equal snippets within a part of the input are joined before the shuffle, so a group of copies
sends one entry for each part.  A minimizer with more than ``HOT`` different snippets is dealt over several shards;
windows that are first in their shard are then compared across shards by a 128-bit hash and a minimum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, shared
from .suffix import common_prefixes, suffix_array

#: Bytes of a minimizer.
GRAM = 24
#: Bytes of text in one suffix array, a longer group of one minimizer aside.
SHARD_BYTES = 1 << 20
#: Different snippets of one minimizer that one shard takes (3.5 MB of text for strings of 100 bytes).
HOT = 20_000
#: Runs that a task joins before it passes them on (about 50 bytes each).
HELD = 200_000
_LAST = 2**63 - 1

_DOC = np.dtype([("doc", "<i8"), ("ver", "<i8"), ("cnt", "<u4")])
_RUN = np.dtype([("h", "<u4"), ("s", "<u8"), ("at", "<u4"), ("n", "u1")])


def _snippets(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, minimizer hash and snippet hash of every run of windows."""
    n, w = len(buf), length - GRAM + 1
    nothing = tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if n < length:
        return nothing
    roll = arrays.Rolling(buf)
    begin = np.arange(n - GRAM + 1)
    gram = roll.of(begin, begin + GRAM)
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | begin.astype(np.uint64)
    step = 1
    while 2 * step <= w:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if w > step:
        least = np.minimum(least[: -(w - step)], least[w - step :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(off)
    count = np.maximum(0, size - length + 1)
    start = arrays.ragged(off[:-1], count)
    if not len(start):
        return nothing
    row = np.repeat(np.arange(len(size)), count)
    place = place[start]
    head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
    many = np.diff(np.r_[head, len(start)])
    first, row = start[head], row[head]
    # a minimizer's hash is small by choice: mixed again, it is even over its range
    return row, first, many, arrays.mix(gram[place[head]] ^ np.uint64(0x9E3779B97F4A7C15)), roll.of(first, first + many + length - 1)


def _versions(batch: pa.RecordBatch, a: int, b: int, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column(0).slice(a, b - a).fill_null(_LAST).to_numpy(zero_copy_only=False)
    return ids, arrays.Rolling(buf).of(off[:-1], off[1:]).view(np.int64)


def _collect(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Per part of the input and bucket of minimizers the first run of each snippet; repeated ones as marks."""

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, ver, at, many, h, s = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, ver, doc, s))
        same = np.r_[False, s[order][1:] == s[order][:-1]]
        lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        twin = (doc[order] == doc[lead]) & (ver[order] == ver[lead]) & (at[order] == at[lead])
        gone, kept = order[same & ~twin], order[~same]
        bucket = ((h[kept] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        by = np.lexsort((at[kept], ver[kept], doc[kept], bucket))
        cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
        keys, blobs = [], []
        for f in np.flatnonzero(np.diff(cut)).tolist():
            o = kept[by[cut[f] : cut[f + 1]]]
            d, v = doc[o], ver[o]
            head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])])
            docs_, runs = np.zeros(len(head), _DOC), np.zeros(len(o), _RUN)
            docs_["doc"], docs_["ver"], docs_["cnt"] = d[head], v[head], np.diff(np.r_[head, len(o)])
            runs["h"], runs["s"], runs["at"], runs["n"] = h[o] & np.uint64(0xFFFFFFFF), s[o], at[o], many[o]
            keys.append(f)
            blobs.append(np.uint32(len(head)).tobytes() + docs_.tobytes() + runs.tobytes())
        m = len(keys)
        lists = [pa.array([None] * m + [x[gone]], pa.list_(pa.int64())) for x in (doc, ver, at, many)]
        return pa.RecordBatch.from_arrays([pa.array([*keys, int(s[0] % np.uint64(buckets))], pa.int32()), pa.array([*blobs, None], pa.binary()), *lists], ["bucket", "runs", "doc", "ver", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                ids, ver = _versions(batch, a, b, buf, off)
                row, first, many, h, s = _snippets(buf, off, length)
                if len(row):
                    held.append((ids[row], ver[row], first - off[row], many, h, s))
                if sum(len(x[0]) for x in held) > HELD:
                    yield flush(held)
                    held = []
        if held:
            yield flush(held)

    return docs.mapInArrow(arrays.lean(run), "bucket int, runs binary, doc array<long>, ver array<long>, at array<long>, n array<long>")


def _judge(most: int):
    """In one bucket: marks (key null) of snippets that occurred before, and the snippets to fetch (key set);
    a minimizer with over ``most`` different ones is dealt over several keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "ver", "at", "n", "key", "hot"]
        got: dict[int, list] = {}
        for batch in batches:
            for bucket, blob, doc, ver, at, n in zip(*(batch.column(i) for i in range(6)), strict=True):
                if blob.is_valid:
                    raw = blob.as_buffer()
                    m = int(np.frombuffer(raw, "<u4", 1)[0])
                    d = np.frombuffer(raw, _DOC, m, 4)
                    got.setdefault(bucket.as_py(), []).append((d, np.frombuffer(raw, _RUN, -1, 4 + m * _DOC.itemsize)))
                elif len(doc.values):
                    none = len(doc.values)
                    yield pa.RecordBatch.from_arrays([doc.values, ver.values, at.values, n.values, pa.nulls(none, pa.int64()), pa.array(np.zeros(none, bool))], names)
        for bucket, pairs in got.items():
            d = np.concatenate([x for x, _ in pairs])
            r = np.concatenate([x for _, x in pairs])
            del pairs[:]
            who = np.repeat(np.arange(len(d)), d["cnt"])
            count = np.sort(r["h"])
            again = np.unique(count[1:][count[1:] == count[:-1]])
            if not len(again):
                continue
            near = np.minimum(np.searchsorted(again, r["h"]), len(again) - 1)
            live = np.flatnonzero(again[near] == r["h"])
            r, who = r[live], who[live]
            doc, ver, at = d["doc"][who], d["ver"][who], r["at"].astype(np.int64)
            order = np.lexsort((at, ver, doc, r["s"], r["h"]))
            r, doc, ver, at = r[order], doc[order], ver[order], at[order]
            new_h = np.r_[True, r["h"][1:] != r["h"][:-1]]
            new_s = new_h | np.r_[True, r["s"][1:] != r["s"][:-1]]
            lead = np.maximum.accumulate(np.where(new_s, np.arange(len(r)), 0))
            gone = ~new_s & ~((doc == doc[lead]) & (ver == ver[lead]) & (at == at[lead]))
            group = np.cumsum(new_h) - 1
            kinds = np.bincount(group, weights=new_s).astype(np.int64)
            turn = np.cumsum(new_s) - 1
            turn -= turn[np.flatnonzero(new_h)][group]
            fetch = new_s & (kinds[group] > 1)
            hot = kinds[group] > most
            key = (np.int64(bucket) << 32) + r["h"].astype(np.int64)
            key = np.where(hot, arrays.mix((key + (turn // most << 48)).view(np.uint64)).view(np.int64), key)
            take = np.flatnonzero(gone | fetch)
            for i in range(0, len(take), 1 << 16):
                t = take[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[t]), pa.array(ver[t]), pa.array(at[t]), pa.array(r["n"][t].astype(np.int64)), pa.array(key[t], mask=~fetch[t]), pa.array(hot[t] & fetch[t])], names
                )

    return run


def _fetch(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                ids, ver = _versions(batch, a, b, buf, off)
                out: list[list] = [[] for _ in range(6)]
                for i in range(b - a):
                    for want in batch.column(2)[a + i].as_py():
                        if want["ver"] == ver[i]:
                            at = int(off[i]) + want["at"]
                            for held, x in zip(out, (want["key"], want["hot"], int(ids[i]), want["ver"], want["at"], buf[at : at + want["n"] + length - 1].tobytes()), strict=True):
                                held.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["key", "hot", "doc", "ver", "at", "bytes"])

    return run


def _shards(length: int, recurse: bool):
    """Snippets sorted by key: a suffix array for about SHARD_BYTES of them at a time."""

    def solve(docs: np.ndarray, vers: np.ndarray, ats: np.ndarray, hots: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        t = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(x) for x in texts])
        begin = np.cumsum(size) - size
        many = size - length + 1
        of = np.repeat(np.arange(len(texts)), size)
        valid = np.zeros(len(t), bool)
        valid[arrays.ragged(begin, many)] = True
        order = suffix_array(t, recurse=recurse)
        order = order[valid[order]]
        shared_ = common_prefixes(t, order, length)
        new = np.r_[True, shared_[order[1:]] < length]
        where = ats[of[order]] + order - begin[of[order]]
        label = np.cumsum(new) - 1
        doc, ver = docs[of[order]], vers[of[order]]
        by = np.lexsort((where, ver, doc, label))
        lead = by[np.maximum.accumulate(np.where(np.r_[True, label[by][1:] != label[by][:-1]], np.arange(len(by)), 0))]
        gone = np.zeros(len(order), bool)
        gone[by] = (doc[by] != doc[lead]) | (ver[by] != ver[lead]) | (where[by] != where[lead])
        marked = np.zeros(len(t), bool)
        marked[order[gone]] = True
        edge = np.r_[True, np.diff(of) != 0]
        start = np.flatnonzero(marked & (edge | ~np.r_[False, marked[:-1]]))
        stop = np.flatnonzero(marked & np.r_[edge[1:] | ~marked[1:], True]) + 1
        hot = order[~gone & hots[of[order]]]
        hot.sort()
        roll = arrays.Rolling(t)
        one = roll.of(hot, hot + length).view(np.int64)
        two = arrays.mix(roll.of(hot, hot + length // 2) * np.uint64(3) + roll.of(hot + length // 3, hot + length)).view(np.int64)
        place = np.r_[start, hot]
        none = np.r_[np.ones(len(start), bool), np.zeros(len(hot), bool)]
        rows = of[place]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(docs[rows]),
                pa.array(vers[rows]),
                pa.array(ats[rows] + place - begin[rows]),
                pa.array(np.r_[stop - start, np.ones(len(hot), np.int64)].astype(np.int64)),
                pa.array(np.r_[np.zeros(len(start), np.int64), one], mask=none),
                pa.array(np.r_[np.zeros(len(start), np.int64), two], mask=none),
            ],
            ["doc", "ver", "at", "n", "one", "two"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            keys, hots, docs, vers, ats = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            texts = batch.column(5).to_pylist()
            for i in range(len(texts)):
                if size >= SHARD_BYTES and keys[i] != last:
                    yield solve(*(np.array([x[j] for x in held]) for j in range(4)), [x[4] for x in held])
                    held, size = [], 0
                held.append((docs[i], vers[i], ats[i], hots[i], texts[i]))
                size += len(texts[i])
                last = keys[i]
        if held:
            yield solve(*(np.array([x[j] for x in held]) for j in range(4)), [x[4] for x in held])

    return run


def _kept(length: int, extra: list[str], texts: bool):
    """doc_id, digest columns and what remains (bytes, or with ``texts`` the whole characters among them) of rows (doc_id, text[, marks])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2)
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                ver = arrays.Rolling(buf).of(off[:-1], off[1:]).view(np.int64)
                size = np.diff(off)
                removed, spans, left = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64), []
                for i in range(b - a):
                    text = buf[off[i] : off[i + 1]]
                    own = marks[a + i]
                    if own.is_valid and len(own.values):
                        v, at, n = (own.values.field(j).to_numpy(zero_copy_only=False) for j in range(3))
                        mine = v == ver[i]
                        turn = np.zeros(len(text) + 1, np.int64)
                        np.add.at(turn, at[mine], 1)
                        np.add.at(turn, at[mine] + n[mine] + length - 1, -1)
                        out = np.cumsum(turn[:-1]) > 0
                        removed[i] = out.sum()
                        spans[i] = np.count_nonzero(out & ~np.r_[False, out[:-1]])
                        text = text[~out]
                    left.append(text.tobytes())
                sha = [hashlib.sha256(x).hexdigest() for x in left]
                whole = pa.array([x.decode("utf-8", "ignore") for x in left], pa.string()) if texts else pa.array(left, pa.binary())
                same = [batch.column(j).slice(a, b - a) for j in (0, *range(3, 3 + len(extra)))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(size), pa.array(removed), pa.array(spans), pa.array(sha), whole], ["doc_id", *extra, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def suffix_dedup(docs: DataFrame, length: int = 100, carry: list[str] | None = None, hot_snippets: int = HOT, texts: bool = False, recurse: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).

    Every byte is removed that a ``length``-byte string covers which also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one.  Strings are judged on the input.  A cut may fall inside a
    character, so ``kept`` is binary; with ``texts`` it is a string of the characters that are left whole.  With
    ``recurse`` reduced texts of any alphabet are induced by recursion, which gives the same result and takes three times as
    long; without it those of many symbols are sorted by doubling.  ``carry`` names further columns of ``docs`` to return.

    Null texts are empty: 0 bytes and the digest of no bytes.  A null doc_id counts as larger than all others.
    Rows that repeat both doc_id and text are one document and get equal results; rows that repeat a doc_id
    with another text are documents of their own, in order of a hash of the text.  There are no other ties: of equal
    strings the first in (doc_id, place) stays.  A text is hashed in one piece, in memory of some 90 times its size.  Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    carry = [c for c in carry or [] if c not in ("doc_id", "text")]
    more = [F.col(c).alias(f"carry{i}") for i, c in enumerate(carry)]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
    extra = docs.columns[2:]
    full, docs = docs, docs.select("doc_id", "text")
    parts = shared.parts(spark)
    buckets = parts
    schema = "doc long, ver long, at long, n long, key long, hot boolean"
    marks = shared.save(_collect(docs, length, buckets).repartitionById(parts, "bucket").mapInArrow(arrays.lean(_judge(hot_snippets)), schema), "marks")
    known = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "text")
    want = marks.filter(F.col("key").isNotNull())
    first = shared.maybe(known, shared.bloom(want.select(F.col("doc").alias("id"))))
    lists = want.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("ver", "at", "n", "key", "hot")).alias("want"))
    bits = first.dropDuplicates(["doc_id", "text"]).join(lists, "doc_id").select("doc_id", "text", "want").mapInArrow(arrays.lean(_fetch(length)), "key long, hot boolean, doc long, ver long, at long, bytes binary")
    shards = bits.repartition(parts, "key").sortWithinPartitions("key")
    found = shared.save(shards.mapInArrow(arrays.lean(_shards(length, recurse)), "doc long, ver long, at long, n long, one long, two long"), "found")
    hot = found.filter(F.col("one").isNotNull())
    place = F.struct("doc", "ver", "at")
    best = hot.groupBy("one", "two").agg(F.min(place).alias("best"))
    later = hot.join(best, ["one", "two"]).filter(F.col("best") != place)
    columns = ["doc", "ver", "at", "n"]
    gone = marks.filter(F.col("key").isNull()).select(*columns).union(found.filter(F.col("one").isNull()).select(*columns)).union(later.select(*columns))
    gone = shared.save(gone, "gone")
    shared.forget(marks)
    shared.forget(found)
    held = shared.bloom(gone.select(F.col("doc").alias("id")))
    lists = gone.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("ver", "at", "n")).alias("marks"))
    known = full.withColumn("doc_id", F.coalesce("doc_id", F.lit(_LAST)))
    out = known.select("doc_id", *extra).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "string" if texts else "binary")):
        out = out.add(name, kind)
    cut = shared.maybe(known, held, columns=extra).join(lists, "doc_id", "left").select("doc_id", "text", "marks", *extra).mapInArrow(arrays.lean(_kept(length, extra, texts)), out)
    none = known.withColumn("marks", F.lit(None).cast("array<struct<ver:long,at:long,n:long>>"))
    whole = shared.maybe(none, held, wanted=False, columns=["marks", *extra], run=arrays.lean(_kept(length, extra, texts)), schema=out)
    both = cut.union(whole)
    return both.select(F.when(F.col("doc_id") != _LAST, F.col("doc_id")).alias("doc_id"), *(F.col(f"carry{i}").alias(c) for i, c in enumerate(carry)), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
