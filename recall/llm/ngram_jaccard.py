"""N-gram Jaccard join by vertical partitioning of the global shingle order.

Shingles have one global order: rare ones first (by a power-of-two class of their frequency), then by hash.
A set of ``n`` shingles that overlaps another one enough must share one of its first ``n - ceil(t n) + 1``
shingles with it (prefix filter), whichever order is used, so no link is lost.  The order is cut into
fragments; a fragment holds the prefix parts that fall into it, finds the shingles that two sets share and
passes only those on.  Overlaps are counted apart in each fragment and summed for each pair, first over the
prefixes (an upper bound of the whole overlap follows and drops most pairs), then over fragments of the whole
sets (the exact overlap).

Large groups.  A shingle of very many sets is known as such from the counts behind the order; its entries are spread by
set instead of meeting in the task of its fragment.  Documents with equal sets are one node.  In a large bucket of one shingle every member is first
compared with the few it shares most with, so a group of m near copies costs a multiple of m comparisons; once
members are known to be connected no pair of them is made.  Only pairs that cross components are then compared,
and all of those are, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, shared
from .shared import components

#: Size of the table of frequent shingles that all tasks hold (12 bytes each); it only shapes the order.
FREQUENT = 400_000
#: Frequency class (a power of two) from which on a shingle's entries don't meet in the task of their fragment.
HOT = 10
#: Pairs of a member that are tried before all of them are.
TOP = 3
#: Shingles of a set, on average, in one fragment when whole sets are compared (rounded up to a power-of-two number).
PART = 1024
#: Members of a bucket up to which its pairs are listed; those of larger ones are compared in place.
SMALL = 48
#: Members of a bucket that one task compares at a time.
CELL = 2000
#: Prefix shingles that one task joins before it passes them on (20 bytes each).
HELD = 500_000
#: Shingles that one task counts at a time before it passes on the repeated ones.
COUNTED = 1_500_000


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of n with any set it may be linked with."""
    return (n * percent + 99) // 100


def _frequent(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and frequency class of the most frequent shingles of the whole corpus."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often(values: list[np.ndarray]) -> pa.RecordBatch:
            value = np.sort(np.concatenate(values))
            at = np.flatnonzero(np.r_[True, value[1:] != value[:-1]][: len(value)])
            count = np.diff(np.r_[at, len(value)])
            keep = count >= 3
            return pa.RecordBatch.from_arrays([pa.array(value[at[keep]].view(np.int64)), pa.array(count[keep].astype(np.int64))], ["h", "c"])

        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, buf, off in arrays.text_pieces(batch, "text"):
                low = arrays.LOWER[buf]
                starts, ends, _ = arrays.words(low, off)
                held.append(arrays.window_hash(arrays.Rolling(low).of(starts, ends), k))
                if sum(map(len, held)) > COUNTED:
                    yield often(held)
                    held = []
        if held:
            yield often(held)

    counts = shared.save(docs.select("text").mapInArrow(arrays.lean(repeated), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "frequent")
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r["l"]: r["n"] for r in counts.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()}
    least, room = 99, FREQUENT
    for l in sorted(sizes, reverse=True):
        room -= sizes[l]
        if room < 0:
            break
        least = l
    got = counts.filter(level >= least).select("h", level.alias("l")).toArrow()
    shared.forget(counts)
    h, l = got["h"].to_numpy().view(np.uint64), got["l"].to_numpy().astype(np.uint64)
    order = np.argsort(h)
    return h[order], l[order]


def _ordered(buf: np.ndarray, off: np.ndarray, k: int, h: np.ndarray, l: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the global order and hash of each text's distinct shingles, sorted by row and order."""
    row, value = arrays.shingle_sets(buf, off, k)
    place = value >> np.uint64(6)
    if len(h) and len(value):
        at = np.minimum(np.searchsorted(h, value), len(h) - 1)
        hit = np.flatnonzero(h[at] == value)
        place[hit] |= (l[at[hit]] + np.uint64(1)) << np.uint64(58)
        if len(hit):
            order = np.lexsort((place, row))
            row, place, value = row[order], place[order], value[order]
    return row, place, value


def _signature(value: np.ndarray, n: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(n), np.uint64)
    live = np.flatnonzero(n)
    if len(live):
        out[live] = np.add.reduceat(arrays.mix(value), first[live])
    return arrays.mix(out + n.astype(np.uint64)).view(np.int64)


#: Lists of documents' rows, and of the entries of hot shingles, that parts of the input send along.
_LISTS = ["ids", "keys", "ns", "sigs", "tokens", "owners", "sizes"]
_ENTRY = np.dtype([("sig", "<i8"), ("n", "<u4"), ("cnt", "<u4")])


def _prefixes(docs: DataFrame, k: int, percent: int, fragments: int, freq) -> DataFrame:
    """Per part of the input and fragment, the prefix parts of its sets; and (doc_id, hash of the text, n, signature) of all rows."""

    def flush(held: list[tuple], rows: list[tuple]) -> pa.RecordBatch:
        frag, token, sig, n, often = (np.concatenate(x) for x in zip(*held, strict=True))
        # entries of hot shingles, each set once, pass by the fragments; their tokens are no other shingle's
        spread = (1 << 62) + (frag[often].astype(np.int64) << 32) + token[often], sig[often], n[often].astype(np.int64)
        by = np.lexsort((spread[1], spread[0]))
        by = by[np.r_[True, (spread[0][by][1:] != spread[0][by][:-1]) | (spread[1][by][1:] != spread[1][by][:-1])][: len(by)]]
        spread = tuple(x[by] for x in spread)
        frag, token, sig, n = (x[~often] for x in (frag, token, sig, n))
        order = np.argsort(frag, kind="stable")
        cut = np.searchsorted(frag[order], np.arange(fragments + 1))
        keys, blobs = [], []
        for f in np.flatnonzero(np.diff(cut)).tolist():
            o = order[cut[f] : cut[f + 1]]
            own = sig[o]
            s = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            head = np.zeros(len(s), _ENTRY)
            head["sig"], head["n"], head["cnt"] = own[s], n[o[s]], np.diff(np.r_[s, len(o)])
            keys.append(f)
            blobs.append(np.uint32(len(s)).tobytes() + head.tobytes() + token[o].tobytes())
        ids, own = (pa.concat_arrays([x[i] for x in rows]) for i in (0, 1))
        ns, sigs = (np.concatenate([x[i] for x in rows]) for i in (2, 3))
        none = pa.nulls(len(keys), pa.list_(pa.int64()))
        last = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(x, pa.int64())) for x in (ids, own, ns, sigs)]
        last += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in spread]
        where = int(abs(int(sigs[0])) % fragments)
        return pa.RecordBatch.from_arrays([pa.array([*keys, where], pa.int32()), pa.array([*blobs, None], pa.binary()), *(pa.concat_arrays([none, x]) for x in last)], ["frag", "prefix", *_LISTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, l = freq.value
        held: list[tuple] = []
        rows: list[tuple] = []
        for batch in batches:
            ids, own = batch.column(0), batch.column(2)
            for a, b, buf, off in arrays.text_pieces(batch, "text", 2 * arrays.PIECE_BYTES):
                row, place, value = _ordered(buf, off, k, h, l)
                n = np.bincount(row, minlength=b - a).astype(np.int64)
                first = np.cumsum(n) - n
                sig = _signature(value, n, first)
                one = np.zeros(b - a, bool)
                one[np.unique(sig, return_index=True)[1]] = True
                null = np.asarray(ids.slice(a, b - a).is_null())
                take = np.where(one & (n > 0) & ~null, n - _need(n, percent) + 1, 0)
                if null.any():  # a copy with an id must not hide behind one without
                    for s in np.unique(sig[null]):
                        same = np.flatnonzero((sig == s) & ~null)[:1]
                        take[same] = np.where(n[same] > 0, n[same] - _need(n[same], percent) + 1, 0)
                at = arrays.ragged(first, take)
                key = (place[at] & np.uint64((1 << 58) - 1)) >> np.uint64(58 - 32)
                frag = ((key * np.uint64(fragments)) >> np.uint64(32)).astype(np.int32)
                mine = np.repeat(np.arange(b - a), take)
                often = (place[at] >> np.uint64(58)) > HOT
                held.append((frag, (place[at] & np.uint64(0xFFFFFFFF)).astype("<u4"), sig[mine], n[mine].astype(np.uint32), often))
                rows.append((ids.slice(a, b - a), own.slice(a, b - a), n, sig))
                if sum(len(x[0]) for x in held) > HELD:
                    yield flush(held, rows)
                    held, rows = [], []
        if rows:
            yield flush(held, rows)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    return rows.mapInArrow(arrays.lean(run), "frag int, prefix binary, " + ", ".join(f"{x} array<long>" for x in _LISTS))


def _shared_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In one fragment: the shingles that two or more different sets have, with the number m of these; documents' rows pass through."""
    heads: dict[int, list] = {}
    names = ["doc_id", "key", "sig", "n", "token", "often", "m"]
    for batch in batches:
        for frag, blob, ids, keys, ns, sigs, tokens, owners, sizes in zip(*(batch.column(i) for i in range(9)), strict=True):
            if blob.is_valid:
                raw = blob.as_buffer()
                m = int(np.frombuffer(raw, "<u4", 1)[0])
                head = np.frombuffer(raw, _ENTRY, m, 4)
                token = np.frombuffer(raw, "<u4", -1, 4 + m * _ENTRY.itemsize)
                heads.setdefault(frag.as_py(), []).append((head, token))
            else:
                yield pa.RecordBatch.from_arrays([ids.values, keys.values, sigs.values, ns.values, pa.nulls(len(ids.values), pa.int64()), pa.array(np.zeros(len(ids.values), bool)), pa.nulls(len(ids.values), pa.int64())], names)
                if len(tokens.values):
                    none = pa.nulls(len(tokens.values), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, none, owners.values, sizes.values, tokens.values, pa.array(np.ones(len(none), bool)), none], names)
    for frag, got in heads.items():
        head = np.concatenate([x for x, _ in got])
        token = np.concatenate([x for _, x in got])
        who = np.repeat(np.arange(len(head), dtype=np.int64), head["cnt"])
        sig = head["sig"][who]
        order = np.lexsort((sig, token))
        token, sig, n = token[order], sig[order], head["n"][who[order]]
        new = np.r_[True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])]
        token, sig, n = token[new], sig[new], n[new]
        same = np.r_[False, token[1:] == token[:-1]]
        keep = same | np.r_[same[1:], False]
        token, sig, n = token[keep], sig[keep], n[keep]
        _, at, m = np.unique(token, return_inverse=True, return_counts=True)
        m = m[at]
        for i in range(0, len(token), 1 << 17):
            s = slice(i, i + (1 << 17))
            none = pa.nulls(len(sig[s]), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(sig[s]), pa.array(n[s].astype(np.int64)), pa.array(token[s].astype(np.int64) + (frag << 32)), pa.array(np.zeros(len(none), bool)), pa.array(m[s].astype(np.int64))], names)


def _level(n: int, part: int) -> int:
    return ((n - 1) // part).bit_length()


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) of signatures whose exact overlap, summed over fragments, reaches the threshold.

    A pair is cut into 2**level fragments, by the size of its larger set; a set is held at the levels that its
    possible partners ask for, which are one or two.
    """
    part = PART
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    ids = shared.save(nodes.join(wanted, "sig").select(F.col("least").alias("id")), "ids")
    bloom = shared.bloom(ids)
    shared.forget(ids)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                row, value = arrays.shingle_sets(buf, off, k)
                n = np.bincount(row, minlength=b - a).astype(np.int64)
                first = np.cumsum(n) - n
                sig = _signature(value, n, first)
                seen: set[int] = set()
                sigs, frags, blobs = [], [], []
                for i in np.flatnonzero(n):
                    if int(sig[i]) in seen:
                        continue
                    seen.add(int(sig[i]))
                    own, size = value[first[i] : first[i] + n[i]], int(n[i])
                    for level in {_level(size, part), _level(size * 100 // percent + 1, part)}:
                        cut = np.searchsorted(own >> np.uint64(64 - level) if level else np.zeros(size, np.uint64), np.arange((1 << level) + 1, dtype=np.uint64))
                        for f in range(1 << level):
                            if cut[f] < cut[f + 1]:
                                sigs.append(int(sig[i]))
                                frags.append((level << 26) + f)
                                blobs.append(own[cut[f] : cut[f + 1]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(frags, pa.int32()), pa.array(blobs, pa.binary())], ["sig", "frag", "part"])

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True)) for x, y in zip(batch.column(4), batch.column(5), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int64())], ["a", "b", "na", "nb", "part"])

    parts = shared.maybe(docs.filter(F.col("doc_id").isNotNull()), bloom, run=arrays.lean(segments), schema="sig long, frag int, part binary")
    parts = parts.join(wanted, "sig").dropDuplicates(["sig", "frag"])
    parts = shared.save(parts, "segments")
    bloom.destroy()
    over = F.floor((F.greatest("na", "nb") - 1) / part).cast("long")
    level = F.when(over > 0, F.length(F.bin(over))).otherwise(0)
    split = pairs.withColumn("level", level).selectExpr("a", "b", "na", "nb", "explode(sequence(shiftleft(level, 26), shiftleft(level, 26) + shiftleft(1, level) - 1)) AS frag")
    left = parts.select(F.col("sig").alias("a"), "frag", F.col("part").alias("pa"))
    right = parts.select(F.col("sig").alias("b"), "frag", F.col("part").alias("pb"))
    met = split.join(left, ["a", "frag"]).join(right, ["b", "frag"]).select("a", "b", "na", "nb", "pa", "pb")
    total = met.mapInArrow(arrays.lean(overlaps), "a long, b long, na long, nb long, part long").groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("o"))
    out = shared.save(total.filter(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b", "na", "nb"), "links")
    shared.forget(parts)
    return out


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, c: shared prefix shingles) that can still reach the threshold."""
    need = lambda x: F.ceil(F.col(x) * percent / 100)
    alpha = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent) - F.lit(1e-9))
    fits = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    return pairs.filter(fits & (F.col("c") + F.greatest(need("na"), need("nb")) - 1 >= alpha))


def _across(live: DataFrame, percent: int, top: int | None = None) -> DataFrame:
    """All pairs (a, b, na, nb, c) of different components that share enough prefix shingles to be possible links.

    ``live`` holds every shingle that two components share.  Pairs in small buckets are listed there.  A row of a large
    bucket takes along its shingles in large buckets, so the common ones of two members are counted where they
    meet, and a pair is passed on only in the bucket of its least common shingle, and only if it can be a link
    whatever it shares in small buckets.  With ``top``, of each member only its ``top`` pairs with the most common
    shingles in a large bucket.  Buckets of over ``CELL`` members are cut into cells of two blocks each.
    """
    small = F.col("m") <= SMALL
    member = F.struct("sig", "n", "comp")
    groups = live.filter(small).groupBy("token").agg(F.collect_list(member).alias("g"))  # of SMALL members at most
    fits = lambda x, y: (x["n"] * 100 >= y["n"] * percent) & (y["n"] * 100 >= x["n"] * percent)
    pair = lambda x, y: F.struct(x["sig"].alias("a"), y["sig"].alias("b"), x["n"].alias("na"), y["n"].alias("nb"))
    later = lambda x: F.filter("g", lambda y: (x["sig"] < y["sig"]) & (x["comp"] != y["comp"]) & fits(x, y))
    made = groups.select(F.explode(F.flatten(F.transform("g", lambda x: F.transform(later(x), lambda y: pair(x, y))))).alias("p"))
    joined = made.select("p.*").groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"))
    lists = live.groupBy("sig").agg(F.collect_list(F.when(~small, F.col("token"))).alias("own"), F.count(F.when(small, 1)).alias("spare"))
    blocks = F.ceil(F.col("m") / CELL).cast("int")
    block = F.pmod(F.xxhash64("sig"), blocks).cast("int")
    rows = live.filter(~small).join(lists, "sig").select("token", "sig", "n", "comp", "own", "spare", block.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("token", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "sig", "n", "comp", "own", "mine", "spare")
    rows = rows.repartition(shared.parts(live.sparkSession), "token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")

    def possible(na, nb, c):
        need = (na + nb) * percent
        alpha = -(-need // (100 + percent))
        fits = (na * 100 >= nb * percent) & (nb * 100 >= na * percent)
        return fits & (c + np.maximum(_need(na, percent), _need(nb, percent)) - 1 >= alpha)

    def compare(token, lo, hi, sig, n, comp, own, size, mine, spare):
        m = len(sig)
        who = np.repeat(np.arange(m), size)
        value, at, count = np.unique(own, return_inverse=True, return_counts=True)
        place = np.cumsum(count > 1) - 1
        keep = count[at] > 1
        value, at, who = value[count > 1], place[at[keep]], who[keep]
        common = np.zeros((m, m), np.float32)
        before = np.zeros((m, m), np.float32)
        for i in range(0, len(value), 2048):
            part = np.zeros((m, min(2048, len(value) - i)), np.float32)
            mine_ = (at >= i) & (at < i + 2048)
            part[who[mine_], at[mine_] - i] = 1
            common += part @ part.T
            early = value[i : i + 2048] < token
            if early.any():
                part = part[:, early]
                before += part @ part.T
        ok = (comp[:, None] != comp[None, :]) & (before == 0) & possible(n[:, None], n[None, :], common.astype(np.int64) + np.minimum(spare[:, None], spare[None, :]))
        if lo != hi:
            ok &= mine[:, None] != mine[None, :]
        if top and m > top:
            best = np.argpartition(np.where(ok, -common, 1), top, axis=1)[:, :top]
            near = np.zeros_like(ok)
            near[np.arange(m)[:, None], best] = True
            ok &= near | near.T
        a, b = np.nonzero(ok & (sig[:, None] < sig[None, :]))
        return sig[a], sig[b], n[a], n[b], common[a, b].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[list]:
            held: list[pa.RecordBatch] = []
            last = None
            for batch in batches:
                key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], 1)
                cut = np.flatnonzero(np.any(key[1:] != key[:-1], 1)) + 1
                for i, j in zip(np.r_[0, cut].tolist(), np.r_[cut, len(key)].tolist(), strict=True):
                    now = tuple(key[i])
                    if held and now != last:
                        yield held
                        held = []
                    held.append(batch.slice(i, j - i))
                    last = now
            if held:
                yield held

        out: list[tuple] = []
        for held in groups():
            token, lo, hi = (held[0].column(i)[0].as_py() for i in range(3))
            sig, n, comp, mine, spare = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]).astype(np.int64) for i in (3, 4, 5, 7, 8))
            if len(sig) < 2 or (comp == comp[0]).all():
                continue
            own = np.concatenate([x.column(6).flatten().to_numpy() for x in held])
            size = np.concatenate([x.column(6).value_lengths().to_numpy(zero_copy_only=False) for x in held])
            out.append(compare(token, lo, hi, sig, n, comp, own, size, mine, spare))
            if sum(len(x[0]) for x in out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["a", "b", "na", "nb", "c"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["a", "b", "na", "nb", "c"])

    met = rows.mapInArrow(arrays.lean(run), "a long, b long, na long, nb long, c long")
    return _possible(joined.union(met).groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c")), percent)


def _classes(docs: DataFrame, k: int, percent: int, fragments: int | None, rounds: int) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, key (hash of the text), n, sig (of the set), label (of its group of
    linked sets) and least (smallest doc_id of the group).  Sets without shingles and rows without doc_id are in no group."""
    spark = docs.sparkSession
    fragments = fragments or shared.parts(spark)
    freq = spark.sparkContext.broadcast(_frequent(docs, k))
    pieces = _prefixes(docs, k, percent, fragments, freq)
    found = shared.save(pieces.repartitionById(fragments, "frag").mapInArrow(arrays.lean(_shared_shingles), "doc_id long, key long, sig long, n long, token long, often boolean, m long"), "shingles")
    freq.destroy()
    rows = found.filter(F.col("token").isNull()).select("doc_id", "key", "sig", "n")
    nodes = shared.save(rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("sig").agg(F.min("doc_id").alias("least")), "nodes")
    # at first every set is a component of its own, and all sets of a shingle that isn't hot have met in its fragment
    often = found.filter("often").select("token", "sig", "n").distinct()
    often = shared.save(often.join(often.groupBy("token").agg(F.count("*").alias("m")).filter(F.col("m") > 1), "token"), "often")
    live = found.filter(F.col("token").isNotNull() & ~F.col("often")).select("token", "sig", "n", "m").union(often.select("token", "sig", "n", "m"))
    live = live.select("token", "sig", "n", F.col("sig").alias("comp"), "m", F.col("m").alias("sq"))
    labels = None
    links: list[DataFrame] = []
    tried: list[DataFrame] = []
    spent: list[DataFrame] = [often]
    for turn in range(rounds + 1):
        if turn:
            per = now.groupBy("token", "comp").agg(F.count("*").alias("s")).groupBy("token")
            per = per.agg(F.count("*").alias("comps"), F.sum("s").alias("m"), F.sum(F.col("s") * F.col("s")).alias("sq"))
            live = shared.save(now.join(per.filter(F.col("comps") > 1).select("token", "m", "sq"), "token"), "live")
            spent.append(live)
        # each of the m rows of a shingle counts its part of the pairs that cross components
        members, hard = live.agg(F.count("*"), F.sum(F.when(F.col("m") > SMALL, (F.col("m") - F.col("sq") / F.col("m")) / 2).otherwise(0))).first()
        if not members:
            break
        last = hard <= 4 * members or turn == rounds
        pairs = _across(live, percent, None if last else TOP)
        for old in tried:
            pairs = pairs.join(old.select("a", "b"), ["a", "b"], "left_anti")
        pairs = shared.save(pairs, "pairs")
        spent.append(pairs)
        if not pairs.isEmpty():
            tried.append(pairs)
            links.append(_verified(docs, nodes, pairs, k, percent))
            labels = shared.save(components(reduce(DataFrame.union, [x.select("a", "b") for x in links])), "labels")
            now = live.select("token", "sig", "n").join(labels, F.col("sig") == F.col("node"), "left").select("token", "sig", "n", F.coalesce("component", "sig").alias("comp"))
        else:
            now = live.select("token", "sig", "n", "comp")
        if last:
            break
    for table in [*spent, *links]:
        shared.forget(table)
    known = nodes.select("sig", F.col("sig").alias("label"), "least")
    if labels is not None:
        joined = nodes.join(labels, nodes["sig"] == labels["node"]).select("sig", "component", "least")
        low = joined.groupBy("component").agg(F.min("least").alias("low"))
        mapped = joined.join(low, "component").select("sig", "component", "low")
        known = nodes.join(mapped, "sig", "left").select("sig", F.coalesce("component", "sig").alias("label"), F.coalesce("low", "least").alias("least"))
    # both sides are read from tables, so that a text with very many copies can be split over tasks
    best = rows.join(shared.save(known, "known"), "sig", "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return best.select("doc_id", "key", "n", "sig", F.when(linked, F.col("label")).alias("label"), F.when(linked, F.col("least")).alias("least"))


def _texts(docs: DataFrame) -> DataFrame:
    shared.ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ngram_jaccard(docs: DataFrame, k: int = 5, percent: int = 75, fragments: int | None = None, rounds: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two texts are linked when ``100 * intersection >= percent * union`` of their sets of distinct ``k``-word
    shingles (A-Z as a-z; fewer words: the whole sequence is one shingle).  component_id is the smallest doc_id
    reachable by links, the row's own included.

    Null or word-free texts have 0 shingles, no link, and their own doc_id.  Rows without doc_id take no part
    in links and get a null component_id.  Repeated rows, and rows that repeat a doc_id with another text, each
    get the component of their own text.  A similarity of exactly ``percent`` is a link.  A text is hashed in one piece,
    in memory of some 60 times its size; its prefix and its whole set then travel in fragments.  Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    rows = _classes(_texts(docs), k, percent, fragments, rounds)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def first_of_groups(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one of each group of linked texts (see ``ngram_jaccard``).

    The one with the smallest doc_id stays; if several texts of a group have that doc_id, the one whose text has the
    smallest hash; of rows that repeat both, the least by their columns.  Rows without doc_id, or without a word, are in
    no group and stay.
    """
    columns = docs.columns
    rows = shared.save(_classes(_texts(docs), k, percent, None, 1).filter(F.col("label").isNotNull()).select("doc_id", "key", "label"), "rows")
    # a text has one label, so (doc_id, key) names the rows of one class, and no group is gathered
    first = rows.groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.*", F.lit(True).alias("stays"))
    marked = rows.groupBy("doc_id", "key").agg(F.count("*").alias("n")).join(first, ["doc_id", "key"], "left")
    out = marked.filter(F.col("stays").isNull() | (F.col("n") > 1)).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.coalesce("stays", F.lit(False)).alias("_stays"))
    out = shared.save(out, "gone")
    shared.forget(rows)
    # only rows that may be among them are moved
    held = shared.bloom(out.select(F.col("_id").alias("id")))
    own = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_key": F.xxhash64(F.col("text").cast("string"))})
    rest = [c for c in own.columns if c not in ("doc_id", "text")]
    plain = shared.maybe(own, held, wanted=False, columns=rest, key="_id").select(*columns)
    some = shared.maybe(own, held, columns=rest, key="_id").join(out, ["_id", "_key"], "left")
    kept = some.filter(F.col("_stays").isNull()).select(*columns)
    again = some.filter("_stays").groupBy("_id", "_key").agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")
    return plain.unionByName(kept).unionByName(again)
