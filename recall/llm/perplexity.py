"""Quality rules: base counts, then n-gram perplexity under a modified Kneser-Ney model.

The n-grams are of characters.  A symbol is a code point: the most frequent ones of the corpus have a number of their own,
all others share ``RARE`` classes by script block, so an n-gram of ``ORDER`` symbols is an exact number of 60 bits.  All
texts are counted by Spark: each task sorts and adds up its own n-grams, and the sums meet in one aggregation that is dealt by
context.  Continuation counts, counts of counts and the totals of contexts are aggregations of that table.

Every language has a model of its own with all its n-grams; those counted less than ``LEAST`` get what their context leaves
to lower orders.  The interpolated probability of each n-gram is worked out by joins from the lowest order up.  As all texts
are counted, the n-grams of a text are all in the table of the highest order, so a text needs one look-up for each of its
n-grams.  The most frequent ``ENTRIES`` of that table are sent to every task, in sorted hash arrays that are probed through
an index of the leading bits; the n-grams of texts that are not among them meet the rest of the table in a join.

The mean log probability of a text gives its perplexity.  For each language the quartiles over all texts that pass the
base rules set a lower and an upper fence (``FENCE`` interquartile ranges away); texts outside are rejected: above are
garbled ones, below those that repeat themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays, shared

BITS, ORDER = 12, 5
SYMBOLS, RARE = 1 << BITS, 64
#: N-grams whose log probabilities are sent to every task (12 bytes each, and an index of 4 to 8); the others are joined.
ENTRIES = 2_000_000
#: Least counts of n-grams with a probability of their own: what a single text has once must not vouch for that text.
LEAST = {1: 1, 2: 1, 3: 2, 4: 2, 5: 2}
#: Languages up to whose number a row for each is sent to every task; with more, Spark chooses the join.
FEW = 100_000
#: Steps of log2 probabilities in a bit: sums of whole numbers are exact, in any order.
UNIT = 1 << 16
#: N-grams in a row of those that wait for the join.
TOGETHER = 1 << 16
#: Distinct n-grams that a task holds before it passes them on (16 bytes each), whatever the number of languages.
HELD = 1_500_000
#: Interquartile ranges between the quartiles and the fences.
FENCE = 3.0
MIN_WORDS = 20
#: Characters at which a text's mean varies so much by its shortness that the fences stand 1.4 times as far off.
SHORT = 400.0
#: Steps of the histogram of log2 perplexity.
STEP = 1e-3

_MARKS = np.zeros(256, bool)
_MARKS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places and values of the characters of valid UTF-8."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at].astype(np.uint32)
    wide = np.flatnonzero(lead >= 0xC0)
    room = np.concatenate([buf, np.zeros(4, np.uint8)])
    a = lead[wide]
    more = [room[at[wide] + j].astype(np.uint32) & 0x3F for j in (1, 2, 3)]
    two = (a & 0x1F) << 6 | more[0]
    three = (a & 0x0F) << 12 | more[0] << 6 | more[1]
    four = (a & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]
    lead[wide] = np.where(a < 0xE0, two, np.where(a < 0xF0, three, four))
    return at, lead


def _points(docs: DataFrame) -> np.ndarray:
    """The symbol of each code point, from the code points of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for _, _, buf, _ in arrays.text_pieces(batch, "text"):
                low = np.bincount(buf, minlength=128)[:128]
                total[:128] += low
                if low.sum() < len(buf):
                    got = np.bincount(code_points(buf[_wide(buf)])[1])
                    total[: len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["point", "c"])

    got = docs.select("text").mapInArrow(arrays.lean(run), "point int, c long").groupBy("point").agg(F.sum("c").alias("c"))
    return symbol_table([r["point"] for r in got.orderBy(F.desc("c"), "point").limit(SYMBOLS - RARE).collect()])


def _wide(buf: np.ndarray) -> np.ndarray:
    """Where the bytes are that are not ASCII."""
    return buf >= 0x80


def symbol_table(frequent: list[int]) -> np.ndarray:
    """Numbers of the frequent code points in their order; the others by a hash of their block of 256; white space as a blank."""
    out = SYMBOLS - RARE + (np.arange(0x110000) >> 8) * 2654435761 % 2**32 % RARE
    out[frequent] = np.arange(len(frequent))
    out[9:14] = out[32]
    return out.astype(np.uint16)


def _grams(buf: np.ndarray, off: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams, and the row of each."""
    at, points = code_points(buf)
    own = symbol[points].astype(np.uint64)
    first = np.searchsorted(at, off)
    size = np.maximum(0, np.diff(first) - ORDER + 1)
    key = np.zeros(max(0, len(own) - ORDER + 1), np.uint64)
    for j in range(ORDER):
        key <<= np.uint64(BITS)
        key |= own[j : j + len(key)]
    if len(size) > 1:
        key = key[arrays.ragged(first[:-1], size)]
    return key, np.repeat(np.arange(len(size)), size)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    return key[head], np.add.reduceat(c[order], head) if len(head) else c


def _counted(docs: DataFrame, symbol) -> DataFrame:
    """(model, gram, c) of all texts, the n-grams of one context in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                key, c = parts[0] if len(parts) == 1 else _added(parts)
                for i in range(0, len(key), 1 << 17):
                    k = key[i : i + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), name)), pa.array(k.view(np.int64)), pa.array(c[i : i + (1 << 17)])], ["model", "gram", "c"])
            held.clear()

        size = 0
        for batch in batches:
            models = batch.column(1).to_numpy()
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                key, row = _grams(buf, off, symbol.value)
                names, of = np.unique(models[a:b], return_inverse=True)
                if len(names) > 1:
                    of = of[row]
                    key = key[np.argsort(of.astype(np.uint16) if len(names) < 1 << 16 else of, kind="stable")]
                    stop = np.cumsum(np.bincount(of, minlength=len(names)))
                else:
                    stop = np.array([len(key)])
                for name, i, j in zip(names.tolist(), np.r_[0, stop[:-1]].tolist(), stop.tolist(), strict=True):
                    mine = np.sort(key[i:j])
                    head = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]][: len(mine)])
                    held.setdefault(name, []).append((mine[head], np.diff(np.r_[head, len(mine)])))
                    size += len(head)
                if size > HELD:
                    held = {name: [_added(parts)] for name, parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        yield from flush()
                        size = 0
        yield from flush()

    parts = docs.select("text", "model").mapInArrow(arrays.lean(run), "model long, gram long, c long").withColumn("ctx", F.shiftright("gram", BITS))
    return parts.repartition(shared.parts(docs.sparkSession), "model", "ctx").groupBy("model", "ctx", "gram").agg(F.sum("c").alias("c")).select("model", "gram", "c")


def _discounts(level: DataFrame) -> DataFrame:
    """(model, d1, d2, d3): discounts for counts 1, 2 and 3 or more, from the numbers of n-grams with counts 1 to 4."""
    n = {i: F.col(f"n{i}") for i in range(1, 5)}
    y = n[1] / (n[1] + 2 * n[2])
    some = F.least(*n.values()) > 0
    raw = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
    cut = [F.when(some, F.greatest(F.lit(lo), F.least(F.lit(hi), x))).otherwise(F.lit(plain)) for x, lo, hi, plain in zip(raw, (0.05, 0.1, 0.15), (0.95, 1.9, 2.85), (0.5, 1.0, 1.5), strict=True)]
    counts = level.groupBy("model").agg(*(F.count_if(F.col("c") == i).alias(f"n{i}") for i in n))
    return counts.select("model", *(x.alias(f"d{i}") for i, x in enumerate(cut, 1)))


class Table:
    """A sorted array of 64-bit hashes with a value each, probed through an index of the leading bits."""

    def __init__(self, h: np.ndarray, value: np.ndarray):
        order = np.argsort(h)
        self.h, self.value = h[order], value[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, min(24, len(h).bit_length())))
        self.begin = np.searchsorted(self.h >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)).astype(np.int32)

    def get(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is known, and its value."""
        hit, value = np.zeros(len(h), bool), np.zeros(len(h), np.float32)
        top = (h >> self.shift).astype(np.int64)
        at, stop = self.begin[top], self.begin[top + 1]
        todo = np.flatnonzero(at < stop)
        at, stop, want = at[todo], stop[todo], h[todo]
        while len(todo):
            same = self.h[at] == want
            hit[todo[same]], value[todo[same]] = True, self.value[at[same]]
            at = at + 1
            rest = np.flatnonzero(~same & (at < stop))
            todo, at, stop, want = todo[rest], at[rest], stop[rest], want[rest]
        return hit, value


class Models:
    """Interpolated modified Kneser-Ney models in memory, pruned ones too, built from the lowest order up.

    For corpora whose n-grams fit; the operator has the same probabilities from joins (``_probabilities``).
    """

    def __init__(self, names: list[str]):
        self.names = {x: i for i, x in enumerate(names)}
        self.single = np.full((max(1, len(names)), SYMBOLS), -float(BITS), np.float32)
        self.seen: dict[int, Table] = {}
        self.back: dict[int, Table] = {}

    @staticmethod
    def _hash(order: int, model: np.ndarray, gram: np.ndarray) -> np.ndarray:
        return arrays.mix(gram ^ (model.astype(np.uint64) + np.uint64(1 + 1000 * order)) * np.uint64(0x9E3779B97F4A7C15))

    def add(self, order: int, model: np.ndarray, gram: np.ndarray, c: np.ndarray, ctx_model: np.ndarray, ctx: np.ndarray, total: np.ndarray, cut: np.ndarray) -> None:
        """The n-grams of one order with their counts, their contexts with totals, and the discounts of each model."""
        by = Table(self._hash(0, ctx_model, ctx), np.zeros(len(ctx)))
        place = np.searchsorted(by.h, self._hash(0, model, gram >> np.uint64(BITS)))  # the context of each n-gram
        sums = np.zeros(len(ctx))
        sums[np.searchsorted(by.h, self._hash(0, ctx_model, ctx))] = total
        own = (c - cut[model, np.minimum(c, 3)]) / sums[place]
        weight = np.maximum(1 - np.bincount(place, weights=own, minlength=len(ctx)), 1e-12)
        p = own + weight[place] * (1 / SYMBOLS if order == 1 else 2.0 ** self.logp(order - 1, model, gram).astype(float))
        if order == 1:
            left = np.log2(weight / SYMBOLS)
            for i, m in zip(np.searchsorted(by.h, self._hash(0, ctx_model, ctx)).tolist(), ctx_model.tolist(), strict=True):
                self.single[m] = left[i]
            self.single[model, gram.astype(np.int64)] = np.log2(p)
            return
        self.seen[order] = Table(self._hash(order, model, gram), np.log2(p))
        at = np.searchsorted(by.h, self._hash(0, ctx_model, ctx))
        self.back[order] = Table(self._hash(order, ctx_model, ctx), np.log2(weight[at]))

    def logp(self, order: int, model: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """log2 probability of the last symbol of each n-gram after the ones before."""
        gram = gram & np.uint64((1 << BITS * order) - 1)
        if order == 1:
            return self.single[model, gram.astype(np.int64)]
        if order not in self.seen:
            return self.logp(order - 1, model, gram)
        hit, out = self.seen[order].get(self._hash(order, model, gram))
        miss = np.flatnonzero(~hit)
        if len(miss):
            m, g = model[miss], gram[miss]
            _, weight = self.back[order].get(self._hash(order, m, g >> np.uint64(BITS)))  # an unknown context passes all its mass down
            out[miss] = weight + self.logp(order - 1, m, g)
        return out


def _for_each(df: DataFrame, few: bool) -> DataFrame:
    """A table with a row for each language, as the other side of a join."""
    return F.broadcast(df) if few else df


def _probabilities(grams: DataFrame, few: bool) -> DataFrame:
    """(model, gram, c, v) of all n-grams of the highest order; v is -log2 of the interpolated probability in ``UNIT`` steps."""
    levels = {ORDER: grams}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: different symbols before each shorter n-gram
        shorter = levels[n + 1].groupBy("model", F.col("gram").bitwiseAND((1 << BITS * n) - 1).alias("gram")).agg(F.count("*").alias("c"))
        levels[n] = shared.save(shorter, f"grams{n}")
    lower = None
    for n in range(1, ORDER + 1):
        ctx = Window.partitionBy("model", F.shiftright("gram", BITS))
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = F.when(F.col("c") >= LEAST[n], (F.col("c") - cut) / F.col("total")).otherwise(0.0)
        rows = levels[n].withColumn("total", F.sum("c").over(ctx)).join(_for_each(_discounts(levels[n]), few), "model")
        rows = rows.select("model", "gram", "c", own.alias("own")).withColumn("weight", F.greatest(1 - F.sum("own").over(ctx), F.lit(1e-12)))
        if lower is None:
            rows = rows.withColumn("below", F.lit(1 / SYMBOLS))
        else:
            rows = rows.withColumn("low", F.col("gram").bitwiseAND((1 << BITS * (n - 1)) - 1)).join(lower, ["model", "low"])
        rows = rows.select("model", "gram", "c", (F.col("own") + F.col("weight") * F.col("below")).alias("p"))
        lower = rows.select("model", F.col("gram").alias("low"), F.col("p").alias("below"))
    out = shared.save(rows.select("model", "gram", "c", F.round(-F.log2("p") * UNIT).cast("int").alias("v")), "probabilities")
    for n in range(1, ORDER):
        shared.forget(levels[n])
    return out


def _key(model: np.ndarray, gram: np.ndarray) -> np.ndarray:
    return arrays.mix(gram.astype(np.uint64) ^ arrays.mix(model.astype(np.uint64)))


def _frequent(table: DataFrame) -> tuple[Table, DataFrame | None]:
    """The most frequent n-grams of the table, all that have one count or none of them, and the rest of it, if there is one."""
    step = F.when(F.col("c") < 64, F.col("c")).otherwise(64 + F.floor(8 * F.log2(F.col("c") / 64))).cast("int")
    sizes = {r["b"]: r["n"] for r in table.groupBy(step.alias("b")).agg(F.count("*").alias("n")).collect()}
    least = _threshold(sizes, 1, ENTRIES)
    got = table.filter(step >= least).select("model", "gram", "v").toArrow()
    known = Table(_key(got["model"].to_numpy(), got["gram"].to_numpy()), got["v"].to_numpy())
    return known, table.filter(step < least) if any(x < least for x in sizes) else None


def _threshold(sizes: dict[int, int], lowest: int, room: int) -> int:
    """The least step of counts, ``lowest`` or above, from which on all n-grams fit ``room``."""
    least = 10**6
    for step in sorted((x for x in sizes if x >= lowest), reverse=True):
        room -= sizes[step]
        if room < 0:
            break
        least = step
    return least


def _model(lang: Column) -> Column:
    """The number of a language's model, a hash; the null language has one too."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), lang), F.lit("-")))


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def _base(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts of each text."""
    n = len(off) - 1
    starts, ends, first = arrays.words(buf, off)
    count = np.diff(first)
    solid = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(~arrays.SPACE[buf] & ((buf & 0xC0) != 0x80), out=solid[1:])
    marks = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_MARKS[buf], out=marks[1:])
    out = {"n_words": count, "word_chars": np.diff(solid[off]), "n_symbols": np.diff(marks[off])}
    roll = arrays.Rolling(buf)
    breaks = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate([off[:-1], breaks + 1]))
    row = np.searchsorted(off, begin, "right") - 1
    stop = np.minimum(np.concatenate([begin[1:], [len(buf)]]), off[np.minimum(row + 1, n)])
    stop = np.maximum(begin, np.where(np.isin(stop, off), stop, stop))
    ended = np.searchsorted(breaks, begin)
    stop = np.where(ended < len(breaks), np.minimum(stop, breaks[np.minimum(ended, max(0, len(breaks) - 1))] if len(breaks) else stop), stop)
    live = solid[stop] > solid[begin]
    begin, stop, row = begin[live], stop[live], row[live]
    key = arrays.mix(roll.of(begin, stop) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=n) - np.bincount(row[at], minlength=n)
    repeated = np.zeros(n, np.int64)
    if len(starts) >= 8:
        window = arrays.window_hash(roll.of(starts, ends), 8)
        rows = np.repeat(np.arange(n), count)
        fits = np.flatnonzero(np.arange(len(window)) + 8 <= first[1:][rows[: len(window)]])
        key = arrays.mix(window[fits] + rows[fits].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = fits[order[np.r_[False, same] | np.r_[same, False]]]
        turn = np.zeros(len(starts) + 1, np.int64)
        turn[twice] += 1
        turn[twice + 8] -= 1
        covered = np.flatnonzero(np.cumsum(turn[:-1]) > 0)
        repeated = np.bincount(rows[covered], minlength=n)
    out["n_repeat_words"] = repeated
    return out


_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _scored(docs: DataFrame, known, symbol) -> DataFrame:
    """A row for each text: an id, the base counts, the number of its n-grams and the sum of those known; and rows of the
    n-grams that are not (id, model, rest)."""
    together = TOGETHER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            models = batch.column(1).to_numpy()
            salt = arrays.mix(models.astype(np.uint64))
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                base = _base(buf, off)
                key, row = _grams(buf, off, symbol.value)
                sums = np.zeros(b - a)
                rest = []
                for i in range(0, len(key), 1 << 18):
                    s = slice(i, i + (1 << 18))
                    hit, value = known.value.get(arrays.mix(key[s] ^ salt[a:b][row[s]]))
                    sums += _per_row(value, row[s], b - a)
                    if not hit.all():
                        rest.append(i + np.flatnonzero(~hit))
                ids = np.arange(first, first + b - a)
                first += b - a
                counts = [pa.array(base[c].astype(np.int64)) for c in _COLUMNS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), batch.column(2).slice(a, b - a), pa.array(models[a:b]), *counts, pa.array(np.bincount(row, minlength=b - a)), pa.array(sums.astype(np.int64)), pa.nulls(b - a, pa.list_(pa.int64()))],
                    names,
                )
                if rest:
                    at = np.concatenate(rest)
                    begin = np.union1d(np.flatnonzero(np.r_[True, row[at][1:] != row[at][:-1]]), np.arange(0, len(at), together))
                    for i in range(0, len(begin), 1024):
                        part = np.r_[begin, len(at)][i : i + 1025]
                        own = row[at[part[:-1]]]
                        lists = pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(key[at[part[0] : part[-1]]].view(np.int64)))
                        none = [pa.nulls(len(own), pa.int64())] * (len(_COLUMNS) + 2)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), none[0], pa.array(models[a:b][own]), *none, lists], names)

    names = ["id", "doc_id", "model", *_COLUMNS, "grams", "v", "rest"]
    schema = ", ".join(f"{c} long" for c in names[:-1]) + ", rest array<long>"
    return docs.select("text", "model", "doc_id").mapInArrow(arrays.lean(run), schema)


def _fences(scored: DataFrame) -> DataFrame:
    """(model, low, high): fences of the bits per symbol of each model, from exact histograms over all texts that pass the base rules."""
    bins = scored.filter(~F.col("base_failed") & F.col("bits").isNotNull()).groupBy("model", F.floor(F.col("bits") / STEP).alias("b")).agg(F.count("*").alias("n"))
    every = Window.partitionBy("model")
    bins = bins.withColumn("up_to", F.sum("n").over(every.orderBy("b"))).withColumn("all", F.sum("n").over(every))
    quartile = lambda q: F.min(F.when(F.col("up_to") >= q * F.col("all"), F.col("b"))) * F.lit(STEP)
    at = bins.groupBy("model").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(0.02))
    return at.select("model", (F.col("q1") - FENCE * spread).alias("low"), (F.col("q3") + FENCE * spread).alias("high"))


def perplexity_filter(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, five base counts, base_failed, perplexity, kept.

    Words are ``[^\\x20\\x09-\\x0D]+``.  n_repeat_words counts the words that lie in an 8-word window which the text
    has twice or more.  base_failed: under 20 words, or over 30 % repeated words.  kept: base rules passed and
    perplexity (per character) inside the band of the text's language, its fences included.

    Null texts have no words and fail the base rules.  A null language and an empty one are languages of their own; every
    language has its own model and fences, so one of very few texts is judged by these alone.
    Texts of fewer than 5 characters have no perplexity (null).  Repeated rows get equal results; they do count in the
    model.  A text is read in one piece, in memory of some 60 times its size.  Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _model(F.col("lang").cast("string")).alias("model"))
    symbol = spark.sparkContext.broadcast(_points(docs))
    grams = shared.save(_counted(docs, symbol), "grams")
    few = grams.select("model").distinct().count() <= FEW
    table = _probabilities(grams, few)
    shared.forget(grams)
    frequent, rest = _frequent(table)
    known = spark.sparkContext.broadcast(frequent)
    rows = shared.save(_scored(docs, known, symbol), "scored")
    known.destroy()
    symbol.destroy()
    scored = rows.filter(F.col("rest").isNull()).drop("rest")
    if rest is not None:
        met = rows.filter(F.col("rest").isNotNull()).select("id", "model", F.explode("rest").alias("gram")).join(rest.select("model", "gram", "v"), ["model", "gram"])
        sums = shared.save(met.groupBy("id").agg(F.sum("v").alias("more")), "sums")
        scored = scored.join(sums, "id", "left").withColumn("v", F.col("v") + F.coalesce("more", F.lit(0)))
    shared.forget(table)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    bits = F.when(F.col("grams") > 0, F.col("v") / UNIT / F.col("grams"))
    scored = scored.select("doc_id", "model", *_COLUMNS, failed.alias("base_failed"), bits.alias("bits"))
    fences = shared.save(_fences(scored), "fences")
    slack = (F.col("high") - F.col("low")) / (2 * FENCE + 1) * FENCE * (F.sqrt(1 + SHORT / F.greatest("word_chars", F.lit(1))) - 1)
    inside = F.col("bits").between(F.col("low") - slack, F.col("high") + slack)
    judged = scored.join(_for_each(fences, few), "model", "left")
    return judged.select("doc_id", *_COLUMNS, "base_failed", F.pow(F.lit(2.0), "bits").alias("perplexity"), (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
