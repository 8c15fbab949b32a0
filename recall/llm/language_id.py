"""Language identification: whole words first, then ever shorter character n-grams.

A word (a run of letters) that the model knows is scored by its log frequency in each language.  An unseen word
falls back to the mean log frequency of its known 4-grams, or if it has none of its 3-grams, and so on down to
single letters.  The language with the largest sum wins.

Counts cover every text that is not held out.  A task adds up its distinct words, derives the n-grams from these once,
and sends sorted arrays by ranges of the key; each range is merged apart.  The table that scoring tasks hold has, for
every language, its own ``WORDS`` / languages most frequent words and ``GRAMS`` / languages n-grams of each length (by
whole frequency classes), each with its counts in all languages: what a language knows does not depend on how much
there is of the others.  Rarer words are unseen words, which is what the fallback is for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, shared
from .perplexity import code_points

LENGTHS = (4, 3, 2, 1)
WORDS, GRAMS = 200_000, 100_000
#: Distinct words of a language that a task holds before it passes them on, with their n-grams (about 60 bytes each).
HELD = 250_000
#: Entries of a range that are merged at a time.
MERGED = 600_000
SMOOTH = 0.5

_ENTRY = np.dtype([("h", "<u8"), ("lang", "<u2"), ("kind", "u1"), ("c", "<u8")])
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ANY = regex.compile(r"\p{L}")


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes with all else blank; starts, ends and hashes of words; row of each word."""
    low = np.where(_LETTER[buf], arrays.LOWER[buf], np.uint8(32))
    starts, ends, first = arrays.words(low, off)
    return low, starts, ends, arrays.Rolling(low).of(starts, ends), np.repeat(np.arange(len(off) - 1), np.diff(first))


def _grams(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, key) of the character n-grams of each word, its two borders counted as a character."""
    size = ends - starts
    joined = np.full(int(size.sum()) + len(size) + 1, 32, np.uint8)
    at = np.cumsum(size + 1) - size
    joined[arrays.ragged(at, size)] = low[arrays.ragged(starts, size)]
    _, points = code_points(joined)
    blank = points == 32
    word = np.cumsum(blank) - 1
    m = max(0, len(points) - n + 1)
    key = np.zeros(m, np.uint64)
    for j in range(n):
        key = key * np.uint64(0xD1342543DE82EF95) + points[j : j + m].astype(np.uint64) + np.uint64(1)
    inner = np.zeros(len(points) + 1, np.int64)
    np.cumsum(blank, out=inner[1:])
    i = np.arange(m)
    good = (inner[np.maximum(i + n - 1, i + 1)] - inner[i + 1] == 0) & ~((n == 1) & blank[:m])
    good &= ~(blank[:m] & blank[n - 1 : n - 1 + m])
    return word[:m][good], arrays.mix(key[good] + np.uint64(n))


def _merge(parts: list[np.ndarray]) -> np.ndarray:
    x = np.concatenate(parts)
    x = x[np.lexsort((x["lang"], x["kind"], x["h"]))]
    if not len(x):
        return x
    head = np.flatnonzero(np.r_[True, (x["h"][1:] != x["h"][:-1]) | (x["lang"][1:] != x["lang"][:-1]) | (x["kind"][1:] != x["kind"][:-1])])
    out = x[head].copy()
    out["c"] = np.add.reduceat(x["c"], head)
    return out


def _added(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """Distinct (word hash, language) of all parts with summed counts, and the bytes of each word: buffer, starts, ends."""
    h, lang, c = (np.concatenate([x[i] for x in parts]) for i in range(3))
    order = np.lexsort((lang, h))
    h, lang = h[order], lang[order]
    head = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (lang[1:] != lang[:-1])])
    c = np.add.reduceat(c[order], head)
    own = order[head]
    base = np.cumsum([0, *(len(x[3]) for x in parts)])
    low = parts[0][3] if len(parts) == 1 else np.concatenate([x[3] for x in parts])
    starts = np.concatenate([x[4] + b for x, b in zip(parts, base, strict=False)])[own]
    size = np.concatenate([x[5] - x[4] for x in parts])[own]
    ends = np.cumsum(size)
    return h[head], lang[head], c, low[arrays.ragged(starts, size)], ends - size, ends


def _entries(h: np.ndarray, lang: np.ndarray, kind: int, c: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), _ENTRY)
    out["h"], out["lang"], out["kind"], out["c"] = h, lang, kind, c
    return out


def _counts(docs: DataFrame, langs: list[str], buckets: int) -> DataFrame:
    index = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple]) -> pa.RecordBatch:
            h, lang, c, low, starts, ends = _added(held)
            parts = [_entries(h, lang, 0, c)]
            for n in LENGTHS:
                for i in range(0, len(h), 1 << 16):
                    s = slice(i, i + (1 << 16))
                    word, key = _grams(low, starts[s], ends[s], n)
                    parts.append(_merge([_entries(key, lang[s][word], n, c[s][word])]))
            x = _merge(parts)
            bucket = ((x["h"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            return pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), pa.array([x[cut[i] : cut[i + 1]].tobytes() for i in range(buckets)], pa.binary())], ["bucket", "entries"])

        held: list[tuple] = []
        for batch in batches:
            of = np.array([index[x] for x in batch.column(1).to_pylist()])
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                low, starts, ends, h, row = _words(buf, off)
                if len(h):
                    held.append(_added([(h, of[a:b][row].astype(np.int64), np.ones(len(h), np.int64), low, starts, ends)]))
                if sum(len(x[0]) for x in held) > 3 * HELD:
                    held = [_added(held)]
                    if len(held[0][0]) > HELD:
                        yield flush(held)
                        held = []
        if held:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = by.setdefault(bucket, [])
                got.append(np.frombuffer(raw.as_buffer(), _ENTRY))
                if len(got) > 1 and sum(map(len, got[1:])) > max(MERGED, len(got[0])):
                    by[bucket] = [_merge(got)]
        for got in by.values():
            x = _merge(got)
            for i in range(0, len(x), 1 << 16):
                y = x[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(y["kind"].astype(np.int32)), pa.array(y["h"].astype(np.uint64).view(np.int64)), pa.array(y["lang"].astype(np.int32)), pa.array(y["c"].astype(np.int64))], ["kind", "h", "lang", "c"])

    parts = docs.select("text", "lang").mapInArrow(arrays.lean(count), "bucket int, entries binary")
    return parts.repartitionById(buckets, "bucket").mapInArrow(arrays.lean(merge), "kind int, h long, lang int, c long")


def _model(counts: DataFrame, langs: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By kind: sorted keys, and log frequency in each language.

    A language's quota is filled by its own counts; a key that one language chooses has its counts in all of them.
    """
    totals = {(r["kind"], r["lang"]): r["c"] for r in counts.groupBy("kind", "lang").agg(F.sum("c").alias("c")).collect()}
    level = F.floor(8 * F.log2("c")).cast("int")
    spread: dict[tuple[int, int], dict[int, int]] = {}
    for r in counts.groupBy("kind", "lang", level.alias("l")).agg(F.count("*").alias("n")).collect():
        spread.setdefault((r["kind"], r["lang"]), {})[r["l"]] = r["n"]
    rows = []
    for (kind, lang), sizes in spread.items():
        room, least = (WORDS if kind == 0 else GRAMS) // langs, 99_999
        for l in sorted(sizes, reverse=True):
            room -= sizes[l]
            if room < 0:
                break
            least = l
        rows.append((kind, lang, least))
    limits = F.broadcast(counts.sparkSession.createDataFrame(rows, "kind int, lang int, least int"))  # a row for each language and kind
    chosen = counts.join(limits, ["kind", "lang"]).filter(level >= F.col("least")).select("kind", "h").distinct()
    got = counts.join(chosen, ["kind", "h"], "left_semi").select("kind", "h", "lang", "c").toArrow()
    out = {}
    kinds = got["kind"].to_numpy()
    for kind in np.unique(kinds).tolist():
        mine = kinds == kind
        h, lang, c = (got[x].to_numpy()[mine] for x in ("h", "lang", "c"))
        keys, at = np.unique(h.view(np.uint64), return_inverse=True)
        table = np.full((len(keys), langs), SMOOTH, np.float64)
        table[at, lang] += c
        total = np.array([totals.get((kind, i), 0) for i in range(langs)], float)
        out[kind] = (keys, np.log(table / (total + SMOOTH * (len(keys) + 1))).astype(np.float32))
    return out


def _known(model: dict, kind: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = model[kind][0] if kind in model else np.zeros(0, np.uint64)
    if not len(keys):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return keys[at] == h, at


def _word_scores(model: dict, langs: int, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Scores of distinct words: of the word itself, or of its longest known n-grams."""
    out = np.zeros((len(h), langs), np.float32)
    hit, at = _known(model, 0, h)
    if hit.any():
        out[hit] = model[0][1][at[hit]]
    todo = np.flatnonzero(~hit)
    for n in LENGTHS:
        if not len(todo):
            break
        word, key = _grams(low, starts[todo], ends[todo], n)
        hit, at = _known(model, n, key)
        word, at = word[hit], at[hit]
        number = np.bincount(word, minlength=len(todo))
        some = number > 0
        if some.any():
            for l in range(langs):
                out[todo[some], l] = np.bincount(word, weights=model[n][1][at, l], minlength=len(todo))[some] / number[some]
        todo = todo[~some]
    return out


def language_id(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Learns from rows with a lang whose crc32 of doc_id as text is no multiple of 5; predicts every row from its
    text alone.  lang_pred is a learned language, or ``und`` (score 0) for a text that is null or has no letter.
    score is the posterior of the predicted language.

    Rows with a null doc_id count as held out.  Repeated rows count as often as they occur and get equal results.
    Of languages with equal sums the first by name wins.  If nothing can be learned every row is ``und``.  A text is read
    in one piece, in memory of some 60 times its size.  Other columns are ignored, whatever their names; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))
    docs = docs.withColumn("held_out", out)
    learn = docs.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = sorted(r["lang"] for r in learn.select("lang").distinct().collect())
    if not langs:
        return docs.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    counts = shared.save(_counts(learn, langs, shared.parts(spark)), "counts")
    model = spark.sparkContext.broadcast(_model(counts, len(langs)))
    shared.forget(counts)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, k = model.value, len(langs)
        names = np.array([*langs, "und"], object)
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                low, starts, ends, h, row = _words(buf, off)
                total = np.zeros((b - a, k))
                if len(h):
                    kinds, at, back = np.unique(h, return_index=True, return_inverse=True)
                    scores = _word_scores(m, k, low, starts[at], ends[at], kinds)
                    for l in range(k):
                        total[:, l] = np.bincount(row, weights=scores[back, l], minlength=b - a)
                plain = np.zeros(len(buf) + 1, np.int64)
                np.cumsum(_LETTER[buf] & (buf < 128), out=plain[1:])
                letter = np.diff(plain[off]) > 0
                for i in np.flatnonzero(~letter & (np.diff(off) > 0)):
                    letter[i] = _ANY.search(buf[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace")) is not None
                best = np.where(letter, total.argmax(1), k)
                share = np.exp(total - total.max(1, keepdims=True))
                score = np.where(letter, share.max(1) / share.sum(1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(names[best], pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(arrays.lean(predict), "doc_id long, held_out boolean, lang_pred string, score double")
