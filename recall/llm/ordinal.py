"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grade g of a text follows ``P(grade <= g) = sigmoid(cut_g - w . x)`` with increasing cuts and one weight vector
``w`` over hashed features of the whole text: its words, their beginnings, and how common each shape of token
(case, digits, trailing mark) and immediate repetition is.  ``x`` marks the selected features that a text has,
scaled to length 1, so one telling word counts as much in a long text as in a short one.

Training reads at most about ``SAMPLE`` labelled texts, taken by a hash of doc_id.  Spark counts features by
grade; those that are ``LIFT`` times as frequent on one side of a cut as on the other, either way, and by z-score (at
most ``FEATURES``), enter the fit, which runs on the driver over the lists of selected features only, with signed weights
and a penalty on their squares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays, shared
from .language_id import _words

#: Labelled texts that the fit may use (a documented bound; with fewer labels all are used).
SAMPLE = 20_000
WIDTH = 1 << 20
FEATURES = 8192
LEAST_COUNT, LEAST_Z = 4, 4.5
#: A feature must be so many times as frequent on one side of a cut as on the other.
LIFT = 3.0
#: Bytes of the beginnings of words that are features, besides whole words.
BEGINNINGS = (4, 6)
GRADES = 3

_CLASS = np.full(256, 5, np.int64)  # other
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
for _c in b".,;:!?'\"()-":
    _CLASS[_c] = 3
for _c in b"#*$%&|<>@=_~^\\/+[]{}`":
    _CLASS[_c] = 4
_CLASS[128:] = 0


def _features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all texts, in no order; features may repeat."""
    n = len(off) - 1
    low, starts, ends, h, row = _words(buf, off)
    roll = arrays.Rolling(low)
    begins = [roll.of(starts, np.minimum(ends, starts + size)) ^ np.uint64(0x6A09E667F3BCC908) for size in BEGINNINGS]
    rows, keys = [row] * (1 + len(begins)), [h, *begins]
    s, e, first = arrays.words(buf, off)
    if len(s):
        raw = arrays.Rolling(arrays.LOWER[buf]).of(s, e)
        token = np.repeat(np.arange(n), np.diff(first))
        size = np.diff(first)
        capital = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(_CLASS[buf] == 1, out=capital[1:])
        shout = (capital[e] - capital[s] > 1).astype(np.int64)
        again = np.r_[False, (raw[1:] == raw[:-1]) & (token[1:] == token[:-1])]
        twice = buf[np.maximum(e - 2, s)]
        shape = ((_CLASS[buf[s]] * 6 + _CLASS[buf[e - 1]]) * 6 + _CLASS[twice]) * 2 + shout
        shape = np.where(again, 500, shape)
        table = np.bincount(token * 512 + shape, minlength=n * 512).reshape(n, 512)
        r, c = np.nonzero(table)
        part = np.digitize(table[r, c] / size[r], [0.02, 0.08, 0.2, 0.5])
        rows.append(r)
        keys.append((c * 8 + part + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = np.concatenate(keys)
    return np.concatenate(rows), (arrays.mix(key) >> np.uint64(44)).astype(np.int64)


def _present(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair = np.unique(row * WIDTH + feature)
    return pair // WIDTH, pair % WIDTH


def _chosen(sample: DataFrame) -> np.ndarray:
    """Features whose presence differs between grades."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((GRADES, WIDTH), np.int32)
        for batch in batches:
            grades = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                row, feature = _present(*_features(buf, off))
                total += np.bincount(grades[a:b][row] * WIDTH + feature, minlength=GRADES * WIDTH).reshape(GRADES, WIDTH).astype(np.int32)
        grade, feature = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(feature.astype(np.int32)), pa.array(grade.astype(np.int32)), pa.array(total[grade, feature].astype(np.int64))], ["feature", "grade", "c"])

    counts = sample.select("text", "grade").mapInArrow(arrays.lean(count), "feature int, grade int, c long")
    wide = counts.groupBy("feature").agg(*(F.sum(F.when(F.col("grade") == g, F.col("c")).otherwise(0)).alias(f"c{g}") for g in range(GRADES)))
    got = wide.filter(sum(F.col(f"c{g}") for g in range(GRADES)) >= LEAST_COUNT).toArrow()
    number = {r["grade"]: r["n"] for r in sample.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    size = np.array([number.get(g, 0) for g in range(GRADES)], float)
    c = np.stack([got[f"c{g}"].to_numpy().astype(float) for g in range(GRADES)], 1)
    best = np.zeros(len(c))
    for cut in range(1, GRADES):
        below, above = size[:cut].sum(), size[cut:].sum()
        if below and above:
            a, b = c[:, :cut].sum(1), c[:, cut:].sum(1)
            rate = (a + b) / (below + above)
            z = (a / below - b / above) / np.sqrt(np.maximum(rate * (1 - rate), 1e-9) * (1 / below + 1 / above))
            low, high = np.minimum(a / below, b / above), np.maximum(a / below, b / above)
            best = np.maximum(best, np.where(high >= LIFT * low, np.abs(z), 0.0))
    order = np.lexsort((got["feature"].to_numpy(), -best))[:FEATURES]
    return np.sort(got["feature"].to_numpy()[order[best[order] >= LEAST_Z]])


def fit(rows: np.ndarray, features: np.ndarray, grades: np.ndarray, width: int, steps: int = 300, rate: float = 0.2, shrink: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts by gradient steps (Adam) on the mean log loss plus ``shrink`` / 2n of squared weights."""
    n = len(grades)
    share = np.cumsum(np.bincount(grades, minlength=GRADES) + 1.0)[:-1] / (n + GRADES)
    cut = np.log(share / (1 - share))
    base, gap = cut[0], np.log(np.maximum(np.diff(cut), 1e-3))
    unit = 1 / np.sqrt(np.maximum(1, np.bincount(rows, minlength=n)))
    x = np.concatenate([np.zeros(width), [base], gap])
    m, v = np.zeros_like(x), np.zeros_like(x)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, steps + 1):
        w, cuts = x[:width], x[width] + np.concatenate([[0], np.cumsum(np.exp(x[width + 1 :]))])
        score = np.bincount(rows, weights=w[features], minlength=n) * unit
        up = np.where(grades < GRADES - 1, sig(cuts[np.minimum(grades, GRADES - 2)] - score), 1.0)
        down = np.where(grades > 0, sig(cuts[np.maximum(grades - 1, 0)] - score), 0.0)
        p = np.maximum(up - down, 1e-12)
        du, dd = up * (1 - up) / p, down * (1 - down) / p
        g_score = (du - dd) / n
        g = np.zeros_like(x)
        g[:width] = np.bincount(features, weights=(g_score * unit)[rows], minlength=width) + shrink * w / n
        g_cut = np.zeros(GRADES - 1)
        np.add.at(g_cut, np.minimum(grades, GRADES - 2), np.where(grades < GRADES - 1, -du, 0.0) / n)
        np.add.at(g_cut, np.maximum(grades - 1, 0), np.where(grades > 0, dd, 0.0) / n)
        g[width] = g_cut.sum()
        for i in range(GRADES - 2):
            g[width + 1 + i] = g_cut[i + 1 :].sum() * np.exp(x[width + 1 + i])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
    return x[:width], x[width] + np.concatenate([[0], np.cumsum(np.exp(x[width + 1 :]))])


def grade(quality: Column, toxic: Column) -> Column:
    """Grade of a label row: 2 less one for poor quality and one for toxicity; null without a quality."""
    return F.when(quality.isNull(), None).otherwise(2 - (quality <= 0).cast("int") - (F.coalesce(toxic, F.lit(0)) > 0).cast("int"))


def quality_classifier(docs: DataFrame, labels: DataFrame, least: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, expected_grade, tail_probability, kept.

    ``labels`` (doc_id, quality, toxic) give grades (``grade``); of several label rows of a document the lowest
    counts.  tail_probability is that of the highest grade, kept where it is at least ``least``.  ``carry`` names
    columns of ``docs`` to return first instead of doc_id.

    A text that is null or has no word is rejected, with grade and probability 0.  Labels without quality or without a
    document are ignored.  Repeated document rows get equal results; of several texts of one labelled doc_id the one with
    the smallest hash is learned from.  If the labels have fewer than two grades nothing can be learned: grade and
    probability are null and every text with a word is kept.  A probability of exactly ``least`` is kept.  A text is read
    in one piece, in memory of some 80 times its size.  Other columns are ignored, whatever their names; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    whole = docs.select("doc_id", "text", *(c for c in carry or [] if c not in ("doc_id", "text")))
    first = carry or ["doc_id"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade(F.col("quality"), F.col("toxic")).alias("grade")).dropna()
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    number = rated.count()
    share = min(1.0, SAMPLE / max(1, number))
    picked = shared.save(rated.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)), "picked")
    texts = shared.maybe(docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), shared.bloom(picked.select(F.col("doc_id").alias("id"))))
    first_text = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")  # of several texts of a doc_id always the same
    sample = shared.save(texts.join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(first_text).join(picked, "doc_id").select("text", "grade", "doc_id"), "sample")
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]") & F.col("text").isNotNull()
    if sample.agg(F.count_distinct("grade")).first()[0] < 2:
        none = F.lit(None).cast("double")
        return whole.select(*first, none.alias("expected_grade"), none.alias("tail_probability"), F.coalesce(words, F.lit(False)).alias("kept"))
    chosen = _chosen(sample)

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                row, feature = _features(buf, off)
                at = np.searchsorted(chosen, feature)
                hit = chosen[np.minimum(at, len(chosen) - 1)] == feature if len(chosen) else np.zeros(len(at), bool)
                row, at = _present(row[hit], at[hit])
                cut = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(a, b - a), batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(pa.array(cut), pa.array(at.astype(np.int32)))], ["doc_id", "grade", "present"])

    got = sample.mapInArrow(arrays.lean(selected), "doc_id long, grade int, present array<int>").orderBy("doc_id").toArrow()
    shared.forget(sample)
    lists = got["present"].combine_chunks()
    features = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(got.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    w, cuts = fit(rows, features, got["grade"].to_numpy().astype(np.int64), max(1, len(chosen)))
    model = spark.sparkContext.broadcast((chosen, w, cuts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w, cuts = model.value
        table = np.zeros(WIDTH)
        table[own] = w[: len(own)]
        chosen_ = np.zeros(WIDTH, bool)
        chosen_[own] = True
        for batch in batches:
            for a, b, buf, off in arrays.text_pieces(batch, "text"):
                row, feature = _features(buf, off)
                hit = chosen_[feature]
                row, feature = _present(row[hit], feature[hit])
                value = np.bincount(row, weights=table[feature], minlength=b - a) / np.sqrt(np.maximum(1, np.bincount(row, minlength=b - a)))
                tails = 1 - 1 / (1 + np.exp(np.clip(value[:, None] - cuts[None, :], -40, 40)))
                solid = np.zeros(len(buf) + 1, np.int64)
                np.cumsum(~arrays.SPACE[buf], out=solid[1:])
                some = np.diff(solid[off]) > 0
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in first), pa.array(np.where(some, tails.sum(1), 0.0)), pa.array(np.where(some, tails[:, -1], 0.0)), pa.array(some & (tails[:, -1] >= least))],
                    [*first, "expected_grade", "tail_probability", "kept"],
                )

    schema = whole.select(*first).schema.add("expected_grade", "double").add("tail_probability", "double").add("kept", "boolean")
    return whole.mapInArrow(arrays.lean(score), schema)
