"""The pipeline: every stage against a plain version of its decisions, on its own input."""

from collections import defaultdict

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from recall.llm import shared
from recall.llm.ordinal import quality_classifier

from . import brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = {"documents": docs}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
    rows = {k: [(r["doc_id"], r["text"]) for r in v.collect()] for k, v in kept.items() if k != "packing"}

    # nothing but what the classifier rejects goes
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    judged = {r["doc_id"]: r["kept"] for r in quality_classifier(kept["documents"], labels).collect()}
    assert sorted(rows["quality"]) == sorted(r for r in rows["documents"] if judged[r[0]])

    # one document of each group stays, the first
    groups = brute.components(rows["quality"])
    assert {d for d, _ in rows["near_copies"]} == {c for _, _, c in groups}

    # repeated strings are cut out of what stays
    cut = brute.without_repeats(rows["near_copies"])
    left = dict(rows["repeats"])
    for d, text in rows["near_copies"]:
        n, removed, _, _ = cut[d]
        if not removed:
            assert left[d] == text or not text.strip()
        elif d in left:
            assert 0 <= n - removed - len(left[d].encode()) <= 6 * cut[d][2]
    assert all(r["n_chars"] == len(r["text"]) for r in kept["repeats"].collect())

    # contaminated documents go, all others stay
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute.benchmark_pairs(rows["repeats"], items)}
    assert {d for d, _ in rows["decontaminate"]} == {d for d, _ in rows["repeats"]} - bad

    # every token is packed once
    pieces = defaultdict(int)
    for r in kept["packing"].collect():
        pieces[r["doc_id"]] += r["length"]
        assert r["offset"] + r["length"] <= 2048
    assert set(pieces) == {d for d, _ in rows["decontaminate"]}
    assert all(pieces[r["doc_id"]] == r["doc_tokens"] for r in kept["packing"].collect())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)


def test_near_copies_of_repeated_ids(spark):
    """A row goes for the sake of its own text, not of its id, and of equal rows one stays."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, a), (None, a), (8, ""), (8, None), (9, a + " more"), (6, "one word"), (7, "One WORD")]
    got = [(r["doc_id"], r["text"]) for r in pipeline.near_copies(spark, documents(spark, rows), DATA).collect()]
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(got, key=key) == sorted([(1, a), (5, b), (7, c), (None, a), (None, a), (8, ""), (8, None), (6, "one word")], key=key)


def test_repeats_keep_genuine_characters(spark):
    """Only characters that a cut breaks are dropped; texts of white space alone go."""
    passage = "".join(chr(0x430 + (i * i + i // 7) % 31) + str(i) for i in range(70))
    rows = [(1, passage), (2, f"abc\ufffd{passage}\ufffd def"), (3, "é" + passage[1:] + "x"), (4, "\n \n\t"), (5, "tail\ufffd")]
    got = {r["doc_id"]: r for r in pipeline.repeats(spark, documents(spark, rows), DATA).collect()}
    assert set(got) == {1, 2, 3, 5}
    assert got[2]["text"].startswith("abc\ufffd") and got[2]["text"].endswith("\ufffd def") and len(got[2]["text"]) < 20
    assert got[5]["text"] == "tail\ufffd"
    assert got[3]["text"][0] == "é" and "\ufffd" not in got[3]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_odd_documents(spark):
    """Nulls in every column, empty, long and repeated texts, and columns with the operators' own names, through all stages."""
    long = " ".join(f"word{i * 7919 % 10007}" for i in range(40_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words of a text without an id that is long enough", "en", None, 5), (4, long, None, "s", None), (5, long + " end", "en", "s", 1)]
    rows += [(3, "the same text twice " * 20, "en", "s", 400)] * 2
    docs = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA + ", sig string, label string, _id int")
    seen = {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        seen[name] = [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
    assert not {1, 2} & {r["doc_id"] for r in seen["quality"]}
    kept = {r["doc_id"] for r in seen["quality"]}
    assert {r["doc_id"] for r in seen["near_copies"]} == kept - ({5} if 4 in kept else set())
    assert len(seen["near_copies"]) == len({r["doc_id"] for r in seen["near_copies"]})
    assert {r["doc_id"] for r in seen["packing"]} == {r["doc_id"] for r in seen["decontaminate"]}


def test_empty_documents(spark):
    docs = documents(spark, []).withColumn("token", F.lit("x"))
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.collect() == []


def test_run_leaves_one_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "folder", lambda spark: f"file://{tmp_path}")
    assert pipeline.run(spark, DATA).count() > 0
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["pipeline"]
