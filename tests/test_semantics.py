"""Hand-made cases for the rules that differ between languages and engines."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recall import schema
from recall.functions import scope, text, vector
from recall.operators import ingest, lifecycle, retrieve, search, views


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("given_", "want"),
    [
        ("---\na: b\n---\n\nbody", "body"),
        ("---\n---\n", "---\n---\n"),
        ("---\na\n---foo\nb", "foo\nb"),
        ("---\r\na\r\n---\r\nb", "---\r\na\r\n---\r\nb"),
        ("no --- here", "no --- here"),
        ("", ""),
        (None, None),
    ],
)
def test_front_matter(spark, given_, want):
    assert one(spark, given_, text.without_front_matter) == want


def test_strip_takes_all_white_space(spark):
    assert one(spark, "\t \n\r 　x y\x0b\x1f", text.strip) == "x y"


def test_key_is_cut_then_lowered_then_stripped(spark):
    assert one(spark, " A" * 400, text.dedupe_key) == (" A" * 400)[:500].lower().strip()


def test_first_truthy(spark):
    assert one(spark, "", lambda x: text.first_truthy(x, F.lit(None), F.lit("z"))) == "z"


def test_decode_drops_bad_bytes(spark):
    assert one(spark, bytearray("é".encode() + b"\xff!"), text.decode_ignoring, "binary") == "é!"


def test_markers(spark):
    for path, want in (("/v/.git/a.md", True), ("/v/.trash", True), ("/v/.foo/a.md", False), ("/v/_u.md", False)):
        assert one(spark, path, lambda x: text.has_marker(x, ingest.MARKERS)) is want


def test_scope(spark):
    wanted = {"user_id": "a", "agent_name": "h"}
    cases = {'{"user_id":"a","agent_name":"h"}': (True, True), '{"agent_name":"h","user_id":"a"}': (True, True), '{"user_id":"a","agent_name":"h","x":"1"}': (False, True), "{}": (False, False)}
    for value, (same, part) in cases.items():
        assert one(spark, value, lambda x: scope.exact(x, wanted)) is same
        assert bool(one(spark, value, lambda x: scope.includes(x, wanted))) is part
    assert one(spark, '{"user_id":{"a":1}}', lambda x: scope.field(x, "user_id")) is None


def test_cosine_of_odd_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0]), (None, [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(vector.cosine_distance(F.col("a"), F.col("b"))).collect()] == [0.0, None, None, None]


def test_nearest_leaves_out_unusable_vectors(spark):
    rows = [("1", "a", "{}", [1.0, 0.0]), ("2", "b", "{}", None), ("3", "c", "{}", [0.0, 0.0]), ("4", "d", "{}", [1.0]), ("5", "e", "{}", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "memory_id string, fact string, scope string, embedding array<double>")
    assert [r["memory_id"] for r in search.nearest(df, [1.0, 0.0], 8).collect()] == ["1", "5"]
    assert search.nearest(df.limit(0), [1.0, 0.0], 8).count() == 0


def legs(spark, bank, warehouse, local):
    make = lambda origin, rank, facts: spark.createDataFrame([(origin, rank, i, f) for i, f in enumerate(facts)], "origin string, src_rank long, rn long, fact string")
    return make("bank", 0, bank), make("warehouse", 1, warehouse), make("local", 2, local)


def test_merge_rules(spark):
    long = "x" * 500
    out = retrieve.merge(*legs(spark, ["A", long + "1", None], ["a ", long + "2", "B"], ["b", "new", "new", " ", "", long + "9"]), 20).orderBy("rank").collect()
    assert [(r["origin"], r["fact"]) for r in out] == [("bank", "A"), ("bank", long + "1"), ("warehouse", "B"), ("local", "new"), ("local", "new"), ("local", " ")]


def plain_merge(bank, warehouse, local, k):
    seen, out = set(), []
    for f in bank + warehouse:
        key = f[:500].lower().strip()
        if key and key not in seen:
            seen.add(key)
            out.append(f)
    return (out + [f[:500] for f in local if f and f[:500].lower().strip() not in seen])[:k]


def test_merge_against_plain_python(spark):
    rng = random.Random(3)
    for _ in range(4):
        draw = lambda: [rng.choice(["a", "A ", "b", " b", "c", "", "d" * 600, "D" * 500]) for _ in range(rng.randint(0, 8))]
        b, w, l = draw(), draw(), draw()
        got = [r["fact"] for r in retrieve.merge(*legs(spark, b, w, l), 9).orderBy("rank").collect()]
        assert got == plain_merge(b, w, l, 9)


def test_prompt_skips_empty_facts(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (1, 4, "")], "g long, rank long, fact string")
    assert retrieve.prompt_context(df, "g").first()["prompt_context"] == "- a\n- b"


def test_note_batches_budget(spark):
    sizes = [4000, 2000, 1, 9000, 10]
    rows = [("v", f"{i}", "", "x" * (n - 33)) if n > 33 else ("v", f"{i}", "", "") for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "vault string, path string, rel string, body string")
    assert [r["batch"] for r in ingest.note_batches(df, 6000).orderBy("path").collect()] == [0, 0, 1, 2, 3]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 90), max_size=30))
def test_note_batches_against_a_loop(spark, sizes):
    rows = [("v", f"{i:03}", "", "x" * n) for i, n in enumerate(sizes)]
    got = [r["batch"] for r in ingest.note_batches(spark.createDataFrame(rows, "vault string, path string, rel string, body string"), 150).orderBy("path").collect()]
    want, number, held = [], 0, 0
    for n in sizes:
        n += 33
        if held and held + n > 150:
            number, held = number + 1, 0
        held += n
        want.append(number)
    assert got == want


def test_turn_length(spark):
    rows = [(1, 0, "user", " 1234567 "), (1, 1, "assistant", "x"), (2, 0, "user", "12345678"), (2, 1, "assistant", None), (3, 0, "user", "no answer"), (3, 1, "user", "y" * 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in ingest.turn_facts(df).collect()] == [(2, 0, "User: 12345678\nAssistant: ")]


def test_seed_keeps_repeats_inside(spark):
    m = spark.createDataFrame([("1", "Known", "u", None)], "memory_id string, fact string, user_id string, created_at timestamp_ntz")
    c = spark.createDataFrame([(" known\n",), ("new",), ("new",)], "fact string")
    assert [r[0] for r in ingest.seed_new_facts(c, m, "u").collect()] == ["new", "new"]


def test_remember_defaults(spark):
    df = spark.createDataFrame([("1", "f", None, None, "{}"), ("2", "g", "u", "a", '{"k":1}')], "memory_id string, fact string, user_id string, agent_name string, metadata string")
    a, b = ingest.remember_rows(df, F.expr("timestamp_ntz'2024-01-01 00:00:00'")).orderBy("memory_id").collect()
    assert (a["user_id"], a["scope"], a["metadata"]) == ("", "{}", "null")
    assert (b["scope"], b["metadata"], str(b["expires_at"])) == ('{"user_id":"u","agent_name":"a"}', '{"k":1}', "2024-12-31 00:00:00")


def test_validate_rejects_nulls(spark):
    rows = schema.conform(spark.createDataFrame([(None, "f")], "memory_id string, fact string"), schema.MEMORIES)
    assert schema.violations(rows, schema.MEMORIES).count() == 1
    with pytest.raises(Exception, match="must not be null"):
        schema.validate(rows, schema.MEMORIES).collect()


def test_manifest_upsert_prefers_what_is_done(spark):
    old = spark.createDataFrame([("a", "9"), ("b", "1")], "path string, hash string")
    new = spark.createDataFrame([("a", "2"), ("c", "3")], "path string, hash string")
    assert sorted(map(tuple, ingest.manifest_upsert(old, new).collect())) == [("a", "2"), ("b", "1"), ("c", "3")]


def test_purge_keeps_unknown(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "user_id string")
    assert lifecycle.purge_preview(df, F.col("user_id") == "a").first()[0] == 1
    assert sorted(str(r[0]) for r in lifecycle.purge_survivors(df, F.col("user_id") == "a").collect()) == ["None", "b"]


def test_stats_group_by_scope_not_column(spark):
    df = spark.createDataFrame([("{}", "", None), ('{"user_id":"u"}', "other", None)], "scope string, user_id string, created_at timestamp_ntz")
    assert sorted((str(r["user_id"]), r["memory_count"]) for r in views.memory_stats(df).collect()) == [("None", 1), ("u", 1)]
