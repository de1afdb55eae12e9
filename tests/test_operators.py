import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.functions.identifiers import base_id, numeric_id
from chronoweave.functions.links import extract_links
from chronoweave.functions.prompts import apply_template, chat_prompt, context_parts, conversation_contexts, ends_with_stop
from chronoweave.functions.tokens import HookTokenizer, PatternTokenizer, pad_batches
from chronoweave.functions.vectors import argmax, f_measure, mean_best_cosine, unit
from chronoweave.operators.aggregates import nest_children, nest_values, pivot_first, spread_attributes, symmetric_difference
from chronoweave.operators.columns import (
    drop_unset, known_at, midnight, not_denied, null_second_if_both, recode, shorter_than_days, whole_days,
)
from chronoweave.operators.joins import counts_before, first_seen, full_merge, rows_before
from chronoweave.plans.samples import cut_after_overflow
from chronoweave.plans.splits import hold_out, split_by_hash, split_chunks, validation_count

D = datetime


def test_null_rules(spark, rows_of):
    df = spark.createDataFrame([(1, "Lab"), (2, None), (3, "x")], "i int, c string")
    assert rows_of(df.where(not_denied("c", ["Lab"])), "i") == [(2,), (3,)]
    assert rows_of(df.select("i", recode("c", {"x": "X"}))) == [(1, None), (2, None), (3, "X")]
    times = spark.createDataFrame([(1, 5, 6), (2, None, 6), (3, None, None)], "i int, a int, b int")
    assert rows_of(times.select("i", null_second_if_both("a", "b"))) == [(1, None), (2, 6), (3, None)]
    assert rows_of(drop_unset(times, ["a", "b"]), "i") == [(1,), (2,)]
    assert rows_of(drop_unset(times, ["a", "b"], how="any"), "i") == [(1,)]


def test_days(spark, rows_of):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1), D(2020, 1, 8)), (2, D(2020, 1, 1), D(2020, 1, 7, 23, 59, 59)), (3, D(2020, 1, 1), None)],
        "i int, a timestamp_ntz, b timestamp_ntz",
    )
    assert rows_of(df.select("i", whole_days("a", "b"))) == [(1, 7), (2, 6), (3, None)]
    assert rows_of(df.where(shorter_than_days("a", "b", 7)), "i") == [(2,)]
    assert rows_of(df.select("i", known_at("b", "b", F.lit(D(2020, 1, 8)).cast("timestamp_ntz"))))[2] == (3, None)
    day = spark.createDataFrame([(date(2020, 1, 2),)], "d date")
    assert day.select(midnight("d")).first()[0] == D(2020, 1, 2)


def test_full_merge_is_a_full_outer_join(spark, rows_of):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (4, "w")], "k int, r string")
    got = full_merge(left, right, ["k"])
    assert got.exceptAll(left.join(right, "k", "full_outer")).count() == 0
    assert got.count() == left.join(right, "k", "full_outer").count()


def test_first_seen(spark, rows_of):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 1, "a"), (1, 1, None), (1, 2, "a"), (1, 2, None), (1, 2, "b"), (1, 3, "b"), (2, 3, "a")],
        "s int, e int, name string",
    )
    assert rows_of(first_seen(df, ["s"], "name", "e")) == sorted(
        [(1, 1, "a"), (1, 1, "a"), (1, 1, None), (1, 2, "b"), (2, 3, "a")], key=str
    )


def test_rows_before_is_strict_and_agrees_with_counts(spark, rows_of):
    anchors = spark.createDataFrame([(1, 10, D(2020, 1, 2)), (1, 11, D(2020, 1, 4)), (2, 12, D(2020, 1, 1))], "s int, a int, cut timestamp_ntz")
    notes = spark.createDataFrame(
        [(1, D(2020, 1, 1), 1, 5), (1, D(2020, 1, 2), 2, 6), (1, D(2020, 1, 3), 3, 7), (1, None, 4, 8)],
        "s int, t timestamp_ntz, n int, v int",
    )
    pairs = rows_before(anchors, notes, "s", "cut", "t")
    assert rows_of(pairs, "a", "n") == [(10, 1), (11, 1), (11, 2), (11, 3)]
    counts = counts_before(anchors, notes, "s", "cut", "t", "n", "v")
    assert rows_of(counts, "a", "n_before", "value_before", "last_before") == [(10, 1, 5, 1), (11, 3, 18, 3), (12, 0, None, None)]


@pytest.mark.parametrize(("part_rows", "last"), [(1, None), (3, None), (7, 4), (1_000, 1), (2, 50)])
def test_histories_in_parts_equal_the_join(spark, rows_of, part_rows, last):
    rng = random.Random(6)
    anchors = spark.createDataFrame([(rng.randrange(4), i, D(2020, 1, 1 + rng.randrange(25)) if i % 5 else None) for i in range(40)], "s int, a int, cut timestamp_ntz")
    notes = [(0 if i % 3 else rng.randrange(5), i, D(2020, 1, 1 + rng.randrange(25)) if i % 11 else None) for i in range(90)]
    df = spark.createDataFrame(notes, "s int, n int, t timestamp_ntz")
    got = rows_before(anchors, df, "s", "cut", "t", part_rows=part_rows, last=last, number="number")
    want = []
    for a in anchors.collect():
        held = sorted((t, n) for s, n, t in notes if s == a.s and t is not None)
        seen = [(a.s, a.a, a.cut, k, n, t) for k, (t, n) in enumerate(held, 1) if a.cut is not None and t < a.cut]
        want += seen if last is None else seen[-last:]
    assert rows_of(got, "s", "a", "cut", "number", "n", "t") == sorted(want, key=str)
    whole = rows_before(anchors, df, "s", None, "t", part_rows=part_rows)
    assert whole.count() == sum(1 for a in anchors.collect() for s, _, t in notes if s == a.s and t is not None)


def test_nesting_in_parts(spark, rows_of):
    df = spark.createDataFrame([(1, i) for i in range(7)] + [(2, 0)], "k int, i int")
    got = nest_children(df, ["k"], ["i"], ["i"], part_rows=3)
    flat = got.select("k", "part", "n_rows", F.transform("rows", lambda r: r["i"]).alias("v"))
    assert rows_of(flat) == [(1, 0, 3, [0, 1, 2]), (1, 1, 3, [3, 4, 5]), (1, 2, 1, [6]), (2, 0, 1, [0])]
    assert rows_of(nest_values(df, ["k"], ["i"], "i", "v")) == [(1, list(range(7))), (2, [0])]


def test_pivot_and_spread(spark, rows_of):
    df = spark.createDataFrame(
        [(1, 1, "a", None), (1, 2, "a", "x"), (1, 3, "a", "y"), (1, 4, "b", "z"), (1, 5, None, "lost"), (2, 1, None, None)],
        "k int, o int, name string, value string",
    )
    assert rows_of(pivot_first(df, ["k"], "name", "value", ["a", "b"], ["o"])) == [(1, "x", "z"), (2, None, None)]
    wide = spread_attributes(df, "name", "value", ["a", "b"])
    assert wide.columns == ["k", "o", "a", "b"]
    assert rows_of(wide) == sorted(
        [(1, 1, None, None), (1, 2, "x", None), (1, 3, "y", None), (1, 4, None, "z"), (1, 5, None, None), (2, 1, None, None)],
        key=str,
    )


def test_symmetric_difference_drops_all_copies(spark, rows_of):
    old = spark.createDataFrame([(1, None), (2, "a")], "i int, c string")
    new = spark.createDataFrame([(1, None), (2, "a"), (3, "b"), (3, "b"), (4, None)], "i int, c string")
    assert rows_of(symmetric_difference(old, new)) == [(4, None)]


def test_ids(spark, rows_of):
    df = spark.createDataFrame([("1_10",), ("1_discharge",), ("1-discharge",), ("a_b_3",), ("7",)], "s string")
    assert rows_of(df.select("s", base_id("s"), numeric_id("s"))) == sorted(
        [("1_10", "1", 10), ("1_discharge", "1", None), ("1-discharge", "1", None), ("a_b_3", "a_b", 3), ("7", "", 7)], key=str
    )


def test_cutoff_in_number_order(spark, rows_of):
    sizes = {n: 10 for n in range(12)} | {2: 101, 1: 100, 5: 10}
    df = spark.createDataFrame([("s", n, size) for n, size in sizes.items()] + [("s", None, 7), ("t", 11, 9)], "s string, n int, size int")
    # _2 is over the limit; _10 and _11 come after it although "_10" < "_2" as text; exactly 100 is out alone
    assert rows_of(cut_after_overflow(df, "s", "n", "size", 100), "s", "n") == [("s", 0), ("s", None), ("t", 11)]


def test_null_words_and_records(spark):
    df = spark.createDataFrame([("None", "nan", "x", 1.5, None)], "a string, b string, c string, d double, e string")
    fields = [(c, F.col(c)) for c in df.columns]
    assert df.select(text.record_lines(fields)).first()[0] == "   - c: x\n   - d: 1.5\n"
    assert df.select(text.block(fields)).first()[0] == "c: x\nd: 1.5\n\n"
    assert df.select(text.clean_record(fields)).first()[0] == {"a": "None", "b": "nan", "c": "x", "d": "1.5"}
    tokenizer = PatternTokenizer()
    printed = [(c, text.printable(v), tokenizer.floor(text.printable(v))) for c, v in fields]
    row = df.select(text.printed_record_size(printed, tokenizer), tokenizer.count(text.record_lines(fields)), text.printed_record(printed), text.record_lines(fields)).first()
    assert row[0] == row[1] and row[2] == row[3]


def test_prompts(spark):
    # Role markers of the prompt format.
    one = spark.range(1)
    whole = one.select(chat_prompt("S", F.lit("U"), F.lit("A"))).first()[0]
    assert whole == (
        "<|im_start|>system\nS\n<|im_end|>\n<|im_start|>user\nU\n<|im_end|>\n<|im_start|>assistant\nA\n<|im_end|></s>"
    )
    parts = one.select(chat_prompt("S", F.lit("U"), F.lit("A"), separate=True).alias("p")).first()["p"]
    assert parts["input"] + parts["output"] == whole
    messages = F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("text")))
    assert one.select(apply_template(messages)).first()[0] == "<|im_start|>user\nhi<|im_end|>\n"
    assert one.select(apply_template(messages, add_generation_prompt=True)).first()[0].endswith("<|im_start|>assistant\n")


def test_contexts_are_whole_without_a_limit(spark):
    turns = spark.createDataFrame(
        [(1, i, "user" if i % 2 == 0 else "assistant", f"word{i}") for i in range(300)], "c int, turn long, role string, text string"
    )
    rows = conversation_contexts(turns, "c", "turn", "role", "text", system="S").orderBy("turn").collect()
    assert [r["turn"] for r in rows] == list(range(0, 300, 2))
    assert [len(r["messages"]) for r in rows] == [r["turn"] + 2 for r in rows]


def test_contexts_stop_at_the_limit(spark):
    turns = spark.createDataFrame(
        [(1, i, "user" if i % 2 == 0 else "assistant", f"word{i}") for i in range(200)], "c int, turn long, role string, text string"
    )
    got = conversation_contexts(turns, "c", "turn", "role", "text", system="S", tokenizer=PatternTokenizer(), max_tokens=500)
    rows = got.orderBy("turn").collect()
    assert [m["text"] for m in rows[1]["messages"]] == ["S", "word0", "word1", "word2"]
    counted = got.withColumn("n", PatternTokenizer().count(apply_template(F.col("messages"), add_generation_prompt=True)))
    assert counted.agg(F.max("n")).first()[0] <= 500
    assert rows[-1]["turn"] >= 30 and [r["turn"] for r in rows] == list(range(0, rows[-1]["turn"] + 1, 2))


def test_stop_strings(spark, rows_of):
    df = spark.createDataFrame([("xxxxxxx END",), ("END xxxxxxxxxx",), ("END",)], "t string")
    assert [r[1] for r in rows_of(df.select("t", ends_with_stop(F.col("t"), ["END"])))] == [0, 0, 1]


def test_padding_sides(spark, rows_of):
    df = spark.createDataFrame([(0, [5, 6, 7]), (0, [8]), (1, [0])], "b int, ids array<int>")
    right = pad_batches(df, "b", "ids")
    assert rows_of(right, "input_ids", "attention_mask", "labels") == [
        ([0], [1], [-100]), ([5, 6, 7], [1, 1, 1], [5, 6, 7]), ([8, 0, 0], [1, 0, 0], [8, -100, -100]),
    ]
    assert ([0, 0, 8],) in rows_of(pad_batches(df, "b", "ids", side="left"), "input_ids")


def test_hook_tokenizer(spark, rows_of):
    def load():
        return lambda s: [ord(c) for c in s]

    df = spark.createDataFrame([("ab",), (None,)], "t string")
    assert rows_of(df.select(HookTokenizer(load, 1).ids(F.col("t")).alias("ids"))) == [(None,), ([97, 98],)]


def test_hook_gets_texts_in_slices_of_bounded_size(spark):
    """However many rows a batch has; a longer text comes alone, and nulls take no place."""

    def load():
        def encode(texts):
            assert len(texts) <= 1 or sum(len(t.encode()) for t in texts) <= 40, texts
            return [[len(t), len(texts)] for t in texts]

        return encode

    texts = [(i, None if i % 7 == 0 else "é" * (i % 45)) for i in range(300)]
    df = spark.createDataFrame(texts, "i int, t string").coalesce(1)
    got = {r.i: r.ids for r in df.select("i", HookTokenizer(load, 1, batched=True, slice_bytes=40).ids(F.col("t")).alias("ids")).collect()}
    assert [got[i] and got[i][0] for i, _ in texts] == [None if t is None else len(t) for _, t in texts]
    assert max(ids[1] for ids in got.values() if ids) > 2


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 9.0, 9.0],)], "v array<double>")
    assert df.select(argmax(F.col("v"))).first()[0] == 1
    pair = spark.createDataFrame([([[2.0, 0.0], [0.0, 3.0]], [[1.0, 0.0]])], "a array<array<double>>, b array<array<double>>")
    a, b = F.transform("a", unit), F.transform("b", unit)
    p, r = pair.select(mean_best_cosine(a, b), mean_best_cosine(b, a)).first()
    assert (p, r) == (0.5, 1.0)
    assert abs(pair.select(f_measure(F.lit(0.5), F.lit(1.0))).first()[0] - 2 / 3) < 1e-12


def test_links(spark, rows_of):
    html = (
        '<!-- <a href="no"> --><A class=x HREF="sub/">d</A><a href=\'f.txt\'>f</a><a href="../">up</a>'
        '<a href="/r?a=1&amp;b=2">r</a><a href="http://o/x">o</a><a href="#t">t</a><abbr href="n">'
    )
    pages = spark.createDataFrame([(1, "http://h/d/index.html?q#f", html)], "id int, url string, html string")
    assert rows_of(extract_links(pages, "id", "url", "html"), "href", "kind", "address") == sorted(
        [
            ("sub/", "directory", "http://h/d/sub/"), ("f.txt", "file", "http://h/d/f.txt"),
            ("/r?a=1&b=2", "file", "http://h/r?a=1&b=2"), ("http://o/x", "file", "http://o/x"),
            ("#t", "file", "http://h/d/index.html?q#t"),
        ],
        key=str,
    )


def test_splits(spark):
    ids = spark.range(1000).withColumnRenamed("id", "i")
    once = split_by_hash(ids, "i", 0.2, seed=1)
    again = split_by_hash(ids.repartition(5), "i", 0.2, seed=1)
    assert once.exceptAll(again).count() == 0 and once.count() == 1000
    assert once.exceptAll(split_by_hash(ids, "i", 0.2, seed=2)).count() > 0
    exact = split_chunks(ids, ["i"], "i", 300, 0.2)
    assert {(r["chunk"], r["split"]): r["count"] for r in exact.groupBy("chunk", "split").count().collect()} == {
        (c, s): n for c in range(4) for s, n in (("test", 60 if c < 3 else 20), ("train", 240 if c < 3 else 80))
    }
    held = hold_out(ids, "i", 0.1)
    assert held.where("split = 'validation'").count() == validation_count(1000, 0.1) == 100
    owned = ids.withColumn("subject", F.col("i") % 7)
    assert split_by_hash(owned, "subject", 0.5).groupBy("subject").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("part_turns", [1, 3, 1_000])
def test_contexts_in_parts_are_whole(spark, part_turns):
    rows = [(c, k, ("user", "assistant")[k % 2], f"t{c}-{k}") for c in (1, 2, 3) for k in range(3 * c)]
    turns = spark.createDataFrame(rows, "c int, k int, role string, text string").repartition(3)
    got = conversation_contexts(turns, "c", "k", "role", "text", system="S", part_turns=part_turns).collect()
    want = {(c, k): [("system", "S")] + [(r, t) for d, j, r, t in rows if d == c and j <= k] for c, k, role, _ in rows if role == "user"}
    assert {(r.c, r.k): [tuple(m) for m in r.messages] for r in got} == want
    some = conversation_contexts(turns, "c", "k", "role", "text", system="S", part_turns=part_turns, asked=turns.where("k = 2")).collect()
    assert sorted((r.c, r.k) for r in some) == [(1, 2), (2, 2), (3, 2)]


def test_a_long_conversation_lies_in_parts(spark):
    """100,000 turns: lists of bounded length, and a context is as long as its turn says."""
    n = 100_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("c"), F.col("id").alias("k"), role.alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    asked = turns.where("k in (0, 998, 1000, 54322, 99998)").select("c", "k")
    pieces = context_parts(turns, "c", "k", "role", "text", asked=asked)
    assert pieces.agg(F.max(F.size("messages"))).first()[0] == 1_000 and pieces.where("k = 99998").count() == 100
    got = conversation_contexts(turns, "c", "k", "role", "text", system="S", asked=asked)
    for r in got.collect():
        assert [m.text for m in r.messages] == ["S", *[f"t{i}" for i in range(r.k + 1)]]
    assert got.count() == 5
