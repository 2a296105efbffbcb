import random

import pytest

from tidewatt.llm import decontam
from tidewatt.llm.decontam import ItemIndex, leaks, normal, op1_decontamination, window_size, without_leaks


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        left, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (p != t))
    return min(row), row.index(min(row))


def words(draw, count):
    return " ".join("".join(draw.choice("abcdefghijklm") for _ in range(draw.randint(2, 9))) for _ in range(count))


def edited(draw, text, rate):
    out = []
    for c in text:
        kind = draw.random()
        out.append(c if kind >= rate else draw.choice(["", c + draw.choice("xyz"), draw.choice("xyz")]))
    return "".join(out)


def test_bit_vectors_equal_dynamic_programming():
    draw = random.Random(1)
    for _ in range(150):
        pattern = "".join(draw.choice("abc ") for _ in range(draw.randint(1, 70))).encode()
        text = "".join(draw.choice("abc ") for _ in range(draw.randint(0, 120))).encode()
        assert ItemIndex(((0, pattern),), 0.2).distance(0, text) == edit_distance_inside(pattern, text)


def test_every_passage_holds_a_whole_window():
    for length in range(1, 700):
        size = window_size(length)
        assert all((-start % size) + size <= length for start in range(size))


@pytest.mark.parametrize(("rate", "recall"), [(0, 1.0), (0.02, 0.99), (0.05, 0.97), (0.1, 0.9)])
def test_recall_of_edited_passages(rate, recall):
    draw = random.Random(7)
    items = tuple((i, normal(words(draw, draw.randint(15, 60)).encode())) for i in range(100))
    index = ItemIndex(items, 0.2)
    texts = [normal(f"{words(draw, 40)} {edited(draw, text.decode(), rate)} {words(draw, 30)}".encode()) for _, text in items]
    found = index.verified(texts)
    assert sum((i, i) in found for i in range(100)) >= recall * 100
    assert all(text == item for text, item in found)


def test_whole_table_against_brute_force(spark, small, sample):
    items = [(r.item_id, normal(r.text.encode())) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {(i, k) for i, t in sample for k, text in items if text in normal((t or "").encode())}
    got = op1_decontamination(spark, small).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.distance == 0} == want and want
    texts = {i: normal((t or "").encode()) for i, t in sample}
    for r in got:
        assert edit_distance_inside(dict(items)[r.item_id], texts[r.doc_id])[0] == r.distance


def test_short_items_nulls_repeats_and_blocks(spark, frame, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 64)
    draw = random.Random(3)
    passage = words(draw, 20)
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (4, "tiny"), (5, words(draw, 30)), (None, words(draw, 25))], "item_id long, text string")
    rows = [(1, f"x\n{passage.upper()}  y"), (1, f"x\n{passage.upper()}  y"), (2, None), (3, ""), (None, passage), (4, "a tiny b"), (5, words(draw, 80))]
    got = sorted((r.doc_id or 0, r.item_id) for r in leaks(frame(rows), bench).collect())
    assert got == [(0, 1), (1, 1), (1, 1), (4, 4)]
    clean = without_leaks(frame(rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 5] and clean.columns == frame(rows).columns
    assert leaks(frame([]), bench).count() == 0
    assert leaks(frame(rows), bench.limit(0)).count() == 0 and without_leaks(frame(rows), bench.limit(0)).count() == 7


def test_item_ids_of_any_type(spark, frame):
    text = " ".join(f"word{i}" for i in range(20))
    docs = frame([(1, "before " + text + " after")])
    for kind, value in (("int", 7), ("string", "seven"), ("long", 7), ("short", 7)):
        items = spark.createDataFrame([(value, text)], f"item_id {kind}, text string")
        assert [(r.item_id, r.distance) for r in leaks(docs, items).collect()] == [(value, 0)]
