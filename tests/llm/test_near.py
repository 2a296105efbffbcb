import random
from collections import defaultdict

import numpy as np

from tidewatt.llm.components import components
from tidewatt.llm.near import SKETCH, _common, half_keys, near_duplicates, one_of_each, op8_minhash_near_dedup, shingle_sets, sketch, table_keys


def sets_of(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute(rows, words, percent=80):
    sets = [(doc_id, sets_of(text, words)) for doc_id, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for number, (_, own) in enumerate(sets):
        for shingle in own:
            holders[shingle].append(number)
    pairs = {(a, b) for members in holders.values() for a in members[:50] for b in members if a < b}
    for a, b in pairs:
        (i, one), (j, two) = sets[a], sets[b]
        if 100 * len(one & two) >= percent * len(one | two):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    return sorted((i, len(own), root(i), root(i) == i) for i, own in sets)


def result(found):
    return sorted(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_whole_table_against_brute_force(spark, small, sample):
    assert result(op8_minhash_near_dedup(spark, small)) == brute(sample, 4)


def test_groups_of_copies_and_chains(frame):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 420):
        text = list(base)
        text[draw.randrange(120)] = word()
        rows.append((i, " ".join(text)))
    chain = [word() for _ in range(100)]
    for i in range(500, 515):
        rows.append((i, " ".join(chain)))
        chain = chain[2:] + [word(), word()]
    rows += [(600 + i, " ".join(word() for _ in range(50))) for i in range(40)]
    assert result(near_duplicates(frame(rows))) == brute(rows, 5)


def test_links_inside_a_large_group_just_below_the_limit(frame):
    """1500 texts of one template at 0.798 to each other; only twins are above 0.8."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(8))
    template, rows = [word() for _ in range(154)], []
    for twin in range(750):
        shared = [word() for _ in range(10)]
        rows += [(10 * twin + own, " ".join([*template, *shared, *(word() for _ in range(9))])) for own in (0, 5)]
    sets = [sets_of(text, 5) for _, text in rows]
    assert 150 / 188 < 0.8 and len(sets[0] & sets[2]) == 150 and len(sets[0] | sets[2]) == 188
    assert len(sets[0] & sets[1]) == 160 and len(sets[0] | sets[1]) == 178
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(rows)).collect()}
    assert got == {doc_id: doc_id - doc_id % 10 for doc_id, _ in rows}


def test_common_shingles_over_many_columns():
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 20_000, n, dtype=np.uint64)) for n in (1, 50, 9000, 15_000, 0, 12_000)]
    expected = [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets]
    assert _common(sets, sets[2:]).tolist() == expected


def test_a_shared_table_key_is_a_shared_half_key():
    draw = np.random.default_rng(7)
    for _ in range(50):
        shared, one, two = (draw.integers(0, 1 << 63, n, dtype=np.uint64) for n in (400, 100, 100))
        both = np.stack([sketch(np.concatenate([shared, own])) for own in (one, two)])
        keys, halves = table_keys(both), half_keys(both)
        assert not set(keys[0]) & set(keys[1]) or set(halves[0]) & set(halves[1])


def test_short_null_empty_and_repeated(frame):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one"), (None, "one two"), (7, "x"), (7, "x")]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(rows)).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (None, 1, None, True), (7, 1, 7, True)}
    stay = one_of_each(frame(rows))
    assert sorted(r.doc_id or 0 for r in stay.collect()) == [0, 1, 2, 3, 4, 6, 7]
    assert stay.columns == frame(rows).columns
    assert near_duplicates(frame([])).count() == 0


def test_an_id_with_two_texts_is_one_document(frame):
    one, two = " ".join("abcdefghij"), " ".join("klmnopqrst")
    rows = [(1, one), (5, one), (5, two), (9, two)]
    assert {r.component_id for r in near_duplicates(frame(rows)).collect()} == {1}


def test_recall_at_the_threshold():
    draw, missed = np.random.default_rng(4), 0
    for _ in range(200):
        shared, one, two = (draw.integers(0, 1 << 63, n, dtype=np.uint64) for n in (400, 50, 50))
        both = np.stack([sketch(np.concatenate([shared, own])) for own in (one, two)])
        assert both.shape == (2, SKETCH)
        keys = table_keys(both)
        missed += not set(keys[0]) & set(keys[1])
    assert missed <= 4


def test_shingles_do_not_cross_texts():
    got = list(shingle_sets([b"a b c", b"d e f", b"A  B\tc"], 2))
    assert [len(s) for s in got] == [2, 2, 2] and (got[0] == got[2]).all() and not set(got[0]) & set(got[1])


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and {got[i] for i in range(100, 150)} == {100} and got[201] == 200
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
