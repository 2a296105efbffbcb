import itertools
import random
import tracemalloc
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatt.llm import packing
from tidewatt.llm.packing import BinCompletion, IdTable, _hashes, dominated, op5_best_fit_packing, packed

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(tokenizer):
    draw = random.Random(3)
    bits = [" ", "\n", "a", "b", "É", "é", "́", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "\x1c", "\x85", "\xa0", "\t", "İ", "ß", "9", "日", "🙂", ".", "!!", "THE", "and,", "x.y,", "it's."]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    same_ids(tokenizer, texts, IdTable(PATH, size=200))


def same_ids(tokenizer, texts, table):
    for low in range(0, len(texts), 100):
        part = texts[low : low + 100]
        ids, stops = table.ids([t.encode() for t in part])
        for text, found in zip(part, np.split(ids, stops[:-1]), strict=True):
            assert found.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0], text


def test_letters_that_composing_or_lowering_splits(tokenizer):
    """Every letter whose composed, lowered form is not all letters, before and after other marks."""
    odd = [c for c in map(chr, range(128, 0x20000)) if c.isalpha() and not unicodedata.normalize("NFC", c).lower().isalpha()]
    assert len(odd) > 50
    texts = [form.format(c) for c in odd for form in ("{}", "{}.", "{},", "a{}.", "{}b, x", "{}{}".replace("{}{}", "{0}{0}."))]
    same_ids(tokenizer, texts, IdTable(PATH))


def test_settled_tables_keep_what_was_met_again(tokenizer):
    table = IdTable(PATH)
    same_ids(tokenizer, ["once upon", "twice told twice"] * 60 + ["twice new"], table)
    before = sum(map(len, table.tables))
    table.settle()
    assert 0 < sum(map(len, table.tables)) < before
    same_ids(tokenizer, ["twice told", "once upon a time", "x", ""] * 40, table)


def test_hashes_of_a_chunk_take_little_memory_and_depend_on_the_stretch_alone():
    words = np.frombuffer(b"once upon a time " * 60_000 + b"x" * 300_000 + b" once", dtype=np.uint8)
    edge = np.flatnonzero(np.diff((words != 32).astype(np.int8), prepend=0, append=0))
    starts, ends = edge[0::2], edge[1::2]
    _hashes(words, starts, ends)
    packing._powers.clear()
    tracemalloc.start()
    found = _hashes(words, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The terms of the whole chunk alone would take 8 bytes for each of its 1.3 million, several times.
    assert peak < 2 * 16 * len(starts) + 32 * 1_000_000
    for one in found:
        assert len(set(one[:-2:4].tolist())) == 1 and one[0] == one[-1]
        assert len(set(one.tolist())) == 5


def test_long_stretches_and_many_chunks(tokenizer):
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdeé.,'") for _ in range(draw.choice([1, 3, 8, 63, 64, 65, 300]))) for _ in range(400)]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 30))) for _ in range(600)]
    same_ids(tokenizer, texts, IdTable(PATH, size=150))


def pieces_of(tokenizer, text, capacity=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    return [(at // capacity, at, ids[at : at + capacity]) for at in range(0, len(ids), capacity)]


def check(rows, tokenizer, got, capacity=2048):
    want = Counter(
        (doc_id, piece, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for doc_id, text in rows
        for piece, start, ids in pieces_of(tokenizer, text, capacity)
    )
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query_packs_the_whole_table(spark, small, sample, tokenizer):
    got = op5_best_fit_packing(spark, small).collect()
    total = sum(r.length for r in got)
    assert check(sample, tokenizer, got) <= -(-total // 2048) + 2


def test_hot_length_nulls_and_repeats(frame, tokenizer):
    rows = [(i, "one two three") for i in range(3000)] + [(1, None), (1, None), (2, ""), (None, "word " * 5000)]
    check(rows, tokenizer, packed(frame(rows), PATH).collect())
    assert packed(frame([]), PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_branch_and_bound_beats_or_meets_best_fit(seed):
    draw = random.Random(seed)
    counts = Counter(draw.choice([draw.randint(20, 60), draw.randint(1, 100)]) for _ in range(40))
    solver = BinCompletion(counts, 100, steps=2000)
    plan, greedy = solver.solve(), solver.best_fit(solver.counts)
    assert solver.bound <= plan.bins <= greedy.bins
    used = Counter()
    for filling, times in plan.fillings:
        assert sum(filling) <= 100
        used.update({length: n * times for length, n in Counter(filling).items()})
    assert used == counts


def test_search_improves_on_best_fit():
    # Best fit fills 6+4 first; the optimum pairs 6+2+2 and 4+3+3.
    counts = {6: 2, 4: 2, 3: 4, 2: 4}
    solver = BinCompletion(counts, 10)
    assert solver.solve().bins == solver.bound == 4


def test_perfectly_packable_cases_are_packed_perfectly():
    draw = random.Random(11)
    for case in range(300):
        bins = draw.randint(3, 5)
        counts = Counter()
        for _ in range(bins):
            cuts = sorted(draw.sample(range(1, 100), draw.randint(2, 4)))
            counts.update(b - a for a, b in zip([0, *cuts], [*cuts, 100], strict=True))
        assert BinCompletion(counts, 100).solve().bins == bins, (case, counts)


def optimum(pieces, capacity):
    """Fewest bins by trying every bin for every piece."""
    best = len(pieces)

    def place(at, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if at == len(pieces):
            best = len(loads)
            return
        for i in range(len(loads)):
            if loads[i] + pieces[at] <= capacity and loads[i] not in loads[:i]:
                place(at + 1, [*loads[:i], loads[i] + pieces[at], *loads[i + 1 :]])
        place(at + 1, [*loads, pieces[at]])

    place(0, [])
    return best


def test_small_cases_are_optimal():
    draw = random.Random(12)
    for _ in range(150):
        pieces = sorted((draw.randint(1, 14) for _ in range(draw.randint(1, 11))), reverse=True)
        assert BinCompletion(Counter(pieces), 20).solve().bins == optimum(pieces, 20), pieces


def test_dominance():
    """A filling is dominated exactly if a piece left out can take the place of some members."""
    draw = random.Random(13)
    for _ in range(2000):
        members = tuple(sorted((draw.randint(1, 9) for _ in range(draw.randint(0, 5))), reverse=True))
        waste, out = draw.randint(0, 6), [draw.randint(1, 15) for _ in range(draw.randint(0, 3))]
        want = False
        for size in range(len(members) + 1):
            for some in itertools.combinations(members, size):
                for x in out:
                    longer = x > sum(some) if size < 2 else x >= sum(some)
                    want |= longer and x <= sum(some) + waste
        assert dominated(members, waste, sum(1 << x for x in set(out))) == want


def test_completions_are_all_that_are_not_dominated():
    solver = BinCompletion({7: 1, 5: 1, 3: 2, 2: 3, 1: 2}, 15)
    got = set(solver.completions(solver.counts, 15))
    pool = [5, 3, 3, 2, 2, 2, 1, 1]
    want = set()
    for size in range(len(pool) + 1):
        for some in set(itertools.combinations(pool, size)):
            left = (Counter(pool) - Counter(some)).keys()
            if sum(some) <= 8 and not dominated(some, 8 - sum(some), sum(1 << x for x in left if x <= 8)):
                want.add((7, *some))
    assert got == want


def test_many_equal_pieces_stay_fast():
    solver = BinCompletion({700: 300_000, 650: 300_000, 400: 10**6, 9: 10**7}, 2048)
    assert solver.bound <= solver.solve().bins <= solver.best_fit(solver.counts).bins
    wide = BinCompletion({length: 3 for length in range(900, 2048)}, 2048, steps=3000)
    assert wide.bound <= wide.solve().bins <= wide.best_fit(wide.counts).bins
