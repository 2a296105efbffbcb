import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatt.llm import language
from tidewatt.llm.language import DEPTH, language_scores, log_gamma, op9_language_scores


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def decisions(word):
    symbols = [256] * DEPTH + list(word if word == b"\n" else word + b" ")
    for at in range(DEPTH, len(symbols)):
        context = tuple(symbols[at - DEPTH : at][::-1])
        for bit in range(8):
            yield context, 1 << bit | symbols[at] >> (8 - bit), symbols[at] >> (7 - bit) & 1


class Brute:
    """The context tree over Python dicts, node by node."""

    def __init__(self, counts):
        nodes = defaultdict(lambda: [0, 0])
        for word, n in counts.items():
            for context, prefix, bit in decisions(word):
                for depth in range(DEPTH + 1):
                    nodes[context[:depth], prefix][bit] += n
        below, self.share = defaultdict(float), {}
        for key in sorted(nodes, key=lambda k: -len(k[0])):
            zeros, ones = nodes[key]
            own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
            value, self.share[key] = own, 1.0
            if len(key[0]) < DEPTH:
                value = np.logaddexp(own, below[key]) - math.log(2)
                self.share[key] = math.exp(own - math.log(2) - value)
            if key[0]:
                below[key[0][:-1], key[1]] += value
        self.nodes = nodes

    def word(self, word):
        total = 0.0
        for context, prefix, bit in decisions(word):
            chance = None
            for depth in range(DEPTH, -1, -1):
                key = context[:depth], prefix
                counts = self.nodes.get(key, (0, 0))
                own = (counts[bit] + 0.5) / (sum(counts) + 1)
                share = self.share.get(key, 0.5)
                chance = own if depth == DEPTH else share * own + (1 - share) * chance
            total += math.log10(chance)
        return total


@pytest.mark.parametrize("bounds", [(100_000, 200_000), (50, 100)])
def test_query_against_brute_force(spark, small, sample, monkeypatch, bounds):
    """Also with bounds so small that most words and contexts take the join."""
    monkeypatch.setattr(language, "TOP_WORDS", bounds[0])
    monkeypatch.setattr(language, "TOP_CONTEXTS", bounds[1])
    train = Counter(w for i, t in sample if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens(t))
    total, distinct, tree = sum(train.values()), len(train), Brute(train)
    got = {r.doc_id: r for r in op9_language_scores(spark, small).collect()}
    assert len(got) == len(sample)
    for doc_id, text in sample[:40]:
        words, row = tokens(text), got[doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(w in train for w in words), total)
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 7 == 2)
        assert row.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in words), abs=1e-6)
        assert row.score == pytest.approx(sum(map(tree.word, words)), abs=1e-5)


def test_a_word_has_less_probability_than_its_first_byte_allows(frame):
    """The byte distribution of a context sums to one: no two words share mass."""
    rows = [(i, "ab ac ab b") for i in range(6)]
    got = language_scores(frame([*rows, *((10 + n, chr(n)) for n in range(33, 127))]), F.col("doc_id") < 10).collect()
    end = next(r.score for r in language_scores(frame([*rows, (9, "")]), F.col("doc_id") < 9).collect() if r.doc_id == 9)
    assert sum(10 ** (r.score - end) for r in got if r.doc_id >= 10) < 1


def test_nulls_repeats_no_training_and_empty_table(frame):
    rows = [(1, None), (2, ""), (3, "x y"), (3, "x y"), (None, "x y")]
    got = language_scores(frame(rows), F.lit(True)).collect()
    assert len(got) == 5
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].score == by_id[2].score and by_id[1].n_tokens == 1 and by_id[3].n_tokens == 3
    assert len({round(r.score, 9) for r in got if r.n_tokens == 3}) == 1
    none = language_scores(frame(rows), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)
    assert language_scores(frame([]), F.lit(True)).count() == 0


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.5, 1e6])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)


def stream_decisions(text):
    """As ``decisions``, over the whole stream of a text: contexts reach across blanks."""
    symbols = [256] * DEPTH + list(b" ".join(tokens(text)))
    for at in range(DEPTH, len(symbols)):
        context = tuple(symbols[at - DEPTH : at][::-1])
        for bit in range(8):
            yield context, 1 << bit | symbols[at] >> (8 - bit), symbols[at] >> (7 - bit) & 1


@pytest.mark.parametrize("bounds", [(100_000, 1_000_000, 1 << 19, 1 << 21, 2_500_000), (50, 100, 300, 2_000, 1_000)])
def test_contexts_reach_across_words(spark, small, sample, monkeypatch, bounds):
    """Against brute force; also with most contexts joined, texts cut and contexts handed on early."""
    for name, bound in zip(("TOP_WORDS", "TOP_CONTEXTS", "CHUNK_BYTES", "SORTED", "SUMMED"), bounds, strict=True):
        monkeypatch.setattr(language, name, bound)
    monkeypatch.setitem(globals(), "decisions", stream_decisions)
    rows = [(i, t) for i, t in sample if len(t or "") < 3000][:60] + [(-1, None), (-2, " \t"), (-3, "x" * 700)]
    tree = Brute(Counter(t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in language_scores(frame, F.crc32(F.col("doc_id").cast("string")) % 7 != 2).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        expected, size = tree.word(text), len(b" ".join(tokens(text)))
        assert got[doc_id].score == pytest.approx(expected, abs=1e-5)
        assert got[doc_id].bits_per_byte == pytest.approx(-expected / math.log10(2) / size, abs=1e-6)


def test_order_of_words_changes_the_score(frame):
    rows = [(i, "the cat sat on the mat") for i in range(5)]
    got = language_scores(frame([*rows, (8, "the cat sat on the mat"), (9, "mat the on sat cat the")]), F.col("doc_id") < 8).collect()
    score = {r.doc_id: r.score for r in got}
    assert score[8] > score[9] + 1
