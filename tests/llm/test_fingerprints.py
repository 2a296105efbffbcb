import hashlib
import random
import re

from tidewatt.llm.fingerprints import edited_fingerprints, op7_order_minhash


def wanted(rows):
    """(n_chars, sha) of each distinct id; ids here are distinct."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for at, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        cut = len(text) // 3
        out[doc_id] = (len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest())
    return out


def test_query_over_whole_table(spark, small, sample):
    got = op7_order_minhash(spark, small).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == wanted(sample)
    prints = {}
    for r in got:
        prints.setdefault(dict(sample)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for p in prints.values()}) == len(prints)
    long = [r for r in got if r.n_chars > 1000]
    assert sum(r.near_edited for r in long) / len(long) > 0.2 > 0.02 > sum(r.near_next for r in long) / len(long)


def test_order_matters_and_repeats_count(frame):
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdef") for _ in range(6)) for _ in range(300)]
    halves = words[150:] + words[:150]
    rows = [(4, " ".join(words)), (3, " ".join(words[:295])), (2, " ".join(words)), (1, " ".join(halves))]
    near = {r.doc_id: r.near_next for r in edited_fingerprints(frame(rows)).collect()}
    # An edit at the end changes little; the same k-mers in another order change much.
    assert near[4] > 0.9 > 0.7 > near[2] > 0.3
    twice = {r.doc_id: r.near_next for r in edited_fingerprints(frame([(2, "a b " * 40), (1, "a b " * 80)])).collect()}
    assert twice[2] < 0.9


def test_nulls_empty_single_and_repeated(frame):
    rows = [(5, None), (4, ""), (3, "one two three"), (None, "é" * 9), (2, "x")]
    got = edited_fingerprints(frame(rows)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == wanted(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].fingerprint == by_id[4].fingerprint and by_id[5].near_next == 1.0
    alone = edited_fingerprints(frame([(1, "a b c d e f")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    again = edited_fingerprints(frame([(1, "a b c"), (1, "a b c"), (0, "d e f")])).collect()
    assert len(again) == 3 and len({r.edited_sha256 for r in again if r.doc_id == 1}) == 1
    assert edited_fingerprints(frame([])).count() == 0


def test_native_plan(spark, small):
    plan = op7_order_minhash(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
