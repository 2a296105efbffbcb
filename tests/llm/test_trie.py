import hashlib
import random
import zlib
from collections import defaultdict
from decimal import Decimal

import pytest

from tidewatt.llm.trie import hashed_ids, op11_prefix_trie, prefix_trie, rebuilt, turn_steps

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """conv -> [(role, text)] with nulls first and ties by digest, as the docstring says."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            said = (str(len(role.encode())) + ":" + role + text).encode()
            convs[conv].append((turn is not None, turn or 0, hashlib.md5(said).hexdigest(), role, text))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in convs.items()}


def rebuild(convs):
    out = {}
    for conv, turns in convs.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        out[conv] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children, out = defaultdict(list), []
    for path in members:
        if path:
            children[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children[path]]
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        sums[path] = (sum(b[0] for b in below) or 1 if below else 1, own + sum(b[1] for b in below))
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), len(children[path]), *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def collected(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def turns(spark):
    def build(rows):
        schema = "conv_id long, turn long, role string, text string, owner long, depth long, digest string, pos string, hi long, block long"
        return spark.createDataFrame([(*r, 1, 2, "x", "y", 3, 4) for r in rows], schema)

    return build


def of(frame, **args):
    steps = turn_steps(frame)
    return collected(prefix_trie(steps, steps.select("conv_id"), **args))


def test_query_against_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op11_prefix_trie(spark, small)) == brute(rebuild(ordered(rows)))


@pytest.mark.parametrize("block", [1, 4, 50])
def test_random_tries(turns, block):
    draw = random.Random(block)
    rows = [(c, t, draw.choice("ua"), draw.choice(["", "x", "é"])) for c in range(60) for t in range(draw.randint(1, 9))]
    rows += [(c, t, "u", "same") for c in range(100, 140) for t in range(30 + (c == 120) * 30)]
    assert of(turns(rows), block=block) == brute(ordered(rows))


def test_rebuilt_conversations_of_any_sign(turns):
    draw = random.Random(5)
    rows = [(c, t, "u", f"{c} {t}") for c in range(-12, 12) for t in range(draw.randint(1, 10)) if c not in (-5, 10)]
    steps = turn_steps(turns(rows))
    assert collected(prefix_trie(rebuilt(steps), steps.select("conv_id"))) == brute(rebuild(ordered(rows)))


def test_nulls_ties_repeats_and_long_texts(turns):
    rows = [(1, None, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "a", "b"), (None, 0, "u", "x"), (2, None, "", ""), (2, 0, "u", "a"), (3, 7, "u", "y" * 200_000)]
    assert of(turns(rows)) == brute(ordered(rows))


def test_caterpillar(turns):
    """Every conversation leaves the one before it a turn later: a chain tree as deep as it gets."""
    rows = [(c, t, "u", str(t) if t < 40 - c else f"own {c}") for c in range(40) for t in range(41 - c)]
    rows += [(40 + c, t, "u", str(t) if t < c else f"up {c}") for c in range(20) for t in range(c + 3)]
    assert of(turns(rows)) == brute(ordered(rows))


def test_one_long_conversation_over_many_spans(turns, monkeypatch):
    monkeypatch.setattr("tidewatt.llm.turns.running.__defaults__", (8,))
    rows = [(1, t, "u", str(t)) for t in range(500)] + [(2, t, "u", str(t) if t < 333 else "z") for t in range(400)]
    assert of(turns(rows)) == brute(ordered(rows))


def test_empty_table(turns):
    assert of(turns([])) == []


def test_ids_in_pieces(spark):
    ends = spark.createDataFrame([(d, Decimal(0), Decimal(0), i) for d, n in ((0, 1), (1, 500), (2, 64)) for i in range(n)], "depth long, hi decimal(38,0), lo decimal(38,0), conv_id long")
    got = {r.depth: r.ends_sha256 for r in hashed_ids(ends.repartition(7), piece=8).collect()}
    assert got == {d: hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest() for d, n in ((0, 1), (1, 500), (2, 64))}
