import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatt.llm.repair import START, audits, best_paths, damaged, joined_paths, op12_structure_repair, repaired, repaired_digests

BLANKS = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def digest(role, text):
    return hashlib.md5((str(len(role.encode())) + ":" + role + text).encode()).hexdigest()


def after_damage(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        role, text = " " if role is None else role, " " if text is None else text
        convs[conv] += []
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, digest(*x[1:]))) for c, r in convs.items()}


def fault_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        tail = text.rstrip(BLANKS)
        out.append(1 if not tail else 2 if (role, text) in seen else 3 if tail[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, audit) by listing: states of the grammar, edits in every order, longest paths first."""
    faults = fault_of(rows)
    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    front = {("", "", ()): 0}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        for _ in range(3):
            for (state, audit, out), cost in list(front.items()):
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in grammar and not audit.endswith("III"):
                        key = (letter, audit + "I", (*out, (name, "")))
                        front[key] = min(cost + 5, front.get(key, 10**9))
        after = {}
        for (state, audit, out), cost in front.items():
            ways = [(state, audit + "D", out, 2)]
            if fault not in (1, 2):
                late = 5 * (fault == 3)
                if (state, role[:1]) in grammar:
                    ways.append((role[:1], audit + "K", (*out, (role, text)), late))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in grammar:
                        ways.append((letter, audit + "R", (*out, (name, text)), 1 + late))
            for state2, audit2, out2, more in ways:
                key = (state2, audit2, out2)
                after[key] = min(cost + more, after.get(key, 10**9))
        keep = {}
        for (state, audit, out), cost in after.items():
            keep.setdefault(state, []).append((cost, audit, out))
        front = {(s, a, o): c for s, found in keep.items() for c, a, o in sorted(found)[:40]}
    done = []
    for (state, audit, out), cost in front.items():
        tail = {"": [], "a": [], "u": [("assistant", "")], "s": [("user", ""), ("assistant", "")]}[state]
        done.append((cost + 5 * len(tail), audit + "I" * len(tail), (*out, *tail)))
    return min(done)


def brute(convs):
    out = []
    for conv, rows in convs.items():
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = fault_of(rows)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, mended = cheapest(rows)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in mended))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in mended).encode()).hexdigest()
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha))
    return sorted(out)


def collected(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def turns(spark):
    def build(rows):
        schema = "conv_id long, turn long, role string, text string, pos long, fault int, slice long, kind string, audit string, copy int"
        return spark.createDataFrame([(*r, 1, 2, 3, "x", "y", 4) for r in rows], schema)

    return build


def of(frame, size):
    rows = damaged(frame)
    found = audits(rows, size)
    return found.join(repaired_digests(rows, found), "conv_id")


def noisy(draw, convs, most):
    texts = ["a.", "b!", "c", " ", "", "long text. ", "x?\n", "Né."]
    return [(c, t, draw.choice(["user", "assistant", "system", "tool", "", None, "usher"]), draw.choice([*texts, None])) for c in range(convs) for t in range(draw.randint(1, most))]


def test_query_against_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op12_structure_repair(spark, small)) == brute(after_damage(rows))


@pytest.mark.parametrize("size", [1, 3, 256])
def test_noisy_conversations(turns, size):
    rows = noisy(random.Random(size), 150, 9)
    kept = {c: r for c, r in after_damage(rows).items() if r}
    assert collected(of(turns(rows), size)) == brute(kept)


def test_nulls_ties_and_repeats(turns):
    rows = [(None, 0, "user", "x."), (1, None, "user", "a."), (1, None, "assistant", "b."), (1, 5, "user", "a."), (1, 5, "user", "a."), (1, 5, "assistant", "c"), (2, None, None, None)]
    assert collected(of(turns(rows), 2)) == brute({c: r for c, r in after_damage(rows).items() if r})


def test_slices_join_to_the_whole():
    draw = random.Random(9)
    for _ in range(400):
        rows = [(draw.choice("sua-"), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(draw.randint(1, 14))]
        whole = joined_paths(iter([{START: best_paths(rows, START)}]))
        cut = draw.randint(1, 4)
        pieces = [{s: best_paths(rows[i : i + cut], s) for s in range(4)} for i in range(0, len(rows), cut)]
        assert joined_paths(iter(pieces)) == whole


def test_long_conversation_and_long_text(turns, spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"line {t}." if t % 7 else f"line {t}") for t in range(3000)] + [(2, 0, "user", "w" * 300_000 + ".")]
    got = {r.conv_id: r for r in of(turns(rows), 64).collect()}
    assert collected(of(turns(rows), 4096)) == sorted(tuple(got[c][n] for n in COLUMNS) for c in got)
    mended = repaired(damaged(turns(rows)), audits(damaged(turns(rows)))).where("conv_id = 1").orderBy("place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in mended))
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mended).encode()).hexdigest()


def test_conversation_that_loses_all_rows(turns, spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    turns([(gone, 0, "user", "a."), (gone + 1, 0, "user", "b.")]).write.parquet(f"{tmp_path}/conversations.parquet")
    row = op12_structure_repair(spark, str(tmp_path)).where(F.col("conv_id") == gone).first()
    assert tuple(row[n] for n in COLUMNS) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(turns):
    assert collected(of(turns([]), 4)) == []
