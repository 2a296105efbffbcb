import hashlib
from collections import defaultdict

from tidewatt.llm.lines import drop_repeated_lines, keep_bitmap, kept_lines, line_bitmaps, line_digest, op4_line_dedup

LONG = "A line that is long enough to be counted as a key"


def brute(rows, min_chars=40, enough=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), ())) < enough or doc_id == max((h for h in holders[key(x)] if h is not None), default=None)]
        out.append((doc_id, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


def digest(docs):
    return [tuple(r) for r in line_digest(docs, line_bitmaps(docs)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_against_brute_force(spark, small, sample):
    got = [tuple(r) for r in op4_line_dedup(spark, small).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert order(got) == order(brute(sample))


def test_hot_line_ties_nulls_and_repeated_rows(frame):
    rows = [(i, f"{LONG}\nown {i}\n  {LONG.upper()}\t") for i in range(1500)]
    rows += [(5000, None), (5001, ""), (None, LONG), (7, rows[7][1]), (5002, "short\nshort"), (4, "É" * 40), (6000, "é" * 39)]
    rows += [(6001 + i, "x" * 39 + "\n" + "y" * 40) for i in range(5)]
    assert order(digest(frame(rows))) == order(brute(rows))


def test_fewer_than_five_documents_keep_their_lines(frame):
    rows = [(i % 4, LONG + "\n" + LONG) for i in range(8)]
    assert all(r[2] == 0 for r in digest(frame(rows)))


def test_dropped_lines_leave_other_columns(frame):
    rows = [(i, f"{LONG}\nrest") for i in range(5)] + [(9, None)]
    got = drop_repeated_lines(frame(rows)).select("doc_id", "text", "id", "key").collect()
    assert sorted((r.doc_id, r.text) for r in got) == [*((i, "rest") for i in range(4)), (4, f"{LONG}\nrest"), (9, None)]
    assert {(r.id, r.key) for r in got} == {(None, "z")}


def test_bitmap_round_trip():
    lines = list(range(30))
    assert kept_lines(lines, keep_bitmap([0, 7, 8, 20])) == [n for n in lines if n not in (0, 7, 8, 20)]
    assert kept_lines(lines, None) == lines


def test_empty_table(frame):
    assert digest(frame([])) == []
