import re

import duckdb

from tidewatt.llm.licences import BASE, MORE, OP10_SQL, licence_scan, op10_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    def starts(phrase):
        p = phrase.split()
        return [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]

    base = sorted((s, label) for phrase, label in BASE for s in starts(phrase))
    return len(words), base, {label for phrase, label in (*BASE, *MORE) if starts(phrase)}


def test_query_equals_sql(spark, small):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    with duckdb.connect() as connection:
        connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
        want = connection.sql(f"SELECT {', '.join(names)} FROM ({OP10_SQL}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in op10_license_scan(spark, small).select(*names).orderBy("doc_id").collect()] == want


def test_against_brute_force(frame):
    texts = [
        "Released under the MIT License.", "UNDER THE under-the.mit\nlicense! under the mit license", "Apache License, Version 2.0", "cc-by-nc cc by nc 4",
        "GNU General Public License", "under the mit licenses", "the mit license", None, "", "é under the mit license 2é", "under the mit K license",
        "cc by " * 50 + "nc", "cc by nc " * 500, "word " * 20000 + "under the mit license", "0 cc by nc 0", "license version 2 apache license version 2",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[2])]
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_words, sorted(map(tuple, r.base_places)), {f.label for f in r.found}) for r in licence_scan(frame(rows)).collect())
    want = sorted(((i if i is not None else -1), *brute(t)) for i, t in rows)
    assert [(a, b, c) for a, b, c, _ in got] == [(a, b, c) for a, b, c, _ in want]
    assert [d for *_, d in got] == [d for *_, d in want]


def test_empty_table_and_native_plan(spark, small, frame):
    assert licence_scan(frame([])).count() == 0
    plan = op10_license_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", plan)
