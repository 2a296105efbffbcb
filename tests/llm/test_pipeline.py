import hashlib
import importlib
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from test_decontam import words
from test_lines import brute as brute_lines
from test_near import brute as brute_near

from tidewatt.llm.common import kept
from tidewatt.llm.decontam import normal

ROOT = Path(__file__).resolve().parents[2]


def test_stages_on_the_smallest_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    items = [normal(r.text.encode()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = kept(stage(spark, docs, small), f"test-{name}")
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in rows}
            assert after.keys() <= before.keys()
        if name == "toxicity":
            assert sum(1 for i in before.keys() - after.keys() if labels.get(i) == 0) <= 1
        if name == "line_dedup":
            want = {i: h for i, _, _, h in brute_lines(list(before.items()))}
            assert {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "near_dedup":
            assert set(after) == {i for i, _, _, keep in brute_near(list(before.items()), 5) if keep}
        if name == "decontamination":
            dirty = {i for i, t in before.items() if any(x in normal(t.encode()) for x in items)}
            assert before.keys() - after.keys() == dirty
        if name == "packing":
            assert {r.doc_id for r in rows} == set(before)
    assert corpus_pipeline.run(spark, small).count() == len(rows)


def test_nulls_clashing_columns_and_empty_table(spark, small, frame):
    import random

    text = words(random.Random(1), 30)
    docs = frame([(1, None), (2, ""), (None, text), (3, text), (3, text), (4, text)])
    for start, expected in ((docs, 3), (frame([]), 0)):
        found = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = kept(stage(spark, found, small), f"odd-{name}")
            assert found.columns == start.columns
        assert found.count() == expected + (expected > 0)
        assert kept(corpus_pipeline.STAGES[-1][1](spark, found, small), "odd-packing").count() == found.count()


def test_registration_and_independence():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    code = "import sys; sys.modules['tidewatt.llm'] = None; import tidewatt.registry.queries, tidewatt.session; print(not [m for m in sys.modules if m.startswith('tidewatt.llm.')])"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "True"
