import pytest

from tidewatt.llm import toxicity as tox
from tidewatt.llm.toxicity import ClauseScorer, compose, fit_toxicity, op3_toxicity, reject_toxic, toxicity_scores

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scorer():
    return ClauseScorer((("veju*", 0.8),))


@pytest.mark.parametrize(
    ("plain", "other", "more"),
    [
        ("what an idiot here.", "you are an idiot here.", True),
        ("what an idiot here.", "he is not an idiot here.", False),
        ("what an idiot here.", "they said what an idiot here.", False),
        ("I will kill time.", "I will kill you.", True),
        ("not now. idiot", "not idiot", False),
    ],
)
def test_clauses_not_words(scorer, plain, other, more):
    one, two = sum(scorer.clauses(plain)), sum(scorer.clauses(other))
    assert two > one if more else two < one


def test_stems_boundaries_and_threats(scorer):
    assert scorer.clauses("Vejuaire") == [0.8]
    assert scorer.clauses("xvejuaire") == [] and scorer.clauses("") == []
    assert scorer.clauses("kill") == []
    assert len(scorer.clauses("idiot! idiot? idiot")) == 3


def test_composition_equals_running_in_turn():
    parts = (tox.negation(), tox.reported(), tox.threat(), tox.target(), tox.scorer())
    machine = tox.grammar()
    for word in ("pi", "ni", "rni", "tp", "toop", "tooop", "npot", "pooooi", "ooiptrip"):
        states, total, state, composed = [0] * len(parts), 0.0, 0, 0.0
        for symbol in word:
            whole = symbol
            for at, part in enumerate(parts):
                symbol, weight, states[at] = part.step(states[at], symbol)
                total += weight
            _, weight, state = machine.arcs[state, whole]
            composed += weight
        assert composed == pytest.approx(total), word
    assert compose(tox.negation(), tox.reported()).arcs


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = op3_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    wrong = [r for r in rows if r.predicted != r.toxic]
    assert len(rows) > 100 and len(wrong) <= 0.04 * len(rows)
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_nulls_empty_tables_and_missing_labels(spark, frame):
    docs = frame([(1, None), (2, ""), (None, "you idiot, you moron, you scum. you idiot. you loser."), (3, "fine"), (3, "fine")])
    model = fit_toxicity(docs, spark.createDataFrame([(None, None, None), (1, 1, 0)], LABELS))
    got = {r.doc_id: r.score for r in toxicity_scores(docs.withColumnsRenamed({"id": "sum", "row": "most", "node": "rate"}), model).collect()}
    assert got[1] == got[2] == got[3] < 0.5 < got[None]
    kept = reject_toxic(docs, model).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3, 3] and kept[0].node == "y"
    empty = fit_toxicity(frame([]), spark.createDataFrame([], LABELS))
    assert reject_toxic(frame([]), empty).count() == 0


def test_lexicon_does_not_depend_on_when_counts_are_handed_on(spark, monkeypatch):
    rows = [(f"fine words number {n} here", 0) for n in range(40)] + [(f"you vejuaire number {n}", 1) for n in range(40)]
    sample = spark.createDataFrame(rows, "text string, label int").coalesce(1)
    whole = tox.learned_lexicon(sample)
    monkeypatch.setattr(tox, "FLUSH", 5)
    assert whole and tox.learned_lexicon(sample) == whole
    assert tox.learned_lexicon(sample.limit(0)) == ()
