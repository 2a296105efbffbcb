"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes (insult, threat, target, negation, reported speech, other). Four small
transducers over classes are composed into one machine; it reads a clause and adds up the
weights of what it matches there. A document's score is calibrated from its clauses.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.common import as_text, documents, giving_back, table
from tidewatt.llm.labels import held_out, labelled_sample, logistic, sigmoid

SAMPLE = 20_000
#: Entries a task counts before it hands them on, and texts that it holds as Python strings.
FLUSH, TEXTS = 50_000, 500
#: Entries of the learned lexicon, and candidates for it that reach the driver.
LEXICON, CANDIDATES = 256, 4_000
THRESHOLD = 0.7
STEMS = range(3, 9)
#: A learned entry has this many words per toxic text of the sample, and log odds this high.
SUPPORT, LOG_ODDS = 0.02, 2.5
PRIOR = (2.0, 0.5, 0.0, -2.5)

# Seed classes; the labels add insults of any language as words or stems.
INSULTS = frozenset("idiot moron loser scum imbecile stupid pathetic worthless disgusting trash clown".split())
THREATS = frozenset("kill hurt destroy murder beat shoot stab burn hang attack".split())
TARGETS = frozenset("you your youre u ur he she they them him her his their".split())
NEGATIONS = frozenset("not no never nobody none cannot isnt arent wasnt dont doesnt didnt without".split())
REPORTED = frozenset('said says say called calls wrote writes reported quoted claims claimed according "'.split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "o", "i", "t", "p", "n", "r"
SHIELDED, AIMED, MENACE = "s", "a", "m"
ALPHABET = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, SHIELDED, AIMED, MENACE)


@dataclass
class Transducer:
    """Arcs: (state, symbol read) -> (symbol written, weight, next state). State 0 starts.

    A symbol without an arc passes unchanged, without weight, and leads to ``rest[state]``.
    """

    arcs: dict[tuple[object, str], tuple[str, float, object]]
    rest: dict[object, object] = field(default_factory=dict)

    def step(self, state: object, symbol: str) -> tuple[str, float, object]:
        return self.arcs.get((state, symbol)) or (symbol, 0.0, self.rest.get(state, state))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``first`` writes is what ``second`` reads; weights add. Only reachable states."""
    arcs, todo, seen = {}, [(0, 0)], {(0, 0): 0}
    while todo:
        pair = todo.pop()
        for symbol in ALPHABET:
            middle, one, left = first.step(pair[0], symbol)
            written, two, right = second.step(pair[1], middle)
            if (left, right) not in seen:
                seen[left, right] = len(seen)
                todo.append((left, right))
            arcs[seen[pair], symbol] = (written, one + two, seen[left, right])
    return Transducer(arcs)


def _countdown(reach: int) -> dict[object, object]:
    return {state: state - 1 for state in range(1, reach + 1)}


def negation(reach: int = 3) -> Transducer:
    """An insult or threat up to ``reach`` words after a negation is shielded."""
    arcs = {(state, NEGATION): (NEGATION, 0.0, reach) for state in range(reach + 1)}
    arcs |= {(state, s): (SHIELDED, 0.0, 0) for state in range(1, reach + 1) for s in (INSULT, THREAT)}
    return Transducer(arcs, _countdown(reach))


def reported() -> Transducer:
    """After a verb of saying or a quotation mark, the rest of the clause is shielded."""
    arcs = {(0, REPORT): (REPORT, 0.0, 1)}
    arcs |= {(1, s): (SHIELDED, 0.0, 1) for s in (INSULT, THREAT)}
    return Transducer(arcs)


def target(reach: int = 4) -> Transducer:
    """An insult within ``reach`` words after a target is aimed at it."""
    arcs = {(state, TARGET): (TARGET, 0.0, reach) for state in range(reach + 1)}
    arcs |= {(state, INSULT): (AIMED, 0.0, state - 1) for state in range(1, reach + 1)}
    return Transducer(arcs, _countdown(reach))


def threat(reach: int = 3) -> Transducer:
    """A threat becomes one when a target follows within ``reach`` words."""
    arcs = {(state, THREAT): (OTHER, 0.0, reach) for state in range(reach + 1)}
    arcs |= {(state, TARGET): (MENACE, 0.0, 0) for state in range(1, reach + 1)}
    return Transducer(arcs, _countdown(reach))


def scorer() -> Transducer:
    """Weights of what is left when the other transducers have read the clause."""
    weights = {INSULT: 1.0, AIMED: 1.5, MENACE: 1.5, SHIELDED: 0.1}
    return Transducer({(0, symbol): (symbol, weight, 0) for symbol, weight in weights.items()})


def grammar() -> Transducer:
    return reduce(compose, (negation(), reported(), threat(), target(), scorer()))


_WORDS = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|\"")
_ENDS = re.compile(r"[.!?;\n]")


class ClauseScorer:
    """Finds the clauses with an insult or threat and runs the composed machine over them."""

    def __init__(self, lexicon: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.machine = grammar().arcs
        self.words = {w: (THREAT, 1.0) for w in THREATS} | {w: (INSULT, 1.0) for w in INSULTS}
        self.stems: dict[str, float] = {}
        for entry, weight in lexicon:
            if entry.endswith("*"):
                self.stems[entry[:-1]] = weight
            else:
                self.words[entry] = (INSULT, weight)
        self.context = {w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTED}
        self.triggers = ahocorasick.Automaton()
        for word in {*self.words, *self.stems}:
            self.triggers.add_word(word, len(word))
        self.triggers.make_automaton()
        self.lengths = sorted({len(stem) for stem in self.stems})

    def classed(self, word: str) -> tuple[str, float]:
        found = self.words.get(word)
        if found is None:
            for length in self.lengths:
                weight = self.stems.get(word[:length])
                if weight is not None:
                    return INSULT, weight
            bare = word.replace("'", "").replace("’", "")
            found = (self.context.get(bare, OTHER), 1.0)
        return found

    def clause(self, text: str) -> float:
        state, total = 0, 0.0
        for word in _WORDS.findall(text):
            symbol, scale = self.classed(word)
            _, weight, state = self.machine[state, symbol]
            total += weight * scale
        return total

    def clauses(self, text: str) -> list[float]:
        """Weights of the matched clauses of a text."""
        text = text.lower()
        scores, done = [], -1
        for end, length in self.triggers.iter(text):
            start = end - length + 1
            if start <= done or (start and text[start - 1].isalnum()):
                continue
            low = max(text.rfind(mark, max(done, 0), start) for mark in ".!?;\n") + 1
            stop = _ENDS.search(text, end)
            done = stop.start() if stop else len(text)
            score = self.clause(text[max(low, 0) : done])
            if score > 0:
                scores.append(score)
        return scores

    def features(self, text: str) -> tuple[float, float, float]:
        scores = self.clauses(text)
        total = sum(scores)
        return np.log1p(total), max(scores, default=0.0), np.log1p(1000 * total / (len(text) + 200))


_scorers: dict[tuple, ClauseScorer] = {}


def clause_scorer(lexicon: tuple) -> ClauseScorer:
    if lexicon not in _scorers:
        _scorers.clear()
        _scorers[lexicon] = ClauseScorer(lexicon)
    return _scorers[lexicon]


def text_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``TEXTS`` rows of a batch at a time."""
    for low in range(0, batch.num_rows, TEXTS):
        yield batch.slice(low, TEXTS)


def batch_features(batch: pa.RecordBatch, text_column: str, lexicon: tuple) -> np.ndarray:
    features = clause_scorer(lexicon).features
    found = [features(text) for part in text_parts(batch) for text in as_text(part, text_column)]
    return np.array(found, dtype=float).reshape(-1, 3)


def learned_lexicon(sample: DataFrame, size: int = LEXICON) -> tuple[tuple[str, float], ...]:
    """Words and stems (``stem*``) that mark toxic texts of the sample, with weights up to 1.

    Counted by Spark over the distinct texts of the sample. The strongest entries stay, each
    instead of all that extend it or that it extends; at most ``size`` of them.
    """

    @giving_back
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed() -> pa.RecordBatch:
            entries = list(counts[0].keys() | counts[1].keys())
            found = pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.string()), *(pa.array([c[e] for e in entries], pa.int64()) for c in counts)],
                names=["entry", "clean", "toxic"],
            )
            for each in counts:
                each.clear()
            return found

        for batch in batches:
            for part in text_parts(batch):
                for text, label in zip(as_text(part, "text"), part.column(1).to_pylist(), strict=True):
                    words = set(_WORDS.findall(text.lower()))
                    counts[label].update(words)
                    counts[label].update(word[:n] + "*" for word in words for n in STEMS if len(word) > n)
                    counts[label][""] += 1
                    if sum(map(len, counts)) > FLUSH:
                        yield flushed()
        yield flushed()

    counts = sample.mapInArrow(counted, "entry string, clean long, toxic long").groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    total = counts.where("entry = ''").select(F.col("clean").alias("cleans"), F.col("toxic").alias("toxics"))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("toxics") + 1)) - F.log((F.col("clean") + 0.5) / (F.col("cleans") + 1))
    rows = (
        counts.where("entry <> '' AND toxic >= 5")
        .crossJoin(F.broadcast(total))
        .where(F.col("toxic") >= SUPPORT * F.col("toxics"))
        .withColumn("odds", odds)
        .where(F.col("odds") >= LOG_ODDS)
        .orderBy(F.desc(F.col("odds") * F.col("toxic")), F.desc(F.length("entry")), "entry")
        .limit(CANDIDATES)
        .collect()
    )
    chosen: dict[str, float] = {}
    for row in rows:
        bare = row.entry.rstrip("*")
        if len(chosen) < size and not any(bare.startswith(c.rstrip("*")) or c.startswith(bare) for c in chosen):
            chosen[row.entry] = float(row.odds)
    top = max(chosen.values(), default=1.0)
    return tuple((entry, round(odd / top, 4)) for entry, odd in sorted(chosen.items()))


def clause_features(docs: DataFrame, lexicon: tuple, text_column: str, keep: list[str]) -> DataFrame:
    schema = T.StructType([*(docs.schema[k] for k in keep), *(T.StructField(n, T.DoubleType()) for n in ("sum", "most", "rate"))])

    @giving_back
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch_features(batch, text_column, lexicon)
            own = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(rows[:, i]) for i in range(3))], names=schema.names)

    return docs.mapInArrow(scored, schema)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: tuple[tuple[str, float], ...] = ()
    weights: tuple[float, float, float, float] = PRIOR


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = SAMPLE) -> ToxicityModel:
    """A lexicon and a calibration from at most ``sample_rows`` labelled texts.

    Without labels of both kinds the seed words and a fixed calibration stay.
    """
    sample = labelled_sample(docs, labels, "toxic", sample_rows, id_column, text_column).where("label IN (0, 1)")
    lexicon = learned_lexicon(sample)
    rows = clause_features(sample, lexicon, "text", ["label"]).toPandas()
    if rows["label"].nunique() < 2:
        return ToxicityModel(lexicon)
    weights = logistic(rows[["sum", "most", "rate"]].to_numpy(float), rows["label"].to_numpy(float), 1e-4)
    return ToxicityModel(lexicon, tuple(float(w) for w in weights))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1; one row per row, nothing shuffled.

    Null and empty texts match no clause and get the score of a text without matches. Every
    clause of a text counts, however long it is. The text is left out; other columns may have any
    names, and one that is called score gives way to the result.
    """
    keep = {name: f"__own{number}" for number, name in enumerate(docs.columns) if name not in (text_column, "score")}
    inner = docs.select(F.col(text_column).alias("__text"), *[F.col(name).alias(own) for name, own in keep.items()])
    features = clause_features(inner, model.lexicon, "__text", list(keep.values()))
    one, two, three, base = map(F.lit, model.weights)
    logit = F.col("sum") * one + F.col("most") * two + F.col("rate") * three + base
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), logit))))
    return features.select(*[F.col(own).alias(name) for name, own in keep.items()], score.alias("score"))


def reject_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``threshold``, unchanged."""
    lexicon, weights = model.lexicon, np.array(model.weights)

    @giving_back
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch_features(batch, text_column, lexicon)
            yield batch.filter(pa.array(sigmoid(rows @ weights[:3] + weights[3]) < threshold))

    return docs.mapInArrow(clean, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity_scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
