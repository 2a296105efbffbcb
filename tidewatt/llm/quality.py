"""Quality by gated attention over passages (multiple-instance learning).

A document is a bag of passages and has one label. Every passage is encoded, a gate decides how
much each one counts, and the weighted passage vector is scored. Encoder, gate and scorer are
learned together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.common import _SPACE as BLANK_BYTES
from tidewatt.llm.common import as_bytes, documents, slices, table, word_hashes
from tidewatt.llm.labels import held_out, labelled_sample, sigmoid

#: Labelled texts that the model is fitted on, at the most; all their passages count.
SAMPLE = 6_000
PASSAGE_WORDS = 64
THRESHOLD = 0.5
BYTES, EXTRA = 128, 5
WIDTH = BYTES + EXTRA
ENCODED, GATED = 16, 8


def passages(texts: list[bytes], size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of ``size`` words, and the number of the text of each row.

    Byte shares (one bin for all of UTF-8's upper half), length and variety of words. Bytes belong
    to the passage of the word that they are in or follow. A text without words is one passage.
    """
    hashes, counts = word_hashes(texts)
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    numbers = np.maximum(1, -(-counts // size))
    owner = np.repeat(np.arange(len(texts)), numbers)
    first = np.cumsum(numbers) - numbers
    rows = np.zeros((len(owner), WIDTH), dtype=np.float32)
    if not len(texts):
        return rows, owner
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    first_word = np.cumsum(counts) - counts
    word_at = np.arange(len(hashes)) - np.repeat(first_word, counts)
    word_passage = np.repeat(first, counts) + word_at // size
    # A passage ends where the first word of the next one begins; bytes before any word open the first.
    inside = ~BLANK_BYTES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = (np.cumsum(lengths) - lengths)[lengths > 0]
    begins[heads] = inside[heads]
    word = np.cumsum(begins) - 1
    text_of = np.repeat(np.arange(len(texts)), lengths)
    within = word >= first_word[text_of]
    byte_passage = first[text_of]
    byte_passage[within] = word_passage[word[within]]
    bins = np.bincount(byte_passage * BYTES + np.minimum(data, BYTES - 1), minlength=len(owner) * BYTES)
    bins = bins.reshape(-1, BYTES)
    n_bytes = np.maximum(1, bins.sum(axis=1))
    rows[:, :BYTES] = np.sqrt(bins / n_bytes[:, None])
    n_words = np.bincount(word_passage, minlength=len(owner))
    busy = np.maximum(1, n_words)
    distinct = np.unique((word_passage.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    n_distinct = np.bincount((distinct >> np.uint64(40)).astype(np.int64), minlength=len(owner))
    same = (hashes[1:] == hashes[:-1]) & (word_passage[1:] == word_passage[:-1])
    n_same = np.bincount(word_passage[1:][same], minlength=len(owner))
    rows[:, BYTES] = n_distinct / busy
    rows[:, BYTES + 1] = n_same / busy
    rows[:, BYTES + 2] = np.minimum(4, n_bytes / busy / 8)
    rows[:, BYTES + 3] = n_words / size
    rows[:, BYTES + 4] = bins[:, 65:91].sum(axis=1) / n_bytes * 4
    return rows, owner


@dataclass
class AttentionModel:
    """Encoder, gate and scorer; ``None`` parameters score one half."""

    parameters: dict[str, np.ndarray] | None = None

    @staticmethod
    def initial(seed: int = 7) -> dict[str, np.ndarray]:
        draw = np.random.default_rng(seed)
        shapes = {"encode": (WIDTH, ENCODED), "tanh": (ENCODED, GATED), "gate": (ENCODED, GATED), "attend": (GATED,), "score": (ENCODED,)}
        found = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
        return found | {"encode0": np.zeros(ENCODED), "score0": np.zeros(1)}

    @staticmethod
    def forward(p: dict[str, np.ndarray], rows: np.ndarray, first: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
        hidden = np.tanh(rows @ p["encode"] + p["encode0"])
        left, gate = np.tanh(hidden @ p["tanh"]), sigmoid(hidden @ p["gate"])
        raw = (left * gate) @ p["attend"]
        weight = np.exp(raw - np.maximum.reduceat(raw, first)[owner])
        weight = weight / np.add.reduceat(weight, first)[owner]
        pooled = np.add.reduceat(weight[:, None] * hidden, first, axis=0)
        score = sigmoid(pooled @ p["score"] + p["score0"])
        return {"hidden": hidden, "left": left, "gate": gate, "weight": weight, "pooled": pooled, "score": score}

    @classmethod
    def gradient(cls, p: dict, rows: np.ndarray, first: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> dict:
        f = cls.forward(p, rows, first, owner)
        error = (f["score"] - labels) / len(labels)
        to_pooled = np.outer(error, p["score"])[owner]
        along = (to_pooled * f["hidden"]).sum(axis=1)
        centred = along - np.add.reduceat(f["weight"] * along, first)[owner]
        raw = f["weight"] * centred
        mixed = np.outer(raw, p["attend"])
        to_left = mixed * f["gate"] * (1 - f["left"] ** 2)
        to_gate = mixed * f["left"] * f["gate"] * (1 - f["gate"])
        to_hidden = f["weight"][:, None] * to_pooled + to_left @ p["tanh"].T + to_gate @ p["gate"].T
        to_hidden *= 1 - f["hidden"] ** 2
        return {
            "encode": rows.T @ to_hidden,
            "encode0": to_hidden.sum(axis=0),
            "tanh": f["hidden"].T @ to_left,
            "gate": f["hidden"].T @ to_gate,
            "attend": (f["left"] * f["gate"]).T @ raw,
            "score": f["pooled"].T @ error,
            "score0": np.array([error.sum()]),
        }

    @classmethod
    def fit(cls, rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 0.01) -> AttentionModel:
        """Adam over shuffled batches of documents; ``sizes``: passages of each document."""
        if len(set(labels.tolist())) < 2:
            return cls()
        p, draw = cls.initial(), np.random.default_rng(11)
        moment = {k: np.zeros_like(v) for k, v in p.items()}
        square = {k: np.zeros_like(v) for k, v in p.items()}
        begins, step = np.cumsum(sizes) - sizes, 0
        for epoch in range(epochs):
            order = draw.permutation(len(sizes))
            for low in range(0, len(order), batch):
                chosen = order[low : low + batch]
                take = np.concatenate([np.arange(begins[c], begins[c] + sizes[c]) for c in chosen])
                own = sizes[chosen]
                first = np.cumsum(own) - own
                found = cls.gradient(p, rows[take], first, np.repeat(np.arange(len(own)), own), labels[chosen])
                step += 1
                pace = rate * (1 if epoch < epochs * 2 // 3 else 0.2)
                for k, g in found.items():
                    g = g + 1e-5 * p[k]
                    moment[k] = 0.9 * moment[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    p[k] = p[k] - pace * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return cls(p)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        found = np.full(len(texts), 0.5)
        if self.parameters is not None:
            for low, high in slices(texts):
                rows, owner = passages(texts[low:high])
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                found[low:high] = self.forward(self.parameters, rows, first, owner)["score"]
        return found


def fit_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = SAMPLE) -> AttentionModel:
    """A model from at most ``sample_rows`` labelled texts, with all their passages.

    Passages are encoded in Spark tasks; the driver gets 266 bytes for every 64 words of the sample.
    Without labels of both kinds every text scores one half.
    """
    sample = labelled_sample(docs, labels, "quality", sample_rows, id_column, text_column).where("label IN (0, 1)")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = as_bytes(batch, "text"), batch.column(1).to_pylist()
            for low, high in slices(texts):
                rows, owner = passages(texts[low:high])
                out = []
                for number in range(high - low):
                    out.append(rows[owner == number].astype("<f2").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(labels[low:high], pa.int32())], names=["rows", "label"])

    bags = sample.mapInArrow(encoded, "rows binary, label int").toPandas()
    if not len(bags):
        return AttentionModel()
    # The same order whatever the layout of the tasks.
    bags = bags.sort_values("rows", kind="stable")
    arrays = [np.frombuffer(b, dtype="<f2").reshape(-1, WIDTH) for b in bags["rows"]]
    return AttentionModel.fit(np.concatenate(arrays).astype(np.float32), np.array([len(a) for a in arrays]), bags["label"].to_numpy(float))


def quality_scores(docs: DataFrame, model: AttentionModel, text_column: str = "text") -> DataFrame:
    """``docs`` without the text and with ``score`` from 0 to 1; one row per row, nothing shuffled.

    Null and empty texts are one passage without words. Every passage of a text counts. A column
    of ``docs`` that is called score gives way to the result.
    """
    keep = [name for name in docs.columns if name not in (text_column, "score")]
    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*own, pa.array(model.scores(as_bytes(batch, text_column)))], names=schema.names)

    return docs.mapInArrow(scored, schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
