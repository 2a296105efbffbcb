"""Benchmark passages in documents: CGK embedding, bit sampling, exact edit verification.

The random walk of Chakraborty, Goldenberg and Koucky copies a string symbol by symbol; at each
step a random bit of the symbol decides whether it moves on. Strings at a small edit distance
get embeddings at a small Hamming distance, and sampled places of the embedding are a locality
sensitive hash for that.

Windows take their size from the items: of an item of ``n`` bytes, the largest power of two
``w`` (up to ``LARGEST``) with ``2 * w - 1 <= n``. Documents are cut into windows side by side,
items at every place, so each passage holds a whole window of its document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidewatt.llm.common import as_bytes, documents, mixed, slices, table

#: Edits per byte of the item up to which a passage counts as the item.
MAX_EDITS = 0.2
LARGEST = 32
#: Walks, samples of each walk, and places of a sample.
WALKS, SAMPLES, PLACES = 4, 4, 14
#: Length of the grams that rule candidates out before their edit distance is computed.
GRAM = 3
#: Bytes of item text whose index one pass over the documents carries; more items, more passes.
BLOCK_BYTES = 1 << 18
_FILTER_BITS = 20


def normal(text: bytes) -> bytes:
    """A-Z lowered, runs of ASCII blanks as one blank."""
    return b" ".join(text.lower().split())


def window_size(length: int) -> int:
    size = 1
    while size < LARGEST and 4 * size - 1 <= length:
        size *= 2
    return size


class Embedding:
    """Keys of windows of one size: every sample of every walk."""

    def __init__(self, size: int):
        draw = np.random.default_rng(1_000 + size)
        self.size, self.steps = size, max(4, 2 * size)
        self.moves = draw.integers(0, 2, (WALKS, self.steps, 256), dtype=np.int32)
        count = min(PLACES, self.steps)
        self.places = [[np.sort(draw.choice(self.steps, count, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)]
        self.factors = draw.integers(1, 1 << 63, (WALKS, SAMPLES, self.steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, data: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """One array of keys per table; a walk that leaves its window reads zeros."""
        padded = np.zeros((len(starts), self.size + 1), dtype=np.uint8)
        padded[:, : self.size] = data[starts[:, None] + np.arange(self.size)]
        flat, base = padded.ravel(), np.arange(len(starts), dtype=np.int32) * (self.size + 1)
        last = base + self.size
        for walk in range(WALKS):
            at = base.copy()
            sums = [np.zeros(len(starts), dtype=np.uint64) for _ in range(SAMPLES)]
            wanted = [set(places.tolist()) for places in self.places[walk]]
            for step in range(self.steps):
                symbol = flat[at]
                for sample in range(SAMPLES):
                    if step in wanted[sample]:
                        sums[sample] += (symbol.astype(np.uint64) + np.uint64(1)) * self.factors[walk, sample, step]
                at += self.moves[walk, step][symbol]
                np.minimum(at, last, out=at)
            yield from (mixed(s) for s in sums)


class ItemIndex:
    """The windows of some items at every place, by the keys of every table."""

    def __init__(self, items: tuple[tuple[object, bytes], ...], max_edits: float):
        self.items, self.max_edits = items, max_edits
        self.classes = []
        sizes: dict[int, list[int]] = {}
        for number, (_, text) in enumerate(items):
            if text:
                sizes.setdefault(window_size(len(text)), []).append(number)
        for size, numbers in sorted(sizes.items()):
            data = np.frombuffer(b"".join(items[n][1] for n in numbers), dtype=np.uint8)
            lengths = np.array([len(items[n][1]) for n in numbers])
            begins = np.cumsum(lengths) - lengths
            shifts = [np.arange(length - size + 1) for length in lengths]
            owner = np.repeat(numbers, [len(s) for s in shifts])
            shift = np.concatenate(shifts)
            starts = np.repeat(begins, [len(s) for s in shifts]) + shift
            embedding, tables = Embedding(size), []
            for keys in embedding.keys(data, starts):
                order = np.argsort(keys, kind="stable")
                filled = np.zeros(1 << _FILTER_BITS, dtype=bool)
                filled[keys >> np.uint64(64 - _FILTER_BITS)] = True
                tables.append((keys[order], owner[order], shift[order], filled))
            self.classes.append((embedding, tables))
        self.masks: dict[int, dict[int, int]] = {}
        self.grams = [{text[i : i + GRAM] for i in range(len(text) - GRAM + 1)} for _, text in items]

    def candidates(self, texts: list[bytes]) -> set[tuple[int, int, int]]:
        """(text, item, place in windows) where some key of a window agrees."""
        found: set[tuple[int, int, int]] = set()
        lengths = np.array([len(text) for text in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begins = np.cumsum(lengths) - lengths
        for embedding, tables in self.classes:
            size = embedding.size
            numbers = lengths // size
            owner = np.repeat(np.arange(len(texts)), numbers)
            place = (np.arange(len(owner)) - np.repeat(np.cumsum(numbers) - numbers, numbers)) * size
            if not len(owner):
                continue
            for (known, items, shifts, filled), keys in zip(tables, embedding.keys(data, begins[owner] + place), strict=True):
                maybe = np.flatnonzero(filled[keys >> np.uint64(64 - _FILTER_BITS)])
                low = np.searchsorted(known, keys[maybe], side="left")
                high = np.searchsorted(known, keys[maybe], side="right")
                for window, first, last in zip(maybe[high > low], low[high > low], high[high > low], strict=True):
                    begin = int(place[window])
                    # Starts within the same few bytes are one place to verify.
                    found.update(
                        (int(owner[window]), int(item), (begin - int(shift)) // size)
                        for item, shift in zip(items[first:last], shifts[first:last], strict=True)
                    )
        return found

    def verified(self, texts: list[bytes]) -> dict[tuple[int, int], tuple[int, int]]:
        """(text, item) -> (least edit distance, where that passage ends), within the limit."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for text, item, place in sorted(self.candidates(texts)):
            pattern = self.items[item][1]
            limit = int(self.max_edits * len(pattern))
            size = window_size(len(pattern))
            low = max(0, place * size - limit - size)
            high = place * size + len(pattern) + limit + 2 * size
            part, grams = texts[text][low:high], self.grams[item]
            # An edit changes at most GRAM of the item's grams, so enough of them must be left.
            if len(grams.intersection([part[i : i + GRAM] for i in range(len(part) - GRAM + 1)])) < len(grams) - GRAM * limit:
                continue
            distance, end = self.distance(item, part)
            known = best.get((text, item))
            if distance <= limit and (known is None or (distance, low + end) < known):
                best[text, item] = (distance, low + end)
        return best

    def distance(self, item: int, text: bytes) -> tuple[int, int]:
        """Least edit distance of the item to any substring, and its first end (Myers' bit vectors)."""
        pattern = self.items[item][1]
        if item not in self.masks:
            masks: dict[int, int] = {}
            for place, symbol in enumerate(pattern):
                masks[symbol] = masks.get(symbol, 0) | 1 << place
            self.masks[item] = masks
        masks, size = self.masks[item], len(pattern)
        full, high = (1 << size) - 1, 1 << (size - 1)
        plus, minus, score = full, 0, size
        best, end = size, 0
        for place, symbol in enumerate(text, 1):
            equal = masks.get(symbol, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
            up, down = up << 1 & full, down << 1 & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            if score < best:
                best, end = score, place
        return best, end


_indexes: dict[tuple, ItemIndex] = {}


def item_index(items: tuple, max_edits: float) -> ItemIndex:
    key = (hash(items), max_edits)
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = ItemIndex(items, max_edits)
    return _indexes[key]


def item_blocks(benchmark: DataFrame, id_column: str, text_column: str) -> list[tuple[tuple[object, bytes], ...]]:
    """The distinct items as blocks of about ``BLOCK_BYTES``; null and empty items are left out.

    A block is small enough to ship; their number grows with the benchmark, not with documents.
    """
    items = benchmark.select(F.col(id_column).alias("item"), F.col(text_column).cast("string").alias("text")).where("text IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-int(total) // BLOCK_BYTES))
    blocks = []
    for number in range(count):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == number).orderBy("item", "text").collect()
        block = tuple((row.item, text) for row in rows if (text := normal(row.text.encode())))
        if block:
            blocks.append(block)
    return blocks


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    max_edits: float = MAX_EDITS,
) -> DataFrame:
    """(id, item, distance, similarity, end): a row per document and item that it holds.

    Texts are compared as UTF-8 with A-Z lowered and blanks joined. A document holds an item if
    some substring is within ``max_edits`` edits per item byte; ``end`` is where the closest
    one ends. Exact passages are always found; others by sampling, so a few may be missed.
    Null and empty texts hold nothing, empty items match nothing, repeated rows repeat their
    result, an empty benchmark gives no rows. Nothing is shuffled.
    """
    source = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    kinds = [T.StructField(id_column, source.schema["id"].dataType), T.StructField(item_column, benchmark.schema[item_column].dataType)]
    schema = T.StructType([*kinds, T.StructField("distance", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("end", T.LongType())])

    item_type = to_arrow_type(benchmark.schema[item_column].dataType)

    def within(block: tuple) -> DataFrame:
        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = item_index(block, max_edits)
            for batch in batches:
                texts = [normal(text) for text in as_bytes(batch, "text")]
                for low, high in slices(texts):
                    found = sorted(index.verified(texts[low:high]).items())
                    at = pa.array([low + text for (text, _), _ in found], pa.int64())
                    items = [index.items[item] for (_, item), _ in found]
                    distances = [d for _, (d, _) in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(at),
                            pa.array([item for item, _ in items], item_type),
                            pa.array(distances, pa.int64()),
                            pa.array([1 - d / len(text) for d, (_, text) in zip(distances, items, strict=True)], pa.float64()),
                            pa.array([end for _, (_, end) in found], pa.int64()),
                        ],
                        names=schema.names,
                    )

        return source.mapInArrow(searched, schema)

    found = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_column, "text"):
        found = found.unionByName(within(block))
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", max_edits: float = MAX_EDITS
) -> DataFrame:
    """The rows of ``docs`` that hold no item by ``leaks``, unchanged."""

    def clean(block: tuple):
        def kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = item_index(block, max_edits)
            for batch in batches:
                texts = [normal(text) for text in as_bytes(batch, text_column)]
                keep = np.ones(len(texts), dtype=bool)
                for low, high in slices(texts):
                    for text, _ in index.verified(texts[low:high]):
                        keep[low + text] = False
                yield batch.filter(pa.array(keep))

        return kept_rows

    for block in item_blocks(benchmark, item_column, "text"):
        docs = docs.mapInArrow(clean(block), docs.schema)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
