"""Language-model scores by context-tree weighting over bytes.

A text is the byte stream of its tokens: A-Z-lowered words, each closed by a blank, and one end
sign. The context of a byte are the bytes before it in the stream, the last first, up to
``DEPTH``, across blanks; in front of the first stand start signs. A byte is eight binary
decisions. Every context of every depth has a Krichevsky-Trofimov estimate for each decision, and
the tree mixes all depths by their evidence.

Spark counts contexts with their byte, and the tree's sums, gives every distinct one its
probability once, and adds these up along each document. Words are counted for the base only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.common import CHUNK_BYTES, as_bytes, documents, giving_back, kept, remainder, slices

FOLDS, HELD_OUT = 7, 2
DEPTH = 6
#: Contexts that share their last two symbols are summed in one task; what is above them has
#: at most ``SYMBOLS * 256`` rows however large the corpus is.
SPLIT = 2
SYMBOLS = 257
START, END = 256, b"\n"
#: The most frequent words and contexts, by these bounds, are looked up in the tasks; a join
#: does the same for all others.
TOP_WORDS, TOP_CONTEXTS = 100_000, 2_000_000
#: Entries a task counts before it hands them on.
FLUSH = 400_000
#: Bytes of the stream whose contexts are sorted at a time, distinct contexts that a task sums
#: before it hands them on, and rows that it hands on at a time.
SORTED, SUMMED, HANDED = 1 << 21, 2_500_000, 200_000


def word_id(word: bytes) -> int:
    found = xxhash.xxh64_intdigest(word, seed=42)
    return found - (1 << 64) if found >> 63 else found


def word_counts(docs: DataFrame, text: str, train: str) -> DataFrame:
    """(word, n): occurrences in the training texts, 0 for words of other texts only."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return found

        for batch in batches:
            for content, learn in zip(as_bytes(batch, text), batch.column(1).to_pylist(), strict=True):
                words = content.lower().split()
                words.append(END)
                if learn:
                    counts.update(words)
                else:
                    for word in words:
                        counts.setdefault(word, 0)
                if len(counts) > FLUSH:
                    yield flushed()
        yield flushed()

    counts = docs.select(text, train).mapInArrow(giving_back(counted), "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def parts(texts: list[bytes], limit: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """Texts cut into (number of the text, bytes before, bytes), at most ``limit`` bytes at a time."""
    held, size = [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text), limit):
            part = text[start : start + limit]
            if size and size + len(part) > limit:
                yield held
                held, size = [], 0
            held.append((number, text[max(start - DEPTH, 0) : start], part))
            size += len(part)
    if held:
        yield held


def contexts(cut: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of some parts: context and byte in one number, and the number of the text."""
    lengths = np.array([len(part) for _, _, part in cut], dtype=np.int64)
    nth = np.repeat(np.arange(len(cut)), lengths)
    place = np.arange(len(nth)) + DEPTH * nth
    symbols = np.full(len(nth) + DEPTH * len(cut), START, dtype=np.int64)
    symbols[place + DEPTH] = np.frombuffer(b"".join(part for _, _, part in cut), dtype=np.uint8)
    firsts = np.cumsum(lengths + DEPTH) - lengths
    for first, (_, before, _) in zip(firsts, cut, strict=True):
        if before:
            symbols[first - len(before) : first] = np.frombuffer(before, dtype=np.uint8)
    size = len(symbols) - DEPTH
    keys = np.zeros(size, dtype=np.int64)
    for back in range(DEPTH, 0, -1):
        keys *= SYMBOLS
        keys += symbols[DEPTH - back : DEPTH - back + size]
    keys *= 256
    keys += symbols[DEPTH:]
    return keys[place], np.array([number for number, _, _ in cut], dtype=np.int64)[nth]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first)


def context_counts(docs: DataFrame, text: str, train: str) -> DataFrame:
    """(key, n): occurrences of each context with its byte in the training texts' streams, 0 for
    those of other texts only. A task sums its own before they are shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: dict[bool, list[np.ndarray]] = {True: [], False: []}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def sort_raw() -> None:
            for learn, found in raw.items():
                if found:
                    keys = np.concatenate(found)
                    keys.sort()
                    first = np.flatnonzero(np.diff(keys, prepend=-1))
                    times = np.diff(first, append=len(keys))
                    held.append((keys[first], times if learn else np.zeros(len(first), np.int64)))
                    found.clear()

        def merged(bound: int) -> Iterator[pa.RecordBatch]:
            keys, counts = _summed(*map(np.concatenate, zip(*held, strict=True)))
            held.clear()
            if len(keys) <= bound:
                held.append((keys, counts))
                return
            for start in range(0, len(keys), HANDED):
                yield pa.RecordBatch.from_arrays([pa.array(v[start : start + HANDED]) for v in (keys, counts)], names=["key", "n"])

        for batch in batches:
            content, learn = as_bytes(batch, text), batch.column(1).to_pylist()
            for start, end in slices(content):
                streams: dict[bool, list[bytes]] = {True: [], False: []}
                for row in range(start, end):
                    streams[bool(learn[row])].append(b" ".join([*content[row].lower().split(), END]))
                for learned, some in streams.items():
                    for cut in parts(some, CHUNK_BYTES):
                        keys, _ = contexts(cut)
                        raw[learned].append(keys)
                        waiting += len(keys)
                        if waiting >= SORTED:
                            sort_raw()
                            waiting = 0
                            if sum(len(keys) for keys, _ in held) > SUMMED:
                                yield from merged(SUMMED // 2)
        sort_raw()
        if held:
            yield from merged(0)

    return docs.select(text, train).mapInArrow(giving_back(counted), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 1/2: Stirling's series at x + 8."""
    product = x.copy()
    for step in range(1, 8):
        product *= x + step
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def _weighed(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln of the weighted probability, the own estimate's share in it, and the chance of a one."""
    own = log_estimate(zeros, ones)
    mixture = np.logaddexp(own, below) - np.log(2)
    return mixture, np.exp(own - np.log(2) - mixture), (ones + 0.5) / (zeros + ones + 1)


@dataclass
class Tree:
    """The contexts below some depth-2 contexts, all of them whole, from ``DEPTH`` up to 2."""

    keys: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        byte, place = self.keys & 255, np.arange(8)
        prefix = (1 << place) | (byte[:, None] >> (8 - place))
        self.bits = (byte[:, None] >> (7 - place)) & 1
        nodes, self.at = np.unique((self.keys >> 8)[:, None] * 256 + prefix, return_inverse=True)
        self.at = self.at.reshape(self.bits.shape)
        weights = np.repeat(self.counts, 8).astype(float)
        ones = np.bincount(self.at.ravel(), weights * self.bits.ravel(), len(nodes))
        zeros = np.bincount(self.at.ravel(), weights, len(nodes)) - ones
        below, chance = log_estimate(zeros, ones), (ones + 0.5) / (zeros + ones + 1)
        levels, path = [], np.arange(len(nodes))
        for depth in range(DEPTH - 1, SPLIT - 1, -1):
            parents, up = np.unique((nodes >> 8) % SYMBOLS**depth * 256 + (nodes & 255), return_inverse=True)
            zeros, ones, below = (np.bincount(up, values, len(parents)) for values in (zeros, ones, below))
            below, share, own = _weighed(zeros, ones, below)
            path = up[path]
            levels.append((share[path], own[path]))
            nodes = parents
        for share, own in levels:
            chance = share * own + (1 - share) * chance
        self.chance, self.path = chance, path
        self.nodes, self.zeros, self.ones, self.below = nodes, zeros, ones, below

    def upper(self) -> tuple[np.ndarray, np.ndarray]:
        """What depth 1 needs to know: nodes, and zeros, ones and summed evidence of each."""
        parents, up = np.unique((self.nodes >> 8) % SYMBOLS * 256 + (self.nodes & 255), return_inverse=True)
        return parents, np.stack([np.bincount(up, v, len(parents)) for v in (self.zeros, self.ones, self.below)])

    def log_chances(self, shallow: np.ndarray) -> np.ndarray:
        """log10 of the probability of each key's byte in its context."""
        at = (self.nodes >> 8) % SYMBOLS * 256 + (self.nodes & 255)
        chance = self.chance
        for share, own in (shallow[:2, at], shallow[2:, at]):
            chance = share[self.path] * own[self.path] + (1 - share[self.path]) * chance
        each = chance[self.at]
        return np.log10(np.where(self.bits == 1, each, 1 - each)).sum(axis=1)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
    """Trees of a partition sorted by the last two symbols, some hundred thousand keys each."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        keys, counts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if size > 200_000:
            group = (keys >> 8) % SYMBOLS**SPLIT
            last = (held[-1][0][-1] >> 8) % SYMBOLS**SPLIT
            cut = int(np.argmax(group != last)) if (group != last).any() else len(keys)
            held.append((keys[:cut], counts[:cut]))
            if cut < len(keys):
                yield Tree(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
            keys, counts = keys[cut:], counts[cut:]
        if len(keys):
            held.append((keys, counts))
            size += len(keys)
    if held:
        yield Tree(*map(np.concatenate, zip(*held, strict=True)))


def _by_tree(counts: DataFrame) -> DataFrame:
    group = F.expr(f"(key div 256) % {SYMBOLS**SPLIT}")
    dealt = counts.select("key", "n", group.alias("tree")).repartition("tree").sortWithinPartitions("tree")
    return dealt.select("key", "n")


def _shallow(counts: DataFrame) -> np.ndarray:
    """Share and chance of every decision at depths 1 and 0, as four rows over depth-1 nodes."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches):
            nodes, values = tree.upper()
            yield pa.RecordBatch.from_arrays([pa.array(nodes), *map(pa.array, values)], names=["node", "zeros", "ones", "below"])

    # At most SYMBOLS * 256 rows.
    rows = (
        _by_tree(counts)
        .mapInArrow(giving_back(sums), "node long, zeros double, ones double, below double")
        .groupBy("node")
        .agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below")))
        .toPandas()
        .sort_values("node")
    )
    nodes, (zeros, ones, below) = rows["node"].to_numpy(np.int64), rows[["zeros", "ones", "below"]].to_numpy(float).T
    found = np.zeros((4, SYMBOLS * 256))
    evidence, share, own = _weighed(zeros, ones, below)
    found[0, nodes], found[1, nodes] = share, own
    zeros, ones, below = (np.bincount(nodes & 255, v, 256) for v in (zeros, ones, evidence))
    _, share, own = _weighed(zeros, ones, below)
    found[2], found[3] = np.tile(share, SYMBOLS), np.tile(own, SYMBOLS)
    return found


def context_scores(counts: DataFrame) -> DataFrame:
    """(key, n, logp): log10 probability of the byte of a key in its context."""
    shallow = _shallow(counts)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches):
            yield pa.RecordBatch.from_arrays([pa.array(tree.keys), pa.array(tree.counts), pa.array(tree.log_chances(shallow))], names=["key", "n", "logp"])

    return _by_tree(counts).mapInArrow(giving_back(scored), "key long, n long, logp double")


def most_frequent(rows: DataFrame, count: str, bound: int) -> DataFrame:
    """The rows with the largest counts, at most ``bound``: those of whole levels of frequency.

    A level is an eighth of a doubling, so a few hundred numbers reach the driver and no task
    or driver ever sorts more rows than the bound.
    """
    level = F.floor(F.log2(count) * 8)
    sizes = rows.where(F.col(count) > 0).groupBy(level.alias("level")).count().collect()
    total, lowest = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["count"]
        if total > bound:
            break
        lowest = row["level"]
    return rows.where(F.lit(False) if lowest is None else (F.col(count) > 0) & (level >= lowest))


class Lookup:
    """Numbers by key, keys ascending. A slot holds one of the keys that fall into it, the last in
    ``order``; the others are searched."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, order: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(int(4 * len(keys)).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, dtype=np.int32)
        self.slots[self._slot(keys[order])] = order

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its place among the table's keys if so."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = self.slots[self._slot(keys)]
        hit = self.keys[at] == keys
        missed = np.flatnonzero(~hit)
        found = np.minimum(np.searchsorted(self.keys, keys[missed]), len(self.keys) - 1)
        at[missed] = found
        hit[missed] = self.keys[found] == keys[missed]
        return hit, at


def language_scores(docs: DataFrame, train: F.Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte): one row per row of
    ``docs``.

    ``train`` says which rows are learned from; ``score`` is the tree's log10 probability of the
    text's whole stream, ``bits_per_byte`` its code length over the stream's bytes, and
    ``base_score`` the add-one unigram's. Null and empty texts are the end sign alone.
    Every row counts for itself, repeated or not; other columns are not read. Without training
    rows all counts are 0. The tables of words and contexts are built from the whole corpus,
    stored, and joined; only parts of a fixed size are broadcast.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.monotonically_increasing_id().alias("uid"), docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"), train.alias("learn")
    )
    id_type = source.schema["id"].dataType
    words = kept(word_counts(source, "text", "learn"), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    top = most_frequent(words, "n", TOP_WORDS).toPandas()
    table = spark.sparkContext.broadcast((list(map(bytes, top["word"])), np.log10(top["n"].to_numpy(float) + 1)))
    scores = kept(context_scores(kept(context_counts(source, "text", "learn"), "contexts")), "context-scores")
    often = most_frequent(scores, "n", TOP_CONTEXTS).toArrow().sort_by("key")
    order = np.argsort(often["n"].to_numpy()).astype(np.int32)
    lookup = spark.sparkContext.broadcast((often["key"].to_numpy(), often["logp"].to_numpy(), order))
    names = [("uid", T.LongType()), ("id", id_type), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("n_bytes", T.LongType()), ("base", T.DoubleType()), ("score", T.DoubleType()), ("word", T.LongType()), ("times", T.LongType()), ("key", T.LongType())]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, logs = table.value
        place = {word: i for i, word in enumerate(common)}
        known = Lookup(*lookup.value)
        for whole in batches:
            contents = as_bytes(whole, "text")
            for start, end in slices(contents):
                batch, size = whole.slice(start, end - start), end - start
                tokens, n_known, n_bytes = (np.zeros(size, np.int64) for _ in range(3))
                base, score = np.zeros(size), np.zeros(size)
                streams, owner, rare, times, lost, keys = [], [], [], [], [], []
                for row, text in enumerate(contents[start:end]):
                    split = [*text.lower().split(), END]
                    streams.append(b" ".join(split))
                    tokens[row], n_bytes[row] = len(split), len(streams[-1])
                    at, n = [], []
                    for word, count in Counter(split).items():
                        index = place.get(word)
                        if index is None:
                            owner.append(row)
                            rare.append(word_id(word))
                            times.append(count)
                        else:
                            at.append(index)
                            n.append(count)
                    n_known[row], base[row] = sum(n), np.array(n, dtype=np.int64) @ logs[at] if at else 0
                for cut in parts(streams, CHUNK_BYTES):
                    of, texts = contexts(cut)
                    hit, at = known.find(of)
                    score += np.bincount(texts[hit], known.values[at[hit]], size)
                    lost.append(texts[~hit])
                    keys.append(of[~hit])
                lost, keys = np.concatenate(lost), np.concatenate(keys)
                more, most = len(owner), len(owner) + len(keys)
                uids = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([uids, uids[np.array(owner, dtype=np.int64)], uids[lost]])),
                        pa.concat_arrays([batch.column(1), pa.nulls(most, batch.column(1).type)]),
                        *(pa.concat_arrays([pa.array(v), pa.nulls(most, pa.int64())]) for v in (tokens, n_known, n_bytes)),
                        *(pa.concat_arrays([pa.array(v), pa.nulls(most, pa.float64())]) for v in (base, score)),
                        *(pa.concat_arrays([pa.nulls(size, pa.int64()), pa.array(v, pa.int64()), pa.nulls(len(keys), pa.int64())]) for v in (rare, times)),
                        pa.concat_arrays([pa.nulls(size + more, pa.int64()), pa.array(keys)]),
                    ],
                    names=[n for n, _ in names],
                )

    rows = kept(source.select("uid", "id", "text").mapInArrow(giving_back(summed), T.StructType([T.StructField(n, t) for n, t in names])), "document-parts")
    numbered = words.select(F.xxhash64("word").alias("word"), "n")
    rare = (
        rows.where("word IS NOT NULL")
        .select("uid", "word", "times")
        .join(numbered.hint("merge"), "word")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_base"),
        )
    )
    seldom = rows.where("key IS NOT NULL").select("uid", "key").join(scores.select("key", "logp").hint("merge"), "key").groupBy("uid").agg(F.sum("logp").alias("more_score"))
    none = F.lit(0.0)
    score = F.col("score") + F.coalesce("more_score", none)
    return (
        rows.where("word IS NULL AND key IS NULL")
        .join(rare, "uid", "left")
        .join(seldom, "uid", "left")
        .select(
            F.col("id").alias(id_column),
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(int(total)).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", none) - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
            score.alias("score"),
            (-score * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
        )
    )


def op9_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    found = language_scores(docs, ~held)
    return found.withColumn("held_out", held)
