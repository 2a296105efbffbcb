"""Packing tokenized documents into sequences by bin completion.

Pieces of equal length can stand for each other, so the plan is made on the histogram of
lengths, which has at most ``capacity`` rows however many pieces there are. Spark counts the
histogram, ranks the pieces within their length, and looks every rank up in the plan.
"""

from __future__ import annotations

import hashlib
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewatt.llm.common import as_bytes, documents, giving_back, kept, mixed, slices

CAPACITY = 2048
SEPARATOR = 0
#: Stretches that a worker remembers, about 40 bytes each, and the longest of them in bytes.
KNOWN_WORDS, LONGEST = 1_000_000, 64
WORDS_AT_ONCE = 1000
#: Bytes of text whose stretches are held at a time.
BATCH_BYTES = 1 << 21
#: Bytes of them that are hashed at a time.
HASHED_BYTES = 1 << 17
#: Pieces that one ranking task group holds; hot lengths are cut into as many groups as needed.
GROUP_ROWS = 128
#: Fillings that the search looks at or lays, if best fit does not meet the bound.
STEPS = 200_000


class IdTable:
    """The ids of texts, put together from those of their blank-free stretches by whole arrays.

    The tokenizer drops blanks and never looks across one; stretches are cut at blanks and line
    feeds only. A stretch is known by two 64-bit hashes of its bytes, A-Z lowered; the hashes of all
    stretches of a chunk are computed, looked up and turned into ids together. What is new goes
    through the library. Stretches over ``LONGEST`` bytes are not remembered. When the table is
    full, it starts again, so that memory stays bounded.
    """

    def __init__(self, path: str, size: int = KNOWN_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Whether an id closes a word.
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.size = size
        self.start_again()

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype=np.uint32) for one in found]

    def encoded_words(self, words: list[str], closers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, end to end, and where each word's ids stop.

        Many words go in one text. A word of letters has one id that closes it, the last; a comma
        or full stop behind it is a token of its own and closes too.
        """
        ids, stops, at = [np.empty(0, np.uint32)], [np.empty(0, np.int64)], 0
        for low in range(0, len(words), WORDS_AT_ONCE):
            part, due = words[low : low + WORDS_AT_ONCE], np.cumsum(closers[low : low + WORDS_AT_ONCE])
            data = self.encoded([" ".join(part)])[0]
            ends = np.flatnonzero(self.closes[data]) + 1
            if len(ends) == due[-1]:
                ends = ends[due - 1]
            else:
                single = self.encoded(part)
                data, ends = np.concatenate(single), np.cumsum([len(one) for one in single])
            ids.append(data)
            stops.append(ends + at)
            at += len(data)
        return np.concatenate(ids), np.concatenate(stops)

    def learned(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches, end to end, and how many each has."""
        places: list[list[int]] = [[], []]
        sent: list[list[str]] = [[], []]
        closers: list[int] = []
        for place, stretch in enumerate(stretches):
            text = stretch.decode()
            word = text[:-1] if text[-1] in ",." else text
            # As the tokenizer sees it: composed and lowered, it must still be letters only.
            plain = word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())
            places[plain].append(place)
            sent[plain].append(text)
            if plain:
                closers.append(1 if word is text else 2)
        word_ids, stops = self.encoded_words(sent[True], closers)
        lengths = np.zeros(len(stretches), np.int64)
        lengths[places[True]] = np.diff(stops, prepend=0)
        others = self.encoded(sent[False])
        lengths[places[False]] = [len(one) for one in others]
        starts = np.cumsum(lengths) - lengths
        ids = np.empty(int(lengths.sum()), np.uint32)
        ids[_ragged(starts[places[True]], lengths[places[True]])] = word_ids
        if others:
            ids[_ragged(starts[places[False]], lengths[places[False]])] = np.concatenate(others)
        return ids, lengths

    def pooled(self, ids: np.ndarray) -> int:
        """Append to the pool, which grows by halves; where the ids begin in it."""
        begin, self.filled = self.filled, self.filled + len(ids)
        if self.filled > len(self.pool):
            grown = np.empty(self.filled + self.filled // 2, np.uint32)
            grown[:begin] = self.pool[:begin]
            self.pool = grown
        self.pool[begin : self.filled] = ids
        return begin

    def remember(self, words: np.ndarray) -> None:
        """Words join the newest part of the table, and that the whole once it is an eighth of it."""
        tables = [*self.tables[1:], words]
        if sum(map(len, tables)) > max(1 << 16, len(self.tables[0]) // 8):
            tables = [*self.tables, words]
        joined = np.concatenate(tables)
        joined = joined[np.argsort(joined["one"], kind="stable")]
        self.tables = [joined] if len(tables) == len(self.tables) + 1 else [self.tables[0], joined]

    def settle(self) -> None:
        """Keep what has been met again since it was learned, and give back the rest.

        Workers outlive their tasks, and what they run next should find their memory free.
        """
        words = np.concatenate(self.tables)
        words = words[words["again"]]
        ids = self.pool[_ragged(words["start"], words["count"])]
        words["start"] = np.cumsum(words["count"]) - words["count"]
        words["again"] = False
        words = words[np.argsort(words["one"], kind="stable")]
        self.tables, self.pool, self.filled = [words], ids, len(ids)
        _powers.clear()

    def start_again(self) -> None:
        self.tables, self.pool, self.filled = [np.empty(0, _WORD)], np.empty(0, np.uint32), 0

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by the separator, end to end, and where each stops."""
        special = [place for place, text in enumerate(texts) if b"<|" in text]
        if special:
            # Special tokens are the only strings whose case matters and that may hold a blank.
            own = dict(zip(special, self.encoded([texts[p].decode() for p in special]), strict=True))
            texts = [b"" if p in own else text for p, text in enumerate(texts)]
        if sum(map(len, self.tables)) > self.size:
            self.start_again()
        data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        limits = np.cumsum([len(text) + 1 for text in texts])
        inside = (data != 0x20) & (data != 0x0A)
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        starts, ends = edge[0::2], edge[1::2]
        lowered = _LOWER[data]
        one, two = _hashes(lowered, starts, ends)
        _, first, member = np.unique(one, return_index=True, return_inverse=True)
        # Different stretches of one first hash: the group is split by the second.
        if (two != two[first][member]).any():
            _, first, member = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
            member = member.ravel()
        start = np.zeros(len(first), np.int64)
        count = np.full(len(first), -1, np.int64)
        for words in self.tables:
            if len(words):
                at = np.minimum(np.searchsorted(words["one"], one[first]), len(words) - 1)
                hit = (words["one"][at] == one[first]) & (words["two"][at] == two[first])
                start[hit], count[hit] = words["start"][at[hit]], words["count"][at[hit]]
                words["again"][at[hit]] = True
        missed = np.flatnonzero(count < 0)
        raw = lowered.tobytes()
        spans = zip(starts[first[missed]].tolist(), ends[first[missed]].tolist(), strict=True)
        fresh, lengths = self.learned([raw[a:b] for a, b in spans])
        start[missed], count[missed] = self.pooled(fresh) + np.cumsum(lengths) - lengths, lengths
        short = missed[(ends - starts)[first[missed]] <= LONGEST]
        if len(short):
            words = np.empty(len(short), _WORD)
            words["one"], words["two"] = one[first[short]], two[first[short]]
            words["start"], words["count"], words["again"] = start[short], count[short], False
            self.remember(words)
        owner = np.searchsorted(limits, starts, side="right")
        gathered = self.pool[_ragged(start[member], count[member])]
        sizes = np.bincount(owner, weights=count[member], minlength=len(texts)).astype(np.int64)
        if special:
            parts = np.split(gathered, np.cumsum(sizes)[:-1])
            for place, found in own.items():
                parts[place] = found
            gathered, sizes = np.concatenate(parts), np.array([len(part) for part in parts], np.int64)
        stops = np.cumsum(sizes + 1)
        out = np.full(int(stops[-1]) if len(stops) else 0, SEPARATOR, dtype="<u4")
        keep = np.ones(len(out), dtype=bool)
        keep[stops - 1] = False
        out[keep] = gathered
        return out, stops


_WORD = np.dtype([("one", np.uint64), ("two", np.uint64), ("start", np.uint32), ("count", np.uint32), ("again", np.bool_)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, end to end."""
    lengths = np.asarray(lengths, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, np.int64) - before, lengths) + np.arange(int(lengths.sum()))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every stretch: polynomials in two odd factors, each mixed.

    A hash depends on the bytes of its stretch alone, so stretches are taken ``HASHED_BYTES`` at a
    time: the arrays of 64-bit terms are eight times as large as the text under them.
    """
    out = (np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64))
    low = 0
    while low < len(starts):
        begin = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, begin + HASHED_BYTES, side="right")))
        terms = data[begin : ends[high - 1]].astype(np.uint64) + np.uint64(1)
        first, last = starts[low:high] - begin, ends[low:high] - begin
        sums = np.zeros(len(terms) + 1, np.uint64)
        for number, factor in enumerate(_FACTORS):
            if number not in _powers or len(_powers[number][0]) < len(terms):
                steps = np.full((2, max(len(terms), HASHED_BYTES)), factor, dtype=np.uint64)
                steps[1] = np.uint64(pow(int(factor), -1, 1 << 64))
                steps[:, 0] = 1
                _powers[number] = tuple(np.multiply.accumulate(steps, axis=1))
            up, down = _powers[number]
            np.cumsum(terms * up[: len(terms)], out=sums[1:])
            out[number][low:high] = mixed((sums[last] - sums[first]) * down[first])
        low = high
    return out


_tables: dict[str, IdTable] = {}


def id_table(path: str) -> IdTable:
    if path not in _tables:
        _tables[path] = IdTable(path)
    return _tables[path]


def pieces(docs: DataFrame, path: str, capacity: int, id_column: str, text_column: str) -> DataFrame:
    """One row per piece: id, row hash, piece, start, length, ids_crc32."""
    source = docs.select(
        docs[id_column].alias("id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
        F.xxhash64(docs[text_column].cast("string")).alias("row"),
    )
    names = ("id", "row", "piece", "start", "length", "ids_crc32")
    kinds = (source.schema["id"].dataType, T.LongType(), T.IntegerType(), T.LongType(), T.LongType(), T.LongType())

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = id_table(path)
        for batch in batches:
            owner, number, start, length, crc = [], [], [], [], []
            texts = as_bytes(batch, "text")
            for low, high in slices(texts, BATCH_BYTES):
                ids, stops = words.ids(texts[low:high])
                begin = 0
                for place, stop in enumerate(stops.tolist(), low):
                    for piece, at in enumerate(range(begin, stop, capacity)):
                        part = ids[at : min(at + capacity, stop)]
                        owner.append(place)
                        number.append(piece)
                        start.append(at - begin)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                    begin = stop
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(2).take(at),
                    pa.array(number, pa.int32()),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                ],
                names=list(names),
            )
        words.settle()

    return source.mapInArrow(cut, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


@dataclass
class Plan:
    """Fillings and how many bins take each; bins are numbered in this order."""

    fillings: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    @property
    def bins(self) -> int:
        return sum(times for _, times in self.fillings)


def sums_of(members: tuple[int, ...]) -> tuple[int, int]:
    """Bit sets of the sums of single members, and of the sums of two or more of them."""
    single = several = 0
    for length in members:
        several |= (single | several) << length
        single |= 1 << length
    return single, several


def spread(bits: int, width: int) -> int:
    """Every set bit, and the ``width`` bits above it."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        bits |= bits << step
        done += step
    return bits


def dominated(members: tuple[int, ...], waste: int, left_out: int) -> bool:
    """Whether a filling can be improved by one piece it leaves out (bit set of lengths).

    It can if such a piece fits into the waste, is longer than a member and fits in its place, or is
    as long as several members together, or longer, and fits in theirs. Whatever packs the rest
    around the filling then packs it around the better one, so the filling need not be tried.
    """
    single, several = sums_of(members)
    better = spread(several, waste) | (spread(1, waste) & ~1)
    if waste:
        better |= spread(single << 1, waste - 1)
    return bool(better & left_out)


class BinCompletion:
    """Branch and bound over undominated fillings of the bin that holds the longest remaining piece.

    ``counts`` maps a length to its number of pieces. The incumbent starts as best fit and the
    search ends as soon as it meets the bound. Fillings are enumerated by recursion over all pieces
    that still fit, least waste first, and only up to the waste that still leads to fewer bins than
    the incumbent; none is cut off. A filling is tried for as many bins as the counts allow, and for
    fewer. ``steps`` limits the fillings looked at and those that best fit lays behind them; what is
    best by then is returned.
    """

    def __init__(self, counts: dict[int, int], capacity: int, steps: int = STEPS):
        self.capacity, self.steps = capacity, steps
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self.counts[length] = count
        self.lengths = np.arange(capacity + 1)
        total = int((self.counts * self.lengths).sum())
        #: No plan needs fewer: the volume, and pieces of over half a bin, which never share.
        self.bound = max(-(-total // capacity), int(self.counts[capacity // 2 + 1 :].sum()))

    def best_fit(self, counts: np.ndarray) -> Plan:
        """Greedy completion: each bin's longest piece, then the longest that still fits."""
        plan, counts = Plan(), counts.copy()
        while (filling := self.filled(counts)) is not None:
            plan.fillings.append((filling, self.taken(counts, filling, self.times(counts, filling))))
        return plan

    def filled(self, counts: np.ndarray) -> tuple[int, ...] | None:
        present = np.flatnonzero(counts)
        if not len(present):
            return None
        first = int(present[-1])
        taken, used, room = [first], {first: 1}, self.capacity - first
        place = int(np.searchsorted(present, room, side="right")) - 1
        while place >= 0:
            length = int(present[place])
            take = min(int(counts[length]) - used.get(length, 0), room // length)
            if take > 0:
                taken += [length] * take
                used[length] = used.get(length, 0) + take
                room -= take * length
            place = min(place - 1, int(np.searchsorted(present, room, side="right")) - 1)
        return tuple(taken)

    @staticmethod
    def times(counts: np.ndarray, filling: tuple[int, ...]) -> int:
        """For how many bins the counts allow a filling."""
        lengths, need = np.unique(np.array(filling), return_counts=True)
        return int((counts[lengths] // need).min())

    @staticmethod
    def taken(counts: np.ndarray, filling: tuple[int, ...], times: int) -> int:
        lengths, need = np.unique(np.array(filling), return_counts=True)
        counts[lengths] -= need * times
        return times

    def sure_waste(self, counts: np.ndarray) -> int:
        """Waste that no plan for the remaining pieces avoids: beside pieces that not even the
        shortest other one fits, all room stays empty."""
        present = np.flatnonzero(counts)
        if not len(present):
            return 0
        alone = present[present + present[0] > self.capacity]
        return int((counts[alone] * (self.capacity - alone)).sum())

    def completions(self, counts: np.ndarray, slack: int) -> Iterator[tuple[int, ...]]:
        """Undominated fillings around the longest piece with at most ``slack`` waste, least first."""
        present = [int(x) for x in np.flatnonzero(counts)][::-1]
        first = present[0]
        room = self.capacity - first
        free = {x: int(counts[x]) - (x == first) for x in present}
        fits = [x for x in present if x <= room and free[x]]
        # Sums that the pieces from a position on can reach: no recursion into a dead end.
        reach = [1] * (len(fits) + 1)
        full = (1 << (room + 1)) - 1
        for at in range(len(fits) - 1, -1, -1):
            bits, copies, block = reach[at + 1], min(free[fits[at]], room // fits[at]), 1
            while copies:
                block = min(block, copies)
                bits |= bits << (block * fits[at])
                copies -= block
                block *= 2
            reach[at] = bits & full

        def exact(at: int, target: int) -> Iterator[tuple[int, ...]]:
            if target == 0:
                yield ()
                return
            for place in range(at, len(fits)):
                if not reach[place] >> target & 1:
                    return
                length = fits[place]
                for copies in range(min(free[length], target // length), 0, -1):
                    if reach[place + 1] >> (target - copies * length) & 1:
                        for rest in exact(place + 1, target - copies * length):
                            yield (length,) * copies + rest

        for waste in range(min(slack, room) + 1):
            for members in exact(0, room - waste):
                used = Counter(members)
                left_out = sum(1 << x for x in fits if free[x] > used[x])
                if not dominated(members, waste, left_out):
                    yield (first, *members)

    def solve(self) -> Plan:
        """The best plan found within ``steps`` fillings; the incumbent starts as best fit."""
        incumbent = self.best_fit(self.counts)
        total = int((self.counts * self.lengths).sum())
        steps, seen = 0, set()

        def options(counts: np.ndarray, waste: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
            """(filling, bins, waste after it), lazily; the incumbent may improve in between."""
            for filling in self.completions(counts, (incumbent.bins - 1) * self.capacity - total - waste):
                for bins in range(self.times(counts, filling), 0, -1):
                    yield filling, bins, waste + bins * (self.capacity - sum(filling))

        stack = [(self.counts.copy(), options(self.counts, 0), [])]
        while stack and steps < self.steps and incumbent.bins > self.bound:
            counts, following, done = stack[-1]
            found = next(following, None)
            if found is None:
                stack.pop()
                continue
            filling, bins, waste = found
            left = counts.copy()
            self.taken(left, filling, bins)
            steps += 1
            state = hashlib.blake2b(left.tobytes() + waste.to_bytes(8), digest_size=16).digest()
            spare = (incumbent.bins - 1) * self.capacity - total
            if state in seen or waste + self.sure_waste(left) > spare:
                continue
            seen.add(state)
            fillings = [*done, (filling, bins)]
            rest = self.best_fit(left).fillings
            steps += len(rest)
            plan = Plan(fillings + rest)
            if plan.bins < incumbent.bins:
                incumbent = plan
            if left.any():
                stack.append((left, options(left, waste), fillings))
        return incumbent


def placements(plan: Plan) -> dict[str, np.ndarray]:
    """Per slot of the plan: length, first rank, ranks, first sequence, offset; by length and rank."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in plan.fillings:
        offset = 0
        for length in filling:
            start = ranks.get(length, 0)
            rows.append((length, start, sequence, offset))
            ranks[length] = start + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


def packed(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece of each row of ``docs``, with its sequence and its offset there.

    A document is its ids and one separator, so null and empty texts have length 1. Longer ones
    are cut at multiples of ``capacity``. Repeated rows are packed each for itself; other columns
    are not read; an empty table gives an empty result. Offsets in a sequence have no gaps.
    """
    table = kept(pieces(docs, path, capacity, id_column, text_column), "pieces")
    # At most ``capacity`` rows, whatever the table holds.
    histogram = {row.length: row.n for row in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = placements(BinCompletion(histogram, capacity).solve())
    groups = np.ones(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        groups[length] = -(-count // GROUP_ROWS)
    spread = F.get(F.array(*(F.lit(int(g)) for g in groups)), F.col("length").cast("int"))
    salted = table.withColumn("salt", F.pmod(F.xxhash64("id", "row", "piece"), spread))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("id", "row", "piece")
    ranked = (
        salted.join(starts, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.row_number().over(order) - 1)
        .select("id", "piece", "start", "length", "ids_crc32", "rank")
    )
    schema = T.StructType(
        [
            T.StructField(id_column, table.schema["id"].dataType),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")),
        ]
    )

    @giving_back
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranks of one length are consecutive in the plan: one key orders both.
        scale = max(histogram.values(), default=0) + 1
        keys = slots["length"] * scale + slots["rank"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, length * scale + rank, side="right") - 1
            sequence = slots["sequence"][at] + rank - slots["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(slots["offset"][at])], names=schema.names
            )

    return ranked.mapInArrow(placed, schema)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
