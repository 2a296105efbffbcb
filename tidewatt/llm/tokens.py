"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewatt.llm.common import Generations, as_text, documents

CACHE = 400_000
LIMIT = 4096
SPACE = "▁"
_RUNS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")


class PairMerger:
    """Counts the pieces of a text by the merge ranks of a piece vocabulary.

    A piece holds the blank sign only in front, or blank signs alone, and never a line feed. So
    no merge crosses from text into a blank or over a line feed, and the stretches between them
    are merged one by one; equal stretches are merged once while the cache holds them.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.rank = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        if any("\n" in piece or SPACE in piece.lstrip(SPACE) for piece in self.rank):
            raise ValueError("a piece of this vocabulary crosses a blank or a line feed")
        order = {score: place for place, score in enumerate(sorted(set(self.rank.values())))}
        self.rank = {piece: order[score] << 32 for piece, score in self.rank.items()}
        self.single = {piece for piece in self.rank if len(piece) == 1}
        #: Neighbours inside some piece; no merge ever joins two others.
        self.joined = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        #: Keys: a word stands for blank sign + word; with a line feed in front, for itself.
        self.words = Generations(self._word, cache)

    def _word(self, key: str) -> int:
        """Cut where no piece joins the neighbours, then count part by part."""
        stretch = key[1:] if key[0] == "\n" else SPACE + key
        joined, start, total = self.joined, 0, 0
        for cut in range(1, len(stretch)):
            if stretch[cut - 1 : cut + 1] not in joined:
                total += self._part(stretch[start:cut])
                start = cut
        return total + self._part(stretch[start:]) if start else self.merge(stretch)

    def _part(self, part: str) -> int:
        if len(part) == 1:
            return 1 if part in self.single else len(part.encode())
        if part[0] == SPACE and part[1] != SPACE:
            return self.words[part[1:]]
        return self.words["\n" + part]

    def merge(self, stretch: str) -> int:
        """Initial symbols minus merges; a symbol without a piece counts as its bytes."""
        rank, size, symbols = self.rank.get, len(stretch), list(stretch)
        count = size
        if not self.single.issuperset(symbols):
            count = sum(1 if c in self.single else len(c.encode()) for c in symbols)
        following = list(range(1, size + 1))
        preceding = list(range(-1, size - 1))
        #: The heap holds rank and place in one number; ``due`` the valid one of each place.
        due, heap = [-1] * size, []
        for left in range(size - 1):
            found = rank(symbols[left] + symbols[left + 1])
            if found is not None:
                due[left] = found | left
                heap.append(found | left)
        heapify(heap)
        while heap:
            lowest = heappop(heap)
            left = lowest & 0xFFFFFFFF
            if due[left] != lowest:
                continue
            right = following[left]
            after, before = following[right], preceding[left]
            symbols[left] = pair = symbols[left] + symbols[right]
            due[left] = due[right] = -1
            count -= 1
            following[left] = after
            if after < size:
                preceding[after] = left
                found = rank(pair + symbols[after])
                if found is not None:
                    due[left] = found | left
                    heappush(heap, found | left)
            if before >= 0:
                found = rank(symbols[before] + pair)
                due[before] = -1
                if found is not None:
                    due[before] = found | before
                    heappush(heap, found | before)
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        words, total = self.words, 0
        odd = "  " in text or SPACE in text
        for number, line in enumerate(text.split("\n")):
            total += number > 0
            if odd or line[:1] == " " or line[-1:] == " " or (not line and not number):
                line = (SPACE if not number else "") + line.replace(" ", SPACE)
                for run in _RUNS.findall(line):
                    single = run[0] == SPACE and run[1:2] != SPACE and len(run) > 1
                    total += words[run[1:] if single else "\n" + run]
            elif line:
                parts = line.split(" ")
                if number:
                    parts[0] = "\n" + parts[0]
                total += sum(map(words.__getitem__, parts))
        return total


_mergers: dict[str, PairMerger] = {}


def merger(path: str) -> PairMerger:
    """One per Python worker and vocabulary, so that its cache outlives a task."""
    if path not in _mergers:
        _mergers[path] = PairMerger(path)
    return _mergers[path]


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT) -> DataFrame:
    """Bytes, tokens and whether the tokens exceed ``limit``, one row per row of ``docs``.

    Null and empty texts have no bytes and no tokens; repeated rows and null ids stay as they
    are; other columns are not read. Nothing is shuffled; a worker holds the vocabulary and a
    bounded cache.
    """
    source = docs.select(docs[id_column], docs[text_column].cast("string").alias("__text"))
    kind = source.schema[0].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merger(path).count
        for batch in batches:
            texts = as_text(batch, "__text")
            tokens = [count(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([number > limit for number in tokens], pa.bool_()),
                ],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(counted, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
