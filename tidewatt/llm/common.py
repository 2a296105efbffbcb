"""Helpers shared by the corpus operators: inputs, Arrow batches, stored intermediates."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.session import work_folder

#: Bytes of text that numpy code handles at a time; its arrays are a small multiple of this.
CHUNK_BYTES = 1 << 19


ARCHIVE = "tidewatt-package"


def shipped(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, once per application.

    The driver hands the archive to the executors itself; no executor opens the driver's path.
    """
    context = spark.sparkContext
    if not any(ARCHIVE in name for name in context.listFiles):
        package = Path(__file__).resolve().parent.parent
        target = f"{tempfile.mkdtemp(prefix=f'{package.name}-')}/{ARCHIVE}"
        context.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % divisor


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared work folder and read again: lineage ends there."""
    folder = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column as UTF-8; null becomes empty."""
    column = batch.column(batch.schema.get_field_index(name))
    wide = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(wide).to_pylist()]


def as_text(batch: pa.RecordBatch, name: str) -> list[str]:
    column = batch.column(batch.schema.get_field_index(name))
    return [value or "" for value in column.to_pylist()]


def give_back() -> None:
    """Hand memory that is free again back to the system, where Arrow and the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


Batches = Iterator[pa.RecordBatch]


def giving_back(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function`` for ``mapInArrow``; what it has freed is handed back when its task ends.

    Python workers outlive their tasks, and allocators keep what a task has freed: what an executor
    runs next would find its memory taken.
    """

    @wraps(function)
    def run(batches: Batches) -> Batches:
        yield from function(batches)
        give_back()

    return run


def slices(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` bytes; a longer text stands alone."""
    start, size = 0, 0
    for position, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, position
            start, size = position, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, size: int) -> np.ndarray:
    if len(_powers[which]) < size:
        steps = np.full(size, _BASE if which == "up" else _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of A-Z-lowered texts, and words per text.

    A word's hash is its polynomial modulo 2**64, mixed: all words of a batch at once.
    """
    joined = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    if not len(joined):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[joined]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[0::2], edge[1::2]
    terms = (_LOWER[joined].astype(np.uint64) + np.uint64(1)) * _power("up", len(joined))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    hashes = mixed((sums[ends] - sums[starts]) * _power("down", len(joined))[starts])
    limits = np.cumsum([len(text) + 1 for text in texts])
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    return hashes, counts


class Generations(dict):
    """A cache in two generations of ``size`` entries, so that memory stays bounded.

    ``compute`` gives the value of a missing key. What the young generation has not seen is
    looked up in the old one before it is computed anew.
    """

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value

    def make_room(self) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()

    def keep(self, key, value) -> None:
        self.make_room()
        self[key] = value
