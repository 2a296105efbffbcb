"""Lines repeated across documents, dropped everywhere but in one document.

The keys of long lines are range-partitioned and sorted by key, document and position; a stream
over each sorted partition sees a key's documents in turn. What comes back is one compressed
keep bitmap per document that loses lines, never text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewatt.llm.common import as_bytes, documents, kept

MIN_CHARS = 40
MIN_DOCUMENTS = 5
BLANKS = b" \t\n\x0b\x0c\r"
#: A row of a document's table is told by its id and the hash of its text.
ROW = "__row"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """16 bytes that stand for the stripped, A-Z-lowered line; None if it is too short."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """One row (key, id, row hash, position) for each line that is long enough."""
    source = docs.select(
        docs[id_column].alias("id"),
        docs[text_column].cast("string").alias("text"),
        F.xxhash64(docs[text_column].cast("string")).alias("row"),
    )
    id_type = source.schema["id"].dataType
    fields = [("key", T.BinaryType()), ("id", id_type), ("row", T.LongType()), ("pos", T.IntegerType())]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner, places = [], [], []
            for number, text in enumerate(as_bytes(batch, "text")):
                for place, line in enumerate(text.split(b"\n")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        keys.append(key)
                        owner.append(number)
                        places.append(place)
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column(0).take(at), batch.column(2).take(at), pa.array(places, pa.int32())],
                names=["key", "id", "row", "pos"],
            )

    return source.mapInArrow(keyed, T.StructType([T.StructField(n, t) for n, t in fields]))


class _Runs:
    """Streams the sorted rows of a partition, key by key and document by document.

    Of a key with enough documents, the lines of every document but the last are dropped at
    once. Undecided stay the last document of a key, and keys that may go on in the
    neighbouring partition while they have too few documents here: both wait until their key
    ends, or become ``pending`` rows. So at most ``enough`` documents of a key are held.
    """

    def __init__(self, enough: int):
        self.enough, self.out, self.first = enough, [], True
        self.key, self.docs = None, 0

    def start(self, key: bytes, doc: object) -> None:
        self.key, self.docs, self.first_doc = key, 0, doc
        self.waiting: list[tuple] = []
        self.held: list[tuple] = []

    def add(self, key: bytes, doc: object, row: int, place: int) -> None:
        if key != self.key:
            if self.key is not None:
                self.close(boundary=self.first)
                self.first = False
            self.start(key, doc)
        if not self.docs or doc != self.doc:
            self.waiting += self.held
            self.held, self.doc = [], doc
            self.docs += 1
            if self.docs >= self.enough:
                self.out += [(None, *line, None, None) for line in self.waiting]
                self.waiting = []
        self.held.append((doc, row, place))

    def close(self, boundary: bool) -> None:
        if boundary:
            self.out += [(self.key, *line, None, None) for line in self.waiting + self.held]
            self.out.append((self.key, self.doc, None, None, self.docs, self.first_doc))


def dropped_lines(lines: DataFrame, enough: int) -> DataFrame:
    """(id, row, pos) of the lines to drop, from the rows of ``line_keys``."""
    id_type = lines.schema["id"].dataType
    names = [("key", T.BinaryType()), ("id", id_type), ("row", T.LongType()), ("pos", T.IntegerType()), ("docs", T.LongType()), ("first_id", id_type)]
    schema = T.StructType([T.StructField(n, t) for n, t in names])

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, arrow, ids = _Runs(enough), None, None

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*runs.out, strict=True)) or [()] * 6
            runs.out = []
            kinds = [pa.binary(), ids, pa.int64(), pa.int32(), pa.int64(), ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[n for n, _ in names]
            )

        for batch in batches:
            ids = batch.column(1).type
            for line in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                runs.add(*line)
            if len(runs.out) > 10_000:
                yield flushed()
        if runs.key is not None:
            runs.close(boundary=True)
            yield flushed()

    ordered = lines.repartitionByRange("key", "id", "row", "pos").sortWithinPartitions("key", "id", "row", "pos")
    found = kept(ordered.mapInArrow(streamed, schema), "line-runs")
    # What follows has a few rows per partition: the ends of partitions, and their totals.
    by_place = Window.partitionBy("key").orderBy("first_id", "id")
    ends = found.where("docs IS NOT NULL")
    shared = F.lag("id").over(by_place).eqNullSafe(F.col("first_id")) & (F.row_number().over(by_place) > 1)
    totals = (
        ends.select("key", "id", (F.col("docs") - shared.cast("long")).alias("docs"))
        .groupBy("key")
        .agg(F.sum("docs").alias("total"), F.max("id").alias("keeper"))
    )
    pending = found.where("key IS NOT NULL AND docs IS NULL").select("key", "id", "row", "pos")
    late = pending.join(totals, "key").where((F.col("total") >= enough) & ~F.col("id").eqNullSafe(F.col("keeper")))
    return found.where("key IS NULL").select("id", "row", "pos").unionByName(late.select("id", "row", "pos"))


def keep_bitmap(dropped: list[int]) -> bytes:
    """Packed bits, 0 for a dropped line, compressed; lines past the end stay."""
    bits = np.ones((max(dropped) // 8 + 1) * 8, dtype=np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def kept_lines(lines: list, bitmap: bytes | None) -> list:
    if bitmap is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))
    size = len(bits)
    return [line for place, line in enumerate(lines) if place >= size or bits[place]]


def line_bitmaps(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """(id, __row, n_dropped, keep) for each document that loses lines.

    A line's key is the line stripped of ASCII blanks and with A-Z lowered. Keys of at least
    ``min_chars`` code points in at least ``min_documents`` distinct ids lose all their lines,
    except in the largest id that holds them (null is smaller than any id). Null and empty
    texts are one empty line and lose nothing; repeated rows share one bitmap; other columns
    are not read. A key of any number of documents is streamed, never gathered.
    """
    lines = kept(line_keys(docs, id_column, text_column, min_chars), "line-keys")
    dropped = dropped_lines(lines, min_documents).groupBy("id", "row").agg(F.collect_set("pos").alias("pos"))
    schema = T.StructType(
        [
            T.StructField(id_column, dropped.schema["id"].dataType),
            T.StructField(ROW, T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("keep", T.BinaryType()),
        ]
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(p) for p in places], pa.int64()),
                    pa.array([keep_bitmap(p) for p in places], pa.binary()),
                ],
                names=schema.names,
            )

    return dropped.mapInArrow(packed, schema)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` with a column ``__keep``, null where nothing is dropped.

    Both sides grow with the input, so the join is a sort-merge join at every size.
    """
    marks = bitmaps.select(F.col(id_column).alias("__id"), F.col(ROW).alias("__mark"), F.col("keep").alias("__keep")).hint("merge")
    same = docs[id_column].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_column].cast("string")) == F.col("__mark"))
    return docs.join(marks, same, "left").drop("__id", "__mark")


def drop_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``docs`` without the lines that ``line_bitmaps`` drops; same rows, same columns.

    A document whose lines all go keeps its row, with an empty text.
    """
    bitmaps = line_bitmaps(docs, id_column, text_column, min_chars, min_documents)
    marked = with_bitmaps(docs, bitmaps, id_column, text_column)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            keeps = batch.column(batch.schema.get_field_index("__keep")).to_pylist()
            texts = [
                b"\n".join(kept_lines(text.split(b"\n"), keep)).decode() if keep else whole
                for text, whole, keep in zip(as_bytes(batch, text_column), batch.column(at).to_pylist(), keeps, strict=True)
            ]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return marked.mapInArrow(cut, docs.schema)


def line_digest(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: its lines, how many go, and the SHA-256 of the text that stays."""
    marked = with_bitmaps(docs.select(id_column, text_column), bitmaps, id_column, text_column)
    id_type = docs.schema[id_column].dataType.simpleString()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, gone, digests = [], [], []
            keeps = batch.column(batch.schema.get_field_index("__keep")).to_pylist()
            for text, keep in zip(as_bytes(batch, text_column), keeps, strict=True):
                if keep is None:
                    before.append(text.count(b"\n") + 1)
                    gone.append(0)
                else:
                    lines = text.split(b"\n")
                    stay = kept_lines(lines, keep)
                    before.append(len(lines))
                    gone.append(len(lines) - len(stay))
                    text = b"\n".join(stay)
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(before, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=[id_column, "n_lines", "n_dropped", "kept_sha256"],
            )

    return marked.mapInArrow(digested, f"`{id_column}` {id_type}, n_lines long, n_dropped long, kept_sha256 string")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_digest(docs, line_bitmaps(docs))


OP4_SQL = """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.doc_id, k.line, k.pos, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
