"""Licence phrases by a positional index of rare words. DataFrame functions only.

One pass keeps, of each text, the positions of licence words. Their document frequencies over
all texts say which words of a phrase are rarest. Two rare words that stand where the phrase has
them give the candidate places; the whole phrase is then verified there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.llm.common import documents, kept

# The phrases of the contract.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Phrases of further licences.
MORE = (
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("bsd license", "bsd"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("creative commons attribution", "cc-by"),
    ("cc by sa", "cc-by-sa"),
    ("cc0 1 0 universal", "cc0"),
    ("permission hereby granted free", "permissive"),
    ("spdx license identifier", "spdx"),
    ("all rights reserved", "reserved"),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A hit is position * CODES + code of the word.
CODES = 64
#: Phrase words at which a score reaches one half.
HALF = 4


class Templates:
    """The phrases as word codes; frequent words of prose get the lowest codes."""

    def __init__(self, phrases: tuple[tuple[str, str], ...]):
        self.phrases = [(phrase.split(), label) for phrase, label in phrases]
        words = {word for phrase, _ in self.phrases for word in phrase}
        common = [word for word in ("the", "by", "under", "all", "version", "1", "0", "2") if word in words]
        self.words = common + sorted(words.difference(common))
        if len(self.words) >= CODES:
            raise ValueError(f"more than {CODES - 1} different phrase words")
        self.code = {word: number for number, word in enumerate(self.words, 1)}


def licence_hits(docs: DataFrame, templates: Templates, id_column: str, text_column: str) -> DataFrame:
    """(id, n_words, hits) of each row: the positions of the words that some phrase has."""
    lowered = F.translate(F.coalesce(docs[text_column].cast("string"), F.lit("")), UPPER, LOWER)
    words = F.filter(F.split(lowered, SEPARATORS), lambda word: word != "")
    vocabulary = F.array(*map(F.lit, templates.words))

    def hit(word: Column, place: Column) -> Column:
        return F.when(word.isin(templates.words), place.cast("long") * CODES + F.array_position(vocabulary, word))

    cut = docs.select(docs[id_column].alias("id"), words.alias("words"))
    return cut.select("id", F.size("words").cast("long").alias("n_words"), F.array_compact(F.transform("words", hit)).alias("hits"))


def document_frequencies(hits: DataFrame) -> dict[int, int]:
    """Rows that hold each word, by its code: at most ``CODES`` numbers."""
    codes = F.array_distinct(F.transform("hits", lambda hit: hit % CODES))
    rows = hits.select(F.explode(codes).alias("code")).groupBy("code").count().collect()
    return {row["code"]: row["count"] for row in rows}


def places(codes: list[int], frequency: dict[int, int]) -> Column:
    """Starts of a phrase among ``hits``; ``present`` has the codes of the text."""
    rarest = sorted(range(len(codes)), key=lambda offset: (frequency.get(codes[offset], 0), offset))[:2]

    def starts(offset: int) -> Column:
        own = F.filter("hits", lambda hit: hit % CODES == codes[offset])
        return F.transform(own, lambda hit: F.floor(hit / CODES) - offset)

    found = reduce(F.array_intersect, map(starts, rarest))
    rest = [offset for offset in range(len(codes)) if offset not in rarest]

    def whole(start: Column) -> Column:
        words = [F.array_contains(F.col("hits"), (start + offset) * CODES + codes[offset]) for offset in rest]
        return reduce(lambda a, b: a & b, words, start >= 0)

    there = reduce(lambda a, b: a & b, (F.array_contains("present", F.lit(codes[o]).cast("long")) for o in rarest))
    return F.when(there, F.array_sort(F.filter(found, whole))).otherwise(F.array().cast("array<bigint>"))


def licence_scan(
    docs: DataFrame,
    base: tuple[tuple[str, str], ...] = BASE,
    more: tuple[tuple[str, str], ...] = MORE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_words, base_places, found): where the ``base`` phrases stand, and what was found.

    ``base_places`` is an array of (start, label) over all base phrases, ``found`` of (label,
    words, base) for every phrase that occurs. Null and empty texts have no words and no places;
    repeated rows repeat their result; other columns are not read; an empty table gives an empty
    result. Words are counted from 0; a phrase that overlaps itself counts at each start.
    """
    templates = Templates((*base, *more))
    hits = kept(licence_hits(docs, templates, id_column, text_column), "licence-hits")
    frequency = document_frequencies(hits)
    hits = hits.withColumn("present", F.array_distinct(F.transform("hits", lambda hit: hit % CODES)))
    columns, names = [], []
    for number, (words, _) in enumerate(templates.phrases):
        names.append(f"p{number}")
        columns.append(places([templates.code[w] for w in words], frequency).alias(f"p{number}"))
    located = hits.select("id", "n_words", *columns)

    def labelled(number: int) -> Column:
        label = templates.phrases[number][1]
        return F.transform(names[number], lambda start: F.struct(start.alias("start"), F.lit(label).alias("label")))

    def once(number: int) -> Column:
        words, label = templates.phrases[number]
        row = F.struct(F.lit(label).alias("label"), F.lit(len(words)).alias("words"), F.lit(number < len(base)).alias("base"))
        return F.when(F.size(names[number]) > 0, row)

    return located.select(
        F.col("id").alias(id_column),
        "n_words",
        F.flatten(F.array(*map(labelled, range(len(base))))).alias("base_places"),
        F.array_compact(F.array(*map(once, range(len(names))))).alias("found"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan(documents(spark, sf_dir))
    starts = F.transform("base_places", lambda place: place["start"])

    def labels(rows: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda row: row["label"]))), ",")

    weight = F.aggregate("found", F.lit(0), lambda total, row: total + row["words"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.filter("found", lambda row: row["base"])).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        (weight / (weight + F.lit(HALF))).alias("score"),
    )


def _oracle() -> str:
    lists = [("[" + ", ".join(f"'{w}'" for w in p.split()) + "]", len(p.split()), label) for p, label in (*BASE, *MORE)]

    def starts(words: str, size: int) -> str:
        return f"list_filter(range(0, greatest(0, len(w) - {size - 1})), lambda i: w[i + 1 : i + {size}] = {words})"

    columns = ", ".join(f"{starts(words, size)} AS p{n}" for n, (words, size, _) in enumerate(lists))
    base = range(len(BASE))
    joined = reduce(lambda a, b: f"list_concat({a}, {b})", (f"p{n}" for n in base))

    def labels(numbers: range) -> str:
        each = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{lists[n][2]}' END" for n in numbers)
        return f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{each}], lambda x: x IS NOT NULL))), ','), '')"

    weight = " + ".join(f"CASE WHEN len(p{n}) > 0 THEN {size} ELSE 0 END" for n, (_, size, _) in enumerate(lists))
    return rf"""
WITH words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '{SEPARATORS}'), lambda x: x <> '') AS w FROM documents
), located AS (
    SELECT doc_id, w, {columns} FROM words
), base AS (
    SELECT *, {joined} AS b, {weight} AS weight FROM located
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(b)::BIGINT AS n_base, list_min(b)::BIGINT AS first_word, list_max(b)::BIGINT AS last_word,
       {labels(base)} AS base_labels, {labels(range(len(lists)))} AS labels, weight::DOUBLE / (weight + {HALF}) AS score
FROM base
"""


OP10_SQL = _oracle()
