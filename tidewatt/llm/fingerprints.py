"""Order MinHash fingerprints. DataFrame functions only.

The k-mers of a text (``WORDS`` words from each word on) are numbered by occurrence, so that
repeats count. A hash deals them to ``SKETCHES`` sketches; each sketch takes its ``TUPLE``
smallest, puts them in text order and hashes that tuple. Texts agree in a sketch if they share
these k-mers and their order, which follows edit distance more closely than a set does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatt.llm.common import documents, kept

WORDS, TUPLE = 2, 2
#: 64 sketches: the highest six of the 63 hash bits name the sketch.
SKETCHES, SKETCH_SHIFT = 64, 57
#: Numbers hold a hash above and a word position below: positions count modulo 2**24.
PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1
HASHES = (1 << 63) - 1 - PLACES
#: A fingerprint's number is an int: the sketch, and this many bits of its tuple's hash.
TUPLE_BITS = 25
BLANKS = r"[\x09-\x0D\x20]+"


def _masked(column: Column, mask: int) -> Column:
    return column.bitwiseAND(F.lit(mask).cast("long"))


def order_minhash(texts: DataFrame, text_column: str, out: str) -> DataFrame:
    """``texts`` with ``out`` instead of the text: one number per sketch that has a k-mer.

    A number holds the sketch in its upper and the hash of the tuple in its lower bits. Null
    counts as empty; a text without words is one empty word, and one with fewer words than a
    k-mer is one k-mer. Everything happens within the row.
    """
    keep = [name for name in texts.columns if name != text_column]
    words = F.split(F.coalesce(F.col(text_column), F.lit("")), BLANKS)
    step = texts.select(*keep, words.alias("__words"))

    def kmer(word: Column, place: Column) -> Column:
        more = [F.get("__words", place + n) for n in range(1, WORDS)]
        return _masked(F.xxhash64(word, *more), HASHES).bitwiseOR(_masked(place.cast("long"), PLACES))

    # Equal k-mers stand side by side, in text order.
    step = step.select(*keep, F.sort_array(F.transform("__words", kmer)).alias("__kmers"))

    def begins(number: Column, place: Column) -> Column:
        return (place == 0) | (_masked(F.get("__kmers", place - 1).bitwiseXOR(number), HASHES) != 0)

    marked = F.filter(F.transform("__kmers", lambda number, place: F.when(begins(number, place), place)), lambda p: p.isNotNull())
    step = step.select(*keep, "__kmers", marked.alias("__runs"))

    def numbered(start: Column, run: Column) -> Column:
        size = F.coalesce(F.get("__runs", run + 1), F.size("__kmers")) - start

        def ranked(number: Column, occurrence: Column) -> Column:
            return _masked(F.xxhash64(_masked(number, HASHES), occurrence), HASHES).bitwiseOR(_masked(number, PLACES))

        return F.transform(F.slice("__kmers", start + 1, size), ranked)

    ranked = F.sort_array(F.flatten(F.transform("__runs", numbered)))
    step = step.select(*keep, ranked.alias("__ranked"))

    def among_least(number: Column, place: Column) -> Column:
        before = F.get("__ranked", place - TUPLE)
        return (place < TUPLE) | (F.shiftright(before, SKETCH_SHIFT) != F.shiftright(number, SKETCH_SHIFT))

    step = step.select(*keep, F.filter("__ranked", among_least).alias("__least"))

    def sketched(number: Column, place: Column) -> Column:
        sketch = F.shiftright(number, SKETCH_SHIFT)
        first = (place == 0) | (F.shiftright(F.get("__least", place - 1), SKETCH_SHIFT) != sketch)
        other = F.get("__least", place + 1)
        other = F.when(F.shiftright(other, SKETCH_SHIFT) == sketch, other)
        own, others = F.shiftright(number, PLACE_BITS), F.shiftright(other, PLACE_BITS)
        in_order = F.when(_masked(number, PLACES) < _masked(other, PLACES), F.xxhash64(own, others)).otherwise(F.xxhash64(others, own))
        number = F.shiftleft(sketch, TUPLE_BITS).bitwiseOR(_masked(in_order, (1 << TUPLE_BITS) - 1))
        return F.when(first, number.cast("int"))

    return step.select(*keep, F.array_compact(F.transform("__least", sketched)).alias(out))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal sketches among those that either text has."""
    sketches = F.array_union(F.transform(one, lambda n: F.shiftright(n, TUPLE_BITS)), F.transform(two, lambda n: F.shiftright(n, TUPLE_BITS)))
    return F.size(F.array_intersect(one, two)) / F.size(sketches)


def as_string(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda n: F.lpad(F.lower(F.hex(n)), 8, "0")), "")


def next_rows(rows: DataFrame) -> DataFrame:
    """(id, row, n_chars, next_id, next_row) of distinct rows: the next in descending order, cyclic.

    Rows are range-partitioned, so neighbours mostly share a partition; what follows the last
    row of a partition is the first of the next one, a table with a row per partition.
    """
    order = (F.desc("id"), F.desc("row"))
    ranged = kept(rows.distinct().repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    within = Window.partitionBy("part").orderBy(*order)
    following = ranged.select("*", F.lead(F.struct("id", "row")).over(within).alias("after"))
    heads = ranged.groupBy("part").agg(F.max(F.struct("id", "row")).alias("head"))
    parts = Window.orderBy("part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    linked = heads.select("part", F.coalesce(F.lead("head").over(parts), F.first("head").over(whole)).alias("head"))
    chosen = F.coalesce("after", "head")
    return following.join(linked, "part").select(
        "id", "row", "n_chars", chosen["id"].alias("next_id"), chosen["row"].alias("next_row")
    )


def _same(left: DataFrame, id_name: str, row_name: str, right: DataFrame) -> Column:
    return left[id_name].eqNullSafe(right["id"]) & (left[row_name] == right["row"])


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text has its last third (floor of code points) replaced by the beginning of the
    next document in descending id, after the last the first. Null texts are empty, a null id is
    the smallest; rows with equal id follow each other by the hash of their text; repeated rows
    are one document and each get its result. A single document follows itself. Other columns
    are not read.
    """
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    source = docs.select(docs[id_column].alias("id"), text.alias("text")).withColumn("row", F.xxhash64("text"))
    pairs = kept(next_rows(source.select("id", "row", F.length("text").cast("long").alias("n_chars"))), "next-rows")
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    wanted = pairs.select(F.col("id").alias("for_id"), F.col("row").alias("for_row"), cut.alias("cut"), "next_id", "next_row").hint("merge")
    given = source.join(wanted, _same(wanted, "next_id", "next_row", source)).select(
        "for_id", "for_row", F.substring("text", F.lit(1), F.col("cut")).alias("begin")
    )
    given = given.dropDuplicates(["for_id", "for_row"]).hint("merge")
    texts = source.join(given, _same(given, "for_id", "for_row", source)).select(
        "id", "row", "text", F.length("text").alias("n"), "begin"
    )
    stays = F.substring("text", F.lit(1), F.col("n") - F.floor(F.col("n") / 3).cast("int"))
    texts = texts.select("id", "row", F.col("n").cast("long").alias("n_chars"), "text", F.concat(stays, F.col("begin")).alias("edited"))
    texts = texts.select("*", F.sha2("edited", 256).alias("edited_sha256"))
    printed = kept(order_minhash(order_minhash(texts, "text", "own"), "edited", "changed"), "fingerprints")
    nexts = printed.select(F.col("id").alias("of_id"), F.col("row").alias("of_row"), F.col("own").alias("next_own")).dropDuplicates(["of_id", "of_row"])
    after = pairs.select("id", "row", "next_id", "next_row").hint("merge")
    linked = after.join(nexts.hint("merge"), after["next_id"].eqNullSafe(nexts["of_id"]) & (after["next_row"] == nexts["of_row"]))
    linked = linked.select(F.col("id").alias("for_id"), F.col("row").alias("for_row"), "next_own").hint("merge")
    return printed.join(linked, _same(linked, "for_id", "for_row", printed)).select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited_sha256",
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))
