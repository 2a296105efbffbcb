"""Near-duplicates on word shingles: MinHash with tensored banding, then full-set verification.

Two collections of ``SIDE`` band hashes are computed; every pair (one from each) forms the key
of one table. So ``SIDE``**2 tables of ``2 * BAND`` rows need ``2 * SIDE * BAND`` minhashes
instead of ``SIDE**2 * 2 * BAND``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.common import as_bytes, documents, kept, mixed, slices, word_hashes
from tidewatt.llm.components import components

PERCENT = 80
#: At similarity 0.8 a pair shares a key with probability (1 - (1 - 0.8**3)**10)**2 = 0.998.
SIDE, BAND = 10, 3
SKETCH = 2 * SIDE * BAND
#: Of 60 minhashes a pair of similarity 0.8 shares 48 on average, under 30 with odds of 1e-7.
LEAST_SHARED = 30
#: Buckets up to this size compare all pairs across their components at once.
SMALL = 16
#: Larger ones first compare all their nodes with so many drawn ones per key.
DRAWS = 2
#: What that leaves apart is compared block by block: nodes and bytes of shingles in a block.
BLOCK_NODES, BLOCK_BYTES = 128, 8 << 20

_draw = np.random.default_rng(20_240_229)
_FACTORS = _draw.integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 1 << 63, SKETCH, dtype=np.uint64)
_PLACES = _draw.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words are one shingle, none is empty."""
    for low, high in slices(texts):
        hashes, counts = word_hashes(texts[low:high])
        sums = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
        for place in range(words):
            sums += hashes[place : place + len(sums)] * _PLACES[place]
        sums = mixed(sums)
        start = 0
        for count in counts.tolist():
            if count >= words:
                yield np.unique(sums[start : start + count - words + 1])
            elif count:
                short = (hashes[start : start + count] * _PLACES[:count]).sum(dtype=np.uint64)
                yield mixed(np.array([short + np.uint64(count)], dtype=np.uint64))
            else:
                yield np.empty(0, dtype=np.uint64)
            start += count


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH`` minhashes of 32 bits."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(shingles), 4096):
        part = shingles[low : low + 4096, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _bands(sketches: np.ndarray) -> np.ndarray:
    return mixed((sketches.reshape(len(sketches), 2, SIDE, BAND).astype(np.uint64) * _PLACES[:BAND]).sum(axis=3, dtype=np.uint64))


def table_keys(sketches: np.ndarray) -> np.ndarray:
    """``SIDE``**2 keys per row of sketches: all pairs of a band of each collection."""
    bands = _bands(sketches)
    pairs = bands[:, 0, :, None] * _PLACES[10] + bands[:, 1, None, :] * _PLACES[11]
    number = np.arange(SIDE * SIDE, dtype=np.uint64)
    return mixed(pairs.reshape(len(sketches), -1) + number * _PLACES[12])


def _sketched(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """(id, n_shingles, whole_hi, whole_lo, sketch); the two wholes stand for the full set."""
    source = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    fields = [("id", source.schema["id"].dataType), ("n_shingles", T.LongType()), ("whole_hi", T.LongType()), ("whole_lo", T.LongType()), ("sketch", T.BinaryType())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low, sketches = [], [], [], []
            for found in shingle_sets(as_bytes(batch, "text"), words):
                sizes.append(len(found))
                high.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                low.append(int(mixed(found).sum(dtype=np.uint64).view(np.int64)))
                sketches.append(sketch(found).tobytes() if len(found) else None)
            columns = [pa.array(c, pa.int64()) for c in (sizes, high, low)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(sketches, pa.binary())], names=[n for n, _ in fields])

    return source.mapInArrow(rows, T.StructType([T.StructField(n, t) for n, t in fields]))


def half_keys(sketches: np.ndarray) -> np.ndarray:
    """``SIDE`` keys per row of sketches, the bands of the first collection: rows that share a key
    of ``table_keys`` share one of these."""
    return mixed(_bands(sketches)[:, 0] + np.arange(SIDE, dtype=np.uint64) * _PLACES[13])


def _keyed(nodes: DataFrame, keys_of: Callable[[np.ndarray], np.ndarray] = table_keys) -> DataFrame:
    """(key, node) for every table."""
    node_type = nodes.schema["node"].dataType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", node_type)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = batch.column(1).to_pylist()
            for low in range(0, len(sketches), 2000):
                part = sketches[low : low + 2000]
                keys = keys_of(np.frombuffer(b"".join(part), dtype="<u4").reshape(len(part), SKETCH))
                at = np.repeat(np.arange(low, low + len(part)), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), batch.column(0).take(pa.array(at))], names=["key", "node"])

    return nodes.select("node", "sketch").mapInArrow(rows, schema)


def _buckets(keyed: DataFrame) -> DataFrame:
    """(key, node, hub) of the keys that several nodes share; the hub is the run's first node.

    Rows are range-partitioned by key and node, so a key of any size is cut over partitions.
    Each partition streams its runs. A run at the edge of a partition may go on in the next one:
    it is given out even if it is a single row, and the hubs of one key are linked by the caller.
    """
    node_type = keyed.schema["node"].dataType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", node_type), T.StructField("hub", node_type)])

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``hub``: first node of the run that is open; ``alone``: its only row so far was not given out.
        key = hub = None
        first, alone = True, False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            goes_on = key is not None and keys[0] == key
            give = np.repeat(sizes > 1, sizes)
            hubs = np.repeat(starts, sizes)
            out_keys, out_nodes, out_hubs = [], [], []
            if goes_on:
                give[: sizes[0]] = True
                if alone:
                    out_keys, out_nodes, out_hubs = [key], [hub], [hub]
            elif first or key is None:
                give[: sizes[0]] = True
            kind = batch.column(1).type
            open_row = bool(sizes[-1] == 1 and not give[-1])
            at = np.flatnonzero(give)
            nodes = batch.column(1).take(pa.array(at))
            centre = batch.column(1).take(pa.array(hubs[at]))
            if goes_on:
                own = int(sizes[0])
                centre = pa.concat_arrays([pa.array([hub] * own, kind), centre.slice(own)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(out_keys, pa.int64()), pa.array(keys[at])]),
                    pa.concat_arrays([pa.array(out_nodes, kind), nodes]),
                    pa.concat_arrays([pa.array(out_hubs, kind), centre]),
                ],
                names=["key", "node", "hub"],
            )
            first = False
            if not (goes_on and len(starts) == 1):
                key, hub, alone = int(keys[-1]), batch.column(1)[int(starts[-1])].as_py(), open_row
            else:
                alone = False
        if alone:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([hub], kind), pa.array([hub], kind)], names=["key", "node", "hub"])

    return keyed.repartitionByRange("key", "node").sortWithinPartitions("key", "node").mapInArrow(streamed, schema)


def _sets(docs: DataFrame, wanted: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """(node, shingles) of the wanted documents, from their whole texts."""
    source = (
        docs.select(docs[id_column].alias("node"), docs[text_column].cast("string").alias("text"))
        .join(wanted.hint("merge"), "node", "left_semi")
    )
    schema = T.StructType([source.schema["node"], T.StructField("shingles", T.BinaryType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(as_bytes(batch, "text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=schema.names)

    return source.mapInArrow(rows, schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("one"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("two"))
    # Sizes alone rule out many pairs before the sets meet.
    sized = (
        pairs.join(left.hint("merge"), "u")
        .join(right.hint("merge"), "v")
        .where((100 * F.length("one") >= percent * F.length("two")) & (100 * F.length("two") >= percent * F.length("one")))
    )

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if one == two:
                    keep.append(True)
                    continue
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return sized.select("u", "v", "one", "two").mapInArrow(similar, pairs.schema)


def _placed(keyed: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, key, component): a node without links is its own component."""
    return keyed.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _across(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs (u, v) across the components of a bucket that share most minhashes, not yet tested.

    A bucket within one component asks for nothing, so copies are never expanded into pairs. A
    bucket of up to ``SMALL`` nodes gives all its pairs across components, a larger one those with
    nodes drawn for each key, ``DRAWS`` rows per node; ``_rest`` does what is left of it.
    """
    placed = _placed(buckets, labels)
    draws = [F.min(F.struct(F.xxhash64("node", "key", F.lit(n)), "node", "component")) for n in range(DRAWS)]
    several = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.array(*draws).alias("draws"))
        .where("low <> high")
    )
    rows = placed.join(several, "key")
    apart = F.filter("draws", lambda draw: draw["component"] != F.col("component"))
    stars = rows.where(F.col("n") > SMALL).select("node", F.explode(apart).alias("drawn")).select("node", F.col("drawn.node").alias("other"))
    few = rows.where(F.col("n") <= SMALL).select("key", "node", "component")
    others = few.select("key", F.col("node").alias("other"), F.col("component").alias("far"))
    stars = stars.unionByName(few.join(others, "key").where("component < far").select("node", "other"))
    pairs = stars.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).where("u <> v").distinct()
    one = nodes.select(F.col("node").alias("u"), F.col("sketch").alias("one")).hint("merge")
    two = nodes.select(F.col("node").alias("v"), F.col("sketch").alias("two")).hint("merge")
    known = pairs.join(tested, ["u", "v"], "left_anti").join(one, "u").join(two, "v").select("u", "v", "one", "two")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, SKETCH) for i in (2, 3))
            yield batch.select(["u", "v"]).filter(pa.array((one == two).sum(axis=1) >= LEAST_SHARED))

    return known.mapInArrow(shared, tested.schema)


def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``one`` shares with each of ``two``."""
    values, at = np.unique(np.concatenate([*one, *two]), return_inverse=True)
    # A shingle of a single set is shared with nobody.
    several = np.bincount(at, minlength=len(values)) > 1
    column = np.where(several, np.cumsum(several) - 1, -1)[at]
    owner = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in (*one, *two)])
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    found = np.zeros((len(one), len(two)), dtype=np.int64)
    for low in range(0, int(several.sum()), 4096):
        start, end = np.searchsorted(column, (low, low + 4096))
        held = np.zeros((len(one) + len(two), 4096), dtype=np.float32)
        held[owner[start:end], column[start:end] - low] = 1
        found += (held[: len(one)] @ held[len(one) :].T).astype(np.int64)
    return found


def _joining(one: np.ndarray, two: np.ndarray, names: list) -> list[int]:
    """Positions of the links that are enough to join what all links (one[i], two[i]) join."""
    parent = {name: name for name in names}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    enough = []
    for at, (i, j) in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
        a, b = root(names[i]), root(names[j])
        if a != b:
            parent[a] = b
            enough.append(at)
    return enough


def _rest(buckets: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that join all components which any pair within a large bucket joins.

    The nodes of large buckets that hold several components meet by their half-keys. Of each
    half-key, the nodes outside its most frequent component are compared with one another and with
    that component, on full sets and in salted blocks: a group gets one row per node and block it
    meets, no pair is a row, and a block pair gives fewer links than it has nodes.
    """
    placed = _placed(buckets, labels)
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    unsettled = several.where((F.col("n") > SMALL) & (F.col("low") != F.col("high"))).select("key")
    nodes = kept(placed.join(unsettled, "key").select("node").distinct(), "open-nodes")
    node_type = nodes.schema["node"].dataType
    schema = T.StructType([T.StructField("u", node_type), T.StructField("v", node_type)])
    if nodes.isEmpty():
        return nodes.sparkSession.createDataFrame([], schema)
    sized = classes.join(nodes.hint("merge"), "node", "left_semi")
    meeting = kept(_placed(_keyed(sized, half_keys), labels).join(sized.select("node", (8 * F.col("n_shingles")).alias("bytes")).hint("merge"), "node"), "half-keys")
    parts = meeting.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_NODES, size / BLOCK_BYTES)).cast("int")
    main = F.max(F.struct("n", "bytes", "component"))
    plan = (
        parts.groupBy("key")
        .agg(main.alias("main"), (F.sum("n") - F.max("n")).alias("n"), F.sum("bytes").alias("bytes"))
        .where("n > 0")
        .select("key", F.col("main.component").alias("main"), blocks(F.col("n"), F.col("bytes") - F.col("main.bytes")).alias("rest"), blocks(F.col("main.n"), F.col("main.bytes")).alias("mains"))
    )
    salt, inside = F.xxhash64("node", "key"), F.col("component") == F.col("main")
    dealt = meeting.join(plan, "key").withColumn("block", F.when(inside, F.col("rest") + F.pmod(salt, F.col("mains"))).otherwise(F.pmod(salt, F.col("rest"))).cast("int"))
    others = F.sequence(F.lit(0), F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("mains")) - 1)
    met = dealt.join(sets.hint("merge"), "node").select("key", "node", "component", "shingles", "block", F.explode(others).alias("other"))
    met = met.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "component", "shingles")

    def linked(group: pa.Table) -> pa.Table:
        block, own = group.column("block").to_numpy(), group.column("component").to_pylist()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
        number = {name: n for n, name in enumerate(dict.fromkeys(own))}
        place = np.array([number[name] for name in own])
        taken = np.empty((2, 0), dtype=np.int64)
        if len(number) > 1 and len(one) and len(two):
            found = [np.frombuffer(value, np.uint64) for value in group.column("shingles").to_pylist()]
            size = np.array([len(s) for s in found])
            common = _common([found[i] for i in one], [found[i] for i in two])
            near = 100 * common >= percent * (size[one][:, None] + size[two] - common)
            i, j = np.nonzero(near & (place[one][:, None] != place[two]))
            enough = _joining(place[one[i]], place[two[j]], list(range(len(number))))
            taken = np.stack([one[i[enough]], two[j[enough]]])
        node = group.column("node").combine_chunks()
        return pa.table({"u": node.take(pa.array(taken[0])), "v": node.take(pa.array(taken[1]))})

    return met.groupBy("key", "low", "high").applyInArrow(linked, schema)


def _hub_labels(links: DataFrame) -> DataFrame:
    """(node, component): the least hub of each node, or that hub's; at least as fine as components."""
    least = links.groupBy("u").agg(F.min("v").alias("v"))
    above = least.select(F.col("u").alias("v"), F.col("v").alias("w"))
    return kept(least.join(above, "v", "left").select(F.col("u").alias("node"), F.coalesce("w", "v").alias("component")), "hub-labels")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of ``docs``.

    Documents are linked if their sets of ``words``-word shingles have a Jaccard similarity of
    at least ``percent`` / 100; ``component_id`` is the least id reachable over links, ``kept``
    whether it is the document's own. Equal sets are one node. Null, empty and wordless texts
    have no shingles and no links; a shorter text is one shingle. Rows with the same id are one
    document, so they share a component; a row without id is linked with nothing (component
    null, kept). Other columns are not read.

    First every node is verified against the hub of each of its buckets. Buckets that then still
    hold several components go on: small ones with all pairs across components, large ones with
    stars around ``DRAWS`` nodes drawn for each key, then with all pairs across the components
    that are left, compared in blocks. So every pair that shares a key ends in one component or
    is compared; a group grows with its nodes times those that its largest component did not
    take in, which is the square of it only where nearly nothing links.
    """
    rows = kept(_sketched(docs, words, id_column, text_column), "sketches")
    id_type = rows.schema["id"].dataType
    whole = ["whole_hi", "whole_lo", "n_shingles"]
    classes = (
        rows.where("id IS NOT NULL AND n_shingles > 0")
        .groupBy(*whole)
        .agg(F.min("id").alias("node"), F.first("sketch").alias("sketch"))
    )
    classes = kept(classes, "classes")
    buckets = kept(_buckets(_keyed(classes)), "buckets")
    hubs = buckets.select("key", "hub").distinct().groupBy("key").agg(F.min("hub").alias("v"), F.max("hub").alias("u"), F.count("*").alias("n"))
    # Hubs of a key cut over partitions: linked to the least of them.
    cut = buckets.select("key", "hub").distinct().join(hubs.where("n > 1").select("key", "v"), "key").select(F.col("hub").alias("u"), "v")
    stars = buckets.select(F.col("node").alias("u"), F.col("hub").alias("v")).unionByName(cut).where("u <> v").distinct()
    stars = kept(stars, "stars")
    wanted = buckets.select("node").distinct()
    sets = kept(_sets(docs, wanted, words, id_column, text_column), "sets")
    links = kept(_confirmed(stars, sets, percent), "links")
    late = kept(_across(buckets, _hub_labels(links), classes, stars), "late-pairs")
    links = links.unionByName(kept(_confirmed(late, sets, percent), "late-links"))
    labels = components(links)
    rest = kept(_rest(buckets, labels, classes, sets, percent), "rest-links")
    if not rest.isEmpty():
        labels = components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(rest))
    # An id with several rows may stand for several sets: its nodes are one document.
    repeated = rows.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    member = rows.where("n_shingles > 0").join(classes.select(*whole, "node"), whole).select("id", "node")
    labelled = member.join(labels, "node", "left").select("id", F.coalesce("component", "node").alias("component"))
    if not repeated.isEmpty():
        linked = labelled.join(repeated, "id", "left_semi").select(F.col("id").alias("u"), F.col("component").alias("v"))
        merged = components(linked)
        labelled = labelled.join(merged.withColumnRenamed("component", "merged"), F.col("component") == F.col("node"), "left").select(
            "id", F.coalesce("merged", "component").alias("component")
        )
    labelled = labelled.groupBy("id").agg(F.min("component").alias("component"))
    found = rows.select("id", "n_shingles").join(labelled, "id", "left")
    component = F.coalesce(F.col("component"), F.col("id")).cast(id_type)
    return found.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``; rows without id stay."""
    found = near_duplicates(docs, words, percent, id_column, text_column)
    keep = found.where("kept").select(F.col(id_column).alias("__kept")).where("__kept IS NOT NULL").distinct()
    named = docs.where(docs[id_column].isNotNull()).join(keep.hint("merge"), docs[id_column] == F.col("__kept"), "left_semi")
    return named.dropDuplicates([id_column]).unionByName(docs.where(docs[id_column].isNull()))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=4)


OP8_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), classes AS (
    SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS node
    FROM (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS whole FROM shingles GROUP BY doc_id)
), nodes AS (
    SELECT s.doc_id, s.s FROM shingles s JOIN classes c ON s.doc_id = c.doc_id AND c.node = c.doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM nodes a JOIN nodes b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, least) AS (
    SELECT DISTINCT node, node FROM classes
    UNION
    SELECT e.b, r.least FROM reach r JOIN both_ways e ON e.a = r.node
), components AS (
    SELECT node, min(least) AS component FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(k.component, d.doc_id)::BIGINT AS component_id,
       coalesce(k.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN classes c ON c.doc_id = d.doc_id
LEFT JOIN components k ON k.node = c.node
"""
