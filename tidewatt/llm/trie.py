"""Prefix trie of conversations by fixed-length block digests.

A turn at a place has two 64-bit hashes of (place, role, text); the key of a prefix is the pair of
their sums, so the key of a block is a difference and prefixes of any length cost one running sum.
Conversations are grouped by their blocks of ``BLOCK`` turns under the key of all blocks before.
Where a parent has one block, all its turns are chain nodes with the counts of the block. Only
where sibling blocks diverge are the distinct blocks, not the conversations, cut into turns.

The smallest member owns a node, so the nodes of an owner are one unbroken chain of depths, and
the trie is a tree of chains with one row per owner. Subtree sums are taken over that small tree by
pointer doubling and then along each chain by running sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatt.llm.common import kept, table
from tidewatt.llm.turns import CRC32_SQL, content_digest, numbered, running

#: Turns of a block.
BLOCK = 4
#: Members of a node whose ids are joined into one piece of text before they are hashed.
PIECE = 1 << 15
_EMPTY = hashlib.sha256(b"").hexdigest()
_SUM = "decimal(38,0)"


def turn_steps(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, pos, digest, n_bytes) of every turn; ``pos`` counts from 0 along ``turn``.

    Null turns come first; rows of one turn follow their digest. Null role or text is empty. Rows
    without a conversation id are left out.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        content_digest(F.coalesce(F.col(role).cast("string"), F.lit("")), said).alias("digest"),
        F.octet_length(said).cast("long").alias("n_bytes"),
    )
    return numbered(rows, "conv_id", [F.asc_nulls_first("turn"), F.asc("digest")], "trie-turns").drop("turn")


def _blocks(steps: DataFrame, block: int) -> DataFrame:
    """A row for each block of a conversation: its turns' prefix sums and the key before it."""
    hashed = steps.select(
        "conv_id",
        "pos",
        "n_bytes",
        F.floor(F.col("pos") / block).cast("long").alias("block"),
        F.xxhash64("pos", "digest").cast(_SUM).alias("hi"),
        F.xxhash64("digest", "pos", F.lit("lo")).cast(_SUM).alias("lo"),
    )
    along = Window.partitionBy("conv_id", "block").orderBy("pos")
    turns = F.sort_array(F.collect_list(F.struct("pos", "hi", "lo", "n_bytes")))
    blocks = (
        hashed.withColumn("hi", F.sum("hi").over(along).cast(_SUM))
        .withColumn("lo", F.sum("lo").over(along).cast(_SUM))
        .groupBy("conv_id", "block")
        .agg(turns.alias("turns"))
        .withColumn("hi", F.element_at("turns", -1).hi)
        .withColumn("lo", F.element_at("turns", -1).lo)
    )
    summed = running(blocks, ["conv_id"], "block", {"hi": "up_hi", "lo": "up_lo"}).drop("up_hi_all", "up_lo_all")
    return summed.withColumn("up_hi", F.col("up_hi").cast(_SUM)).withColumn("up_lo", F.col("up_lo").cast(_SUM))


def _turn_nodes(blocks: DataFrame) -> DataFrame:
    """A row for each turn of each distinct block: key and parent key of the prefix that ends there."""
    rows = blocks.select("*", F.posexplode("turns").alias("at", "step"))
    earlier = F.when(F.col("at") > 0, F.try_element_at("turns", F.col("at")))
    before = lambda part: F.coalesce(earlier[part], F.lit(0).cast(_SUM))
    return rows.select(
        (F.col("step.pos") + 1).alias("depth"),
        *[(F.col(f"up_{x}") + F.col("step")[x]).cast(_SUM).alias(x) for x in ("hi", "lo")],
        *[(F.col(f"up_{x}") + before(x)).cast(_SUM).alias(f"up_{x}") for x in ("hi", "lo")],
        F.col("step.n_bytes").alias("n_bytes"),
        "n_convs",
        "owner",
    )


def _nodes(blocks: DataFrame) -> DataFrame:
    """Every node below the root: (depth, hi, lo, up_hi, up_lo, n_bytes, n_convs, owner)."""
    distinct = blocks.groupBy("block", "up_hi", "up_lo", "hi", "lo").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.first("turns").alias("turns")
    )
    distinct = kept(distinct, "trie-distinct")
    # An only child names itself, so the lookup is by the block and no parent gathers its children.
    siblings = distinct.groupBy("block", "up_hi", "up_lo").agg(F.count("*").alias("siblings"), F.min(F.struct("hi", "lo")).alias("one"))
    only = siblings.where("siblings = 1").select("block", "up_hi", "up_lo", "one.hi", "one.lo", F.lit(True).alias("only"))
    told = kept(distinct.join(only, ["block", "up_hi", "up_lo", "hi", "lo"], "left").drop("hi", "lo"), "trie-blocks")
    alone = _turn_nodes(told.where("only"))
    refined = (
        _turn_nodes(told.where("only is null"))
        .groupBy("depth", "hi", "lo")
        .agg(
            F.first("up_hi").alias("up_hi"),
            F.first("up_lo").alias("up_lo"),
            F.first("n_bytes").alias("n_bytes"),
            F.sum("n_convs").alias("n_convs"),
            F.min("owner").alias("owner"),
        )
    )
    return kept(alone.unionByName(refined), "trie-nodes")


def _ends(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256) of the nodes at which conversations end."""
    zero = F.lit(0).cast(_SUM)
    last = blocks.groupBy("conv_id").agg(
        F.max(F.struct("block", F.element_at("turns", -1).pos.alias("pos"), *[(F.col(f"up_{x}") + F.col(x)).cast(_SUM).alias(x) for x in ("hi", "lo")])).alias("end")
    )
    ends = ids.join(last, "conv_id", "left").select(
        F.coalesce(F.col("end.pos") + 1, F.lit(0).cast("long")).alias("depth"),
        F.coalesce("end.hi", zero).alias("hi"),
        F.coalesce("end.lo", zero).alias("lo"),
        "conv_id",
    )
    return hashed_ids(ends)


def hashed_ids(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ``conv_id`` of each (depth, hi, lo).

    Ids are range-partitioned and joined into pieces of at most ``piece`` ids where they lie; the
    hash then takes the pieces of a node in order, one at a time, so memory does not grow with a
    node's members.
    """
    spots = ["depth", "hi", "lo"]
    ranged = ends.repartitionByRange(*spots, "conv_id").sortWithinPartitions(*spots, "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, found = None, []

        def row() -> pa.RecordBatch:
            values = [*spot, found[0], ",".join(map(str, found))]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=[*spots, "first", "ids"])

        kinds = [pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.int64(), pa.string()]
        for batch in batches:
            out = []
            for *at, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if found and (at != spot or len(found) == piece):
                    out.append(row())
                    found = []
                spot = at
                found.append(conv)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if found:
            yield row()

    joined = ranged.mapInArrow(pieces, f"depth long, hi {_SUM}, lo {_SUM}, first long, ids string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, state = None, None

        def made(done: list) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = [pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*spots, "ends_sha256"])

        for batch in batches:
            done = []
            for depth, hi, lo, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = (depth, hi, lo)
                if at != spot:
                    if state is not None:
                        done.append((*spot, state.hexdigest()))
                    spot, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield made(done)
        if state is not None:
            yield made([(*spot, state.hexdigest())])

    ordered = joined.repartition(*[F.col(c) for c in spots]).sortWithinPartitions(*spots, "first")
    return ordered.mapInArrow(digests, f"depth long, hi {_SUM}, lo {_SUM}, ends_sha256 string")


def _chains(nodes: DataFrame, root: int) -> DataFrame:
    """(owner, bottom, up_owner, up_depth) per chain; a chain at depth 1 hangs from the root."""
    tops = nodes.groupBy("owner").agg(F.min(F.struct("depth", "up_hi", "up_lo")).alias("top"), F.max("depth").alias("bottom"))
    tops = tops.where(F.col("owner") != root).select(
        "owner", "bottom", (F.col("top.depth") - 1).alias("up_depth"), F.col("top.up_hi").alias("hi"), F.col("top.up_lo").alias("lo")
    )
    spots = nodes.select(F.col("depth").alias("up_depth"), "hi", "lo", F.col("owner").alias("up_owner"))
    deep = tops.where("up_depth > 0").join(spots, ["up_depth", "hi", "lo"])
    shallow = tops.where("up_depth = 0").withColumn("up_owner", F.lit(root).cast("long"))
    return kept(shallow.unionByName(deep).drop("hi", "lo"), "trie-chains")


def _totals(chains: DataFrame, root: int) -> DataFrame:
    """``leaves`` and ``saved`` of each chain with all chains below it, by pointer doubling.

    A row starts with what its chain owns. In every round it adds the sums of the rows whose pointer
    leads to it, and pointers double their reach: as many rounds as the logarithm of the depth.
    Pointers to the root chain end there: its own sums come from the whole table.
    """
    state = chains.select("owner", "leaves", "saved", F.when(F.col("up_owner") != root, F.col("up_owner")).alias("up"))
    state = kept(state, "trie-sums")
    while not state.where("up is not null").isEmpty():
        below = state.where("up is not null")
        gains = below.groupBy(F.col("up").alias("owner")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        jumps = below.select("owner", "up").join(state.select(F.col("owner").alias("up"), F.col("up").alias("next")), "up").select("owner", "next")
        state = kept(
            state.join(gains, "owner", "left")
            .join(jumps, "owner", "left")
            .select(
                "owner",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).cast("long").alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).cast(_SUM).alias("saved"),
                F.col("next").alias("up"),
            ),
            "trie-sums",
        )
    return state.drop("up")


def prefix_trie(steps: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the prefix trie over ``steps`` (conv_id, pos, digest, n_bytes).

    ``ids`` (conv_id) names every conversation, those without turns too; they end at the root.
    ``pos`` counts the turns of a conversation from 0 without gaps. A node is (conv_id, depth): its
    smallest member and the length of its prefix. Empty input gives no node, not even a root.
    Other columns of the inputs are not read.
    """
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    spark = steps.sparkSession
    ids = ids.select("conv_id").distinct()
    root, members = ids.agg(F.min("conv_id"), F.count("*")).first()
    if root is None:
        return spark.createDataFrame([], schema)
    blocks = kept(_blocks(steps.select("conv_id", "pos", "digest", "n_bytes"), block), "trie-turn-blocks")
    below = _nodes(blocks)
    chains = _chains(below, root)
    top = spark.createDataFrame([(0, 0, 0, members, root)], "depth long, hi long, lo long, n_convs long, owner long").select(
        "depth", *[F.col(x).cast(_SUM).alias(x) for x in ("hi", "lo")], F.lit(0).cast("long").alias("n_bytes"), "n_convs", "owner"
    )
    nodes = below.select(*top.columns).unionByName(top)

    hung = chains.groupBy(F.col("up_owner").alias("owner"), F.col("up_depth").alias("depth")).agg(F.count("*").alias("hung"))
    bottoms = nodes.groupBy("owner").agg(F.max("depth").alias("bottom"), F.sum((F.col("n_convs") - 1) * F.col("n_bytes")).cast(_SUM).alias("saved"))
    own = (
        bottoms.join(hung.withColumnRenamed("depth", "bottom"), ["owner", "bottom"], "left")
        .withColumn("leaves", F.when(F.col("hung").isNull(), 1).otherwise(0).cast("long"))
        .select("owner", "leaves", "saved", F.col("bottom").alias("low"))
    )
    totals = _totals(chains.drop("bottom").join(own, "owner"), root)
    sums = (
        chains.join(totals, "owner")
        .groupBy(F.col("up_owner").alias("owner"), F.col("up_depth").alias("depth"))
        .agg(F.count("*").alias("hung"), F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    )
    none = F.lit(0)
    lows = own.select("owner", F.col("low").alias("depth"), F.lit(True).alias("last"))
    valued = kept(
        nodes.join(sums, ["owner", "depth"], "left")
        .join(lows, ["owner", "depth"], "left")
        .withColumn("n_children", F.coalesce("hung", none) + F.when(F.col("last").isNull(), 1).otherwise(0))
        .withColumn("leaves", (F.coalesce("hung_leaves", none) + F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long"))
        .withColumn("saved", ((F.col("n_convs") - 1) * F.col("n_bytes") + F.coalesce("hung_saved", none)).cast(_SUM))
        .select("owner", "depth", "hi", "lo", "n_convs", "n_children", "leaves", "saved"),
        "trie-valued",
    )
    uppers = chains.select("owner", (F.col("up_depth") + 1).alias("depth"), "up_owner")
    return (
        running(valued, ["owner"], "depth", {"leaves": "leaves_before", "saved": "saved_before"})
        .join(uppers, ["owner", "depth"], "left")
        .join(_ends(blocks, ids), ["depth", "hi", "lo"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("up_owner", "owner")).alias("parent_conv_id"),
            "n_convs",
            F.col("n_children").cast("long").alias("n_children"),
            (F.col("leaves_before_all") - F.col("leaves_before")).cast("long").alias("n_leaves"),
            (F.col("saved_before_all") - F.col("saved_before")).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its five: 0 to 8."""
    return (F.crc32(conv.cast("string").cast("binary")) % 9).cast("long")


def rebuilt(steps: DataFrame) -> DataFrame:
    """``steps`` where every conversation begins with the first turns of conversation c - c % 5.

    Taken are as many as ``shared_turns`` says and are there; its own turns after as many follow.
    """
    spans = steps.groupBy("conv_id").agg(F.count("*").alias("n"))
    bases = spans.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    spans = (
        spans.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
        .withColumn("h", shared_turns(F.col("conv_id")))
        .join(bases, "base", "left")
        .select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))).alias("taken"))
    )
    wanted = spans.where("taken > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("pos"))
    first = wanted.join(steps.withColumnRenamed("conv_id", "base"), ["base", "pos"]).select("conv_id", "pos", "digest", "n_bytes")
    own = steps.join(spans, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "n_bytes")
    return first.unionByName(own)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the rebuilt conversations; see ``turn_steps``, ``rebuilt`` and ``prefix_trie``."""
    steps = kept(turn_steps(table(spark, sf_dir, "conversations")), "trie-steps")
    return prefix_trie(kept(rebuilt(steps), "trie-rebuilt"), steps.select("conv_id"))


OP11_SQL = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(text, '') AS text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS pos, digest, strlen(text) AS n_bytes FROM said
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32_SQL.format(text="conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), pieces AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.digest, t.n_bytes FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.digest, t.n_bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
), steps AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, digest, n_bytes FROM pieces
), paths AS (
    SELECT conv_id, depth, n_bytes, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM steps
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), owned AS (
    SELECT *, min(conv_id) OVER (PARTITION BY path) AS owner, count(*) OVER (PARTITION BY path) AS n_convs,
           depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS (
    SELECT owner, depth, path, any_value(n_convs) AS n_convs, any_value(n_bytes) AS n_bytes,
           string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
    FROM owned GROUP BY owner, depth, path
), parents AS (
    SELECT n.*, u.owner AS up FROM nodes n LEFT JOIN owned u ON u.conv_id = n.owner AND u.depth = n.depth - 1
), children AS (
    SELECT up AS owner, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE up IS NOT NULL GROUP BY ALL
), valued AS (
    SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM parents p LEFT JOIN children c ON c.owner = p.owner AND c.depth = p.depth
), sums AS (
    SELECT a.owner, a.depth, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.n_bytes) AS saved
    FROM valued v JOIN owned a ON a.conv_id = v.owner AND a.depth <= v.depth GROUP BY a.owner, a.depth
)
SELECT v.owner AS conv_id, v.depth, v.up AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN sums s ON s.owner = v.owner AND s.depth = v.depth
"""
