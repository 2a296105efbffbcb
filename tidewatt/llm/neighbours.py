"""Nearest neighbours by learned partitions: a balanced cut of a neighbour graph, and a router.

Fitted on a bounded sample: its nearest-neighbour graph is cut into parts of equal size with few
edges between them, and a softmax classifier learns to tell, from a vector alone, in which parts
its neighbours lie. Every row is indexed in its most probable part; a query visits as many of its
most probable parts as held-out sample rows need for the wished recall, and what it finds there is
ranked by the exact cosine. Rows, queries and ranking are Spark work; only the sample is on the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatt.llm.common import kept, table

#: Distinct vectors that the index is fitted on, at the most (expected; drawn by hash).
SAMPLE = 8192
#: Distinct vectors of a part, on average, and limits to the number of parts.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 1024, 8, 512
#: Vectors that are ranked at a time; larger parts are cut into cells of about this size.
CELL_ROWS = 4096
#: Neighbours of a graph node.
DEGREE = 10
#: Share of the held-out neighbours that the visited parts must hold.
RECALL = 0.95
NEAREST = 5
#: Queries whose scores against a cell are in memory at once.
QUERY_BLOCK = 64


@dataclass
class Router:
    """Weights of the classifier over ``parts`` parts, and how many of them a query visits."""

    weights: np.ndarray
    offsets: np.ndarray
    visits: int

    @property
    def parts(self) -> int:
        return len(self.offsets)

    def logits(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.weights + self.offsets

    def parts_of(self, unit: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` most probable parts of each row, most probable first."""
        return np.argsort(-self.logits(unit), axis=1, kind="stable")[:, :count]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def neighbour_graph(unit: np.ndarray, others: np.ndarray, degree: int, own: bool) -> np.ndarray:
    """For each row the positions of its ``degree`` nearest rows of ``others``, itself left out if ``own``."""
    degree = min(degree, len(others) - own)
    found = np.empty((len(unit), degree), np.int64)
    for start in range(0, len(unit), 512):
        near = unit[start : start + 512] @ others.T
        if own:
            near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        found[start : start + 512] = np.argpartition(-near, degree - 1, axis=1)[:, :degree] if degree else 0
    return found


def balanced_seeds(unit: np.ndarray, parts: int, room: int, draw: np.random.Generator, rounds: int = 4) -> np.ndarray:
    """A first balanced assignment: rows ask for their nearest seed with room, the closest win."""
    seeds = unit[draw.choice(len(unit), parts, replace=False)]
    for _ in range(rounds):
        near = unit @ seeds.T
        part = np.full(len(unit), -1)
        free = np.full(parts, room)
        while (open_rows := np.flatnonzero(part < 0)).size:
            wish = np.where(free > 0, near[open_rows], -np.inf).argmax(axis=1)
            for p in np.unique(wish):
                asking = open_rows[wish == p]
                won = asking[np.argsort(-near[asking, p], kind="stable")[: free[p]]]
                part[won] = p
                free[p] -= len(won)
        sums = np.zeros_like(seeds)
        np.add.at(sums, part, unit)
        seeds = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return part


def refined_cut(part: np.ndarray, graph: np.ndarray, parts: int, room: int, rounds: int = 12) -> np.ndarray:
    """Moves nodes to the part of most of their neighbours while that part has room: fewer cut edges.

    Edges count in both directions. Moves are tried by falling gain against the state at the
    beginning of the round, each node at most once in a round.
    """
    rows = np.arange(len(part))
    ends = np.concatenate([np.repeat(rows, graph.shape[1]), graph.ravel()])
    others = np.concatenate([graph.ravel(), np.repeat(rows, graph.shape[1])])
    floor = max(1, int(0.8 * len(part) / parts))
    for _ in range(rounds):
        links = np.zeros((len(part), parts), np.float32)
        np.add.at(links, (ends, part[others]), 1)
        best = links.argmax(axis=1)
        gain = links[rows, best] - links[rows, part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for row in np.argsort(-gain, kind="stable"):
            if gain[row] <= 0:
                break
            if sizes[best[row]] < room and sizes[part[row]] > floor:
                sizes[part[row]] -= 1
                sizes[best[row]] += 1
                part[row] = best[row]
                moved += 1
        if not moved:
            break
    return part


def fit_classifier(unit: np.ndarray, wish: np.ndarray, draw: np.random.Generator, epochs: int = 30, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Softmax weights for the shares ``wish`` of each row over the parts, by Adam on cross entropy."""
    weights, offsets = np.zeros((unit.shape[1], wish.shape[1])), np.zeros(wish.shape[1])
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, offsets)]
    step, scale = 0, np.sqrt(unit.shape[1])
    for _ in range(epochs):
        order = draw.permutation(len(unit))
        for start in range(0, len(order), 512):
            rows = order[start : start + 512]
            x = unit[rows] * scale
            logits = x @ weights + offsets
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            slope = (odds / odds.sum(axis=1, keepdims=True) - wish[rows]) / len(rows)
            step += 1
            for value, grad, (mean, square) in zip((weights, offsets), (x.T @ slope + 1e-4 * weights, slope.sum(axis=0)), state, strict=True):
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return weights * scale, offsets


def fit_router(vectors: np.ndarray, rows: int, recall: float = RECALL, nearest: int = NEAREST, seed: int = 7) -> Router:
    """The router for a table of ``rows`` distinct vectors, from the sample ``vectors``.

    A quarter of the sample is held out. The number of visited parts is the least at which the
    parts that the classifier gives to the other rows hold ``recall`` of the held-out rows' nearest.
    Fewer than 64 vectors make one part.
    """
    unit = unit_rows(vectors)
    parts = int(np.clip(rows // PART_ROWS, LEAST_PARTS, MOST_PARTS))
    parts = min(parts, len(unit) // 16)
    if len(unit) < 64:
        return Router(np.zeros((unit.shape[1], 1)), np.zeros(1), 1)
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(unit))
    tried, fitted = unit[order[: len(unit) // 4]], unit[order[len(unit) // 4 :]]
    graph = neighbour_graph(fitted, fitted, DEGREE, own=True)
    room = int(np.ceil(1.1 * len(fitted) / parts))
    part = refined_cut(balanced_seeds(fitted, parts, room, draw), graph, parts, room)
    wish = np.zeros((len(fitted), parts))
    np.add.at(wish, (np.repeat(np.arange(len(fitted)), graph.shape[1]), part[graph].ravel()), 1.0 / (graph.shape[1] + 1))
    wish[np.arange(len(fitted)), part] += 1.0 / (graph.shape[1] + 1)
    router = Router(*fit_classifier(fitted, wish, draw), parts)
    home = router.parts_of(fitted, 1)[:, 0]
    wanted = home[neighbour_graph(tried, fitted, nearest, own=False)]
    ranks = np.argsort(router.parts_of(tried, parts), axis=1)
    needed = np.sort(ranks[np.arange(len(tried))[:, None], wanted].ravel())
    router.visits = int(needed[int(np.ceil(recall * len(needed))) - 1]) + 1
    return router


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector): one row of doubles for each id, without vectors that take no part.

    Left out are null and empty vectors, those with a null, NaN or infinite component, all-zero ones
    and rows without an id. An id given more than once stands for the least of its usable vectors.
    """
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector")).where("vec_id is not null and vector is not null")
    return rows.where(finite & F.exists("vector", lambda x: x != 0.0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def distinct_vectors(rows: DataFrame, copies: int) -> DataFrame:
    """(vector, ids): equal vectors once, with their ``copies`` smallest ids.

    No more ids of one vector can be among the ``copies`` - 1 nearest of any query, so this loses
    nothing, and a vector that many rows share costs each task ``copies`` rows.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= copies)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _routed(rows: DataFrame, router: Router, visits: int) -> DataFrame:
    """``rows`` with ``parts``, the most probable ones of ``vector``, most probable first."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), len(router.weights))
            parts = router.parts_of(unit_rows(vectors), visits)
            lists = pa.ListArray.from_arrays(np.arange(0, parts.size + 1, visits, dtype=np.int32), pa.array(parts.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "parts"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(route, f"{ddl}, parts array<int>")


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision; a row's value does not depend on the rows beside it."""
    q = np.ldexp(query, -np.frexp(np.abs(query).max())[1])
    r = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return (r * q).sum(axis=1) / (np.sqrt((r * r).sum(axis=1)) * np.sqrt((q * q).sum()))


def nearest_of(query_id: int, query: np.ndarray, near: np.ndarray, rows: np.ndarray, ids: list[list[int]], nearest: int) -> list[tuple[int, float]]:
    """The ``nearest`` (id, cosine) among ``rows`` for one query, from rough cosines ``near``.

    One more vector than wanted is looked at, as one may stand for the query alone, and all whose
    rough value is level with the last of them; these are scored exactly.
    """
    if len(near) > nearest + 1:
        level = np.partition(near, -(nearest + 1))[-(nearest + 1)]
        near_rows = np.flatnonzero(near >= level - 1e-9)
    else:
        near_rows = np.arange(len(near))
    scores = _exact(query, rows[near_rows])
    found = [(-float(s), i) for r, s in zip(near_rows, scores, strict=True) for i in ids[r] if i != query_id]
    return [(i, -s) for s, i in sorted(found)[:nearest]]


def _ranked(nearest: int):
    """Ranks cell by cell: the vectors of a cell come first and stay, its queries stream past."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, pieces, rows, unit, ids = None, [], None, None, []

        def answer(queries: pa.RecordBatch) -> pa.RecordBatch:
            out = ([], [], [])
            names = queries.column("vec_id").to_pylist()
            vectors = _matrix(queries.column("vector"), rows.shape[1])
            for start in range(0, len(names), QUERY_BLOCK):
                block = vectors[start : start + QUERY_BLOCK]
                rough = unit_rows(block) @ unit.T
                for name, query, near in zip(names[start : start + QUERY_BLOCK], block, rough, strict=True):
                    for found, score in nearest_of(name, query, near, rows, ids, nearest):
                        for column, value in zip(out, (name, found, score), strict=True):
                            column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("width", "part", "chunk", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:], strict=False):
                if start == end:
                    continue
                *at, kind = keys[start].tolist()
                if at != cell:
                    cell, pieces, rows, ids = at, [], None, []
                some = batch.slice(start, end - start)
                if kind == 0:
                    pieces.append(_matrix(some.column("vector"), at[0]))
                    ids += some.column("ids").to_pylist()
                elif pieces:
                    if rows is None:
                        rows = np.concatenate(pieces)
                        unit = unit_rows(rows)
                    yield answer(some)

    return rank


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    nearest: int = NEAREST,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` rows of ``vectors`` found for each query.

    ``queries`` has the columns of ``vectors``; a query's own id is no candidate. ``usable`` says
    which rows take part, and vectors of another length than a query's are no candidates. The index
    is fitted for the most frequent length; vectors of other lengths form one part that is searched
    as a whole. Ties go to the smaller id. Empty tables give no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = kept(distinct_vectors(usable(vectors, id_column, vector_column), nearest + 1).withColumn("width", F.size("vector")), "neighbour-rows")
    asked = usable(queries, id_column, vector_column).withColumn("width", F.size("vector"))
    common = rows.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if common is None:
        return spark.createDataFrame([], schema)
    width, count = common
    router = fit_router(sampled(rows.where(F.col("width") == width), count), count, recall, nearest)

    whole = F.array(F.lit(0))
    parts = lambda frame, visits: _routed(frame.where(F.col("width") == width), router, visits).unionByName(
        frame.where(F.col("width") != width).withColumn("parts", whole)
    )
    indexed = kept(parts(rows, 1).withColumn("part", F.col("parts")[0]).drop("parts"), "neighbour-index")
    # At most as many rows as parts reach the driver; vectors of all other lengths count together.
    sizes = indexed.groupBy(F.when(F.col("width") == width, F.col("part")).otherwise(-1).alias("part")).agg(F.count("*").alias("n")).collect()
    chunks = {row.part: -(-row.n // CELL_ROWS) for row in sizes}
    of_part = F.get(F.array(*[F.lit(chunks.get(p, 0)) for p in range(router.parts)]), F.col("part"))
    cut = F.when(F.col("width") == width, of_part).otherwise(chunks.get(-1, 0))
    cells = indexed.select("width", "part", F.pmod(F.xxhash64("ids"), cut).cast("int").alias("chunk"), F.lit(0).alias("kind"), _none("long").alias("vec_id"), "vector", "ids")
    visits = parts(asked, router.visits).withColumn("part", F.explode("parts")).where(cut > 0)
    visits = visits.withColumn("chunk", F.explode(F.sequence(F.lit(0), cut - 1)))
    visits = visits.select("width", "part", "chunk", F.lit(1).alias("kind"), "vec_id", "vector", _none("array<bigint>").alias("ids"))

    cell = ["width", "part", "chunk"]
    met = cells.unionByName(visits).repartition(*cell).sortWithinPartitions(*cell, "kind")
    found = met.mapInArrow(_ranked(nearest), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def sampled(rows: DataFrame, count: int, size: int = SAMPLE) -> np.ndarray:
    """About ``size`` vectors of ``rows`` (all, if there are fewer), drawn by the hash of the vector, in a fixed order."""
    share = min(1.0, size / count)
    drawn = rows.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else rows
    return np.array([r.vector for r in drawn.select("vector", F.xxhash64("vector").alias("hash")).orderBy("hash", "vector").select("vector").collect()], dtype=np.float64)


def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows, by cosine, of every row of ``embeddings`` whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))
