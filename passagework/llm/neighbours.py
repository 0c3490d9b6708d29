"""Nearest neighbours by stable projections, kd-trees and a chi-square stopping test."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import staged

NEAREST = 10
# Projected dimensions, even.
DIMENSIONS = 8
# A true neighbour fails the stopping test with a probability of at most 1 - CONFIDENCE.
CONFIDENCE = 0.98
# Vectors that the cells are fitted on, at most; every vector is then put into its cell.
FIT_ROWS = 20_000
# Vectors of a cell; fuller ones are split evenly into shards.
CELL = 8_000
LEAF = 96
_SEED = 11


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile for an even number of degrees, by bisection of the closed form."""
    def below(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    low, high = 0.0, 10.0 * degrees + 200
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def projection(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Normal random numbers: a projected distance squared is the true one's times a chi-square number."""
    return np.random.default_rng(_SEED).standard_normal((size, dimensions))


@dataclass
class Tree:
    """A kd-tree by median splits; node 0 is the root, a leaf has no children."""

    low: np.ndarray
    high: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    left: np.ndarray
    order: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, leaf: int) -> Tree:
        order = np.arange(len(points))
        begin, end, left = [0], [len(points)], [-1]
        low, high = [points.min(0)], [points.max(0)]
        node = 0
        while node < len(begin):
            a, b = begin[node], end[node]
            if b - a > leaf:
                axis = int(np.argmax(high[node] - low[node]))
                middle = (b - a) // 2
                part = order[a:b]
                part = part[np.argpartition(points[part, axis], middle)]
                order[a:b] = part
                left[node] = len(begin)
                for x, y in ((a, a + middle), (a + middle, b)):
                    begin.append(x)
                    end.append(y)
                    left.append(-1)
                    low.append(points[order[x:y]].min(0))
                    high.append(points[order[x:y]].max(0))
            node += 1
        return cls(np.array(low), np.array(high), np.array(begin), np.array(end), np.array(left), order)


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to boxes."""
    gap = np.maximum(low - point, 0) + np.maximum(point - high, 0)
    return (gap * gap).sum(-1)


def rounding(projected: np.ndarray) -> float:
    """What squared projected distances may be off, as equal vectors need not project to equal bits."""
    return 1e-9 * (1 + float(projected @ projected))


class Cell:
    """Vectors of one cell, ready for searches."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray, leaf: int = LEAF):
        projected = vectors @ matrix
        self.tree = Tree.build(projected, leaf)
        order = self.tree.order
        self.ids, self.vectors, self.projected = ids[order], vectors[order], projected[order]

    def search(
        self, own: int, vector: np.ndarray, projected: np.ndarray, k: int, stop: float, bound: float,
    ) -> list[tuple[float, int]]:
        """The k nearest found, as (distance, id), but for the query's own rows.

        Leaves come in order of their projected distance. The search ends when the next one's, squared, exceeds
        `stop` (a chi-square quantile) times the square of the k-th best distance so far: a
        vector beyond is nearer than that only with the test's small probability. `bound`: a
        distance that the k-th nearest is known not to exceed.
        """
        tree, slack = self.tree, rounding(projected)
        best: list[tuple[float, int]] = []
        worst = bound
        queue = [(0.0, 0)]
        while queue:
            gap, node = heapq.heappop(queue)
            if gap > stop * worst * worst + slack:
                break
            child = tree.left[node]
            if child >= 0:
                gaps = box_distance(projected, tree.low[child : child + 2], tree.high[child : child + 2])
                heapq.heappush(queue, (float(gaps[0]), int(child)))
                heapq.heappush(queue, (float(gaps[1]), int(child) + 1))
                continue
            a, b = tree.begin[node], tree.end[node]
            apart = self.projected[a:b] - projected
            near = np.flatnonzero(((apart * apart).sum(1) <= stop * worst * worst + slack) & (self.ids[a:b] != own))
            if not len(near):
                continue
            apart = self.vectors[a + near] - vector
            distance = np.sqrt((apart * apart).sum(1))
            good = distance <= worst
            if not good.any():
                continue
            best = sorted([*best, *zip(distance[good].tolist(), self.ids[a + near[good]].tolist())])[:k]
            if len(best) == k:
                worst = min(worst, best[-1][0])
        return best


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows with an id whose vector is not null or zero and holds finite numbers only.

    Vectors of a length other than the most frequent one (of several, the longest) are left out.
    """
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), x.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
        & F.exists("v", lambda e: e != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("v") == sizes[0]["size"]) if sizes else rows


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _assigned(rows: DataFrame, tree: Tree, matrix: np.ndarray) -> DataFrame:
    """`rows` with the cell (leaf of the fitted tree) whose box is nearest to the projected vector."""
    leaves = np.flatnonzero(tree.left < 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            projected = _matrix(batch.column("v")) @ matrix if batch.num_rows else np.zeros((0, matrix.shape[1]))
            cells = np.empty(len(projected), np.int64)
            for i, p in enumerate(projected):
                cells[i] = int(np.argmin(box_distance(p, tree.low[leaves], tree.high[leaves])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array(list(projected), pa.list_(pa.float64()))], ["id", "v", "cell", "p"]
            )

    return rows.mapInArrow(run, "id long, v array<double>, cell long, p array<double>")


def _search(indexed: DataFrame, asked: DataFrame, matrix: np.ndarray, k: int, stop: float) -> DataFrame:
    """(query, id, score): the best of each query (id, v, bound) in each (cell, shard) it is sent to.

    Vectors and queries of a shard meet in one task: the vectors first, of bounded number, then the queries
    as a stream.
    """
    none = F.lit(None).cast("double")
    both = indexed.select("cell", "shard", F.lit(0).alias("kind"), "id", none.alias("bound"), "v").unionByName(
        asked.select("cell", "shard", F.lit(1).alias("kind"), "id", "bound", "v")
    )
    dealt = both.repartition("cell", "shard").sortWithinPartitions("cell", "shard", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, cell = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            where = list(zip(batch.column("cell").to_pylist(), batch.column("shard").to_pylist(), batch.column("kind").to_pylist()))
            ids = batch.column("id").to_numpy()
            matrix_rows = _matrix(batch.column("v"))
            bounds = batch.column("bound").to_pylist()
            out: list[tuple[int, int, float]] = []
            begin = 0
            for i in range(1, len(where) + 1):
                if i < len(where) and where[i] == where[begin]:
                    continue
                spot, kind = where[begin][:2], where[begin][2]
                if spot != at:
                    at, held, cell = spot, [], None
                if kind == 0:
                    held.append((ids[begin:i], matrix_rows[begin:i]))
                elif held or cell is not None:
                    if cell is None:
                        cell = Cell(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]), matrix)
                        held = []
                    for j in range(begin, i):
                        vector = matrix_rows[j]
                        bound = math.inf if bounds[j] is None else bounds[j]
                        for distance, found in cell.search(int(ids[j]), vector, vector @ matrix, k, stop, bound):
                            out.append((int(ids[j]), found, distance))
                begin = i
            if out:
                q, f, d = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(f, pa.int64()), pa.array(d, pa.float64())],
                                                 ["query", "id", "score"])

    return dealt.mapInArrow(run, "query long, id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query with their rank; ties to the smaller id."""
    order = Window.partitionBy("query").orderBy("score", "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, every: int = 100, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST,
    dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, fit_rows: int = FIT_ROWS, cell_rows: int = CELL,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest rows of each query.

    Queries are the rows whose key is divisible by `every`; all rows but those of the query's own key are
    candidates. Vectors are projected to a few dimensions; a kd-tree over the projections of at
    most `fit_rows` rows makes cells, and every row goes to its cell. A query first searches
    its own cell. The k-th distance there bounds the cells that it still has to be sent to:
    those whose box the chi-square test does not rule out. Within a cell a
    second tree gives projected neighbours one leaf after the other until the test ends the search.
    Distances are exact; a true neighbour is missed with a probability of at most 1 - `confidence`.

    Rows without key or with an unusable vector (see `usable`) take no part. Of equal vectors
    only the k + 1 smallest keys are kept, as no other can be among the k nearest; so a vector
    that very many rows share is harmless. Repeated rows count once; rows of one key with different
    vectors are separate candidates and queries. Without candidates there are no rows. `score` is finite
    unless squares overflow.
    """
    # Repeated rows go before the places are given out, else they would take those of other keys.
    clean = usable(vectors, key, vector).distinct()
    kept = clean.withColumn("kept", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    copies = staged(kept.where(F.col("kept") <= k + 1).drop("kept"), "vectors")
    queries = staged(clean.where(F.pmod("id", F.lit(every)) == 0), "queries")
    sample = copies.orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("v").collect()
    schema = f"query_id long, rank int, {key} long, score double"
    if not sample:
        return vectors.sparkSession.createDataFrame([], schema)
    points = np.array([r["v"] for r in sample])
    matrix = projection(points.shape[1], dimensions)
    rows = copies.count()
    leaf = max(1, round(len(points) * min(1.0, cell_rows / 2 / rows)))
    tree = Tree.build(points @ matrix, leaf)
    placed = staged(_assigned(copies, tree, matrix), "placed")
    # One row for each cell of the fitted tree, at most `fit_rows`.
    axes = range(dimensions)
    boxes = placed.groupBy("cell").agg(
        F.count("*").alias("rows"), F.array(*(F.min(F.col("p")[i]) for i in axes)).alias("low"),
        F.array(*(F.max(F.col("p")[i]) for i in axes)).alias("high"),
    ).collect()
    shards = {b["cell"]: -(-b["rows"] // cell_rows) for b in boxes}
    cells = np.array([b["cell"] for b in boxes])
    low, high = np.array([b["low"] for b in boxes]), np.array([b["high"] for b in boxes])
    counts = F.create_map(*(F.lit(x) for c, n in shards.items() for x in (c, n))) if len(shards) < 2000 else None
    if counts is not None:
        of_cell = counts[F.col("cell")]
        indexed = placed.withColumn("shard", F.pmod(F.xxhash64("id"), of_cell).cast("int"))
    else:
        sizes = vectors.sparkSession.createDataFrame(list(shards.items()), "cell long, parts long")
        indexed = placed.join(sizes, "cell").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    indexed = indexed.select("cell", "shard", "id", "v")
    stop = chi_square_quantile(confidence, dimensions)
    homes = _assigned(queries, tree, matrix).select("cell", F.lit(0).alias("shard"), "id", F.lit(None).cast("double").alias("bound"), "v")
    first = _search(indexed.where("shard = 0"), homes, matrix, k, stop)
    tenth = _best(first, k).groupBy("query").agg(F.max("score").alias("bound"), F.count("*").alias("n")).where(F.col("n") == k)
    bounded = staged(
        queries.join(tenth.select(F.col("query").alias("id"), "bound"), "id", "left").select("id", "v", "bound"), "bounds"
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                projected = _matrix(part.column("v")) @ matrix
                which, cell, shard = [], [], []
                for i, bound in enumerate(part.column("bound").to_pylist()):
                    gaps = box_distance(projected[i], low, high)
                    near = gaps <= (math.inf if bound is None else stop * bound * bound + rounding(projected[i]))
                    for c in cells[near].tolist():
                        which.extend([i] * shards[c])
                        cell.extend([c] * shards[c])
                        shard.extend(range(shards[c]))
                rows = part.take(pa.array(which, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int64()), pa.array(shard, pa.int32()), rows.column("id"), rows.column("bound"), rows.column("v")],
                    ["cell", "shard", "id", "bound", "v"],
                )

    sent = bounded.mapInArrow(route, "cell long, shard int, id long, bound double, v array<double>")
    found = _search(indexed, sent, matrix, k, stop)
    return _best(found, k).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score"
    )
