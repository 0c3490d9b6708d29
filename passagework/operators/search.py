"""Exact inner-product top-N of every question over all indexed vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .. import settings
from ..runtime import staged

# A block of questions has at most so many bytes of float32 vectors, and at most
# as many rows as let a task hold four times `n` hits for each.
BLOCK_BYTES = 8 * 2**20
HELD_HITS = 1_000_000
# A slice of the index, held by one task, has about so many bytes of float32 vectors.
SLICE_BYTES = 32 * 2**20
_TILE_CELLS = 4_000_000
# Survivors per question and tile above which the floor is worth raising.
_MANY = 8
# Rows of a result batch.
_SLICE = 50_000
# Products below the smallest normal float32 lose their digits.
_TINY = 1e-37
_VECTOR, _QUESTION = 0, 1
_HITS = "part int, qid long, passage_id long, score double"


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows, summed in double with the rounding errors carried along.

    Products of float32 numbers are exact in double. Components are added from the first to
    the last, so a pair has the same score in any batch, and pairs whose exact scores
    are equal tie, in whichever components these lie.
    """
    total, lost = np.zeros(len(left)), np.zeros(len(left))
    for i in range(left.shape[1]):
        term = left[:, i].astype(np.float64) * right[:, i]
        added = total + term
        part = added - total
        lost += (total - (added - part)) + (term - part)
        total = added
    return total + lost


class _Best:
    """Running best `n` per question over all vectors a task has seen.

    A float32 product sorts out nearly all pairs; its rounding error is
    bounded, and pairs within that bound of the n-th best are scored in
    double. The outcome is the same as scoring every pair in double.
    """

    def __init__(self, questions: np.ndarray, n: int, floor: np.ndarray):
        self.questions, self.n = questions, n
        self.floor = floor.copy()
        # Error of a float32 sum of d products: below d * 2^-24 * |q| * |v|.
        self.unit_error = _lengths(questions) * (questions.shape[1] + 2) * 2.0**-23
        self.longest = 0.0
        self.top = np.full((len(questions), n), -np.inf, dtype=np.float32)
        self.parts: list[tuple] = []
        self.held = 0
        self.room = max(4 * n * len(questions), HELD_HITS)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        tile = max(self.n, _TILE_CELLS // len(self.questions))
        for start in range(0, len(ids), tile):
            self._add_tile(ids[start : start + tile], vectors[start : start + tile])

    def _add_tile(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.longest = max(self.longest, _lengths(vectors).max())
        rough = self.rough(vectors)
        near = self.near(rough)
        if near.sum() > _MANY * len(self.questions):
            self._raise_floor(rough)
            near = self.near(rough)
        q, v = np.nonzero(near)
        pairs = max(1, _TILE_CELLS // vectors.shape[1])
        for start in range(0, len(q), pairs):
            left, right = q[start : start + pairs], v[start : start + pairs]
            scores = self.scores(self.questions[left], vectors[right])
            kept = scores >= self.floor[left]
            self.parts.append((left[kept], ids[right[kept]], scores[kept]))
            self.held += int(kept.sum())
            if self.held > self.room:
                self._compact()

    def rough(self, vectors: np.ndarray) -> np.ndarray:
        """float32 products, by which pairs are sorted out."""
        return self.questions @ vectors.T

    def scores(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return _products(left, right)

    def _error(self) -> np.ndarray:
        return self.unit_error * self.longest + _TINY

    def near(self, rough: np.ndarray) -> np.ndarray:
        least = self.floor - self._error()
        # Rounded down, so that float32 comparison lets no pair slip.
        return rough >= np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None]

    def _raise_floor(self, rough: np.ndarray) -> None:
        """The n-th best of any vectors seen bounds the n-th best of all."""
        both = np.concatenate([self.top, rough], axis=1)
        self.top = np.partition(both, rough.shape[1], axis=1)[:, rough.shape[1] :]
        np.maximum(self.floor, self.top.min(axis=1) - self._error(), out=self.floor)

    def _compact(self) -> tuple:
        q, ids, scores = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        full = rank == self.n - 1
        self.floor[q[full]] = np.maximum(self.floor[q[full]], scores[full])
        kept = rank < self.n
        best = q[kept], ids[kept], scores[kept]
        self.parts, self.held = [best], int(kept.sum())
        return best

    def result(self) -> tuple | None:
        return self._compact() if self.parts else None


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, dim)


def block_rows(n: int, dim: int) -> int:
    """Questions of a block: bounded bytes of vectors, bounded hits in a task."""
    return max(1, min(BLOCK_BYTES // (4 * dim), HELD_HITS // (4 * n)))


def result_batches(best: _Best, qids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """qid, passage_id and score of the best that were found."""
    q, found, scores = best.result() or (np.zeros(0, np.int64),) * 3
    for a in range(0, len(q), _SLICE):
        some = slice(a, a + _SLICE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids[q[some]]), pa.array(found[some]), pa.array(scores[some])], ["qid", "passage_id", "score"]
        )


def _nested(batches: Iterator[pa.RecordBatch], n: int, rows: int | None) -> Iterator[pa.RecordBatch]:
    """Best `n` of one slice for every question: the slice's vectors come first, then the questions, block by block."""
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []
    part, dim = None, 0
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        cut = int(np.searchsorted(kinds, _QUESTION))
        if cut:
            part = batch.column("part")[0].as_py()
            dim = dim or len(batch.column("embedding")[0])
            ids.append(batch.column("id").slice(0, cut).to_numpy())
            vectors.append(matrix(batch.column("embedding").slice(0, cut), dim))
        if cut == batch.num_rows or not ids:
            continue
        if len(ids) > 1:
            ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
        size = rows or block_rows(n, dim)
        for start in range(cut, batch.num_rows, size):
            block = batch.slice(start, min(size, batch.num_rows - start))
            questions = matrix(block.column("embedding"), dim)
            best = _Best(questions, n, np.full(len(questions), -np.inf))
            best.add(ids[0], vectors[0])
            for some in result_batches(best, block.column("id").to_numpy()):
                parts = pa.array(np.full(some.num_rows, part, np.int32))
                yield pa.RecordBatch.from_arrays([parts, *some.columns], ["part", *some.schema.names])


def _dealt(questions: DataFrame, index: DataFrame, slices: int, runs: Sequence[int]) -> DataFrame:
    """(part, kind, id, embedding): a part has one slice of the index, of one run if there are runs, and all questions."""
    held = index.where(F.col("embedding").isNotNull())
    part = F.pmod(F.xxhash64("passage_id"), F.lit(slices)).cast("int")
    if runs:
        place = F.element_at(F.create_map(*[F.lit(x) for k, run in enumerate(runs) for x in (run, k)]), F.col("run"))
        held, part = held.where(F.col("run").isin(*runs)), (place * slices + part).cast("int")
    parts = slices * max(1, len(runs))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    both = held.select(part.alias("part"), F.lit(_VECTOR).alias("kind"), F.col("passage_id").alias("id"), "embedding").unionByName(
        questions.where(F.col("embedding").isNotNull()).select(
            every.alias("part"), F.lit(_QUESTION).alias("kind"), F.col("qid").alias("id"), "embedding"
        )
    )
    return both.repartitionById(parts, F.col("part")).sortWithinPartitions("kind")


def index_slices(index: DataFrame, runs: Sequence[int] = ()) -> int:
    """Slices that `index` is dealt out to: as many as keep one bounded, and no fewer than there are cores."""
    first = index.select(F.size("embedding").alias("n")).where("n > 0").first()
    if first is None:
        return 1
    size = index.count() * 4 * first["n"] // max(1, len(runs))
    return max(index.sparkSession.sparkContext.defaultParallelism // max(1, len(runs)), -(-size // SLICE_BYTES), 1)


def search(
    questions: DataFrame,
    index: DataFrame,
    n: int = settings.CANDIDATES,
    rows: int | None = None,
    runs: Sequence[int] = (),
) -> DataFrame:
    """Best `n` passages per question: qid, passage_id, score, rank from 1.

    `questions` has unique qid and embedding, `index` passage_id and embedding.
    Scores are inner products in double, and ranks follow from them unrounded; ties are
    ordered by passage_id; fewer than `n` vectors give fewer rows. With `runs`, the index
    has a column run, every question is asked in each of these runs, and so is the result.

    A nested search in one job, however many questions there are: the index is read once and dealt out
    to slices that a task can hold; the questions are sent to every slice, where they are
    read in blocks (of `rows` rows, or as many as `block_rows` allows). A slice's best `n` of each question
    meet in a window that limits them in every task first. Nothing of either side is on the
    driver. The result being a table, a join with it is planned by its true size: a few hits are
    broadcast to the passages instead of all passages being shuffled to the hits.
    """
    slices = index_slices(index, runs)
    hits = _dealt(questions, index, slices, runs).mapInArrow(lambda batches: _nested(batches, n, rows), _HITS)
    keys = ["qid"]
    if runs:
        run = F.element_at(F.array(*[F.lit(r) for r in runs]), F.floor(F.col("part") / slices).cast("int") + 1)
        hits, keys = hits.withColumn("run", run), ["run", "qid"]
    best_first = Window.partitionBy(*keys).orderBy(F.desc("score"), "passage_id")
    ranked = hits.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)
    return staged(ranked.select(*keys, "passage_id", "score", "rank"), "hits")
