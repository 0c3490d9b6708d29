"""Approximate nearest passages by bucketed random projections stored with the index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .. import settings
from ..runtime import staged
from .search import _Best, block_rows, index_slices, matrix, result_batches

# A bucket is cut into so many steps, which tell how near its edges a question lies.
_STEPS = 64
_PRIME = np.uint64(0x9E3779B97F4A7C15)
# Pairs of a question and a passage that are marked at a time.
_CELLS = 4_000_000
_VECTOR, _QUESTION = 0, 1
_HITS = "qid long, passage_id long, score double"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _PRIME
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class ProjectionTables:
    """Hash tables over unit vectors: each joins `per_table` projections, cut into buckets, to one name.

    A bucket is `width` standard deviations of a projection of random unit vectors wide. More tables and wider
    buckets find more of the true neighbours and compare more pairs. A question also probes the buckets beyond the nearer
    edge of up to `flips` of a table's projections.
    """

    tables: int = 20
    per_table: int = 6
    width: float = 1.2
    flips: int = 2
    seed: int = 7

    def _steps(self, vectors: DataFrame) -> DataFrame:
        """Adds `_steps`: all projections of each vector in steps of a bucket."""
        first = vectors.select(F.size("embedding").alias("n")).where("n > 0").first()
        dim = first["n"] if first else 1
        lsh = BucketedRandomProjectionLSH(
            inputCol="_vector", outputCol="_hashes", seed=self.seed, numHashTables=self.tables * self.per_table,
            bucketLength=self.width / dim**0.5 / _STEPS,
        )
        known = vectors.where(F.size("embedding") > 0).withColumn("_vector", array_to_vector("embedding"))
        if first is None:
            return known.drop("_vector").withColumn("_steps", F.array().cast("array<double>"))
        hashed = lsh.fit(known).transform(known)
        steps = F.array(*[vector_to_array(F.col("_hashes")[i])[0] for i in range(self.tables * self.per_table)])
        return hashed.withColumn("_steps", steps).drop("_vector", "_hashes")

    def _names(self, buckets: np.ndarray) -> np.ndarray:
        """One number for each row's buckets of each table: rows x tables x projections to rows x tables."""
        names = np.broadcast_to(np.arange(self.tables, dtype=np.uint64), buckets.shape[:2]).copy()
        for i in range(self.per_table):
            names = _mixed(names * _PRIME + buckets[:, :, i].astype(np.int64).view(np.uint64))
        return names.view(np.int64)

    def _probes(self, steps: np.ndarray) -> np.ndarray:
        buckets = np.floor(steps / _STEPS)
        side = np.where(steps - buckets * _STEPS < _STEPS / 2, -1, 1)
        out = []
        for n in range(self.flips + 1):
            for some in combinations(range(self.per_table), n):
                moved = buckets.copy()
                for i in some:
                    moved[:, :, i] += side[:, :, i]
                out.append(self._names(moved))
        return np.concatenate(out, axis=1)

    def _with_names(self, df: DataFrame, name: str) -> DataFrame:
        stepped, columns = self._steps(df), df.columns
        schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.LongType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                steps = np.asarray(batch.column("_steps").flatten()).reshape(-1, self.tables, self.per_table)
                names = self._names(np.floor(steps / _STEPS))
                ends = pa.array(np.arange(0, names.size + 1, names.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(names).reshape(-1)))
                kept = [batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, lists], [*columns, name])

        return stepped.select(*columns, "_steps").mapInArrow(run, schema)

    def index(self, index: DataFrame) -> DataFrame:
        """`index` with its bucket names as a column, written once; rows without vector go."""
        return staged(self._with_names(index, "buckets"), "hash-tables")

    def search(self, questions: DataFrame, index: DataFrame, n: int = settings.CANDIDATES) -> DataFrame:
        """Best `n` passages per question among those in a probed bucket: qid, passage_id, score, rank from 1.

        `index` is what `index` gave. It is dealt out by id to slices that a task can hold, and questions are sent to every
        slice with the steps that their probes follow from. A task looks the probed buckets up in the sorted names of its
        slice and scores each passage found there once; only a slice's best `n` leave it, so pairs are
        neither shuffled nor written. Scores are inner products in double; ties are ordered by passage_id.
        """
        slices = index_slices(index)
        part = F.pmod(F.xxhash64("passage_id"), F.lit(slices)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
        asked = self._steps(questions.select("qid", "embedding"))
        dealt = index.select(
            part.alias("part"), F.lit(_VECTOR).alias("kind"), F.col("passage_id").alias("id"), "embedding", F.col("buckets").alias("codes")
        ).unionByName(asked.select(
            every.alias("part"), F.lit(_QUESTION).alias("kind"), F.col("qid").alias("id"), "embedding",
            F.transform("_steps", lambda x: x.cast("bigint")).alias("codes"),
        )).repartitionById(slices, F.col("part")).sortWithinPartitions("kind")
        hits = dealt.mapInArrow(lambda batches: self._probed(batches, n), _HITS)
        best_first = Window.partitionBy("qid").orderBy(F.desc("score"), "passage_id")
        ranked = hits.withColumn("rank", F.row_number().over(best_first))
        return ranked.where(F.col("rank") <= n)

    def _probed(self, batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
        """Best `n` of one slice for each question among the passages in its probed buckets; the slice comes first."""
        held: list[tuple] = []
        found, dim = None, 0
        for batch in batches:
            cut = int(np.searchsorted(batch.column("kind").to_numpy(), _QUESTION))
            if cut:
                dim = dim or len(batch.column("embedding")[0])
                vectors, names = (batch.column(c).slice(0, cut) for c in ("embedding", "codes"))
                held.append((batch.column("id").slice(0, cut).to_numpy(), matrix(vectors, dim), names.flatten().to_numpy()))
            if cut == batch.num_rows or not held:
                continue
            if found is None:
                ids, vectors, names = (np.concatenate(c) for c in zip(*held))
                held, order = held[:1], np.argsort(names)
                found = _Postings(names[order], order // self.tables, len(ids))
            size = min(block_rows(n, dim), max(1, _CELLS // len(ids)))
            for start in range(cut, batch.num_rows, size):
                block = batch.slice(start, min(size, batch.num_rows - start))
                steps = block.column("codes").flatten().to_numpy().reshape(-1, self.tables, self.per_table)
                best = _BestProbed(matrix(block.column("embedding"), dim), n, found.of(self._probes(steps)))
                best.add(ids, vectors)
                yield from result_batches(best, block.column("id").to_numpy())


class _Postings:
    """The passages of a slice in order of their bucket names."""

    def __init__(self, names: np.ndarray, rows: np.ndarray, size: int):
        self.names, self.rows, self.size = names, rows, size

    def of(self, probes: np.ndarray) -> np.ndarray:
        """Which passages each question finds in its probed buckets: questions x passages."""
        marked = np.zeros((len(probes), self.size), np.bool_)
        flat = probes.ravel()
        begins = np.searchsorted(self.names, flat)
        sizes = np.searchsorted(self.names, flat, "right") - begins
        hit = np.flatnonzero(sizes)
        begins, sizes, asked = begins[hit], sizes[hit], hit // probes.shape[1]
        parts = np.flatnonzero(np.diff(np.cumsum(sizes) // _CELLS, prepend=-1))
        for a, b in zip(parts, [*parts[1:], len(sizes)]):
            k = sizes[a:b]
            at = np.repeat(begins[a:b] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            marked[np.repeat(asked[a:b], k), self.rows[at]] = True
        return marked


class _BestProbed(_Best):
    """Running best `n` per question among marked pairs."""

    def __init__(self, questions: np.ndarray, n: int, marked: np.ndarray):
        super().__init__(questions, n, np.full(len(questions), -np.inf))
        self.marked, self.seen = marked, 0

    def rough(self, vectors: np.ndarray) -> np.ndarray:
        mine = self.marked[:, self.seen : self.seen + len(vectors)]
        self.seen += len(vectors)
        return np.where(mine, super().rough(vectors), np.float32(-np.inf))

    def near(self, rough: np.ndarray) -> np.ndarray:
        return super().near(rough) & (rough > -np.inf)

    def scores(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Summed in double from the first component to the last."""
        total = np.zeros(len(left))
        for i in range(left.shape[1]):
            total += left[:, i].astype(np.float64) * right[:, i]
        return total


def recall_against(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the pairs of `exact` that are in `found`: recall, pairs."""
    hit = found.select("qid", "passage_id", F.lit(1).alias("hit"))
    return exact.select("qid", "passage_id").join(hit, ["qid", "passage_id"], "left").agg(
        F.avg(F.coalesce("hit", F.lit(0))).alias("recall"), F.count(F.lit(1)).alias("pairs")
    )
