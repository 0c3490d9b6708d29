"""Text to unit vectors through an exchangeable encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .. import settings
from ..functions import text as tx
from ..functions.vectors import ZERO_NORM


# Rows whose vectors a task makes at a time; an Arrow batch may have ten times as many.
_SLICE = 1024
# Rows whose words a task holds at a time.
_PART = 4 * _SLICE
# Words whose hashes a task keeps, in some 15 MB.
_KNOWN = 2**17


def _with_vector(schema: T.StructType, drop: str) -> T.StructType:
    kept = [f for f in schema.fields if f.name != drop]
    return T.StructType([*kept, T.StructField("embedding", T.ArrayType(T.FloatType()))])


def _unit_rows(vectors: np.ndarray) -> np.ndarray:
    wide = np.asarray(vectors, dtype=np.float64)
    norms = np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    norms[norms == 0] = ZERO_NORM
    return (wide / norms).astype(np.float32)


def _vector_column(rows: np.ndarray) -> pa.Array:
    n, dim = rows.shape
    ends = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1)))


def _append(batch: pa.RecordBatch, drop: str, rows: np.ndarray) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != drop]
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*columns, _vector_column(rows)], [*names, "embedding"])


class _Known(dict):
    """The numbers that a function gives for words; those of the first `_KNOWN` words of a task are kept."""

    def __init__(self, number: Callable[[bytes], int]):
        self.number = number

    def __missing__(self, word: bytes) -> int:
        found = self.number(word)
        if len(self) < _KNOWN:
            self[word] = found
        return found

    def of(self, words: pa.Array) -> np.ndarray:
        each = words.cast(pa.binary()).to_numpy(zero_copy_only=False)
        return np.fromiter(map(self.__getitem__, each), np.int64, len(each))


@dataclass(frozen=True)
class HashingEncoder:
    """Signed feature hashing of words; needs no model files.

    A task finds the words in the bytes of the lower-case texts, hashes each distinct word of some thousand texts
    once, if it is new to the task, and adds up all words of a text with one `bincount`.
    """

    dim: int = 256

    def word_code(self, word: bytes) -> int:
        """Twice the bucket, from the first 32 bits of the md5 digest, and one more if the next bit is set."""
        digest = md5(word, usedforsecurity=False).digest()
        return int.from_bytes(digest[:4]) % self.dim * 2 + (digest[4] >> 7)

    def encode(self, df: DataFrame, text: str) -> DataFrame:
        dim, word_code = self.dim, self.word_code

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = _Known(word_code)
            for batch in (big.slice(a, _PART) for big in batches for a in range(0, big.num_rows, _PART)):
                n = batch.num_rows
                at, sizes, words = tx.coded_words(batch.column(batch.schema.get_field_index("_lowered")))
                codes = known.of(words)
                buckets, signs = codes >> 1, 1.0 - 2.0 * (codes & 1)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                for a in range(0, n, _SLICE):
                    some = batch.slice(a, _SLICE)
                    k = some.num_rows
                    mine = at[ends[a] : ends[a + k]]
                    cell = np.repeat(np.arange(k) * dim, sizes[a : a + k]) + buckets[mine]
                    flat = np.bincount(cell, weights=signs[mine], minlength=k * dim)
                    yield _append(some, "_lowered", _unit_rows(flat.reshape(k, dim)))

        lowered = df.withColumn("_lowered", F.lower(F.col(text)))
        return lowered.mapInArrow(add_up, _with_vector(lowered.schema, "_lowered"))


@dataclass(frozen=True)
class BatchEncoder:
    """A model as encoder.

    `factory` is picklable; each task calls it once and gets back a function
    from a list of texts to a 2-D array, which then sees `batch` texts a time.
    """

    factory: Callable[[], Callable[[list[str]], np.ndarray]]
    batch: int = settings.ENCODE_BATCH

    def encode(self, df: DataFrame, text: str) -> DataFrame:
        factory, size = self.factory, self.batch

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for big in batches:
                for start in range(0, big.num_rows, size):
                    batch = big.slice(start, size)
                    model = factory() if model is None else model
                    texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
                    yield _append(batch, "_text", _unit_rows(model(texts)))

        marked = df.withColumn("_text", F.col(text))
        return marked.mapInArrow(run, _with_vector(marked.schema, "_text"))


def encode(df: DataFrame, text: str, encoder) -> DataFrame:
    """Add `embedding`, the unit vector of column `text`; zero vectors stay zero."""
    return encoder.encode(df, text)
