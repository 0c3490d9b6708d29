"""Arrow batches in portions of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

PORTION_BYTES = 1 << 20


def portions(batch: pa.RecordBatch, column: str, most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` whose text in `column` has about `most` bytes, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)


def under_plain_names(
    docs: DataFrame, work: Callable[..., DataFrame], **columns: str,
) -> DataFrame:
    """What `work` makes of `docs`, all of whose columns have numbered names meanwhile, so that none clashes with names used inside.

    `columns` are arguments of `work` that name columns; one that names none is passed as None. The
    result must have the same columns in the same order.
    """
    names = [f"_column_{i}" for i in range(len(docs.columns))]
    plain = dict(zip(docs.columns, names))
    done = work(docs.toDF(*names), **{k: plain.get(v) for k, v in columns.items()})
    return done.select(*names).toDF(*docs.columns)


def map_portions(
    df: DataFrame, column: str, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | StructType,
    most: int = PORTION_BYTES,
) -> DataFrame:
    """`mapInArrow` that hands `work` bounded portions, so that long texts don't add up in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, column, most):
                yield from work(part)

    return df.mapInArrow(run, schema)
