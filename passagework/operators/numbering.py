"""Dense positions in a total order, without a one-partition window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged

_ROW_BITS = 33
# Fewer rows are not dealt out to more tasks.
_TASK_ROWS = 1024


class Places:
    """Dense positions 0, 1, 2, ... along `order`, found from the keys alone.

    The keys are sorted into ranges of which the first key and the count reach the driver, as many as a shuffle is wide. Then
    a row's range follows from its key, so rows go through one shuffle and are written nowhere. Rows with
    equal keys share a range. For sources that give the same rows when they are read again.
    """

    def __init__(self, df: DataFrame, order: Sequence[str]):
        self.df, self.order = df, list(order)
        keys = staged(df.select(*self.order), "keys")
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        width = max(1, min(width, -(-keys.count() // _TASK_ROWS)))
        ranged = keys.repartitionByRange(width, *self.order).withColumn("_range", F.spark_partition_id())
        found = ranged.groupBy("_range").agg(
            F.min(F.struct(*self.order)).alias("first"), F.count(F.lit(1)).alias("n")
        ).orderBy("_range").collect()
        self.kinds = [keys.schema[c].dataType for c in self.order]
        self.firsts = [r["first"] for r in found]
        self.begins = [0, *accumulate(r["n"] for r in found)]

    def rows(self, name: str, low: int = 0, high: int | None = None) -> DataFrame:
        """The rows at the positions from `low` to below `high`, sorted, with their position as `name`."""
        high = self.begins[-1] if high is None else high
        if low >= high or not self.firsts:
            return self.df.where(F.lit(False)).withColumn(name, F.lit(0).cast("bigint"))
        firsts = F.array(*[
            F.struct(*[F.lit(v).cast(k).alias(c) for c, k, v in zip(self.order, self.kinds, first)]) for first in self.firsts
        ])
        key = F.struct(*[F.col(c) for c in self.order])
        place = F.size(F.filter(firsts, lambda first: first <= key)) - 1
        wanted = [i for i in range(len(self.firsts)) if self.begins[i] < high and self.begins[i + 1] > low]
        # Ranges without a wanted position go before the shuffle.
        dealt = self.df.withColumn("_range", place).where(F.col("_range").between(wanted[0], wanted[-1]))
        slotted = (
            dealt.repartitionById(len(self.firsts), F.col("_range"))
            .sortWithinPartitions(*self.order)
            .withColumn("_slot", F.monotonically_increasing_id())
        )
        begins = F.array(*[F.lit(b).cast("bigint") for b in self.begins])
        row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        numbered = slotted.withColumn(name, F.get(begins, F.col("_range")) + row).drop("_range", "_slot")
        return numbered.where((F.col(name) >= low) & (F.col(name) < high))


def assign_positions(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `name`: 0, 1, 2, ... along `order`, which must identify each row.

    Rows are range-partitioned and sorted inside their partition, written
    once together with (partition, row) and numbered by adding the row to the
    count of all earlier partitions. Only one count per partition reaches the
    driver, so its size is set by the shuffle width and not by the data.

    `prepare` may add columns row by row (an encoder, say). The numbered rows are then written
    once more, in order and without a shuffle, together with these columns: a filter on
    `name` skips row groups of that table, and nothing is computed again.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    slotted = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    table = staged(slotted, "positions")
    part = F.shiftright("_slot", _ROW_BITS)
    counts = sorted(table.groupBy(part.alias("p")).count().collect())
    before = dict(zip((c["p"] for c in counts), accumulate((c["count"] for c in counts), initial=0)))
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if not before:
        numbered = table.withColumn(name, F.col("_slot")).drop("_slot")
        return staged(prepare(numbered), name) if prepare else numbered
    offsets = df.sparkSession.createDataFrame(list(before.items()), "_part long, _before long")
    # One row per shuffle partition: the broadcast side cannot grow with the data.
    numbered = (
        table.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row)
        .drop("_part", "_before", "_slot")
    )
    return staged(prepare(numbered), name) if prepare else numbered
