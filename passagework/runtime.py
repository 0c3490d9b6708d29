"""Where intermediate tables live and how wide a cluster is."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Texts take a third less room than by Parquet's default.
CODEC = "zstd"


class _OfDriver(dict):
    """Goes into tasks with every operator that names this module; its values cannot be pickled and stay behind."""

    def __reduce__(self):
        return dict, ()


_local: dict[str, Callable[[], str]] = _OfDriver()


def use_in_local_mode(make_folder: Callable[[], str]) -> None:
    """Where intermediate tables go in local mode if the session names no folder; asked for once, when first needed."""
    _local["make"] = functools.cache(make_folder)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session, which every executor can reach; there is no other on a cluster."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if "make" in _local and spark.sparkContext.master.startswith("local["):
        return _local["make"]()
    raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path; all paths of one application share a folder that can be dropped after it."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/passagework/{application}/{label}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; results that read them end with it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/passagework/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and go on from the table.

    This cuts lineage in a way that survives lost executors, fixes the rows
    that later jobs see, and gives Catalyst real sizes and column pruning.
    """
    path = staging_path(df.sparkSession, label)
    # Components of vectors hardly repeat; looking each up in a dictionary takes longer than writing it.
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.FloatType)]
    plain = {f"parquet.enable.dictionary#{name}.list.element": "false" for name in vectors}
    df.write.options(compression=CODEC, **plain).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, task_rows: int, *keys: str) -> DataFrame:
    """Write `df` and hash its rows over as many tasks as have `task_rows` rows each.

    For few rows that each take long, such as calls of a model: splits and
    adaptive coalescing go by bytes and would leave them to a task or two. The width follows from
    the rows alone, not from the cores that happen to be there.
    """
    table = staged(df, "spread")
    return table.repartition(max(1, -(-table.count() // task_rows)), *keys)
