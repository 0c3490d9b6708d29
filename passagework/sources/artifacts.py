"""Passage and index tables on disk, keyed by the settings that made them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas, settings
from ..runtime import CODEC


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a write to `path` was committed."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS")
    except AnalysisException:
        return False
    return True


def fingerprint(table: DataFrame) -> str:
    """Row count and two sums of row hashes: equal for equal rows, in whatever order."""
    columns = [F.col(c) for c in table.columns]
    # Sums in decimals, which neither overflow nor depend on the order.
    sums = [F.sum(F.xxhash64(*columns, F.lit(i)).cast("decimal(38,0)")).cast("string") for i in range(2)]
    empty = F.lit("0")
    return table.agg(F.concat_ws("-", F.count(F.lit(1)).cast("string"), *(F.coalesce(s, empty) for s in sums))).first()[0]


def write_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Written after the table at `path`, beside it: it vouches for a complete table."""
    spark.range(1).select(F.lit(mark).alias("mark")).write.mode("overwrite").parquet(f"{path}/_mark")


def read_mark(spark: SparkSession, path: str) -> str | None:
    """The mark of the table at `path`; None if the table or its mark is not complete.

    Overwriting a table removes its mark with it.
    """
    if not (is_complete(spark, path) and is_complete(spark, f"{path}/_mark")):
        return None
    return spark.read.schema("mark string").parquet(f"{path}/_mark").first()["mark"]


def _settings(chunking: settings.Chunking, tokenizer_name: str) -> str:
    return f"tokenizer={tokenizer_name}/chunk={chunking.tokens}/overlap={chunking.overlap}"


def passages_path(root: str, chunking: settings.Chunking, tokenizer_name: str = "blank") -> str:
    return f"{root}/passages/{_settings(chunking, tokenizer_name)}"


def index_path(
    root: str, chunking: settings.Chunking, encoder_name: str, tokenizer_name: str = "blank"
) -> str:
    return f"{root}/index/{_settings(chunking, tokenizer_name)}/encoder={encoder_name}"


def sweep_path(root: str, encoder_name: str) -> str:
    return f"{root}/sweep/encoder={encoder_name}"


def _run_mark(path: str, run: int) -> str:
    # Names that begin with an underscore are no part of the table at `path`.
    return f"{path}/_runs/run-{run}"


def write_runs(index: DataFrame, path: str) -> None:
    """Replace the partitions of the runs in `index`, and no others."""
    writer = index.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
    writer.partitionBy("run").parquet(path)


def write_run_mark(spark: SparkSession, path: str, run: int, mark: str) -> None:
    spark.range(1).select(F.lit(mark).alias("mark")).write.mode("overwrite").parquet(_run_mark(path, run))


def read_run_mark(spark: SparkSession, path: str, run: int) -> str | None:
    """What vouches for a run of the table at `path`; None if its write did not end."""
    mark = _run_mark(path, run)
    return spark.read.schema("mark string").parquet(mark).first()["mark"] if is_complete(spark, mark) else None


def read_passages(spark: SparkSession, path: str) -> DataFrame:
    """Passage table; a missing path fails at once."""
    return spark.read.schema(schemas.PASSAGES).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Passages with unit vectors; a missing path fails at once."""
    return spark.read.schema(schemas.INDEX).parquet(path)


def write_log(log: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Evaluation rows as JSON lines, nulls spelled out."""
    log.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EVAL_LOG).json(path)
