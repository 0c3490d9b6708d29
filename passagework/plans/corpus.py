"""From pages to a searchable index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas, settings
from ..functions import text as tx
from ..operators.encode import encode
from ..operators.pages import chunk_pages, chunk_sweep, first_passages, marked_pages, passage_texts, unnest_pages
from ..runtime import CODEC, staged
from ..sources import artifacts, examples as ex


def build_passages(
    pages: DataFrame,
    chunking: settings.Chunking = settings.Chunking(),
    tokenizer: tx.Tokenizer = tx.BLANK_TOKENIZER,
) -> DataFrame:
    """Chunk, drop copies, number along corpus order: passage_id, passage."""
    marked = marked_pages(pages)
    firsts = first_passages(chunk_pages(marked, chunking, tokenizer))
    return passage_texts(marked, firsts, [chunking], tokenizer).drop("run")


def build_index(
    pages: DataFrame,
    encoder,
    chunking: settings.Chunking = settings.Chunking(),
    tokenizer: tx.Tokenizer = tx.BLANK_TOKENIZER,
) -> DataFrame:
    """Written table of passages with ids and unit vectors, in order of the ids.

    Encoding is the dearest step, so its result is a table before anything
    reads it: a lost executor or a second scan does not encode again.
    """
    index = encode(build_passages(pages, chunking, tokenizer), "passage", encoder)
    return staged(index.select("passage", "passage_id", "embedding"), "index")


def ensure_index(
    pages: DataFrame,
    encoder,
    root: str,
    encoder_name: str,
    chunking: settings.Chunking = settings.Chunking(),
    recompute_passages: bool = False,
    recompute_index: bool = False,
    tokenizer: tx.Tokenizer = tx.BLANK_TOKENIZER,
) -> DataFrame:
    """Reuse or build the passage and index tables under `root`.

    Paths carry chunk length, overlap, tokenizer and encoder name, so other settings
    never meet a stale table. An index remembers the fingerprint of the passages it was made of and is
    made anew when they have changed, whichever encoder's call changed them.
    """
    spark = pages.sparkSession
    text_path = artifacts.passages_path(root, chunking, tokenizer.name)
    path = artifacts.index_path(root, chunking, encoder_name, tokenizer.name)
    mark = artifacts.read_mark(spark, text_path)
    if recompute_passages or mark is None:
        build_passages(pages, chunking, tokenizer).write.mode("overwrite").option("compression", CODEC).parquet(text_path)
        mark = artifacts.fingerprint(artifacts.read_passages(spark, text_path))
        artifacts.write_mark(spark, text_path, mark)
    if recompute_index or artifacts.read_mark(spark, path) != mark:
        passages = artifacts.read_passages(spark, text_path)
        encode(passages, "passage", encoder).write.mode("overwrite").option("compression", CODEC).parquet(path)
        artifacts.write_mark(spark, path, mark)
    return artifacts.read_index(spark, path)


def _ids_per_run(numbered: DataFrame) -> DataFrame:
    """Restart the ids at 0 in every run."""
    # One row per setting, and the settings are an argument.
    first = numbered.groupBy("run").agg(F.min("passage_id").alias("_first"))
    return (
        numbered.join(F.broadcast(first), "run")
        .withColumn("passage_id", F.col("passage_id") - F.col("_first"))
        .drop("_first")
    )


def sweep_passages(
    pages: DataFrame, sweep: Sequence[settings.Chunking], numbers: Sequence[int] | None = None
) -> DataFrame:
    """Passages of several chunk settings in one table, ids dense per run; `numbers` are those of the runs, or 1, 2, ..."""
    def of_run(values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("run") - 1)

    marked, numbers = marked_pages(pages), list(numbers or range(1, len(sweep) + 1))
    firsts = _ids_per_run(first_passages(chunk_sweep(marked, sweep, numbers=numbers), "run"))
    place = F.array_position(F.array(*[F.lit(n) for n in numbers]), F.col("run")).cast("int")
    texts = passage_texts(marked, firsts.withColumn("run", place), sweep)
    return texts.select(
        of_run(numbers).alias("run"),
        of_run([c.tokens for c in sweep]).alias("chunk_tokens"),
        of_run([c.overlap for c in sweep]).alias("chunk_overlap"),
        "passage",
        "passage_id",
    )


def sweep_index(
    pages: DataFrame, sweep: Sequence[settings.Chunking], encoder, path: str | None = None
) -> DataFrame:
    """Index of several chunk settings; under `path`, one directory per run.

    Without a path the rows stay in the written table they were encoded into.
    """
    built = encode(sweep_passages(pages, sweep), "passage", encoder)
    if path is None:
        return staged(built, "index")
    built.write.option("compression", CODEC).partitionBy("run").parquet(path)
    return pages.sparkSession.read.schema(built.schema).parquet(path)


def ensure_sweep(
    pages: DataFrame, sweep: Sequence[settings.Chunking], encoder, root: str, encoder_name: str
) -> DataFrame:
    """Index of several chunk settings under `root`, of which only runs without a valid mark are built.

    A run has a partition of its own, which its write replaces and no other does, and a mark beside the table that is
    written last. The mark tells the run's settings and the fingerprint of the pages, so a sweep that ended
    halfway goes on where it stopped, and changed pages or settings make their runs anew.
    """
    spark = pages.sparkSession
    path = artifacts.sweep_path(root, encoder_name)
    source = artifacts.fingerprint(pages)
    wanted = {run: f"{c.tokens}-{c.overlap}-{source}" for run, c in enumerate(sweep, 1)}
    missing = [run for run, mark in wanted.items() if artifacts.read_run_mark(spark, path, run) != mark]
    if missing:
        built = encode(sweep_passages(pages, [sweep[run - 1] for run in missing], missing), "passage", encoder)
        artifacts.write_runs(built.select(*schemas.RUN_INDEX.names), path)
        for run in missing:
            artifacts.write_run_mark(spark, path, run, wanted[run])
    table = spark.read.schema(schemas.RUN_INDEX).parquet(path)
    return table.where(F.col("run").isin(list(wanted)))


def pages_of_shards(
    spark: SparkSession,
    path: str,
    splits: Sequence[str] = settings.SPLITS,
    max_shards: int | None = None,
) -> DataFrame:
    """Pages of the examples in a sharded table, in source order.

    Splits that are not there add nothing; `max_shards` keeps the first shards
    of each split. Fails if no row is left.
    """
    sharded = ex.first_shards(ex.read_shards(spark, path, splits), max_shards, ex.read_catalogue(spark, path, splits))
    examples = ex.in_source_order(ex.require_rows(sharded, path), splits)
    return unnest_pages(examples)
