"""Corpus ingestion and sharding as streams over a landing folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import settings
from ..operators.numbering import assign_positions
from ..operators.pages import chunk_pages
from ..sources.examples import with_shards


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000, glob: str = "*"
) -> DataFrame:
    """Stream of the Parquet files that appear under `path`."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", glob)
        .parquet(path)
    )


def _drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_passages(
    pages: DataFrame, out: str, checkpoint: str, chunking: settings.Chunking = settings.Chunking()
) -> DataFrame:
    """Chunk a stream of pages and append the passages not seen before.

    What was seen is a table of 256-bit digests beside the passages, joined anti by each micro-batch: the
    stream itself keeps no state. A batch writes passages and digests into folders of its own number and looks
    only at those of smaller numbers, so running it again after a failure gives the same rows once.
    Which copy survives is not defined here, so rows carry no order. Returns
    the written table after all files that were present have been read.
    """
    schema = T.StructType([T.StructField("passage", T.StringType()), T.StructField("digest", T.BinaryType())])
    stored = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])

    def append(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(["digest"])
        if epoch:
            seen = spark.read.schema(stored).parquet(out).where(F.col("epoch") < epoch).select("digest")
            fresh = fresh.join(seen, "digest", "left_anti")
        fresh.select(*schema.names).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    chunks = chunk_pages(pages, chunking).select("passage", F.unhex(F.sha2("passage", 256)).alias("digest"))
    _drain(chunks.writeStream.foreachBatch(append), checkpoint)
    spark = pages.sparkSession
    try:
        return spark.read.schema(stored).parquet(out).select("passage")
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], "passage string")


def stream_shards(
    rows: DataFrame,
    order: Sequence[str],
    out: str,
    checkpoint: str,
    shard_rows: int = settings.SHARD_ROWS,
    split: str = "train",
) -> DataFrame:
    """Append a stream as numbered shards of `shard_rows` rows each, as split `split`.

    The table has the layout of `write_shards`, so `read_shards` reads it.

    A micro-batch continues after the rows of the batches before it, whose
    total the previous batch left behind. A batch overwrites its own folders,
    so running it again after a failure gives the same rows once.
    """
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("pos", T.LongType()),
         T.StructField("shard", T.IntegerType()), T.StructField("row", T.IntegerType())]
    )

    def append(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        start = 0
        if epoch:
            start = spark.read.schema("total long").parquet(f"{out}/_totals/{epoch - 1}").first()[0]
        placed = assign_positions(batch, order, "pos").withColumn("pos", F.col("pos") + start)
        target = f"{out}/split={split}/epoch={epoch}"
        with_shards(placed, shard_rows).select(*schema.names).write.mode("overwrite").parquet(target)
        written = spark.read.schema(schema).parquet(target)
        written.agg((F.count(F.lit(1)) + start).alias("total")).write.mode("overwrite").parquet(
            f"{out}/_totals/{epoch}"
        )

    _drain(rows.writeStream.foreachBatch(append), checkpoint)
    stored = T.StructType(
        [*schema.fields, T.StructField("split", T.StringType()), T.StructField("epoch", T.IntegerType())]
    )
    return rows.sparkSession.read.schema(stored).parquet(out)
