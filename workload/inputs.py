"""The test tables seen as pages, examples, questions and answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagework.functions.text import normalize_answer
from passagework.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """Table `name`; a table of few files may be one row group each, so text work on it is spread first."""
    df, cores = read_table(spark, f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores, spread_by) if spread_by and len(df.inputFiles()) < cores else df


def _pieces(text: Column, pattern: str) -> Column:
    return F.filter(
        F.transform(F.split(text, pattern), lambda s: F.trim(s)), lambda s: s != ""
    )


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id")


def pages(spark, sf_dir) -> DataFrame:
    """Documents as pages, titled by their source."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("example_ord"),
        F.lit(0).alias("page_pos"),
        F.col("source").alias("title"),
        "text",
    )


def example_texts(spark, sf_dir) -> DataFrame:
    """What `as_examples` needs of the documents."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("ord"), "text", "lang", "source")


def as_examples(texts: DataFrame) -> DataFrame:
    """Documents as examples, other columns kept.

    The lines of a document are its accepted answers and its pages; the title
    of a page is the line before it, so there is one title too many.
    """
    lines = F.split("text", "\n")
    return texts.select(
        "ord",
        F.col("text").alias("question"),
        F.struct(
            F.col("source").alias("value"),
            F.concat_ws(" ", "lang", "source").alias("normalized_value"),
            lines.alias("aliases"),
            F.transform(lines, normalize_answer).alias("normalized_aliases"),
        ).alias("answer"),
        F.struct(
            F.concat(F.array("source"), lines).alias("title"), lines.alias("wiki_context")
        ).alias("entity_pages"),
        *[c for c in texts.columns if c not in ("ord", "text", "lang", "source")],
    )


def examples(spark, sf_dir) -> DataFrame:
    return as_examples(example_texts(spark, sf_dir))


def questions(spark, sf_dir) -> DataFrame:
    """Benchmark texts as questions; their sentences are the accepted answers."""
    sentences = _pieces(F.col("text"), r"[.!?\n]+")
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"),
        F.col("text").alias("question"),
        F.transform(sentences, F.lower).alias("aliases"),
        F.coalesce(F.element_at(sentences, -1), F.lit("")).alias("gold"),
    )


def answer_pairs(spark, sf_dir) -> DataFrame:
    """Each user turn as prediction for the assistant turn that follows it."""
    turns = table(spark, sf_dir, "conversations", "conv_id")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("predicted")
    )
    replied = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("gold")
    )
    # (conv_id, turn) is unique on both sides, so no key is heavy.
    return asked.join(replied, ["conv_id", "turn"]).withColumn(
        "aliases", _pieces(F.col("gold"), r"[.!?\n]+")
    )


def embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("passage_id"), "embedding", "label"
    )
