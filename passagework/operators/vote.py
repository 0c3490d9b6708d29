"""Majority vote over sampled answers, restricted to answers found in context."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.answers import grounded
from ..functions.text import normalize_vote


def vote(samples: DataFrame, contexts: DataFrame) -> DataFrame:
    """One `answer` per qid from (qid, sample_idx, answer) and (qid, passages).

    Equal keys are counted and the most frequent key found in the passages
    wins, the earlier one on a tie; its first raw answer is returned. If no
    key is in context, sample 0 is. Two partial aggregations carry it, so a
    question with very many samples does not land in one task as a whole.
    """
    counted = (
        samples.withColumn("norm", normalize_vote(F.col("answer")))
        .groupBy("qid", "norm")
        .agg(
            F.count(F.lit(1)).alias("votes"),
            F.min("sample_idx").alias("first"),
            F.min_by("answer", "sample_idx").alias("raw"),
        )
    )
    placed = counted.join(contexts.select("qid", "passages"), "qid", "left")
    ballot = F.struct("votes", (-F.col("first")).alias("early"), "raw")
    won = F.max(F.when(grounded(F.col("norm"), F.col("passages")), ballot))
    return (
        placed.groupBy("qid")
        .agg(won.alias("won"), F.min_by("raw", "first").alias("baseline"))
        .select(
            "qid",
            F.coalesce("won.raw", "baseline").alias("answer"),
            F.coalesce("won.votes", F.lit(0).cast("bigint")).alias("votes"),
            F.col("won").isNotNull().alias("in_context"),
        )
    )
