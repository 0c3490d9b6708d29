"""Retrieval and answer scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import settings
from ..functions import answers as an


def first_hits(ranked: DataFrame, questions: DataFrame, *by: str) -> DataFrame:
    """Per question the best rank whose passage mentions an alias, or null.

    `ranked`: qid, rank, passage and the `by` columns; `questions`: qid,
    aliases. Questions without any retrieved row keep a null.
    """
    golden = questions.select("qid", "aliases")
    hit = an.mentions_any(F.col("passage"), F.col("aliases"))
    return (
        ranked.join(golden, "qid")
        .groupBy("qid", *by)
        .agg(F.min(F.when(hit, F.col("rank"))).alias("first_hit"))
    )


def recall_at(
    ranked: DataFrame,
    questions: DataFrame,
    ks: Sequence[int] = settings.RECALL_AT,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of questions with a hit among the first k, for all k in one pass.

    `by` columns come from `questions` (such as split).
    """
    found = first_hits(ranked.where(F.col("rank") <= max(ks)), questions)
    every = questions.select("qid", *by).join(found, "qid", "left")
    return recall_of(every, ks, *by)


def recall_of(first: DataFrame, ks: Sequence[int], *by: str) -> DataFrame:
    hit = F.coalesce(F.col("first_hit") <= F.col("k"), F.lit(False))
    return (
        first.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
        .groupBy(*by, "k")
        .agg(F.avg(hit.cast("int")).alias("recall"), F.count(F.lit(1)).alias("questions"))
    )


def score_answers(predictions: DataFrame) -> DataFrame:
    """Add exact_match and f1 against the best of `golds`.

    Input: predicted STRING, golds ARRAY<STRING>. The two scores are
    maximised independently of each other.
    """
    said, golds = F.col("predicted"), F.col("golds")
    return predictions.withColumns(
        {"exact_match": an.best_exact_match(said, golds), "f1": an.best_f1(said, golds)}
    )


def eval_log(predictions: DataFrame) -> DataFrame:
    """Log rows: question, gold, aliases, predicted, retrieved prefixes, scores.

    Input: question, gold, aliases, predicted, passages. The gold answer is
    one of the accepted answers and is listed with the aliases.
    """
    limit = F.lit(settings.LOG_PREFIX_CHARS)
    golds = predictions.withColumn("golds", F.concat("aliases", F.array("gold")))
    return score_answers(golds).select(
        *[c for c in ("qid",) if c in predictions.columns],
        "question",
        "gold",
        F.col("golds").alias("aliases"),
        "predicted",
        F.transform("passages", lambda p: F.left(p, limit)).alias("retrieved"),
        "exact_match",
        "f1",
    )


def summarize(log: DataFrame, *by: str) -> DataFrame:
    """Macro means of both scores."""
    return log.groupBy(*by).agg(
        F.avg("exact_match").alias("exact_match"),
        F.avg("f1").alias("f1"),
        F.count(F.lit(1)).alias("questions"),
    )
