"""Retrieval quality, end-to-end answers and chunk-setting sweeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import settings
from ..operators import metrics
from ..operators.generate import generate
from ..operators.prompt import with_passages
from ..operators.rerank import IdfOverlapScorer, encode_questions, retrieve
from ..operators.vote import vote
from ..runtime import staged
from ..sources import artifacts, examples as ex
from .corpus import ensure_sweep, pages_of_shards, sweep_index


def ranked_for_recall(
    questions: DataFrame,
    index: DataFrame,
    encoder,
    scorer=None,
    candidates: int = settings.CANDIDATES,
    ks: Sequence[int] = settings.RECALL_AT,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Reranked candidates; at least as many as the largest k asks for."""
    return retrieve(questions, index, encoder, scorer, max(candidates, max(ks)), max(ks), vectors)


def evaluate_recall(
    questions: DataFrame,
    index: DataFrame,
    encoder,
    scorer=None,
    candidates: int = settings.CANDIDATES,
    ks: Sequence[int] = settings.RECALL_AT,
    by: Sequence[str] = (),
) -> DataFrame:
    """Recall@K of (qid, question, aliases), per `by` column such as split."""
    ranked = ranked_for_recall(questions, index, encoder, scorer, candidates, ks)
    return metrics.recall_at(ranked, questions, ks, by)


def compare_rerank(
    questions: DataFrame,
    index: DataFrame,
    encoder,
    scorer,
    candidates: int = settings.CANDIDATES,
    ks: Sequence[int] = settings.RECALL_AT,
) -> DataFrame:
    """Recall@K in vector order and in reranked order, from one search."""
    top = max(ks)
    both = retrieve(questions, index, encoder, scorer, max(candidates, top), None)
    variants = both.select(
        "qid",
        "passage",
        F.expr("stack(2, 'vector', candidate_rank, 'rerank', rank) AS (variant, rank)"),
    ).where(F.col("rank") <= top)
    first = metrics.first_hits(variants, questions, "variant")
    every = questions.select(
        "qid", F.explode(F.array(F.lit("vector"), F.lit("rerank"))).alias("variant")
    )
    return metrics.recall_of(every.join(first, ["qid", "variant"], "left"), ks, "variant")


def answer(
    questions: DataFrame,
    index: DataFrame,
    encoder,
    generator,
    scorer=None,
    candidates: int = settings.CANDIDATES,
    k: int = settings.ANSWER_TOP,
    consensus: bool = False,
    n_samples: int = settings.VOTE_SAMPLES,
) -> DataFrame:
    """Answer every question: the input columns plus passages and answer.

    Contexts and answers are written tables: generation is dear, and votes,
    scores and logs must all see the same samples.
    """
    ranked = retrieve(questions, index, encoder, scorer, candidates, k)
    asked = staged(with_passages(questions, ranked), "contexts")
    if not consensus:
        n_samples = 1
    generated = generate(asked, generator, n_samples, vote=consensus)
    samples = staged(generated.select("qid", "sample_idx", "answer"), "answers")
    final = vote(samples, asked) if consensus else samples
    return asked.join(final.select("qid", "answer"), "qid")


def evaluate_answers(
    questions: DataFrame, index: DataFrame, encoder, generator, scorer=None, **options
) -> DataFrame:
    """Log rows of (qid, question, gold, aliases) answered end to end."""
    answered = answer(questions, index, encoder, generator, scorer, **options)
    return metrics.eval_log(answered.withColumnRenamed("answer", "predicted"))


def run_recall(
    spark: SparkSession,
    shards: str,
    index: DataFrame,
    encoder,
    scorer=None,
    sample_limit: int | None = None,
    candidates: int = settings.CANDIDATES,
    ks: Sequence[int] = settings.RECALL_AT,
    splits: Sequence[str] = settings.SPLITS,
) -> DataFrame:
    """Recall@K on all examples of each split of a sharded table, or on the first `sample_limit` of each."""
    rows = ex.read_shards(spark, shards, splits)
    if sample_limit is not None:
        rows = ex.head_per_split(rows, sample_limit, ex.read_catalogue(spark, shards, splits))
    asked = ex.as_questions(ex.in_source_order(ex.require_rows(rows, shards), splits))
    return evaluate_recall(staged(asked, "asked"), index, encoder, scorer, candidates, ks, ["split"])


def run_answers(
    spark: SparkSession,
    shards: str,
    index: DataFrame,
    encoder,
    generator,
    scorer=None,
    max_questions: int = settings.EVAL_ROWS,
    k: int = settings.RERANK_TOP,
    save_path: str | None = None,
    consensus: bool = False,
) -> DataFrame:
    """Mean exact match and F1 on the first test examples; the log is saved on request."""
    first = ex.head(ex.read_shards(spark, shards, ["test"]), max_questions, ex.read_catalogue(spark, shards, ["test"]))
    asked = ex.as_questions(ex.in_source_order(ex.require_rows(first, shards), ["test"]))
    log = evaluate_answers(
        staged(asked.drop("split"), "asked"), index, encoder, generator, scorer, k=k, consensus=consensus
    )
    if save_path is None:
        return metrics.summarize(log)
    artifacts.write_log(log.drop("qid"), save_path)
    return metrics.summarize(artifacts.read_log(spark, save_path))


def sweep_recall(
    questions: DataFrame,
    pages: DataFrame,
    sweep: Sequence[settings.Chunking],
    encoder,
    scorer=None,
    candidates: int = settings.CANDIDATES,
    ks: Sequence[int] = settings.RECALL_AT,
) -> DataFrame:
    """Recall@K and corpus size per chunk setting."""
    return recall_per_run(questions, sweep_index(pages, sweep, encoder), sweep, encoder, scorer, candidates, ks)


def recall_per_run(
    questions: DataFrame,
    index: DataFrame,
    sweep: Sequence[settings.Chunking],
    encoder,
    scorer=None,
    candidates: int = settings.CANDIDATES,
    ks: Sequence[int] = settings.RECALL_AT,
) -> DataFrame:
    """Recall@K and corpus size of each run of an index as `sweep_index` makes it.

    One search, one ranking and one aggregation for all runs, with `run` as a part of every key. A scorer that
    counts words does so per run.
    """
    runs = range(1, len(sweep) + 1)
    if isinstance(scorer, IdfOverlapScorer):
        scorer = IdfOverlapScorer.on(index, "run")
    top = max(ks)
    vectors = encode_questions(questions, encoder)
    ranked = retrieve(questions, index, encoder, scorer, max(candidates, top), top, vectors, runs)
    first = metrics.first_hits(ranked, questions, "run")
    chosen = F.array(*[
        F.struct(F.lit(run).alias("run"), F.lit(c.tokens).alias("chunk_tokens"), F.lit(c.overlap).alias("chunk_overlap"))
        for run, c in zip(runs, sweep)
    ])
    every = questions.select("qid", F.inline(chosen))
    recalls = metrics.recall_of(every.join(first, ["qid", "run"], "left"), ks, "run", "chunk_tokens", "chunk_overlap")
    size = index.groupBy("run").agg(F.count(F.lit(1)).alias("passages"))
    return recalls.join(size, "run")


def sweep_shards(
    spark: SparkSession,
    shards: str,
    root: str,
    questions: DataFrame,
    sweep: Sequence[settings.Chunking],
    encoder,
    encoder_name: str,
    scorer=None,
    splits: Sequence[str] = settings.SPLITS,
    max_shards: int | None = None,
) -> DataFrame:
    """Recall@K per chunk setting over all shards, or the first `max_shards` of each split, with an index under `root` that later sweeps reuse."""
    pages = staged(pages_of_shards(spark, shards, splits, max_shards), "pages")
    index = ensure_sweep(pages, sweep, encoder, root, encoder_name)
    return recall_per_run(questions, index, sweep, encoder, scorer)
