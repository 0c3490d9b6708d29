"""Candidate passages, pair scores and the final ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .. import settings
from ..functions import text as tx
from ..runtime import spread, staged
from .encode import encode
from .search import search

# Weights are whole millionths, so that a sum does not depend on its order.
_WEIGHT_UNIT = 1_000_000
_WORDS = "_passage_words"
# Texts whose words are sorted at a time.
_SLICE = 1024


def fetch_passages(hits: DataFrame, passages: DataFrame, *others: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the passage text of each hit, and `others`; the optimizer sizes the join."""
    keys = [*by, "passage_id"]
    return hits.join(passages.select(*keys, "passage", *others), keys)


def word_frequencies(passages: DataFrame, *by: str) -> DataFrame:
    """(by, word, df): how many passages have each word; the row of the null word counts all passages.

    A task counts the words of an Arrow batch, and these counts are added up before the shuffle, so a word that is
    in every passage is one row per task. Written once beside an index, it serves every search in it.
    """
    read = passages.where(F.col("passage").isNotNull()).select(*by, F.lower("passage").alias("_lowered"))
    kept = [f for f in read.schema.fields if f.name != "_lowered"]
    schema = T.StructType([*kept, T.StructField("word", T.StringType()), T.StructField("df", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _counted(batch, by, schema.names)

    return read.mapInArrow(count, schema).groupBy(*by, "word").agg(F.sum("df").alias("df"))


def _counted(batch: pa.RecordBatch, by: Sequence[str], names: list[str]) -> pa.RecordBatch:
    """How many texts of the batch have each word, and how many there are, per group of the `by` columns."""
    columns = [batch.column(batch.schema.get_field_index(c)) for c in by]
    group = np.zeros(batch.num_rows, np.int64)
    for column in columns:
        value = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        group = np.unique(group * batch.num_rows + value, return_inverse=True)[1]
    first = np.unique(group, return_index=True)[1]
    codes, sizes, words = tx.coded_words(batch.column(batch.schema.get_field_index("_lowered")))
    width, ends = max(1, len(words)), np.concatenate([[0], np.cumsum(sizes)])
    cells = [np.zeros(0, np.int64)]
    for a in range(0, batch.num_rows, _SLICE):
        b = min(a + _SLICE, batch.num_rows)
        found = np.repeat(np.arange(a, b), sizes[a:b]) * width + codes[ends[a] : ends[b]]
        found.sort()
        # A word of a text counts once.
        found = found[np.diff(found, prepend=-1) > 0]
        cells.append(group[found // width] * width + found % width)
    cell, df = np.unique(np.concatenate(cells), return_counts=True)
    texts = pa.nulls(len(first), words.type)
    word = pa.concat_arrays([words.take(pa.array(cell % width)), texts])
    row = pa.array(np.concatenate([first[cell // width], first]))
    counts = pa.array(np.concatenate([df, np.bincount(group)]).astype(np.int64))
    return pa.RecordBatch.from_arrays([*[c.take(row) for c in columns], word, counts], names)


@dataclass(frozen=True)
class IdfOverlapScorer:
    """Sum of idf weights of the distinct question words found in the passage.

    `frequencies` is what `word_frequencies` gave for the index; without it, each call counts the words of the
    passages anew.
    """

    frequencies: DataFrame | None = None

    @classmethod
    def on(cls, index: DataFrame, *by: str) -> IdfOverlapScorer:
        """Scorer for an index whose word frequencies are counted and written here."""
        return cls(staged(word_frequencies(index, *by), "word-frequencies"))

    def weights(self, questions: DataFrame, passages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Per question its distinct words with weight ln(1 + N / df), in each of the `by` groups."""
        known = word_frequencies(passages, *by) if self.frequencies is None else self.frequencies
        asked = questions.select(
            "qid", F.explode(F.array_distinct(tx.words(F.col("question")))).alias("word")
        )
        total = known.where(F.col("word").isNull()).select(*by, F.col("df").cast("double").alias("total"))
        found = asked.join(known, "word")
        found = found.join(total, list(by)) if by else found.withColumn("total", total.select("total").scalar())
        weight = F.round(F.ln(1 + F.col("total") / F.col("df")) * _WEIGHT_UNIT).cast("bigint")
        return (
            found.select(*by, "qid", F.struct("word", weight.alias("weight")).alias("w"))
            .groupBy(*by, "qid")
            .agg(F.map_from_entries(F.collect_list("w")).alias("weights"))
        )

    @staticmethod
    def prepare(passages: DataFrame) -> DataFrame:
        """Passages with their words, so that these are cut once and not per pair."""
        return passages.withColumn(_WORDS, tx.words(F.col("passage")))

    def score(self, pairs: DataFrame, questions: DataFrame, passages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        pairs = pairs if _WORDS in pairs.columns else self.prepare(pairs)
        weighted = pairs.join(self.weights(questions, passages, by), [*by, "qid"], "left")
        shared = F.array_intersect(F.map_keys("weights"), F.col(_WORDS))
        none = F.lit(0).cast("bigint")
        total = F.aggregate(shared, none, lambda s, w: s + F.col("weights")[w])
        score = F.coalesce(total, none) / F.lit(float(_WEIGHT_UNIT))
        return weighted.withColumn("rerank_score", score).drop("weights", _WORDS)


@dataclass(frozen=True)
class PairScorer:
    """A model that scores (question, passage) pairs, built once per task; it sees `batch` pairs a time."""

    factory: Callable[[], Callable[[list[tuple[str, str]]], Sequence[float]]]
    task_rows: int = settings.TASK_ROWS
    batch: int = settings.ENCODE_BATCH

    def score(self, pairs: DataFrame, questions: DataFrame, passages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        factory, size = self.factory, self.batch
        schema = T.StructType([*pairs.schema.fields, T.StructField("rerank_score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for big in batches:
                for start in range(0, big.num_rows, size):
                    batch = big.slice(start, size)
                    model = factory() if model is None else model
                    asked = batch.column("question").to_pylist()
                    found = batch.column("passage").to_pylist()
                    scores = pa.array(np.asarray(model(list(zip(asked, found))), dtype=np.float64))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, scores], [*batch.schema.names, "rerank_score"]
                    )

        return spread(pairs, self.task_rows, *by, "qid", "passage_id").mapInArrow(run, schema)


def rerank(
    pairs: DataFrame, questions: DataFrame, passages: DataFrame, scorer, k: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Order each question's candidates by pair score, ties by candidate rank.

    Input: qid, passage_id, score, rank, question, passage. `rank` becomes the
    new rank and `candidate_rank` keeps the old one. Without a scorer the
    vector order stays. A question has as many rows as candidates were asked
    for, so its window is bounded by that parameter. `by` names columns that keep several indexes apart.
    """
    if scorer is None:
        ranked = pairs.withColumn("candidate_rank", F.col("rank")).withColumn(
            "rerank_score", F.lit(None).cast("double")
        )
        return ranked if k is None else ranked.where(F.col("rank") <= k)
    scored = scorer.score(pairs.withColumnRenamed("rank", "candidate_rank"), questions, passages, by)
    order = Window.partitionBy(*by, "qid").orderBy(F.desc("rerank_score"), "candidate_rank")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def encode_questions(questions: DataFrame, encoder) -> DataFrame:
    """qid, question and embedding of each question, encoded in parallel and written once."""
    asked = spread(questions.select("qid", "question"), settings.TASK_ROWS, "qid")
    return staged(encode(asked, "question", encoder), "question-vectors")


def retrieve(
    questions: DataFrame,
    index: DataFrame,
    encoder,
    scorer=None,
    candidates: int = settings.CANDIDATES,
    k: int | None = settings.RERANK_TOP,
    vectors: DataFrame | None = None,
    runs: Sequence[int] = (),
) -> DataFrame:
    """Encode, search, fetch and rerank for all questions.

    `questions`: qid, question. `index`: passage_id, passage, embedding. `vectors`: what
    `encode_questions` gave, for several searches with the same questions. `runs`: see `search`;
    all runs are searched and ranked together, each on its own.
    """
    asked = questions.select("qid", "question")
    by = ["run"] if runs else []
    if vectors is None:
        vectors = encode_questions(questions, encoder)
    hits = search(vectors, index, candidates, runs=runs)
    keys, extra = [*by, "passage_id"], []
    passages = index.select(*keys, "passage")
    if hasattr(scorer, "prepare"):
        # Only passages that are candidates of some question are prepared, and each of them once.
        passages = scorer.prepare(passages.join(hits.select(*keys).distinct(), keys, "left_semi"))
        extra = [c for c in passages.columns if c not in (*keys, "passage")]
    pairs = fetch_passages(hits, passages, *extra, by=by).join(asked, "qid")
    return rerank(pairs, asked, index, scorer, k, by)
