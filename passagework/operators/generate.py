"""Answers per question and sample through an exchangeable generator."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import settings
from ..functions import text as tx
from ..functions.binding import let
from ..runtime import spread
from .prompt import chat_messages, text_prompt

_SENTENCE_END = "[.!?]+"


def with_samples(asked: DataFrame, n_samples: int) -> DataFrame:
    """One row per question and sample; sample 0 is asked for without sampling.

    Fewer than one sample counts as one.
    """
    samples = F.sequence(F.lit(0), F.lit(max(n_samples, 1) - 1))
    return asked.withColumn("sample_idx", F.explode(samples)).withColumn(
        "do_sample", F.col("sample_idx") > 0
    )


@dataclass(frozen=True)
class ExtractiveGenerator:
    """Answers with a sentence of the passages; needs no model files.

    Sentences are ordered by the number of distinct question words in them,
    then by place. Sample i is the sentence at place i, or "" beyond the last.
    """

    def answers(self, question: Column, passages: Column, n: int) -> Column:
        """The first `n` sentences, "" where there are no more; ranked once for all samples."""
        sentences = F.filter(
            F.flatten(
                F.transform(
                    passages,
                    lambda p: F.transform(F.split(p, _SENTENCE_END), lambda s: F.trim(s)),
                )
            ),
            lambda s: s != "",
        )

        def ranked(asked):
            return F.array_sort(
                F.transform(
                    sentences,
                    lambda s, i: F.struct(
                        (-F.size(F.array_intersect(asked, tx.words(s)))).alias("score"),
                        i.alias("place"),
                        s.alias("sentence"),
                    ),
                )
            )

        def first(best):
            places = F.sequence(F.lit(0), F.lit(n - 1))
            return F.transform(places, lambda i: F.coalesce(F.get(best, i)["sentence"], F.lit("")))

        return let(let(tx.words(question), ranked), first)

    def generate(self, asked: DataFrame, n_samples: int, vote: bool) -> DataFrame:
        answers = self.answers(F.col("question"), F.col("passages"), max(n_samples, 1))
        sampled = asked.select("*", F.posexplode(answers).alias("sample_idx", "_answer"))
        return sampled.withColumn("do_sample", F.col("sample_idx") > 0).withColumnRenamed("_answer", "answer")


@dataclass(frozen=True)
class ModelGenerator:
    """A language model as generator.

    `factory` is picklable and called once per task; it returns a function
    from a list of request dicts to a list of answers. A request holds
    `prompt` (form "text") or `messages` (form "chat"), `max_new_tokens`,
    `do_sample`, `temperature` and `top_p` (None without sampling) and `seed`,
    which depends on question and sample only, so that a retried task repeats
    its answers.
    """

    factory: Callable[[], Callable[[list[dict[str, Any]]], list[str]]]
    form: str = "text"
    batch: int = 16
    max_new_tokens: int = settings.MAX_ANSWER_TOKENS
    max_prompt_tokens: int = settings.MAX_PROMPT_TOKENS
    temperature: float = settings.SAMPLE_TEMPERATURE
    top_p: float = settings.SAMPLE_TOP_P
    task_rows: int = settings.TASK_ROWS
    # Cuts text prompts by the model's own tokens.
    tokenizer: tx.Tokenizer | None = None

    def __post_init__(self):
        if self.form not in ("text", "chat"):
            raise ValueError("form is 'text' or 'chat'")

    def _request(self, vote: bool) -> Column:
        question, passages = F.col("question"), F.col("passages")
        if self.form == "text":
            return text_prompt(question, passages, vote, self.max_prompt_tokens, self.tokenizer)
        return chat_messages(question, passages, vote)

    def generate(self, asked: DataFrame, n_samples: int, vote: bool) -> DataFrame:
        samples = with_samples(asked, n_samples)
        key = "prompt" if self.form == "text" else "messages"
        slot, size, names = replace(self, tokenizer=None), self.batch, samples.columns
        asked = samples.withColumn("_request", self._request(vote)).withColumn(
            "_seed", F.xxhash64("qid", "sample_idx")
        )
        schema = T.StructType([*samples.schema.fields, T.StructField("answer", T.StringType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for big in batches:
                for start in range(0, big.num_rows, size):
                    batch = big.slice(start, size)
                    model = slot.factory() if model is None else model
                    rows = batch.select(["_request", "_seed", "do_sample"]).to_pylist()
                    answers = model([
                        {
                            key: r["_request"],
                            "max_new_tokens": slot.max_new_tokens,
                            "do_sample": r["do_sample"],
                            "temperature": slot.temperature if r["do_sample"] else None,
                            "top_p": slot.top_p if r["do_sample"] else None,
                            "seed": r["_seed"],
                        }
                        for r in rows
                    ])
                    kept = batch.select(names)
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, pa.array(answers, pa.string())],
                        [*kept.schema.names, "answer"],
                    )

        answered = spread(asked, self.task_rows, "qid", "sample_idx").mapInArrow(run, schema)
        return answered.withColumn("answer", tx.strip(F.col("answer")))


def generate(asked: DataFrame, generator, n_samples: int = 1, vote: bool = False) -> DataFrame:
    """Add sample_idx, do_sample and answer to qid, question, passages."""
    return generator.generate(asked, n_samples, vote)
