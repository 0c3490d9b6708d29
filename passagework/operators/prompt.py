"""Prompts in text and chat form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import settings
from ..functions import text as tx

# The instruction texts. Models answer differently to other words.
SYSTEM = (
    "You are a question answering assistant for a trivia dataset. "
    "Use the information in the passages to answer the question. "
    "Prefer short, factual answers. "
)
OWN_KNOWLEDGE_SINGLE = (
    "If the passages do not clearly contain the answer, answer it based on your own knowledge. "
)
OWN_KNOWLEDGE_VOTE = (
    "If the passages do not clearly contain the answer, you may answer based on your own knowledge."
)
CLOSING = "Give only the final answer as a short phrase (no explanation, no full sentence)."


def instruction(vote: bool) -> str:
    return SYSTEM + (OWN_KNOWLEDGE_VOTE if vote else OWN_KNOWLEDGE_SINGLE)


def with_passages(questions: DataFrame, ranked: DataFrame) -> DataFrame:
    """Add `passages`, the retrieved texts in rank order, to each question.

    A list holds as many texts as were retrieved per question. Questions
    without a hit get an empty list.
    """
    lists = ranked.groupBy("qid").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "passage"))), lambda r: r["passage"]
        ).alias("passages")
    )
    empty = F.array().cast("array<string>")
    return questions.join(lists, "qid", "left").withColumn(
        "passages", F.coalesce("passages", empty)
    )


def context_block(passages: Column) -> Column:
    numbered = F.transform(
        passages, lambda p, i: F.concat(F.lit("Passage "), (i + 1).cast("string"), F.lit(":\n"), p)
    )
    return F.array_join(numbered, "\n\n")


def user_part(question: Column, passages: Column) -> Column:
    return F.concat(
        F.lit("Question: "), question,
        F.lit("\n\nPassages:\n"), context_block(passages),
        F.lit("\n\n" + CLOSING),
    )


def text_prompt(
    question: Column,
    passages: Column,
    vote: bool = False,
    max_tokens: int = settings.MAX_PROMPT_TOKENS,
    tokenizer: tx.Tokenizer | None = None,
) -> Column:
    """One string, cut after its first `max_tokens` tokens, blank-separated ones by default."""
    whole = F.concat(F.lit(instruction(vote) + "\n\n"), user_part(question, passages))
    if tokenizer is None:
        return tx.first_tokens(whole, max_tokens)
    return tx.first_model_tokens(whole, max_tokens, tokenizer)


def chat_messages(question: Column, passages: Column, vote: bool = False) -> Column:
    """System and user message as array<struct<role, content>>."""

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        message("system", F.lit(instruction(vote))),
        message("user", user_part(question, passages)),
    )
