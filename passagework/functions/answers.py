"""Scores of one predicted answer, and tests of answers against passages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .binding import let
from .text import normalize_answer, squeeze


def answer_words(text: Column) -> Column:
    return F.filter(F.split(normalize_answer(text), " "), lambda w: w != "")


def exact_match(predicted: Column, gold: Column) -> Column:
    return (normalize_answer(predicted) == normalize_answer(gold)).cast("int")


def counted(items: Column) -> Column:
    """Distinct words in order, each with how often it is there, by one sort."""

    def of_sorted(words):
        begins = F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
            lambda e: (e["at"] == 0) | (F.get(words, e["at"] - 1) != e["word"]),
        )
        return let(begins, lambda found: F.transform(found, lambda e, i: F.struct(
            e["word"].alias("word"), (F.coalesce(F.get(found, i + 1)["at"], F.size(words)) - e["at"]).alias("n")
        )))

    return let(F.array_sort(items), of_sorted)


def f1_of_counted(p: Column, g: Column) -> Column:
    """Token F1 of two lists of counted words: multiset overlap, harmonic mean.

    Both lists are sorted together, where a common word stands beside itself; so long answers cost
    what a sort does.
    """

    def shared(both):
        pairs = F.transform(both, lambda e, i: F.when(
            F.get(both, i - 1)["word"] == e["word"], F.least(F.get(both, i - 1)["n"], e["n"])
        ).otherwise(0))
        return F.aggregate(pairs, F.lit(0), lambda total, n: total + n).cast("double")

    def harmonic(same):
        precision, recall = F.try_divide(same, _total(p)), F.try_divide(same, _total(g))
        return (
            F.when((F.size(p) == 0) & (F.size(g) == 0), F.lit(1.0))
            .when(same == 0, F.lit(0.0))
            .otherwise(2 * precision * recall / (precision + recall))
        )

    return let(let(F.array_sort(F.concat(p, g)), shared), harmonic)


def _total(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda total, e: total + e["n"])


def token_f1(predicted: Column, gold: Column) -> Column:
    return let(
        counted(answer_words(predicted)), lambda p: let(counted(answer_words(gold)), lambda g: f1_of_counted(p, g))
    )


def best_exact_match(predicted: Column, golds: Column) -> Column:
    """Highest exact match over all accepted answers."""
    accepted = F.transform(golds, normalize_answer)
    hit = F.array_contains(accepted, normalize_answer(predicted))
    return F.coalesce(hit, F.lit(False)).cast("int")


def best_f1(predicted: Column, golds: Column) -> Column:
    """Highest token F1 over all accepted answers; the prediction is split and counted once."""

    def against(said):
        return F.array_max(
            F.transform(golds, lambda g: let(counted(answer_words(g)), lambda w: f1_of_counted(said, w)))
        )

    return let(counted(answer_words(predicted)), against)


def mentions_any(passage: Column, aliases: Column) -> Column:
    """True if some alias occurs in the lower-cased passage; aliases stay as given."""
    found = let(F.lower(passage), lambda p: F.exists(aliases, lambda a: F.contains(p, a)))
    return F.coalesce(found, F.lit(False))


def grounded(norm: Column, passages: Column) -> Column:
    """True if the normalised answer occurs in one of the passages."""
    found = F.exists(passages, lambda p: F.contains(squeeze(F.lower(p)), norm))
    return F.coalesce((norm != "") & found, F.lit(False))
