"""Tokens, chunk windows, answer normalisers and previews."""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from . import runs

# Separators, punctuation and articles of the answer metrics.
BLANKS = " \t\n\r"
BLANK_RUN = r"[ \t\n\r]+"
UNICODE_BLANK_RUN = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]+"
PUNCTUATION = string.punctuation
PUNCTUATION_CLASS = r"[!-/:-@\[-`{-~]"
WORD_BREAK = r"[ \t\n\r!-/:-@\[-`{-~]+"
ARTICLES = r"(?<![\p{L}\p{N}_])(a|an|the)(?![\p{L}\p{N}_])"
QUOTES = "\"'"
VOTE_TRAILING = r"[.!?,]+\z"
VOTE_ARTICLE = r"\A(the |a |an )"
NO_TITLE = "No Title"
# Code points or ids that a model's tokenizer gets at a time, but at least one text.
_PIECE = 500_000

_NO_TOKENS = "array<string>"
_IN_TOKEN, _IN_WORD = runs.outside(BLANKS), runs.outside(BLANKS + PUNCTUATION)


def tokens(text: Column) -> Column:
    """Default tokeniser: maximal runs of non-blank characters."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, BLANK_RUN)).otherwise(
        F.array().cast(_NO_TOKENS)
    )


def words(text: Column) -> Column:
    """Lower-case words between blanks and ASCII punctuation, for matching and hashing."""
    trimmed = F.btrim(F.lower(text), F.lit(BLANKS + PUNCTUATION))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WORD_BREAK)).otherwise(
        F.array().cast(_NO_TOKENS)
    )


def coded_words(lowered: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """In a task, the `words` of texts that are lower-case already: their numbers, how many each text has, the words by number."""
    return runs.coded_words(lowered, _IN_WORD)


def word_count(text: Column) -> Column:
    """Number of Unicode-whitespace separated words; null stays null."""
    trimmed = squeeze(text)
    return F.when(text.isNull(), F.lit(None)).otherwise(
        F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " ")))
    ).cast("int")


def squeeze(text: Column) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(text, UNICODE_BLANK_RUN, " "))


def strip(text: Column) -> Column:
    """Remove whitespace at both ends."""
    return F.regexp_replace(text, rf"\A{UNICODE_BLANK_RUN}|{UNICODE_BLANK_RUN}\z", "")


def windows(items: Column, size: Column | int, step: Column | int) -> Column:
    """Overlapping slices that start at 0, step, 2*step, ... below the length."""
    n = F.size(items)
    starts = F.sequence(F.lit(0), n - 1, step if isinstance(step, Column) else F.lit(step))
    return F.when(n > 0, F.transform(starts, lambda s: F.slice(items, s + 1, size)))


def blank_windows(text: Column, cuts: Sequence[tuple[int, int]]) -> Column:
    """For each (size, step) the `windows` of the `tokens` of a text, put together with spaces: array<array<string>>."""
    # What a piece turns into is bounded, however much windows overlap.
    most = int(runs.PIECE_BYTES // max(1, sum(size / step for size, step in cuts)))

    @F.arrow_udf("array<array<string>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for some in runs.pieces(texts, most):
                yield runs.token_windows(some, _IN_TOKEN, cuts)

    return cut(text)


@dataclass(frozen=True)
class Tokenizer:
    """Text to a token array and back, both as column functions."""

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]
    # Part of the paths of tables that were made with it.
    name: str = "blank"
    # Text to the decoded windows of several (size, step), where that is cheaper than by tokens.
    cut: Callable[[Column, Sequence[tuple[int, int]]], Column] | None = None


BLANK_TOKENIZER = Tokenizer(tokens, lambda items: F.array_join(items, " "), cut=blank_windows)


def _pieces(values: pd.Series, sizes: pd.Series) -> Iterator[pd.Series]:
    """Runs of values that begin in the same `_PIECE` of their added sizes: ids of a whole batch as objects take gigabytes."""
    if len(values):
        for _, some in values.groupby(((sizes.cumsum() - sizes) // _PIECE).to_numpy(), sort=False):
            yield some
    else:
        yield values


def model_tokenizer(
    factory: Callable[[], tuple[Callable[[list[str]], list], Callable[[list], list[str]]]],
    name: str,
) -> Tokenizer:
    """Tokenizer of a model.

    `factory` is picklable; each task calls it once and gets back two
    functions on batches: texts to lists of ids, and lists of ids (arrays, or parts of what the first one gave) to texts.
    `name` tells tables of different tokenizers apart. Windows are cut and put together in the
    task that made the ids, which so never leave it.
    """

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        to_ids, _ = factory()
        for texts in batches:
            for some in _pieces(texts.fillna(""), texts.str.len().fillna(0)):
                yield pd.Series(to_ids(some.tolist()))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, to_text = factory()
        for ids in batches:
            for some in _pieces(ids, ids.str.len().fillna(0)):
                yield pd.Series(to_text(some.tolist()))

    def cut(text: Column, cuts: Sequence[tuple[int, int]]) -> Column:
        @F.pandas_udf("array<array<string>>")
        def windows_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            to_ids, to_text = factory()
            for texts in batches:
                made = []
                for some in _pieces(texts.fillna(""), texts.str.len().fillna(0)):
                    ids = to_ids(some.tolist())
                    spans = [[row[a : a + size] for a in range(0, len(row), step)] for row in ids for size, step in cuts]
                    flat = iter(to_text([span for group in spans for span in group]))
                    # Python strips the same characters as `strip`.
                    whole = [[next(flat).strip() for _ in group] for group in spans]
                    made += [whole[a : a + len(cuts)] for a in range(0, len(whole), len(cuts))]
                yield pd.Series(made, dtype=object)

        return windows_of(text)

    return Tokenizer(encode, lambda ids: strip(decode(ids)), name, cut)


def title_or_default(title: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.lit(NO_TITLE))


def first_tokens(text: Column, limit: int) -> Column:
    """The text up to its `limit`-th token as `tokens` cuts them, inner blanks kept."""
    return F.regexp_extract(text, rf"^(?:[{BLANKS}]*+[^{BLANKS}]++){{0,{limit}}}+", 0)


def first_model_tokens(text: Column, limit: int, tokenizer: Tokenizer) -> Column:
    """The text of the first `limit` tokens of `tokenizer`; a text of no more tokens stays as it is."""
    items = tokenizer.encode(text)
    return F.when(F.size(items) <= limit, text).otherwise(tokenizer.decode(F.slice(items, 1, limit)))


def normalize_answer(text: Column) -> Column:
    """Lower-case, drop punctuation, blank out articles, collapse whitespace."""
    bare = F.regexp_replace(F.lower(text), PUNCTUATION_CLASS, "")
    return squeeze(F.regexp_replace(bare, ARTICLES, " "))


def normalize_vote(text: Column) -> Column:
    """Key under which sampled answers are counted as the same answer."""
    bare = F.lower(F.btrim(strip(text), F.lit(QUOTES)))
    bare = F.regexp_replace(bare, VOTE_TRAILING, "")
    return squeeze(F.regexp_replace(bare, VOTE_ARTICLE, ""))


def clip(text: Column, limit: int) -> Column:
    """Cut to `limit` characters, marking the cut."""
    cut = F.concat(F.left(text, F.lit(limit)), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def one_line(text: Column, limit: int) -> Column:
    """Preview: a prefix with newlines shown as spaces."""
    return F.translate(F.left(text, F.lit(limit)), "\n", " ")


def clip_nested(value: Column, kind: T.DataType, limit: int) -> Column:
    """Apply `clip` to every string inside arrays, structs and map values."""
    if isinstance(kind, T.StringType):
        return clip(value, limit)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: clip_nested(x, kind.elementType, limit))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: clip_nested(x, kind.valueType, limit))
    if isinstance(kind, T.StructType):
        parts = [clip_nested(value[f.name], f.dataType, limit).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value
