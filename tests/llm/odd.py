"""Documents with all that may be odd about them."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, class_id long, row string"
PASSAGE = "one passage of many words that stands in more than one text and is longer than a hundred bytes, all in all"
LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(30_000))


def odd_docs(spark):
    texts = [
        (1, "a plain first text with several words in it, and a second sentence.\n" + PASSAGE),
        (2, None),
        (3, ""),
        (4, "a plain first text with several words in it, and a second sentence.\n" + PASSAGE),
        (5, "é ß 中文 😀 \x00 \u0301 \u200b tab\tline\r\n\n\n  two  blanks  "),
        (6, LONG),
        (7, "Erin Erin " * 300),
        (None, "a text without any id, but with " + PASSAGE),
        (9, "short"),
        (9, "another text of the same id"),
        (10, "one row given twice, word for word, with " + PASSAGE),
        (10, "one row given twice, word for word, with " + PASSAGE),
        (11, "<|endoftext|> it's <|startoftext|>"),
        (12, "\n"),
        (-5, "a negative id"),
    ]
    rows = [(i, t, None if i == 3 else "en", "s", None if t is None else len(t), "k", 0.5, 77, "r") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]
