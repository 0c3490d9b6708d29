"""Tokens, windows, normalisers and previews on literal and random strings."""

import math
import re
import string

import pytest
from hypothesis import given, settings as hs, strategies as st
from pyspark.sql import functions as F, types as T

from passagework.functions import answers as an, text as tx

DROP = {ord(c): None for c in string.punctuation}


def values(spark, column_of, inputs):
    """Apply a column function to each input string, in order."""
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r[1] for r in df.select("i", column_of(F.col("x"))).orderBy("i").collect()]


def plain_answer(text):
    kept = text.lower().translate(DROP)
    return " ".join(w for w in re.sub(r"\b(?:the|an|a)\b", " ", kept).split())


def plain_vote(text):
    key = text.strip().strip("'\"").lower().rstrip(".!?,")
    return " ".join(re.sub(r"\A(?:an|a|the) ", "", key).split())


ODD = [
    "", " ", "The  Cat's-eye, a an x", "naïve é a té théa éa", "á b", "a the b",
    "x　y", "\x1cx\x85", "a​b", "_a_ the_", "A.B the-end", "an\nan\tan", "ÀÉ The ÖÜ",
    "THE", "a", "don't", "“the” end", "1 a 2the the2",
]
VOTES = [
    '"The Paris."', "the a x", "an the b", "'paris \n'", "...", "the", "A.", "", " ",
    "the  x", "a\nb", '"\'x\'"', "x.!?,", "an apple", "The", "The ", "“q”", "x  y.\n",
]
ALPHABET = st.sampled_from(
    list("aAnNtThHeExyz019 _-.,!?'\"\n\t`~$") + ["é", "ß", "Ω", "ж", "中", " ", " ", "́", "“"]
)


def test_normalize_answer_literals(spark):
    assert values(spark, tx.normalize_answer, ODD) == [plain_answer(x) for x in ODD]


def test_normalize_vote_literals(spark):
    assert values(spark, tx.normalize_vote, VOTES) == [plain_vote(x) for x in VOTES]
    assert values(spark, tx.normalize_vote, ["the a x", "an the b", "..."]) == ["a x", "the b", ""]


@hs(max_examples=5, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=200, max_size=400))
def test_normalizers_on_random_text(spark, texts):
    assert values(spark, tx.normalize_answer, texts) == [plain_answer(x) for x in texts]
    assert values(spark, tx.normalize_vote, texts) == [plain_vote(x) for x in texts]


@hs(max_examples=5, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=100, max_size=200))
def test_word_count_and_strip(spark, texts):
    assert values(spark, tx.word_count, texts) == [len(x.split()) for x in texts]
    assert values(spark, tx.strip, texts) == [x.strip() for x in texts]


@pytest.mark.parametrize("size,overlap", [(240, 60), (5, 5), (5, 9), (4, 0), (3, -2), (1, 0)])
def test_windows(spark, size, overlap):
    step = max(1, size - overlap)
    counts = [0, 1, 2, 3, 4, 5, 6, 180, 181, 240, 241, 360, 361]
    df = spark.createDataFrame([(n,) for n in counts], "n int").withColumn(
        "items", F.expr("CASE WHEN n = 0 THEN array() ELSE transform(sequence(1, n), x -> cast(x AS string)) END")
    )
    rows = df.select("n", F.coalesce(tx.windows(F.col("items"), size, step), F.array()).alias("w")).collect()
    for r in rows:
        words = [str(i + 1) for i in range(r["n"])]
        assert r["w"] == [words[s : s + size] for s in range(0, r["n"], step)]
        assert len(r["w"]) == math.ceil(r["n"] / step)


def test_tokens(spark):
    got = values(spark, tx.tokens, [" a  b\n\tc ", "", " \n", None, "x"])
    assert got == [["a", "b", "c"], [], [], [], ["x"]]


def test_words_break_at_punctuation(spark):
    got = values(spark, tx.words, ["Don't, stop!", "...", "(É) b-c", None])
    assert got == [["don", "t", "stop"], [], ["é", "b", "c"], []]


def test_first_tokens_keeps_inner_whitespace(spark):
    texts = [" a\n\nb  c d", "a", "", "x " * 5000]
    got = values(spark, lambda c: tx.first_tokens(c, 3), texts)
    assert got == [" a\n\nb  c", "a", "", "x x x"]
    long = values(spark, lambda c: tx.first_tokens(c, 2048), ["w " * 100_000])[0]
    assert long == " ".join(["w"] * 2048)


def test_titles_and_previews(spark):
    assert values(spark, tx.title_or_default, ["", None, "x"]) == ["No Title", "No Title", "x"]
    assert values(spark, lambda c: tx.clip(c, 3), ["abc", "abcd", None]) == ["abc", "abc...", None]
    assert values(spark, lambda c: tx.one_line(c, 4), ["a\nb\nc"]) == ["a b "]


def test_clip_nested(spark):
    kind = T.StructType.fromDDL("s string, l array<struct<x: string, n: int>>, m map<string, string>")
    df = spark.createDataFrame([(("abcd", [("efgh", 1), None], {"kkkk": "vvvv"}),)], T.StructType([T.StructField("v", kind)]))
    got = df.select(tx.clip_nested(F.col("v"), kind, 2).alias("v")).first()["v"]
    assert got["s"] == "ab..." and got["l"][0]["x"] == "ef..." and got["l"][0]["n"] == 1
    assert got["l"][1] is None and got["m"] == {"kkkk": "vv..."}


def plain_f1(pred, gold):
    from collections import Counter

    p, g = plain_answer(pred).split(), plain_answer(gold).split()
    if not p or not g:
        return float(p == g)
    same = sum((Counter(p) & Counter(g)).values())
    if same == 0:
        return 0.0
    precision, recall = same / len(p), same / len(g)
    return 2 * precision * recall / (precision + recall)


@hs(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.text(ALPHABET, max_size=20), st.text(ALPHABET, max_size=20)), min_size=200, max_size=300))
def test_answer_scores_on_random_pairs(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, g string")
    rows = df.select(
        "i", an.exact_match(F.col("p"), F.col("g")), an.token_f1(F.col("p"), F.col("g"))
    ).orderBy("i").collect()
    for (p, g), (_, em, f1) in zip(pairs, rows):
        assert em == int(plain_answer(p) == plain_answer(g))
        assert f1 == plain_f1(p, g)


def test_f1_literals(spark):
    pairs = [("", ""), ("the", ""), ("", "x"), ("x x y", "x y y"), ("p", "q"), ("x y", "Y, X!")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, g string")
    got = [r[1] for r in df.select("i", an.token_f1(F.col("p"), F.col("g"))).orderBy("i").collect()]
    assert got == [1.0, 1.0, 0.0, pytest.approx(2 / 3), 0.0, 1.0]


def test_best_scores_use_different_aliases(spark):
    df = spark.createDataFrame([("x y", ["x y z", "x", "y x"]), ("the", [""]), ("q", [])], "p string, g array<string>")
    rows = df.select(an.best_exact_match(F.col("p"), F.col("g")), an.best_f1(F.col("p"), F.col("g"))).collect()
    assert rows[0][0] == 0 and rows[0][1] == 1.0
    assert rows[1][0] == 1 and rows[1][1] == 1.0
    assert rows[2][0] == 0 and rows[2][1] is None


def test_alias_and_context_tests(spark):
    df = spark.createDataFrame(
        [
            ("Title: Big CAT", ["cat"]), ("Title: x", ["title"]), ("x", [""]), ("x", []),
            ("x", None), ("don't", ["dont"]), (None, ["x"]), ("x", [None, "x"]), ("x", [None]),
        ],
        "p string, a array<string>",
    )
    got = [r[0] for r in df.select(an.mentions_any(F.col("p"), F.col("a"))).collect()]
    assert got == [True, True, True, False, False, False, False, True, False]
    df = spark.createDataFrame([("a b", ["x", "A\n B c"]), ("", ["x"]), ("q", []), ("q", None)], "n string, p array<string>")
    got = [r[0] for r in df.select(an.grounded(F.col("n"), F.col("p"))).collect()]
    assert got == [True, False, False, False]


def test_model_tokenizer_gets_bounded_pieces(spark):
    """A batch of long texts does not become objects all at once; the output is that of single texts."""
    def factory():
        def to_ids(texts):
            assert len(texts) == 1 or sum(map(len, texts)) <= 800_000
            return [[ord(c) for c in t] for t in texts]

        return to_ids, lambda ids: ["".join(map(chr, row)) for row in ids]

    tokenizer = tx.model_tokenizer(factory, "bounded")
    rows = spark.createDataFrame([(i, None if i == 3 else "ab" * (i % 5) * 30_000) for i in range(20)], "i long, t string").coalesce(1)
    got = rows.withColumn("ids", tokenizer.encode(F.col("t"))).select("i", F.size("ids").alias("n"), tokenizer.decode(F.col("ids")).alias("back"), "t")
    assert all(r["n"] == len(r["t"] or "") and r["back"] == (r["t"] or "") for r in got.collect()) and got.count() == 20
