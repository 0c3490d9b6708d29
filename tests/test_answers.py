"""Prompts, generators, votes, scores and end-to-end answers."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from passagework import schemas
from passagework.operators import metrics, prompt
from passagework.operators.encode import HashingEncoder
from passagework.operators.generate import ExtractiveGenerator, ModelGenerator, generate
from passagework.operators.rerank import IdfOverlapScorer
from passagework.operators.vote import vote
from passagework.plans import corpus, evaluate
from passagework.runtime import staging_path
from passagework.sources import artifacts

from test_text import plain_vote


def asked_table(spark):
    rows = [
        (1, "who is red", ["T: Foo is blue. Red is who! Who", "U: red"]),
        (2, "x", []),
    ]
    return spark.createDataFrame(rows, "qid long, question string, passages array<string>")


def test_passages_in_rank_order(spark):
    questions = spark.createDataFrame([(1, "q"), (2, "r")], "qid long, question string")
    ranked = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 10, "c")], "qid long, rank int, passage string")
    got = {r["qid"]: r["passages"] for r in prompt.with_passages(questions, ranked).collect()}
    assert got == {1: ["a", "b", "c"], 2: []}


def test_prompt_forms(spark):
    df = spark.createDataFrame([("Q?", ["a", "b"]), ("Q?", [])], "question string, passages array<string>")
    q, p = F.col("question"), F.col("passages")
    rows = df.select(
        prompt.context_block(p).alias("c"), prompt.text_prompt(q, p).alias("t"),
        prompt.text_prompt(q, p, vote=True).alias("v"), prompt.chat_messages(q, p).alias("m"),
        prompt.text_prompt(q, p, max_tokens=2).alias("cut"),
    ).collect()
    assert rows[0]["c"] == "Passage 1:\na\n\nPassage 2:\nb" and rows[1]["c"] == ""
    user = "Question: Q?\n\nPassages:\nPassage 1:\na\n\nPassage 2:\nb\n\n" + prompt.CLOSING
    assert rows[0]["t"] == prompt.instruction(False) + "\n\n" + user
    assert rows[0]["v"] == prompt.instruction(True) + "\n\n" + user
    assert [m["role"] for m in rows[0]["m"]] == ["system", "user"]
    assert rows[0]["m"][1]["content"] == user and rows[0]["m"][0]["content"] == prompt.instruction(False)
    assert rows[0]["cut"] == "You are"


def test_extractive_answers(spark):
    got = generate(asked_table(spark), ExtractiveGenerator(), 5).orderBy("qid", "sample_idx").collect()
    first = [(r["sample_idx"], r["do_sample"], r["answer"]) for r in got if r["qid"] == 1]
    assert first == [
        (0, False, "Red is who"), (1, True, "T: Foo is blue"), (2, True, "Who"), (3, True, "U: red"), (4, True, ""),
    ]
    assert {r["answer"] for r in got if r["qid"] == 2} == {""}


@pytest.mark.parametrize("n,expected", [(0, 1), (-3, 1), (1, 1), (3, 3)])
def test_number_of_samples(spark, n, expected):
    got = generate(asked_table(spark), ExtractiveGenerator(), n)
    assert got.where("qid = 1").count() == expected


@pytest.mark.parametrize("form", ["text", "chat"])
def test_model_generator_slot(spark, form):
    def factory():
        def model(requests):
            assert len(requests) <= 2
            return ["  " + json.dumps(r, sort_keys=True) + "\n" for r in requests]

        return model

    generator = ModelGenerator(factory, form, batch=2, max_prompt_tokens=5)
    runs = [
        {(r["qid"], r["sample_idx"]): json.loads(r["answer"]) for r in generate(asked_table(spark), generator, 3, vote=True).collect()}
        for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 6
    assert len({r["seed"] for r in runs[0].values()}) == 6
    for (_, sample), r in runs[0].items():
        assert r["max_new_tokens"] == 48 and r["do_sample"] == (sample > 0)
        assert (r["temperature"], r["top_p"]) == ((0.7, 0.9) if sample else (None, None))
        if form == "text":
            assert r["prompt"] == "You are a question answering"
        else:
            assert r["messages"][0] == {"role": "system", "content": prompt.instruction(True)}
    with pytest.raises(ValueError):
        ModelGenerator(factory, "xml")


def plain_winner(answers, passages):
    keys = [plain_vote(a) for a in answers]
    texts = [" ".join(p.lower().split()) for p in passages]
    usable = [k for k in keys if k and any(k in t for t in texts)]
    if not usable:
        return answers[0]
    top = max(Counter(usable).values())
    best = next(k for k in keys if k in usable and usable.count(k) == top)
    return answers[keys.index(best)]


def test_votes_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["Paris", "the Paris.", "paris", '"Rome"', "rome!", "", "...", "Oslo", "an Oslo", "x  y", "X y", "a"]
    passages = ["in PARIS today", "rome\n and x\ty", "nothing", "oslo oslo"]
    answers, contexts = {}, {}
    for q in range(300):
        answers[q] = [rng.choice(words) for _ in range(rng.randint(1, 7))]
        contexts[q] = rng.sample(passages, rng.randint(0, 3))
    samples = spark.createDataFrame([(q, i, a) for q, l in answers.items() for i, a in enumerate(l)], "qid long, sample_idx int, answer string")
    table = spark.createDataFrame(list(contexts.items()), "qid long, passages array<string>")
    got = {r["qid"]: r["answer"] for r in vote(samples.repartition(5), table).collect()}
    assert got == {q: plain_winner(answers[q], contexts[q]) for q in answers}


def test_vote_literals(spark):
    cases = {
        1: (["Rome", "Paris", "paris"], ["rome and paris"], "Paris", 2, True),
        2: (["Rome", "Paris"], ["rome and paris"], "Rome", 1, True),
        3: (["Rome", "Oslo", "Oslo"], ["in rome"], "Rome", 1, True),
        4: (["Oslo", "Rome", "Rome"], ["nothing"], "Oslo", 0, False),
        5: (["", "..."], ["x"], "", 0, False),
        6: (["", "x"], ["x"], "x", 1, True),
        7: (["one"], [], "one", 0, False),
    }
    samples = [(q, i, a) for q, c in cases.items() for i, a in enumerate(c[0])]
    contexts = [(q, c[1]) for q, c in cases.items()]
    got = vote(
        spark.createDataFrame(samples, "qid long, sample_idx int, answer string"),
        spark.createDataFrame(contexts, "qid long, passages array<string>"),
    )
    assert {r["qid"]: tuple(r)[1:] for r in got.collect()} == {q: c[2:] for q, c in cases.items()}


def test_one_question_with_most_samples(spark):
    """A third of all samples under one question, still a correct vote."""
    hot = spark.range(50_000).select(F.lit(0).alias("qid"), F.col("id").cast("int").alias("sample_idx"), F.when(F.col("id") % 3 == 1, "b").otherwise("a").alias("answer"))
    rest = spark.range(100_000).select((F.col("id") % 5000 + 1).cast("int").alias("qid"), F.floor(F.col("id") / 5000).cast("int").alias("sample_idx"), F.lit("c").alias("answer"))
    samples = hot.unionByName(rest)
    contexts = samples.select("qid").distinct().withColumn("passages", F.array(F.lit("b c")))
    got = {r["qid"]: (r["answer"], r["votes"]) for r in vote(samples, contexts).collect()}
    assert got[0] == ("b", 16667) and got[17] == ("c", 20) and len(got) == 5001


def test_recall_literals(spark):
    questions = spark.createDataFrame(
        [(1, ["cat"], "a"), (2, ["dog"], "a"), (3, [], "b"), (4, [""], "b"), (5, None, "b"), (6, ["x"], "b")],
        "qid long, aliases array<string>, split string",
    )
    ranked = spark.createDataFrame(
        [(1, 1, "no"), (1, 2, "a CAT"), (2, 1, "dog"), (3, 1, "x"), (4, 1, "x"), (5, 1, "x"), (1, 9, "cat")],
        "qid long, rank int, passage string",
    )
    got = {r["k"]: (r["recall"], r["questions"]) for r in metrics.recall_at(ranked, questions, (1, 3)).collect()}
    assert got == {1: (pytest.approx(2 / 6), 6), 3: (pytest.approx(3 / 6), 6)}
    split = {(r["split"], r["k"]): r["recall"] for r in metrics.recall_at(ranked, questions, (1, 3), ["split"]).collect()}
    assert split == {("a", 1): 0.5, ("a", 3): 1.0, ("b", 1): 0.25, ("b", 3): 0.25}
    assert metrics.recall_at(ranked, questions.where("qid > 9"), (1,)).collect() == []


def test_eval_log_and_summary(spark):
    rows = [("q", "gold", ["The Gold", "x"], "gold!", ["p" * 300, "é"]), ("r", "y", [], "z y", [])]
    df = spark.createDataFrame(rows, "question string, gold string, aliases array<string>, predicted string, passages array<string>")
    log = metrics.eval_log(df)
    assert log.columns == schemas.EVAL_LOG.names
    path = staging_path(spark, "test")
    artifacts.write_log(log, path)
    got = {r["question"]: r for r in artifacts.read_log(spark, path).collect()}
    assert got["q"]["aliases"] == ["The Gold", "x", "gold"] and got["q"]["exact_match"] == 1
    assert [len(p) for p in got["q"]["retrieved"]] == [200, 1]
    assert got["r"]["exact_match"] == 0 and got["r"]["f1"] == pytest.approx(2 / 3)
    total = metrics.summarize(log).first()
    assert (total["exact_match"], total["questions"]) == (0.5, 2) and total["f1"] == pytest.approx(5 / 6)


def small_index(spark):
    pages = spark.createDataFrame(
        [(0, 0, "Eye", "Glaucoma affects the eye. It is common."), (1, 0, "Dog", "A dog barks. The eye of a dog.")], schemas.PAGES
    )
    return corpus.build_index(pages, HashingEncoder(64))


def test_answer_end_to_end(spark):
    questions = spark.createDataFrame([(1, "what does glaucoma affect", "the eye", ["eye"])], "qid long, question string, gold string, aliases array<string>")
    for consensus in (False, True):
        got = evaluate.answer(
            questions, small_index(spark), HashingEncoder(64), ExtractiveGenerator(), IdfOverlapScorer(), k=1, consensus=consensus
        ).collect()
        assert len(got) == 1 and got[0]["answer"] == "Eye: Glaucoma affects the eye"
        assert got[0]["passages"] == ["Eye: Glaucoma affects the eye. It is common."]
    log = evaluate.evaluate_answers(questions, small_index(spark), HashingEncoder(64), ExtractiveGenerator(), k=2)
    assert log.first()["f1"] == pytest.approx(2 * (1 / 4) * 1 / (1 / 4 + 1))


def test_consensus_generates_each_sample_once(spark):
    """A sampling model may answer differently each time it is called."""
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def model(requests):
            calls.add(len(requests))
            return ["eye"] * len(requests)

        return model

    questions = spark.createDataFrame([(i, f"glaucoma {i}") for i in range(10)], "qid long, question string")
    got = evaluate.answer(questions, small_index(spark), HashingEncoder(64), ModelGenerator(factory), consensus=True, n_samples=4)
    assert {r["answer"] for r in got.collect()} == {"eye"} and got.count() == 10
    assert calls.value == 40


def test_rerank_comparison_uses_both_orders(spark):
    questions = spark.createDataFrame([(1, "dog barks", ["barks"])], "qid long, question string, aliases array<string>")
    got = evaluate.compare_rerank(questions, small_index(spark), HashingEncoder(64), IdfOverlapScorer(), ks=(1, 2))
    found = {(r["variant"], r["k"]): r["recall"] for r in got.collect()}
    assert set(found) == {(v, k) for v in ("vector", "rerank") for k in (1, 2)}
    assert found["rerank", 1] == 1.0 and found["vector", 2] == 1.0
