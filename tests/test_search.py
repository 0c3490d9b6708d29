"""Exact search, reranking and the plans behind them."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagework.functions import text as tx
from passagework.functions.vectors import inner_product
from passagework.operators.encode import HashingEncoder
from passagework.operators.rerank import (
    IdfOverlapScorer,
    PairScorer,
    fetch_passages,
    rerank,
    retrieve,
    word_frequencies,
)
from passagework.operators.search import _products, search

VECTORS = "array<float>"


def table(spark, key, matrix, partitions=4):
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} long, embedding {VECTORS}").repartition(partitions)


def brute(questions, vectors, n):
    """Scores whose sums are exact: math.fsum rounds once."""
    scores = np.array([[math.fsum(float(a) * float(b) for a, b in zip(q, v)) for v in vectors] for q in questions])
    out = set()
    for q, row in enumerate(scores):
        order = np.lexsort((np.arange(len(row)), -row))[:n]
        out |= {(q, int(i), float(row[i]), r + 1) for r, i in enumerate(order)}
    return out


def rows_of(df):
    return {(r["qid"], r["passage_id"], r["score"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("n,block", [(10, None), (10, 3), (3, 16), (1, None), (400, 16)])
def test_search_equals_brute_force(spark, n, block):
    rng = np.random.default_rng(5)
    questions = rng.normal(size=(40, 12)).astype(np.float32)
    vectors = rng.normal(size=(300, 12)).astype(np.float32)
    got = search(table(spark, "qid", questions), table(spark, "passage_id", vectors, 7), n, block)
    assert rows_of(got) == brute(questions, vectors, n)


def test_blocks_follow_the_byte_limit(spark, monkeypatch):
    from passagework.operators import search as module

    monkeypatch.setattr(module, "BLOCK_BYTES", 4 * 8 * 9)
    rng = np.random.default_rng(7)
    questions, vectors = (rng.normal(size=(n, 8)).astype(np.float32) for n in (40, 60))
    asked = table(spark, "qid", questions)
    assert module.block_rows(4, 8) == 9
    assert rows_of(search(asked, table(spark, "passage_id", vectors), 4)) == brute(questions, vectors, 4)


def test_slices_follow_the_byte_limit(spark, monkeypatch):
    from passagework.operators import search as module

    rng = np.random.default_rng(17)
    questions, vectors = (rng.normal(size=(n, 8)).astype(np.float32) for n in (30, 200))
    index = table(spark, "passage_id", vectors)
    assert module.index_slices(index) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(module, "SLICE_BYTES", 4 * 8 * 10)
    assert module.index_slices(index) == 20
    assert rows_of(search(table(spark, "qid", questions), index, 7, rows=4)) == brute(questions, vectors, 7)


def test_runs_are_searched_together(spark):
    rng = np.random.default_rng(19)
    questions = rng.normal(size=(12, 6)).astype(np.float32)
    corpora = {run: rng.normal(size=(20 * run, 6)).astype(np.float32) for run in (1, 2, 4)}
    rows = [(run, i, [float(x) for x in v]) for run, m in corpora.items() for i, v in enumerate(m)]
    index = spark.createDataFrame(rows, f"run int, passage_id long, embedding {VECTORS}")
    got = search(table(spark, "qid", questions), index, 25, runs=[4, 2, 3])
    for run in (4, 2):
        assert rows_of(got.where(F.col("run") == run)) == brute(questions, corpora[run], 25)
    assert {r["run"] for r in got.select("run").distinct().collect()} == {2, 4}


def test_near_ties_are_ranked_in_double(spark):
    """Scores that float32 sums cannot tell apart, at length 768."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=768)
    vectors = np.stack([base + rng.normal(size=768) * 1e-6 for _ in range(100)])
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    questions = np.concatenate([vectors[:5], -vectors[:5], 1000 * vectors[:5]])
    got = search(table(spark, "qid", questions), table(spark, "passage_id", vectors, 3), 20)
    assert rows_of(got) == brute(questions, vectors, 20)


def test_ties_and_zero_vectors(spark):
    questions = np.array([[1, 0], [0, 0]], dtype=np.float32)
    vectors = np.array([[1, 0]] * 50 + [[0, 0]] * 50 + [[-1, 0]] * 5, dtype=np.float32)
    got = search(table(spark, "qid", questions), table(spark, "passage_id", vectors, 9), 60)
    assert rows_of(got) == brute(questions, vectors, 60)


def test_short_and_long_vectors_are_ranked_in_full(spark):
    questions = np.array([[1e-5, 0], [3e6, 1e-3]], dtype=np.float32)
    vectors = np.array([[1e-4, 0], [2e-4, 0], [3e-4, 0], [1e7, 1], [1e-30, 1e-30]], dtype=np.float32)
    got = search(table(spark, "qid", questions), table(spark, "passage_id", vectors, 2), 3)
    assert rows_of(got) == brute(questions, vectors, 3)


def test_equal_scores_tie_in_whichever_components():
    rng = np.random.default_rng(3)
    left, right = rng.normal(size=(2, 200, 64)).astype(np.float32)
    order = rng.permutation(64)
    assert (_products(left, right) == _products(left[:, order], right[:, order])).all()


def test_task_memory_at_many_places():
    """A block of the size chosen for n = 1000 stays below 200 MB."""
    from passagework.operators import search as module

    rng = np.random.default_rng(4)
    rows = module.block_rows(1000, 64)
    questions, vectors = (rng.normal(size=(n, 64)).astype(np.float32) for n in (rows, 20_000))
    tracemalloc.start()
    best = module._Best(questions, 1000, np.full(rows, -np.inf))
    best.add(np.arange(len(vectors)), vectors)
    found = best.result()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(found[0]) == rows * 1000 and peak < 200e6


def test_small_tiles_keep_a_running_best(spark, monkeypatch):
    from passagework.operators import search as module

    monkeypatch.setattr(module, "_TILE_CELLS", 200)
    rng = np.random.default_rng(6)
    questions = rng.integers(-2, 3, size=(20, 4)).astype(np.float32)
    vectors = rng.integers(-2, 3, size=(500, 4)).astype(np.float32)
    best = module._Best(questions, 5, np.full(20, -np.inf))
    best.room = 150
    for start in range(0, 500, 90):
        best.add(np.arange(start, min(start + 90, 500)), vectors[start : start + 90])
    q, ids, scores = best.result()
    expected = {(a, b, c) for a, b, c, _ in brute(questions, vectors, 5)}
    assert set(zip(q.tolist(), ids.tolist(), scores.tolist())) == expected


def test_empty_sides(spark):
    one = table(spark, "passage_id", np.ones((3, 2), dtype=np.float32))
    none = table(spark, "qid", np.ones((2, 2), dtype=np.float32)).where("qid < 0")
    assert search(none, one, 5).collect() == []
    asked = table(spark, "qid", np.ones((2, 2), dtype=np.float32))
    assert search(asked, one.where("passage_id < 0"), 5).collect() == []


def test_matrix_search_equals_sql_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asked = vectors.select(F.col("vec_id").alias("qid"), "embedding")
    index = vectors.select(F.col("vec_id").alias("passage_id"), "embedding")
    got = search(asked, index, 5).alias("h")
    joined = got.join(asked.withColumnRenamed("embedding", "q"), "qid").join(
        index.withColumnRenamed("embedding", "p"), "passage_id"
    )
    off = joined.where(F.abs(F.col("score") - inner_product(F.col("q"), F.col("p"))) > 1e-7)
    assert off.count() == 0


def pairs(spark):
    rows = [
        (1, 10, 0.9, 1, "red cat", "t: a dog"),
        (1, 11, 0.8, 2, "red cat", "t: red cat here"),
        (1, 12, 0.7, 3, "red cat", "t: cat, cat"),
        (1, 13, 0.6, 4, "red cat", "t: the CAT"),
        (2, 10, 0.5, 1, "zzz", "t: a dog"),
    ]
    return spark.createDataFrame(rows, "qid long, passage_id long, score double, rank int, question string, passage string")


def test_rerank_breaks_ties_by_candidate_rank(spark):
    df = pairs(spark)
    questions = df.select("qid", "question").distinct()
    passages = df.select("passage_id", "passage").distinct()
    got = rerank(df, questions, passages, IdfOverlapScorer(), 3).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["passage_id"], r["candidate_rank"]) for r in got] == [
        (1, 11, 2), (1, 12, 3), (1, 13, 4), (2, 10, 1),
    ]
    assert got[0]["rerank_score"] == round((np.log(1 + 4 / 1) + np.log(1 + 4 / 3)) * 1e6) / 1e6 or got[0][
        "rerank_score"
    ] == pytest.approx(np.log(5) + np.log(1 + 4 / 3), abs=2e-6)
    assert got[3]["rerank_score"] == 0.0


def test_without_scorer_the_vector_order_stays(spark):
    got = rerank(pairs(spark), None, None, None, 2).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["passage_id"]) for r in got] == [(1, 10), (1, 11), (2, 10)]
    assert all(r["rerank_score"] is None for r in got)


def test_model_scorer_slot(spark):
    def factory():
        def score(batch):
            assert len(batch) <= 2
            return [len(p) - len(q) for q, p in batch]

        return score

    got = rerank(pairs(spark), None, None, PairScorer(factory, 3, batch=2), 1).collect()
    assert {(r["qid"], r["passage_id"], r["rerank_score"]) for r in got} == {(1, 11, 8.0), (2, 10, 5.0)}


def test_retrieve_returns_fewer_rows_than_k(spark):
    from passagework.operators.encode import encode

    passages = spark.createDataFrame([(0, "t: red cat"), (1, "t: blue dog")], "passage_id long, passage string")
    index = encode(passages, "passage", HashingEncoder(64))
    questions = spark.createDataFrame([(5, "red cat")], "qid long, question string")
    got = retrieve(questions, index, HashingEncoder(64), IdfOverlapScorer(), 1, 3).collect()
    assert [(r["qid"], r["passage_id"], r["rank"]) for r in got] == [(5, 0, 1)]
    got = retrieve(questions, index, HashingEncoder(64), None, 100, 10).orderBy("rank").collect()
    assert [r["passage_id"] for r in got] == [0, 1]


def test_fetch_keeps_only_real_rows(spark):
    hits = spark.createDataFrame([(1, 7, 0.5, 1), (1, 99, 0.4, 2)], "qid long, passage_id long, score double, rank int")
    passages = spark.createDataFrame([(7, "x")], "passage_id long, passage string")
    assert [r["passage"] for r in fetch_passages(hits, passages).collect()] == ["x"]


def test_words_are_counted_per_batch_and_not_exploded(spark):
    """a row per word of every passage takes longer than all else; a task counts the words of a batch."""
    texts = ["One two, two", "é中 two\tİx", None, "", "..", "three-one"] * 700
    rows = [(i, None if i % 5 == 0 else i % 2, t) for i, t in enumerate(texts)]
    passages = spark.createDataFrame(rows, "passage_id long, run int, passage string").repartition(3)
    found = word_frequencies(passages, "run")
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    words = passages.where("passage is not null").select("run", "passage_id", F.explode(F.concat(tx.words(F.col("passage")), F.array(F.lit(None).cast("string")))).alias("word"))
    plain = words.groupBy("run", "word").agg(F.countDistinct("passage_id").alias("df"))
    got = {tuple(r) for r in found.collect()}
    assert got == {tuple(r) for r in plain.collect()} and len(got) == 15
    assert {tuple(r) for r in word_frequencies(passages).where("word is null").collect()} == {(None, 3500)}
    assert word_frequencies(passages.where("passage is null"), "run").collect() == []
