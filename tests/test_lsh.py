"""Approximate search against the exact one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagework.operators.encode import HashingEncoder
from passagework.operators import lsh
from passagework.operators.lsh import ProjectionTables, recall_against
from passagework.operators.search import search
from passagework.plans import corpus
from workload import inputs, queries


@pytest.fixture(scope="module")
def index(spark, sf_dir):
    return corpus.build_index(inputs.pages(spark, sf_dir), HashingEncoder())


def test_recall_on_the_corpus(spark, index):
    tables = ProjectionTables()
    asked = index.where("passage_id % 50 = 0").select(F.col("passage_id").alias("qid"), "embedding")
    found = tables.search(asked, tables.index(index), 10)
    exact = search(asked, index, 10)
    row = recall_against(found, exact).first()
    assert row["pairs"] == exact.count() and row["recall"] >= 0.9
    # What is found is scored exactly.
    both = found.alias("f").join(exact.alias("e"), ["qid", "passage_id"]).select(F.max(F.abs(F.col("f.score") - F.col("e.score"))).alias("d"))
    assert both.first()["d"] < 1e-12
    ranks = found.groupBy("qid").agg(F.max("rank").alias("m"), F.count("*").alias("n")).where("m <> n or n > 10")
    assert ranks.count() == 0


def test_few_pairs_are_compared_where_neighbours_are_near(spark):
    """Clusters of near vectors: all neighbours are found among few candidates."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 32))
    vectors = np.repeat(centres, 5, axis=0) + rng.normal(size=(300, 32)) * 0.05
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    index = spark.createDataFrame(rows, "passage_id long, embedding array<float>")
    asked = index.where("passage_id % 7 = 0").withColumnRenamed("passage_id", "qid")
    tables = ProjectionTables(tables=12, per_table=8)
    stored = tables.index(index)
    assert recall_against(tables.search(asked, stored, 5), search(asked, index, 5)).first()["recall"] >= 0.98
    assert tables.search(asked, stored, 300).count() < 0.35 * asked.count() * 300


def test_equal_vectors_share_all_buckets(spark):
    index = spark.createDataFrame([(1, [0.6, 0.8]), (2, [0.6, 0.8]), (3, None), (4, [])], "passage_id long, embedding array<float>")
    tables = ProjectionTables(tables=3, per_table=2)
    stored = {r["passage_id"]: r["buckets"] for r in tables.index(index).collect()}
    assert set(stored) == {1, 2} and stored[1] == stored[2] and len(stored[1]) == 3
    asked = index.withColumnRenamed("passage_id", "qid")
    got = {(r["qid"], r["passage_id"], r["rank"]) for r in tables.search(asked, tables.index(index), 2).collect()}
    assert got == {(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2)}
    assert tables.search(asked.where("false"), tables.index(index), 2).collect() == []
    assert tables.search(asked, tables.index(index.where("false")), 2).collect() == []


def test_registered_recall(spark, sf_dir):
    rows = queries.QUERIES["topk_lsh"](spark, sf_dir).collect()
    assert {r["qid"] % 50 for r in rows} == {0}
    assert min(r["rank"] for r in rows) == 1 and max(r["rank"] for r in rows) == 10


def test_pairs_are_not_shuffled(spark, index):
    """vectors meet in tasks that hold a slice of the index; what leaves them are the best of each question."""
    tables = ProjectionTables()
    small = index.select("passage_id", "embedding")
    asked = small.where("passage_id % 50 = 0").withColumnRenamed("passage_id", "qid")
    found = tables.search(asked, tables.index(small), 10)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Aggregate" not in text and "WindowGroupLimit" in text


@pytest.mark.parametrize("cells", [1, 50, 4_000_000])
def test_found_are_all_that_share_a_probed_bucket(spark, monkeypatch, cells):
    """plain loops over bucket names find the same passages, in the same order."""
    monkeypatch.setattr(lsh, "_CELLS", cells)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(90, 8)).round(1).astype(np.float32)
    vectors[40:60] = vectors[:20]
    vectors[7] = 0
    index = spark.createDataFrame([(i * 3, [float(x) for x in v]) for i, v in enumerate(vectors)], "passage_id long, embedding array<float>")
    tables = ProjectionTables(tables=4, per_table=3)
    stored = tables.index(index)
    asked = index.where("passage_id % 2 = 0").withColumnRenamed("passage_id", "qid")
    names = {r["passage_id"]: set(r["buckets"]) for r in stored.collect()}
    exact = {r["passage_id"]: np.array(r["embedding"]) for r in index.collect()}
    want = set()
    for r in tables._steps(asked).collect():
        probes = set(tables._probes(np.array(r["_steps"]).reshape(1, 4, 3)).ravel().tolist())
        hit = [p for p in names if names[p] & probes]
        scored = [(-float(sum(np.array(r["embedding"])[i] * exact[p][i] for i in range(8))), p) for p in hit]
        want |= {(r["qid"], p, rank) for rank, (_, p) in enumerate(sorted(scored)[:5], 1)}
    got = {(r["qid"], r["passage_id"], r["rank"]) for r in tables.search(asked, stored, 5).collect()}
    assert got == want and len(want) > 150
