"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from passagework.operators.encode import HashingEncoder
from passagework.operators.pages import chunk_pages, dedup_passages
from passagework.operators.rerank import IdfOverlapScorer, retrieve
from passagework import settings
from passagework.operators.search import _dealt, _nested, search
from passagework.operators.vote import vote
from passagework.plans import corpus, evaluate
from passagework.runtime import staged
from workload import inputs, queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def index(spark, sf_dir):
    return corpus.build_index(inputs.pages(spark, sf_dir), HashingEncoder(64))


def test_index_rows_are_found_by_id(spark, index):
    text = plan(index.where("passage_id = 3"))
    assert "EqualTo(passage_id,3)" in text and "Exchange" not in text and "Join" not in text
    assert index.where("passage_id = 3").count() == 1


def checked(text):
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", text):
        assert not spec.strip().startswith(("orderBy", "specified")), spec
    return text


def test_dedup_is_a_hash_aggregate_with_partials(spark, sf_dir):
    text = checked(plan(dedup_passages(chunk_pages(inputs.pages(spark, sf_dir)))))
    assert "SortAggregate" not in text and "partial_min" in text


def test_retrieval_never_shuffles_the_corpus_for_few_hits(spark, sf_dir, index):
    questions = inputs.questions(spark, sf_dir)
    text = checked(plan(retrieve(questions, index, HashingEncoder(64), IdfOverlapScorer())))
    assert "WindowGroupLimit" in text
    # The passages are streamed past the broadcast hits.
    assert re.search(r"BroadcastHashJoin \[passage_id", text), text


def test_search_scans_the_index_once_for_all_blocks(spark, index):
    """Twenty blocks of questions, one scan of two columns, nothing broadcast."""
    asked = staged(index.select(F.col("passage_id").alias("qid"), "embedding"), "asked")
    block = asked.count() // 20
    dealt = _dealt(asked, index, 8, ())
    hits = dealt.mapInArrow(lambda batches: _nested(batches, 5, block), "part int, qid long, passage_id long, score double")
    text = plan(hits)
    scans = re.findall(r"FileScan parquet.*", text)
    assert len(scans) == 2 and "Broadcast" not in text
    assert sum("passage_id" in s for s in scans) == 1 and "passage:string" not in text


def test_weights_come_from_the_table_of_frequencies(spark, sf_dir, index):
    """The passages are read to be shown and compared, and not once more to count their words."""
    questions = inputs.questions(spark, sf_dir)
    text = plan(retrieve(questions, index, HashingEncoder(64), IdfOverlapScorer.on(index)))
    reads = [s for s in re.findall(r"FileScan parquet.*", text) if "passage:string" in s]
    assert len(reads) == 1 and "df:bigint" in text


def test_runs_share_every_step(spark, sf_dir):
    """A sweep plans one search result, one ranking and one aggregation, however many runs there are."""
    chunkings = [settings.Chunking(40, 10), settings.Chunking(60, 20), settings.Chunking(80, 30)]
    index = corpus.sweep_index(inputs.pages(spark, sf_dir), chunkings, HashingEncoder(64))
    text = checked(plan(evaluate.recall_per_run(
        inputs.questions(spark, sf_dir), index, chunkings, HashingEncoder(64), IdfOverlapScorer())))
    assert "Union" not in text
    assert len([s for s in re.findall(r"FileScan parquet.*", text) if "passage:string" in s]) == 1


def test_vote_has_no_window_and_two_partial_aggregates(spark, sf_dir):
    text = checked(plan(vote(*queries._votes(spark, sf_dir))))
    assert "Window" not in text and text.count("partial_") >= 2


def test_recall_plan(spark, sf_dir, index):
    text = checked(plan(evaluate.evaluate_recall(inputs.questions(spark, sf_dir), index, HashingEncoder(64), None)))
    assert "partial_avg" in text


def test_hits_are_a_table_with_a_known_size(spark, index):
    vectors = index.select(F.col("passage_id").alias("qid"), "embedding")
    assert "FileScan parquet" in plan(search(vectors, index, 2))


@pytest.mark.parametrize("name", ["top_labels", "common_answers", "sample_qa", "head_sample"])
def test_top_n_without_global_sort(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in checked(plan(queries.QUERIES[name](spark, sf_dir)))
