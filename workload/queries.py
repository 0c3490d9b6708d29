"""Every operator as a query over whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from passagework import settings
from passagework.functions import answers as an, text as tx
from passagework.functions.vectors import l2_normalize
from passagework.operators import metrics, profile, prompt
from passagework.operators.encode import BatchEncoder, HashingEncoder, encode
from passagework.operators.generate import ExtractiveGenerator, ModelGenerator, generate
from passagework.operators.numbering import assign_positions
from passagework.operators.pages import (
    chunk_pages,
    dedup_passages,
    unnest_pages,
    unpack_order,
)
from passagework.operators.lsh import ProjectionTables
from passagework.operators.rerank import IdfOverlapScorer, PairScorer, retrieve
from passagework.operators.search import search
from passagework.operators.vote import vote
from passagework.plans import corpus, evaluate
from passagework.runtime import staging_path
from passagework.sources import artifacts, examples as ex
from passagework.streaming.ingest import ingest_passages, read_landing, stream_shards

from . import inputs, models

ENCODER = HashingEncoder(256)
GENERATOR = ExtractiveGenerator()
VALIDATION_ROWS = 300
SHARD_ROWS = 50
SWEEP = [settings.Chunking(*s) for s in settings.SWEEP]


def _passages(spark, sf_dir):
    return corpus.build_passages(inputs.pages(spark, sf_dir))


def _index(spark, sf_dir):
    return corpus.build_index(inputs.pages(spark, sf_dir), ENCODER)


def _scored_index(spark, sf_dir):
    """Index, encoder and the scorer with the index's word frequencies."""
    index = _index(spark, sf_dir)
    return index, ENCODER, IdfOverlapScorer.on(index)


def _six(column):
    return F.round(column, 6)


# Corpus ---------------------------------------------------------------------


def unnest(spark, sf_dir):
    return unnest_pages(inputs.examples(spark, sf_dir))


def chunks(spark, sf_dir):
    return chunk_pages(inputs.pages(spark, sf_dir)).select(
        F.col("example_ord").alias("doc_id"), "chunk_pos", "passage"
    )


def dedup(spark, sf_dir):
    kept = dedup_passages(chunk_pages(inputs.pages(spark, sf_dir)))
    return kept.withColumn("o", unpack_order(F.col("corpus_order"))).select(
        F.col("o.example_ord").alias("doc_id"), "o.chunk_pos", "copies", "passage"
    )


def passage_ids(spark, sf_dir):
    return _passages(spark, sf_dir)


def _components(vectors):
    return (
        vectors.select("passage_id", F.posexplode("embedding").alias("bucket", "value"))
        .where(F.col("value") != 0)
        .select("passage_id", "bucket", _six(F.col("value").cast("double")).alias("value"))
    )


def hash_embed(spark, sf_dir):
    return _components(encode(_passages(spark, sf_dir), "passage", ENCODER))


def model_encoder(spark, sf_dir):
    vectors = encode(_passages(spark, sf_dir), "passage", BatchEncoder(models.letter_encoder, 33))
    return vectors.select("passage_id", F.posexplode("embedding").alias("pos", "value")).select(
        "passage_id", "pos", _six(F.col("value").cast("double")).alias("value")
    )


def model_tokens(spark, sf_dir):
    """Chunks of 240 code points, cut and put together by a model's tokenizer."""
    tokenizer = tx.model_tokenizer(models.character_tokenizer, "characters")
    return chunk_pages(inputs.pages(spark, sf_dir), tokenizer=tokenizer).select(
        F.col("example_ord").alias("doc_id"), "chunk_pos", "passage"
    )


def unit_vectors(spark, sf_dir):
    scaled = inputs.embeddings(spark, sf_dir).withColumn(
        "embedding", F.transform("embedding", lambda x: (x * F.col("label")).cast("float"))
    )
    return scaled.select(
        F.col("passage_id").alias("vec_id"),
        F.posexplode(l2_normalize(F.col("embedding"))).alias("pos", "value"),
    ).withColumn("value", _six(F.col("value").cast("double")))


def index_reuse(spark, sf_dir):
    """The index is built under a path, then read back by a second call."""
    root = staging_path(spark, "artifacts")
    pages = inputs.pages(spark, sf_dir)
    corpus.ensure_index(pages, ENCODER, root, "hash256")
    return _components(corpus.ensure_index(pages, ENCODER, root, "hash256"))


def index_two_encoders(spark, sf_dir):
    """Passages made anew through one encoder's call renew the index of the other."""
    root = staging_path(spark, "artifacts")
    pages = inputs.pages(spark, sf_dir)
    retitled = pages.withColumn("title", F.lit("renamed"))
    other = HashingEncoder(16)
    corpus.ensure_index(pages, ENCODER, root, "hash256")
    corpus.ensure_index(pages, other, root, "hash16")
    corpus.ensure_index(retitled, other, root, "hash16", recompute_passages=True)
    return _components(corpus.ensure_index(retitled, ENCODER, root, "hash256"))


def index_two_tokenizers(spark, sf_dir):
    """Each tokenizer has its own passages under the same root."""
    root = staging_path(spark, "artifacts")
    pages = inputs.pages(spark, sf_dir)
    characters = tx.model_tokenizer(models.character_tokenizer, "characters")
    corpus.ensure_index(pages, ENCODER, root, "hash256", tokenizer=characters)
    return corpus.ensure_index(pages, ENCODER, root, "hash256").select("passage_id", "passage")


# Search ---------------------------------------------------------------------


def _rounded(hits, digits=7):
    """Ranks follow from unrounded scores; only what is shown is rounded."""
    return hits.withColumn("score", F.round("score", digits))


def nearest(spark, sf_dir):
    vectors = inputs.embeddings(spark, sf_dir)
    return _rounded(search(vectors.withColumnRenamed("passage_id", "qid"), vectors, 10))


def nearest_blocks(spark, sf_dir):
    """The same search in more blocks of questions than one job takes."""
    vectors = inputs.embeddings(spark, sf_dir)
    asked = vectors.withColumnRenamed("passage_id", "qid")
    return _rounded(search(asked, vectors, 10, rows=50))


def nearest_scaled(spark, sf_dir):
    """Vectors far from unit length on both sides."""
    vectors = inputs.embeddings(spark, sf_dir)

    def times(factor):
        return F.transform("embedding", lambda x: (x.cast("double") * factor).cast("float"))

    asked = vectors.select(F.col("passage_id").alias("qid"), times(F.lit(1e-3)).alias("embedding"))
    index = vectors.select("passage_id", times(F.col("label")).alias("embedding"))
    return _rounded(search(asked, index, 10), 9)


def nearest_centroids(spark, sf_dir):
    """More places than vectors: the label centroids are the whole index."""
    vectors = inputs.embeddings(spark, sf_dir)
    means = (
        vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).cast("float").alias("x"))
    )
    # One entry per dimension, so a list cannot outgrow the vector length.
    centroids = means.groupBy(F.col("label").cast("bigint").alias("passage_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias(
            "embedding"
        )
    )
    return _rounded(search(vectors.withColumnRenamed("passage_id", "qid"), centroids, 100))


def nearest_by_tables(spark, sf_dir):
    """Approximate search: every 50th passage against all passages."""
    tables, index = ProjectionTables(), _index(spark, sf_dir).select("passage_id", "embedding")
    asked = index.where(F.col("passage_id") % 50 == 0).select(F.col("passage_id").alias("qid"), "embedding")
    return _rounded(tables.search(asked, tables.index(index), 10)).select("qid", "passage_id", "score", "rank")


def retrieved(spark, sf_dir):
    found = retrieve(inputs.questions(spark, sf_dir), *_scored_index(spark, sf_dir))
    return _rounded(found).select(
        "qid", "rank", "candidate_rank", "passage_id", "score", "rerank_score"
    )


def model_scorer(spark, sf_dir):
    found = retrieve(
        inputs.questions(spark, sf_dir), _index(spark, sf_dir), ENCODER,
        PairScorer(models.length_scorer, batch=7), 100, None,
    )
    return found.select("qid", "candidate_rank", "rank", "rerank_score")


def retrieved_by_vector(spark, sf_dir):
    found = retrieve(
        inputs.questions(spark, sf_dir), _index(spark, sf_dir), ENCODER, None, 100, 10
    )
    return _rounded(found).select("qid", "rank", "passage_id", "score", "passage")


def reranked_candidates(spark, sf_dir):
    found = retrieve(
        inputs.questions(spark, sf_dir), *_scored_index(spark, sf_dir), 50, None
    )
    return found.select("qid", "candidate_rank", "rank", "rerank_score")


# Scores ---------------------------------------------------------------------


def recall_at_k(spark, sf_dir):
    return evaluate.evaluate_recall(
        inputs.questions(spark, sf_dir), *_scored_index(spark, sf_dir)
    ).select("k", _six("recall").alias("recall"), "questions")


def recall_by_split(spark, sf_dir):
    asked = ex.split_by_position(inputs.questions(spark, sf_dir), ["qid"], 15)
    return evaluate.evaluate_recall(
        asked, *_scored_index(spark, sf_dir), by=["split"]
    ).select("split", "k", _six("recall").alias("recall"), "questions")


def recall_with_without_rerank(spark, sf_dir):
    return evaluate.compare_rerank(
        inputs.questions(spark, sf_dir), *_scored_index(spark, sf_dir)
    ).select("variant", "k", _six("recall").alias("recall"), "questions")


def chunk_sweep(spark, sf_dir):
    return evaluate.sweep_recall(
        inputs.questions(spark, sf_dir), inputs.pages(spark, sf_dir), SWEEP, ENCODER, IdfOverlapScorer()
    ).select(
        "run", "chunk_tokens", "chunk_overlap", "passages", "k",
        _six("recall").alias("recall"), "questions",
    )


def sweep_passages(spark, sf_dir):
    return corpus.sweep_passages(inputs.pages(spark, sf_dir), SWEEP)


def normalize_answer(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id", tx.normalize_answer(F.col("text")).alias("normalized")
    )


def normalize_vote(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id",
        F.posexplode(F.transform(F.split("text", "\n"), tx.normalize_vote)).alias("line", "norm"),
    )


def exact_match(spark, sf_dir):
    return inputs.answer_pairs(spark, sf_dir).select(
        "conv_id", "turn",
        an.exact_match(F.col("predicted"), F.col("gold")).alias("same"),
        an.exact_match(F.col("gold"), F.concat(F.lit("The "), F.col("gold"), F.lit("?!"))).alias("variant"),
    )


def token_f1(spark, sf_dir):
    return inputs.answer_pairs(spark, sf_dir).select(
        "conv_id", "turn", _six(an.token_f1(F.col("predicted"), F.col("gold"))).alias("f1")
    )


def best_of_aliases(spark, sf_dir):
    golds = inputs.answer_pairs(spark, sf_dir).withColumn(
        "golds", F.concat("aliases", F.array("gold"))
    )
    return metrics.score_answers(golds).select(
        "conv_id", "turn", "exact_match", _six("f1").alias("f1")
    )


def _evaluated(spark, sf_dir, **options):
    index, _, scorer = _scored_index(spark, sf_dir)
    return evaluate.evaluate_answers(
        inputs.questions(spark, sf_dir), index, ENCODER, GENERATOR, scorer,
        k=3, **options,
    )


def eval_log(spark, sf_dir):
    """Log rows written as JSON lines and read back."""
    path = staging_path(spark, "log")
    artifacts.write_log(_evaluated(spark, sf_dir).drop("qid"), path)
    return artifacts.read_log(spark, path).select(
        "question", "gold", "predicted", "exact_match", _six("f1").alias("f1"),
        F.to_json("aliases").alias("aliases"),
        F.array_join("retrieved", "|").alias("retrieved"),
    )


def rag_eval(spark, sf_dir):
    summary = metrics.summarize(_evaluated(spark, sf_dir))
    return summary.select(
        _six("exact_match").alias("exact_match"), _six("f1").alias("f1"), "questions"
    )


def rag_eval_consensus(spark, sf_dir):
    summary = metrics.summarize(_evaluated(spark, sf_dir, consensus=True, n_samples=3))
    return summary.select(
        _six("exact_match").alias("exact_match"), _six("f1").alias("f1"), "questions"
    )


# Prompts, answers, votes ----------------------------------------------------


def _asked(spark, sf_dir, k):
    questions = inputs.questions(spark, sf_dir)
    ranked = retrieve(questions, *_scored_index(spark, sf_dir), k=k)
    return prompt.with_passages(questions, ranked)


def context_block(spark, sf_dir):
    return _asked(spark, sf_dir, 5).select(
        "qid", prompt.context_block(F.col("passages")).alias("context")
    )


def prompt_text(spark, sf_dir):
    question, passages = F.col("question"), F.col("passages")
    return _asked(spark, sf_dir, 12).select(
        "qid",
        prompt.text_prompt(question, passages).alias("prompt"),
        prompt.text_prompt(question, passages, vote=True).alias("vote_prompt"),
    )


def chat_messages(spark, sf_dir):
    messages = prompt.chat_messages(F.col("question"), F.col("passages"))
    return _asked(spark, sf_dir, 5).select(
        "qid", F.posexplode(messages).alias("pos", "message")
    ).select("qid", "pos", "message.role", "message.content")


def generate_extractive(spark, sf_dir):
    return generate(_asked(spark, sf_dir, 5), GENERATOR, 3, vote=True).select(
        "qid", "sample_idx", "do_sample", "answer"
    )


def model_answers_text(spark, sf_dir):
    """A text model whose prompts are cut by its own tokens."""
    tokenizer = tx.model_tokenizer(models.character_tokenizer, "characters")
    model = ModelGenerator(models.prompt_reader, batch=5, tokenizer=tokenizer)
    return generate(_asked(spark, sf_dir, 5), model, 2, vote=True).select(
        "qid", "sample_idx", "do_sample", "answer"
    )


def model_answers_chat(spark, sf_dir):
    model = ModelGenerator(models.message_reader, form="chat", batch=5)
    return generate(_asked(spark, sf_dir, 5), model).select("qid", "sample_idx", "do_sample", "answer")


def answer_consensus(spark, sf_dir):
    index, _, scorer = _scored_index(spark, sf_dir)
    return evaluate.answer(
        inputs.questions(spark, sf_dir), index, ENCODER, GENERATOR, scorer,
        consensus=True, n_samples=5,
    ).select("qid", "answer")


def _votes(spark, sf_dir):
    """Words of an assistant turn as sampled answers, the user turn as context."""
    pairs = inputs.answer_pairs(spark, sf_dir).withColumn(
        "qid", F.col("conv_id") * 1_000_000 + F.col("turn")
    )
    samples = pairs.select("qid", F.posexplode(tx.tokens(F.col("gold"))).alias("sample_idx", "answer"))
    return samples, pairs.select("qid", F.array("predicted").alias("passages"))


def vote_consensus(spark, sf_dir):
    return vote(*_votes(spark, sf_dir))


def answer_in_context(spark, sf_dir):
    samples, contexts = _votes(spark, sf_dir)
    norm = tx.normalize_vote(F.col("answer"))
    return samples.join(contexts, "qid").select(
        "qid", "sample_idx", an.grounded(norm, F.col("passages")).alias("in_context")
    )


# Splits and shards ----------------------------------------------------------


_SHARD_COLUMNS = ("split", "shard", "pos", "ord", "lang", "source", "text")


def _rows_to_shard(spark, sf_dir):
    """Whole documents, and those with a label, which stand in as test split."""
    documents = inputs.documents(spark, sf_dir).withColumnRenamed("doc_id", "ord")
    labelled = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"))
    return documents, documents.join(labelled, "ord")


def _sharded(spark, sf_dir, path=None):
    path = path or staging_path(spark, "shards")
    return ex.ensure_shards(
        spark, path, *_rows_to_shard(spark, sf_dir), ["ord"], VALIDATION_ROWS, SHARD_ROWS
    )


def split_shards(spark, sf_dir):
    return _sharded(spark, sf_dir).select(*_SHARD_COLUMNS)


def shards_resume(spark, sf_dir):
    """A run that ended while it wrote: its rows count for nothing, and all splits get written."""
    path = staging_path(spark, "shards")
    documents, _ = _rows_to_shard(spark, sf_dir)
    ex.write_shards(ex.split_by_position(documents, ["ord"], 10), path, 7)
    return _sharded(spark, sf_dir, path).select(*_SHARD_COLUMNS)


def source_order(spark, sf_dir):
    """Places of all rows in source order, which nobody tells the size of the shards."""
    placed = assign_positions(ex.in_source_order(_sharded(spark, sf_dir)), ["ord"], "place")
    return placed.select("split", "shard", "pos", "place")


def read_examples(spark, sf_dir):
    """Examples back from JSON lines, one in seven of which has lost its end."""
    path = staging_path(spark, "json")
    rows = inputs.examples(spark, sf_dir)
    line = F.to_json(F.struct(*rows.columns))
    cut = F.when(F.col("ord") % 7 == 0, F.left(line, F.length(line) - 1)).otherwise(line)
    rows.select(cut.alias("value")).write.option("compression", "gzip").text(path)
    examples, damaged = ex.read_json_examples(spark, path)
    return examples.select(
        "ord", "question", F.col("answer.value").alias("value"), F.size("answer.aliases").alias("aliases"),
        F.size("entity_pages.title").alias("titles"),
        damaged.agg(F.count(F.lit(1))).scalar().alias("damaged_lines"),
    )


def head_sample(spark, sf_dir):
    train = ex.read_shards(spark, _written(spark, sf_dir), ["train"])
    return ex.head(train, settings.EVAL_ROWS).select(*_SHARD_COLUMNS)


def _written(spark, sf_dir):
    path = staging_path(spark, "shards")
    documents, _ = _rows_to_shard(spark, sf_dir)
    ex.write_shards(ex.split_by_position(documents, ["ord"], 100), path, 20)
    return path


def head_per_split(spark, sf_dir):
    path = staging_path(spark, "shards")
    sharded = _sharded(spark, sf_dir, path)
    return ex.head_per_split(sharded, settings.EVAL_ROWS, ex.read_catalogue(spark, path)).select(*_SHARD_COLUMNS)


def shard_limit(spark, sf_dir):
    path = staging_path(spark, "shards")
    sharded = _sharded(spark, sf_dir, path)
    return ex.first_shards(sharded, 2, ex.read_catalogue(spark, path)).select(*_SHARD_COLUMNS)


def _example_shards(spark, sf_dir):
    """Examples with pages, sharded; the test split repeats the labelled rows."""
    path = staging_path(spark, "shards")
    rows = inputs.example_texts(spark, sf_dir)
    ex.ensure_shards(spark, path, rows, rows, ["ord"], VALIDATION_ROWS, SHARD_ROWS, inputs.as_examples)
    return path


def index_from_shards(spark, sf_dir):
    """Train and validation, two shards each, as in a sweep on part of the data."""
    pages = corpus.pages_of_shards(
        spark, _example_shards(spark, sf_dir), ("train", "validation"), 2
    )
    return _components(corpus.build_index(pages, ENCODER))


def sweep_from_shards(spark, sf_dir):
    """A sweep that goes on after one that had ended without its second run."""
    shards, root = _example_shards(spark, sf_dir), staging_path(spark, "artifacts")
    pages = corpus.pages_of_shards(spark, shards)
    corpus.ensure_sweep(pages, SWEEP, ENCODER, root, "hash256")
    artifacts.write_run_mark(spark, artifacts.sweep_path(root, "hash256"), 2, "not done")
    found = evaluate.sweep_shards(
        spark, shards, root, inputs.questions(spark, sf_dir), SWEEP, ENCODER, "hash256", IdfOverlapScorer()
    )
    return found.select(
        "run", "chunk_tokens", "chunk_overlap", "passages", "k", _six("recall").alias("recall"), "questions"
    )


def passages_from_shards(spark, sf_dir):
    pages = corpus.pages_of_shards(spark, _example_shards(spark, sf_dir))
    return corpus.build_passages(pages)


def recall_from_shards(spark, sf_dir):
    found = evaluate.run_recall(
        spark, _example_shards(spark, sf_dir), *_scored_index(spark, sf_dir)
    )
    return found.select("split", "k", _six("recall").alias("recall"), "questions")


def answers_from_shards(spark, sf_dir):
    index, _, scorer = _scored_index(spark, sf_dir)
    found = evaluate.run_answers(
        spark, _example_shards(spark, sf_dir), index, ENCODER, GENERATOR, scorer,
        save_path=staging_path(spark, "log"),
    )
    return found.select(
        _six("exact_match").alias("exact_match"), _six("f1").alias("f1"), "questions"
    )


# Profiles -------------------------------------------------------------------


def describe_columns(spark, sf_dir):
    return profile.describe_columns(inputs.examples(spark, sf_dir))


def word_stats(spark, sf_dir):
    return profile.text_stats(inputs.documents(spark, sf_dir)).withColumn(
        "mean_words", _six("mean_words")
    )


def top_labels(spark, sf_dir):
    return profile.top_labels(inputs.examples(spark, sf_dir))


def top_quality(spark, sf_dir):
    labels = inputs.table(spark, sf_dir, "labels")
    return profile.top_labels(labels.select("doc_id", F.col("quality").alias("answers")), "doc_id")


def common_answers(spark, sf_dir):
    return profile.common_answers(inputs.examples(spark, sf_dir))


def mean_length(spark, sf_dir):
    return profile.mean_length(
        profile.field_lengths(inputs.examples(spark, sf_dir), "answer")
    ).unionByName(
        profile.mean_length(profile.field_lengths(inputs.examples(spark, sf_dir), "question"))
    ).select(_six("mean_words").alias("mean_words"))


def length_histogram(spark, sf_dir):
    bins = profile.length_histogram(
        profile.field_lengths(inputs.examples(spark, sf_dir), "question")
    )
    return bins.select("bin", _six("low").alias("low"), _six("high").alias("high"), "n_rows")


def sample_qa(spark, sf_dir):
    return profile.sample_qa(inputs.examples(spark, sf_dir))


def truncate_nested(spark, sf_dir):
    """The clipping of the three-row preview, applied to every row."""
    rows = inputs.examples(spark, sf_dir)
    limit = settings.PREVIEW_CHARS
    clipped = rows.select(
        *[tx.clip_nested(F.col(f.name), f.dataType, limit).alias(f.name) for f in rows.schema]
    )
    return clipped.select(
        "ord", "question", F.col("answer.value").alias("value"),
        F.array_join("answer.aliases", "|").alias("aliases"),
        F.array_join("entity_pages.title", "|").alias("titles"),
    )


def sample_rows(spark, sf_dir):
    return profile.sample_rows(inputs.documents(spark, sf_dir), "doc_id")


def preview_passages(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id", tx.one_line(F.col("text"), settings.LOG_PREFIX_CHARS).alias("preview")
    )


# Streams --------------------------------------------------------------------


def _landing(spark, sf_dir):
    """The documents as a stream, be they one file or a folder of files; a pattern may name either."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    return read_landing(spark, f"{sf_dir}/document[s].parquet", schema)


def stream_ingest_dedup(spark, sf_dir):
    pages = _landing(spark, sf_dir).select(F.col("source").alias("title"), "text")
    root = staging_path(spark, "stream")
    return ingest_passages(pages, f"{root}/out", f"{root}/checkpoint")


def stream_sharded(spark, sf_dir):
    root = staging_path(spark, "stream")
    stream_shards(_landing(spark, sf_dir), ["doc_id"], f"{root}/out", f"{root}/checkpoint", SHARD_ROWS)
    return ex.read_shards(spark, f"{root}/out", ["train"]).select(
        "doc_id", "pos", "shard", "lang", "source", "text"
    )


QUERIES = {
    "unnest_pages": unnest,
    "chunk_passages": chunks,
    "dedup_passages": dedup,
    "passage_ids": passage_ids,
    "hash_embed": hash_embed,
    "l2_normalize": unit_vectors,
    "index_reuse": index_reuse,
    "index_two_encoders": index_two_encoders,
    "index_two_tokenizers": index_two_tokenizers,
    "model_encoder": model_encoder,
    "model_tokens": model_tokens,
    "model_scorer": model_scorer,
    "model_answers_text": model_answers_text,
    "model_answers_chat": model_answers_chat,
    "topk_scaled": nearest_scaled,
    "shards_resume": shards_resume,
    "source_order": source_order,
    "topk_inner_product": nearest,
    "topk_blocks": nearest_blocks,
    "topk_underfull": nearest_centroids,
    "topk_lsh": nearest_by_tables,
    "retrieve": retrieved,
    "retrieve_vector_only": retrieved_by_vector,
    "rerank_overlap": reranked_candidates,
    "recall_at_k": recall_at_k,
    "recall_by_split": recall_by_split,
    "recall_with_without_rerank": recall_with_without_rerank,
    "chunk_sweep": chunk_sweep,
    "sweep_passages": sweep_passages,
    "normalize_answer": normalize_answer,
    "normalize_vote": normalize_vote,
    "exact_match": exact_match,
    "token_f1": token_f1,
    "best_of_aliases": best_of_aliases,
    "eval_log": eval_log,
    "rag_eval": rag_eval,
    "rag_eval_consensus": rag_eval_consensus,
    "context_block": context_block,
    "prompt_text": prompt_text,
    "chat_messages": chat_messages,
    "generate_extractive": generate_extractive,
    "answer_consensus": answer_consensus,
    "vote_consensus": vote_consensus,
    "answer_in_context": answer_in_context,
    "split_shards": split_shards,
    "head_sample": head_sample,
    "head_per_split": head_per_split,
    "shard_limit": shard_limit,
    "index_from_shards": index_from_shards,
    "sweep_from_shards": sweep_from_shards,
    "read_examples": read_examples,
    "passages_from_shards": passages_from_shards,
    "recall_from_shards": recall_from_shards,
    "answers_from_shards": answers_from_shards,
    "describe_columns": describe_columns,
    "word_stats": word_stats,
    "top_labels": top_labels,
    "top_quality": top_quality,
    "common_answers": common_answers,
    "mean_length": mean_length,
    "length_histogram": length_histogram,
    "sample_qa": sample_qa,
    "truncate_nested": truncate_nested,
    "sample_rows": sample_rows,
    "preview_passages": preview_passages,
    "stream_ingest_dedup": stream_ingest_dedup,
    "stream_shards": stream_sharded,
}
