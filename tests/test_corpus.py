"""Pages, chunks, dedup, ids, encoders and index tables."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from passagework import schemas, settings
from passagework.functions import runs, text as tx
from passagework.functions.vectors import inner_product, l2_normalize
from passagework.operators import encode as encode_module, numbering
from passagework.operators.encode import BatchEncoder, HashingEncoder, encode
from passagework.operators.numbering import assign_positions
from passagework.operators.pages import (
    chunk_pages,
    chunk_sweep,
    corpus_order,
    dedup_passages,
    number_passages,
    unnest_pages,
    unpack_order,
)
from passagework.plans import corpus
from passagework.runtime import staging_path
from passagework.sources import artifacts
from workload import models


def pages_of(spark, rows):
    return spark.createDataFrame(rows, schemas.PAGES)


def test_unnest_pairs_up_to_the_shorter_list(spark):
    answer = ("v", "v", ["v"], ["v"])
    rows = [
        (0, "q", answer, (["a", "", None], ["x", "y"])),
        (1, "q", answer, (["b"], ["x", "y", "z"])),
        (2, "q", answer, None),
        (3, "q", answer, ([], ["x"])),
        (4, "q", answer, (None, ["x"])),
    ]
    got = unnest_pages(spark.createDataFrame(rows, schemas.EXAMPLES)).orderBy("example_ord", "page_pos").collect()
    assert [tuple(r) for r in got] == [(0, 0, "a", "x"), (0, 1, "No Title", "y"), (1, 0, "b", "x")]


def test_chunks_carry_titles(spark):
    pages = pages_of(spark, [(0, 0, "", "a b c d e"), (1, 0, "T", ""), (2, 0, "T", None), (3, 0, None, "x")])
    got = chunk_pages(pages, settings.Chunking(3, 1)).orderBy("example_ord", "chunk_pos")
    assert [(r["example_ord"], r["chunk_pos"], r["passage"]) for r in got.collect()] == [
        (0, 0, "No Title: a b c"), (0, 1, "No Title: c d e"), (0, 2, "No Title: e"), (3, 0, "No Title: x"),
    ]


def test_first_occurrence_survives(spark):
    rows = [(9, 0, "t", "x y"), (2, 1, "t", "x y"), (2, 0, "t", "z"), (5, 0, "t", "x y"), (2, 3, "t", "z")]
    chunks = chunk_pages(pages_of(spark, rows)).repartition(4)
    got = dedup_passages(chunks).select("passage", "copies", unpack_order(F.col("corpus_order")).alias("o"))
    found = {r["passage"]: (r["copies"], tuple(r["o"])) for r in got.collect()}
    assert found == {"t: x y": (3, (2, 1, 0)), "t: z": (2, (2, 0, 0))}
    ids = {r["passage"]: r["passage_id"] for r in number_passages(dedup_passages(chunks)).collect()}
    assert ids == {"t: z": 0, "t: x y": 1}


def test_one_text_in_a_third_of_all_pages(spark):
    pages = spark.range(30_000).select(
        F.col("id").alias("example_ord"),
        F.lit(0).alias("page_pos"),
        F.lit("t").alias("title"),
        F.when(F.col("id") % 3 == 1, "hot text").otherwise(F.concat(F.lit("n"), "id")).alias("text"),
    )
    kept = dedup_passages(chunk_pages(pages))
    assert kept.count() == 20_001
    hot = kept.where("passage = 't: hot text'").select("copies", unpack_order(F.col("corpus_order")).alias("o")).first()
    assert (hot["copies"], hot["o"]["example_ord"]) == (10_000, 1)
    ids = number_passages(kept).agg(F.min("passage_id"), F.max("passage_id"), F.countDistinct("passage_id")).first()
    assert tuple(ids) == (0, 20_000, 20_001)


def test_corpus_order_sorts_like_its_parts(spark):
    rows = [(o, p, c) for o in (0, 1, 2**62) for p in (0, 7, 10**8) for c in (0, 3, 10**8)]
    df = spark.createDataFrame(rows, "example_ord long, page_pos int, chunk_pos int")
    got = df.withColumn("o", corpus_order()).orderBy("o").select("*", unpack_order(F.col("o")).alias("u")).collect()
    assert [tuple(r)[:3] for r in got] == sorted(rows)
    assert all(tuple(r["u"]) == tuple(r)[:3] for r in got)


@pytest.mark.parametrize("partitions", [1, 8, 31])
def test_positions_are_dense_and_in_order(spark, partitions):
    df = spark.range(10_000).select((F.col("id") * 37 % 10_007).alias("k")).repartition(partitions)
    got = assign_positions(df, ["k"], "pos").collect()
    assert sorted(r["pos"] for r in got) == list(range(10_000))
    by_key = [r["pos"] for r in sorted(got, key=lambda r: r["k"])]
    assert by_key == list(range(10_000))
    assert assign_positions(df.where("k < 0"), ["k"], "pos").count() == 0


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("example_ord"), F.lit(0).alias("page_pos"), F.col("source").alias("title"), "text"
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(tuple, corpus.build_passages(pages.repartition(int(n) * 3)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) > 100


def test_sweep_equals_single_settings(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("example_ord"), F.lit(0).alias("page_pos"), F.col("source").alias("title"), "text"
    )
    sweep = [settings.Chunking(*s) for s in settings.SWEEP]
    together = corpus.sweep_passages(pages, sweep)
    for run, chunking in enumerate(sweep, 1):
        alone = corpus.build_passages(pages, chunking)
        ours = together.where(F.col("run") == run).select("passage_id", "passage")
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, alone.collect()))


def plain_hash(text, dim):
    import re

    vector = np.zeros(dim)
    for word in re.split(r"[ \t\n\r!-/:-@\[-`{-~]+", text.lower()):
        if word:
            digest = hashlib.md5(word.encode()).hexdigest()
            vector[int(digest[:8], 16) % dim] += -1 if int(digest[8], 16) >= 8 else 1
    norm = np.sqrt((vector * vector).sum())
    return (vector / (norm or 1e-10)).astype(np.float32)


def test_hashing_encoder(spark):
    texts = ["one two two, THREE!", "", "é ß 中", "...", None, "x " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    for dim in (16, 256):
        for r in encode(df, "t", HashingEncoder(dim)).collect():
            np.testing.assert_array_equal(np.float32(r["embedding"]), plain_hash(r["t"] or "", dim))
    assert encode(df.where("i < 0"), "t", HashingEncoder()).collect() == []


def test_model_encoder_sees_batches_and_is_built_per_task(spark):
    def factory():
        def model(texts):
            assert 0 < len(texts) <= 7
            return np.array([[len(t), 0.0, 3.0 if t else 0.0] for t in texts])

        return model

    df = spark.range(50).select("id", F.repeat(F.lit("x"), F.col("id").cast("int") % 5).alias("t"))
    for r in encode(df, "t", BatchEncoder(factory, 7)).collect():
        n = len(r["t"])
        length = np.hypot(n, 3.0 if n else 0.0) or 1.0
        np.testing.assert_allclose(r["embedding"], [n / length, 0, (3.0 if n else 0) / length], rtol=1e-6)


def test_l2_normalize_and_inner_product(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],)], "v array<float>")
    rows = df.select(l2_normalize(F.col("v")).alias("u"), inner_product(F.col("v"), F.col("v")).alias("d")).collect()
    np.testing.assert_allclose(rows[0]["u"], [0.6, 0.8], rtol=1e-6)
    assert rows[0]["d"] == 25.0 and rows[1]["u"] == [0.0, 0.0] and rows[2]["u"] == []


def test_model_tokenizer_slot(spark):
    def factory():
        def to_ids(texts):
            return [[ord(c) for c in t] for t in texts]

        def to_text(ids):
            return ["".join(map(chr, row)) for row in ids]

        return to_ids, to_text

    pages = pages_of(spark, [(0, 0, "T", "abc de"), (1, 0, "T", None)])
    got = chunk_pages(pages, settings.Chunking(4, 1), tx.model_tokenizer(factory, "characters")).orderBy("chunk_pos")
    assert [r["passage"] for r in got.collect()] == ["T: abc", "T: de"]
    swept = chunk_sweep(pages, [settings.Chunking(4, 1)], tx.model_tokenizer(factory, "characters")).orderBy("chunk_pos")
    assert [r["passage"] for r in swept.collect()] == ["T: abc", "T: de"]


def test_index_is_reused_per_setting(spark):
    root = staging_path(spark, "test")
    first = pages_of(spark, [(0, 0, "t", "a b c d")])
    changed = pages_of(spark, [(0, 0, "t", "e f")])
    small = settings.Chunking(2, 0)

    def texts(*args, **options):
        return sorted(r["passage"] for r in corpus.ensure_index(*args, **options).collect())

    encoder = HashingEncoder(8)
    assert texts(first, encoder, root, "h8") == ["t: a b c d"]
    assert texts(changed, encoder, root, "h8") == ["t: a b c d"]
    assert texts(changed, encoder, root, "h8", small) == ["t: e f"]
    assert texts(changed, encoder, root, "h8", recompute_index=True) == ["t: a b c d"]
    other = HashingEncoder(4)
    assert texts(first, other, root, "h4") == ["t: a b c d"]
    assert texts(changed, encoder, root, "h8", recompute_passages=True) == ["t: e f"]
    assert texts(changed, other, root, "h4") == ["t: e f"]
    pairs = tx.Tokenizer(tx.tokens, lambda items: F.array_join(items, "+"), "plus")
    assert texts(first, encoder, root, "h8", tokenizer=pairs) == ["t: a+b+c+d"]
    assert texts(first, encoder, root, "h8") == ["t: e f"]
    assert artifacts.read_passages(spark, artifacts.passages_path(root, small)).count() == 1
    with pytest.raises(AnalysisException):
        artifacts.read_index(spark, f"{root}/absent")


def test_sweep_index_has_a_folder_per_run(spark):
    path = staging_path(spark, "test")
    pages = pages_of(spark, [(0, 0, "t", "a b c d")])
    sweep = [settings.Chunking(2, 0), settings.Chunking(3, 0)]
    index = corpus.sweep_index(pages, sweep, HashingEncoder(8), path)
    assert index.where("run = 2").count() == 2 and index.count() == 4
    assert artifacts.read_index(spark, f"{path}/run=1").count() == 2


def test_vectors_do_not_depend_on_the_piece(spark):
    """A batch of many texts is turned to vectors piece by piece; each row has those it has alone."""
    rows = spark.range(3000).select("id", F.concat(F.lit("w"), F.col("id") % 7, F.lit(" x"), F.col("id") % 3).alias("t")).coalesce(1)
    vectors = HashingEncoder(16).encode(rows, "t")

    assert vectors.count() == 3000
    got = {r["id"]: r["embedding"] for r in vectors.collect()}
    alone = {r["id"]: r["embedding"] for r in HashingEncoder(16).encode(rows.where("id < 21"), "t").collect()}
    assert all(got[i] == alone[i % 21] for i in got)


def test_words_are_hashed_once_in_a_task():
    """a word that comes again in a later batch is looked up; what the first words leave no room for is hashed again."""
    asked = []
    known = encode_module._Known(lambda word: asked.append(word) or len(word))
    batches = [pa.array(["a", "bb", "é"]), pa.array(["é", "a", "dddd"]), pa.array([], pa.string())]
    assert [known.of(b).tolist() for b in batches] == [[1, 2, 2], [2, 1, 4], []]
    assert asked == [b"a", b"bb", "é".encode(), b"dddd"]


def test_texts_are_not_split_to_words_in_the_plan(spark):
    """F12 F19: neither chunks nor vectors need an object for each word."""
    pages = pages_of(spark, [(0, 0, "T", "a b c d")])
    sweep = [settings.Chunking(2, 0), settings.Chunking(3, 1)]
    for made in (chunk_pages(pages), chunk_sweep(pages, sweep), encode(pages, "text", HashingEncoder(8))):
        assert "split(" not in made._jdf.queryExecution().executedPlan().toString()


def test_windows_of_odd_texts(spark, monkeypatch):
    """windows cut from the bytes are those cut from tokens, in pieces of any size."""
    texts = ["", " ", None, "a", " a  b\t\tc\r\nd ", "é ß 中 x", "x\x0by z", "a b c d e f g" * 3, "t\n"] * 20
    pages = pages_of(spark, [(i, i % 3, None if i % 4 else "T", t) for i, t in enumerate(texts)]).repartition(2)
    sweep = [settings.Chunking(*s) for s in ((3, 1), (1, 0), (2, 1), (50, 0))]
    by_tokens = tx.Tokenizer(tx.tokens, lambda items: F.array_join(items, " "))
    want = sorted(map(repr, chunk_sweep(pages, sweep, by_tokens, [4, 7, 2, 9]).collect()))
    assert len(want) > 300
    for most in (1, 40, 2**19):
        monkeypatch.setattr(runs, "PIECE_BYTES", most)
        assert sorted(map(repr, chunk_sweep(pages, sweep, numbers=[4, 7, 2, 9]).collect())) == want
    one = sorted(map(repr, chunk_pages(pages, sweep[0]).collect()))
    assert one == sorted(map(repr, chunk_pages(pages, sweep[0], by_tokens).collect()))


def test_texts_are_not_numbered(spark, monkeypatch):
    """F3 F6: first passages are found and numbered by digests; what is written for that holds no text."""
    written = []
    original = numbering.staged
    monkeypatch.setattr(numbering, "staged", lambda df, label: written.append(df.columns) or original(df, label))
    pages = pages_of(spark, [(i, 0, "T", f"a b c d {i % 3}") for i in range(9)])
    swept = corpus.sweep_passages(pages, [settings.Chunking(2, 0), settings.Chunking(3, 1)])
    assert swept.groupBy("run").count().count() == 2 and swept.count() == swept.select("run", "passage").distinct().count()
    assert corpus.build_passages(pages, settings.Chunking(2, 0)).count() == 5
    assert written and not any({"passage", "text"} & set(columns) for columns in written)


def test_pages_with_equal_or_no_keys(spark):
    """F3 F6: copies of pages, pages that share a key or begin alike, and null keys give each passage once."""
    rows = [
        (3, 0, "T", "a b c d e"), (3, 0, "T", "a b c d e"), (3, 0, "T", "a b x"), (3, 0, "U", "a b x"), (1, 1, None, "a b c d"),
        (1, 0, "", "c d"), (None, 0, "T", "a b"), (None, 0, "T", "n n"), (None, None, "T", "o o"), (5, None, "T", "p p"),
        (2, 0, "T", None), (4, 0, "T", "  "), (0, 0, "U", "a b"),
    ] * 2
    sweep = [settings.Chunking(2, 0), settings.Chunking(3, 1)]
    plus = tx.Tokenizer(tx.tokens, lambda items: F.array_join(items, " "), "plain")
    want = {}
    for run, c in enumerate(sweep, 1):
        for n, page, title, text in rows:
            words = (text or "").split()
            for at, a in enumerate(range(0, len(words), c.step)):
                key = (run, f"{title or 'No Title'}: {' '.join(words[a : a + c.tokens])}")
                place = None if n is None or page is None else (n, page, at)
                old = want.get(key)
                want[key] = place if old is None else old if place is None else min(old, place)
    for partitions in (1, 7):
        pages = pages_of(spark, rows).repartition(partitions)
        got = corpus.sweep_passages(pages, sweep).collect()
        assert len(got) == len(want) and {(r["run"], r["passage"]) for r in got} == set(want)
        assert {(r["chunk_tokens"], r["chunk_overlap"]) for r in got if r["run"] == 2} == {(3, 1)}
        for run, c in enumerate(sweep, 1):
            mine = sorted((r["passage_id"], r["passage"]) for r in got if r["run"] == run)
            assert [i for i, _ in mine] == list(range(len(mine)))
            places = [want[run, p] for _, p in mine]
            known = [p for p in places if p is not None]
            assert places == [None] * (len(places) - len(known)) + sorted(known)
            for tokenizer in (tx.BLANK_TOKENIZER, plus):
                alone = corpus.build_passages(pages, c, tokenizer)
                assert alone.columns == ["passage_id", "passage"]
                assert {r["passage"] for r in alone.collect()} == {p for _, p in mine}
    numbered = corpus.sweep_passages(pages, sweep, [9, 4]).groupBy("run").count().collect()
    assert {r["run"]: r["count"] for r in numbered} == {9: sum(k[0] == 1 for k in want), 4: sum(k[0] == 2 for k in want)}


def test_model_windows_are_cut_where_the_ids_are(spark, monkeypatch):
    """a model's windows for all settings come from one call per piece, equal those cut from an array of ids, and no ids leave the task."""
    texts = ["", None, " a", "abcdefghij" * 3, "\x1c x​ \x85", "é中\U0001f600z" * 5, "　  q \xa0"] * 3
    pages = pages_of(spark, [(i, 0, "T", t) for i, t in enumerate(texts)]).repartition(2)
    sweep = [settings.Chunking(4, 1), settings.Chunking(3, 0)]
    whole = tx.model_tokenizer(models.character_tokenizer, "characters")
    by_ids = tx.Tokenizer(whole.encode, whole.decode, "ids")
    for most in (1, 7, 500_000):
        monkeypatch.setattr(tx, "_PIECE", most)
        assert sorted(map(repr, chunk_sweep(pages, sweep, whole).collect())) == sorted(map(repr, chunk_sweep(pages, sweep, by_ids).collect()))
    assert sorted(corpus.build_passages(pages, sweep[0], whole).collect()) == sorted(corpus.build_passages(pages, sweep[0], by_ids).collect())
    for made in (chunk_sweep(pages, sweep, whole), chunk_sweep(pages, sweep)):
        assert made._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1
