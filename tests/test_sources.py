"""Splits, shards, streams and profiles."""

import os
import pickle

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from passagework import runtime, schemas, settings
from passagework.operators import profile
from passagework.operators.encode import HashingEncoder
from passagework.operators.generate import ModelGenerator
from passagework.operators.lsh import ProjectionTables
from passagework.plans import corpus, evaluate
from passagework.runtime import shared_folder, staging_path
from passagework.sources import artifacts, examples as ex
from passagework.sources.tables import read_table
from passagework.streaming.ingest import ingest_passages, read_landing, stream_shards
from workload import queries


def rows_table(spark, n, factor=7):
    """Keys 0, factor, 2*factor, ... in scattered order."""
    return spark.range(n).select((F.col("id") * factor).alias("ord")).repartition(5)


@pytest.mark.parametrize("n,validation", [(10, 0), (10, 4), (10, 10), (10, 99), (0, 3)])
def test_positional_split(spark, n, validation):
    got = ex.split_by_position(rows_table(spark, n), ["ord"], validation).collect()
    for r in got:
        i = r["ord"] // 7
        assert (r["split"], r["pos"]) == (("validation", i) if i < validation else ("train", i - validation))
    assert len(got) == n


def test_split_uses_a_given_position(spark):
    df = spark.range(6).withColumnRenamed("id", "ord")
    got = ex.split_by_position(df, ["ord"], 2, position="ord")
    assert [(r["split"], r["pos"]) for r in got.orderBy("ord").collect()] == [
        ("validation", 0), ("validation", 1), ("train", 0), ("train", 1), ("train", 2), ("train", 3),
    ]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shards(spark):
    path = staging_path(spark, "test")
    ex.ensure_shards(spark, path, rows_table(spark, 135), rows_table(spark, 25, 3), ["ord"], 12, 10)
    return path


def test_shards_are_full_but_the_last(spark, shards):
    got = ex.read_shards(spark, shards).groupBy("split", "shard").count().collect()
    sizes = {(r["split"], r["shard"]): r["count"] for r in got}
    expected = {("train", i): 10 for i in range(12)} | {("train", 12): 3}
    expected |= {("validation", 0): 10, ("validation", 1): 2}
    expected |= {("test", 0): 10, ("test", 1): 10, ("test", 2): 5}
    assert sizes == expected


def test_present_splits_are_left_alone(spark, shards):
    again = ex.ensure_shards(spark, shards, rows_table(spark, 5), rows_table(spark, 5), ["ord"], 1, 1)
    assert again.count() == 160


@pytest.mark.parametrize("left", ["train", "validation", "test"])
def test_missing_splits_are_completed(spark, left):
    """Only one split was finished; another one was begun."""
    path = staging_path(spark, "test")
    tables = rows_table(spark, 20), rows_table(spark, 7), ["ord"], 5, 10
    whole = ex.ensure_shards(spark, staging_path(spark, "test"), *tables)
    part = whole.where(F.col("split") == left).drop("split")
    part.write.parquet(f"{path}/split={left}")
    part.groupBy().count().withColumnRenamed("count", "rows").write.parquet(ex._marker(path, left))
    begun = "test" if left != "test" else "train"
    part.withColumn("ord", F.lit(-1).cast("long")).write.parquet(f"{path}/split={begun}")
    got = ex.ensure_shards(spark, path, *tables)
    assert sorted(map(tuple, got.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_an_empty_split_is_not_written_again(spark):
    path = staging_path(spark, "test")
    tables = rows_table(spark, 20), rows_table(spark, 0), ["ord"], 0, 10
    assert ex.ensure_shards(spark, path, *tables).count() == 20
    again = ex.ensure_shards(spark, path, rows_table(spark, 9), rows_table(spark, 9), ["ord"], 3, 10)
    assert again.count() == 20


def test_unmarked_splits_are_written(spark):
    path = staging_path(spark, "test")
    ex.write_shards(ex.split_by_position(rows_table(spark, 20), ["ord"], 5), path, 10)
    got = ex.ensure_shards(spark, path, rows_table(spark, 20), rows_table(spark, 7), ["ord"], 5, 10)
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 15, "validation": 5, "test": 7}


def test_head_follows_shard_names_as_text(spark, shards):
    train = ex.read_shards(spark, shards, ["train"])
    got = [(r["shard"], r["pos"]) for r in ex.head(train, 45).collect()]
    # shard_0, shard_1, shard_10, shard_11, shard_12 (3 rows), shard_2
    expected = [(s, p) for s in (0, 1, 10, 11) for p in range(s * 10, s * 10 + 10)]
    expected += [(12, p) for p in (120, 121, 122)] + [(2, 20), (2, 21)]
    assert got == expected
    assert ex.head(train, 10_000).count() == 123
    per_split = ex.head_per_split(ex.read_shards(spark, shards), 11).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in per_split} == {"train": 11, "validation": 11, "test": 11}


def test_head_reads_the_leading_shards_only(spark, shards):
    splits = {r["split"] for r in ex._leading_shards(ex.read_shards(spark, shards), 11).collect()}
    plan = ex.head(ex.read_shards(spark, shards, ["train"]), 11)._jdf.queryExecution().executedPlan().toString()
    assert "shard" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert splits == {"train", "validation", "test"}


@pytest.mark.parametrize("limit,kept", [(2, {0, 1}), (3, {0, 1, 10}), (0, set(range(13))), (None, set(range(13)))])
def test_first_shards(spark, shards, limit, kept):
    train = ex.read_shards(spark, shards, ["train", "absent"])
    assert {r["shard"] for r in ex.first_shards(train, limit).select("shard").distinct().collect()} == kept


def test_source_order_is_split_then_shard_name_then_row(spark):
    rows = [(s, p // 3, p) for s in settings.SPLITS for p in range(400)]
    df = ex.with_shards(spark.createDataFrame([(s, p) for s, _, p in rows], "split string, pos long"), 3)
    got = ex.in_source_order(df.select("split", "shard", "pos", "row")).orderBy("ord").collect()
    place = settings.SPLITS.index
    expected = sorted(rows, key=lambda r: (place(r[0]), f"shard_{r[1]}", r[2]))
    assert [tuple(r)[:3] for r in got] == expected and len({r["ord"] for r in got}) == len(rows)


def test_shards_of_absent_splits_are_skipped(spark):
    from passagework.plans import corpus, evaluate

    path = staging_path(spark, "test")
    answer = ("v", "v", ["v"], ["v"])
    rows = [(i, "q", answer, ([f"t{i}"], [f"x{i}"])) for i in range(6)]
    df = spark.createDataFrame(rows, schemas.EXAMPLES)
    ex.write_shards(ex.split_by_position(df, ["ord"], 2), path, 2)
    pages = corpus.pages_of_shards(spark, path).orderBy("example_ord")
    assert [r["title"] for r in pages.collect()] == ["t2", "t3", "t4", "t5", "t0", "t1"]
    assert corpus.pages_of_shards(spark, path, ("train",), 1).count() == 2
    with pytest.raises(ValueError):
        corpus.pages_of_shards(spark, path, ("test",))


def test_empty_input_is_reported(spark, shards):
    with pytest.raises(ValueError):
        ex.require_rows(ex.read_shards(spark, shards, ["absent"]), "absent")
    assert ex.require_rows(ex.read_shards(spark, shards, ["test"]), "test").count() == 25


def test_examples_as_json_and_parquet(spark):
    answer = ("v", "v", ["a"], ["a"])
    df = spark.createDataFrame([(0, "q", answer, (["t"], ["c"])), (1, "r", None, None)], schemas.EXAMPLES)
    for fmt in ("json", "parquet"):
        path = staging_path(spark, "test")
        df.write.format(fmt).save(path)
        back = ex.read_examples(spark, path, fmt)
        assert back.schema == schemas.EXAMPLES and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_damaged_lines_are_kept_apart(spark):
    path = staging_path(spark, "test")
    lines = ['{"ord": 1, "question": "q"}', '{"ord": 2, "quest', "no json at all", '{"ord": "x"}', '{"ord": 3, "extra": [1]}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    examples, damaged = ex.read_json_examples(spark, path)
    assert sorted(r["ord"] for r in examples.collect()) == [1, 3] and examples.schema == schemas.EXAMPLES
    assert sorted(r["damaged"] for r in damaged.collect()) == sorted(lines[1:4])
    spark.createDataFrame([('{"ord": 3}',)], "value string").write.mode("append").text(path)
    with pytest.raises(ValueError, match="ord of their own"):
        ex.read_json_examples(spark, path)


def test_first_shards_are_found_without_reading_shards(spark):
    path = staging_path(spark, "test")
    rows = spark.range(300).select(F.col("id").alias("ord"))
    sharded = ex.ensure_shards(spark, path, rows, rows, ["ord"], 100, 7)
    sizes = ex.read_catalogue(spark, path)
    assert {tuple(r) for r in sizes.collect()} == {tuple(r) for r in ex.catalogue(sharded).collect()}
    for got, want in (
        (ex.head(sharded.where("split = 'test'"), 40, sizes.where("split = 'test'")), ex.head(sharded.where("split = 'test'"), 40)),
        (ex.head_per_split(sharded, 23, sizes), ex.head_per_split(sharded, 23)),
        (ex.first_shards(sharded, 3, sizes), ex.first_shards(sharded, 3)),
    ):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    text = ex.first_shards(sharded, 3, sizes)._jdf.queryExecution().executedPlan().toString()
    # The data are scanned once, with the shards' range pushed down; the rest are catalogues.
    assert sum("GreaterThanOrEqual(shard" in x for x in text.split("\n") if "FileScan" in x) == 1
    assert sum("pos" in x for x in text.split("\n") if "FileScan" in x) == 1


def test_sweep_builds_only_what_has_no_mark(spark, monkeypatch):
    pages = spark.range(30).select(
        F.col("id").alias("example_ord"), F.lit(0).alias("page_pos"), F.lit("t").alias("title"),
        F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id") % 11) for i in range(12)]).alias("text"),
    )
    root, sweep = staging_path(spark, "sweep"), [settings.Chunking(5, 1), settings.Chunking(7, 2), settings.Chunking(12, 0)]
    built = []
    original = corpus.chunk_sweep

    def spied(pages, sweep, *args, numbers=None):
        if numbers:
            built.append(list(numbers))
        return original(pages, sweep, *args, numbers=numbers)

    monkeypatch.setattr(corpus, "chunk_sweep", spied)
    encoder = HashingEncoder(8)

    def rows(df):
        return sorted((r["run"], r["passage_id"], r["passage"], tuple(r["embedding"])) for r in df.collect())

    first = rows(corpus.ensure_sweep(pages, sweep, encoder, root, "h8"))
    assert rows(corpus.ensure_sweep(pages, sweep, encoder, root, "h8")) == first
    path = artifacts.sweep_path(root, "h8")
    artifacts.write_run_mark(spark, path, 2, "half")
    assert rows(corpus.ensure_sweep(pages, sweep, encoder, root, "h8")) == first
    assert {r[0] for r in rows(corpus.ensure_sweep(pages, sweep[:2], encoder, root, "h8"))} == {1, 2}
    changed = pages.where("example_ord < 20")
    corpus.ensure_sweep(changed, sweep[:1], encoder, root, "h8")
    assert built == [[1, 2, 3], [2], [1]]
    assert rows(corpus.ensure_sweep(changed, sweep, encoder, root, "h8")) == rows(
        corpus.sweep_index(changed, sweep, encoder).select("run", "passage_id", "passage", "embedding"))


@pytest.fixture(scope="module")
def example_shards(spark):
    """130 examples in train and 30 in validation, ten a shard, and 40 in test; each with a page of its own words."""
    rows = spark.range(200).select(
        F.col("id").alias("ord"),
        F.concat(F.lit("w"), "id").alias("question"),
        F.expr("named_struct('value', '', 'normalized_value', '', 'aliases', array(''), 'normalized_aliases', array(concat('w', id)))").alias("answer"),
        F.expr("named_struct('title', array('t'), 'wiki_context', array(concat('w', id)))").alias("entity_pages"),
    )
    path = staging_path(spark, "test")
    ex.ensure_shards(spark, path, rows.where("ord < 160"), rows.where("ord >= 160"), ["ord"], 30, 10)
    return path


def test_rows_are_widened_after_the_shuffle(spark, monkeypatch):
    """F4 F5: what `prepare` makes of a row is written, and only what it is made of is shuffled."""
    rows = rows_table(spark, 57).withColumn("word", F.concat(F.lit("w"), "ord"))
    plans = []
    original = ex.with_shards

    def spied(df, n):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(df, n)

    monkeypatch.setattr(ex, "with_shards", spied)

    def wide(df):
        return df.select("*", F.repeat("word", 20).alias("many"))

    some = ex.ensure_shards(spark, staging_path(spark, "test"), rows, rows.limit(0), ["ord"], 12, 10, wide)
    want = ex.ensure_shards(spark, staging_path(spark, "test"), wide(rows), wide(rows).limit(0), ["ord"], 12, 10)
    assert sorted(map(repr, some.select(*want.columns).collect())) == sorted(map(repr, want.collect())) and some.count() == 57
    for text in (p for p in plans[:2] if "repeat(" in p):
        assert text.index("repeat(") < text.index("Repartition")
    assert any("repeat(" in p for p in plans[:2])


def test_sweep_over_all_shards(spark, example_shards):
    """F8: a sweep reads every shard of every split, unless it is told to read the first ones only."""
    questions = spark.createDataFrame([(1, "w7", ["w7"])], "qid long, question string, aliases array<string>")
    for options, size in (({}, 200), ({"splits": ("train", "validation"), "max_shards": 2}, 40)):
        found = evaluate.sweep_shards(
            spark, example_shards, staging_path(spark, "artifacts"), questions, [settings.Chunking(5, 1)], HashingEncoder(8), "h8", **options
        )
        assert {r["passages"] for r in found.collect()} == {size}


def test_recall_of_all_examples(spark, example_shards):
    """all examples of a split are asked, also beyond the first 100."""
    index = corpus.build_index(corpus.pages_of_shards(spark, example_shards), HashingEncoder(8))
    found = evaluate.run_recall(spark, example_shards, index, HashingEncoder(8), candidates=200, ks=(200,))
    assert {(r["split"], r["questions"], r["recall"]) for r in found.collect()} == {("train", 130, 1.0), ("validation", 30, 1.0), ("test", 40, 1.0)}
    some = evaluate.run_recall(spark, example_shards, index, HashingEncoder(8), sample_limit=100, candidates=200, ks=(200,))
    assert {(r["split"], r["questions"]) for r in some.collect()} == {("train", 100), ("validation", 30), ("test", 40)}


def test_replayed_batch_gives_the_same_passages(spark):
    """Batches over one landing folder, then again from an older checkpoint; no state is kept by the stream."""
    import os
    import tempfile

    path, root = staging_path(spark, "landing"), tempfile.mkdtemp(prefix="stream-")
    pages = spark.range(120).select(F.lit("t").alias("title"), F.concat(F.lit("w"), F.col("id") % 29).alias("text"))
    pages.repartition(3).write.parquet(path)

    def ingest():
        stream = read_landing(spark, path, pages.schema, files_per_batch=1, glob="*.parquet")
        return sorted(r["passage"] for r in ingest_passages(stream, f"{root}/out", f"{root}/check").collect())

    want = sorted(f"t: w{i}" for i in range(29))
    assert ingest() == want
    assert not os.path.exists(f"{root}/check/state")
    # The last batch was written, but the checkpoint does not know that it ended.
    os.remove(f"{root}/check/commits/2")
    if os.path.exists(f"{root}/check/commits/.2.crc"):
        os.remove(f"{root}/check/commits/.2.crc")
    assert ingest() == want
    spark.createDataFrame([("t", "new"), ("t", "w3")], "title string, text string").coalesce(1).write.mode("append").parquet(path)
    assert ingest() == sorted([*want, "t: new"])


def test_tables_are_read_where_they_lie(spark, sf_dir):
    df = read_table(spark, f"{sf_dir}/documents.parquet")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == named.rstrip("/") if named else shared_folder(spark)


def test_no_folder_is_made_up(monkeypatch):
    from passagework import runtime

    class Session:
        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    made = []
    monkeypatch.setattr(runtime, "_local", {})
    with pytest.raises(RuntimeError):
        shared_folder(Session("local[2]"))
    runtime.use_in_local_mode(lambda: made.append(1) or "/some/folder")
    assert shared_folder(Session("local[2]")) == shared_folder(Session("local[8]")) == "/some/folder" and made == [1]
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://host:7077"))


def test_staged_tables_can_be_dropped():
    import os
    import subprocess
    import sys

    code = """
import os, tempfile
from pyspark.sql import SparkSession
from passagework.runtime import drop_staged, staged
folder = tempfile.mkdtemp()
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", folder).config("spark.ui.enabled", "false").getOrCreate()
assert staged(spark.range(3), "x").count() == 3
assert os.listdir(f"{folder}/passagework")
drop_staged(spark)
assert not os.listdir(f"{folder}/passagework")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=200)


def test_shards_are_written_once_and_nothing_beside_them(spark):
    """Equal and null keys get places of their own, and only keys are written before the shards."""
    keys = [None, None, *[i // 2 for i in range(5000)]]
    rows = spark.createDataFrame([(k, "x" * 50 + str(i)) for i, k in enumerate(keys)], "ord long, text string").repartition(4)
    before = set(os.listdir(os.path.dirname(staging_path(spark, "x")))) if os.path.isdir(os.path.dirname(staging_path(spark, "x"))) else set()
    path = staging_path(spark, "shards")
    table = ex.ensure_shards(spark, path, rows, rows, ["ord"], 7, 100)
    for split, n in (("validation", 7), ("train", 4995), ("test", 5002)):
        got = sorted((r["pos"], r["shard"], -1 if r["ord"] is None else r["ord"]) for r in table.where(F.col("split") == split).collect())
        assert [g[0] for g in got] == list(range(n)) and all(g[1] == g[0] // 100 for g in got)
        assert [g[2] for g in got] == sorted(g[2] for g in got)
    folder = os.path.dirname(path)
    for name in set(os.listdir(folder)) - before - {os.path.basename(path)}:
        assert "text" not in spark.read.parquet(f"{folder}/{name}").columns, name


def test_folder_maker_stays_on_the_driver():
    """Operators go into tasks by value, with all that their module names."""
    assert "make" in runtime._local
    assert isinstance(pickle.loads(cloudpickle.dumps(ModelGenerator(len))), ModelGenerator)
    assert isinstance(pickle.loads(cloudpickle.dumps(ProjectionTables())), ProjectionTables)


def test_streams_of_a_table_in_one_file_or_many(spark):
    path = staging_path(spark, "tables")
    rows = [(i, f"w{i % 7}", "en", "web", 2) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(3).write.parquet(f"{path}/many/documents.parquet")
    table.write.parquet(f"{path}/many/labels.parquet")
    os.mkdir(f"{path}/one")
    table.toPandas().to_parquet(f"{path}/one/documents.parquet")
    for folder in ("many", "one"):
        placed = queries.QUERIES["stream_shards"](spark, f"{path}/{folder}").collect()
        assert sorted((r["doc_id"], r["pos"], r["shard"]) for r in placed) == [(i, i, i // 50) for i in range(60)]
        assert queries.QUERIES["stream_ingest_dedup"](spark, f"{path}/{folder}").count() == 7


def test_stream_dedup_and_shards_over_several_batches(spark):
    path = staging_path(spark, "landing")
    pages = spark.range(200).select(
        F.col("id").alias("key"), F.lit("t").alias("title"), F.concat(F.lit("w"), F.col("id") % 37).alias("text")
    )
    pages.repartition(6).write.parquet(path)
    root = staging_path(spark, "stream")
    stream = read_landing(spark, path, pages.schema, files_per_batch=2, glob="*.parquet")
    out = ingest_passages(stream.select("title", "text"), f"{root}/p", f"{root}/pc")
    assert sorted(r["passage"] for r in out.collect()) == sorted(f"t: w{i}" for i in range(37))

    def shards():
        again = read_landing(spark, path, pages.schema, files_per_batch=2, glob="*.parquet")
        return stream_shards(again.select("key"), ["key"], f"{root}/s", f"{root}/sc", 30)

    got = shards().collect()
    assert ex.in_source_order(ex.read_shards(spark, f"{root}/s", ["train"])).select("ord").distinct().count() == 200
    assert sorted(r["pos"] for r in got) == list(range(200)) and len({r["key"] for r in got}) == 200
    assert all(r["shard"] == r["pos"] // 30 for r in got) and len({r["epoch"] for r in got}) > 1
    # Files that arrive later continue the numbering.
    pages.where("key < 15").write.mode("append").parquet(path)
    got = shards().collect()
    assert sorted(r["pos"] for r in got) == list(range(215))


# Profiles -------------------------------------------------------------------


def test_text_stats_skip_nulls(spark):
    df = spark.createDataFrame([("a b", " ", 1), (None, "x", 2), ("c", "", 3)], "s string, t string, n int")
    got = {r["column"]: tuple(r)[1:] for r in profile.text_stats(df).collect()}
    assert got == {"s": (1.5, 1, 2), "t": (pytest.approx(1 / 3), 0, 1)}
    assert profile.text_stats(df.select("n")).collect() == []


def test_labels_by_shape(spark):
    answer = T.StructType.fromDDL("normalized_value string, value string")
    rows = [(0, ("b", "x")), (1, ("a", "x")), (2, ("", "a")), (3, (None, "b")), (4, ("", "")), (5, None)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("ord", T.LongType()), T.StructField("answer", answer)]))
    got = [tuple(r) for r in profile.top_labels(df).collect()]
    assert got[:2] == [("b", 2), ("a", 2)] and got[2][1] == 1
    listed = spark.createDataFrame([(0, ["z", "y"]), (1, ["y"]), (2, [])], "ord long, answers array<string>")
    assert [tuple(r) for r in profile.top_labels(listed).collect()] == [("y", 2), ("z", 1)]
    assert [tuple(r) for r in profile.top_labels(listed, n=1).collect()] == [("y", 2)]
    plain = spark.createDataFrame([(0, 5), (1, 6), (2, 6)], "ord long, answer int")
    assert [tuple(r) for r in profile.top_labels(plain).collect()] == [("6", 2), ("5", 1)]
    structs = spark.createDataFrame([(0, [("k",), ("m",)]), (1, [("m",)])], "ord long, answer array<struct<value: string>>")
    assert [tuple(r) for r in profile.top_labels(structs).collect()] == [("m", 2), ("k", 1)]
    with pytest.raises(ValueError):
        profile.top_labels(spark.range(3))


def test_common_answers_by_shape(spark):
    aliased = spark.createDataFrame([(0, (["q", "p"],)), (1, (["p"],))], "ord long, answer struct<aliases: array<string>>")
    assert [tuple(r) for r in profile.common_answers(aliased).collect()] == [("p", 2), ("q", 1)]
    valued = spark.createDataFrame([(0, ("u",)), (1, ("v",)), (2, ("v",))], "ord long, answer struct<value: string>")
    assert [tuple(r) for r in profile.common_answers(valued).collect()] == [("v", 2), ("u", 1)]
    listed = spark.createDataFrame([(0, ["b", "a"]), (1, ["a"])], "ord long, answer array<string>")
    assert [tuple(r) for r in profile.common_answers(listed, n=1).collect()] == [("a", 2)]
    plain = spark.createDataFrame([(0, "b")], "ord long, answer string")
    assert [tuple(r) for r in profile.common_answers(plain).collect()] == [("b", 1)]


def test_field_lengths_by_shape(spark):
    def mean(rows, ddl):
        return profile.mean_length(profile.field_lengths(spark.createDataFrame(rows, ddl), "f")).first()[0]

    assert mean([("a b",), ("",), (None,)], "f string") == 1.0  # null counts as one word
    assert mean([(["a b", "c"],), ([],)], "f array<string>") == 1.0
    assert mean([(("a b c",),)], "f struct<value: string>") == 3.0
    assert mean([([("a b",)],)], "f array<struct<value: string>>") == 2.0
    assert mean([(12,)], "f int") == 1.0
    assert mean([(["a b"],), ([None],)], "f array<string>") == 2.0
    assert mean([(("a b",),), ((None,),)], "f struct<value: string>") == 2.0
    assert mean([], "f string") is None


@pytest.mark.parametrize("low,high,n", [(0, 500, 3000), (3, 17, 400), (7, 7, 50), (1, 10_007, 5000), (0, 30, 999)])
def test_histogram_equals_numpy(spark, low, high, n):
    lengths = np.random.default_rng(low + high).integers(low, high + 1, n)
    table = spark.createDataFrame([(int(v),) for v in lengths], "n_words int").groupBy("n_words").agg(F.count(F.lit(1)).alias("n_rows"))
    got = profile.length_histogram(table).orderBy("bin").collect()
    counts, edges = np.histogram(lengths, bins=30)
    assert [r["n_rows"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["low"] for r in got] + [got[-1]["high"]], edges)


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([], "n_words int, n_rows long")
    assert profile.length_histogram(empty).collect() == []


def test_samples_and_columns(spark):
    df = spark.createDataFrame([(2, "c" * 60, ("v", ["1", "2", "3", "4"])), (1, "b", ("w", []))], "ord long, question string, answer struct<value: string, aliases: array<string>>")
    assert [tuple(r) for r in profile.sample_qa(df).collect()] == [(1, "b", ""), (2, "c" * 60, "1, 2, 3")]
    assert profile.sample_qa(df, n=1).count() == 1
    assert [r["question"] for r in profile.sample_rows(df, "ord").collect()] == ["b", "c" * 50 + "..."]
    listed = profile.describe_columns(df).orderBy("position").collect()
    assert [(r["column"], r["type"], r["n_rows"]) for r in listed][:2] == [("ord", "bigint", 2), ("question", "string", 2)]


def test_chunk_settings():
    assert settings.Chunking().step == 180 and settings.Chunking(3, 9).step == 1
    with pytest.raises(ValueError):
        settings.Chunking(0, 0)
