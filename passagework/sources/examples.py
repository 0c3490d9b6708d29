"""Question/answer examples: reading, positional split, shards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .. import schemas, settings
from ..operators.numbering import Places, assign_positions
from ..runtime import CODEC, staged
from . import artifacts

_SHARD_DIGITS = 10
# Rows of a shard, and splits in one order, that fit a 64-bit number with the shard's rank.
_MOST_ROWS = 2**26
_MOST_SPLITS = 5
# Texts are the bulk of a shard; pages of 8 MB at this level take a twelfth less room than by default.
_DENSE = {"parquet.page.size": str(2**23), "parquet.compression.codec.zstd.level": "6"}


def read_examples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Labelled examples with an explicit schema; any splittable format."""
    return spark.read.schema(schemas.EXAMPLES).format(fmt).load(path)


def read_json_examples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Examples of a folder of JSON lines, and the lines that are none (damaged), as a written table of both.

    Lines are parsed with the fixed schema in one pass over the files; a line that it does not fit is kept as
    it is instead of ending the job or turning into nulls. Fails if two examples have the same `ord`
    or one has none, since all later order rests on it.
    """
    schema = T.StructType([*schemas.EXAMPLES.fields, T.StructField("damaged", T.StringType())])
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "damaged").json(path)
    table = staged(lines, "examples")
    examples = table.where(F.col("damaged").isNull()).drop("damaged")
    twice = examples.groupBy("ord").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("ord").isNull())
    if not twice.isEmpty():
        raise ValueError(f"rows without an ord of their own: {path}")
    return examples, table.where(F.col("damaged").isNotNull()).select("damaged")


def _positioned(df: DataFrame, order: Sequence[str], position: str | None) -> DataFrame:
    if position is not None:
        return df.withColumn("pos", F.col(position))
    return assign_positions(df, order, "pos")


def split_by_position(
    df: DataFrame,
    order: Sequence[str],
    validation_rows: int = settings.VALIDATION_ROWS,
    position: str | None = None,
) -> DataFrame:
    """First `validation_rows` rows become validation, the others train.

    Adds `split` and `pos`, the dense position inside the split. A source
    that already carries a dense `position` is split without a shuffle.
    """
    numbered = _positioned(df, order, position)
    first = F.col("pos") < validation_rows
    return numbered.withColumn("split", F.when(first, "validation").otherwise("train")).withColumn(
        "pos", F.when(first, F.col("pos")).otherwise(F.col("pos") - validation_rows)
    )


def as_test_split(df: DataFrame, order: Sequence[str], position: str | None = None) -> DataFrame:
    """The source's own evaluation rows, positioned as split `test`."""
    return _positioned(df, order, position).withColumn("split", F.lit("test"))


def with_shards(df: DataFrame, rows: int = settings.SHARD_ROWS) -> DataFrame:
    """Shard number and the row in it: `rows` examples per shard, the last one may be short."""
    if not 0 < rows <= _MOST_ROWS:
        raise ValueError(f"a shard has 1 to {_MOST_ROWS} rows")
    return df.withColumns({
        "shard": F.floor(F.col("pos") / F.lit(rows)).cast("int"), "row": F.pmod(F.col("pos"), F.lit(rows)).cast("int")
    })


def shard_name(shard="shard"):
    return F.concat(F.lit(settings.SHARD_PREFIX), F.col(shard).cast("string"))


def write_shards(
    df: DataFrame, path: str, rows: int = settings.SHARD_ROWS, mode: str = "errorifexists"
) -> None:
    """One directory per split, its rows sorted by shard.

    Positions come range-sorted, so the table is written without a further shuffle, and a filter
    on `shard` skips the row groups of all other shards, however many there are.
    """
    with_shards(df, rows).write.mode(mode).option("compression", CODEC).partitionBy("split").parquet(path)


def _marker(path: str, split: str) -> str:
    return f"{path}/_splits/{split}"


def _require_full(sizes: DataFrame, rows: int, split: str) -> None:
    """All shards but the last are full, or else the source gave other rows when it was read again."""
    last = F.max("shard")
    found = sizes.agg(last.alias("last"), F.sum("rows").alias("n"), F.max("rows").alias("most")).first()
    if found["n"] and (found["most"] > rows or found["last"] + 1 != -(-found["n"] // rows)):
        raise RuntimeError(f"the source of split {split} changed while it was read")


def ensure_shards(
    spark: SparkSession,
    path: str,
    labelled: DataFrame,
    test: DataFrame,
    order: Sequence[str],
    validation_rows: int = settings.VALIDATION_ROWS,
    rows: int = settings.SHARD_ROWS,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write the splits that are missing and return the sharded table.

    `prepare` may turn the rows, one by one, into what is written: wide columns made there are not shuffled.

    A split is there if its marker is, the catalogue of its shards that is written last; a split
    that ended halfway, or that was never begun, is written anew, whatever the others are. A
    split without rows is there with an empty catalogue.
    """
    missing = [s for s in settings.SPLITS if not artifacts.is_complete(spark, _marker(path, s))]
    sources = {}
    if "train" in missing or "validation" in missing:
        both, first = Places(labelled, order), max(0, validation_rows)
        sources["validation"] = both.rows("pos", 0, first)
        sources["train"] = both.rows("pos", first).withColumn("pos", F.col("pos") - first)
    if "test" in missing:
        sources["test"] = Places(test, order).rows("pos")
    for split in missing:
        target = f"{path}/split={split}"
        made = prepare(sources[split]) if prepare else sources[split]
        with_shards(made, rows).write.mode("overwrite").options(compression=CODEC, **_DENSE).parquet(target)
        sizes = staged(spark.read.parquet(target).groupBy("shard").agg(F.count(F.lit(1)).alias("rows")), "sizes")
        _require_full(sizes, rows, split)
        sizes.write.mode("overwrite").parquet(_marker(path, split))
    return read_shards(spark, path)


def read_shards(spark: SparkSession, path: str, splits: Sequence[str] | None = None) -> DataFrame:
    """All shards, or those of the given splits; a split without data adds no row."""
    df = spark.read.parquet(path)
    return df if splits is None else df.where(F.col("split").isin(list(splits)))


def source_order() -> list:
    """Sort keys of a sharded table: shard names sort as text, as directories do."""
    return [F.col("split"), shard_name(), F.col("pos")]


def catalogue(df: DataFrame) -> DataFrame:
    """(split, shard, rows) of a sharded table, counted from its data."""
    return df.groupBy("split", "shard").agg(F.count(F.lit(1)).alias("rows"))


def read_catalogue(spark: SparkSession, path: str, splits: Sequence[str] = settings.SPLITS) -> DataFrame:
    """(split, shard, rows) as `ensure_shards` left it beside the data: nothing of the shards is read.

    Only splits that were written without a catalogue are counted.
    """
    known = [s for s in splits if artifacts.is_complete(spark, _marker(path, s))]
    parts = [
        spark.read.schema("shard int, rows long").parquet(_marker(path, s)).select(F.lit(s).alias("split"), "shard", "rows")
        for s in known
    ]
    if rest := [s for s in splits if s not in known]:
        parts.append(catalogue(read_shards(spark, path, rest)))
    return reduce(DataFrame.unionByName, parts)


def _leading_names(sizes: DataFrame, per_split: int) -> DataFrame:
    """The first `per_split` rows of (split, shard, ...) per split in name order.

    The rank filter runs in each task before the shuffle, so the number of
    shards does not matter.
    """
    names = Window.partitionBy("split").orderBy(shard_name())
    return sizes.withColumn("_n", F.row_number().over(names)).where(F.col("_n") <= per_split)


def _only(df: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows of the given shards by a semi join; the range of their numbers in each split is a filter that the scan pushes down."""
    spans = shards.groupBy("split").agg(F.min("shard").alias("low"), F.max("shard").alias("high")).collect()
    inside = [(F.col("split") == r["split"]) & F.col("shard").between(r["low"], r["high"]) for r in spans]
    if not inside:
        return df.where(F.lit(False))
    return df.where(reduce(or_, inside)).join(shards.select("split", "shard"), ["split", "shard"], "left_semi")


def _leading_shards(df: DataFrame, rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """Shards that hold the first `rows` rows of each split, by running sums over their sizes.

    A shard of the catalogue holds a row at least, so `rows` names per split are enough to add up.
    """
    earlier = Window.partitionBy("split").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    named = _leading_names(catalogue(df) if sizes is None else sizes, rows).withColumn("_before", before)
    return _only(df, named.where(F.col("_before") < rows))


def head(df: DataFrame, rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """First `rows` examples of a sharded table, across its shards in name order.

    `sizes` is the table's catalogue; without it the shards are counted.
    """
    return _leading_shards(df, rows, sizes).orderBy(*source_order()).limit(rows)


def head_per_split(df: DataFrame, rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """First `rows` examples of every split."""
    ranked = Window.partitionBy("split").orderBy(shard_name(), F.col("pos"))
    numbered = _leading_shards(df, rows, sizes).withColumn("_n", F.row_number().over(ranked))
    return numbered.where(F.col("_n") <= rows).drop("_n")


def first_shards(df: DataFrame, per_split: int | None, sizes: DataFrame | None = None) -> DataFrame:
    """Keep the first `per_split` shards of each split in name order; None or 0 keeps all."""
    if not per_split:
        return df
    names = df.select("split", "shard").distinct() if sizes is None else sizes.select("split", "shard")
    return _only(df, _leading_names(names, per_split))


def _text_rank(shard: Column) -> Column:
    """A number that sorts shard numbers like their decimal text: 0, 1, 10, 2.

    Digits become 1 to a and missing ones 0 in base 11, so a prefix comes first.
    """
    digits = F.translate(shard.cast("string"), "0123456789", "123456789a")
    return F.conv(F.rpad(digits, _SHARD_DIGITS, "0"), 11, 10).cast("bigint")


def in_source_order(df: DataFrame, splits: Sequence[str] = settings.SPLITS) -> DataFrame:
    """Set `ord` to sort like split, shard name as text and row, and to differ for all rows.

    The order follows from where a row was written, so nothing is shuffled and nothing about
    the table has to be told.
    """
    if len(splits) > _MOST_SPLITS:
        raise ValueError(f"at most {_MOST_SPLITS} splits")
    place = F.coalesce(*[F.when(F.col("split") == s, F.lit(i)) for i, s in enumerate(splits)])
    shard = place.cast("bigint") * 11**_SHARD_DIGITS + _text_rank(F.col("shard"))
    return df.withColumn("ord", shard * _MOST_ROWS + F.col("row"))


def as_questions(examples: DataFrame) -> DataFrame:
    """Questions with accepted answers: qid, question, aliases, gold and the split, if any."""
    kept = [c for c in ("split",) if c in examples.columns]
    return examples.select(
        F.col("ord").alias("qid"),
        *kept,
        "question",
        F.col("answer.normalized_aliases").alias("aliases"),
        F.col("answer.normalized_value").alias("gold"),
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early when a table is empty."""
    if df.isEmpty():
        raise ValueError(f"no rows found: {what}")
    return df
