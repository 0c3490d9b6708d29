"""Dataset profiling: sizes, types, text lengths, labels, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import settings
from ..functions import text as tx
from ..functions.binding import sequence_key
from ..runtime import staged

_BINS = 30


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the number of rows."""
    listed = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(listed))


def sample_rows(df: DataFrame, order: str, n: int = 3, limit: int = settings.PREVIEW_CHARS) -> DataFrame:
    """First `n` rows with every string, nested ones too, cut to `limit` characters."""
    first = df.orderBy(order).limit(n)
    return first.select(
        *[tx.clip_nested(F.col(f.name), f.dataType, limit).alias(f.name) for f in df.schema.fields]
    )


def text_stats(df: DataFrame) -> DataFrame:
    """Mean, shortest and longest word count of each top-level string column.

    One scan and one aggregation for all columns; nulls are left out.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, mean_words double, min_words int, max_words int")
    counts = df.select(*[tx.word_count(F.col(n)).alias(n) for n in names])
    stats = counts.agg(*[
        F.struct(
            F.lit(n).alias("column"),
            F.avg(n).alias("mean_words"),
            F.min(n).alias("min_words"),
            F.max(n).alias("max_words"),
        ).alias(n)
        for n in names
    ])
    return stats.select(F.inline(F.array(*[F.col(n) for n in names])))


def _or_next(*choices: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices[:-1]], choices[-1])


def _label(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.StructType):
        return value.cast("string")
    named = [value[n].cast("string") for n in ("normalized_value", "value") if n in kind.names]
    return _or_next(*named, F.to_json(value))


def _most_common(items: DataFrame, n: int) -> DataFrame:
    """Most frequent items, the first seen first on a tie.

    Counts and first places are combined per task before the shuffle.
    """
    return (
        items.groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("_place"))
        .orderBy(F.desc("n"), "_place")
        .limit(n)
        .drop("_place")
    )


def top_labels(df: DataFrame, order: str = "ord", n: int = 10) -> DataFrame:
    """Most frequent labels of `answer`, or of `answers` if there is no such column."""
    column = next((c for c in ("answer", "answers") if c in df.columns), None)
    if column is None:
        raise ValueError("no answer column")
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        items = df.select(order, F.posexplode(column).alias("_pos", "_item"))
        label = _label(F.col("_item"), kind.elementType)
    else:
        items = df.select(order, F.lit(0).alias("_pos"), F.col(column).alias("_item"))
        label = _label(F.col("_item"), kind)
    placed = items.select(
        label.alias("item"), sequence_key(F.col(order), F.col("_pos")).alias("_place")
    )
    return _most_common(placed, n)


def common_answers(df: DataFrame, order: str = "ord", n: int = 10) -> DataFrame:
    """Most frequent answer strings: aliases if there are any, else the value."""
    kind, column = df.schema["answer"].dataType, F.col("answer")
    if isinstance(kind, T.StructType) and "aliases" in kind.names:
        column = F.col("answer.aliases")
        listed = True
    elif isinstance(kind, T.StructType):
        column = column["value"].cast("string") if "value" in kind.names else F.to_json(column)
        listed = False
    else:
        listed = isinstance(kind, T.ArrayType)
    if listed:
        items = df.select(order, F.posexplode(column).alias("_pos", "item"))
    else:
        items = df.select(order, F.lit(0).alias("_pos"), column.cast("string").alias("item"))
    placed = items.select("item", sequence_key(F.col(order), F.col("_pos")).alias("_place"))
    return _most_common(placed, n)


def _field_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        inner = F.get(value, F.lit(0))
        if isinstance(kind.elementType, T.StructType):
            inner = inner["value"] if "value" in kind.elementType.names else F.to_json(inner)
        return F.when(value.isNull(), "None").when(F.size(value) == 0, "").otherwise(inner)
    if isinstance(kind, T.StructType):
        inner = value["value"] if "value" in kind.names else F.to_json(value)
        return F.when(value.isNull(), "None").otherwise(inner)
    return F.coalesce(value.cast("string"), F.lit("None"))


def field_lengths(df: DataFrame, field: str) -> DataFrame:
    """Frequency table (n_words, n_rows) of a field's length in words.

    One scan, and as many result rows as there are distinct lengths; means
    and histograms are computed from it. A value without a length (the first of a list, or
    the value of a struct, is null) is left out.
    """
    length = tx.word_count(_field_text(F.col(field), df.schema[field].dataType))
    known = df.select(length.alias("n_words")).where(F.col("n_words").isNotNull())
    return known.groupBy("n_words").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def mean_length(lengths: DataFrame) -> DataFrame:
    words = F.sum(F.col("n_words").cast("bigint") * F.col("n_rows"))
    return lengths.agg(F.try_divide(words, F.sum("n_rows")).alias("mean_words"))


def length_histogram(lengths: DataFrame, bins: int = _BINS) -> DataFrame:
    """Equal-width bins over the observed range; the last bin includes its end.

    With one observed length the range is that length plus and minus a half.
    """
    spark = lengths.sparkSession
    # A few rows, kept so that the range and the bins share one scan of the data.
    lengths = staged(lengths, "lengths")
    low, high = lengths.agg(F.min("n_words"), F.max("n_words")).first()
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, n_rows bigint")
    low, high = (low - 0.5, high + 0.5) if low == high else (float(low), float(high))
    width = high - low

    def edge(i):
        return F.when(i == bins, F.lit(high)).otherwise(i * F.lit(width / bins) + F.lit(low))

    x = F.col("n_words").cast("double")
    rough = F.least(
        F.lit(bins - 1), F.floor((x - F.lit(low)) / F.lit(width) * F.lit(bins)).cast("int")
    )
    # The division may land one bin off; the edges decide.
    placed = lengths.withColumn("_bin", rough)
    b = F.col("_bin")
    exact = (
        F.when(x < edge(b), b - 1).when((x >= edge(b + 1)) & (b < bins - 1), b + 1).otherwise(b)
    )
    counted = placed.groupBy(exact.alias("bin")).agg(F.sum("n_rows").alias("n_rows"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    i = F.col("bin")
    return every.join(counted, "bin", "left").select(
        "bin",
        edge(i).alias("low"),
        edge(i + 1).alias("high"),
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )


def sample_qa(df: DataFrame, order: str = "ord", n: int = 20, aliases: int = 3) -> DataFrame:
    """First `n` questions with their first accepted answers in one string."""
    question = _field_text(F.col("question"), df.schema["question"].dataType)
    kind = df.schema["answer"].dataType
    if isinstance(kind, T.StructType) and "aliases" in kind.names:
        accepted = F.col("answer.aliases")
    elif isinstance(kind, T.ArrayType):
        accepted = F.col("answer")
    else:
        accepted = F.array().cast("array<string>")
    return (
        df.orderBy(order)
        .limit(n)
        .select(
            order,
            question.alias("question"),
            F.array_join(F.slice(accepted, 1, aliases), ", ").alias("answers"),
        )
    )
