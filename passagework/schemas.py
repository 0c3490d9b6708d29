"""Schemas of the tables that jobs exchange."""

from pyspark.sql import types as T

ANSWER = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("normalized_value", T.StringType()),
    T.StructField("aliases", T.ArrayType(T.StringType())),
    T.StructField("normalized_aliases", T.ArrayType(T.StringType())),
])

ENTITY_PAGES = T.StructType([
    T.StructField("title", T.ArrayType(T.StringType())),
    T.StructField("wiki_context", T.ArrayType(T.StringType())),
])

# `ord` is the position in the source; every order-sensitive step uses it.
EXAMPLES = T.StructType([
    T.StructField("ord", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", ANSWER),
    T.StructField("entity_pages", ENTITY_PAGES),
])

PAGES = T.StructType([
    T.StructField("example_ord", T.LongType()),
    T.StructField("page_pos", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])

PASSAGES = T.StructType([
    T.StructField("passage_id", T.LongType()),
    T.StructField("passage", T.StringType()),
])

INDEX = T.StructType([
    *PASSAGES.fields,
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

RUN_INDEX = T.StructType([
    *INDEX.fields,
    T.StructField("chunk_tokens", T.IntegerType()),
    T.StructField("chunk_overlap", T.IntegerType()),
    T.StructField("run", T.IntegerType()),
])

EVAL_LOG = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("gold", T.StringType()),
    T.StructField("aliases", T.ArrayType(T.StringType())),
    T.StructField("predicted", T.StringType()),
    T.StructField("retrieved", T.ArrayType(T.StringType())),
    T.StructField("exact_match", T.IntegerType()),
    T.StructField("f1", T.DoubleType()),
])
