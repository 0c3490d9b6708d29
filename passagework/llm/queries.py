"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe_codec import decode_ids, encode_texts
from .collocations import collocations
from .conversations import damaged, repair
from .fingerprints import fingerprints
from .jaccard import join_texts
from .line_dedup import line_report
from .neighbours import nearest
from .packing import pack_documents
from .phrase_dedup import phrase_report
from .quality import classify
from .suffix_dedup import report
from .token_counts import count_tokens
from .url_rules import judge_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_texts(table(spark, sf_dir, "documents"))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = decode_ids(encode_texts(table(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_report(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ann_search": op2_ann_search,
    "op3_url_filter": op3_url_filter,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_collocations": op11_collocations,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
# What SQL can say of these. The others depend on trained rules, vocabularies, random projections
# or edit distances of code points, and are held against brute force in the tests.
ORACLES = {
    "op7_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d),
s AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte,
         CASE WHEN 2 * i + 200 <= length(h) THEN md5(substr(h, 2 * i + 1, 200)) END AS gram FROM b),
r AS (
  SELECT *, gram IS NOT NULL AND row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1 AS again FROM s),
c AS (
  SELECT *, max(again::INTEGER) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) = 1 AS gone FROM r),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM c),
t AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed, count(*) FILTER (begins) AS spans,
         string_agg(CASE WHEN gone THEN '' ELSE byte END, '' ORDER BY i) AS kept
  FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)""",
    "op9_jaccard_join": """
WITH RECURSIVE texts AS (
  SELECT coalesce(text, '') AS t, min(doc_id) AS id FROM documents GROUP BY ALL),
w AS (
  SELECT id, list_filter(string_split_regex(lower(t), '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS w FROM texts),
runs AS (
  SELECT DISTINCT id, array_to_string(w[i : i + 4], ' ') AS run
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM w)),
sizes AS (SELECT id, count(*) AS n FROM runs GROUP BY id),
both_ AS (
  SELECT a.id AS x, b.id AS y, count(*) AS m FROM runs a JOIN runs b ON a.run = b.run AND a.id <> b.id GROUP BY ALL),
links AS (
  SELECT x, y FROM both_ JOIN sizes p ON p.id = x JOIN sizes q ON q.id = y WHERE m >= 0.8 * (p.n + q.n - m)),
reached(id, other) AS (
  SELECT id, id FROM texts UNION SELECT r.id, y FROM reached r JOIN links ON x = other),
classes AS (SELECT id, min(other) AS class_id FROM reached GROUP BY id),
counts AS (SELECT x AS id, count(*) AS n_links FROM links GROUP BY x)
SELECT d.doc_id, c.class_id, coalesce(n_links, 0) AS n_links
FROM documents d JOIN texts t ON t.t = coalesce(d.text, '') JOIN classes c ON c.id = t.id
LEFT JOIN counts k ON k.id = t.id""",
    "op11_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS m FROM i),
f AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 100),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r, n,
         (1000::HUGEINT * k.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1 : k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1 :], ' ')
  JOIN t ON t.lang = k.lang),
least_ AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
j AS (SELECT lang, a, w, m, unnest(range(2, m)) AS q FROM c),
b AS (SELECT lang, a, w, q, unnest(range(1, m - q + 2)) AS b FROM j),
inner_ AS (SELECT lang, array_to_string(w[b : b + q - 1], ' ') AS phrase, max(a) AS around FROM b GROUP BY ALL),
o AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM least_ LEFT JOIN inner_ USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM o WHERE rank <= 2000""",
    "op12_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\f\v]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN md5(array_to_string(w[i : i + 19], ' ')) END AS run FROM b),
r AS (SELECT *, run IS NOT NULL AND row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1 AS again FROM g),
c AS (
  SELECT *, max(again::INTEGER) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 1 AS gone FROM r),
t AS (
  SELECT doc_id, count(*) FILTER (gone) AS removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)""",
}
