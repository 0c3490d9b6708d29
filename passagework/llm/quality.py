"""Quality scores by a sparse ensemble of rules over text statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged

# Labelled rows that the rules are fitted on; with more labels, those of the smallest hash.
FIT_ROWS = 20_000
TREES, DEPTH = 24, 3
LASSO = 0.002
_SYMBOLS = "#%&$*|!~^=+<>{}[]@\\/_"
_STOPS = ".,;:?"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all are defined, also for an empty one."""
    spaced = F.replace(text, F.lit("\n"), F.lit(" "))
    words = F.array_remove(F.split(spaced, " "), "")
    lines = F.array_remove(F.split(text, "\n"), "")
    chars = F.length(text)

    def without(letters: str) -> Column:
        return chars - F.length(F.translate(text, letters, ""))

    def share(part: Column, of: Column) -> Column:
        return part / F.greatest(of, F.lit(1))

    return {
        "chars": chars.cast("double"),
        "words": F.size(words).cast("double"),
        "word_length": share(chars, F.size(words)),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "lines": F.size(lines).cast("double"),
        "line_length": share(chars, F.size(lines)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "upper": share(F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")), chars),
        "symbols": share(without(_SYMBOLS), chars),
        "digits": share(without("0123456789"), chars),
        "stops": share(without(_STOPS), F.size(words)),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds on statistics: (name, is it an upper bound, bound)."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, upper, bound in self.bounds:
            holds = holds & (F.col(name) <= bound if upper else F.col(name) > bound)
        return holds


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; `score` is a plain column expression over `statistics`."""

    weights: dict[Rule, float]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _tightened(bounds: list[tuple[str, bool, float]]) -> Rule:
    """One bound for each statistic and side, in a fixed order."""
    best: dict[tuple[str, bool], float] = {}
    for name, upper, bound in bounds:
        known = best.get((name, upper))
        best[name, upper] = bound if known is None else (min if upper else max)(known, bound)
    return Rule(tuple((n, u, b) for (n, u), b in sorted(best.items())))


def _paths(node, names: list[str], above: list[tuple[str, bool, float]]) -> list[Rule]:
    """Rules of all nodes below the root of a fitted tree."""
    rules = [_tightened(above)] if above else []
    if node.numDescendants():
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        rules += _paths(node.leftChild(), names, [*above, (name, True, bound)])
        rules += _paths(node.rightChild(), names, [*above, (name, False, bound)])
    return rules


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> RuleModel:
    """Rules and weights from `labels` (doc_id, label 0 or 1) of documents.

    At most `rows` labelled documents are used. Trees give the rules: one for each path from
    a root. A logistic model with a lasso penalty weights them, and rules of weight 0 are left
    out. Rows with a null id or label take no part; of an id with several labels the smallest
    counts. If the labels are all alike the score is their share everywhere (0.5 without any).
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most `rows` rows of two numbers: a bounded broadcast.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sample = (
        docs.select("doc_id", text.alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select(F.col("label").cast("double").alias("label"), *(c.alias(n) for n, c in statistics(F.col("text")).items()))
    )
    sample = staged(sample, "quality-sample")
    names = [c for c in sample.columns if c != "label"]
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    total = sum(seen.values())
    if len(seen) < 2:
        share = (seen.get(1.0, 0) + 0.5) / (total + 1)
        return RuleModel({}, math.log(share / (1 - share)))
    vector = VectorAssembler(inputCols=names, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="onethird", maxBins=64)
    trees = forest.fit(vector.transform(sample)).trees
    rules = sorted({r for t in trees for r in _paths(t._call_java("rootNode"), names, [])}, key=lambda r: r.bounds)
    held = sample.select("label", *(r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    held = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60)
    model = lasso.fit(held.select("label", "features"))
    weights = {r: float(w) for r, w in zip(rules, model.coefficients) if w}
    return RuleModel(weights, float(model.intercept))


def in_fold(doc_id: Column) -> Column:
    """True for rows that are held out of fitting: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _judged(docs: DataFrame, model: RuleModel, text: str) -> DataFrame:
    """Each row as `_row`, whatever its columns are called, with its `_score` and `_place`; null texts count as empty."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    found = docs.select(row, *(c.alias(n) for n, c in statistics(plain).items()))
    # Rows are numbered so that a filter on the score stays above it: pushed below, it would work
    # out the statistics again for each bound of each rule.
    return found.select("_row", model.score().alias("_score"), F.monotonically_increasing_id().alias("_place"))


def score(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """`docs` with columns score and predicted, which take the place of columns of these names."""
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("score", "predicted")]
    value = F.col("_score")
    return _judged(docs, model, text).select(
        *kept, value.alias("score"), (value >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """The rows of `docs`, with their columns, that score 0.5 or more."""
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns]
    return _judged(docs, model, text).where((F.col("_score") >= 0.5) & (F.col("_place") >= 0)).select(*kept)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document, fitted on the rows not held out."""
    shown = labels.where(~in_fold(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    model = fit(docs, shown)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
