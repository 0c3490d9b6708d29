"""URL filtering by fixed rules and by association rules mined from labelled pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged

# Labelled bad pages that a rule needs, however many pages there are.
SUPPORT = 20
CONFIDENCE = 0.8
_BLOCK = "!block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """Fits `host`, all its subdomains, and paths that begin with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From after the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _choose(rules: tuple[UrlRule, ...], of) -> Column:
    """Value of the longest fitting rule; null if none fits. Ties: the longer host, then by text."""
    found = F.lit(None).cast("string")
    host, path = F.col("host"), F.col("path")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, of(rule)).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels, words of the path, names of query fields, and a fragment's presence.

    Plain numbers are left out: they name single pages.
    """
    def words(part: Column, mark: str) -> Column:
        found = F.filter(F.split(part, r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.rlike(r"^\d+$"))
        return F.transform(found, lambda w: F.concat(F.lit(mark), w))

    rest = _after_scheme(url)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda f: F.substring_index(f, "=", 1)), lambda n: n != "")
    return F.array_distinct(F.concat(
        F.transform(F.filter(F.split(host_of(url), r"\."), lambda w: w != ""), lambda w: F.concat(F.lit("h:"), w)),
        words(path_of(url), "p:"),
        F.transform(names, lambda n: F.concat(F.lit("q:"), n)),
        F.when(F.instr(rest, "#") > 0, F.array(F.lit("#"))).otherwise(F.array().cast("array<string>")),
    ))


def mine(
    labelled: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE,
) -> DataFrame:
    """Rules (tokens, support, confidence) that call for a block, from rows (url, bad).

    FP-growth over the tokens of each URL and its label: sets that `support` bad URLs or more hold, whatever
    the number of all, of whose URLs at least `confidence` are bad. A rule that contains
    another one is left out.
    URLs that are null or have no token teach nothing; an empty table gives no rule.
    """
    tokens = tokens_of(F.col("url"))
    baskets = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select(
        F.when(F.col("bad"), F.concat(tokens, F.array(F.lit(_BLOCK)))).otherwise(tokens).alias("items")
    ).where(F.size("items") > 0)
    # A little less than the share of `support` URLs, so that rounding does not ask for one more.
    needed = min(1.0, max(support - 0.5, 0.5) / max(1, baskets.count()))
    model = FPGrowth(itemsCol="items", minSupport=needed, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.element_at("consequent", 1) == _BLOCK)
    rules = staged(rules.select(F.sort_array("antecedent").alias("tokens"), "support", "confidence"), "url-rules")
    wider = rules.alias("a").join(
        rules.alias("b"),
        (F.size("b.tokens") < F.size("a.tokens")) & (F.size(F.array_except("b.tokens", "a.tokens")) == 0),
        "left_anti",
    )
    return wider.select("tokens", "support", "confidence")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct `url` that hold all tokens of a rule, by an inverted index.

    Each rule is listed under one token only, its rarest among the rules, so that a frequent token
    of many rules doesn't call them all up; its other tokens are compared where that one is met.
    """
    often = rules.select(F.explode("tokens").alias("token")).groupBy("token").count()
    listed = (
        rules.select("tokens", F.explode("tokens").alias("token")).join(often, "token")
        .groupBy("tokens").agg(F.min_by("token", F.struct("count", "token")).alias("token"))
        .groupBy("token").agg(F.collect_list("tokens").alias("rules"))
    )
    held = urls.where("url IS NOT NULL").select("url").distinct().withColumn("held", tokens_of(F.col("url")))
    met = held.select("url", "held", F.explode("held").alias("token")).join(listed, "token")
    fits = F.exists("rules", lambda r: F.size(F.array_except(r, "held")) == 0)
    return met.where(fits).select("url").distinct()


def judge(
    pages: DataFrame, labelled: DataFrame, rules: tuple[UrlRule, ...] = RULES, key: str = "page_id", url: str = "url",
    support: int = SUPPORT, confidence: float = CONFIDENCE,
) -> DataFrame:
    """key, host, path, rule and verdict of each page's URL.

    The longest of the fixed `rules` that fits decides. Where none fits, rule is null and the
    verdict is block if a rule mined from `labelled` (url, bad) matches, else allow. A URL that is
    null or has no `://` has an empty host and path, no tokens, and is allowed. One
    row for each row of `pages`; other columns are not read.
    """
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumns(
        {"rule": _choose(rules, lambda r: F.lit(r.text)), "given": _choose(rules, lambda r: F.lit(r.verdict))}
    )
    mined = mine(labelled, support, confidence)
    if mined.isEmpty():
        by_method = F.lit("allow")
    else:
        hit = matched(rows.where("given IS NULL"), mined).withColumn("hit", F.lit(True))
        rows = rows.join(hit, "url", "left")
        by_method = F.when(F.col("hit"), "block").otherwise("allow")
    return rows.select(
        F.col("_key").alias(key), "host", "path", "rule", F.coalesce("given", by_method).alias("verdict")
    )


def judge_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Rules mined from pages whose id has a label: bad if of low quality or toxic."""
    bad = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    labelled = pages.select(F.col("page_id").alias("_id"), F.col("url").cast("string").alias("url")).join(bad, "_id")
    return judge(pages, labelled.select("url", "bad"))
