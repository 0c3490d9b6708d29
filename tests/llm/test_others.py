"""Quality rules, nearest neighbours, URL rules, fingerprints and the pipeline."""

import hashlib
import random
import unicodedata
import zlib
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from odd import none, odd_docs, rows_of
from passagework.llm import fingerprints, neighbours, quality, queries, url_rules
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


# Quality

def test_held_out_accuracy(spark, sf_dir):
    got = queries.op1_quality_classifier(spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.85 * len(held)


def test_quality_without_use(spark):
    docs = odd_docs(spark)
    scored = quality.classify(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(scored) == docs.count() and {r.score for r in scored} == {0.5}
    odd_labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 0, 0), (2, None, 0), (3, 1, 0)], LABELS)
    assert all(r.score > 0.5 for r in quality.classify(docs, odd_labels).collect())
    assert quality.classify(none(spark), odd_labels).collect() == []


def plain_statistics(t):
    words = [w for w in t.replace("\n", " ").split(" ") if w]
    lines = [x for x in t.split("\n") if x]
    n, w, k = len(t), max(1, len(words)), max(1, len(lines))
    return {
        "chars": n, "words": len(words), "word_length": n / w, "distinct_words": len(set(words)) / w,
        "lines": len(lines), "line_length": n / k, "distinct_lines": len(set(lines)) / k,
        "upper": sum(unicodedata.category(c) == "Lu" for c in t) / max(1, n),
        "symbols": sum(c in quality._SYMBOLS for c in t) / max(1, n), "digits": sum(c in "0123456789" for c in t) / max(1, n),
        "stops": sum(c in quality._STOPS for c in t) / w,
    }


def test_scores_recomputed_from_the_rules(spark, sf_dir):
    """Statistics, rules and the logistic sum, once more by loops over the texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.in_fold(F.col("doc_id")))
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    assert model.weights and all(model.weights.values())
    scored = {r.doc_id: r.score for r in queries.op1_quality_classifier(spark, sf_dir).collect()}
    for i, t in rows_of(docs):
        values, total = plain_statistics(t or ""), model.intercept
        for rule, weight in model.weights.items():
            if all((values[name] <= bound) == upper for name, upper, bound in rule.bounds):
                total += weight
        assert scored[i] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)
    # Every rule is a path of a tree that was fitted: no statistic has two bounds of one side.
    assert all(len({(n, u) for n, u, _ in r.bounds}) == len(r.bounds) <= 2 * quality.DEPTH for r in model.weights)


def test_quality_keeps_columns(spark):
    docs = odd_docs(spark)
    model = quality.RuleModel({quality.Rule((("words", False, 3.0),)): 2.0}, -1.0)
    scored = quality.score(docs, model)
    assert scored.columns == [*docs.drop("score").columns, "score", "predicted"]
    assert quality.accepted(docs, model).columns == docs.columns
    assert quality.accepted(docs, model).count() == scored.where("predicted = 1").count()
    for r in scored.collect():
        assert r.predicted == int(len((r.text or "").replace("\n", " ").split(" ")) - (r.text or "").replace("\n", " ").split(" ").count("") > 3)


# Neighbours

def brute_neighbours(rows, every=100, k=10):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((i, np.array(v, float)))
    out = {}
    for i, v in good:
        if i % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in good if j != i)[:k]
            out[i] = near
    return out


def test_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = brute_neighbours([(r.vec_id, r.embedding) for r in table.collect()])
    got = {}
    for r in queries.op2_ann_search(spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert got.keys() == want.keys()
    hits = 0
    for q, near in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        hits += len({v for _, v in near} & {v for _, _, v in found})
    assert hits >= 0.9 * 10 * len(want)


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist(), "x") for i in range(300)]
    rows += [(i, [1.0] * 6, "copy") for i in range(300, 700)]
    rows += [(700, None, ""), (800, [0.0] * 6, ""), (900, [1.0, None, 2.0, 3.0, 4.0, 5.0], ""), (1000, [float("nan")] * 6, ""),
             (1100, [float("inf")] * 6, ""), (1200, [1.0, 2.0], ""), (None, [1.0] * 6, ""), (100, rows[100][1], "again")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(4)
    single = [(i, None if v is None else np.array([np.nan if x is None else x for x in v], np.float32).tolist()) for i, v, _ in rows if v is None or len(v) == 6]
    want = brute_neighbours({i: (i, v) for i, v in single}.values())
    found = {}
    for r in neighbours.nearest(table, confidence=0.999999, cell_rows=64, fit_rows=200).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert {q: [(s, v) for _, s, v in sorted(f)] for q, f in found.items()} == want
    assert neighbours.nearest(table.limit(0)).collect() == []
    few = neighbours.nearest(table.where("vec_id IN (0, 5, 6)")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2)]


def test_copies_given_many_times(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(100, 200)]
    rows += [(i, [1.0] * 6) for i in range(1, 21) for _ in range(12)] + [(i, [2.0] * 6) for i in range(200, 221) for _ in range(2)]
    want = brute_neighbours(dict(rows).items(), every=20)
    found = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), every=20, confidence=0.999999).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert {q: [(s, v) for _, s, v in sorted(f)] for q, f in found.items()} == want


def test_quantile():
    # Fixed values of chi-square tables.
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_quantile(0.99, 2) == pytest.approx(9.210, abs=1e-3)


# URLs

def plain_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule in url_rules.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.text) > len(best.text):
                best = rule
    return host, path, best


def test_registered_urls(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.op3_url_filter(spark, sf_dir).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule = plain_judge(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")


def test_odd_urls(spark):
    urls = [None, "", "abc", "http://A.Example.com/en/x#f", "ftp://example.com?x/en/", "x://www.example.com/en/", "http://org.net/es/://b",
            "://com/", "http://com", "http://notcom/", "http://ÀB.com/Ä?q=1&b&=c#", "http://example.net/fr/" + "a" * 5000]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[3], "h"), (3, urls[3], "h")], "page_id long, url string, host string")
    got = url_rules.judge(pages, spark.createDataFrame([], "url string, bad boolean")).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is not None:
            host, path, rule = plain_judge(urls[r.page_id])
            assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule.text if rule else None, rule.verdict if rule else "allow")


def test_mined_rules(spark):
    rows = [(i, f"https://b{i % 7}.example.org/{'casino' if i % 3 == 0 else 'news'}/{i}?ref=1") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labelled = pages.where("page_id < 500").withColumn("bad", F.col("url").contains("casino") & (F.col("page_id") % 7 < 3)).select("url", "bad")
    mined = {tuple(r.tokens): r for r in url_rules.mine(labelled, 20, 0.9).collect()}
    # Brute force over all sets of tokens.
    tokens = [(set(r.t), r.bad) for r in labelled.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    good = {}
    for size in (1, 2, 3, 4):
        for items in combinations(sorted({t for s, _ in tokens for t in s}), size):
            held = [bad for s, bad in tokens if s.issuperset(items)]
            if sum(held) >= 20 and sum(held) >= 0.9 * len(held):
                if not any(set(g) < set(items) for g in good):
                    good[items] = sum(held) / len(held)
    assert mined.keys() == good.keys()
    blocked = {r.page_id for r in url_rules.judge(pages, labelled, confidence=0.9).where("verdict = 'block'").collect()}
    assert blocked == {i for i, u in rows if "casino" in u and i % 7 < 3}


@pytest.mark.parametrize("n", [1000, 6000, 50_000])
def test_the_same_pages_make_a_rule_at_every_size(spark, n):
    rows = spark.range(n).select(
        F.when(F.col("id") < 20, F.concat(F.lit("http://bad.example/"), F.col("id")))
        .otherwise(F.concat(F.lit("http://h"), F.col("id") % 97, F.lit(".example/"), F.col("id"))).alias("url"),
        (F.col("id") < 20).alias("bad"),
    )
    assert ["h:bad"] in [r.tokens for r in url_rules.mine(rows).collect()]
    assert url_rules.mine(rows.where("url <> 'http://bad.example/7'")).count() == 0


# Fingerprints

def check_fingerprints(rows, got):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = {}
    for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1]):
        edited = t[: len(t) - len(t) // 4] + n[: len(t) // 4]
        own, next_, changed = fingerprints.sketches([t.encode(), n.encode(), edited.encode()])
        want.setdefault(i, []).append((
            len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.printed(own), fingerprints.printed(changed),
            fingerprints.likeness(own, changed), fingerprints.likeness(own, next_),
        ))
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next))
    assert {i: sorted(x) for i, x in found.items()} == {i: sorted(x) for i, x in want.items()}


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_odd_fingerprints(spark, parts):
    docs = odd_docs(spark)
    check_fingerprints(rows_of(docs), fingerprints.fingerprints(docs, parts=parts).collect())


def test_fingerprints_of_few(spark):
    assert fingerprints.fingerprints(none(spark)).collect() == []
    docs = odd_docs(spark).where("doc_id = 1")
    check_fingerprints(rows_of(docs), fingerprints.fingerprints(docs).collect())


def test_registered_fingerprints(spark, sf_dir):
    got = queries.op4_fingerprints(spark, sf_dir).collect()
    check_fingerprints(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), got)
    long = [r for r in got if r.n_chars > 400]
    assert np.mean([r.near_edited for r in long]) > 0.5 > 0.1 > np.median([r.near_next for r in long])


def test_interior_names_ignore_offset():
    text = " ".join(f"w{i * 7919 % 499}" for i in range(600)).encode()
    a, b = fingerprints.sketches([text, b"some other words first " + text + b" and last"], size=10**6)
    assert len(np.intersect1d(a, b)) >= 0.97 * len(a)


def plain_sketch(data):
    """Phrase names by loops over one text, with Python's own numbers."""
    low = (1 << 64) - 1
    odd = 0x9E3779B97F4A7C15

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & low
        x = (x ^ x >> 27) * 0x94D049BB133111EB & low
        return x ^ x >> 31

    names, taken = list(data), set()
    for level in range(1, 6):
        runs = []
        for x in names:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        if level == 1:
            weights = [mix(x + 256) if n == 1 else mix(x + (n << 8)) for x, n in runs]
        else:
            weights = [mix(x ^ mix(n)) for x, n in runs]
        label = [x for x, _ in runs]
        for _ in range(3 if level == 1 else 4):
            tossed = []
            for i, x in enumerate(label):
                differ = x ^ (label[i - 1] if i else x ^ 1)
                place = (differ & -differ).bit_length() - 1
                tossed.append(2 * place + (x >> place & 1))
            label = tossed
        cuts = [0] + [i for i in range(1, len(label) - 1) if label[i - 1] < label[i] >= label[i + 1]] + [len(label)]
        names = []
        for a, b in zip(cuts, cuts[1:]):
            hashed = sum(w * pow(odd, k + 1, 1 << 64) for k, w in enumerate(weights[a:b])) & low
            names.append(mix(hashed + (b - a) & low))
        if level > 1:
            taken.update(x >> 32 for x in names)
    return sorted(taken)[:128]


def test_parsing_by_a_plain_loop():
    rnd = random.Random(7)
    texts = ["a", "aa", "ab", "aaaa" * 50, "abab" * 40, "é ü 中文 😀 " * 9] + [
        "".join(rnd.choices("abcdefgh  ,.\n", k=rnd.randrange(1, 3000))) for _ in range(40)]
    data = [t.encode() for t in texts] + [b""]
    assert [x.tolist() for x in fingerprints.sketches(data)] == [plain_sketch(d) if d else [] for d in data]


# Pipeline

def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near-copies", "passages", "packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, corpus_pipeline.staged(stage(spark, now, sf_dir), f"test-{name}")
        if name != "packing":
            assert now.dtypes == docs.dtypes
        ids = [r.doc_id for r in now.select("doc_id").collect()]
        if name == "quality":
            good = [i for i, q in labels.items() if q == 1]
            assert len(set(good) & set(ids)) >= 0.97 * len(good)
        if name in ("lines", "passages"):
            assert sorted(ids) == sorted(r.doc_id for r in before.select("doc_id").collect())
        if name == "near-copies":
            texts = [r.text for r in now.collect()]
            assert len(set(texts)) == len(texts)
    assert now.agg(F.count_distinct("doc_id")).first()[0] == before.count()


@pytest.mark.parametrize("name", ["quality", "lines", "near-copies", "passages", "packing"])
def test_stages_take_odd_tables(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (odd_docs(spark), none(spark)):
        out = stage(spark, docs, sf_dir)
        assert name == "packing" or out.columns == docs.columns
        assert out.count() <= docs.count() or name == "packing"
