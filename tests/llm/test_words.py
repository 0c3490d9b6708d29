"""Collocations and word-sequence dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from odd import none, odd_docs, rows_of
from passagework.llm import collocations, phrase_dedup
from passagework.llm.collocations import Summary
from passagework.llm.phrase_dedup import ReferenceBlock

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest=5):
    """Occurrences of each phrase and number of words, by lang."""
    found, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        here = found.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            here.update(tuple(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    return found, words


def best_phrases(rows, threshold, top, percent=100):
    out = []
    found, words = counted(rows)
    for lang, f in found.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        inside = {
            p[i : i + m] for p, a in chosen.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= percent * chosen[p[i : i + m]]
        }
        scored = []
        for p in chosen.keys() - inside:
            score, k = min((1000 * chosen[p] * words[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -chosen[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def chatter(spark):
    rnd = random.Random(11)
    words = ["a", "B", "é", "the", "x\x00", " ", "THE"]
    rows = [
        (rnd.choice(["en", "de", None, "und"]), None if rnd.random() < 0.1 else "".join(
            rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", ", ", "\n", "  ", "?"]) for _ in range(rnd.randrange(60))))
        for _ in range(90)
    ]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "lang string, text string, n long, phrase long, part long").repartition(5), rows


@pytest.mark.parametrize("threshold, top, options", [
    (5, 30, {}), (20, 2000, {}), (1, 2000, {}), (5, 2000, {"counters": 3, "word_bits": 32768, "phrase_bits": 32768}), (5, 100, {"percent": 60}),
])
def test_collocations(chatter, threshold, top, options):
    docs, rows = chatter
    got = sorted(tuple(r) for r in collocations.collocations(docs, threshold=threshold, top=top, **options).collect())
    assert got == best_phrases(rows, threshold, top, options.get("percent", 100))


def test_collocations_of_odd_documents(spark):
    docs = odd_docs(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(tuple(r) for r in collocations.collocations(docs, threshold=2).collect()) == best_phrases(rows, 2, 2000)
    assert collocations.collocations(none(spark)).collect() == []


def test_exact_products(spark):
    """Counts whose products pass 64 bits."""
    text = "a b, " * 1500
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    row, = collocations.collocations(docs).collect()
    assert tuple(row) == ("en", 1, "a b", 1500, 1500, 1500, 3000, 2000)
    joined = spark.sql("SELECT (1000 * CAST(a AS decimal(19,0)) * CAST(a AS decimal(19,0))) div (CAST(a - 1 AS decimal(19,0)) * CAST(a AS decimal(19,0))) AS s FROM (SELECT 9000000000000L AS a)")
    assert joined.first()["s"] == 1000


@pytest.mark.parametrize("capacity", [1, 7, 60])
def test_summary_keeps_all_frequent_keys(capacity):
    rnd = np.random.default_rng(capacity)
    stream = np.concatenate([rnd.integers(0, 5000, 20_000), np.repeat(np.arange(40), 120)]).astype(np.uint32)
    rnd.shuffle(stream)
    summary = Summary(capacity, 25)
    for part in np.array_split(stream, 37):
        summary.merge(*(x.astype(t) for x, t in zip(np.unique(part, return_counts=True), (np.uint32, np.int64))))
    kept = set(summary.frequent(100).tolist())
    true = Counter(stream.tolist())
    assert summary.error <= 25
    assert {k for k, n in true.items() if n >= 100} <= kept <= {k for k, n in true.items() if n >= 75}
    known = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert all(known.get(k, 0) <= n <= known.get(k, 0) + summary.error for k, n in true.items())


def without_repeats(rows, window=20):
    """(key, n_words, n_removed, digest) by one pass over all windows in order of the keys."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.add(run)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((key, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("vocabulary", [["a", "b", "cc", "d\x00", "é", "😀", "x.y", " "], ["a"], ["a", "b"]])
@pytest.mark.parametrize("options", [{}, {"block_segments": 2}, {"bits": 32768}, {"window": 5, "anchor": 2}, {"window": 4, "anchor": 4}])
def test_repeated_sequences(spark, vocabulary, options):
    rnd = random.Random(5)
    passages = [[rnd.choice(vocabulary) for _ in range(60)] for _ in range(5)]
    rows = [(100, None), (101, ""), (102, " \n")]
    for i in range(60):
        words = []
        for _ in range(rnd.randrange(5)):
            begin = rnd.randrange(50)
            words += rnd.choice(passages)[begin : begin + rnd.randrange(60)] + [rnd.choice(vocabulary) for _ in range(rnd.randrange(8))]
        rows.append((i * 3 % 61, rnd.choice([" ", "\n", "\t "]).join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(tuple(r) for r in phrase_dedup.phrase_report(docs, **options).collect())
    assert got == without_repeats(rows, options.get("window", 20))


def test_repeated_sequences_of_odd_documents(spark):
    docs = odd_docs(spark)
    got = {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in phrase_dedup.phrase_report(docs).collect()}
    # The two rows of id 9 are too short to share anything, so their order is of no account.
    once = {(-(2**63) if i is None else i, t) for i, t in rows_of(docs)}
    want = {(None if k == -(2**63) else k, *rest) for k, *rest in without_repeats(sorted(once, key=lambda r: (r[0], r[1] or "")))}
    assert got == want
    assert phrase_dedup.phrase_report(docs).count() == docs.count()
    assert phrase_dedup.phrase_report(none(spark)).collect() == []


def test_repeated_words_go(spark):
    """Texts as they are kept, with columns of the names used inside."""
    passage = " ".join(f"w{i}" for i in range(25))
    names = ["doc_id", "text", "doc", "row", "spans", "whole", "kept", "key", "words", "gram", "start", "size"]
    rows = [(1, f"first\n {passage} end"), (2, f"other {passage}\tlast"), (3, None), (4, "as  it\nwas ")]
    docs = spark.createDataFrame([(*r, *range(10)) for r in rows], ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names))
    got = phrase_dedup.drop_phrases(docs)
    assert got.schema == docs.schema
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: rows[0][1], 2: "other last", 3: None, 4: "as  it\nwas "}
    assert all(tuple(r)[2:] == tuple(range(10)) for r in got.collect())


def test_factors():
    block = ReferenceBlock(3)
    assert block.parse(b"a b c d e") == []
    assert block.parse(b"x a b c d") == [(1, 4)]
    assert block.parse(b"a b c d e") == [(0, 5)]
    assert block.parse(b"b c d e f") == [(0, 4)]
    # The two factors overlap: the window across the boundary stands in another segment.
    assert block.parse(b"a b c d e f g") == [(0, 5), (3, 3)]
