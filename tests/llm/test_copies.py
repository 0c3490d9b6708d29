"""Suffix-array dedup, line dedup and the Jaccard join against brute force."""

import hashlib
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import PASSAGE, none, odd_docs, rows_of
from passagework.llm import jaccard, line_dedup, queries, suffix_dedup
from passagework.llm.components import components

LOW = -(2**63)


# Suffix-array dedup

def brute_bytes(rows, length=100):
    """Mask of removed bytes for each distinct (id, text), in order of id."""
    seen, out = set(), {}
    for i, t in sorted({(LOW if i is None else i, t or "") for i, t in rows}, key=lambda r: r[0]):
        data = t.encode()
        mask = np.zeros(len(data), bool)
        for a in range(len(data) - length + 1):
            gram = data[a : a + length]
            if gram in seen:
                mask[a : a + length] = True
            seen.add(gram)
        out[i, t] = mask
    return out


def reported(i, t, mask):
    data = np.frombuffer((t or "").encode(), np.uint8)
    spans = int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(mask) else 0
    return i, len(data), int(mask.sum()), spans, hashlib.sha256(data[~mask].tobytes()).hexdigest()


def check_bytes(rows, got):
    masks = brute_bytes(rows)
    want = [reported(i, t, masks[LOW if i is None else i, t or ""]) for i, t in rows]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_merged_transforms_find_repeats():
    rng = random.Random(3)
    for _ in range(150):
        letters = rng.choice([b"ab", b"abcdefgh", bytes(range(256))])
        base = [bytes(rng.choices(letters, k=rng.randint(5, 60))) for _ in range(3)]
        strings = [b"".join(rng.choices([*base, b"xyz"], k=rng.randint(1, 5))) for _ in range(rng.randint(1, 8))]
        length = rng.choice([3, 8, 20])
        owners = np.array([[i, 0, 5 * (i % 2)] for i in range(len(strings))])
        found = [bytearray(len(s)) for s in strings]
        for w, a, b in suffix_dedup.repeated(strings, owners, length, rng.randint(1, 4)):
            found[w][a:b] = b"\1" * (b - a)
        wanted, seen = [bytearray(len(s)) for s in strings], set()
        for i, s in enumerate(strings):
            for a in range(len(s) - length + 1):
                if s[a : a + length] in seen:
                    wanted[i][a : a + length] = b"\1" * length
                seen.add(s[a : a + length])
        assert found == wanted


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    for _ in range(20):
        shared = bytes(rng.choices(b"abcd ", k=160))
        a, b = bytes(rng.choices(b"abcd ", k=rng.randint(0, 90))) + shared, shared + b"zz"
        grams = []
        for data in (a, b):
            begins, ends, gram, _, _ = suffix_dedup.windows(data, 100, 24)
            at = {}
            for x, y, g in zip(begins, ends, gram):
                for i in range(x, y - 99):
                    at[data[i : i + 100]] = g
            assert len(at) <= len(data) - 99
            grams.append(at)
        for window in grams[0].keys() & grams[1].keys():
            assert grams[0][window] == grams[1][window]


def test_odd_bytes(spark):
    docs = odd_docs(spark).where("doc_id IS NULL OR doc_id <> 9")
    check_bytes(rows_of(docs), suffix_dedup.report(docs).collect())
    assert suffix_dedup.report(none(spark)).collect() == []
    assert suffix_dedup.dedup(none(spark)).collect() == []
    assert suffix_dedup.report(odd_docs(spark)).count() == odd_docs(spark).count()


def test_overlaps_and_hot_passages(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefé", k=rng.randint(1, 7))) for _ in range(40)]
    shared = [" ".join(rng.choices(words, k=60)) for _ in range(3)]
    rows = []
    for i in range(120):
        own = [" ".join(rng.choices(words, k=rng.randint(3, 30))) for _ in range(2)]
        cut = rng.randint(0, 40)
        middle = shared[0] if i % 3 == 0 else rng.choice(shared)[cut:]
        rows.append((i, own[0] + middle + own[1] + ("ab" * rng.randint(0, 150) if i % 5 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_bytes(rows, suffix_dedup.report(docs).collect())
    small = suffix_dedup.covered(docs, bytes_per_task=2000).count()
    assert small > 0


@pytest.mark.parametrize("passage", [80, 300])
def test_passage_with_many_surroundings(spark, monkeypatch, passage):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared, ends = text(passage), [text(50) for _ in range(12)]
    rows = [(i, text(60) + (ends[i % 12] if i % 3 else "") + shared + (ends[i % 5] if i % 2 else "") + text(60)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    limit, largest, merged = 2000, [], suffix_dedup._merged

    def watched(parts, length, bytes_per_task):
        keys = parts.groupBy("key").agg(F.sum(F.length("content")).alias("bytes"))
        largest.append(keys.agg(F.max("bytes")).first()[0])
        return merged(parts, length, bytes_per_task)

    monkeypatch.setattr(suffix_dedup, "_merged", watched)
    found = {}
    for r in suffix_dedup.covered(docs, bytes_per_task=limit).collect():
        found.setdefault(r.doc, []).append((r.start, r.start + r.size))
    for (i, t), mask in brute_bytes(rows).items():
        got = np.zeros(len(t), bool)
        for a, b in found.get(i, []):
            got[a:b] = True
        assert (got == mask).all()
    assert 0 < largest[0] <= limit


def test_registered_bytes(spark, sf_dir):
    check_bytes(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), queries.op7_suffix_dedup(spark, sf_dir).collect())


def test_dedup_keeps_whole_characters(spark):
    docs = spark.createDataFrame([(1, "é" * 60 + "abc" + PASSAGE, 1), (2, "xé" + "é" * 60 + "q", 1), (3, None, 1)], "doc_id long, text string, n_chars long")
    kept = {r.doc_id: r for r in suffix_dedup.dedup(docs).collect()}
    assert kept[2].text == "xq" or set(kept[2].text) <= set("xéq")
    assert kept[2].n_chars == len(kept[2].text) and kept[3].text is None


# Line dedup

def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def changed(rng, line, times):
    out = list(line)
    for _ in range(times):
        at, letter = rng.randrange(len(out)), rng.choice("abcé中")
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = letter
        elif kind == 1 and len(out) > 8:
            del out[at]
        else:
            out.insert(at, letter)
    return "".join(out)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_band_and_segments(threshold):
    rng = random.Random(threshold)
    left = ["".join(rng.choices("abcé" if rng.random() < 0.7 else "a", k=rng.randint(9, 40))) for _ in range(600)]
    right = [changed(rng, a, rng.randint(0, 5)) for a in left]
    within = line_dedup.within(left, right, threshold)
    assert within.tolist() == [edits(a, b) <= threshold for a, b in zip(left, right)]
    row, keys, probe = line_dedup.segment_keys(line_dedup.Lines(left + right), threshold)
    listed, looked = defaultdict(set), defaultdict(set)
    for r, k, p in zip(row.tolist(), keys.tolist(), probe.tolist()):
        (looked if p else listed)[r].add(k)
    for i in np.flatnonzero(within):
        a, b = i, i + len(left)
        assert listed[a] & listed[b] or listed[a] & looked[b] or listed[b] & looked[a]


def brute_lines(rows, threshold=2, shortest=20):
    """Line numbers that go, for each distinct (id, text)."""
    places, first = defaultdict(list), {}
    for i, t in sorted({(LOW if i is None else i, t or "") for i, t in rows}, key=lambda r: r[0]):
        for n, line in enumerate(t.split("\n")):
            if line.strip(" "):
                places[i, t].append((n, line))
                first.setdefault(line, (i, n))
    late = set()
    for a, b in combinations(first, 2):
        edits = min(threshold, max(len(a), len(b)) * threshold // shortest)
        if edits and abs(len(a) - len(b)) <= edits and line_dedup.within([a], [b], edits)[0]:
            late.add(a if first[b] < first[a] else b)
    return {
        d: (len(p), [n for n, x in p if first[x] != (d[0], n)], [n for n, x in p if first[x] == (d[0], n) and x in late])
        for d, p in places.items()
    }


def check_lines(rows, got):
    gone = brute_lines(rows)
    want = []
    for i, t in rows:
        n, exact, near = gone.get((LOW if i is None else i, t or ""), (0, [], []))
        want.append((i, n, len(exact), len(near), sorted(exact + near)))
    got = [(r.doc_id, r.n_lines, r.n_exact, r.n_near, list(r.removed)) for r in got]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_lines(spark):
    docs = odd_docs(spark).where("doc_id IS NULL OR doc_id <> 9")
    check_lines(rows_of(docs), line_dedup.line_report(docs).collect())
    kept = line_dedup.dedup_lines(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == odd_docs(spark).count()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[2] is None and texts[3] == "" and texts[12] == "\n" and texts[4] == ""
    assert line_dedup.line_report(none(spark)).collect() == []
    assert line_dedup.dedup_lines(none(spark)).collect() == []


def test_near_and_hot_lines(spark):
    rng = random.Random(8)
    base = ["".join(rng.choices("abcdefgh é", k=rng.randint(7, 50))) for _ in range(40)]
    hot = "a line that stands in every single document"
    rows = [
        (i, "\n".join([hot, changed(rng, rng.choice(base), rng.randint(0, 4)), "", "x", "".join(rng.choices("qwertz ", k=30))]))
        for i in range(90)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_lines(rows, line_dedup.line_report(docs).collect())
    gone = brute_lines(rows)
    for r in line_dedup.dedup_lines(docs).collect():
        t = dict(rows)[r.doc_id]
        _, exact, near = gone[r.doc_id, t]
        assert r.text == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in {*exact, *near})


def test_short_lines_may_differ_less(spark):
    rows = [
        (1, "eighteen points he"), (2, "eighteen points here"),  # two edits, the longer one has 20
        (3, "nineteen points too"), (4, "nineteen pointz tooo"), (5, "nineteen poinz tooo"),
        (6, "ten points"), (7, "ten pointz"), (8, "nine long"), (9, "nine lang"), (10, "nine longs"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_report(docs).collect()
    check_lines(rows, got)
    assert {r.doc_id for r in got if r.n_near} == {2, 4, 5, 7, 10}


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_one_pair_equals_many(threshold):
    rng = random.Random(threshold)
    left = ["".join(rng.choices("abé", k=rng.randint(3, 90))) for _ in range(600)]
    right = [changed(rng, x, rng.randint(0, threshold + 2)) for x in left]
    both = [(a, b) for a, b in zip(left, right) if min(len(a), len(b)) > threshold]
    many = line_dedup.within(*zip(*both), threshold)
    assert [line_dedup.within_long(a, b, threshold) for a, b in both] == many.tolist()
    assert [line_dedup.within_long(*line_dedup._bare("x" * 300 + a + "yz" * 99, "x" * 300 + b + "yz" * 99), threshold) for a, b in both] == [
        line_dedup.within(["x" * 300 + a + "yz" * 99], ["x" * 300 + b + "yz" * 99], threshold)[0] for a, b in both]


def test_very_long_lines(spark):
    rng = random.Random(4)
    line = "".join(rng.choices("abcdefgh ", k=500_000))
    edited = line[:1000] + "X" + line[1001:400_000] + line[400_001:]
    far = line[:1000] + "X" + line[1001:400_000] + "YZ" + line[400_002:]
    rows = [(1, line), (2, edited), (3, far), (4, "short\n" + line[::-1])]
    got = {r.doc_id: r.n_near for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}  # the third is two edits from the second


NAMES = (
    "_gone", "_hash", "_tid", "_first", "_found", "_ident", "_text_id", "_ordinal", "_doc", "_row", "doc", "row", "name", "lines",
    "key", "spans", "tid", "keeper", "first", "content", "gram", "size", "start", "c0", "c1",
)


@pytest.mark.parametrize("stage", [line_dedup.dedup_lines, jaccard.keep_one, suffix_dedup.dedup])
def test_columns_of_names_used_inside(spark, stage):
    text = "one and the same text of many words that is given twice, the second time with others in front of it\nand a second line of it"
    rows = [(1, text, *range(len(NAMES))), (2, text, *range(len(NAMES))), (3, "others in front: " + text, *range(len(NAMES))), (4, None, *range(len(NAMES)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in NAMES))
    got = stage(docs)
    assert got.schema == docs.schema
    plain = stage(docs.select("doc_id", "text"))
    assert sorted((r[:2] for r in got.collect()), key=repr) == sorted((tuple(r) for r in plain.collect()), key=repr)
    assert all(r[2:] == tuple(range(len(NAMES))) for r in got.collect())


def test_registered_lines(spark, sf_dir):
    check_lines(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), queries.op8_line_dedup(spark, sf_dir).collect())


# Jaccard join

def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def brute_join(rows, similarity=0.8):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    names = list(texts)
    sets = [shingles(t) for t in names]
    root, links = list(range(len(names))), [0] * len(names)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(range(len(names)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= similarity * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k, t in enumerate(names):
        ids = [i for i in texts[t] if i is not None]
        if ids:
            least[find(k)] = min(least.get(find(k), ids[0]), *ids)
    return {t: (least.get(find(k)), links[k]) for k, t in enumerate(names)}


def check_join(rows, got):
    want = brute_join(rows)
    expected = sorted(((i, *want[t or ""]) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == expected


def test_shingles_and_samples():
    texts = ["", "one", "a b c d", "a b c d e", "A  b\nc\td e f", "é b c d e", " x y " * 9]
    assert [len(s) for s in jaccard.shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    a = rng.choices(words, k=3000)
    b = [w if rng.random() < 0.98 else "zz" for w in a]
    sets = jaccard.shingle_sets([" ".join(a), " ".join(b)])
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    picked = jaccard.sampled(sets, 2000)
    assert abs((picked[0] == picked[1]).mean() - true) < 0.04


def test_runs_reach_recall():
    assert 1 - (1 - 0.8**jaccard.DEPTH) ** jaccard.runs_needed() >= jaccard.RECALL


def test_few_pairs_at_the_threshold_are_missed():
    assert (1 - 0.8**jaccard.DEPTH) ** jaccard.runs_needed() <= 1e-4
    assert jaccard.runs_needed() * jaccard.DEPTH <= jaccard.SAMPLES


def test_pairs_at_a_low_threshold_are_compared():
    rng = np.random.default_rng(5)
    found = 0
    for _ in range(300):
        tokens = rng.integers(1, 2**63, 120, dtype=np.uint64)
        sets = [np.unique(tokens[:90]), np.unique(np.concatenate([tokens[30:90], tokens[90:]]))]
        samples = [s.tobytes() for s in jaccard.sampled(sets)]
        group = {"size": [90, 90], "side": [0, 0], "run": [0, 0], "samples": samples, "paths": [[1], [1]]}
        found += jaccard._candidates(group, 0.5) is not None
    assert found >= 299


def test_components(spark):
    rng = random.Random(1)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(60)] + [("hub", f"m{i}") for i in range(80)] + [("z", "z"), ("a", None)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert {got[f"n{i}"] for i in range(61)} == {"n0"} and {got[f"m{i}"] for i in range(80)} == {"hub"}
    assert "z" not in got and "a" not in got
    assert components(spark.createDataFrame([], "u string, v string")).collect() == []


def test_odd_join(spark):
    docs = odd_docs(spark)
    check_join(rows_of(docs), jaccard.join_texts(docs).collect())
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [-5, 1, 2, 5, 6, 7, 9, 9, 10, 11, 12]
    assert jaccard.join_texts(none(spark)).collect() == []
    assert jaccard.keep_one(none(spark)).collect() == []


def test_large_group_in_blocks(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    base = rng.choices(words, k=120)
    rows = []
    for i in range(150):
        if i % 3:
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = rng.choices(words, k=rng.randint(1, 60))
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_join(rows, jaccard.join_texts(docs, recall=0.9999, depth=2, small=8, block=16).collect())


def test_registered_join(spark, sf_dir):
    check_join(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), queries.op9_jaccard_join(spark, sf_dir).collect())
