"""Phrase collocations: frequent word sequences by mergeable Misra-Gries summaries, then exact counts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import staged
from .batches import map_portions, portions
from .words import bit_set, in_bits, longer, mixed, word_codes, word_hashes, word_places

LONGEST = 5
THRESHOLD = 100
TOP = 2000
# A summary's error may be this part of the threshold; it has so many times the counters that mass / threshold asks for.
SHARPNESS = 8
# Counters of one summary (8 bytes each) that the number of hash partitions aims at.
COUNTERS = 1 << 18
# Bits of the sets of frequent words and of possible phrases (1 and 16 MB): each task gets them whole.
WORD_BITS = 1 << 23
PHRASE_BITS = 1 << 27
# Parts of each language that are ranked on their own before the last ranking.
_RANK_PARTS = 64
_PORTION = 4 << 20
# Phrases that a task counts together before it hands them on.
_HELD = 150_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_IS_WORD = ~_BREAKS
_IS_WORD[list(b" \t")] = False


class _Pieces:
    """Words of one language's texts, with the piece of text each of them is in."""

    def __init__(self, lang: str, texts: list[str]):
        self.data = "\n".join(texts).encode().translate(_LOWER)
        starts, ends = word_places(self.data, _IS_WORD)
        self.codes, self.vocabulary = word_codes(self.data, starts, ends)
        self.hashes = word_hashes(self.vocabulary, int(word_hashes([lang.encode()])[0]))
        breaks = np.cumsum(_BREAKS[np.frombuffer(self.data, np.uint8)], dtype=np.int32)
        self.piece = breaks[starts]

    def phrases(self, longest: int, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For 2 to `longest` words: number, places and hashes of phrases all of whose words may be frequent.

        `words` is the bit set of frequent words.
        """
        if not len(self.codes):
            return
        single = mixed(self.hashes)[self.codes]
        usable = in_bits(words, self.hashes & np.uint64(8 * len(words) - 1))[self.codes]
        hashes, fits = single, usable
        for n in range(2, longest + 1):
            if len(hashes) < 2:
                return
            hashes = longer(hashes, single, n)
            fits = fits[:-1] & usable[n - 1 :] & (self.piece[: len(hashes)] == self.piece[n - 1 :])
            at = np.flatnonzero(fits)
            yield n, at, hashes[at]

    def text(self, at: int, n: int) -> bytes:
        return b" ".join(self.vocabulary[c] for c in self.codes[at : at + n])


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, _Pieces]]:
    langs = batch.column("lang").to_pylist()
    texts = batch.column("text").to_pylist()
    groups: dict[str, list[str]] = {}
    for lang, text in zip(langs, texts):
        if text:
            groups.setdefault(lang, []).append(text)
    for lang in sorted(groups):
        yield lang, _Pieces(lang, groups[lang])


def _word_counts(rows: DataFrame, longest: int) -> DataFrame:
    """(lang, word, n, mass): occurrences of each word; mass counts phrases, in rows with a null word."""

    def work(batch: pa.RecordBatch):
        langs, words, counts, mass = [], [], [], []
        for lang, pieces in _by_lang(batch):
            found = np.bincount(pieces.codes, minlength=len(pieces.vocabulary))
            some = [(w, c) for w, c in zip(pieces.vocabulary, found.tolist()) if c]
            phrases = sum(int((pieces.piece[n - 1 :] == pieces.piece[: 1 - n]).sum()) for n in range(2, longest + 1))
            langs += [lang] * (len(some) + 1)
            words += [*(w.decode() for w, _ in some), None]
            counts += [*(c for _, c in some), 0]
            mass += [*itertools.repeat(0, len(some)), phrases]
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(mass, pa.int64())],
            ["lang", "word", "n", "mass"],
        )

    counted = map_portions(rows, "text", work, "lang string, word string, n long, mass long", _PORTION)
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))


class Summary:
    """A Misra-Gries summary: counters of keys, each too low by `error` at most; others have no more than that.

    Taking the (capacity + 1)-th largest count off all counters removes at least capacity + 1 times
    that from the mass, so a capacity of mass / allowed keeps the error within `allowed`. The capacity grows
    if the error would pass what is allowed, so the bound holds whatever mass comes.
    """

    def __init__(self, capacity: int, allowed: int):
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.error = 0
        self._capacity, self._allowed = max(1, capacity), allowed
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._held += len(keys)
        if self._held > self._capacity:
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self._waiting)])
        self._waiting, self._held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[begins], np.add.reduceat(counts, begins) if len(keys) else counts
        while len(self.keys) > self._capacity:
            off = int(np.partition(self.counts, len(self.counts) - self._capacity - 1)[len(self.counts) - self._capacity - 1])
            if self.error + off > self._allowed:
                self._capacity *= 2
                continue
            self.error += off
            keep = self.counts > off
            self.keys, self.counts = self.keys[keep], self.counts[keep] - off

    def frequent(self, threshold: int) -> np.ndarray:
        """All keys that may have been met `threshold` times."""
        self.settle()
        return self.keys[self.counts + self.error >= threshold]


def _packed(keys: np.ndarray) -> bytes:
    """Sorted 32-bit keys as differences, byte by byte of the same weight, which compresses well."""
    return np.diff(keys, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(gaps, dtype=np.uint32)


def _place(part: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    return mixed(part.astype(np.uint64) << np.uint64(32) | key.astype(np.uint64)) & np.uint64(bits - 1)


def _possible(rows: DataFrame, words, parts: int, capacity: int, longest: int, threshold: int, bits: int) -> DataFrame:
    """(place): bits of all phrases that may be met `threshold` times.

    A portion counts its phrases by hash; each hash partition's counts are a summary that is not full. The
    summaries of a partition are merged one after another in a task that holds one of them.
    """

    def count(batch: pa.RecordBatch):
        frequent = np.frombuffer(words.value, np.uint8)
        found = [h for _, pieces in _by_lang(batch) for _, _, h in pieces.phrases(longest, frequent)]
        hashes, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        part, key = (hashes >> np.uint64(32)) % np.uint64(parts), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.lexsort((key, part))
        part, key, counts = part[order].astype(np.int64), key[order], counts[order].astype(np.uint32)
        begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
        ends = np.append(begins[1:], len(part))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[begins]),
                pa.array([_packed(key[a:b]) for a, b in zip(begins, ends)], pa.binary()),
                pa.array([np.ascontiguousarray(counts[a:b]).view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in zip(begins, ends)], pa.binary()),
            ],
            ["part", "keys", "counts"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, summary = None, None

        def finish():
            keys = summary.frequent(threshold)
            places = np.unique(_place(np.full(len(keys), part), keys, bits))
            return pa.RecordBatch.from_arrays([pa.array(places.view(np.int64))], ["place"])

        for batch in batches:
            for i, own in enumerate(batch.column("part").to_pylist()):
                if own != part:
                    if summary is not None:
                        yield finish()
                    part, summary = own, Summary(capacity, threshold // SHARPNESS)
                keys = _unpacked(batch.column("keys")[i].as_buffer())
                data = np.frombuffer(batch.column("counts")[i].as_buffer(), np.uint8).reshape(4, -1).T
                summary.merge(keys, np.ascontiguousarray(data).view(np.uint32).ravel().astype(np.int64))
        if summary is not None:
            yield finish()

    local = map_portions(rows, "text", count, "part long, keys binary, counts binary", _PORTION)
    dealt = local.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(merge, "place long")


def _exact_counts(rows: DataFrame, words, phrases, parts: int, longest: int, threshold: int) -> DataFrame:
    """(lang, phrase, size, n): phrases met `threshold` times, counted exactly where the bit set of possible ones lets them pass.

    Counts are added up in a task first and then per hash partition, like the summaries. A partition has
    a bounded number of occurrences beside those of very frequent phrases, so its phrases fit a task even
    if the bit set lets all pass.
    """

    def count(batch: pa.RecordBatch, found: dict[tuple[int, str, str], int]) -> None:
        frequent, possible = np.frombuffer(words.value, np.uint8), np.frombuffer(phrases.value, np.uint8)
        bits = 8 * len(possible)
        for lang, pieces in _by_lang(batch):
            codes, several = pieces.codes, len(pieces.vocabulary)
            for n, at, hashes in pieces.phrases(longest, frequent):
                part, key = (hashes >> np.uint64(32)) % np.uint64(parts), hashes & np.uint64(0xFFFFFFFF)
                passed = in_bits(possible, _place(part, key, bits))
                at, part = at[passed], part[passed]
                # Equal phrases get equal names, word after word, so that no hash decides on equality.
                names = codes[at]
                for k in range(1, n):
                    names = np.unique(names * several + codes[at + k], return_inverse=True)[1]
                _, first, often = np.unique(names, return_index=True, return_counts=True)
                for i, own, m in zip(at[first].tolist(), part[first].tolist(), often.tolist()):
                    phrase = own, lang, pieces.text(i, n).decode()
                    found[phrase] = found.get(phrase, 0) + m

    def packed(found: dict[tuple[int, str, str], int]) -> pa.RecordBatch:
        """One row for each partition, with lists of its phrases."""
        order = sorted(found)
        own = np.array([p for p, _, _ in order], np.int64)
        cuts = np.append(np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else [], len(own)).astype(np.int32)
        columns = [[x for _, x, _ in order], [x for _, _, x in order], [found[x] for x in order]]
        lists = [pa.ListArray.from_arrays(cuts, pa.array(c, t)) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(own[cuts[:-1]]), *lists], ["part", "lang", "phrase", "n"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, str, str], int] = {}
        for batch in batches:
            for some in portions(batch, "text", _PORTION):
                count(some, found)
                if len(found) > _HELD:
                    yield packed(found)
                    found = {}
        yield packed(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, {}

        def finish() -> pa.RecordBatch:
            kept = [(lang, phrase, phrase.count(" ") + 1, n) for (lang, phrase), n in total.items() if n >= threshold]
            columns = zip(*kept) if kept else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "phrase", "size", "n"])

        for batch in batches:
            for i, own in enumerate(batch.column("part").to_pylist()):
                if own != part:
                    yield finish()
                    part, total = own, {}
                for lang, phrase, n in zip(*(batch.column(c)[i].as_py() for c in ("lang", "phrase", "n"))):
                    total[lang, phrase] = total.get((lang, phrase), 0) + n
        yield finish()

    lists = rows.mapInArrow(local, "part long, lang array<string>, phrase array<string>, n array<long>")
    dealt = lists.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(merge, "lang string, phrase string, size int, n long")


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST,
    counters: int = COUNTERS, word_bits: int = WORD_BITS, phrase_bits: int = PHRASE_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, phrase, size, n) of 1 to `longest` words met `threshold` times or more, and totals (lang, n) of words.

    First the words are counted. Then summaries of the phrases of frequent words are
    merged per hash partition, of which there are as many as the phrases' number asks for, so
    that none outgrows a task. No phrase that is frequent enough can be missing in them. A second pass over the
    texts counts exactly what they let pass. The bit sets have a fixed size: with very many
    phrases they let more pass, and the exact count drops it.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    counted = staged(_word_counts(rows, longest), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    single = counted.where(F.col("word").isNotNull() & (F.col("n") >= threshold)).select(
        "lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n"
    )
    words = spark.sparkContext.broadcast(bit_set(_word_places(single, word_bits), "place", word_bits))
    mass = counted.agg(F.sum("mass")).first()[0] or 0
    wanted = SHARPNESS * mass // threshold + 1
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-wanted // counters))
    capacity = -(-wanted // parts)
    possible = _possible(rows, words, parts, capacity, longest, threshold, phrase_bits)
    marks = spark.sparkContext.broadcast(bit_set(possible, "place", phrase_bits))
    exact = _exact_counts(rows, words, marks, parts, longest, threshold)
    return staged(single.unionByName(exact), "phrases"), totals


def _word_places(words: DataFrame, bits: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds: dict[str, int] = {}
            found = []
            for lang, word in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                seed = seeds.get(lang)
                if seed is None:
                    seed = seeds[lang] = int(word_hashes([lang.encode()])[0])
                found.append(word_hashes([word.encode()], seed)[0])
            places = np.array(found, np.uint64) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array(places.view(np.int64))], ["place"])

    return words.select("lang", "phrase").mapInArrow(work, "place long")


def _part(begin: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", begin, size), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST,
    top: int = TOP, percent: int = 100, **options,
) -> DataFrame:
    """The best `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut at `.,;:!?` and line ends, and then into words at blanks and tabs; null
    texts are empty, a null lang is `und`. A phrase of 2 to `longest` words that is met a >= `threshold`
    times is scored by its worst cut into two parts met l and r times: floor(1000 a n / (l r)), with n words
    in the language; ties go to the shorter first part. Phrases inside a longer one that is met
    `percent` of a hundred times as often, or more, are left out. Order: score, a, then the phrase's
    bytes. Other columns are not read. Counts and scores are exact: products have 38 digits.
    """
    phrases, totals = frequent_phrases(docs, text, lang, threshold, longest, **options)
    many = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))
    # Parts of frequent phrases are frequent, so all of them have been counted.
    cuts = many.select(
        "lang", "phrase", "words", F.col("n").alias("a"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    ).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    known = phrases.select("lang", "phrase", "n")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    joined = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    whole = {c: f"cast({c} AS decimal(19,0))" for c in "alrn"}
    score = f"(1000 * {whole['a']} * {whole['n']}) div ({whole['l']} * {whole['r']})"
    scored = joined.select("lang", "phrase", "a", "k", "l", "r", "n", F.expr(score).alias("score"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("worst"))
    inner = many.where("size > 2").select("lang", "n", "words", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m")).select(
        "lang", "n", "words", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("begin")
    ).select("lang", "n", _part(F.col("begin"), F.col("m")).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    kept = worst.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(percent) * F.col("worst.a"))
    ).select("lang", "phrase", "worst.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_PARTS))
    first = kept.withColumn("part", part).withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.where(F.col("nth") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
