"""Removal of repeated word sequences by relative Lempel-Ziv parsing against indexed reference blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..runtime import staged
from .batches import map_portions, portions
from .words import bit_set, in_bits, longer, mixed, word_codes, word_hashes, word_places

WINDOW = 20
# Words whose hash in a window decides in which block equal windows meet.
ANCHOR = 8
# Bits of the set of repeated anchors that every task gets, at most (16 MB); more anchors only make it let more pass.
MOST_BITS = 1 << 27
# Segments of one anchor that a block holds at once; those of a more frequent one are split into windows.
BLOCK_SEGMENTS = 20_000
_PORTION = 4 << 20
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(b"\t\n\x0b\x0c\r ")] = False
_SPAN = "doc long, row long, start int, size int"
_SEGMENT = f"gram long, {_SPAN}, words binary"


class ReferenceBlock:
    """Segments of words, indexed by their windows, against which further segments are parsed.

    No window may stand twice in one segment. The index is built once a second segment comes,
    since most blocks of a portion have one only.
    """

    __slots__ = ("_index", "_segments", "_waiting", "_window")

    def __init__(self, window: int = WINDOW):
        self._window = window
        self._segments: set[bytes] = set()
        self._waiting: bytes | None = None
        self._index: dict[bytes, tuple[list[bytes], int]] | None = None

    def _add(self, words: list[bytes], i: int) -> None:
        self._index.setdefault(b" ".join(words[i : i + self._window]), (words, i))

    def parse(self, segment: bytes) -> list[tuple[int, int]]:
        """Factors of `segment` (words joined by one blank) as (start, size) in words; it then joins the block.

        Greedy: the longest match with an earlier segment from here on is a factor if it has a window's
        length at least. The next one is sought from the first window that crosses the factor's end, so
        that windows across a boundary are not missed; where none begins, one word is passed as a literal.
        """
        if segment in self._segments:
            return [(0, segment.count(b" ") + 1)]
        self._segments.add(segment)
        if len(self._segments) == 1:
            self._waiting = segment
            return []
        if self._index is None:
            self._index = {}
            first = self._waiting.split(b" ")
            for i in range(len(first) - self._window + 1):
                self._add(first, i)
        words = segment.split(b" ")
        n, window, found, i = len(words), self._window, [], 0
        while i + window <= n:
            source, j = self._index.get(b" ".join(words[i : i + window]), (None, 0))
            if source is None:
                self._add(words, i)
                i += 1
                continue
            size, most = window, min(n - i, len(source) - j)
            while size < most and words[i + size] == source[j + size]:
                size += 1
            found.append((i, size))
            i += size - window + 1
        return found


def _runs(data: bytes, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, window: int, anchor: int):
    """Runs of windows with the same anchor: first word, words, and the anchor's hash.

    A window's anchor is the leftmost of its least hashes of `anchor` words, so it
    follows from the window's content, as does its place in it: equal windows lie equally in their runs.
    """
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(starts) < window:
        return nothing
    codes, vocabulary = word_codes(data, starts, ends)
    single = mixed(word_hashes(vocabulary)[codes])
    grams = single
    for n in range(2, anchor + 1):
        grams = longer(grams, single, n)
    # Leftmost minimum of each window by windows of doubled width: the place of the least hash so far.
    width = window - anchor + 1
    at, size = np.arange(len(grams)), 1
    while size < width:
        step = min(size, width - size)
        a, b = at[:-step], at[step:]
        at = np.where(grams[b] < grams[a], b, a)
        size += step
    inside = doc[: len(at)] == doc[window - 1 :]
    first = np.flatnonzero(inside)
    if not len(first):
        return nothing
    at = at[first]
    begins = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)]))
    last = np.concatenate([begins[1:], [len(first)]]) - 1
    return first[begins], first[last] - first[begins] + window, grams[at[begins]]


class _Texts:
    """The words of a portion's texts, one after the other."""

    def __init__(self, texts: list[str]):
        plain = [b" ".join(t.encode().split()) for t in texts]
        self.data = b" ".join(plain)
        self.starts, self.ends = word_places(self.data, _IS_WORD)
        begins = np.cumsum([0, *(len(p) + 1 for p in plain)])[:-1]
        self.doc = np.searchsorted(begins, self.starts, "right") - 1
        self.base = np.searchsorted(self.starts, begins)

    def runs(self, window: int, anchor: int):
        return _runs(self.data, self.starts, self.ends, self.doc, window, anchor)


def _rows(docs: DataFrame, key: str, text: str, *others: Column) -> DataFrame:
    """(doc, row, text, ...): `row` tells rows of the same key apart by their text."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.conv(F.substring(F.sha2(F.encode(whole, "UTF-8"), 256), 1, 15), 16, 10)
    doc = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)).cast("long"))
    return docs.select(doc.alias("doc"), digest.cast("long").alias("row"), whole.alias("text"), *others)


def _repeated_anchors(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """Hashes of the anchors that more than one run has anywhere; counted per portion before the shuffle."""

    def work(batch: pa.RecordBatch):
        *_, grams = _Texts(batch.column("text").to_pylist()).runs(window, anchor)
        values, counts = np.unique(grams, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["gram", "n"])

    grams = map_portions(rows.select("text"), "text", work, "gram long, n long", _PORTION)
    return grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")


def _parsed_locally(rows: DataFrame, bits: int, repeated, window: int, anchor: int) -> DataFrame:
    """Spans found within a portion (`words` null), and the segments that other portions may have as well."""

    def work(batch: pa.RecordBatch):
        docs, row, texts = (batch.column(c).to_pylist() for c in ("doc", "row", "text"))
        order = sorted(range(len(docs)), key=lambda i: (docs[i], row[i]))
        # A repeated row counts once.
        order = [i for k, i in enumerate(order) if not k or (docs[i], row[i]) != (docs[order[k - 1]], row[order[k - 1]])]
        table = _Texts([texts[i] for i in order])
        first, size, grams = table.runs(window, anchor)
        often = in_bits(np.frombuffer(repeated.value, np.uint8), mixed(grams) & np.uint64(bits - 1))
        first, size, grams = first[often], size[often], grams[often]
        places = np.array([(docs[i], row[i]) for i in order], np.int64).reshape(-1, 2)
        owner = table.doc[first]
        begins, ends = table.starts[first], table.ends[first + size - 1]
        start = first - table.base[owner]
        blocks: dict[int, ReferenceBlock] = {}
        spans: list[tuple[int, int, int]] = []
        sent: list[int] = []
        segments: list[bytes] = []
        for k, (gram, a, b) in enumerate(zip(grams.tolist(), begins.tolist(), ends.tolist())):
            segment = table.data[a:b]
            block = blocks.get(gram)
            if block is None:
                block = blocks[gram] = ReferenceBlock(window)
            found = block.parse(segment)
            spans.extend((k, i, n) for i, n in found)
            if found != [(0, int(size[k]))]:
                sent.append(k)
                segments.append(segment)
        which = np.array([k for k, _, _ in spans], np.int64)
        both = np.concatenate([which, np.array(sent, np.int64)])
        shift = np.concatenate([np.array([i for _, i, _ in spans], np.int64), np.zeros(len(sent), np.int64)])
        sizes = np.concatenate([np.array([n for _, _, n in spans], np.int64), size[sent] if sent else np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(grams.view(np.int64)[both]), pa.array(places[owner[both], 0]), pa.array(places[owner[both], 1]),
                pa.array((start[both] + shift).astype(np.int32)), pa.array(sizes.astype(np.int32)),
                pa.array([None] * len(spans) + segments, pa.binary()),
            ],
            ["gram", "doc", "row", "start", "size", "words"],
        )

    return map_portions(rows, "text", work, _SEGMENT, _PORTION)


def _into_windows(segments: DataFrame, window: int) -> DataFrame:
    """Each window of the segments as a segment of its own, named by its words."""

    def work(batch: pa.RecordBatch):
        columns: list[list] = [[], [], [], [], []]
        for doc, row, start, words in zip(*(batch.column(c).to_pylist() for c in ("doc", "row", "start", "words"))):
            parts = words.split(b" ")
            for i in range(len(parts) - window + 1):
                piece = b" ".join(parts[i : i + window])
                for column, value in zip(columns, (int(word_hashes([piece]).view(np.int64)[0]), doc, row, start + i, piece)):
                    column.append(value)
        gram, doc, row, start, words = columns
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(start, pa.int32()),
             pa.array([window] * len(gram), pa.int32()), pa.array(words, pa.binary())],
            ["gram", "doc", "row", "start", "size", "words"],
        )

    return map_portions(segments, "words", work, _SEGMENT, _PORTION // 8)


def _parsed_in_blocks(segments: DataFrame, window: int) -> DataFrame:
    """Spans of the segments that a segment of an earlier place has too; equal anchors meet in one block."""
    dealt = segments.repartition("gram").sortWithinPartitions("gram", "doc", "row", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block, place = None, ReferenceBlock(window), None
        for batch in batches:
            for part in portions(batch, "words", _PORTION):
                spans: list[tuple[int, int, int]] = []
                for k, (gram, words, *here) in enumerate(zip(*(part.column(c).to_pylist() for c in ("gram", "words", "doc", "row", "start")))):
                    if gram != last:
                        last, block, place = gram, ReferenceBlock(window), None
                    if here != place:  # else a repeated row's, from another portion
                        spans.extend((k, i, n) for i, n in block.parse(words))
                    place = here
                picked = np.array(spans, np.int64).reshape(-1, 3)
                starts = part.column("start").to_numpy()[picked[:, 0]] + picked[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc").take(pa.array(picked[:, 0])), part.column("row").take(pa.array(picked[:, 0])),
                     pa.array(starts.astype(np.int32)), pa.array(picked[:, 2].astype(np.int32))],
                    ["doc", "row", "start", "size"],
                )

    return dealt.mapInArrow(run, _SPAN)


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
    block_segments: int = BLOCK_SEGMENTS, bits: int = MOST_BITS,
) -> DataFrame:
    """(doc, row, start, size): words that a window of `window` words covers which also starts earlier.

    Texts are cut into segments, runs of windows with the same anchor, so that all places of a
    repeated sequence meet. A portion of texts parses its segments against the block of its
    earlier ones: copies are settled there, and only what is new to the portion goes on, if its anchor is
    repeated anywhere. Segments of one anchor then meet in a block of all portions. An anchor with more than
    `block_segments` of them is split into single windows, each a block by its own words, which need
    no more memory however many there are. Words are compared themselves, hashes only
    bring them together. Spans may overlap.
    """
    rows = _rows(docs, key, text)
    repeated = _repeated_anchors(rows, window, anchor)
    marks = rows.sparkSession.sparkContext.broadcast(bit_set(_bit_places(repeated, bits), "place", bits))
    local = staged(_parsed_locally(rows, bits, marks, window, anchor), "local-factors")
    spans = local.where("words IS NULL").select("doc", "row", "start", "size")
    segments = local.where("words IS NOT NULL")
    often = segments.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > block_segments).select("gram")
    often = staged(often, "frequent-anchors")
    few = segments.join(often, "gram", "left_anti")
    many = _into_windows(segments.join(often, "gram", "left_semi").select(*segments.columns), window)
    return spans.unionByName(_parsed_in_blocks(few.select(*many.columns).unionByName(many), window))


def _bit_places(grams: DataFrame, bits: int) -> DataFrame:
    def work(batch: pa.RecordBatch):
        found = mixed(batch.column("gram").to_numpy().view(np.uint64)) & np.uint64(bits - 1)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["place"])

    return grams.mapInArrow(lambda batches: (out for batch in batches for out in work(batch)), "place long")


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Adds `spans`, the list of each row's spans, to `rows` (doc, row, ...)."""
    found = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    return rows.join(found, ["doc", "row"], "left")


def _kept(text: str, spans: list | None) -> tuple[int, list[bytes]]:
    """Number of words, and those that no span covers."""
    words = text.encode().split()
    if not spans:
        return len(words), words
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, [s["start"] for s in spans], 1)
    np.add.at(gone, [s["start"] + s["size"] for s in spans], -1)
    return len(words), [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]


def phrase_report(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """key, n_words, n_removed and kept_sha256 of each row.

    Words are what ASCII white space parts. A word is removed if a sequence of `window` words covers it
    that also starts earlier: in a row of a smaller key or earlier in the same text; sequences are judged on the
    input and never cross texts. The key must cast to long; null texts have no words; a null key comes before
    all others; rows of equal key are ordered by a hash of their text, and a repeated row counts once and is
    treated like its double. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    spans = repeated_spans(docs, key, text, window, **options)
    rows = _rows(docs, key, text, F.col(key).alias("key"))

    def work(batch: pa.RecordBatch):
        counts, removed, digests = [], [], []
        for text_, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            n, kept = _kept(text_, found)
            counts.append(n)
            removed.append(n - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)],
            ["key", "n_words", "n_removed", "kept_sha256"],
        )

    schema = f"key {kind}, n_words long, n_removed long, kept_sha256 string"
    joined = _with_spans(rows, spans).select("key", "text", "spans")
    return map_portions(joined, "text", work, schema).withColumnRenamed("key", key)


def drop_phrases(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """`docs` with the words that `phrase_report` counts as removed taken out; kept words are joined by one blank.

    All rows and columns stay, whatever their names; a null text stays null, and a text that loses nothing stays as it is.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    rows = _rows(docs, key, text, whole)

    def work(batch: pa.RecordBatch):
        texts = []
        for text_, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            texts.append(b" ".join(_kept(text_, found)[1]).decode() if found else None)
        yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(texts, pa.string())], ["whole", "kept"])

    joined = _with_spans(rows, repeated_spans(docs, key, text, window, **options)).select("text", "whole", "spans")
    kind = StructType().add("whole", rows.schema["whole"].dataType).add("kept", "string")
    done = map_portions(joined, "text", work, kind)
    changed = F.coalesce("kept", F.col("whole").getField(text)).cast(docs.schema[text].dataType).alias(text)
    return done.select(*(changed if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns))
