"""Token counts by merging with a heap and a linked list, without any identifiers."""

from __future__ import annotations

import functools
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import map_portions
from .subword import BlankPieces, vocabulary

# Entries of a worker's memory of counts (some 170 bytes each), first come, first kept.
COUNTS = 1_500_000
_PORTION = 4 << 20
_MARKED = re.compile(rb"[A-Za-z][.,;:!?]\Z")
_POSITION_BITS = 32
_SYMBOL_BITS = 20


class MergeCounter:
    """Counts the tokens of texts: initial symbols minus merges."""

    def __init__(self, path: str):
        self._vocabulary = vocabulary(path)
        merges = self._vocabulary.merges
        self._rank = {a << _SYMBOL_BITS | b: rank for rank, (a, b, _) in enumerate(merges)}
        self._made = [new for _, _, new in merges]
        self._memory: dict[bytes, int] = {}
        self._marks_apart = self._vocabulary.plain

    def merges(self, symbols: list[int]) -> int:
        """How many merges `symbols` undergo, always the lowest rank first, ties from the left.

        A heap holds rank and place of each adjacent pair that has a rank; a linked list over
        the places finds the neighbours. A popped entry is stale if its place went into another
        symbol or now begins a pair of another rank.
        """
        rank, made, n = self._rank, self._made, len(symbols)
        at = symbols[:]
        keys = [a << _SYMBOL_BITS | b for a, b in zip(at, at[1:])]
        heap = [r << _POSITION_BITS | i for i, r in enumerate(map(rank.get, keys)) if r is not None]
        if not heap:
            return 0
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        done, low = 0, (1 << _POSITION_BITS) - 1
        while heap:
            entry = heapq.heappop(heap)
            r, i = entry >> _POSITION_BITS, entry & low
            j = after[i]
            if at[i] < 0 or j >= n or rank.get(at[i] << _SYMBOL_BITS | at[j]) != r:
                continue
            done += 1
            at[i], at[j] = made[r], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := rank.get(at[i] << _SYMBOL_BITS | at[k])) is not None:
                    heapq.heappush(heap, s << _POSITION_BITS | i)
            h = before[i]
            if h >= 0 and (s := rank.get(at[h] << _SYMBOL_BITS | at[i])) is not None:
                heapq.heappush(heap, s << _POSITION_BITS | h)
        return done

    def _piece(self, piece: str) -> int:
        count = 0
        for word in self._vocabulary.words(piece):
            if isinstance(word, int):
                count += 1
            else:
                symbols = self._vocabulary.symbols(word)
                count += len(symbols) - self.merges(symbols)
        return count

    def _known(self, piece: bytes) -> int:
        """Tokens of a piece that begins with a blank, kept in the memory.

        A mark after a letter is a word of its own and one token, so pieces with and without it share an entry.
        """
        if self._marks_apart and _MARKED.search(piece):
            return self._known(piece[:-1]) + 1
        n = self._memory.get(piece)
        if n is None:
            n = self._piece(piece.decode())
            if len(self._memory) < COUNTS:
                self._memory[piece] = n
        return n

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a distinct piece between blanks is worked out once."""
        cut = BlankPieces(texts)
        values = np.fromiter(map(self._known, cut.pieces), np.int64, len(cut.pieces))
        firsts = map(self._piece, cut.firsts)
        return [n if codes is None else n + int(values[codes].sum()) for n, codes in zip(firsts, cut.rows())]

    def count(self, text: str) -> int:
        return self.counts([text])[0]


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of each text for the byte-level vocabulary file at `path`.

    Result: the key, n_bytes (UTF-8) and n_tokens, one row for each row of `docs`, repeated
    rows included. A null or empty text has 0 bytes and 0 tokens. The key may be null and of
    any type; other columns are not read. Special strings inside texts count as one token.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        counter = _counter(path)
        counts = counter.counts([t or "" for t in batch.column("text").to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
            ["key", "n_bytes", "n_tokens"],
        )

    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).cast("string").alias("text"),
    )
    counted = map_portions(rows, "text", work, f"key {kind}, n_bytes long, n_tokens long", _PORTION)
    return counted.withColumnRenamed("key", key)
