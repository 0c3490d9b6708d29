"""Exact BPE encoding by longest matches with backtracking, and decoding by an offset table."""

from __future__ import annotations

import array
import functools

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .batches import map_portions
from .subword import MEMORY, vocabulary

# Where the letters that end a word lie, so that each initial symbol is one letter.
_END = 0x4000
# Entries of a worker's table of judged token pairs (about 100 bytes each).
PAIRS = 300_000


class BacktrackingEncoder:
    """Merges of words in linear time, without merging.

    A sequence of tokens is what merging gives if and only if each adjacent pair of it is
    stable, that is, merging both tokens' symbols gives the same two tokens. The encoder takes
    the longest token at each place and steps back when no token there is stable after the
    one before. A place found to lead nowhere is marked and never entered again.
    """

    def __init__(self, path: str):
        self._vocabulary = v = vocabulary(path)
        self._joined = {(a, b): new for a, b, new in v.merges}
        self._age = {new: i for i, (_, _, new) in enumerate(v.merges)}
        self._parts = {new: (a, b) for a, b, new in v.merges}
        self._pairs: dict[int, bool] = {}
        self._memory: dict[str, bytes] = {}
        self._automaton = ahocorasick.Automaton()
        for token, i in v.ids.items():
            if i not in self._parts or self.stable(*self._parts[i], made=i):
                letters = self._letters(token)
                self._automaton.add_word(letters, (len(letters), i))
        self._automaton.make_automaton()
        # Decoding: all token strings end to end, and where each begins.
        names = {i: t for t, i in v.ids.items()} | {i: t for t, i in v.special.items()}
        strings = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self._blob = np.frombuffer(b"".join(strings), np.uint8)
        self._offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])

    def _letters(self, token: str) -> str:
        suffix = self._vocabulary.suffix
        if suffix and token.endswith(suffix) and len(token) > len(suffix):
            token = token[: -len(suffix)]
            return token[:-1] + chr(_END + ord(token[-1]))
        return token

    def stable(self, a: int, b: int, made: int | None = None) -> bool:
        """True if merging the symbols of both tokens never crosses the border between them.

        Undoes the merges of both sides, the latest first, and looks at the pair that then
        touches the border: merging would have joined it if that merge comes before the one
        just undone, or at the same rank from the left. `made`: the join to leave out of
        account, for a token's own parts.
        """
        known = self._pairs.get(a << 20 | b) if made is None else None
        if known is not None:
            return known
        age, parts, joined = self._age, self._parts, self._joined
        left, right, limit, result = a, b, len(age) + 1, True
        while True:
            new = joined.get((left, right))
            if new is not None and new != made and age[new] < limit:
                result = False
                break
            older_left, older_right = age.get(left, -1), age.get(right, -1)
            if older_left < 0 and older_right < 0:
                break
            # At equal rank merging goes from the left, so the right one is undone first.
            if older_left > older_right:
                left, limit = parts[left][1], older_left
            else:
                right, limit = parts[right][0], older_right + 1
        if made is None and len(self._pairs) < PAIRS:
            self._pairs[a << 20 | b] = result
        return result

    def word(self, letters: str) -> list[int]:
        n = len(letters)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self._automaton.iter(letters):
            starts[end - match[0] + 1].append(match)
        # Matches come by their end: those of a place are in order of length.
        tokens: list[tuple[int, int, int]] = []  # length, id, which of the place's matches
        open_ = [True] * n + [True]
        at, which = 0, len(starts[0]) - 1
        while at < n:
            while which >= 0:
                length, i = starts[at][which]
                if open_[at + length] and (not tokens or self.stable(tokens[-1][1], i)):
                    tokens.append((length, i, which))
                    at += length
                    which = len(starts[at]) - 1 if at < n else -1
                    break
                which -= 1
            else:
                open_[at] = False
                length, _, which = tokens.pop()
                at -= length
        return [i for _, i, _ in tokens]

    def _piece(self, piece: str) -> bytes:
        out: list[int] = []
        suffix = self._vocabulary.suffix
        for word in self._vocabulary.words(piece):
            if isinstance(word, int):
                out.append(word)
            else:
                out.extend(self.word(word[:-1] + chr(_END + ord(word[-1])) if suffix else word))
        return array.array("I", out).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of `text` as machine-order unsigned 32-bit numbers.

        White space is no part of a token in such a vocabulary, so blanks cut the text.
        """
        pieces = text.split(" ")
        found = list(map(self._memory.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = ids = self._piece(pieces[i])
                    if len(self._memory) < MEMORY:
                        self._memory[pieces[i]] = ids
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings in UTF-8, with a blank between two: a vocabulary without decoder says no more."""
        if not len(ids):
            return b""
        begins = self._offsets[ids]
        lengths = self._offsets[ids + 1] - begins
        ends = np.cumsum(lengths)
        places = np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1])
        return self._blob[places[:-1]].tobytes()


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> BacktrackingEncoder:
    return BacktrackingEncoder(path)


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, `ids` (unsigned 32-bit little-endian, one after the other) of each text.

    One row for each row of `docs`, repeated rows included; null and empty texts have no ids.
    The key may be null and of any type; other columns are not read. `path` names a BPE file of
    the tokenizers library whose splitting drops white space.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        encoder = _encoder(path)
        texts = batch.column("text").to_pylist()
        ids = [np.frombuffer(encoder.encode(t or ""), "=u4").astype("<u4").tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary())], ["key", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return map_portions(rows, "text", work, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the decoded text of `ids` (as `encode_texts` gives them) as column `into`.

    Null ids give an empty text.
    """
    columns = [f.name for f in encoded.schema.fields]
    if into in columns:
        raise ValueError(f"there is a column {into} already")
    schema = StructType([*encoded.schema.fields, StructField(into, StringType())])

    def work(batch: pa.RecordBatch):
        encoder = _encoder(path)
        texts = [
            encoder.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)).decode()
            for x in batch.column(ids).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*columns, into])

    return map_portions(encoded, ids, work, schema)
