"""Packing of token sequences: local search that fills bins by moves and exchanges until others are empty."""

from __future__ import annotations

import functools
import os
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..runtime import staged
from .batches import map_portions
from .subword import MEMORY, BlankPieces, byte_letters

# Pieces that are packed together by one task. A group leaves about one underfull bin.
GROUP = 20_000
_PORTION = 2 << 20
# Pieces that are encoded as one text.
_TOGETHER = 50_000


class IdCache:
    """Ids of whole texts by the tokenizers library, which sees each distinct blank-cut piece of a portion at most once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this process one core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        blank = byte_letters()[ord(" ")]
        size = self._library.get_vocab_size()
        self._begins = np.array([(self._library.id_to_token(i) or "").startswith(blank) for i in range(size)])
        self._memory: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _fresh(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, each of which begins with its only blank: they are encoded as one text and cut at such tokens."""
        out: list[bytes] = []
        for begin in range(0, len(pieces), _TOGETHER):
            some = pieces[begin : begin + _TOGETHER]
            ids, = self._ids([b"".join(some).decode()])
            cuts = np.append(np.flatnonzero(self._begins[ids]), len(ids)).tolist()
            if len(cuts) != len(some) + 1:
                raise ValueError("a token of this vocabulary crosses a blank")
            data = ids.tobytes()
            out.extend(data[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:]))
        return out

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        cut = BlankPieces(texts)
        memory = self._memory
        found = [*map(memory.get, cut.pieces)]
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh = self._fresh([cut.pieces[i] for i in missing])
        for i, ids in zip(missing, fresh):
            found[i] = ids
        if len(memory) + len(missing) <= MEMORY:
            memory.update(zip((cut.pieces[i] for i in missing), fresh))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        starts = np.cumsum(lengths) - lengths
        firsts = iter(self._ids(cut.firsts))
        for codes in cut.rows():
            if codes is None:
                yield next(firsts)
                continue
            own = lengths[codes]
            ends = np.cumsum(own)
            total = int(ends[-1]) if len(ends) else 0
            at = np.arange(total) + np.repeat(starts[codes] - ends + own, own)
            yield np.concatenate([next(firsts), flat[at]])


@functools.lru_cache(maxsize=2)
def _cache(path: str) -> IdCache:
    return IdCache(path)


def cut_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int = 1024, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each document's ids and `end_id`, cut into pieces of at most `capacity` tokens.

    Only the first piece of a longer document may be shorter. Result: the key, piece (from 0),
    start, length and ids (unsigned 32-bit little-endian, end to end). A null or empty text is
    a piece of `end_id` alone. Repeated rows give repeated pieces; keys may be null and of any
    type; other columns are not read. `path` must name a byte-level file, whose tokens
    never cross a single blank.
    """
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4")

    def work(batch: pa.RecordBatch):
        rows, pieces, starts, ids = [], [], [], []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for row, found in enumerate(_cache(path).texts(texts)):
            n = len(found) + 1
            data = np.concatenate([found, end]).tobytes()
            cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
            for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                rows.append(row)
                pieces.append(piece)
                starts.append(a)
                ids.append(data[4 * a : 4 * b])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key").take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            ["key", "piece", "start", "length", "ids"],
        )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {kind}, piece int, start long, length long, ids binary"
    return map_portions(rows, "text", work, schema, _PORTION).withColumnRenamed("key", key)


class _Open:
    """The underfull bins, findable by gap, by the length of an item and by the length of two items in one bin.

    Each index goes from a number to the bins that have it; a bit mask tells which numbers there are.
    """

    def __init__(self, items: list[list[int]], lengths: list[int], capacity: int):
        self.items = [list(b) for b in items]
        self.lengths = lengths
        self.gap = [capacity - sum(lengths[i] for i in b) for b in self.items]
        self.indexes: list[dict[int, dict[int, None]]] = [defaultdict(dict) for _ in range(3)]
        self.masks = [0, 0, 0]
        for b in range(len(self.items)):
            if self.gap[b]:
                self.enter(b)

    def _numbers(self, b: int) -> tuple[set[int], set[int], set[int]]:
        often = Counter(self.lengths[i] for i in self.items[b])
        some = sorted(often)
        pairs = {x + y for k, x in enumerate(some) for y in some[:k]} | {2 * x for x in some if often[x] > 1}
        return {self.gap[b]}, set(some), pairs

    def enter(self, b: int) -> None:
        for k, numbers in enumerate(self._numbers(b)):
            for n in numbers:
                self.indexes[k][n][b] = None
                self.masks[k] |= 1 << n

    def leave(self, b: int) -> None:
        for k, numbers in enumerate(self._numbers(b)):
            for n in numbers:
                found = self.indexes[k][n]
                del found[b]
                if not found:
                    self.masks[k] &= ~(1 << n)

    def fullest(self) -> int | None:
        least = self.masks[0]
        return next(iter(self.indexes[0][(least & -least).bit_length() - 1])) if least else None

    def exchange(self, a: int) -> tuple[int, int, int] | None:
        """What fills bin `a` most: (length that leaves it or 0, length that comes, items that come)."""
        best, gain = None, 0
        for out in sorted({0} | {self.lengths[i] for i in self.items[a]}):
            room = (1 << out + self.gap[a] + 1) - 1
            for k in (2, 1):
                come = (self.masks[k] & room).bit_length() - 1
                if come - out > gain:
                    best, gain = (out, come, k), come - out
        return best

    def apply(self, a: int, out: int, come: int, k: int) -> None:
        b = next(iter(self.indexes[k][come]))
        self.leave(b)
        mine, theirs, lengths = self.items[a], self.items[b], self.lengths
        taken = _of_length(theirs, lengths, come) if k == 1 else _of_two_lengths(theirs, lengths, come)
        given = _of_length(mine, lengths, out) if out else []
        self.items[a] = [i for i in mine if i not in given] + taken
        self.items[b] = [i for i in theirs if i not in taken] + given
        self.gap[a] -= come - out
        self.gap[b] += come - out
        if self.items[b]:
            self.enter(b)


def _of_length(items: list[int], lengths: list[int], n: int) -> list[int]:
    return [next(i for i in items if lengths[i] == n)]


def _of_two_lengths(items: list[int], lengths: list[int], total: int) -> list[int]:
    seen: dict[int, int] = {}
    for i in items:
        if total - lengths[i] in seen:
            return [seen[total - lengths[i]], i]
        seen[lengths[i]] = i
    raise KeyError(total)


def improve(items: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Fewer bins by local search between underfull ones.

    The fullest of them takes what fills it most: an item moves in, or it is exchanged for a shorter one, or
    two items of one bin are exchanged for one. The other bin is not fuller, so each step increases
    the sum of squared fills and the search ends. A bin that is full or that no step fills further is done; a bin
    that has given its last item is gone. There is no other bound on steps or partners.
    """
    bins = _Open(items, lengths, capacity)
    while (a := bins.fullest()) is not None:
        bins.leave(a)
        while bins.gap[a] and (step := bins.exchange(a)):
            bins.apply(a, *step)
    return [b for b in bins.items if b]


def _next_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins filled one after the other in the order given."""
    items, room = [], 0
    for i, n in enumerate(lengths):
        if n > room:
            items.append([])
            room = capacity
        items[-1].append(i)
        room -= n
    return items


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in `lengths`, each of a total of `capacity` at most.

    Local search from two plain starts: every item in a bin of its own, where moves lead; and unless that
    reaches the least number there can be, next fit, where exchanges do. The better result counts.
    """
    found = improve([[i] for i in range(len(lengths))], lengths, capacity)
    if len(found) > -(-sum(lengths) // capacity):
        found = min(found, improve(_next_fit(lengths, capacity), lengths, capacity), key=len)
    return found


def pack(pieces: DataFrame, capacity: int = 1024, length: str = "length", group: int = GROUP) -> DataFrame:
    """`pieces` with sequence_id and offset: which sequence a piece lies in, and where.

    Pieces of full length are sequences of their own and never shuffled. All others are dealt
    evenly over groups of about `group` pieces, each packed in one task, so that memory is
    bounded and only about one sequence per group stays underfull. Offsets are gapless from 0.
    All columns of `pieces` are kept, repeated rows too; an empty table gives an empty one.
    Lengths must be from 1 to `capacity`. `pieces` is read more than once: pass a written table.
    """
    numbered = pieces.withColumn("_slot", F.monotonically_increasing_id())
    full = numbered.where(F.col(length) == capacity).select(
        *pieces.columns, (F.col("_slot") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.where(F.col(length) < capacity)
    groups = max(1, -(-rest.count() // group))
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("_slot"), F.lit(groups)))
    schema = StructType([
        *pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType()),
    ])
    names = [f.name for f in schema.fields]

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        # The order in which rows arrive is no matter of chance: a repeated task gives the same result.
        rows = rows.sort_values("_slot", ignore_index=True)
        lengths = rows[length].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        base = int(rows["_group"].iloc[0]) << 32
        for b, items in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = (base | b) * 2, at
                at += lengths[i]
        return rows.assign(sequence_id=sequence, offset=offset)[names]

    return dealt.groupBy("_group").applyInPandas(work, schema).unionByName(full)


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """Pieces of all documents with the checksum of their ids instead of the ids, packed.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Texts are tokenised
    once: the narrow table of pieces is written before it is dealt out.
    """
    pieces = cut_pieces(docs, path, end_id, capacity)
    return pack(staged(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"), capacity)
