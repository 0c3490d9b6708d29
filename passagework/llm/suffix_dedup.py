"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import staged
from .batches import map_portions, under_plain_names

LENGTH = 100
# Length of the strings whose smallest hash in a window decides where equal windows meet.
ANCHOR = 24
# Bytes of text whose transforms are merged by one task, and shards it is cut into.
BUCKET_BYTES = 1 << 19
SHARDS = 2
_PORTION = 1 << 20
# Runs overlap, and each of their bytes takes about 80 while they are split.
_SPLIT_PORTION = 1 << 18
_K = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[1]
    x = (x ^ (x >> np.uint64(29))) * _K[0]
    return x ^ (x >> np.uint64(32))


_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64))


class Hashes:
    """Hashes of all substrings of a byte string in constant time each."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(data, np.uint8)
        n = len(data) + 1
        up, down = np.full(n, np.uint64(_BASE)), np.full(n, np.uint64(_BACK))
        up[0] = down[0] = 1
        sums = np.zeros(n, np.uint64)
        np.cumsum(_LETTERS[self.bytes] * np.cumprod(up)[:-1], out=sums[1:])
        self._sums, self._down = sums, np.cumprod(down)

    def at(self, begins, ends) -> np.ndarray:
        return (self._sums[ends] - self._sums[begins]) * self._down[begins]


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of `width`, by windows of doubled width."""
    least, size = x, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def windows(data: bytes, length: int, anchor: int):
    """Runs of windows of `length` bytes with the same smallest anchor hash.

    Returns begin and end of each run's bytes, the anchor hash, a hash of those bytes, and whether the
    anchor hash occurs twice in them, so that a window may repeat within the run. Where a window
    lies in its run and which anchor it has follows from its content alone: equal windows
    anywhere have the same anchor hash.
    """
    if len(data) < length:
        return None
    hashes = Hashes(data)
    starts = np.arange(len(data) - anchor + 1)
    grams = _mix(hashes.at(starts, starts + anchor))
    width = length - anchor + 1
    least = _sliding_least(grams, width)
    begins = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    counts = np.diff(np.append(begins, len(least)))
    ends = begins + counts + length - 1
    # Anchors among the strings that the run's windows hold.
    spans = counts + width - 1
    first = np.cumsum(spans) - spans
    places = np.repeat(begins - first, spans) + np.arange(spans.sum())
    hits = grams[places] == np.repeat(least[begins], spans)
    twice = np.add.reduceat(hits, first) > 1
    return begins, ends, least[begins], _mix(hashes.at(begins, ends) + (ends - begins).astype(np.uint64)), twice


def _ident(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, row, text): the key (a null one first), a hash of the text, and the text (null: empty)."""
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)).cast("long")).alias("doc"), _ident(F.col(text)).alias("row"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def _runs(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """(gram, content, doc, row, start, size, twice) of all runs of windows."""

    def work(batch: pa.RecordBatch):
        docs, idents = batch.column("doc").to_numpy(zero_copy_only=False), batch.column("row").to_numpy(zero_copy_only=False)
        parts: list[tuple] = []
        for i, text in enumerate(batch.column("text").to_pylist()):
            found = windows(text.encode(), length, anchor)
            if found is not None:
                begins, ends, gram, content, twice = found
                n = len(begins)
                parts.append((gram, content, np.full(n, docs[i]), np.full(n, idents[i]), begins, ends - begins, twice))
        if parts:
            columns = [np.concatenate(c) for c in zip(*parts)]
            arrays = [pa.array(c.view(np.int64)) for c in columns[:4]]
            arrays += [pa.array(c.astype(np.int32)) for c in columns[4:6]] + [pa.array(columns[6])]
            yield pa.RecordBatch.from_arrays(arrays, ["gram", "content", "doc", "row", "start", "size", "twice"])

    schema = "gram long, content long, doc long, row long, start int, size int, twice boolean"
    return map_portions(rows, "text", work, schema, _PORTION)


def split_runs(runs: list[bytes], length: int, anchor: int):
    """Windows of runs by anchor and side: (run, key, begin, end, lead, near, far) of parts that may hold equal windows.

    A window has at least half of its other bytes after its first anchor or before it; these
    bytes and the anchor name the part. Equal windows are in parts of equal names, and few others are.
    Parts come in order of run and begin. The anchor is `lead` bytes behind the part's begin; parts of
    this side hold windows with `near` to `far` bytes before the anchor.
    """
    sizes = np.array([len(r) for r in runs])
    starts = np.cumsum(sizes) - sizes
    hashes = Hashes(b"".join(runs))
    # Anchors: of each run, the places of its smallest hash.
    counts = sizes - anchor + 1
    firsts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(runs)), counts)
    at = np.arange(counts.sum()) - firsts[owner]
    places = starts[owner] + at
    grams = _mix(hashes.at(places, places + anchor))
    least = np.minimum.reduceat(grams, firsts)
    hit = grams == least[owner]
    run, a = owner[hit], at[hit]
    before = np.concatenate([[-1], a[:-1]])
    before[np.concatenate([[True], run[1:] != run[:-1]])] = -1
    last = sizes[run] - length
    half = (length - anchor + 1) // 2
    # Windows from here on have `half` bytes after the anchor, those before it have them in front.
    turn = a + anchor + half - length
    out = []
    for side, low, high in ((1, np.maximum(before + 1, turn), a), (0, before + 1, np.minimum(a, turn - 1))):
        low, high = np.maximum(low, 0), np.minimum(high, last)
        some = low <= high
        r, x, low, high = run[some], a[some], low[some], high[some]
        begin, end = (x + anchor, x + anchor + half) if side else (x - half, x)
        key = _mix(hashes.at(starts[r] + begin, starts[r] + end) ^ _mix(least[r] + np.uint64(side)))
        near, far = (0, length - anchor - half) if side else (length - anchor - half + 1, length - anchor)
        out.append((r, key, low, high + length, x - low, np.full(len(r), near), np.full(len(r), far)))
    columns = [np.concatenate(c) for c in zip(*out)]
    order = np.lexsort((columns[2], columns[0]))
    return tuple(c[order] for c in columns)


def _parts(fetched: DataFrame, length: int, anchor: int) -> DataFrame:
    """(key, doc, row, start, size, lead, near, far, content) of the parts of fetched runs.

    A part that repeats within its own run is covered as a whole: its content is null.
    """

    def work(batch: pa.RecordBatch):
        pieces, docs, rows, starts = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("doc", "row", "text", "wanted"))
        for doc, row, text, wanted in zip(*columns):
            data = text.encode()
            for run in wanted:
                pieces.append(data[run["start"] : run["start"] + run["size"]])
                docs.append(doc)
                rows.append(row)
                starts.append(run["start"])
        if not pieces:
            return
        run, key, begin, end, lead, near, far = split_runs(pieces, length, anchor)
        contents, seen, now = [], set(), -1
        for r, x, y in zip(run.tolist(), begin.tolist(), end.tolist()):
            if r != now:
                seen, now = set(), r
            content = pieces[r][x:y]
            contents.append(None if content in seen else content)
            seen.add(content)
        arrays = [
            key.view(np.int64), np.array(docs)[run], np.array(rows)[run],
            (np.array(starts)[run] + begin).astype(np.int32), (end - begin).astype(np.int32),
            *(c.astype(np.int32) for c in (lead, near, far)),
        ]
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, arrays), pa.array(contents, pa.binary())],
            ["key", "doc", "row", "start", "size", "lead", "near", "far", "content"],
        )

    schema = "key long, doc long, row long, start int, size int, lead int, near int, far int, content binary"
    return map_portions(fetched, "text", work, schema, _SPLIT_PORTION)


def _halved(parts: DataFrame, length: int) -> DataFrame:
    """`parts` cut in two by how many bytes their windows have before the anchor, under longer names.

    All windows of a half hold the anchor, as many bytes before it as the one that has fewest, and as many after
    it as the one that has most before; these bytes name the half. Equal windows stay together.
    Once `near` equals `far`, a part is one window, named by all its bytes.
    """
    middle = F.floor((F.col("near") + F.col("far")) / 2).cast("int")
    halves = parts.withColumn("half", F.explode(F.array(
        F.struct(F.col("near").alias("near"), middle.alias("far")), F.struct((middle + 1).alias("near"), F.col("far").alias("far"))
    ))).withColumns({
        # Bytes before the anchor in the half's first and last window.
        "most": F.least("lead", "half.far"), "fewest": F.greatest(F.col("lead") - F.col("size") + length, F.col("half.near")),
    }).where("fewest <= most AND half.near <= half.far").withColumns({
        "begin": F.col("lead") - F.col("most"), "wide": F.col("most") - F.col("fewest") + length,
    })
    named = F.substring("content", F.col("lead") - F.col("half.near") + 1, length - F.col("half.far") + F.col("half.near"))
    return halves.select(
        F.xxhash64("key", "half.near", named).alias("key"), "doc", "row", (F.col("start") + F.col("begin")).alias("start"),
        F.col("wide").alias("size"), F.col("most").alias("lead"), "half.near", "half.far",
        F.substring("content", F.col("begin") + 1, F.col("wide")).alias("content"),
    )


def _within_tasks(parts: DataFrame, length: int, bytes_per_task: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Different parts whose keys fit a task, with the bytes of their key, and covered spans found on the way.

    Keys of more bytes than a task takes are split by longer names until they fit. A name that
    is a whole window has equal parts only, so this ends, and no key is merged above the limit.
    """
    place = F.struct("doc", "row", "start")
    columns = ["key", "doc", "row", "start", "size", "lead", "near", "far", "content", "total"]
    fits = (F.col("total") <= bytes_per_task) | (F.col("near") == F.col("far"))
    ready, spans, large = [parts.where(fits)], [], parts.where(~fits)
    while not large.isEmpty():
        halves = staged(_halved(large, length), "halved-parts")
        firsts = halves.groupBy("key", "content").agg(
            F.min(place).alias("first"), *(F.first(c).alias(c) for c in ("size", "lead", "near", "far")), F.count("*").alias("often")
        )
        firsts = staged(firsts, "first-halves")
        copies = firsts.where("often > 1").select("key", "content", "first")
        spans.append(halves.join(copies, ["key", "content"]).where(F.col("first") != place).select("doc", "row", "start", "size"))
        totals = firsts.groupBy("key").agg(F.sum(F.length("content")).alias("total"), F.count("*").alias("different"))
        met = firsts.join(totals.where("different > 1"), "key").select("*", "first.doc", "first.row", "first.start").select(*columns)
        met = staged(met, "met-halves")
        ready.append(met.where(fits))
        large = met.where(~fits)
    return ready, spans


class ShardTransform:
    """Sorted suffixes of a shard's strings and the byte before each.

    Every string ends in a mark of its own, smaller than all bytes and than the marks of later strings.
    """

    def __init__(self, strings: list[bytes], depth: int):
        sizes = np.array([len(s) + 1 for s in strings])
        self.begins = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        symbols = np.zeros(n, np.int64)
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        marks = self.begins + sizes - 1
        symbols[:] = data.astype(np.int64) + len(strings)
        symbols[marks] = np.arange(len(strings))
        rank, reach = symbols, 1
        while True:
            # Ranks by the first 2 * reach symbols from those by `reach`; past a mark nothing counts.
            after = np.zeros(n, np.int64)
            after[:-reach] = rank[reach:]
            pair = rank * (n + 257) + np.where(self._past(marks, n, reach), 0, after + 1)
            order = np.argsort(pair, kind="stable")
            new = np.concatenate([[True], pair[order][1:] != pair[order][:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            reach *= 2
            if new.all():
                break
        self.order = order
        before = np.empty(n, np.int16)
        before[1:] = data[:-1]
        before[self.begins] = -1  # a string's first suffix has nothing before it
        self.transform = before[order]
        self.count = len(strings)

    @staticmethod
    def _past(marks: np.ndarray, n: int, reach: int) -> np.ndarray:
        """True where the suffix ends, with its mark, within `reach` symbols."""
        to_mark = np.repeat(marks, np.diff(np.concatenate([[-1], marks]))) - np.arange(n)
        return to_mark < reach


def merge_transforms(shards: list[ShardTransform], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, place in its order, block) of all suffixes, in order of their first `depth` bytes.

    Nothing is sorted anew: the merged order starts with one shard after the other, and each
    round refines which shard comes next. The bytes before the suffixes, read in the present order, are dealt out
    stably by value; that is the order by one byte more. A block is what still has a common
    prefix as long as the rounds done; it splits where bytes or earlier blocks differ.
    Blocks of two or more suffixes at the end share `depth` bytes.
    """
    marks = sum(s.count for s in shards)
    sizes = [len(s.order) for s in shards]
    # The marks come first, in order of shards and strings; no round moves them.
    head = np.repeat(np.arange(len(shards), dtype=np.uint8), [s.count for s in shards])
    source = np.concatenate([head, np.repeat(np.arange(len(shards), dtype=np.uint8), [n - s.count for n, s in zip(sizes, shards)])])
    block = np.zeros(len(source), np.int32)  # before the first round, all are alike
    heads = np.arange(marks, dtype=np.int32)
    before = np.empty(len(source), np.int16)
    for _ in range(depth):
        for i, shard in enumerate(shards):
            before[source == i] = shard.transform
        # 16-bit letters are dealt out by counting; those of string starts (-1) come first.
        moved = np.argsort(before, kind="stable")[marks:]
        letters, was = before[moved], block[moved]
        source = np.concatenate([head, source[moved]])
        splits = np.empty(len(was), bool)
        splits[:1] = True
        splits[1:] = (letters[1:] != letters[:-1]) | (was[1:] != was[:-1])
        new = np.concatenate([heads, np.cumsum(splits, dtype=np.int32) + np.int32(marks - 1)])
        done = new[-1] == len(new) - 1 if len(new) else True
        block = new
        if done:
            break
    place = np.empty(len(source), np.int64)
    for i in range(len(shards)):
        mine = source == i
        place[mine] = np.arange(mine.sum())
    return source, place, block


def repeated(strings: list[bytes], owners: np.ndarray, length: int, shards: int = SHARDS) -> Iterator[tuple[int, int, int]]:
    """(string, begin, end) of the bytes covered by `length`-byte strings that also start earlier.

    `owners` has a row of order for each string: its document, that document's hash and its start there.
    """
    if not len(strings):
        return
    cuts = np.linspace(0, len(strings), min(shards, len(strings)) + 1).astype(int)
    parts = [ShardTransform(strings[a:b], length) for a, b in zip(cuts, cuts[1:])]
    source, place, block = merge_transforms(parts, length)
    sizes = np.bincount(block)
    common = np.flatnonzero(sizes[block] > 1)
    if not len(common):
        return
    at = np.empty(len(common), np.int64)
    which = np.empty(len(common), np.int64)
    for i, part in enumerate(parts):
        mine = source[common] == i
        suffix = part.order[place[common[mine]]]
        string = np.searchsorted(part.begins, suffix, "right") - 1
        which[mine], at[mine] = string + cuts[i], suffix - part.begins[string]
    start = owners[which, 2] + at
    order = np.lexsort((start, owners[which, 1], owners[which, 0], block[common]))
    classes = block[common][order]
    later = np.concatenate([[False], classes[1:] == classes[:-1]])
    # One place may stand in several strings: copies of the class's first place are no repeats.
    doc, row = owners[which, 0], owners[which, 1]
    first = order[np.maximum.accumulate(np.where(later, 0, np.arange(len(order))))]
    same = (doc[order] == doc[first]) & (row[order] == row[first]) & (start[order] == start[first])
    hit = order[later & ~same]
    which, at = which[hit], at[hit]
    order = np.lexsort((at, which))
    which, at = which[order], at[order]
    new = np.concatenate([[True], (which[1:] != which[:-1]) | (at[1:] > at[:-1] + length)]) if len(at) else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    for i, j in zip(begins, np.append(begins[1:], len(at))):
        yield int(which[i]), int(at[i]), int(at[j - 1]) + length


def _merged(parts: DataFrame, length: int, bytes_per_task: int) -> DataFrame:
    """(doc, row, start, size): covered bytes found in the parts of equal keys, of which each has `total` bytes."""
    total = parts.agg(F.sum(F.length("content"))).first()[0] or 0
    buckets = max(1, -(-total // bytes_per_task))
    dealt = parts.withColumn("bucket", F.pmod("key", F.lit(buckets))).repartition(buckets, "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        held = 0

        def flush():
            table = pa.concat_tables(waiting)
            owners = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("doc", "row", "start")], 1)
            found = list(repeated(table.column("content").to_pylist(), owners, length))
            which = [w for w, _, _ in found]
            picked = owners[which] if which else np.zeros((0, 3), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(picked[:, 0]), pa.array(picked[:, 1]),
                 pa.array((picked[:, 2] + [a for _, a, _ in found]).astype(np.int32) if which else [], pa.int32()),
                 pa.array([b - a for _, a, b in found], pa.int32())],
                ["doc", "row", "start", "size"],
            )

        # Sorted by key: what is held is worked off before a key that it has no room for.
        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys, totals = table.column("key").to_numpy(), table.column("total").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            begin = 0
            for a in cuts[:-1]:
                if keys[a] == last:
                    continue
                if held and held + totals[a] > bytes_per_task:
                    waiting.append(table.slice(begin, a - begin))
                    begin = a
                    yield flush()
                    waiting, held = [], 0
                held += totals[a]
                last = keys[a]
            waiting.append(table.slice(begin))
        if any(t.num_rows for t in waiting):
            yield flush()

    columns = dealt.select("bucket", "key", "doc", "row", "start", "content", "total").sortWithinPartitions("key", "doc", "row", "start")
    return columns.mapInArrow(run, "doc long, row long, start int, size int")


def covered(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
    bytes_per_task: int = BUCKET_BYTES,
) -> DataFrame:
    """(doc, row, start, size): bytes that a `length`-byte string covers which also starts earlier.

    Windows of `length` bytes are dealt out in runs by their smallest anchor hash, so that all
    places of a repeated string meet. Runs that are equal as a whole are settled there: all but the earliest are
    covered. The earliest ones of different runs that meet, and runs that may repeat
    inside, are cut up by their bytes around the anchor, by more of them where more than `bytes_per_task` would meet; where
    different parts meet, their transforms are merged shard
    by shard, which shows all common prefixes of `length` bytes and so the repeated
    windows. Spans may overlap.
    """
    rows = _rows(docs, key, text)
    by_gram = Window.partitionBy("gram")
    # One shuffle: what stands alone goes where it meets nothing.
    runs = _runs(rows, length, anchor).withColumns({
        "low": F.min("content").over(by_gram), "high": F.max("content").over(by_gram), "often": F.count("*").over(by_gram),
    }).where("often > 1 OR twice").select(
        "gram", "content", "doc", "row", "start", "size", ((F.col("low") != F.col("high")) | F.col("twice")).alias("open")
    )
    runs = staged(runs, "runs")
    place = F.struct("doc", "row", "start")
    firsts = staged(
        runs.groupBy("gram", "content").agg(F.min(place).alias("first"), F.first("size").alias("size"), F.first("open").alias("open"), F.count("*").alias("often")),
        "first-runs",
    )
    whole = runs.join(firsts.where("often > 1").select("gram", "content", "first"), ["gram", "content"]).where(
        F.col("first") != place
    ).select("doc", "row", "start", "size")
    wanted = firsts.where("open").select("first.doc", "first.row", "first.start", "size").groupBy("doc", "row").agg(
        F.collect_list(F.struct("start", "size")).alias("wanted")
    )
    fetched = rows.join(wanted, ["doc", "row"]).select("doc", "row", "text", "wanted").dropDuplicates(["doc", "row"])
    parts = staged(_parts(fetched, length, anchor), "parts")
    inner = parts.where("content IS NULL").select("doc", "row", "start", "size")
    # Parts that are equal as a whole are settled like runs: their first one goes on, if others meet it.
    by_key = Window.partitionBy("key")
    in_order = Window.partitionBy("key", "content").orderBy("doc", "row", "start")
    met = parts.where("content IS NOT NULL").withColumns({
        "low": F.min("content").over(by_key), "high": F.max("content").over(by_key), "nth": F.row_number().over(in_order),
    }).withColumn("total", F.sum(F.when(F.col("nth") == 1, F.length("content"))).over(by_key))
    met = met.withColumn("other", F.col("low") != F.col("high")).where("nth > 1 OR other")
    met = staged(met.drop("low", "high"), "met-parts")
    again = met.where("nth > 1").select("doc", "row", "start", "size")
    ready, spans = _within_tasks(met.where("nth = 1 AND other").drop("nth", "other"), length, bytes_per_task)
    merged = _merged(reduce(DataFrame.unionByName, ready), length, bytes_per_task)
    return reduce(DataFrame.unionByName, [whole, inner, again, *spans, merged])


def _spans(found: list | None, n: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in `found` (start and size), ascending."""
    out: list[list[int]] = []
    for a, b in sorted((f["start"], f["start"] + f["size"]) for f in found or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    found = covered(docs, key, text, length).groupBy("doc", "row").agg(F.collect_list(F.struct("start", "size")).alias("_found"))
    found = found.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), "_found")
    ordinal = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)).cast("long"))
    marked = docs.withColumns({"_ordinal": ordinal, "_ident": _ident(F.col(text))})
    return marked.join(found, (F.col("_ordinal") == F.col("_doc")) & (F.col("_ident") == F.col("_row")), "left")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 of each row.

    Every byte that is covered by a string of `length` bytes which also starts earlier (in a document of a
    smaller key, or earlier in the same one) counts as removed; strings are judged on the
    input and never cross documents. Null texts are empty; a null key comes before all others; rows of
    equal key are ordered by a hash of their text, and a repeated row counts once and
    is treated like its double. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = _with_spans(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", length)

    def work(batch: pa.RecordBatch):
        sizes, removed, spans, digests = [], [], [], []
        for text_, found in zip(batch.column("text").to_pylist(), batch.column("_found").to_pylist()):
            data = text_.encode()
            gone = _spans(found, len(data))
            kept, at = hashlib.sha256(), 0
            for a, b in gone:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            sizes.append(len(data))
            removed.append(sum(b - a for a, b in gone))
            spans.append(len(gone))
            digests.append(kept.hexdigest())
        numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), *numbers, pa.array(digests, pa.string())], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    plain = rows.select("key", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "_found")
    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_portions(plain, "text", work, schema).withColumnRenamed("key", key)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`docs` without the bytes that `report` counts as removed; characters of which only a part goes stay.

    All rows and columns are kept; a column n_chars is brought up to date; null texts stay null.
    """
    return under_plain_names(docs, partial(_dedup, length), key=key, text=text, n_chars="n_chars")


def _dedup(length: int, docs: DataFrame, key: str, text: str, n_chars: str | None) -> DataFrame:
    columns = docs.columns
    joined = _with_spans(docs, key, text, length).select(*(F.col(f"`{c}`") for c in columns), "_found")

    def work(batch: pa.RecordBatch):
        texts = batch.column(text).to_pylist()
        for i, found in enumerate(batch.column("_found").to_pylist()):
            if found and texts[i] is not None:
                data = texts[i].encode()
                out, at = [], 0
                for a, b in _spans(found, len(data)):
                    while a < b and data[a] & 0xC0 == 0x80:  # not within a character
                        a += 1
                    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                        b -= 1
                    out.append(data[at:a])
                    at = b
                out.append(data[at:])
                texts[i] = b"".join(out).decode()
        arrays = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, columns)

    kept = map_portions(joined, text, work, docs.schema)
    return kept.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars else kept
