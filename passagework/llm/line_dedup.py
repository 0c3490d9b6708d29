"""Removal of repeated lines by a segment-partition join under edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import staged
from .batches import map_portions, portions, under_plain_names

THRESHOLD = 2
# Code points from which on a line may differ by all edits of the threshold; below that by fewer, in proportion.
SHORTEST = 20
# Code points of all lines that are verified together, padding included.
_CELLS = 1 << 21
# Lines of a list that are compared with each other in one task; twice as many if the list has more.
BLOCK = 512
_PORTION = 1 << 20
# Lines from this length on are compared one pair at a time, without what they have in common at their ends but for so many code points.
_LONG, _KEPT = 8192, 64
_K = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[1]
    x = (x ^ (x >> np.uint64(29))) * _K[0]
    return x ^ (x >> np.uint64(32))


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out)


class Lines:
    """Code points of many lines end to end, with hashes of all their substrings in constant time."""

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, lines: list[str]):
        self.lengths = np.array([len(x) for x in lines], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = len(points) + 1
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(points + np.uint64(1)) * _powers(n, self._BASE)[:-1])])
        self._back = _powers(n, pow(self._BASE, -1, 1 << 64))

    def hashes(self, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return (self._sums[begins + lengths] - self._sums[begins]) * self._back[begins]


def segments(lengths: np.ndarray, threshold: int):
    """(begin, length) of the threshold + 1 segments of lines of these lengths, the longer ones last."""
    parts = threshold + 1
    short, longer = lengths // parts, lengths % parts
    for i in range(parts):
        extra = np.maximum(0, i - (parts - longer))
        yield i * short + extra, short + (i >= parts - longer)


def allowed(lengths: np.ndarray, threshold: int, shortest: int) -> np.ndarray:
    """Edits by which two lines may differ of which the longer one has this length."""
    return np.minimum(threshold, lengths * threshold // shortest)


def segment_keys(lines: Lines, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, probe): under which keys each line is found, and under which it looks for others.

    Lines of a distance of at most `threshold` share a segment of the shorter one. It is looked
    for, length by length, only at the places where all its segments before and after it can have
    used up the edits: at most i before segment i, at most threshold - i after it. The line's own segments
    serve as both, so they are not repeated among its probes.
    """
    n = len(lines.lengths)
    row, keys, probes = [], [], []

    def add(which, begins, sizes, of_length, i, probe):
        mark = (of_length.astype(np.uint64) << np.uint64(16)) + np.uint64(threshold << 8 | i)
        row.append(which)
        keys.append(_mix(lines.hashes(lines.begins[which] + begins, sizes) ^ _mix(mark)))
        probes.append(np.full(len(which), probe))

    everyone = np.arange(n)
    for less in range(threshold + 1):
        target = lines.lengths - less
        for i, (begin, size) in enumerate(segments(target, threshold)):
            for shift in range(max(-i, less - (threshold - i)), min(i, less + threshold - i) + 1):
                own = less == 0 and shift == 0
                at = begin + shift
                fits = everyone[(at >= 0) & (at + size <= lines.lengths) & (size > 0)]
                add(fits, at[fits], size[fits], target[fits], i, not own)
    return np.concatenate(row), np.concatenate(keys), np.concatenate(probes)


def within(left: list[str], right: list[str], threshold: int) -> np.ndarray:
    """For each pair, whether its edit distance is at most `threshold`; no line shorter than that.

    Bit-parallel in a band of diagonals: one word holds the vertical differences of a column
    near the diagonal and moves down a row with each character. All pairs advance
    together, a column at a time. Differences of lengths beyond the threshold are false at once.
    """
    n, m = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    ok = np.abs(n - m) <= threshold
    if not ok.any():
        return ok
    pad = 2 * threshold + 2
    width, columns = int(n.max()) + 2 * pad, int(m.max())

    def grid(lines, wide, fill, shift):
        out = np.full((len(lines), wide), fill, np.uint32)
        for i, x in enumerate(lines):
            out[i, shift : shift + len(x)] = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        return out

    rows = grid(left, width, 0xFFFFFFFF, pad)
    others = grid(right, columns, 0xFFFFFFFE, 0)
    top = pad + threshold  # bit of the lowest row in the band, `threshold` below the diagonal
    full = np.uint64((1 << (top + 1)) - 1)
    diagonal, one = np.uint64(1 << top), np.uint64(1)
    plus = np.full(len(left), np.uint64(((1 << (threshold + 1)) - 1) << (top - threshold)))
    minus = np.zeros(len(left), np.uint64)
    distance = np.full(len(left), threshold)
    floor = np.full(len(left), diagonal >> one)  # the last row of `left` once the band has reached it
    for j in range(columns):
        equal = np.zeros(len(left), np.uint64)
        for k in range(top + 1):  # bit k is row j + threshold - (top - k)
            at = j + threshold - top + k + pad
            if 0 <= at < width:
                equal |= (rows[:, at] == others[:, j]).astype(np.uint64) << np.uint64(k)
        zero = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        across_plus = (minus | ~(zero | plus)) & full
        across_minus = zero & plus
        slides = j + threshold < n
        running = j < m
        step = np.where(
            slides, ((zero & diagonal) == 0).astype(int),
            ((across_plus & floor) != 0).astype(int) - ((across_minus & floor) != 0).astype(int),
        )
        distance += np.where(running, step, 0)
        floor = np.where(slides, floor, floor >> one)
        down = zero >> one
        plus = (across_minus | ~(down | across_plus)) & full
        minus = down & across_plus
    return ok & (distance <= threshold)


def within_long(a: str, b: str, threshold: int) -> bool:
    """`within` for one pair of long lines: which characters are equal is worked out for all columns at once."""
    n, m = len(a), len(b)
    if abs(n - m) > threshold:
        return False
    pad = 2 * threshold + 2
    top = pad + threshold
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    rows = np.full(max(n, m) + 2 * pad, 0xFFFFFFFF, np.uint32)
    rows[pad : pad + n] = x
    equals = np.zeros(m, np.int64)
    for k in range(top + 1):  # bit k of column j is row j + threshold - (top - k)
        begin = threshold - top + k + pad
        equals |= (rows[begin : begin + m] == y).astype(np.int64) << k
    full, diagonal = (1 << (top + 1)) - 1, 1 << top
    plus, minus = ((1 << (threshold + 1)) - 1) << (top - threshold), 0
    distance, floor = threshold, diagonal >> 1
    for j, equal in enumerate(equals.tolist()):
        zero = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        across_plus = (minus | ~(zero | plus)) & full
        across_minus = zero & plus
        if j + threshold < n:
            distance += not zero & diagonal
            # Only the last columns, 2 * threshold at most, may lower it again.
            if distance > 3 * threshold:
                return False
        else:
            distance += (across_plus & floor != 0) - (across_minus & floor != 0)
            floor >>= 1
        down = zero >> 1
        plus = (across_minus | ~(down | across_plus)) & full
        minus = down & across_plus
    return distance <= threshold


def _row_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def line_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, row, line, name, size) of each line that is not blank.

    name is a hash of 128 bits as text, row a hash of the whole text, which tells rows of one key apart.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = docs.select(F.col(key).cast("long").alias("doc"), _row_id(F.col(text)).alias("row"), F.posexplode(F.split(plain, "\n")).alias("line", "content"))
    return lines.where(F.trim("content") != "").select(
        "doc", "row", "line", F.unhex(F.md5("content")).alias("name"), F.length("content").alias("size")
    )


def _keys(docs: DataFrame, text: str, threshold: int, shortest: int) -> DataFrame:
    """(key, name, probe) of all lines that may be near another one.

    A pair is sought with as many edits as its longer line allows, so lines have the keys of one or two such numbers.
    """
    # From this length on, pairs may differ by 1, 2, ... edits.
    begins = [-(-edits * shortest // threshold) for edits in range(1, threshold + 1)]

    def work(batch: pa.RecordBatch):
        found: dict[str, None] = {}
        for t in batch.column("text").to_pylist():
            for x in t.split("\n"):
                if begins and len(x) >= begins[0] - 1 and x.strip(" "):
                    found[x] = None
        for edits, begin in enumerate(begins, 1):
            end = begins[edits] if edits < threshold else 1 << 62
            lines = [x for x in found if begin - edits <= len(x) < end]
            if not lines:
                continue
            names = pa.array([hashlib.md5(x.encode()).digest() for x in lines], pa.binary())
            row, keys, probes = segment_keys(Lines(lines), edits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), names.take(pa.array(row)), pa.array(probes)], ["key", "name", "probe"]
            )

    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return map_portions(docs.select(plain.alias("text")), "text", work, "key long, name binary, probe boolean", _PORTION)


def _near(pairs: list[tuple[str, str, bytes, int]]) -> Iterator[bytes]:
    """Names of the pairs (line, line, name, edits) that are near enough."""
    yield from (p[2] for p in pairs if len(p[0]) >= _LONG and within_long(*_bare(p[0], p[1]), p[3]))
    # Pairs of about one length together, and of long ones few, so that padding is bounded.
    pairs = sorted((p for p in pairs if len(p[0]) < _LONG), key=lambda p: (p[3], len(p[0])))
    begin = 0
    for end in range(1, len(pairs) + 1):
        if end < len(pairs) and pairs[end][3] == pairs[begin][3] and (end + 1 - begin) * len(pairs[end][0]) <= _CELLS:
            continue
        part = pairs[begin:end]
        good = within([p[0] for p in part], [p[1] for p in part], part[0][3])
        yield from (p[2] for p, near in zip(part, good) if near)
        begin = end


def _bare(a: str, b: str) -> tuple[str, str]:
    """Both lines without the beginning and the end that they have in common, which costs no edit; a little of it stays."""
    most = min(len(a), len(b))
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    unequal = np.flatnonzero(x[:most] != y[:most])
    front = max(0, int(unequal[0] if len(unequal) else most) - _KEPT)
    rest = most - front
    unequal = np.flatnonzero(x[len(x) - rest :][::-1] != y[len(y) - rest :][::-1])
    back = max(0, int(unequal[0] if len(unequal) else rest) - _KEPT)
    return a[front : len(a) - back], b[front : len(b) - back]


def _late(groups: list[dict[str, list]], threshold: int, shortest: int = SHORTEST) -> set[bytes]:
    """Names of lines that are near an earlier line of their group.

    A group's lines come in order of their first places. Each one is compared with those
    before it, a few at a time and many lines at once, until one is near enough.
    """
    open_: list[tuple[dict[str, list], int, np.ndarray, np.ndarray]] = []
    for group in groups:
        sizes = np.array([len(x) for x in group["content"]])
        probe, side = np.array(group["probe"]), np.array(group["side"])
        for j in range(1, len(sizes)):
            edits = allowed(np.maximum(sizes[:j], sizes[j]), threshold, shortest)
            fits = (np.abs(sizes[:j] - sizes[j]) <= edits) & (edits > 0) & ~(probe[:j] & probe[j])
            fits &= (side[:j] != side[j]) | (side[j] == 0)
            earlier = np.flatnonzero(fits)
            if len(earlier):
                open_.append((group, j, earlier, edits))
    late: set[bytes] = set()
    at, width = 0, 2
    while open_:
        pairs = [
            (group["content"][i], group["content"][j], group["name"][j], int(edits[i]))
            for group, j, earlier, edits in open_
            for i in earlier[at : at + width]
            if group["name"][i] != group["name"][j]
        ]
        late.update(_near(pairs))
        at, width = at + width, width * 4
        open_ = [x for x in open_ if at < len(x[2]) and x[0]["name"][x[1]] not in late]
    return late


def late_lines(
    docs: DataFrame, lines: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
    shortest: int = SHORTEST, block: int = BLOCK,
) -> DataFrame:
    """Names of `lines` that have a different line near them (see `dedup_lines`) at an earlier first place.

    Lines are cut into threshold + 1 segments and listed under each; a line probes the lists of
    its own and all shorter lengths in reach. Lists without two lines are dropped where they
    meet; texts are fetched for the rest and compared list by list, in one task each.
    A list of more than `block` lines is compared by pairs of blocks. No pair leaves a task, so a large group of
    lines that are all near each other costs comparisons but no rows.
    """
    by_key = Window.partitionBy("key")
    met = _keys(docs, text, threshold, shortest).withColumns({
        "low": F.min("name").over(by_key), "high": F.max("name").over(by_key), "listed": F.min("probe").over(by_key),
    }).where("low <> high AND NOT listed")
    met = staged(met.select("key", "name", "probe").distinct(), "line-keys")
    # One place where each line stands, then its text from there.
    places = lines.join(met.select("name").distinct(), "name").groupBy("name").agg(F.min(F.struct("doc", "row", "line")).alias("at"))
    at_docs = places.select("name", "at.doc", "at.row", "at.line").groupBy("doc", "row").agg(
        F.collect_list(F.struct("line", "name")).alias("wanted")
    )
    whole = docs.select(F.col(key).cast("long").alias("_doc"), _row_id(F.col(text)).alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    held = whole.join(at_docs, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_row") == F.col("row")))
    texts = held.select("doc", "row", F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w")).select(
        F.col("w.name").alias("name"), "doc", "row", F.col("w.line").alias("line"), F.col("lines")[F.col("w.line")].alias("content")
    )
    texts = staged(texts.dropDuplicates(["name"]), "line-texts")
    blocks = F.ceil(F.col("company") / block).cast("int")
    dealt = met.join(met.groupBy("key").agg(F.count("*").alias("company")), "key").select(
        "key", "name", "probe", F.pmod(F.xxhash64("name"), blocks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    rows = dealt.select(
        "name", "probe", F.xxhash64("key", low, high).alias("gid"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == low, 1).otherwise(2).alias("side"),
    ).join(texts, "name")
    columns = ["gid", "name", "probe", "side", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[dict[str, list]] = []
        held = 0

        def flush():
            found = _late(groups, threshold, shortest)
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], ["name"])

        for batch in batches:
            for part in portions(batch, "content", _PORTION):
                for values in zip(*(part.column(c).to_pylist() for c in columns)):
                    if not groups or groups[-1]["gid"][-1] != values[0]:
                        if held > _PORTION:
                            yield flush()
                            groups, held = [], 0
                        groups.append({c: [] for c in columns})
                    for c, v in zip(columns, values):
                        groups[-1][c].append(v)
                    held += len(values[-1])
        if groups:
            yield flush()

    ordered = rows.repartition("gid").sortWithinPartitions("gid", "doc", "row", "line").select(*columns)
    return ordered.mapInArrow(run, "name binary").distinct()


def removed_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST,
) -> DataFrame:
    """(doc, row, n_lines, exact, near): line numbers of each document that go, from 0.

    See `dedup_lines`. Documents without a line that is not blank are left out.
    """
    lines = staged(line_table(docs, key, text), "lines")
    firsts = lines.groupBy("name").agg(F.min(F.struct("doc", "row", "line")).alias("first"), F.count("*").alias("often"))
    late = late_lines(docs, lines, key, text, threshold, shortest).withColumn("late", F.lit(True))
    concerned = firsts.join(late, "name", "left").where("often > 1 OR late").select(
        "name", "first", F.coalesce("late", F.lit(False)).alias("late")
    )
    # Names of few lines are concerned; a line that stands very often has one row on this side.
    judged = lines.join(concerned, "name", "left").withColumn(
        "again", F.coalesce(F.col("first") != F.struct("doc", "row", "line"), F.lit(False))
    )
    number = F.col("line")
    return judged.groupBy("doc", "row").agg(
        F.sort_array(F.collect_set(F.when(F.col("again"), number))).alias("exact"),
        F.sort_array(F.collect_set(F.when(F.col("late") & ~F.col("again"), number))).alias("near"),
        F.size(F.collect_set("line")).cast("long").alias("n_lines"),
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST,
) -> DataFrame:
    """`docs` with the text of lines that stand nowhere earlier, and without the others.

    A line that is not blank goes if an equal line stands earlier: in a document of a smaller key, or
    further up in its own. It also goes if a line near it stood anywhere before its own first place: within
    `threshold` edits if the longer one of the two has `shortest` code points or more, within fewer in
    proportion below that (with 2 and 20: one edit from 10 code points on, none below). Judged on the input:
    a line may go for one that goes itself. Blank lines stay. All rows and columns are kept; if there is a
    column n_chars it is brought up to date. Null texts stay null, empty ones empty; a null key comes
    before all others; rows of equal key are ordered by a hash of their text, and a
    repeated row counts once and is treated like its double.
    """
    return under_plain_names(docs, partial(_dedup_lines, threshold, shortest), key=key, text=text, n_chars="n_chars")


def _dedup_lines(threshold: int, shortest: int, docs: DataFrame, key: str, text: str, n_chars: str | None) -> DataFrame:
    gone = removed_lines(docs, key, text, threshold, shortest)
    gone = gone.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.concat("exact", "near").alias("_gone"))
    gone = gone.where(F.size("_gone") > 0)
    columns = docs.columns
    marked = docs.withColumn("_hash", _row_id(F.col(text)))
    joined = marked.join(gone, F.col(key).cast("long").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_row")), "left")

    def work(batch: pa.RecordBatch):
        texts = batch.column(text).to_pylist()
        for i, lost in enumerate(batch.column("_gone").to_pylist()):
            if lost and texts[i] is not None:
                lost = set(lost)
                texts[i] = "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in lost)
        arrays = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, columns)

    kept = map_portions(joined.select(*(F.col(f"`{c}`") for c in columns), "_gone"), text, work, docs.schema)
    return kept.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars else kept


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_lines (not blank), n_exact, n_near and removed (line numbers from 0) of each row."""
    gone = removed_lines(docs, key, text)
    none = F.array().cast("array<int>")
    rows = docs.select(F.col(key).alias(key), F.col(key).cast("long").alias("_doc"), _row_id(F.col(text)).alias("_row"))
    joined = rows.join(gone, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_row") == F.col("row")), "left")
    return joined.select(
        key,
        F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce(F.size("exact"), F.lit(0)).cast("long").alias("n_exact"),
        F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.sort_array(F.concat("exact", "near")), none).alias("removed"),
    )
