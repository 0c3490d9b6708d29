"""Similarity join of word shingles by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged
from .batches import map_portions, under_plain_names
from .components import components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
# Tokens on a path; a set that still has much company at its end is compared in blocks.
DEPTH = 3
# A bucket of at most so many sets is not split further.
SMALL = 128
# Sets of one block: two blocks meet in a task at most.
BLOCK = 512
# Sampled tokens of a set; the paths use the first ones.
SAMPLES = 40
_PORTION = 1 << 20
_K = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_BLANKS = np.zeros(256, bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True


def runs_needed(similarity: float = SIMILARITY, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability `recall`.

    In one run it stays together along a path of `depth` sampled tokens with
    probability similarity ** depth, and the runs are independent.
    """
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def least_equal(similarity: float, samples: int = SAMPLES) -> float:
    """Share of equal samples from which a pair is compared exactly: five standard deviations below `similarity`."""
    return max(0.0, similarity - 5 * math.sqrt(similarity * (1 - similarity) / samples))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[1]
    x = (x ^ (x >> np.uint64(29))) * _K[0]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit names of the runs of `words` words of each lower-cased text.

    Words are parted by ASCII white space. A text of fewer words, one at least, is a single run.
    """
    data = np.frombuffer("\n".join([*(t.lower() for t in texts), ""]).encode(), np.uint8)
    blank = _BLANKS[data]
    inside = ~blank
    begins = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
    # Texts end at the line breaks put between them; their own are found by length.
    sizes = np.array([len(t.lower().encode()) + 1 for t in texts])
    edges = np.concatenate([[0], np.cumsum(sizes)])
    bounds = np.searchsorted(begins, edges)
    if not len(begins):
        return [np.zeros(0, np.uint64) for _ in texts]
    lengths = np.diff(np.append(begins, len(data)))
    place = np.arange(len(data) - begins[0]) - np.repeat(begins - begins[0], lengths)
    longest = int(place.max()) + 1
    powers = np.cumprod(np.full(longest, _K[0], np.uint64))
    letters = np.where(blank, np.uint64(0), _mix(np.arange(1, 257, dtype=np.uint64))[data])[begins[0] :]
    names = _mix(np.add.reduceat(letters * powers[place], begins - begins[0]))
    padded = np.concatenate([names, np.zeros(words, np.uint64)])
    runs = np.zeros(len(names), np.uint64)
    for i in range(words):
        runs = (runs + padded[i : i + len(names)]) * _K[2]
        runs ^= runs >> np.uint64(31)
    runs = _mix(runs)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= words:
            out.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            few = np.zeros(1, np.uint64)
            for name in names[a:b]:
                few = _mix(few * _K[2] + name)
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sampled(sets: list[np.ndarray], samples: int = SAMPLES) -> np.ndarray:
    """For each set, `samples` tokens: each the first one in another random order of all tokens.

    Two sets have equal tokens at a place with the probability of their Jaccard similarity.
    """
    full = [s for s in sets if len(s)]
    out = np.zeros((len(sets), samples), np.uint32)
    if not full:
        return out
    tokens = np.concatenate(full)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in full])[:-1]])
    rows = np.array([bool(len(s)) for s in sets])
    orders = np.random.default_rng(20).integers(1, 2**63, (samples, 2), dtype=np.uint64)
    for j, (a, b) in enumerate(orders):
        order = (tokens ^ a) * (b | np.uint64(1))
        order ^= order >> np.uint64(31)
        order *= _K[1]
        out[rows, j] = (np.minimum.reduceat(order, begins) >> np.uint64(32)).astype(np.uint32)
    return out


def text_id(text: Column) -> Column:
    """What equal texts have in common; a null text counts as empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """key, tid, size (distinct shingles) and samples (SAMPLES 32-bit numbers) of each row."""
    kind = docs.schema[key].dataType.simpleString()
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def work(batch: pa.RecordBatch):
        sets = shingle_sets(batch.column("text").to_pylist(), words)
        picked = sampled(sets)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("tid"), pa.array([len(s) for s in sets], pa.int32()),
             pa.array([p.tobytes() for p in picked], pa.binary())],
            ["key", "tid", "size", "samples"],
        )

    rows = docs.select(F.col(key).alias("key"), text_id(F.col(text)).alias("tid"), plain.alias("text"))
    return map_portions(rows, "text", work, f"key {kind}, tid string, size int, samples binary", _PORTION)


def _paths(texts: DataFrame, runs: int, depth: int, small: int) -> DataFrame:
    """(tid, run, path, company): the bucket in which each run's path ends, if it has company there.

    A path grows by the next sampled token while its bucket has more than `small` sets. Buckets are counted
    before the shuffle; a level is written before the next one splits what is still large.
    """
    def token(at: Column) -> Column:
        return F.substring("samples", (at * 4 + 1).cast("int"), F.lit(4))

    level = texts.where("size > 0").select("tid", "samples", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    level = level.withColumn("path", F.xxhash64("run", token(F.col("run") * depth)))
    ends = []
    for d in range(1, depth + 1):
        counts = level.groupBy("path").agg(F.count("*").alias("company")).where("company > 1")
        met = staged(level.join(counts, "path").select("tid", "samples", "run", "path", "company"), f"paths-{d}")
        ends.append(met.where((F.col("company") <= small) | F.lit(d == depth)).select("tid", "run", "path", "company"))
        if d == depth:
            break
        large = met.where(F.col("company") > small)
        if large.isEmpty():
            break
        level = large.select(
            "tid", "samples", "run", F.xxhash64("path", token(F.col("run") * depth + d)).alias("path")
        )
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return out


def _groups(ends: DataFrame, block: int) -> DataFrame:
    """(tid, gid, run, side): buckets, and pairs of blocks of buckets with more than `block` sets.

    A set of a large bucket goes to each pair of blocks that has its own; side tells which of both it is.
    """
    blocks = F.ceil(F.col("company") / block).cast("int")
    own = F.when(blocks > 1, F.pmod(F.xxhash64("tid"), blocks)).otherwise(0).cast("int")
    dealt = ends.select("tid", "run", "path", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(
        "tid", "run", F.xxhash64("path", low, high).alias("gid"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == low, 1).otherwise(2).alias("side"),
    )


def _by_group(rows: DataFrame, work, schema: str) -> DataFrame:
    """`work` on the rows of each gid, as a dict of lists; groups are of bounded size."""
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.strip().split()[0] for f in schema.split(",")]
        waiting: dict[str, list] = {c: [] for c in columns}
        made: list[tuple] = []

        def groups():
            for batch in batches:
                # Bytes of Arrow buffers are copied out a portion at a time.
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    got = {c: part.column(c).to_pylist() for c in columns}
                    for i, gid in enumerate(got["gid"]):
                        if waiting["gid"] and waiting["gid"][-1] != gid:
                            yield dict(waiting)
                            for c in columns:
                                waiting[c] = []
                        for c in columns:
                            waiting[c].append(got[c][i])
            if waiting["gid"]:
                yield dict(waiting)

        for group in groups():
            made.extend(work(group))
            if len(made) >= 4096:
                yield _batch(made, names)
                made = []
        if made:
            yield _batch(made, names)

    return rows.repartition("gid").sortWithinPartitions("gid").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"gid": pa.int64(), "tid": pa.string(), "links": pa.int64(), "root": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(zip(*rows), names)], names)


def _candidates(group: dict[str, list], similarity: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs (i, j) of a group to be compared: first met in this run, of fitting sizes, much alike in samples."""
    size = np.array(group["size"])
    side = np.array(group["side"])
    run = group["run"][0]
    picked = np.frombuffer(b"".join(group["samples"]), np.uint32).reshape(len(size), -1)
    earlier = np.array([p[:run] for p in group["paths"]], object)
    left, right = [], []
    for i in range(len(size)):
        others = np.arange(i + 1, len(size))
        ratio = np.minimum(size[others], size[i]) / np.maximum(size[others], size[i])
        others = others[(ratio >= similarity) & ((side[others] != side[i]) | (side[i] == 0))]
        if not len(others):
            continue
        others = others[(picked[others] == picked[i]).mean(1) >= least_equal(similarity)]
        if run and len(others):
            met = (earlier[others] == earlier[i]) & (earlier[others] != np.array(None))
            others = others[~met.any(1)]
        left.append(np.full(len(others), i))
        right.append(others)
    if not left:
        return None
    i, j = np.concatenate(left), np.concatenate(right)
    return (i, j) if len(i) else None


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs."""
    if len(i) <= 32:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1  # the rest is in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for at in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total[i, j].astype(np.int64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _classes(
    docs: DataFrame, key: str, text: str, words: int, similarity: float, recall: float, depth: int, small: int, block: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows (key, tid), and for each text (tid, first, class_id, n_links, keeper)."""
    runs = runs_needed(similarity, recall, depth)
    if runs * depth > SAMPLES:
        raise ValueError(f"{runs} runs of {depth} tokens need more than {SAMPLES} samples")
    rows = staged(sketches(docs, key, text, words), "sketches")
    texts = rows.groupBy("tid").agg(
        F.min("key").alias("first"), F.first("size").alias("size"), F.first("samples").alias("samples")
    )
    texts = staged(texts, "texts")
    ends = _paths(texts, runs, depth, small)
    by_run = F.map_from_entries(F.collect_list(F.struct("run", "path")))
    seen = ends.groupBy("tid").agg(by_run.alias("by_run")).select(
        "tid", F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.col("by_run")[r]).alias("paths")
    )
    known = staged(texts.join(seen, "tid").select("tid", "first", "size", "samples", "paths"), "known")
    grouped = _groups(ends, block).join(known.drop("first"), "tid")

    def promising(group: dict[str, list]):
        found = _candidates(group, similarity)
        if found is not None:
            for i in np.unique(np.concatenate(found)):
                yield group["gid"][i], group["tid"][i]

    active = _by_group(grouped.select("gid", "tid", "run", "side", "size", "samples", "paths"), promising, "gid long, tid string")
    active = staged(active, "active")
    # A text's groups are bounded by runs and blocks; its set is made once for all of them.
    wanted = active.join(_groups(ends, block), ["gid", "tid"]).groupBy("tid").agg(
        F.collect_list(F.struct("gid", "run", "side")).alias("groups")
    ).join(known, "tid")
    whole = docs.select(F.col(key).alias("_key"), text_id(F.col(text)).alias("_tid"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    fetched = whole.join(wanted, (F.col("_tid") == F.col("tid")) & F.col("_key").eqNullSafe(F.col("first")))
    fetched = fetched.select("tid", "text", "size", "samples", "paths", "groups")

    def sets(batch: pa.RecordBatch):
        found = shingle_sets(batch.column("text").to_pylist(), words)
        kept = [batch.column(c) for c in ("tid", "size", "samples", "paths", "groups")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array([s.tobytes() for s in found], pa.binary())],
                                         ["tid", "size", "samples", "paths", "groups", "set"])

    group_type = "array<struct<gid:bigint,run:int,side:int>>"
    with_sets = map_portions(
        fetched, "text", sets, f"tid string, size int, samples binary, paths array<bigint>, groups {group_type}, set binary", _PORTION
    )
    exploded = with_sets.withColumn("group", F.explode("groups")).select(
        "group.gid", "tid", "group.run", "group.side", "size", "samples", "paths", "set"
    )

    def verified(group: dict[str, list]):
        # A repeated row brings its text twice.
        once = {t: i for i, t in enumerate(group["tid"])}
        group = {c: [v[i] for i in once.values()] for c, v in group.items()}
        found = _candidates(group, similarity)
        if found is None:
            return
        i, j = found
        members = [np.frombuffer(s, np.uint64) for s in group["set"]]
        common = _common(members, i, j)
        sizes = np.array([len(s) for s in members])
        linked = common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9
        i, j = i[linked], j[linked]
        links = np.bincount(np.concatenate([i, j]), minlength=len(members))
        for m, root in enumerate(_roots(len(members), i, j)):
            if links[m]:
                yield group["tid"][m], int(links[m]), group["tid"][root]

    found = staged(_by_group(exploded, verified, "tid string, links long, root string"), "links")
    links = found.groupBy("tid").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("tid").alias("u"), F.col("root").alias("v")))
    classes = (
        texts.select("tid", "first").join(roots.withColumnRenamed("node", "tid"), "tid", "left")
        .withColumn("root", F.coalesce("root", "tid"))
    )
    place = F.struct(F.col("first").isNull().alias("none"), "first", "tid")
    least = classes.groupBy("root").agg(F.min(place).alias("least"))
    result = classes.join(least, "root").join(links, "tid", "left").select(
        "tid", "first", F.col("least.first").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (F.col("tid") == F.col("least.tid")).alias("keeper"),
    )
    return rows.select("key", "tid"), result


def join_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY,
    recall: float = RECALL, depth: int = DEPTH, small: int = SMALL, block: int = BLOCK,
) -> DataFrame:
    """key, class_id and n_links of each row: near duplicates by Jaccard similarity of word shingles.

    Two different texts are linked if their sets of `words`-word shingles (lower-cased) have a
    similarity of `similarity` or more; n_links counts the different texts that a text is
    linked to, and class_id is the smallest key among all rows that links and equal texts connect it
    to. Each of the runs splits all sets by sampled tokens they share, path by path, until
    buckets are small; there each pair is judged on its samples and then exactly on its sets, in the
    first run in which it meets. There are as many runs as `recall` needs for pairs just at
    the threshold; more similar ones are missed far more rarely. Buckets that stay large at the
    end of the path are compared block by block, so none is left out or held by one task.

    A null text is empty. Texts without words have no links; equal ones are of one class.
    Keys may be null (a class of nulls alone has a null class_id); repeated rows are equal
    texts. Other columns are not read.
    """
    rows, result = _classes(docs, key, text, words, similarity, recall, depth, small, block)
    return rows.join(result, "tid").select(F.col("key").alias(key), "class_id", "n_links")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each class of `join_texts`: that of the smallest key, a null one last.

    Of several such rows with different texts the one whose text has the smallest hash stays, of
    repeated rows one. All columns stay, whatever their names. Texts without words are equal texts of one class only if equal byte by byte.
    """
    return under_plain_names(docs, _keep_one, key=key, text=text)


def _keep_one(docs: DataFrame, key: str, text: str) -> DataFrame:
    _, result = _classes(docs, key, text, WORDS, SIMILARITY, RECALL, DEPTH, SMALL, BLOCK)
    kept = result.where("keeper").select(F.col("tid").alias("_tid"), F.col("first").alias("_first"))
    marked = docs.withColumn("_text_id", text_id(F.col(text)))
    matched = marked.join(kept, (F.col("_text_id") == F.col("_tid")) & F.col(key).eqNullSafe(F.col("_first")))
    return matched.dropDuplicates(["_tid", "_first"]).drop("_text_id", "_tid", "_first")
