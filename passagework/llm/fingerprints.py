"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import portions

# Phrase names of a fingerprint, the smallest ones of the document; 4 bytes each.
SKETCH = 128
# Text that a task parses at a time; its arrays take about 50 times as much.
_PORTION = 1 << 20
# The first level whose phrases are taken, about a dozen bytes long on average.
FIRST_LEVEL = 2
LEVELS = 5
# Steps of coin tossing: names of 64 bits get below 6 values in four.
_TOSSES = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit names over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels of a few values, adjacent ones unequal, each from the names next to it alone.

    One step: twice the lowest bit place in which a name differs from the one before, plus its
    bit there. A document's first name counts as differing in bit 0.
    """
    label = names
    for _ in range(_TOSSES):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ label.dtype.type(1)
        differ = label ^ before
        lowest = differ & (~differ + label.dtype.type(1))
        place = np.frexp(lowest.astype(np.float64))[1].astype(np.uint8) - np.uint8(1)
        label = place * np.uint8(2) + ((label & lowest) != 0).astype(np.uint8)
    return label


def _small_table() -> np.ndarray:
    """Label of a byte after another byte: the steps of `_toss` for all pairs at once, first step."""
    x, y = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    differ = x ^ y
    lowest = differ & -differ
    place = np.where(lowest > 0, np.frexp(np.maximum(lowest, 1).astype(float))[1] - 1, 0)
    return (place * 2 + ((x & lowest) != 0)).astype(np.uint8).ravel()


_STEP = _small_table()
_BYTE_WEIGHTS = _mix(np.arange(256, dtype=np.uint64) + np.uint64(256))


def _toss_bytes(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    label = names
    for _ in range(_TOSSES - 1):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ np.uint8(1)
        label = _STEP[label.astype(np.uint16) << np.uint16(8) | before]
    return label


def _phrases(names: np.ndarray, weights: np.ndarray, owner: np.ndarray, first: np.ndarray):
    """Cut before each local maximum of the labels; names of the phrases, and whose they are.

    `names` are unequal to their neighbours within a document, `weights` what enters the hash.
    """
    toss = _toss_bytes if names.dtype == np.uint8 else _toss
    label = toss(names, first)
    cut = np.zeros(len(names), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    # The neighbour of a document's first or last name is another document's: no maximum there.
    cut[first[1:] - 1] = False
    cut[first] = True
    begins = np.flatnonzero(cut)
    lengths = np.diff(np.append(begins, len(names)))
    place = np.arange(len(names)) - np.repeat(begins, lengths)
    powers = np.cumprod(np.full(place.max() + 1, _ODD, np.uint64))
    hashed = np.add.reduceat(weights * powers[place], begins)
    return _mix(hashed + lengths.astype(np.uint64)), owner[begins]


def _collapse(names: np.ndarray, owner: np.ndarray):
    """Runs of one name in one document as a single entry, with their lengths."""
    new = np.empty(len(names), bool)
    new[0] = True
    new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    return names[begins], owner[begins], np.diff(np.append(begins, len(names))).astype(np.uint64)


def _firsts(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))


def sketches(texts: list[bytes], size: int = SKETCH) -> list[np.ndarray]:
    """The `size` smallest phrase names of each text, ascending; none for an empty text.

    Level by level, names (bytes at first) are cut into phrases whose borders depend on a few
    neighbours only, and each phrase gets a name from its content. Two texts that share a
    passage so share the names of its interior phrases, wherever it lies in them. Phrases of
    FIRST_LEVEL and all higher levels count; a text too short for that level is one phrase.
    """
    lengths = np.array([len(t) for t in texts])
    if not lengths.sum():
        return [np.zeros(0, np.uint32) for _ in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    names = np.frombuffer(b"".join(texts), np.uint8)
    taken, whose = [], []
    for level in range(1, LEVELS + 1):
        names, owner, runs = _collapse(names, owner)
        if level == 1:
            weights = _BYTE_WEIGHTS[names]
            long = runs > 1
            weights[long] = _mix(names[long] + (runs[long] << np.uint64(8)))
        else:
            weights = _mix(names ^ _mix(runs))
        names, owner = _phrases(names, weights, owner, _firsts(owner))
        if level >= FIRST_LEVEL:
            taken.append((names >> np.uint64(32)).astype(np.uint32))
            whose.append(owner)
    key = np.unique(np.concatenate(whose).astype(np.uint64) << np.uint64(32) | np.concatenate(taken))
    bounds = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    return [key[a : min(b, a + size)].astype(np.uint32) for a, b in zip(bounds, bounds[1:])]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Estimated share of common phrases, from 0 to 1; two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    smallest = np.union1d(a, b)[:size]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(smallest, common, assume_unique=True).mean())


def printed(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u4").tobytes()).decode()


def _bounds(docs: DataFrame, key: Column, parts: int) -> list[int]:
    """At most `parts` - 1 keys that deal the rows out evenly."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(key, shares, 10 * parts).alias("q")).first()["q"]
    return sorted(set(found or []))


def with_next(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Rows in ranges of the key, each range followed by the first row of the next one.

    Columns: key, text (null: empty), part, borrowed (true for that row of the next range). One shuffle,
    in which each text moves once; only one key per range comes to the driver.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    bounds = _bounds(rows, F.col("key"), parts)
    key = F.col("key")
    # A null key is above no bound, so it lies in the first range.
    part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: key > b)) if bounds else F.lit(0)
    least = sorted((r["part"], r["least"]) for r in rows.groupBy(part.alias("part")).agg(F.min("key").alias("least")).collect())
    heads = [(earlier[0], later[1]) for earlier, later in zip(least, least[1:])]
    to = F.array(F.struct(part.alias("part"), F.lit(False).alias("borrowed")))
    if heads:
        lender = F.create_map(*(F.lit(x) for before, first in heads for x in (first, before)))
        to = F.when(
            lender[F.col("key")].isNotNull(),
            F.concat(to, F.array(F.struct(lender[F.col("key")].alias("part"), F.lit(True).alias("borrowed")))),
        ).otherwise(to)
    return rows.select("key", "text", F.explode(to).alias("to")).select("key", "text", "to.part", "to.borrowed")


def _first_text(docs: DataFrame, key: str, text: str) -> str:
    """The text after the last one: that of the smallest key, a null one before all others."""
    key = F.col(key).cast("long")
    seen = docs.agg(F.min(key).alias("least"), F.count_if(key.isNull()).alias("nulls")).first()
    at = key.isNull() if seen["nulls"] else key == seen["least"]
    text = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.where(at).select(F.min(text).alias("text")).first()
    return found["text"] or ""


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprint of each text and of an edited text, and how alike they and the next one's are.

    The edited text has its last floor(n_chars / 4) code points replaced by as many first ones
    of the next document in ascending order of the key (all of it if shorter; after the last
    comes the first). Result: the key as long, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next; one row for each row of `docs`. Null texts are
    empty; empty texts have an empty fingerprint, alike (1) to another empty one and unlike (0)
    all others. A null key comes first; rows of one key are in order of their texts. A table of
    one row has itself as next. `parts`: ranges of the key, spark.sql.shuffle.partitions by default.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_next(docs, key, text, parts)
    head = _first_text(docs, key, text)
    # Two rows follow each other across batches, so the last one of a batch waits for the next.
    schema = (
        "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """(key, text, text of the next one) of rows to be answered, in portions."""
        waiting = None
        for batch in batches:
            for portion in portions(batch, "text", _PORTION):
                found = []
                for k, t, p, borrowed in zip(*(portion.column(c).to_pylist() for c in ("key", "text", "part", "borrowed"))):
                    if waiting is not None:
                        follows = t if p == waiting[2] else head
                        found.append((*waiting[:2], follows))
                    waiting = None if borrowed else (k, t, p)
                yield found
        if waiting is not None:
            yield [(*waiting[:2], head)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in pairs(batches):
            if not rows:
                continue
            edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for _, t, n in rows]
            # A row's next text is nearly always the following row's own.
            chain = [(t.encode(), n.encode()) for _, t, n in rows]
            texts, own, after = [], [], []
            for t, n in chain:
                if not (texts and after and texts[-1] == t):
                    texts.append(t)
                own.append(len(texts) - 1)
                texts.append(n)
                after.append(len(texts) - 1)
            codes = [e.encode() for e in edited]
            found = sketches(texts + codes)
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for i, (k, t, _) in enumerate(rows):
                mine, changed = found[own[i]], found[len(texts) + i]
                out["key"].append(k)
                out["n_chars"].append(len(t))
                out["edited_sha256"].append(hashlib.sha256(codes[i]).hexdigest())
                out["fingerprint"].append(printed(mine))
                out["edited_fingerprint"].append(printed(changed))
                out["near_edited"].append(likeness(mine, changed))
                out["near_next"].append(likeness(mine, found[after[i]]))
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("key", pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in list(out)[2:5]),
                ("near_edited", pa.float64()), ("near_next", pa.float64()),
            ]))

    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "borrowed", F.col("key").asc_nulls_first(), "text")
    return ordered.mapInArrow(work, schema).withColumnRenamed("key", key)
