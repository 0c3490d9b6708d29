"""Words of many texts at once: places, codes, hashes of runs, and bit sets of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_GROUP = 32768


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers scattered one to one."""
    x = (x ^ (x >> np.uint64(32))) * _ODD[1]
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


def word_places(data: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of bytes for which the table `is_word` holds."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_codes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, equal ones for equal words, and the words by number."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    offsets = np.empty(2 * len(starts), np.int32)
    offsets[::2], offsets[1::2] = starts, ends
    # What lies between the words is an entry as well, since Arrow's strings have no gaps.
    strings = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = strings.dictionary_encode()
    return coded.indices.to_numpy()[::2].astype(np.int64), coded.dictionary.to_pylist()


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def longer(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words from those of n - 1 words and of single ones."""
    return mixed(hashes[:-1] * _ODD[0] + first[n - 1 :])


def bit_set(places: DataFrame, column: str, bits: int) -> bytes:
    """`bits` bits, of which those at the numbers in `column` (0 to bits - 1) are set.

    At most bits / 32768 rows of 4 KB come to the driver, however many numbers there are.
    """
    groups = places.groupBy(F.bitmap_bucket_number(F.col(column) + 1).alias("group")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column) + 1)).alias("bitmap")
    )
    out = bytearray(max(bits, _GROUP) // 8)
    for row in groups.toLocalIterator():
        begin = (row["group"] - 1) * _GROUP // 8
        out[begin : begin + _GROUP // 8] = row["bitmap"]
    return bytes(out)


def in_bits(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the bit at each place is set; `bitmap` holds bytes, lowest bit first."""
    return (bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
