"""Words and token windows of Arrow text columns, found in their bytes without an object per word."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are looked at a time, but at least one text.
PIECE_BYTES = 2**19
# Stands after every text, so that none of its runs goes on into the next one.
_END = "\n"


def outside(breaks: str) -> bytes:
    """Table for `bytes.translate`: 0 for the ASCII characters `breaks`, line feed among them, 1 for all other bytes."""
    return bytes(chr(i) not in breaks if i < 128 else True for i in range(256))


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """`texts` in slices of about `most` bytes, without nulls."""
    if len(texts) == 0:
        return
    texts = texts.fill_null("")
    begins = _offsets(texts)[:-1]
    cuts = np.flatnonzero(np.diff((begins - begins[0]) // max(1, most))) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        yield texts.slice(a, b - a)


def _found(texts: pa.Array, inside: bytes) -> tuple[np.ndarray, ...]:
    """The bytes of a piece, which of them are `inside`, begin and end of each run of these, and the first run of each text."""
    ended = pc.binary_join_element_wise(texts, pa.scalar(_END, texts.type), pa.scalar("", texts.type))
    offsets = _offsets(ended)
    held = ended.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes()
    is_in = np.frombuffer(held.translate(inside), np.bool_)
    edges = np.flatnonzero(is_in[1:] != is_in[:-1]) + 1
    if is_in[0]:
        edges = np.concatenate([[0], edges])
    begins, ends = edges[::2], edges[1::2]
    return np.frombuffer(held, np.uint8), is_in, begins, ends, np.searchsorted(begins, offsets - offsets[0])


def _strings(sizes: np.ndarray, data) -> pa.StringArray:
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))


def coded_words(texts: pa.Array, inside: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """A number for each run of bytes that are `inside`, how many of them each text has, and the runs by number.

    Texts are looked at in pieces, but a word has one number in all of them.
    """
    found, counts = [], [np.zeros(0, np.int64)]
    for some in pieces(texts):
        data, is_in, begins, ends, first = _found(some, inside)
        found.append(_strings(ends - begins, data[is_in]))
        counts.append(np.diff(first))
    coded = pa.chunked_array(found, pa.string()).dictionary_encode().combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy(), np.concatenate(counts), coded.dictionary


def token_windows(texts: pa.Array, inside: bytes, cuts: Sequence[tuple[int, int]]) -> pa.ListArray:
    """Per text of a piece and (size, step) of `cuts` the windows of `size` runs that begin at run 0, step, 2*step, ..., joined by spaces."""
    data, is_in, begins, ends, first = _found(texts, inside)
    # Every run keeps the byte after it, as a space.
    kept = is_in.copy()
    kept[ends] = True
    lengths = ends - begins
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    ends = begins + lengths
    squeezed = data[kept]
    squeezed[ends] = ord(" ")
    squeezed = memoryview(squeezed)
    sizes, steps = (np.array(x, np.int64) for x in zip(*cuts))
    windows = (-(-np.diff(first)[:, None] // steps)).ravel()
    upto = np.concatenate([[0], np.cumsum(windows)])
    cell = np.repeat(np.arange(len(windows)), windows)
    row, cut = cell // len(steps), cell % len(steps)
    left = first[row] + (np.arange(len(cell)) - upto[cell]) * steps[cut]
    right = np.minimum(left + sizes[cut], first[row + 1]) - 1
    left, right = begins[left], ends[right]
    text = b"".join([squeezed[a:b] for a, b in zip(left.tolist(), right.tolist())])
    lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), _strings(right - left, text))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(windows) + 1, len(steps), dtype=np.int32)), lists)
