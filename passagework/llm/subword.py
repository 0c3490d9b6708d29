"""What the token operators share: a vocabulary file, and texts cut where no token can cross."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

# Entries of a worker's memory of finished pieces (200 to 250 bytes each). Frequent pieces come
# early in a stream of texts, so a full memory is kept as it is and later pieces are worked out anew.
MEMORY = 400_000
# How byte-level splitting cuts words; fixed value.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOOSE_BLANK = re.compile(r" (?=\s|$)")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: itself if printable, else from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    return [letters[b] for b in range(256)]


def single_blanks(text: str) -> bool:
    """True if `text` may be cut before each of its blanks without parting a token.

    Byte-level patterns hand the last blank before a word to that word, so no token crosses
    such a place. Where a blank is followed by more white space or the end, cuts could part a run.
    """
    return _LOOSE_BLANK.search(text) is None


class BlankPieces:
    """Texts cut before each of their blanks: distinct pieces (each beginning with its blank), and each text's own by number.

    `firsts` has what stands before a text's first blank, or the whole of a text that must not be cut.
    """

    def __init__(self, texts: list[str]):
        cut = [t if single_blanks(t) else None for t in texts]
        self.firsts = [t if c is None else c.partition(" ")[0] for t, c in zip(texts, cut)]
        rests = [None if c is None else c[len(f) :].encode() for c, f in zip(cut, self.firsts)]
        data = b"".join(r for r in rests if r)
        places = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        offsets = pa.py_buffer(np.append(places, len(data)).astype(np.int32))
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(places), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        self.pieces: list[bytes] = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        ends = np.searchsorted(places, np.cumsum([len(r or b"") for r in rests]))
        self._ends = [None if r is None else e for r, e in zip(rests, ends.tolist())]

    def rows(self) -> Iterator[np.ndarray | None]:
        """Numbers of each text's pieces after the first; None for a text that is not cut."""
        begin = 0
        for end in self._ends:
            yield None if end is None else self.codes[begin:end]
            begin = begin if end is None else end


class Vocabulary:
    """A byte-level BPE file of the tokenizers library: its ids, merges and way of splitting.

    Normalising and splitting are left to the library, whose Unicode tables decide there;
    merging is not.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        letters = byte_letters()
        self._shown = {b: letters[b] for b in range(128)}
        self._ascii = _ascii_rule(content)
        # Split by the byte-level pattern alone, with nothing lower-cased.
        self.plain = self._ascii is not None and not self._ascii[1]

    def words(self, piece: str) -> list[str | int]:
        """Words of a piece in byte letters; a special string gives its id."""
        if piece.isascii() and "<|" not in piece and self._ascii:
            pattern, lower = self._ascii
            found = pattern.findall(piece.lower() if lower else piece)
            return [w.translate(self._shown) for w in found]
        out: list[str | int] = []
        for part in self._special.split(piece) if self.special else [piece]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                plain = self._normalizer.normalize_str(part) if self._normalizer else part
                out.extend(w for w, _ in self._splitter.pre_tokenize_str(plain))
        return out

    def symbols(self, word: str) -> list[int]:
        """Initial symbols: one for each byte, the last one with the end-of-word suffix."""
        ids = [*map(self.ids.__getitem__, word)]
        if ids and self.suffix:
            ids[-1] = self.ids[word[-1] + self.suffix]
        return ids


def _ascii_rule(content: dict) -> tuple[regex.Pattern, bool] | None:
    """Pattern and lower-casing that do the file's splitting on ASCII pieces; None if it has other parts."""
    splitter, normalizer = content["pre_tokenizer"], content["normalizer"]
    if any(not t["content"].startswith("<|") for t in content["added_tokens"]):
        return None
    if normalizer is None and splitter["type"] == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"]:
        return regex.compile(_BYTE_LEVEL), False
    if normalizer is None or splitter["type"] != "Sequence":
        return None
    steps = [n["type"] for n in normalizer.get("normalizers", [])]
    first, *rest = splitter["pretokenizers"]
    if steps == ["NFC", "Replace", "Lowercase"] and first["type"] == "Split" and first["invert"] and first["behavior"] == "Removed" and [(r["type"], r["use_regex"]) for r in rest] == [("ByteLevel", False)]:
        return regex.compile(first["pattern"]["Regex"]), True
    return None


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per worker process."""
    return Vocabulary(path)
