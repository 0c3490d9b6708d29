"""Small deterministic models in the places where users put their own."""

from __future__ import annotations

import numpy as np

# The letters whose shares make a vector.
LETTERS = "etnaoi "


def letter_encoder():
    """Counts of a few letters of each text."""
    return lambda texts: np.array([[t.count(x) for x in LETTERS] for t in texts], dtype=np.float64)


def length_scorer():
    """How much longer a passage is than the question, up to 400 code points."""
    return lambda pairs: [min(400, len(p) - len(q)) for q, p in pairs]


def character_tokenizer():
    """Code points as ids."""
    def to_ids(texts):
        return [[ord(c) for c in t] for t in texts]

    def to_text(ids):
        return ["".join(map(chr, row)) for row in ids]

    return to_ids, to_text


def prompt_reader():
    """Answers with the length and the end of the prompt, and whether it may sample."""
    return lambda requests: [f" {len(r['prompt'])}:{r['prompt'][-12:]}:{int(r['do_sample'])} " for r in requests]


def message_reader():
    """Answers with role and length of each message."""
    return lambda requests: [
        " ".join(f"{m['role']}={len(m['content'])}" for m in r["messages"]) for r in requests
    ]
