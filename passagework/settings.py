"""Defaults of the jobs, as plain values that callers override by argument."""

from __future__ import annotations

from dataclasses import dataclass

# The published defaults of the workload.
VALIDATION_ROWS = 7900
SHARD_ROWS = 1000
SHARD_PREFIX = "shard_"
SPLITS = ("train", "validation", "test")
CHUNK_TOKENS = 240
CHUNK_OVERLAP = 60
ENCODE_BATCH = 512
CANDIDATES = 100
RERANK_TOP = 3
ANSWER_TOP = 5
RECALL_AT = (1, 3, 5, 10)
EVAL_ROWS = 100
VOTE_SAMPLES = 3
SAMPLE_TEMPERATURE = 0.7
SAMPLE_TOP_P = 0.9
MAX_PROMPT_TOKENS = 2048
MAX_ANSWER_TOKENS = 48
LOG_PREFIX_CHARS = 200
PREVIEW_CHARS = 50
SWEEP = ((160, 40), (200, 50), (240, 60))

# Questions, pairs or prompts that a task hands to a model.
TASK_ROWS = 256


@dataclass(frozen=True)
class Chunking:
    """Window length and overlap, both counted in tokens."""

    tokens: int = CHUNK_TOKENS
    overlap: int = CHUNK_OVERLAP

    def __post_init__(self):
        if self.tokens < 1:
            raise ValueError("a chunk needs at least one token")

    @property
    def step(self) -> int:
        return max(1, self.tokens - self.overlap)
