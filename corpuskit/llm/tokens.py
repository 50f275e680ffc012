"""Tokenizers from vocabulary files of public tokenizers; paths are parameters and files stay where they are."""

from __future__ import annotations

import base64
import functools

import tiktoken

#: Where the box keeps vocabulary files; every machine that runs tasks needs the file at the given path.
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of these rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoding(path: str = DEFAULT_RANKS) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file; loaded once per process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def end_of_text(path: str = DEFAULT_RANKS) -> int:
    """The first id that the rank file leaves free; ends every document."""
    return encoding(path).n_vocab
