"""Token ids of the public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
import re
from functools import cache

import numpy as np

VOCABULARY = "byte_bpe_50k"

# Both libraries split such texts alike whatever Unicode version their patterns follow.
_PLAIN = re.compile("[^\x00-ɏ‐-‧€]")


@cache
def _encoders(name: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    slow.encode_special_tokens = True
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return slow, fast


def encode(text: str, name: str = VOCABULARY) -> list[int]:
    """Ids of the JSON vocabulary, strings of special tokens being ordinary text.

    Latin text goes through the rank file of the same vocabulary, which gives
    the same ids several times faster.
    """
    slow, fast = _encoders(name)
    if _PLAIN.search(text):
        return slow.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def encode_all(texts: list[str | None], end: int | None = None, name: str = VOCABULARY) -> list[np.ndarray]:
    """Ids of each text as little-endian 32-bit numbers, each followed by ``end`` if given; null counts as empty."""
    tail = [] if end is None else [end]
    return [np.array(encode(text or "", name) + tail, dtype="<u4") for text in texts]
