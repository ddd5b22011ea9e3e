"""Byte-level BPE encoding of whole texts, with character offsets.

``encode`` gives the ids that ``tokenizers`` gives for the named vocabulary
file with ``add_special_tokens=False``: nothing is added, and the string of an added token
inside a text (``<|endoftext|>``) is that token. The work is done by ``tiktoken``
over the same vocabulary as ranks, three to four times as fast; texts that hold such
a string, and the few on which its pattern engine cannot be relied upon (white
space in very long runs), go through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np

VOCABULARY = "byte_bpe_50k"
_LONG_BLANK = re.compile(r"\s{512}")


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; a name with a slash is a path."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _reference(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(f"{vocabulary}.json"))


@functools.lru_cache(maxsize=2)
def _added(vocabulary: str) -> dict[int, str]:
    """Added tokens of the vocabulary and their strings."""
    return {i: t.content for i, t in _reference(vocabulary).get_added_tokens_decoder().items()}


@functools.lru_cache(maxsize=2)
def _ranked(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = _added(vocabulary)
    sizes = np.zeros(max([*ranks.values(), *added]) + 1, np.int64)
    for b, i in ranks.items():
        sizes[i] = len(b)
    for i, string in added.items():
        sizes[i] = len(string.encode())
    return enc, sizes


def encode(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a text as uint32."""
    if not text:
        return np.zeros(0, np.uint32)
    if _LONG_BLANK.search(text) or any(x in text for x in _added(vocabulary).values()):
        return np.array(_reference(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)
    return _ranked(vocabulary)[0].encode_to_numpy(text, disallowed_special=())


def char_spans(text: str, ids: np.ndarray, vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the character after its last one. A
    token that holds a part of a character's bytes counts the character."""
    sizes = _ranked(vocabulary)[1][ids]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if text.isascii():
        return starts, ends
    lead = (np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) & 0xC0) != 0x80
    chars = np.cumsum(lead)  # chars[b]: characters begun up to byte b
    return chars[starts] - 1, chars[ends - 1]
