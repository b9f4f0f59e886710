"""Byte-level BPE ids of the public tokenizer.

The rank file and the JSON file of the vocabulary hold the same tokens; the
ids equal those of ``tokenizers`` with ``add_special_tokens=False``, for which
the special token's own string in a text keeps its one id.
"""

from __future__ import annotations

import base64
import functools
from array import array

SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={SPECIAL: SPECIAL_ID})


def encoder(path: str):
    """text -> its ids as a list of ints (null: none)."""
    enc = _encoding(path)

    def encode(text: str | None) -> list[int]:
        if not text:
            return []
        return enc.encode(text, allowed_special={SPECIAL}) if SPECIAL in text else enc.encode_ordinary(text)

    return encode


def as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit form of the ids."""
    a = array("I", ids)
    if a.itemsize != 4 or array("I", [1]).tobytes() != b"\x01\0\0\0":
        import struct

        return struct.pack(f"<{len(ids)}I", *ids)
    return a.tobytes()
