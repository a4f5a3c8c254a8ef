"""Splitting text into the words that a byte-level BPE vocabulary merges within."""

from __future__ import annotations

import base64
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space by code points: Java, Python and Rust each mean something else by their class.
_SPACE = r"\t-\r \u0085   -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def pretokens(text: Column) -> Column:
    """The words, in order; joined they are the text again."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


@lru_cache(maxsize=2)
def encoding(path: str):
    """The vocabulary of a rank file; read once in each Python process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def pieces(path: str) -> list[bytes]:
    """The bytes of each id, from 0."""
    with open(path, "rb") as lines:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]
