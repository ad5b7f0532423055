r"""Pre-tokens of byte-level BPE: the pieces of a text that merges do not cross.

The pattern (a fixed value of the vocabularies, see public_tokenizers.PATTERN)::

    's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

``re`` has no ``\p``; for texts within the basic plane the classes are built
from ``unicodedata``, and ``re`` then splits about three times as fast as
``regex``.  Other texts go through ``regex`` itself.  Characters that younger
Unicode versions have added may be classed otherwise than by a library that
knows them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import public_tokenizers
import regex

#: Characters with the property White_Space.
SPACES = "\t-\r \x85\xa0  -     　"


def _class(kind: str) -> str:
    """Ranges of the basic plane's characters whose category begins with ``kind``."""
    out, start = [], None
    for cp in range(0x10001):
        inside = cp < 0x10000 and unicodedata.category(chr(cp))[0] == kind
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{cp - 1:04x}")
            start = None
    return "".join(out)


@lru_cache(maxsize=1)
def splitter() -> Callable[[str], list[str]]:
    letters, numbers = _class("L"), _class("N")
    plane = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+").findall
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    every = regex.compile(public_tokenizers.PATTERN).findall
    return lambda text: plane(text) if text.isascii() or not beyond(text) else every(text)
