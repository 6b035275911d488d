"""Words of ASCII letters, digits and everything beyond ASCII, found in UTF-8 bytes.

Only ASCII characters separate words, and no byte of a longer UTF-8 character
is ASCII, so cutting the bytes gives the same words as cutting the text.
"""

from __future__ import annotations

import re

#: Fixed value: a word in a text whose case was not folded (A-Z count as a-z).
PLAIN_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def _folded(b: int) -> int:
    if ord("A") <= b <= ord("Z"):
        return b + 32
    return b if b >= 128 or chr(b).isalnum() else ord(" ")


_FOLD = bytes(map(_folded, range(256)))


def plain_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_FOLD).split()
