"""Splitting of text into the pieces whose byte pairs are merged, as the vocabulary files define it."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import regex

#: The contractions and classes of the two split patterns.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACED = CONTRACTIONS + r"| ?{L}+| ?{N}+| ?[^{S}{l}{n}]+|{s}+(?!{x})|{s}+"
WORDS = CONTRACTIONS + r"|{L}+|{N}|[^{S}{l}{n}]+"

# Letters, numbers and white space below U+02B0, where most texts stay; there `re` is twice as fast.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_BEYOND = re.compile("[^\0-ʯ]")


@functools.cache
def _patterns(kind: str) -> tuple[re.Pattern, regex.Pattern]:
    def fill(letters: str, numbers: str, space: str) -> str:
        return kind.format(L=f"[{letters}]", N=f"[{numbers}]", S=space, l=letters, n=numbers, s=f"[{space}]", x=f"[^{space}]")

    return re.compile(fill(_L, _N, _S)), regex.compile(fill(r"\p{L}", r"\p{N}", r"\s"))


@functools.cache
def _unassigned() -> re.Pattern:
    """Code points without a meaning in Python's character table; libraries of other versions may know them."""
    out, start = [], None
    for c in range(0x110001):
        free = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if free and start is None:
            start = c
        elif not free and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(out)}]")


def splitter(kind: str, text: str):
    """The `findall` that splits this text; None when only the library knows all of its characters."""
    plain, full = _patterns(kind)
    if text.isascii() or not _BEYOND.search(text):
        return plain.findall
    return None if _unassigned().search(text) else full.findall


_CUT = regex.compile(r"(?<=\S) (?=\S)")


def parts(text: str, size: int = 500_000) -> Iterator[str]:
    """The text cut before single spaces between other characters, where a piece starts under both patterns."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


@functools.cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]
