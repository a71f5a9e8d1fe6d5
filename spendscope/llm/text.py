"""Vectorised text helpers for Python workers: chunks of documents as code
point arrays, word spans and 64-bit word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

CHUNK_CHARS = 1_000_000  # characters handled at once; a longer text is one chunk of its own
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) with about ``size`` characters each."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= size:
            yield first, texts[first:i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a newline, and where each begins
    (one more at the end)."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return codes, starts


def which(codes: np.ndarray, holds: Callable[[str], bool]) -> np.ndarray:
    """For each code point, whether its character holds; asked once per character."""
    present = np.bincount(codes).nonzero()[0]
    table = np.zeros(int(present[-1]) + 1, bool)
    table[present] = [holds(chr(c)) for c in present]
    return table[codes]


def is_letter(c: str) -> bool:
    return c.isalpha()


def is_not_space(c: str) -> bool:
    return c not in " \t\n\x0b\x0c\r"


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str], in_word: Callable[[str], bool]):
    """Hashes of all maximal runs of ``in_word`` characters, their starts and ends
    in the code point array, the array's text starts, each text's first word
    (one more at the end), and a function for hashes of words' first letters."""
    codes, starts = code_points(texts)
    inside = which(codes, in_word)
    edge = np.diff(inside.astype(np.int8), prepend=0)
    begin, end = (edge == 1).nonzero()[0], (edge == -1).nonzero()[0]
    power = np.cumprod(np.full(len(codes), BASE, np.uint64))
    undo = np.cumprod(np.full(len(codes), INVERSE, np.uint64))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])


    def begins_with(at: np.ndarray, k: int) -> np.ndarray:
        return mix64((total[at + k] - total[at]) * undo[at] + np.uint64(k))

    hashes = mix64((total[end] - total[begin]) * undo[begin])
    return hashes, begin, end, starts, np.searchsorted(begin, starts), begins_with
