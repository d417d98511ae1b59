"""Words of many texts as numbers, straight from Arrow's UTF-8 buffers."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = 0x100000001B3
MIX = 0x9E3779B97F4A7C15

_CODE = np.zeros(256, np.uint8)  # lower-case byte of a word character, 0 for others
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalnum():
        _CODE[_b] = ord(chr(_b).lower()) if _b < 0x80 else _b


class Words(NamedTuple):
    hash: np.ndarray  # uint64 per word
    first: np.ndarray  # words before each text, and the total


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64)


# first and last code point of scripts that are written without spaces
UNSPACED = [
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3000, 0x312F),
    (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF), (0x1B000, 0x1B16F),
    (0x20000, 0x3FFFF),
]
# punctuation among them, no part of any word
UNSPACED_MARKS = [(0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]


def _unspaced(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the end and whether it is a mark, of the characters of scripts without spaces."""
    at = np.flatnonzero(own >= 0xE0)
    size = np.where(own[at] >= 0xF0, 4, 3)
    at, size = at[at + size <= len(own)], size[at + size <= len(own)]
    wide = size == 4
    point = np.where(wide, own[at] & 0x07, own[at] & 0x0F).astype(np.int64)
    for k in (1, 2):
        point = point << 6 | own[at + k] & 0x3F
    point[wide] = point[wide] << 6 | own[at[wide] + 3] & 0x3F

    def among(ranges: list[tuple[int, int]]) -> np.ndarray:
        low, high = np.array(ranges).T
        return point <= high[np.maximum(0, np.searchsorted(low, point, side="right") - 1)]

    some = among([(0, 0), *UNSPACED])
    return at[some], (at + size)[some], among([(0, 0), *UNSPACED_MARKS])[some]


def hashed_words(raw: np.ndarray, offsets: np.ndarray, characters: bool = False) -> Words:
    """Words are runs of ASCII letters and digits and of any characters beyond ASCII; Latin letters without case.
    With `characters` each character of a script without spaces is a word, and its punctuation is none."""
    start, stop = int(offsets[0]), int(offsets[-1])
    own = raw[start:stop]
    code = _CODE[own]
    if len(own):
        # capitals of the Latin-1 letters: the byte after C3 from 80 to 9E, but for the multiplication sign
        code[1:][(own[:-1] == 0xC3) & (own[1:] >= 0x80) & (own[1:] <= 0x9E) & (own[1:] != 0x97)] += 0x20
    single = after = np.zeros(0, np.int64)
    if characters and len(own):
        single, after, mark = _unspaced(own)
        for k in range(3):  # marks have three bytes
            code[single[mark] + k] = 0
    inside = code > 0
    begins = inside.copy()
    if len(begins):
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1] - start
        edges = edges[edges < len(code)]
        edges = np.concatenate([edges, single, after[after < len(code)]])
        begins[edges] = inside[edges]  # a text starts a word of its own, as does a single character and what follows it
    at = np.flatnonzero(inside)
    word_at = np.flatnonzero(begins)
    if not len(word_at):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    first_letter = np.searchsorted(at, word_at)
    place = np.arange(len(at)) - np.repeat(first_letter, np.diff(np.append(first_letter, len(at))))
    longest = int(place.max()) + 1
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(longest, BASE, np.uint64), dtype=np.uint64)
        sums = np.add.reduceat((code[at].astype(np.uint64) + np.uint64(1)) * powers[place], first_letter)
        sums ^= sums >> np.uint64(31)
        sums *= np.uint64(MIX)
        sums ^= sums >> np.uint64(29)
    return Words(sums, np.searchsorted(word_at, offsets - start))


def words_of(text: str, characters: bool = False) -> np.ndarray:
    return hashed_words(*utf8(pa.array([text], pa.string())), characters).hash
