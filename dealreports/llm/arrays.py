"""Texts as byte arrays: words and their hashes for a whole batch at a time.

A word is a run of bytes other than space and the control characters 9 to 13, so the bytes of one UTF-8 code point
are never split. Words are 64-bit values of a polynomial over random byte values, finished by a mixing step.
"""

import unicodedata
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts worked on together; one longer text is a chunk of its own

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# For words without marks: all of ASCII but letters and digits.
MARKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly (a one-to-one finishing step)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words(NamedTuple):
    """Words of a chunk; those of text i are ``first[i]`` up to ``first[i + 1]``."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


def words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = WHITE,
    marks: np.ndarray | None = None, cuts: np.ndarray | None = None,
) -> Words:
    """The words of texts that lie one after another in ``data``, text i from ``offsets[i]``.

    No word goes on past the places ``cuts``; bytes at the places ``marks`` are in no word.
    """
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(separators[data], out=inside[1:-1])
    if marks is not None:
        inside[1:-1][marks] = False
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    inner = offsets if cuts is None else np.concatenate([offsets, cuts])
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner] = inside[1:-1][inner]  # a text never continues the word that the one before ends with
    ends[inner - 1] = inside[1:-1][inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE[data] * up[:n], dtype=np.uint64, out=total[1:])
    hashes = mixed((total[end] - total[start]) * down[start])
    return Words(hashes, start, end, np.searchsorted(start, offsets), data)


# Scripts that are written without spaces between words, as ranges of code points.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x303C), (0x3040, 0x30FF), (0x3100, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA980, 0xA9DF),
    (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x17000, 0x18DFF), (0x1AFF0, 0x1B2FF),
    (0x20000, 0x3FFFF),
)
_SEPARATES, _LETTER, _ALONE = 0, 1, 2


@cache
def _classes() -> np.ndarray:
    """For each code point whether it separates words, is a letter of one, or is a word of its own."""
    out = np.full(0x110000, _LETTER, dtype=np.uint8)
    for lo, hi in UNSPACED:
        out[lo : hi + 1] = _ALONE
    for point in range(0x80, 0x20000):
        kind = unicodedata.category(chr(point))
        if kind[0] in "PZ" or kind == "Cc" or point == 0x200B:  # the last is the space of zero width
            out[point] = _SEPARATES
        elif kind[0] == "S":
            out[point] = _ALONE
    return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of letters and digits, A to Z in lower case; symbols and letters of unspaced scripts stand alone.

    ASCII symbols separate as punctuation does.
    """
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return words(data, offsets, True, MARKS)
    first = data[lead].astype(np.int64)
    length = 2 + (first >= 0xE0) + (first >= 0xF0)
    point = first & (0x7F >> length)
    for k in (1, 2, 3):
        more = length > k
        point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
    kind = _classes()[point]
    apart, size = lead[kind == _SEPARATES], length[kind == _SEPARATES]
    marks = np.concatenate([apart + k if k < 2 else apart[size > k] + k for k in range(4)])
    alone = lead[kind == _ALONE]
    return words(data, offsets, True, MARKS, marks, np.concatenate([alone, alone + length[kind == _ALONE]]))


def runs(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` values, by the place it starts; runs that would pass the end are left out."""
    n = len(values)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * up[:n], dtype=np.uint64, out=total[1:])
    return mixed((total[length:] - total[:-length]) * down[: n - length + 1])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by the first of them."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Chunk(NamedTuple):
    rows: slice
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A text column in chunks of about ``size`` bytes; a NULL counts as an empty text."""
    if not len(column):
        return
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, bounds, values = column.buffers()
    offsets = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield Chunk(slice(at, to), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
