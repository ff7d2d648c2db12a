"""A compressed full-text index over sequences of numbers, searched for many patterns in step.

The Burrows-Wheeler transform of the sequences is kept in a wavelet matrix of packed bits with block counts. A
pattern is searched from its last symbol to its first; each symbol narrows the interval of suffixes that begin with
what has been read. Every step works on all patterns at once.
"""

from collections.abc import Iterator

import numpy as np


class WaveletMatrix:
    """Answers how often a symbol occurs before a place; one level of packed bits for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.size = len(symbols)
        self.bits = max(1, int(largest).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        starts, order = np.zeros(1, dtype=np.int64), symbols.astype(np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = ((order >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(self.size // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.zeros(len(words) + 1, dtype=np.int32)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(self.size - int(counts[-1]))
            order = np.concatenate([order[~bit], order[bit]])
        # Where each symbol's run begins after the last level.
        first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if self.size else starts[:0]
        self.begin = np.zeros(int(largest) + 1, dtype=np.int64)
        self.begin[order[first]] = first

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` (one that occurs) before ``place``, for arrays of both."""
        for level, (words, counts, zeros) in enumerate(zip(self.words, self.counts, self.zeros)):
            word = place >> 6
            below = words[word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
            ones = counts[word] + np.bitwise_count(below)
            is_one = (symbol >> (self.bits - 1 - level)) & 1
            place = np.where(is_one, zeros + ones, place - ones)
        return place - self.begin[symbol]


def _classes(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    return np.unique(major * (int(minor.max()) + 1) + minor, return_inverse=True)[1]


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[: len(values) - by] = values[by:]
    return out


class Index:
    """Index of sequences; ``length`` is the number of symbols whose matches are reported.

    Suffixes are sorted by their first symbols, at least ``length`` and one of them: enough for searches up to it.
    """

    def __init__(self, sequences: np.ndarray, first: np.ndarray, owners: np.ndarray, length: int):
        """``sequences`` holds all symbols; number i begins at ``first[i]`` and has ``owners[i]`` as its owner."""
        self.length = length
        self.alphabet = np.unique(sequences)
        sizes = np.diff(first)
        # Each sequence is followed by the symbol 0, which no search contains.
        text = np.zeros(len(sequences) + len(sizes), dtype=np.int64)
        places = np.arange(len(sequences)) + np.repeat(np.arange(len(sizes)), sizes)
        text[places] = np.searchsorted(self.alphabet, sequences) + 1
        owner = np.repeat(owners, sizes + 1)
        ranks, depth, by_depth = text, 1, {1: text}
        while depth <= length:
            ranks = _classes(ranks, _ahead(ranks, min(depth, len(ranks))))
            depth *= 2
            by_depth[depth] = ranks
        order = np.argsort(ranks, kind="stable")

        def blocks(size: int) -> np.ndarray:
            """Number of the block of suffixes that share ``size`` symbols, along the sorted suffixes."""
            half = 1 << (size.bit_length() - 1)
            a = by_depth[half][order]
            b = _ahead(by_depth[half], min(size - half, len(text)))[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            return np.cumsum(new) - 1

        whole, shorter = blocks(length), blocks(length - 1)
        begin = np.flatnonzero(np.diff(whole, prepend=-1))
        self.owner = np.minimum.reduceat(owner[order], begin)[whole]
        begin = np.flatnonzero(np.diff(shorter, prepend=-1))
        ends = np.append(begin[1:], len(order))
        self.low, self.high = begin[shorter], ends[shorter]
        self.before = WaveletMatrix(text[order - 1], len(self.alphabet))
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.size = len(text)

    def matches(self, stream: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For streamed sequences: number, place and smallest owner of every run of ``length`` symbols in the index.

        A sequence is read from its end. Its match is as long as the index allows but not longer than ``length``:
        a full match is reported and gives up its last symbol before the next is put in front. Where a match breaks,
        reading begins anew with an end one symbol further left.
        """
        symbol = np.searchsorted(self.alphabet, stream)
        known = symbol < len(self.alphabet)
        known &= self.alphabet[np.where(known, symbol, 0)] == stream if len(self.alphabet) else known
        symbol = np.where(known, symbol + 1, 0)  # 0: a symbol that the index does not have
        lane = np.flatnonzero(np.diff(first) >= self.length)
        start, end = first[lane], first[lane + 1]
        at, low, high = end.copy(), np.zeros(len(lane), dtype=np.int64), np.full(len(lane), self.size, dtype=np.int64)
        while len(lane):
            c = symbol[at - 1]
            safe = np.maximum(c, 1)
            both = self.before.rank(np.concatenate([safe, safe]), np.concatenate([low, high]))
            low, high = self.first[safe] + both[: len(lane)], self.first[safe] + both[len(lane) :]
            found = (low < high) & (c > 0)
            at = np.where(found, at - 1, end - 1)
            full = found & (end - at == self.length)
            if full.any():
                row = low[full]
                yield lane[full], (at - start)[full], self.owner[row]
                low[full], high[full] = self.low[row], self.high[row]
            end = end - (full | ~found)
            low, high = np.where(found, low, 0), np.where(found, high, self.size)
            goes_on = (end - start >= self.length) & (at > start)
            lane, start, end, at, low, high = (x[goes_on] for x in (lane, start, end, at, low, high))
