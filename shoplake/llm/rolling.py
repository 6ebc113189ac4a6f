"""64-bit hashes of many word windows at once, with a prefix sum over the bytes."""

import numpy as np

from shoplake.llm.common import mixed

BASE = 0x9E6C63D0876A3F6B  # odd, so that it has an inverse
INVERSE = pow(BASE, -1, 2**64)
BLOCK = 1 << 18  # bytes hashed at a time; some 48 bytes are held for each


def powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, base, dtype=np.uint64)
    found[:1] = 1
    return np.cumprod(found, dtype=np.uint64)


class Joined:
    """The words of some texts, one space between any two, with each word's place.

    ``first`` and ``last`` are byte offsets; ``text`` is the number of the word's text and
    ``place`` the word's number in it.
    """

    def __init__(self, buffer: bytes, counts: np.ndarray):
        self.buffer = buffer
        spaces = np.flatnonzero(np.frombuffer(self.buffer, dtype=np.uint8) == 32)
        total = int(counts.sum())
        self.first = np.concatenate([[0], spaces + 1])[:total].astype(np.int64)
        self.last = np.concatenate([spaces, [len(self.buffer)]])[:total].astype(np.int64)
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.begin = np.cumsum(counts) - counts
        self.place = np.arange(total) - np.repeat(self.begin, counts)
        self.counts = counts

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> "Joined":
        counts = np.array([len(t) for t in texts], dtype=np.int64)
        return cls(b" ".join([b" ".join(t) for t in texts if t]), counts)

    def windows(self, size: int) -> np.ndarray:
        """Numbers of the words at which a window of ``size`` words of one text starts."""
        if size > len(self.text):
            return np.zeros(0, dtype=np.int64)
        starts = np.arange(len(self.text) - size + 1)
        return starts[self.text[size - 1 :] == self.text[: len(starts)]]

    def hashes(self, starts: np.ndarray, size: int) -> np.ndarray:
        return span_hashes(self.buffer, self.first[starts], self.last[starts + size - 1])


def span_hashes(buffer: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of ``buffer[first:last]``; both ascending. Memory is bounded by the block, or by
    the longest span."""
    out = np.empty(len(first), dtype=np.uint64)
    data = np.frombuffer(buffer, dtype=np.uint8)
    at, up, down = 0, powers(BASE, 0), powers(INVERSE, 0)
    while at < len(first):
        low = int(first[at])
        stop = max(at + 1, int(np.searchsorted(last, low + BLOCK, side="right")))
        high = int(last[stop - 1])
        if high - low >= len(up):
            size = max(high - low + 1, min(BLOCK, len(buffer)) + 1)
            up, down = powers(BASE, size), powers(INVERSE, size)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        begin, end = first[at:stop] - low, last[at:stop] - low
        out[at:stop] = (sums[end] - sums[begin]) * down[begin]
        at = stop
    return mixed(out)
