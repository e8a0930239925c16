"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run without the six ASCII blanks x20 and x09 to x0D.
"""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_SIGN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_VALUE = np.random.default_rng(20_240_517).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """raw: all texts joined by a line feed; of each word start, end (bytes in raw) and doc.

    bare: ASCII signs part words like blanks do.
    """

    def __init__(self, texts: list[str], lower: bool = False, bare: bool = False):
        encoded = [t.encode() for t in texts]
        raw = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
        self.raw = _LOWER[raw] if lower else raw
        lengths = np.array([len(x) + 1 for x in encoded], np.int64)
        self.doc_end = np.cumsum(lengths)
        self.doc_start = self.doc_end - lengths
        self.solid = ~(_SIGN if bare else _BLANK)[raw]
        edge = np.diff(self.solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.length = self.end - self.start
        self.doc = np.searchsorted(self.doc_end, self.start, side="right")
        self.counts = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.counts) - self.counts

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first `most` bytes (shorter words: of the whole)."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.length if most is None else np.minimum(self.length, most)
        at = np.cumsum(length) - length
        place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(at, length)
        taken = self.raw[self.solid] if most is None else self.raw[place + np.repeat(self.start, length)]
        powers = np.empty(int(length.max()), np.uint64)
        powers[:] = _STEP
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        return mix64(np.add.reduceat(_VALUE[taken] * powers[place], at) + length.astype(np.uint64))

    def shingles(self, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(doc, hash) of every window of `size` words; a text with fewer words is one window."""
        h = self.hashes() if hashes is None else hashes
        n = len(h)
        factors = mix64(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
        if n >= size:
            total = np.zeros(n - size + 1, np.uint64)
            for k in range(size):
                total += h[k : n - size + 1 + k] * factors[k]
            whole = self.doc[: n - size + 1] == self.doc[size - 1 :]
            docs, found = self.doc[: n - size + 1][whole], mix64(total[whole])
        else:
            docs, found = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        short = np.flatnonzero((self.counts > 0) & (self.counts < size))
        if len(short):
            with np.errstate(over="ignore"):  # sums wrap around
                extra = np.array([np.add.reduce(h[a : a + c] * factors[:c]) + np.uint64(c) * _STEP for a, c in zip(self.first[short], self.counts[short], strict=True)], np.uint64)
            docs, found = np.concatenate([docs, short]), np.concatenate([found, mix64(extra)])
            order = np.argsort(docs, kind="stable")
            docs, found = docs[order], found[order]
        return docs, found


def sets_of(texts: list[str], size: int, lower: bool = True) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    docs, found = Words(texts, lower).shingles(size)
    cuts = np.searchsorted(docs, np.arange(len(texts) + 1))
    return [np.unique(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
