"""Vectorised word splitting and XXH64 over many texts at once (NumPy, no loops over words)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[SPACE] = 32
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[SPACE] = 32
#: Bytes of text handled at once; bounds the memory of a Python worker.
BLOCK = 1 << 21


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Return the UTF-8 bytes of a string column; nulls become empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Yield ranges of ``texts`` of about ``most`` bytes; a longer text is a range of its own."""
    at = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > most:
            yield at, i
            at, size = i, 0
        size += len(x) + 1
    if at < len(texts):
        yield at, len(texts)


class Words:
    """The words of some texts: one buffer in which single spaces end the words.

    ``start`` and ``end`` are word bounds in ``buf``, ``first`` holds the first
    word of each text and one more entry at the end.
    """

    def __init__(self, texts: list[bytes], fold: np.ndarray = FOLDED) -> None:
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        solid = ~SPACE[raw]
        keep = solid.copy()
        keep[1:] |= solid[:-1]
        ends = np.flatnonzero(keep & ~solid)
        bounds = np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts)))
        self.first = np.concatenate([[0], np.searchsorted(ends, bounds)])
        self.buf = np.concatenate([fold[raw[keep]], np.zeros(16, np.uint8)])
        self.end = np.flatnonzero(self.buf[:-16] == 32)
        self.start = np.concatenate([[0], self.end[:-1] + 1]) if len(self.end) else self.end

    def __len__(self) -> int:
        return len(self.end)

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the ``n``-word shingles and the first shingle of each text.

        A text of fewer words has its whole sequence as its one shingle.
        """
        counts = self.counts
        last = np.repeat(self.first[1:], counts) - 1
        begin = np.repeat(self.first[:-1], counts)
        i = np.arange(len(self))
        valid = (i + n - 1 <= last) | (i == begin)
        many = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        return self.start[valid], self.end[np.minimum(i + n - 1, last)[valid]], np.concatenate([[0], np.cumsum(many)])


def rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each buf[start:end]; ``buf`` must have 8 bytes after the last end.

    Spans of one length are hashed together; long ones go to the C library.
    """
    length = end - start
    out = np.zeros(len(start), np.uint64)
    if not len(start):
        return out
    wide = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    half = np.ndarray((len(buf) - 7,), "<u4", buf, strides=(1,))
    seed64 = np.uint64(seed)
    order = np.argsort(length, kind="stable")
    sizes, at = np.unique(length[order], return_index=True)
    with np.errstate(over="ignore"):
        for size, lo, hi in zip(sizes.tolist(), at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
            which = order[lo:hi]
            if size >= 32:
                raw = buf.data
                out[which] = [xxhash.xxh64_intdigest(raw[a : a + size], seed) for a in start[which].tolist()]
                continue
            p = start[which]
            h = np.full(len(p), seed64 + P5 + np.uint64(size), np.uint64)
            done = 0
            while done + 8 <= size:
                h ^= rotate(wide[p + done] * P2, 31) * P1
                h = rotate(h, 27) * P1 + P4
                done += 8
            if done + 4 <= size:
                h ^= half[p + done].astype(np.uint64) * P1
                h = rotate(h, 23) * P2 + P3
                done += 4
            while done < size:
                h ^= buf[p + done].astype(np.uint64) * P5
                h = rotate(h, 11) * P1
                done += 1
            h ^= h >> np.uint64(33)
            h *= P2
            h ^= h >> np.uint64(29)
            h *= P3
            h ^= h >> np.uint64(32)
            out[which] = h
    return out
