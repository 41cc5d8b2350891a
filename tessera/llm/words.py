"""Words of texts and their hashes, a part of a text at a time."""

from __future__ import annotations

import re

import numpy as np
import xxhash

PART = 1 << 19  # bytes worked on at a time
LONG = 512  # bytes of a word
BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
BLANK = re.compile(rb"[\x20\x09-\x0D]")
IN_WORD = np.array([c != 0x20 and not 0x09 <= c <= 0x0D for c in range(256)])


class Words:
    """Two 64-bit codes a word: polynomials over random byte values, taken from
    running sums over the bytes; of words over ``LONG`` bytes a digest, as
    polynomials modulo 2^64 are weak there."""

    def __init__(self):
        rng = np.random.default_rng(11)
        self.values = rng.integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
        factors = [int(x) | 1 for x in rng.integers(1 << 62, 1 << 63, 2)]
        self.up = [self.powers(x) for x in factors]
        self.down = [self.powers(pow(x, -1, 1 << 64)) for x in factors]

    @staticmethod
    def powers(factor: int) -> np.ndarray:
        out = np.full(PART + 1, factor, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def codes(self, data: bytes, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of ``data`` start, and their codes (lane, word).
        ``data`` has at most PART bytes or is one word."""
        if len(data) > PART:
            return np.zeros(1, np.int64), np.frombuffer(xxhash.xxh3_128_digest(data), np.uint64).reshape(2, 1)[:lanes]
        raw = np.frombuffer(data, np.uint8)
        edge = np.diff(IN_WORD[raw].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out = np.empty((lanes, len(start)), np.uint64)
        for k in range(lanes):
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(self.values[k][raw] * self.up[k][: len(raw)], out=sums[1:])
            out[k] = (sums[end] - sums[start]) * self.down[k][start]
            out[k] ^= out[k] >> np.uint64(32)
        for w in np.flatnonzero(end - start > LONG).tolist():
            out[:, w] = np.frombuffer(xxhash.xxh3_128_digest(data[start[w] : end[w]]), np.uint64)[:lanes]
        return start, out

    def prefixes(self, data: bytes, size: int) -> np.ndarray:
        """A code for the first ``size`` bytes of each word of ``data``."""
        if len(data) > PART:
            data = data[:size]
        raw = np.frombuffer(data, np.uint8)
        edge = np.diff(IN_WORD[raw].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[0][raw] * self.up[0][: len(raw)], out=sums[1:])
        out = (sums[np.minimum(end, start + size)] - sums[start]) * self.down[0][start]
        return out ^ out >> np.uint64(32)


def cut(data: bytes):
    """``data`` in parts of at most PART bytes that end between words, or of
    one longer word."""
    at = 0
    while len(data) - at > PART:
        end = max(data.rfind(c, at, at + PART) for c in BLANKS) + 1
        if end <= at:
            found = BLANK.search(data, at)
            end = found.start() if found else len(data)
        if end > at:
            yield data[at:end]
        else:
            end += 1
        at = end
    yield data[at:]


def all_codes(text: str | None, words: Words) -> np.ndarray:
    """One 64-bit code for each word of a whole text."""
    if not text:
        return np.zeros(0, np.uint64)
    return np.concatenate([words.codes(part, 1)[1][0] for part in cut(text.encode())])


def all_prefixes(text: str | None, words: Words, size: int) -> np.ndarray:
    """One 64-bit code for the first ``size`` bytes of each word."""
    if not text:
        return np.zeros(0, np.uint64)
    return np.concatenate([words.prefixes(part, size) for part in cut(text.encode())])
