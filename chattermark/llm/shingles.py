"""Words and word shingles of texts as numbers, for code that runs in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying loses nothing
EMPTY = np.empty(0, dtype="uint64")
#: White space of the contracts, 0x09 to 0x0D and the blank.
BLANKS = b"\t\n\x0b\x0c\r "
#: Longer words are hashed one by one; sums over powers are too regular for them.
LONG_WORD = 64
PIECE = 1 << 17


def lowered_words(text: str | None) -> list[bytes]:
    """Words between white space of 0x09 to 0x0D and blanks, with A to Z lowered and nothing else."""
    return (text or "").encode().lower().split()


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers; seeds give unrelated orders."""
    x = values ^ np.uint64(seed * int(MULTIPLIER) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_numbers() -> np.ndarray:
    """A scrambled number for each byte, 0 for white space."""
    numbers = mixed(np.arange(1, 257, dtype="uint64"), 3)
    numbers[list(BLANKS)] = 0
    return numbers


BYTES = _byte_numbers()
IS_BLANK = BYTES == 0


class Powers:
    """Powers of a multiplier and of its inverse, modulo 2 ** 64, for buffers of any length."""

    def __init__(self) -> None:
        self.base = 0xD1342543DE82EF97
        self.up = self.down = EMPTY

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * PIECE)
            inverse = pow(self.base, -1, 1 << 64)
            self.up, self.down = (self._table(b, n) for b in (self.base, inverse))
        return self.up, self.down

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, dtype="uint64")
        factors[0] = 1
        return np.cumprod(factors, dtype="uint64")


POWERS = Powers()


def _hashed(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a buffer that begins and ends with a blank.

    A word's hash is a sum over its bytes, taken from running sums over the buffer.
    """
    blank = IS_BLANK[buffer]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    up, down = POWERS.upto(len(buffer))
    running = np.cumsum(BYTES[buffer] * up[: len(buffer)], dtype="uint64")
    sums = (running[ends - 1] - running[starts - 1]) * down[starts]
    hashes = mixed(sums, 1) ^ mixed((ends - starts).astype("uint64"), 2)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(buffer[starts[i] : ends[i]].tobytes())
    return hashes, starts


def word_hashes(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words, in order. Works on some hundred kilobytes at a time."""
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        waiting.append((text or "").encode().lower())
        size += len(waiting[-1])
        if size >= PIECE:
            yield from _split(waiting)
            waiting, size = [], 0
    if waiting:
        yield from _split(waiting)


def _split(texts: list[bytes]) -> Iterator[np.ndarray]:
    buffer = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype="uint8")
    hashes, starts = _hashed(buffer)
    cuts = np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)]))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield hashes[a:b]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct shingles of `k` words, ascending; fewer words make one shingle, none make none."""
    if len(words) == 0:
        return EMPTY
    width = min(k, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype="uint64")
    for i in range(width):
        out = out * MULTIPLIER + words[i : i + n]
    out = np.sort(mixed(out))
    return out[np.append(True, out[1:] != out[:-1])]


def shingle_sets(texts: Iterable[str | None], k: int) -> Iterator[np.ndarray]:
    """The shingle set of each text."""
    return (shingle_set(words, k) for words in word_hashes(texts))
