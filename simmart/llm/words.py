"""Words of a text as 64-bit hashes, for whole texts at once in numpy.

A word's hash is a polynomial in its UTF-8 bytes modulo 2**64, got from running
sums over the text, and then mixed. Modulo a power of two there are unlike texts,
of a thousand letters and more, whose polynomials are equal by construction (those
of the Thue-Morse sequence): words of over LONG bytes are hashed by XXH3
instead. Hashes of runs of words are made from word hashes as those are of bytes;
runs are short.
"""

from __future__ import annotations

import numpy as np
import xxhash

LONG = 128
_BASE = 0x9E3779B97F4A7C15
_RUN_BASE = 0xD1342543DE82EF95
_BITS = 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64 (Steele, Lea & Flood, 2014)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bytes(delimiters: bytes) -> np.ndarray:
    """Table of the bytes that belong to words."""
    found = np.ones(256, bool)
    found[list(delimiters)] = False
    return found


# Space, tab, line feed, vertical tab, form feed, carriage return.
SPACED = word_bytes(b" \t\n\x0b\x0c\r")


class Hasher:
    """Holds tables of powers, as long as the longest text so far."""

    def __init__(self) -> None:
        self._bytes = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
        self._powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _table(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse, n of each at least."""
        held = self._powers.get(base)
        if held is None or len(held[0]) < n:
            n = max(1 << 16, 1 << (n - 1).bit_length())
            held = tuple(
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))])
                for b in (base, pow(base, -1, _BITS))
            )
            self._powers[base] = held
        return held

    def words(self, data: np.ndarray, inside: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words in the bytes of a text."""
        n = len(data)
        marks = np.zeros(n + 2, np.int8)
        marks[1:-1] = inside[data]
        edges = np.flatnonzero(np.diff(marks))
        starts, ends = edges[::2], edges[1::2]
        powers, inverses = self._table(_BASE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._bytes[data] * powers[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverses[starts])
        for i in np.flatnonzero(ends - starts > LONG):
            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
        return hashes, starts, ends

    def runs(self, words: np.ndarray, length: int, skip: int = 0, within: int | None = None) -> np.ndarray:
        """Of each run of `within` words (default: length), the hash of the
        `length` words that follow its first `skip`."""
        within = within or length
        n = len(words) - within + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        powers, inverses = self._table(_RUN_BASE, len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[: len(words)], out=sums[1:])
        return mix((sums[skip + length : skip + length + n] - sums[skip : skip + n]) * inverses[skip : skip + n])

    def spans(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the runs of words from each start to its end."""
        powers, inverses = self._table(_RUN_BASE, len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[: len(words)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverses[starts])


def utf8(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values: by a sort, several times as fast as hashing is
    for many that are distinct."""
    ordered = np.sort(values)
    stays = np.ones(len(ordered), bool)
    stays[1:] = ordered[1:] != ordered[:-1]
    return ordered[stays]


def sorted_blob(values: np.ndarray) -> bytes:
    """Sorted 64-bit integers as differences, byte by byte of all of them, in
    as few bytes each as the largest needs; what compresses comes together."""
    steps = np.diff(np.asarray(values, np.uint64), prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_sorted_blob(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def among(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values are in the sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values
