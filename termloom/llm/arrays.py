"""Words and shingles of many texts at once, as numpy arrays of 64-bit hashes.

Whole texts are laid out one after the other as code points; masks, hashes and sums
then run over the whole array. Hashes are equal for equal words; two different ones
meet with a chance of about 2**-54.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

U = np.uint64
_POINTS = 0x110000
#: Odd multipliers of the polynomial hashes.
BY_CHAR, BY_WORD = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = np.atleast_1d(np.asarray(x, U))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(1)
def point_codes() -> np.ndarray:
    """A random-looking 64-bit number for each code point."""
    return mixed(np.arange(1, _POINTS + 1, dtype=U) * BY_CHAR)


@lru_cache(1)
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(_POINTS)])


@lru_cache(1)
def letters_and_digits() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(_POINTS)])


@lru_cache(1)
def not_ascii_space() -> np.ndarray:
    """All code points but U+0020 and U+0009 to U+000D."""
    out = np.ones(_POINTS, bool)
    out[[0x20, *range(0x09, 0x0E)]] = False
    return out


@lru_cache(8)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: np.uint64) -> np.ndarray:
    return _powers(1 << max(6, int(n - 1).bit_length()), int(base))


def chunks(texts: list[str], points: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about so many code points (a longer text is alone), each with its place."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > points:
            yield start, texts[start:i]
            start, total = i, 0
        total += len(text) + 1
    if start < len(texts):
        yield start, texts[start:]


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, a line feed after each, and where each text starts (and the end)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    data = ("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, np.uint32), starts


def ascii_lower(points: np.ndarray) -> np.ndarray:
    return points + np.where((points >= 65) & (points <= 90), np.uint32(32), np.uint32(0))


def words(points: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where the words of each text start (and the end).

    A word is a longest run of code points that `inside` marks; the line feed after
    each text must not be marked.
    """
    mask = inside[points]
    if not mask.any():
        return np.zeros(0, U), np.zeros(len(starts), np.int64)
    edge = np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = end - begin
    first = np.cumsum(length) - length
    chars = points[mask]
    place = np.arange(len(chars)) - np.repeat(first, length)
    terms = point_codes()[chars] * powers(int(length.max()), BY_CHAR)[place]
    return mixed(np.add.reduceat(terms, first)), np.searchsorted(begin, starts)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words of each text, and where those of each text start (and the end).

    A text with fewer words has its whole sequence as one shingle, one without words none.
    """
    counts = np.diff(bounds)
    out_counts = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(out_counts)])
    if not len(hashes):
        return hashes, out_bounds
    step = powers(size, BY_WORD)
    whole = np.zeros(max(0, len(hashes) - size + 1), U)
    for j in range(size):
        whole += hashes[j : j + len(whole)] * step[j]
    out = np.zeros(out_bounds[-1], U)
    full = np.flatnonzero(counts >= size)
    take = np.repeat(bounds[full] - out_bounds[full], out_counts[full])
    at = np.arange(len(take)) + np.repeat(out_bounds[full] - (np.cumsum(out_counts[full]) - out_counts[full]), out_counts[full])
    out[at] = mixed(whole[at + take] + U(size))
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        part = hashes[bounds[i] : bounds[i + 1]]
        out[out_bounds[i]] = mixed((part * step[: len(part)]).sum(dtype=U, keepdims=True) + U(len(part)))[0]
    return out, out_bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]
