"""Words of many texts at once: where they begin and end, and a 64-bit hash of each.

A word is a run of bytes other than ASCII white space. All arithmetic is done on
arrays that hold a few megabytes of text, never per word. Only words of over LONG bytes are
hashed one by one, by xxh3: the sum of products that serves for the others gives some
long words of a regular build the same hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import xxhash

GROUP_BYTES = 8 << 20
_WORDS_AT_ONCE = 200_000
LONG = 128
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_BYTE[SPACE] = 0
_BYTE_FOLDED = _BYTE[_LOWER]
_BYTE_KEPT = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_BYTE_KEPT[32] = 0
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1024)
        steps = np.full(size, _MULTIPLIER, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """The words of a group of texts, one after the other."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # text k has the words bounds[k] to bounds[k + 1]
    offsets: np.ndarray  # text k begins at this byte of `data`

    def slices(self) -> Iterator[tuple[int, int]]:
        return zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())


def scan(
    texts: Sequence[bytes], fold: bool, only_spaces: bool = False,
    cuts: Callable[[np.ndarray], np.ndarray] | None = None,
) -> Words:
    """Find and hash all words; with `fold`, A-Z count as a-z in the hash.

    With `only_spaces`, nothing but a space parts words, and other white space counts in the hash.
    `cuts` says before which bytes a word begins besides, without white space between.
    """
    data = b" " + b" ".join(texts) + b" "
    raw = np.frombuffer(data, dtype=np.uint8)
    space = raw == 32 if only_spaces else SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    if cuts is not None:
        inner = np.flatnonzero(cuts(raw) & ~space & ~np.concatenate([[True], space[:-1]]))
        starts, ends = (np.sort(np.concatenate([x, inner]), kind="stable") for x in (starts, ends))
    table = _BYTE_KEPT if only_spaces else _BYTE_FOLDED if fold else _BYTE
    hashes = np.empty(len(starts), dtype=np.uint64)
    for i in range(0, len(starts), _WORDS_AT_ONCE):
        s, e = starts[i : i + _WORDS_AT_ONCE], ends[i : i + _WORDS_AT_ONCE]
        low, high = s[0], e[-1]
        spans = np.diff(s, append=high)
        position = np.arange(high - low) - np.repeat(s - low, spans)
        longest = int((e - s).max())
        power = powers(longest + 1)
        value = table[raw[low:high]] * power[np.minimum(position, longest)]
        sums = np.add.reduceat(value, s - low)
        hashes[i : i + len(s)] = mix(sums + (e - s).astype(np.uint64) * _MULTIPLIER)
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        word = data[starts[i] : ends[i]]
        hashes[i] = xxhash.xxh3_64_intdigest(word.lower() if fold else word)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets), offsets)


def groups(texts: Sequence[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes; a longer text stands alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words, in order; of the whole sequence if it is shorter."""
    n = min(width, len(words))
    if n == 0:
        return words
    count = len(words) - n + 1
    out = np.full(count, n, dtype=np.uint64)
    for k in range(n):
        out = out * _MULTIPLIER + words[k : k + count]
    return mix(out)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(words, width))


def sequence_hash(values: np.ndarray) -> int:
    """One 64-bit hash of a sequence of 64-bit values."""
    return xxhash.xxh3_64_intdigest(np.ascontiguousarray(values, dtype="<u8").tobytes())
