"""Words of many texts at once, with numpy, inside Arrow batches.

Texts are taken in slices of a few megabytes, so memory follows the slice (or
the one text that is longer), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 512 << 10

#: Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads nearby values (splitmix64's finisher)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: The first ``n`` bytes of a little-endian integer.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes ``data[starts[i]:ends[i]]``.

    Eight bytes at a time go through a bijection that is not linear, so unlike in a polynomial no two words are
    bound to meet by their pattern; words over ``LONG_WORD`` bytes take XXH64.
    """
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    live = np.flatnonzero(lengths <= LONG_WORD)
    at = 0
    while len(live):
        left = lengths[live] - at
        chunk = eights[starts[live] + at] & _HEAD[np.minimum(left, 8)]
        out[live] = mix(out[live] * np.uint64(0x9E3779B97F4A7C15) ^ chunk)
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), LONG_WORD)
    return out


class Powers:
    """Powers of an odd number modulo 2**64, and of its inverse; grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)), dtype=np.uint64)
                                  for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_CALLS: dict[int, Powers] = {}


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A hash of ``values[s:e]`` for every span: equal sequences get equal hashes, wherever they stand."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A hash of the words ``starts[i]:ends[i]``; seeds give independent hashes."""
    powers = _CALLS.setdefault(seed, Powers(int(mix(np.array([seed], np.uint64))[0]) | 1))
    return spans(hashes if seed == 1 else mix(hashes + np.uint64(seed)), starts, ends, powers)


class Slice:
    """The words of texts ``first:last`` of a batch.

    ``hash``, ``start`` and ``end`` (bytes in ``data``) of every word; ``row``
    tells which text a word is of, counted from ``first``; the words of text r
    are ``bound[r]:bound[r + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, in_word: np.ndarray, fold: bool):
        self.data, self.offsets, self.first, self.n = data, offsets, first, len(offsets) - 1
        is_word = in_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], is_word[:-1]]) if len(data) else is_word
        after = np.concatenate([is_word[1:], [False]]) if len(data) else is_word
        self.start = np.flatnonzero(is_word & (~before | edge[:-1]))
        self.end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
        self.hash = word_hashes(_FOLD[data] if fold else data, self.start, self.end)
        self.bound = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(self.n), np.diff(self.bound))

    def text(self, r: int) -> bytes:
        return self.data[self.offsets[r]:self.offsets[r + 1]].tobytes()


def slices(texts: pa.Array, in_word: np.ndarray = NOT_SPACE, fold: bool = False,
           size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow column slice by slice; a null counts as an empty text."""
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = offsets[first:last + 1]
        yield Slice(data[part[0]:part[-1]], part - part[0], first, in_word, fold)
        first = last


def runs(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places some run ``[start, end)`` covers."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(ends, n), -1)
    return np.cumsum(change[:-1]) > 0
