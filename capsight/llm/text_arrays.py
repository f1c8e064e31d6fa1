"""Words and shingles of whole texts as numpy arrays, a few megabytes at a time.

Words are ``[^\\x20\\x09-\\x0D]+``; all separators are ASCII, so byte positions in UTF-8 suffice.  A word's 64-bit hash is a
keyed polynomial of its bytes; a shingle's identity is 48 bits of a mix of five word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20
MAX_TEXTS = 1 << 15

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20250601))
BYTE_KEYS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1
STEP = np.uint64(0x9E3779B97F4A7C15)
ORDER_KEYS = _RANDOM.integers(1, 1 << 63, 8, dtype=np.uint64) * 2 + 1
MASK48 = np.uint64((1 << 48) - 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes and ``MAX_TEXTS`` rows, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        stop = min(max(stop, at + 1), at + MAX_TEXTS)
        yield at, stop
        at = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts (null: none) and their ``n + 1`` offsets."""
    whole = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(whole):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    text: np.ndarray  # index of the word's text
    length: np.ndarray  # bytes
    hash: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """All words of the texts in order."""
    inside = ~SEPARATOR[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    start[begins] = inside[begins]
    body = (LOWER[data] if lower else data)[inside]
    first = np.flatnonzero(start[inside])  # place of each word's first byte in body
    where = np.flatnonzero(start)
    text = np.searchsorted(offsets, where, "right") - 1
    if not len(first):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none.astype(np.uint64))
    length = np.diff(np.append(first, len(body)))
    powers = np.multiply.accumulate(np.full(int(length.max()), STEP, dtype=np.uint64))
    place = np.arange(len(body)) - np.repeat(first, length)
    return Words(text, length, mix(np.add.reduceat(BYTE_KEYS[body] * powers[place], first) + length.astype(np.uint64)))


def shingle_keys(found: Words, width: int) -> np.ndarray:
    """Distinct ``text << 48 | shingle`` in ascending order; a text shorter than ``width`` words has its whole sequence as one."""
    n = len(found.hash)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    text = found.text
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        part = np.zeros(n, dtype=np.uint64)
        part[:n - k] = found.hash[k:] * ORDER_KEYS[k]
        total += part
    full = np.zeros(n, dtype=bool)
    if n >= width:
        full[:n - width + 1] = text[:n - width + 1] == text[width - 1:]
    keys = [(text[full].astype(np.uint64) << np.uint64(48)) | (mix(total[full]) & MASK48)]
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    count = np.diff(np.append(first, n))
    short = count < width
    if short.any():
        at, size = first[short], count[short]
        total = size.astype(np.uint64) * ORDER_KEYS[-1]
        for k in range(width - 1):
            has = size > k
            total[has] += found.hash[at[has] + k] * ORDER_KEYS[k]
        keys.append((text[at].astype(np.uint64) << np.uint64(48)) | (mix(total, 1) & MASK48))
    keys = np.concatenate(keys)
    keys.sort()
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
