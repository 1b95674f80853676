"""Word shingles of whole texts as 64-bit hashes, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .common import slices

WIDTH = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_LETTER = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
#: Words hashed at once: a letter takes some 50 bytes meanwhile.
_STRETCH = 1 << 16


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words between white space, and the number of words per text.

    A word's hash is a polynomial of its bytes modulo 2^64 with random byte values.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = words.flatten()
    if not len(flat):
        return np.zeros(0, np.uint64), sizes
    wide = np.int64 if pa.types.is_large_string(flat.type) else np.int32
    _, ends, data = flat.buffers()
    ends = np.frombuffer(ends, wide)[flat.offset:flat.offset + len(flat) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    real = ends[1:] > ends[:-1]  # white space at either end leaves an empty word
    if not real.all():
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sizes = np.bincount(owner[real], minlength=len(sizes)).astype(np.int64)
    starts, ends = ends[:-1][real], ends[1:][real]
    power = np.ones(int((ends - starts).max(initial=1)), np.uint64)
    power[1:] = _ODD
    power = np.cumprod(power)
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _STRETCH):
        lo, hi = starts[at:at + _STRETCH], ends[at:at + _STRETCH]
        # Words are apart by their separators at most, so a stretch of them is a stretch of bytes.
        n = hi - lo
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        letters = data[place + np.repeat(lo, n)]
        out[at:at + _STRETCH] = np.add.reduceat(_LETTER[letters] * power[place], first)
    return out ^ (out >> _SHIFT), sizes


def _mix(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words."""
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = (h ^ (h >> _SHIFT)) * _ODD + words[k:k + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; fewer words than ``WIDTH`` form one."""
    for part in slices(texts):
        words, sizes = word_hashes(part)
        ends = np.cumsum(sizes)
        runs = _mix(words, WIDTH) if len(words) >= WIDTH else np.zeros(0, np.uint64)
        for start, end in zip((ends - sizes).tolist(), ends.tolist()):
            n = end - start
            if n >= WIDTH:
                grams = np.sort(runs[start:end - WIDTH + 1])
                fresh = np.ones(len(grams), bool)
                np.not_equal(grams[1:], grams[:-1], out=fresh[1:])
                yield grams[fresh]
            elif n:
                yield _mix(words[start:end], n)
            else:
                yield np.zeros(0, np.uint64)


def set_key(grams: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return xxhash.xxh3_128_digest(grams.tobytes())
