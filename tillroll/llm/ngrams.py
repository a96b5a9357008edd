"""Words of whole texts as byte ranges, and n-grams interned in an open-addressed table.

Texts are handled as the bytes of an Arrow string array: in UTF-8 every byte
of a character beyond ASCII is 0x80 or more, so a class of ASCII characters is
a table of 256 bytes, and only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
#: The five primes of xxHash64.
_P1, _P2, _P3, _P4, _P5 = (_U(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Longer byte ranges are hashed and compared one by one.
LONG = 128


def byte_class(digits: bool) -> np.ndarray:
    """Which bytes belong to words: letters, bytes beyond ASCII and, if asked for, digits."""
    word = np.zeros(256, bool)
    word[0x80:] = True
    word[ord("A"):ord("Z") + 1] = word[ord("a"):ord("z") + 1] = True
    word[ord("0"):ord("9") + 1] = digits
    return word


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Words:
    """The words of some texts in order, each followed by a space in ``data``."""
    data: np.ndarray    # bytes, padded by eight zeros
    start: np.ndarray   # of each word in data
    end: np.ndarray
    text: np.ndarray    # the number of its text

    def strings(self) -> pa.Array:
        """The words as an Arrow array, without a copy per word."""
        if not len(self.start):
            return pa.array([], pa.string())
        # Each word's slot of the offsets holds the word and its space; the space is cut off.
        import pyarrow.compute as pc

        offsets = np.r_[self.start, self.end[-1] + 1].astype(np.int32)
        spaced = pa.StringArray.from_buffers(len(self.start), pa.py_buffer(offsets), pa.py_buffer(self.data))
        return pc.binary_slice(spaced.cast(pa.binary()), 0, -1).cast(pa.string())


def words(texts: pa.Array, word_bytes: np.ndarray) -> Words:
    """The maximal runs of word bytes of each text (no nulls), A-Z lower-cased."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4) if n else np.zeros(1, np.int32)
    raw = texts.buffers()[2]
    raw = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    edge = offsets.astype(np.int64) - offsets[0]
    inside = np.r_[False, word_bytes[raw], False]
    # A run ends where its text does, whatever the next text begins with.
    inner = edge[1:-1]
    joined = inner[inside[inner] & inside[inner + 1]] if len(inner) else inner
    change = np.flatnonzero(inside[1:] != inside[:-1])
    if len(joined):
        change = np.sort(np.r_[change, np.repeat(np.unique(joined), 2)], kind="stable")
    a, b = change[::2], change[1::2]
    size = b - a
    start = np.cumsum(size + 1) - (size + 1)
    total = int(size.sum() + len(size))
    data = np.zeros(total + 8, np.uint8)
    if total:
        at = np.repeat(a - start, size + 1)
        at += np.arange(total)
        data[:total] = _LOWER[np.r_[raw, np.uint8(32)][at]]
        data[start + size] = 32
    return Words(data, start, start + size, np.searchsorted(edge, a, "right") - 1)


def runs(found: Words, most: int, chunk: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``first, last`` word of all runs of 1 to ``most`` consecutive words of a text, for ``chunk`` first words at a time."""
    n = len(found.start)
    for a in range(0, n, chunk):
        first = np.arange(a, min(a + chunk, n))
        firsts, lasts = [], []
        for k in range(most):
            f = first[first + k < n]
            f = f[found.text[f] == found.text[f + k]]
            firsts.append(f)
            lasts.append(f + k)
        yield np.concatenate(firsts), np.concatenate(lasts)


def _zero_bytes(most: int) -> np.ndarray:
    """By number of bytes, byte of the register and its value: what so many zero bytes make of a CRC-32 register."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0))
    out = np.empty((most, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for k in range(1, most):
        out[k] = (out[k - 1] >> 8) ^ step[out[k - 1] & 255]
    return out


def crc32(found: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of words, joined by one space.

    Each different word is read once; a run's value is the one before it moved
    on by the next word's length, xor the next word's.
    """
    import zlib

    coded = found.strings().dictionary_encode()
    code = coded.indices.to_numpy()
    different = coded.dictionary.cast(pa.binary()).to_pylist()
    alone = np.array([zlib.crc32(w) for w in different], np.uint32)
    spaced = np.array([zlib.crc32(b" " + w) for w in different], np.uint32)
    size = (found.end - found.start) + 1
    table = _zero_bytes(LONG)
    out = alone[code[first]] if len(first) else np.zeros(0, np.uint32)
    at, on = first.copy(), np.flatnonzero(last > first)
    while len(on):
        at[on] += 1
        w, crc = at[on], out[on]
        n = np.minimum(size[w], LONG - 1)
        moved = table[n, 0, crc & 255]
        for k in (1, 2, 3):
            moved ^= table[n, k, (crc >> (8 * k)) & 255]
        out[on] = moved ^ spaced[code[w]]
        on = on[last[on] > at[on]]
    view = memoryview(found.data)
    for i in np.flatnonzero(_holds_long(size, first, last)):
        out[i] = zlib.crc32(view[found.start[first[i]]:found.end[last[i]]])
    return out


def _holds_long(size: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a word other than the first is too long for the table."""
    before = np.r_[0, np.cumsum(size >= LONG)]
    return before[last + 1] > before[first + 1]


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def xxhash64(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of each byte range of ``data``, which is padded by eight bytes."""
    import xxhash

    size = end - start
    h = np.zeros(len(start), _U)
    long = np.flatnonzero(size >= LONG)
    if len(long):
        view = memoryview(data)
        h[long] = [xxhash.xxh64_intdigest(view[i:j]) for i, j in zip(start[long].tolist(), end[long].tolist())]
    some = np.flatnonzero(size < LONG)
    with np.errstate(over="ignore"):
        h[some] = _short(_eights(data), data, start[some], size[some])
    return h


def _round(v: np.ndarray, eight: np.ndarray) -> np.ndarray:
    return _rotated(v + eight * _P2, 31) * _P1


def _short(eights: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = np.full(len(start), _P5)
    at = start.copy()
    wide = np.flatnonzero(size >= 32)
    if len(wide):
        lanes = [np.full(len(wide), x, _U) for x in (_P1 + _P2, _P2, _U(0), _U(0) - _P1)]
        left, here = size[wide], at[wide]
        while True:
            on = left >= 32
            if not on.any():
                break
            for k in range(4):
                lanes[k] = np.where(on, _round(lanes[k], eights[np.where(on, here + 8 * k, 0)]), lanes[k])
            here, left = here + 32 * on, left - 32 * on
        total = sum((_rotated(v, r) for v, r in zip(lanes, (1, 7, 12, 18))), np.zeros(len(wide), _U))
        for v in lanes:
            total = (total ^ _round(np.zeros(len(wide), _U), v)) * _P1 + _P4
        h[wide], at[wide] = total, here
    h += size.astype(_U)
    end = start + size
    on = np.flatnonzero(end - at >= 8)
    while len(on):
        x = _rotated(h[on] ^ _round(_U(0), eights[at[on]]), 27) * _P1 + _P4
        h[on] = x
        at[on] += 8
        on = on[end[on] - at[on] >= 8]
    on = np.flatnonzero(end - at >= 4)
    h[on] = _rotated(h[on] ^ ((eights[at[on]] & _U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[on] += 4
    on = np.flatnonzero(end > at)
    while len(on):
        h[on] = _rotated(h[on] ^ (data[at[on]].astype(_U) * _P5), 11) * _P1
        at[on] += 1
        on = on[end[on] > at[on]]
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ranges of these sizes at a and at b hold the same bytes."""
    eights, same = _eights(data), a == b
    long = np.flatnonzero(~same & (size >= LONG))
    if len(long):
        view = memoryview(data)
        same[long] = [view[i:i + n] == view[j:j + n] for i, j, n in zip(a[long].tolist(), b[long].tolist(), size[long].tolist())]
    on, k = np.flatnonzero(~same & (size < LONG)), 0
    while len(on):
        differ = (eights[a[on] + k] ^ eights[b[on] + k]) & _MASK[np.minimum(size[on] - k, 8)]
        on = on[differ == 0]
        k += 8
        done = size[on] <= k
        same[on[done]] = True
        on = on[~done]
    return same


def intern(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte range's slot in an open-addressed table, and by slot the range that owns it (-1: free).

    Linear probing from the key; a slot takes equal bytes only, so ranges whose
    keys clash get slots of their own.
    """
    n = len(key)
    size = 1 << max(int(2 * n - 1).bit_length(), 4)
    owner = np.full(size, -1, np.int32)
    slot = (key & _U(size - 1)).astype(np.int64)
    length = end - start
    left = np.arange(n)
    while len(left):
        s = slot[left]
        free = owner[s] < 0
        owner[s[free]] = left[free]  # of several, the last stays
        own = owner[s]
        hit = (key[own] == key[left]) & (length[own] == length[left])
        at = np.flatnonzero(hit)
        hit[at] = same_bytes(data, start[left[at]], start[own[at]], length[left[at]])
        left = left[~hit]
        slot[left] = (slot[left] + 1) & (size - 1)
    return slot, owner
