"""Texts of an Arrow batch as one byte array, and words and word windows of it as numpy arrays.

Everything is vectorised over a batch of texts. Word classes are given by byte: all bytes of a character beyond ASCII
are 0x80 or more, so a class that treats these alike never cuts a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes of text handled at once; a longer text is handled alone, whole.
PIECE_BYTES = 1 << 19
_HASH_BYTES = 1 << 18
#: Hashes are polynomials modulo this Mersenne prime, at one of two independent points. Modulo a power of two, texts of two
#: letters in a Thue-Morse order and its complement would hash alike at every point.
_PRIME = (1 << 61) - 1
_POINTS = (0x1A3F5C7E9B2D4F61, 0x0C7D1E3B5A998877)
_P, _LOW31, _LOW30 = np.uint64(_PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from halves of 31 bits."""
    a_high, a_low, b_high, b_low = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a_low * b_high + a_high * b_low
    return _reduced(a_high * b_high * np.uint64(2) + (middle >> _30) + ((middle & _LOW30) << _31) + a_low * b_low)


#: A small number for each byte, so that its products with half a power can be summed without reducing them.
_BYTE_VALUE = np.random.default_rng(7).permutation(np.arange(1, 257)).astype(np.uint64)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(point: int, inverse: bool, n: int) -> np.ndarray:
    """The first powers of a point, or of its inverse."""
    held = _powers.get((point, inverse), np.ones(1, np.uint64))
    base = pow(_POINTS[point], -1 if inverse else 1, _PRIME)
    while len(held) < n:
        held = np.concatenate([held, _times(held, np.uint64(pow(base, len(held), _PRIME)))])
    _powers[point, inverse] = held
    return held[:n]


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``low + high * 2**31`` modulo the prime."""
    high = _reduced(high)
    return _reduced(_reduced(low) + ((high & _LOW30) << _31) + (high >> _30))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (one more at the end); null is the empty text."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row, bytes and offsets of successive groups of texts."""
    data, offsets = texts_of(column)
    for a, b in slices(offsets, most):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


#: Fixed value: the first bytes of a Zstandard frame.
_PACKED = b"\x28\xb5\x2f\xfd"


def packed_texts(column: pa.Array) -> pa.Array:
    """Each text compressed (Zstandard); null is the empty text. Smaller shuffles for texts that are only carried."""
    pack = zstandard.ZstdCompressor(level=3)
    _, offsets = texts_of(column)
    parts = [
        pa.array([pack.compress((t or "").encode()) for t in column.slice(a, b - a).to_pylist()], pa.binary())
        for a, b in slices(offsets)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def unpacked_pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``pieces``, of compressed texts; no more than a piece is held uncompressed. A value without the mark of a
    compressed one, whose second byte begins no character, is taken as the text itself."""
    unpack = zstandard.ZstdDecompressor()
    first, held, size = 0, [], 0
    for i, blob in enumerate(column):
        raw = blob.as_py()
        held.append(unpack.decompress(raw) if raw[:4] == _PACKED else raw)
        size += len(held[-1])
        if size >= most or i + 1 == len(column):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in held])]).astype(np.int64)
            yield first, i + 1, np.frombuffer(b"".join(held), np.uint8), offsets
            first, held, size = i + 1, [], 0


def byte_class(separators: bytes) -> np.ndarray:
    """True for the bytes that belong to words."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


#: Words between blanks and the control characters 9 to 13.
SPACED = byte_class(b" \t\n\x0b\x0c\r")


class HashIndex:
    """64-bit keys to numbers from 0 on, in an open-addressing table with linear probing; grows as keys are added."""

    _SPREAD = np.uint64(0x9E3779B97F4A7C15)
    _EMPTY = np.uint64(2**64 - 1)

    def __init__(self, expected: int = 1 << 10):
        self.count = 0
        self._room(max(10, int(expected * 3).bit_length()))

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, self._EMPTY)
        self.values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self._SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys must be distinct and new."""
        if (self.count + len(keys)) * 2 > len(self.keys):
            old = self.keys != self._EMPTY
            held = self.keys[old], self.values[old]
            self.count = 0
            self._room(int((len(held[0]) + len(keys)) * 3).bit_length())
            self.add(*held)
        self.count += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == self._EMPTY)
            here, first = np.unique(slots[free], return_index=True)
            chosen = free[first]
            self.keys[here], self.values[here] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (len(self.keys) - 1)

    def find(self, keys: np.ndarray, absent: int = -1) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], np.int32(absent))
        open_ = np.flatnonzero((found != keys) & (found != self._EMPTY))
        while len(open_):
            at = slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (found != self._EMPTY)]
        return out


@dataclass
class Words:
    """Words of a group of texts: byte positions, the text of each, each text's range of words, and 64-bit hashes."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray


def find_words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray | None = None, hashed: bool = True, point: int = 0
) -> Words:
    """Maximal runs of ``inside`` bytes, never across texts. ``fold`` maps bytes before hashing."""
    n = len(data)
    within = np.zeros(n + 2, bool)
    within[1:-1] = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(within[1:-1] & (~within[:-2] | edge[:-1]))
    ends = np.flatnonzero(within[1:-1] & (~within[2:] | edge[1:])) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    words = np.searchsorted(starts, offsets, "left")
    hashes = hash_ranges(data, starts, ends, fold, point) if hashed else np.zeros(0, np.uint64)
    return Words(starts, ends, row, words, hashes)


def hash_ranges(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None, point: int = 0
) -> np.ndarray:
    """A polynomial hash of each byte range (in ascending order), from running sums over blocks of ranges."""
    value = _BYTE_VALUE if fold is None else _BYTE_VALUE[fold]
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _HASH_BYTES, "right")))
        low, high = int(starts[a]), int(ends[b - 1])
        values, power = value[data[low:high]], _power(point, False, high - low)
        s, e = starts[a:b] - low, ends[a:b] - low
        parts = []
        # sums of products below 2**40 stay exact for 2**24 bytes; a longer range is summed in steps
        for half in (power & _LOW31, power >> _31):
            parts.append(_range_sums(values * half, s, e, 1 << 23))
        own = _times(_joined(*parts), _power(point, True, high - low + 1)[s])
        out[a:b] = mix(own ^ mix((e - s).astype(np.uint64)))
        a = b
    return out


def _range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """Sums of ranges, modulo the prime where there are more than ``step`` values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    if len(values) <= step:
        np.cumsum(values, dtype=np.uint64, out=sums[1:])
        return sums[ends] - sums[starts]
    for i in range(0, len(values), step):
        part = np.cumsum(values[i : i + step], dtype=np.uint64)
        sums[i + 1 : i + 1 + len(part)] = _reduced(_reduced(part) + sums[i])
    return _reduced(sums[ends] + (_P - sums[starts]))


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, point: int = 0) -> np.ndarray:
    """Hash of the values in each range."""
    n = len(hashes)
    product = _times(_reduced(hashes), _power(point, False, n))
    parts = [_range_sums(half, starts, ends, 1 << 31) for half in (product & _LOW31, product >> _31)]
    return mix(_times(_joined(*parts), _power(point, True, n + 1)[starts]))


def window_hashes(hashes: np.ndarray, width: int, point: int = 0) -> np.ndarray:
    """Hash of ``width`` consecutive values from each place on; ``len - width + 1`` of them (none if shorter)."""
    starts = np.arange(max(0, len(hashes) - width + 1))
    return range_hashes(hashes, starts, starts + width, point)


def window_places(offsets: np.ndarray, width: int) -> np.ndarray:
    """For each place of ``window_hashes`` over all words: whether the window lies in one text."""
    total = int(offsets[-1])
    if total < width:
        return np.zeros(0, bool)
    ok = np.ones(total - width + 1, bool)
    cuts = offsets[1:-1]
    for back in range(1, width):
        at = cuts - back
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    return ok
