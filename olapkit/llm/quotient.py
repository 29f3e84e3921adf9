"""Counting quotient filters: lossless compact counters of fixed-width keys.

A key is a pair of unsigned numbers of ``wide`` and ``low`` bits (at most 64 each): word ids packed into two halves. The
key is permuted invertibly (rounds that xor a mix of one half into the other), so that its leading bits are even. These
are the quotient: they are never stored with a key, only the number of keys for each quotient is. The rest of the bits is
the remainder, stored in full, with a counter. So a filter holds exactly its keys and counts: there are no collisions.

Filters are sorted by permuted key; filters of several shards are merged by adding the counts of equal keys.
"""

from __future__ import annotations

import struct

import numpy as np

from .hashing import mix

_U = np.uint64
_HEAD = struct.Struct("<BBQQ")
_ROUND = [_U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for k in range(1, 5)]


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def permute(left: np.ndarray, right: np.ndarray, wide: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """An invertible permutation of all pairs of ``wide`` and ``low`` bits."""
    for k in (0, 2):
        right = right ^ (mix(left + _ROUND[k]) & _mask(low))
        left = left ^ (mix(right + _ROUND[k + 1]) & _mask(wide))
    return left, right


def restore(left: np.ndarray, right: np.ndarray, wide: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permute``."""
    for k in (2, 0):
        left = left ^ (mix(right + _ROUND[k + 1]) & _mask(wide))
        right = right ^ (mix(left + _ROUND[k]) & _mask(low))
    return left, right


def counted(left: np.ndarray, right: np.ndarray, n: np.ndarray | None, wide: int, low: int):
    """Distinct keys in order, with the sums of their counts (1 each if ``n`` is None)."""
    if not len(left):
        return left, right, np.empty(0, np.int64)
    if wide + low <= 64:
        key = left << _U(low) | right if low < 64 else right
        if n is None:
            key = np.sort(key)
        else:
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        left, right = (key[first] >> _U(low) if low < 64 else left[:len(first)]), key[first] & _mask(low)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        n = None if n is None else n[order]
        first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        left, right, size = left[first], right[first], len(left)
        if n is None:
            return left, right, np.diff(np.append(first, size))
        return left, right, np.add.reduceat(n, first)
    return left, right, np.diff(np.append(first, len(key))) if n is None else np.add.reduceat(n, first)


def _narrow(x: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` of numbers, in whole bytes."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)]).tobytes()


def _widen(data: memoryview, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    width = -(-bits // 8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.view("<u8").ravel()


def pack(left: np.ndarray, right: np.ndarray, n: np.ndarray, bits: int, low: int) -> bytes:
    """A filter of sorted distinct keys. ``bits`` of ``left`` matter: those above are the same for all and known to the
    reader (the filter's path)."""
    left = left & _mask(bits)
    quotient = min(bits, 16, max(0, len(left).bit_length() - 1))
    rest = bits - quotient
    sizes = np.bincount((left >> _U(rest)).astype(np.int64), minlength=1 << quotient)
    code = 1 if sizes.max(initial=0) < 256 else 4
    large = n >= 255
    return b"".join((_HEAD.pack(quotient, code, len(left), int(large.sum())), sizes.astype(f"<u{code}").tobytes(),
                     _narrow(left & _mask(rest), rest), _narrow(right, low),
                     np.where(large, 255, n).astype(np.uint8).tobytes(), n[large].astype("<i8").tobytes()))


def unpack(data: bytes, path: int, bits: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts of a filter, in order; ``path`` is what stands above ``bits`` in every left half."""
    quotient, code, size, larges = _HEAD.unpack_from(data)
    view, at, rest = memoryview(data), _HEAD.size, bits - quotient
    sizes = np.frombuffer(view[at:at + (code << quotient)], f"<u{code}").astype(np.int64)
    at += code << quotient
    left = _widen(view[at:], size, rest)
    at += size * -(-rest // 8)
    right = _widen(view[at:], size, low)
    at += size * -(-low // 8)
    n = np.frombuffer(view[at:at + size], np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(view[at + size:at + size + 8 * larges], "<i8")
    top = np.repeat(np.arange(1 << quotient, dtype=np.uint64), sizes)
    left = left | top << _U(rest) if rest < 64 else left
    return (left | _U(path) << _U(bits) if bits < 64 else left), right, n


def pieces(left: np.ndarray, right: np.ndarray, n: np.ndarray, bits: int, low: int, path: int = 0):
    """(path, filter) for every value of the leading 8 of ``bits`` that sorted distinct keys have."""
    rest = bits - 8
    lead = (left & _mask(bits)) >> _U(rest)
    bounds = np.searchsorted(lead, np.arange(257, dtype=np.uint64))
    for k in np.flatnonzero(np.diff(bounds)):
        s = slice(bounds[k], bounds[k + 1])
        yield path << 8 | int(k), pack(left[s], right[s], n[s], rest, low)
