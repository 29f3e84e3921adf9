"""64-bit hashes of words and word shingles, computed over Arrow text buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Multiplier of the polynomial word hash (odd, so it has an inverse modulo 2^64) and mixing constants.
_P, _K1, _K2 = 0x9E3779B97F4A7C15 | 1, _U(0xC2B2AE3D27D4EB4F), _U(0x9E3779B97F4A7C15)
_PINV = pow(_P, -1, 1 << 64)
#: Bytes hashed at a time (a longer word extends its piece).
PIECE = 1 << 18

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _P), ("down", _PINV)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _K2
    x = (x ^ (x >> _U(29))) * _K1
    return x ^ (x >> _U(32))


def _words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and their places; a word also ends where one of ``begins`` is."""
    solid = ~_BLANK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[begins] = True
    cut[0] = cut[-1] = True
    first = np.flatnonzero(solid & (cut[:-1] | np.concatenate([[True], ~solid[:-1]])))
    last = np.flatnonzero(solid & (cut[1:] | np.concatenate([~solid[1:], [True]]))) + 1
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(_U) * _K1), first


def text_words(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order) for every row with words, texts whole; null rows have none."""
    if len(texts) == 0:
        return
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        texts, width = texts.cast(pa.string()), np.int32
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    row, at = 0, int(offsets[0])
    carried: list[np.ndarray] = []
    while row < len(texts):
        # rows [row, end) that fit a piece; or a part of one long row, up to a blank
        end = max(row + 1, int(np.searchsorted(offsets, at + PIECE, "right")) - 1)
        stop = int(offsets[end])
        if stop - at > PIECE:
            blank = np.flatnonzero(_BLANK[data[at + PIECE:stop]])
            if len(blank):
                stop = at + PIECE + int(blank[0])
        part = data[at:stop]
        if lower:
            part = _LOWER[part]
        starts = offsets[row:end] - at
        starts[0] = 0
        hashes, places = _words(part, starts[starts < len(part)]) if len(part) else (np.empty(0, _U), np.empty(0, int))
        bounds = np.searchsorted(places, np.append(starts[1:], len(part)))
        begin = 0
        for k, b in enumerate(bounds):
            own = hashes[begin:b]
            begin = b
            if stop < offsets[end]:  # more of this row follows
                carried.append(own)
                break
            if carried:
                own, carried = np.concatenate([*carried, own]), []
            if len(own) and valid[row + k]:
                yield row + k, own
        row, at = (end if stop == offsets[end] else row), stop


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """The distinct n-word shingles of a text as sorted hashes; fewer than n words are one shingle."""
    if len(words) == 0:
        return words
    width = min(n, len(words))
    x = words[:len(words) - width + 1] + _U(width)
    for k in range(1, width):
        x = mix(x) + words[k:len(words) - width + 1 + k] * _K2
    return np.unique(mix(x))
