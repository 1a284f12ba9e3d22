"""Words and runs of words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from functools import cache

import numpy as np

from sluice.llm._frames import SLICE_BYTES

_BYTE_STEP = 0x9E3779B97F4A7C15
_WORD_STEP = 0xD1342543DE82EF95


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits (the finisher of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@cache
def _powers(step: int, size: int) -> np.ndarray:
    out = np.full(size, step, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers_for(step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``step`` and of its inverse modulo 2**64; the usual size is kept."""
    inverse = pow(step, -1, 1 << 64)
    if size > SLICE_BYTES + 1:
        return _powers.__wrapped__(step, size), _powers.__wrapped__(inverse, size)
    return _powers(step, SLICE_BYTES + 1), _powers(inverse, SLICE_BYTES + 1)


@cache
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_STEP))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = _WORD_STEP) -> np.ndarray:
    """A hash of each run ``values[start:end]`` that depends on the values in it and their order only."""
    powers, inverses = _powers_for(step, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, counts)``: bytes of each word of all texts, and the number of words of each text.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and return.
    """
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    begins = solid[1:-1] & ~solid[:-2]
    finishes = solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[1:-1][inner]
    finishes[inner - 1] = solid[1:-1][inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(byte_values()[data], starts, ends, _BYTE_STEP)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
