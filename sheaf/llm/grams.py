"""Hashed byte n-grams of normalised text, and table look-ups summed per document."""

from __future__ import annotations

import numpy as np

# ASCII bytes that are no letters read as a space; A-Z in lower case.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the two-byte Latin-1 letters; bytes keep their number."""
    out = FOLD[data]
    if len(out) > 1:
        high = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][high] += 0x20
    return out


def ids(data: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The hashed n-gram that starts at each byte (the last ``width - 1`` wrap round)."""
    h = np.zeros(len(data), np.uint32)
    for k in range(width):
        h = h * np.uint32(0x01000193) + np.roll(data, -k)
    h *= np.uint32(0x9E3779B1)
    return (h >> np.uint32(32 - bits)).astype(np.int32)


def within(data: np.ndarray, offsets: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams that lie inside one document, and the offsets of each document's."""
    count = np.maximum(np.diff(offsets) - width + 1, 0)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    inside = np.ones(len(data), bool)
    for back in range(1, width):
        # a document shorter than that reaches into those before it, which end there as well
        inside[np.maximum(offsets[1:] - back, offsets[:-1])[np.diff(offsets) > 0]] = False
    return ids(data, width, bits)[inside], first


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` rows between consecutive offsets; an empty document sums to 0."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(values, offsets[:-1][some], axis=0)
    return out
