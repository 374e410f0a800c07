"""Words of texts by classes of bytes, as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Lower case of A-Z alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(values: np.ndarray, edges: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word and the byte behind it: runs of bytes whose class is ``inside``, none
    across the ends of texts given by n + 1 offsets."""
    held = inside[values]
    if not len(held):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.zeros(len(held) + 1, bool)
    fresh[edges] = True
    begin = held & (np.r_[True, ~held[:-1]] | fresh[:-1])
    end = held & (np.r_[~held[1:], True] | fresh[1:])
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_array(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, inside: np.ndarray) -> pa.StringArray:
    """The words at those places, A-Z lower-cased."""
    held = values[inside[values]]
    edges = np.r_[0, np.cumsum(stops - starts)]
    if edges[-1] != len(held):
        raise ValueError("words don't cover all bytes inside words")
    if edges[-1] >= 1 << 31:
        raise ValueError("a slice of 2 GB")
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(LOWER[held]))


def parts(values: np.ndarray, apart: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Places to cut a long text: before a byte of a class ``apart``, every ``most`` bytes or at the next such byte."""
    out, at = [], 0
    while len(values) - at > most:
        found = np.flatnonzero(apart[values[at + 1 : at + most + 1]])
        if len(found):
            stop = at + 1 + int(found[-1])
        else:
            stop = at + most + 1
            while stop < len(values) and not apart[values[stop]]:
                stop += 1
        out.append((at, stop))
        at = stop
    return [*out, (at, len(values))]
