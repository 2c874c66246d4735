"""Word shingles of many texts at once, as 64-bit hashes.

Words are runs of anything but ASCII white space, with A-Z in lower case. A text
of fewer words than a shingle takes gives one shingle of all its words; a text
without words gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BASE = 0x100000001B3
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_break = np.zeros(256, bool)
_break[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []

#: Bytes of text that one step handles.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 2 * CHUNK_BYTES)
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, np.uint64)
            down = np.full(size, _BASE_INVERSE, np.uint64)
            up[0] = down[0] = 1
            _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets); NULL counts as empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, offsets) of runs of texts of about CHUNK_BYTES; a long text is a run of its own."""
    data, offsets = text_bytes(texts)
    first, n = 0, len(texts)
    while first < n:
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield first, data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the text it is in); words end where texts do."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gap = _break[data]
    begins = ~gap
    begins[1:] &= gap[:-1]
    ends = ~gap
    ends[:-1] &= gap[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = ~gap[edges]
    ends[edges - 1] = ~gap[edges - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power_tables(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_fold[data].astype(np.uint64) + U(1)) * up[: len(data)], out=sums[1:])
    hashes = mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64) * U(_STEP))
    return hashes, np.searchsorted(offsets, start, "right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text: its distinct shingles, ascending, and how often each occurs."""
    hashes, owner = word_hashes(data, offsets)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    windows = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        windows = windows * U(_STEP) + hashes[k : k + len(windows)]
    windows = mix(windows)
    for begin, stop in zip(bounds[:-1], bounds[1:]):
        n = stop - begin
        if n >= words:
            yield np.unique(windows[begin : stop - words + 1], return_counts=True)
        elif n:
            whole = U(n)
            with np.errstate(over="ignore"):
                for h in hashes[begin:stop]:
                    whole = whole * U(_STEP) + h
                yield mix(np.array([whole])), np.ones(1, np.int64)
        else:
            yield np.zeros(0, np.uint64), np.zeros(0, np.int64)
