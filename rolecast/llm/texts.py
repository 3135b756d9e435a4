"""Arrow batches of texts: slices by bytes, words, and 64-bit word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text of one slice. A single longer text is a slice of its own; texts are never cut.
SLICE_BYTES = 2_000_000
#: Words are runs of anything but these.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_MULTIPLIER = 0x9E3779B97F4A7C15
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def unused(columns: list[str], name: str) -> str:
    """`name`, with underscores in front until no column is called so."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches`, cut so that the texts of a slice take about `limit` bytes."""
    for batch in batches:
        sizes = np.array(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        block = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        _POWERS[:] = [
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, factor, np.uint64))]) for factor in (_MULTIPLIER, inverse)
        ]
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span; it depends on the values only."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of the texts of a slice, in order, as spans of one byte array.

    first[i]:first[i + 1] are the words of text i."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        word = np.concatenate([[False], ~_IS_SPACE[self.data], [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.array([len(text) + 1 for text in texts], np.int64)
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.first = np.searchsorted(self.starts, self.text_starts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends)


def window_hashes(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each window of `width` values that lies within one text."""
    counts = np.diff(first)
    kept = np.maximum(counts - width + 1, 0)
    starts = np.arange(kept.sum()) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(kept)[:-1]]), kept)
    return starts, span_hashes(values, starts, starts + width)
