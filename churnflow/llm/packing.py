"""Many small values in one binary cell, and rolling hashes modulo 2**64: fewer bytes and rows to shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from churnflow.llm.common import documents_of

_BASE = 0x9E3779B97F4A7C15
_HASH_BYTES = 7


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, kept between texts."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            rows = [np.full(max(n, 2 * len(self.up)), b, np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
            for row in rows:
                row[0] = 1
            self.up, self.down = map(np.multiply.accumulate, rows)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads a value over all 64 bits; one-to-one, so no two values fall together."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Rabin-Karp hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        # With S[i] the sum of value[j] * base**-j over j < i, a stretch [s, e) is (S[e] - S[s]) * base**s.
        self.up, down = _powers.to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * down[: len(values)], out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        """The hashes of all stretches of one width."""
        if len(self.sums) <= width:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[width:] - self.sums[:-width]) * self.up[: len(self.sums) - width])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.up[starts])


def narrow(x: np.ndarray) -> bytes:
    """Ascending longs as differences of the least width, which the first byte tells."""
    step = np.diff(x, prepend=x[:1])
    width = next(w for w in (1, 2, 4, 8) if w == 8 or step.max(initial=0) < 1 << (8 * w))
    return bytes([width]) + x[:1].astype("<i8").tobytes() + step.astype(f"<u{width}").tobytes()


def wide(b: bytes) -> np.ndarray:
    if len(b) == 1:
        return np.zeros(0, np.int64)
    return np.frombuffer(b, "<i8", 1, 1) + np.cumsum(np.frombuffer(b, f"<u{b[0]}", -1, 9).astype(np.int64))


def pack56(h: np.ndarray) -> bytes:
    """The lower 56 bits of each hash; a bucket stands for the upper ones."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]).tobytes()


def unpack56(b: bytes, bucket: int, bits: int) -> np.ndarray:
    out = np.zeros((len(b) // _HASH_BYTES, 8), np.uint8)
    out[:, :_HASH_BYTES] = np.frombuffer(b, np.uint8).reshape(-1, _HASH_BYTES)
    return out.view("<u8").ravel() | (np.uint64(bucket) << np.uint64(64 - bits))


def bucket_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def group_of(ids: np.ndarray, n: int) -> np.ndarray:
    """The group of documents that an id belongs to."""
    return (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int64)


def runs(x: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def in_groups(documents: DataFrame, n_groups: int) -> DataFrame:
    """``doc_id``, ``text`` and the group ``at`` of each row; rows without an id are dealt out like ids of their own."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("doc_id")
            ids = np.where(np.array(column.is_null()), np.arange(batch.num_rows), np.array(column.fill_null(0)))
            at = group_of(ids, n_groups)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=["doc_id", "text", "at"])

    return documents_of(documents).mapInArrow(add, "doc_id long, text string, at long")
