"""Exact integer inner products of scaled vectors, at any size of component."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_PLAIN = 2.0**40


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def exact(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, for a power of two: whole doubles, or Python integers where doubles end."""
    if not x.size or np.abs(x).max() < _PLAIN:
        return np.floor(x * float(scale))
    whole = [int(e) * scale if abs(e) >= 2.0**53 else math.floor(e * scale) for e in x.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(x.shape)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows, as longs where all fit, else as Python integers."""
    largest = [int(np.abs(m).max(initial=0)) if m.size else 0 for m in (q, c)]
    bound = largest[0] * largest[1] * q.shape[1]
    if bound < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound < 2**63 and max(largest) < 2**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = [np.array([[int(e) for e in row] for row in m.tolist()], object).reshape(m.shape) for m in (q, c)]
    return whole[0] @ whole[1].T


class Keys:
    """Scores as binary keys of one length whose order is that of the scores, whatever their size."""

    def __init__(self, largest: int, dim: int) -> None:
        self.width = max(8, (int(largest) ** 2 * dim).bit_length() // 8 + 1)
        self.middle = 1 << (8 * self.width - 1)

    def of(self, scores: np.ndarray) -> list[bytes]:
        if scores.dtype != object and self.width == 8:
            raw = (scores.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").tobytes()
            return [raw[i:i + 8] for i in range(0, len(raw), 8)]
        return self.made(scores.tolist())

    def made(self, scores: list[int]) -> list[bytes]:
        return [(int(s) + self.middle).to_bytes(self.width, "big") for s in scores]

    def score(self, key: bytes) -> int:
        return int.from_bytes(key, "big") - self.middle

    def reader(self, *columns: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """For ``mapInArrow``: the named key columns as longs, null where a score is beyond one."""
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for name in batch.schema.names:
                    if name in columns:
                        scores = [self.score(k) for k in batch[name].to_pylist()]
                        out.append(pa.array([s if -(2**63) <= s < 2**63 else None for s in scores], pa.int64()))
                    else:
                        out.append(batch[name])
                yield pa.RecordBatch.from_arrays(out, batch.schema.names)
        return read
