"""Arrays as compressed blobs, and runs and parts of sorted arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, byte by byte of its numbers."""
    planes = values.view(np.uint8).reshape(len(values), -1).T if values.ndim == 1 else values
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def groups(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal sorted keys."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def by_part(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part and the places of its rows, in order."""
    order = np.argsort(parts, kind="stable")
    starts = groups(parts[order])
    for a, b in zip(starts, [*starts[1:], len(parts)], strict=True):
        yield int(parts[order[a]]), order[a:b]
