"""Arrays as compressed bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def squeeze(values: np.ndarray) -> bytes:
    """An array as bytes: all first bytes, all second ones and so on, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def loosen(data: bytes, dtype: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.empty(0, dtype)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=keys.dtype.type(0)))


def loosen_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(loosen(data, "u8"), dtype=np.uint64)
