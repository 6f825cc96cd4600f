"""Number arrays as binary cells that compress well."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first: the high bytes are mostly zero and compress away."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""


def from_planes(cell: bytes, kind: str) -> np.ndarray:
    rows = np.frombuffer(cell, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences."""
    return planes(np.diff(np.r_[np.zeros(1, np.uint64), keys]).astype("<u8"))


def unpacked_keys(cell: bytes) -> np.ndarray:
    return np.cumsum(from_planes(cell, "<u8"))
