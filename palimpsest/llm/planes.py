"""Packed numbers and bucket numbers, for what blocks and buckets send to each other."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from palimpsest.llm.words import U64


def packed(values: np.ndarray) -> bytes:
    """Nonnegative whole numbers as compressed planes of bytes, no more planes than needed."""
    values = np.ascontiguousarray(values, np.int64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    head = np.array([width, len(values)], np.int64).tobytes()
    return head + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    width, n = np.frombuffer(raw[:16], np.int64).tolist()
    planes = np.frombuffer(pa.decompress(raw[16:], width * n, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.reshape(-1).view(np.int64)


def packed_floats(values: np.ndarray) -> bytes:
    """Numbers of which many are equal: the distinct ones and which is where."""
    distinct, which = np.unique(values, return_inverse=True)
    return len(distinct).to_bytes(8, "little") + distinct.tobytes() + packed(which)


def unpacked_floats(raw: bytes) -> np.ndarray:
    end = 8 + 8 * int.from_bytes(raw[:8], "little")
    return np.frombuffer(raw[8:end], np.float64)[unpacked(raw[end:])]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where in sorted columns a new value begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)
