"""Packs arrays of numbers into bytes; sorted keys take little more than their entropy."""

from __future__ import annotations

import numpy as np
import zstandard

LEVEL = 1


def pack(values: np.ndarray) -> bytes:
    """An array of any number type. Bytes of equal weight stand together, which packs better."""
    kind = values.dtype.str.encode().ljust(4)
    planes = np.ascontiguousarray(values).view("uint8").reshape(len(values), values.dtype.itemsize).T
    return kind + zstandard.compress(planes.tobytes(), LEVEL)


def unpack(packed: bytes) -> np.ndarray:
    kind = np.dtype(bytes(packed[:4]).strip().decode())
    planes = np.frombuffer(zstandard.decompress(packed[4:]), "uint8").reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype="uint64")


def smallest(values: np.ndarray) -> np.ndarray:
    """Non-negative whole numbers in the narrowest type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(most))
