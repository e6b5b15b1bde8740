"""Numeric arrays in binary columns."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, each in planes of equal byte positions, compressed."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        small = zstandard.ZstdCompressor(level=1).compress(raw)
        out.append(np.array([len(a), len(small), ord(a.dtype.kind), a.itemsize], dtype=np.int64).tobytes() + small)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, size, kind, item = np.frombuffer(data, np.int64, 4, at).tolist()
        raw = zstandard.ZstdDecompressor().decompress(data[at + 32:at + 32 + size], max_output_size=n * item)
        out.append(np.frombuffer(raw, np.uint8).reshape(item, n).T.copy().view(f"{chr(kind)}{item}").reshape(n) if n
                   else np.empty(0, f"{chr(kind)}{item}"))
        at += 32 + size
    return out
