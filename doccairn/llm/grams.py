"""Hashed n-grams of code points, shared by the text classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers, one per place of an n-gram, and the finalizer's.
PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)
FINISH = np.uint32(0x2C1B3C6D)
#: Code points handled at once, so that a text of any length takes bounded memory.
PIECE = 1 << 16


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def hashed(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket in ``[0, 2**bits)`` of every n-gram of ``order`` symbols; empty if too short."""
    count = len(codes) - order + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint32)
    mixed = codes[:count] * PLACES[0] + np.uint32(order)
    for place in range(1, order):
        mixed = mixed + codes[place : place + count] * PLACES[place]
        mixed ^= mixed >> np.uint32(15)
    mixed *= FINISH
    mixed ^= mixed >> np.uint32(16)
    return mixed & np.uint32((1 << bits) - 1)


def pieces(codes: np.ndarray, order: int, bits: int) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a whole text, in runs of bounded size."""
    for start in range(0, max(len(codes) - order + 1, 0), PIECE):
        yield hashed(codes[start : start + PIECE + order - 1], order, bits)
