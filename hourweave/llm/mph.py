"""Minimal perfect hash of 128-bit keys for one shard: cascaded bit levels with rank.

Each level is a bit array; a key takes the bit it hashes to if no other key of the level wants it, and moves
to the next level otherwise.  A key's slot is the number of set bits before its own.  About three to four
bits a key, constant-time lookup, no keys stored: callers keep a fingerprint per slot.
"""

from __future__ import annotations

import struct

import numpy as np

from .common import mix64

GAMMA = 1.6
MAX_LEVELS = 64


def _at(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(h1 + salt) ^ mix64(h2 ^ salt)) % np.uint64(bits)


def build(h1: np.ndarray, h2: np.ndarray) -> bytes:
    """The function over distinct (h1, h2) pairs of uint64 arrays."""
    out, n = [], len(h1)
    for level in range(MAX_LEVELS):
        if not len(h1):
            break
        bits = -(-max(64, int(GAMMA * len(h1))) // 64) * 64
        at = _at(h1, h2, level, bits)
        single = np.bincount(at.astype(np.int64), minlength=bits) == 1
        out.append(np.packbits(single, bitorder="little").tobytes())
        rest = ~single[at.astype(np.int64)]
        h1, h2 = h1[rest], h2[rest]
    if len(h1):
        raise ValueError("keys of a minimal perfect hash must be distinct")
    return struct.pack("<II", n, len(out)) + b"".join(struct.pack("<I", len(x)) + x for x in out)


class Lookup:
    """Slots of keys; a key outside the set gets -1 or any slot, so compare its fingerprint."""

    def __init__(self, blob: bytes):
        self.n, levels = struct.unpack_from("<II", blob)
        pos, base, self.levels = 8, 0, []
        for _ in range(levels):
            (size,) = struct.unpack_from("<I", blob, pos)
            bits = np.unpackbits(np.frombuffer(blob, np.uint8, size, pos + 4), bitorder="little").astype(bool)
            rank = np.cumsum(bits, dtype=np.int64) - 1 + base
            self.levels.append((bits, rank))
            base = int(rank[-1]) + 1
            pos += 4 + size

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, (bits, rank) in enumerate(self.levels):
            if not len(left):
                break
            at = _at(h1[left], h2[left], level, len(bits)).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out
