"""Seeded permutations of 0 .. n-1 in column arithmetic.

A number below ``n`` is written as a pair (x % a, x // a) with a * b >= n; each round adds a keyed function of one
half to the other half (mod a or mod b), so the rounds together permute the a * b pairs.  Fewer than ``a`` of them
are no numbers below ``n``: a row that lands on one walks on along its cycle.  The longest such walk is computed
from those pairs, so a fixed number of steps serves every row.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
#: halves stay below this prime, so products of two values fit into 63 bits; it allows n up to 4.6e18
PRIME = 2**31 - 1


def round_keys(seed: int, epoch: int = 0) -> list[tuple[int, int]]:
    """(factor, offset) of each round: 28 bits each of the md5 of ``seed/epoch/round/name``, plus one."""
    def key(j: int, name: str) -> int:
        return int(hashlib.md5(f"{seed}/{epoch}/{j}/{name}".encode()).hexdigest()[:7], 16) + 1

    return [(key(j, "factor"), key(j, "offset")) for j in range(ROUNDS)]


def _halves(n: int) -> tuple[int, int]:
    a = isqrt(n - 1) + 1
    return a, -(-n // a)


def _keyed(v, factor: int, offset: int):
    """A number below PRIME from a half; the same arithmetic for columns and arrays."""
    u = (v * factor + offset) % PRIME
    return (u * u % PRIME * u + u) % PRIME


def _once(x: np.ndarray, a: int, b: int, keys: list[tuple[int, int]]) -> np.ndarray:
    low, high = x % a, x // a
    for j, (factor, offset) in enumerate(keys):
        if j % 2:
            high = (high + _keyed(low, factor, offset)) % b
        else:
            low = (low + _keyed(high, factor, offset)) % a
    return low + a * high


def longest_walk(n: int, keys: list[tuple[int, int]]) -> int:
    """Passes after which every number below ``n`` has come back below ``n``."""
    a, b = _halves(n)
    beyond, walk = np.arange(n, a * b, dtype=np.int64), 1
    at = np.setdiff1d(beyond, _once(beyond, a, b, keys))  # entered from below n; the others are later or on cycles of their own
    while len(at):
        at, walk = _once(at, a, b, keys), walk + 1
        at = at[at >= n]
    return walk


def permuted(x: Column, n: int, seed: int, epoch: int = 0) -> Column:
    """Where the permutation of (seed, epoch) sends ``x``, 0 <= x < n; null stays null.

    One expression, a left fold over the rounds: it holds every step once, so filters on the result may be
    pushed through projections without the expression growing with each round.
    """
    if not 0 < n <= PRIME**2:
        raise ValueError("n must be from 1 to the square of PRIME")
    keys = round_keys(seed, epoch)
    a, b = (F.lit(v).cast("long") for v in _halves(n))
    sizes = (a, b)
    rounds = F.array(*[F.struct(F.lit(f).cast("long").alias("f"), F.lit(o).cast("long").alias("o"), sizes[j % 2].alias("size"))
                       for j, (f, o) in enumerate(keys)])

    def turn(pair: Column, key: Column) -> Column:
        """The half in turn moves by a function of the other one; then they change places."""
        u = (pair["other"] * key["f"] + key["o"]) % PRIME
        cubed = F.element_at(F.transform(F.array(u), lambda v: (v * v % PRIME * v + v) % PRIME), 1)
        return F.struct(pair["other"].alias("turn"), ((pair["turn"] + cubed) % key["size"]).alias("other"))

    def once(place: Column) -> Column:
        start = F.struct((place % a).alias("turn"), F.call_function("div", place, a).alias("other"))
        return F.aggregate(rounds, start, turn, lambda pair: pair["turn"] + a * pair["other"])

    place = once(x.cast("long"))
    for _ in range(longest_walk(n, keys) - 1):
        place = F.element_at(F.transform(F.array(place), lambda p: F.when(p < n, p).otherwise(once(p))), 1)
    return place
