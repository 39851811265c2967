"""Words of whole batches of texts as arrays, and bit tables of fixed size for their hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64

FILTER_BITS = 1 << 23

#: word bytes stay (A-Z lower-cased), others become 0; every byte of a non-ASCII character is a word byte
_WORD = np.zeros(256, np.uint8)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _WORD[_c] = _c
for _c in range(0x41, 0x5B):
    _WORD[_c] = _c + 32
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


class Words:
    """The words of a batch of texts: their bytes, bounds, hashes and the text each belongs to.

    ``table`` says what each byte becomes; 0 ends a word.
    """

    def __init__(self, texts: list[str], table: np.ndarray = _WORD):
        data = [t.encode() for t in texts]
        self.bytes = table[np.frombuffer(b"\n".join(data) + b"\n", np.uint8)]
        word = self.bytes != 0
        edge = np.flatnonzero(word != np.r_[False, word[:-1]])
        self.start, self.stop = edge[::2], edge[1::2]
        ends = np.cumsum([len(x) + 1 for x in data])
        self.text = np.searchsorted(ends, self.start, "right")
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        if not len(self.start):
            self.hash = np.empty(0, np.uint64)
            return
        length = self.stop - self.start
        powers = np.cumprod(np.full(int(length.max()) + 1, STEP, np.uint64))
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        value = self.bytes[word].astype(np.uint64) * powers[place]
        self.hash = mix64(np.add.reduceat(value, np.cumsum(length) - length))

    def shingles(self, size: int) -> np.ndarray:
        """Hashes of the runs of ``size`` words at each place; 0 where a run would leave its text."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        if n < size:
            return out
        run = np.full(n - size + 1, np.uint64(size))
        for k in range(size):
            run = mix64(run * STEP + self.hash[k:n - size + 1 + k])
        run |= np.uint64(1)  # 0 means none
        inside = self.text[:n - size + 1] == self.text[size - 1:]
        out[:n - size + 1][inside] = run[inside]
        return out

    def word(self, i: int) -> str:
        return self.bytes[self.start[i]:self.stop[i]].tobytes().decode()


def bit_table(shingles: DataFrame) -> np.ndarray:
    """Bit table of the signed hashes in ``shingle``: FILTER_BITS bits, merged by the executors."""
    bit = F.pmod("shingle", F.lit(FILTER_BITS))
    words = (shingles.select((bit / 64).cast("int").alias("word"), F.pmod(bit, F.lit(64)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.collect():  # FILTER_BITS / 64 rows at most
        table[row["word"]] = row["bits"]
    return table.view(np.uint64)


def in_bits(table: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    bit = shingle.view(np.int64) % FILTER_BITS
    return (shingle != 0) & ((table[bit // 64] >> (bit % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)
