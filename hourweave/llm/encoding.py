"""Whole-text encoding with the tokenizers library, each distinct chunk of text encoded once per worker.

Texts are cut only where both supported kinds of vocabulary always end a token, so that the ids of the chunks
are the ids of the text:

* byte-level: before a single space that stands between two characters that are no white space;
* words ("word ends", white space dropped): before every space and line feed;
* both: between an ASCII letter and one of MARKS (a run of letters ends there; no special string is cut).

A place that might be none of these is left alone; the chunk is longer then, and still right.  Chunks are told
apart by 128-bit hashes computed over whole batches; those not seen yet go to the library, the others' ids are
gathered from a bounded store.  Special strings inside texts are treated as the library does by default.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from .common import mix64

#: chunks a worker remembers; when there are more it starts anew, which costs time only
CACHE = 1_500_000
MARKS = ".,!?;:$%&*#\"()"
_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

_MARK, _LETTER, _BLANK, _LEAD = (np.zeros(256, bool) for _ in range(4))
_MARK[list(MARKS.encode())] = True
_LETTER[65:91] = _LETTER[97:123] = True
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # first bytes of the characters that may be white space beyond ASCII


def _with(held: np.ndarray, used: int, values: np.ndarray) -> np.ndarray:
    """``held`` with ``values`` after its first ``used`` places; it grows by doubling."""
    if used + len(values) > len(held):
        held = np.concatenate([held[:used], np.empty(max(used, len(values)) + len(values), held.dtype)])
    held[used:used + len(values)] = values
    return held


class Encoder:
    """``encode(texts)`` gives each text's ids as the bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, words: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.words = words
        for special in self.library.get_added_tokens_decoder().values():
            s = special.content
            if any(c.isspace() for c in s) or any(a.isalpha() and b in MARKS for a, b in zip(s, s[1:])):
                raise ValueError(f"a special string would be cut: {s!r}")
        self._forget()

    def _forget(self) -> None:
        self.key, self.slot = np.empty(0, np.uint64), np.empty(0, np.int32)  # sorted hashes and where their chunks are
        self.chunks = self.ids = 0
        self.check, self.first, self.length = (np.empty(1 << 16, t) for t in (np.uint64, np.int64, np.int32))
        self.pool = np.empty(1 << 18, "<u4")

    def _cuts(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where chunks begin: at every text's start and at the safe places."""
        before = np.r_[np.uint8(0), raw[:-1]]
        cut = _MARK[raw] & _LETTER[before]
        if self.words:
            cut |= (raw == 32) | (raw == 10)
        else:
            after = np.r_[raw[1:], np.uint8(32)]
            two, three = np.r_[np.uint8(0), before[:-1]], np.r_[np.uint8(0), np.uint8(0), before[:-2]][:len(raw)]
            plain = ~_BLANK[before] & ((before < 128) | ~((two == 0xC2) | _LEAD[three]))
            cut |= (raw == 32) & plain & ~_BLANK[after] & ~_LEAD[after]
        cut[starts[starts < len(raw)]] = True
        return np.flatnonzero(cut)

    def _slots(self, raw: np.ndarray, begin: np.ndarray) -> np.ndarray | None:
        """Where in the store each chunk is, after encoding the new ones; None if two chunks' hashes agree."""
        size = np.diff(np.r_[begin, len(raw)])
        place = np.arange(len(raw), dtype=np.int32)
        place -= np.repeat(begin.astype(np.int32), size)
        value, h = raw.astype(np.uint64), []
        for step in _STEPS:
            powers = np.cumprod(np.full(int(size.max()), step, np.uint64))[place]
            powers *= value
            h.append(mix64(mix64(np.add.reduceat(powers, begin)) + size.astype(np.uint64)))
        distinct, one, which = np.unique(h[0], return_index=True, return_inverse=True)
        check = h[1][one]
        if (check[which] != h[1]).any():
            return None
        at = np.searchsorted(self.key, distinct)
        known = at < len(self.key)
        known[known] = self.key[at[known]] == distinct[known]
        slot = np.empty(len(distinct), np.int32)
        slot[known] = self.slot[at[known]]
        if (self.check[slot[known]] != check[known]).any():
            return None
        new = np.flatnonzero(~known)
        if len(new):
            data = raw.tobytes()
            found = [e.ids for e in self.library.encode_batch_fast(
                [data[begin[i]:begin[i] + size[i]].decode() for i in one[new].tolist()], add_special_tokens=False)]
            n = np.fromiter(map(len, found), np.int32, len(found))
            ids = np.fromiter(chain.from_iterable(found), "<u4", int(n.sum()))
            slot[new] = np.arange(self.chunks, self.chunks + len(new))
            for name, values, used in (("check", check[new], self.chunks), ("length", n, self.chunks), ("pool", ids, self.ids),
                                       ("first", self.ids + np.cumsum(n, dtype=np.int64) - n, self.chunks)):
                setattr(self, name, _with(getattr(self, name), used, values))
            self.chunks, self.ids = self.chunks + len(new), self.ids + len(ids)
            self.key, self.slot = np.insert(self.key, at[new], distinct[new]), np.insert(self.slot, at[new], slot[new])
        return slot[which]

    def encode(self, texts: list[str]) -> list[bytes]:
        data = [t.encode() for t in texts]
        raw = np.frombuffer(b"".join(data), np.uint8)
        if not len(raw):
            return [b""] * len(texts)
        if len(self.key) > CACHE:
            self._forget()
        ends = np.cumsum([len(x) for x in data])
        begin = self._cuts(raw, np.r_[0, ends[:-1]])
        slot = self._slots(raw, begin)
        if slot is None:
            return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        n = self.length[slot]
        done = np.cumsum(n, dtype=np.int64)
        ids = self.pool[np.arange(done[-1]) + np.repeat(self.first[slot] - done + n, n)].tobytes()
        stop = 4 * np.r_[0, done][np.searchsorted(begin, ends)]
        return [ids[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]


_OPEN: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, words: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file: opened once, its store lives as long as the worker."""
    if (path, words) not in _OPEN:
        _OPEN[path, words] = Encoder(path, words)
    return _OPEN[path, words]
