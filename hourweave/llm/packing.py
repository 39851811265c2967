"""Best-fit packing after a dominance reduction.

Whether sequences can be filled depends on lengths alone, so the instance is the histogram of piece lengths: at
most as many numbers as a sequence has tokens, however many documents there are.

1. Documents are encoded once; only documents longer than a sequence are cut.  Each piece is written with its
   task and its rank among the task's pieces of the same length.
2. The histogram is reduced by dominance: for a length, a set of up to three pieces is fixed for good if, by an
   exchange argument, no other choice of companions can lead to fewer sequences.  What remains is packed by
   best fit, longest first.  Both work on counts, many equal pieces at a time, and give patterns with repeats.
3. Pieces find their place by length and rank: ranks within tasks plus a running count over tasks, then a search
   in the pattern table.  No task sees all pieces of a length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows_below, store, table, texts
from .encoding import encoder

CAPACITY = 4096
TEXT_AT_ONCE = 1 << 19
Pattern = list[tuple[int, int]]  # (length, how many) in the order they lie in the sequence


def reduce(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Fix dominating sets and take them out of ``counts``: (sequences, pattern) of each.

    For a piece of length w with room r = capacity - w, over the pieces still there:

    * nothing fits: the piece goes alone;
    * k, the largest that fits, fills the room, or no two or more pieces sum to more than k within the room:
      any other companions of w could change places with k, so {w, k} is fixed;
    * at most two pieces fit beside w, and with a = the largest that fits and b = the largest beside a, no
      pair within the room has both above b: every pair is at most (a, b) piece by piece, so {w, a, b} is fixed.
    """
    fixed: list[tuple[int, Pattern]] = []
    here = sorted(n for n, c in counts.items() if c)

    def take(copies: int, pattern: list[int]) -> None:
        tally: dict[int, int] = defaultdict(int)
        for n in pattern:
            tally[n] += 1
        fixed.append((copies, sorted(tally.items(), reverse=True)))
        for n, k in tally.items():
            counts[n] -= k * copies
            if not counts[n]:
                del here[bisect_left(here, n)]

    def spare(n: int, used: list[int]) -> int:
        return counts[n] - used.count(n)

    def largest(room: int, used: list[int]) -> int | None:
        i = bisect_left(here, room + 1) - 1
        while i >= 0 and not spare(here[i], used):
            i -= 1
        return here[i] if i >= 0 else None

    def smallest(k: int, above: int, used: list[int]) -> list[int]:
        """The k least pieces longer than ``above`` (fewer if there are fewer)."""
        out: list[int] = []
        i = bisect_left(here, above + 1)
        while i < len(here) and len(out) < k:
            out += [here[i]] * min(k - len(out), max(0, spare(here[i], used)))
            i += 1
        return out

    def sums_between(low: int, room: int, used: list[int]) -> bool:
        """Could pieces (each any number of times) sum to more than low, within room?"""
        mask = (1 << (room + 1)) - 1
        reach = 1
        for n in here:
            if n > room:
                break
            if not spare(n, used):
                continue
            step = n
            while step <= room:
                reach |= reach << step & mask
                step *= 2
            if reach >> (low + 1):
                return True
        return False

    def copies(pattern: list[int]) -> int:
        return min(counts[n] // pattern.count(n) for n in set(pattern))

    for w in sorted(here, reverse=True):
        while counts[w]:
            room, used = capacity - w, [w]
            k = largest(room, used)
            if k is None:
                take(counts[w], [w])
                continue
            least = smallest(3, 0, used)
            if k == room or sum(least[:2]) > room or len(least) < 2 or not sums_between(k, room, used):
                take(copies([w, k]), [w, k])
                continue
            if len(least) < 3 or sum(least) > room:
                b = largest(room - k, [w, k])
                above = smallest(2, b, used) if b is not None else []
                if b is not None and (len(above) < 2 or sum(above) > room):
                    take(copies([w, k, b]), [w, k, b])
                    continue
            break
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Best fit, longest first, for equal pieces together: (sequences, pattern)."""
    open_: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # room left: (sequences, pieces as a linked list)
    rooms: list[int] = []  # the rooms in open_, ascending

    def put(room: int, copies: int, pieces: tuple) -> None:
        if room not in open_ or not open_[room]:
            i = bisect_left(rooms, room)
            if i == len(rooms) or rooms[i] != room:
                rooms.insert(i, room)
        open_[room].append((copies, pieces))

    for w in sorted((n for n, c in counts.items() if c), reverse=True):
        left = counts[w]
        while left:
            i = bisect_left(rooms, w)
            if i == len(rooms):
                each = capacity // w
                whole, rest = divmod(left, each)
                if whole:
                    put(capacity - each * w, whole, ((w, each), None))
                if rest:
                    put(capacity - rest * w, 1, ((w, rest), None))
                break
            room = rooms[i]
            copies, pieces = open_[room].pop()
            if not open_[room]:
                del rooms[i]
            if copies > left:
                put(room, copies - left, pieces)
                copies = left
            left -= copies
            put(room - w, copies, ((w, 1), pieces))
    out = []
    for room in rooms:
        for copies, pieces in open_[room]:
            tally: dict[int, int] = defaultdict(int)
            while pieces:
                (n, k), pieces = pieces
                tally[n] += k
            out.append((copies, sorted(tally.items(), reverse=True)))
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Pattern]]:
    counts = {n: c for n, c in counts.items() if c}
    return reduce(counts, capacity) + best_fit(counts, capacity)


def slots(patterns: list[tuple[int, Pattern]]) -> dict[int, np.ndarray]:
    """Per length, in rank order: rows (first rank, first sequence, pieces a sequence, offset of the first)."""
    rows, seen, sequence = defaultdict(list), defaultdict(int), 0
    for copies, pattern in patterns:
        offset = 0
        for n, k in pattern:
            rows[n].append((seen[n], sequence, k, offset))
            seen[n] += copies * k
            offset += n * k
        sequence += copies
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def place(table_: dict[int, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank among the pieces of that length."""
    sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    order = np.argsort(length, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
        if not len(part):
            continue
        n = int(length[part[0]])
        row = table_[n][np.searchsorted(table_[n][:, 0], rank[part], "right") - 1]
        step = rank[part] - row[:, 0]
        sequence[part] = row[:, 1] + step // row[:, 2]
        offset[part] = row[:, 3] + step % row[:, 2] * n
    return sequence, offset


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank): every document encoded and, if longer than a
    sequence, cut; ``part`` and ``rank`` number the pieces of a length.  ``keep_ids`` adds ``ids``."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part, seen = encoder(path, words=True), TaskContext.get().partitionId(), defaultdict(int)
        for frame in rows_below(frames, "text", TEXT_AT_ONCE):
            out = []
            for doc_id, raw in zip(frame["doc_id"].astype("Int64"), enc.encode(frame["text"].tolist()), strict=True):
                raw += end
                for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                    ids = raw[a:a + 4 * capacity]
                    n = len(ids) // 4
                    out.append((doc_id, k, a // 4, n, zlib.crc32(ids), part, seen[n], *([ids] * keep_ids)))
                    seen[n] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", *(["ids"] * keep_ids)]
            frame = pd.DataFrame(out, columns=names)
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    return store(texts(docs).mapInPandas(cut, kinds + ", ids binary" * keep_ids), "pieces")


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Sequences are numbered from 0 and filled without gaps.  Edge cases: a null or empty text is the end id
    alone; documents without an id, and rows that repeat one, are packed like any others; pieces of equal length
    take their places in the order of the written tasks; an empty table packs nothing.
    """
    found = pieces(docs, path, end_id, capacity, keep_ids)
    tasks = store(found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity
    where = docs.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))  # bounded by capacity, not by rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = tasks.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = place(where.value, length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    at = found.join(first, ["part", "length"]).withColumn("__at", find(F.col("length"), F.col("rank") + F.col("first")))
    return at.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] * keep_ids), "__at.*")


def _vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), _vocabulary())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the places of all pieces of the documents."""
    return pack(docs, _vocabulary())
