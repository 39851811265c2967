"""Personal data: fixed patterns seed a bootstrapped search by context.

1. Each text's base spans (email, ip, card, phone) and its other candidates are found in one pass, each with its
   contexts: the two words before it, and the word before with the word after.  Base spans are the seeds.
   Candidates are the longest runs of tokens with a digit or an @ (a group of up to four capitals or of marks may
   stand between two of them) within a line and between punctuation that ends a clause; the same run with the one
   or two capitals, or the +, beside it; and, within a run, tokens with five digits or more, or an @.
2. A context that surrounds MIN_INSTANCES or more different identifiers, known ones among them, is a pattern.  A
   second pass counts, per batch, how often patterns surround anything else; a bit table of fixed size keeps
   other contexts in the scan.
3. Patterns and instances form a graph that Spark scores in ROUNDS rounds: a pattern is worth the mean score of
   what it surrounds, an instance the chance that one of its patterns is right; seeds stay at 1.
4. Identifiers that end at ACCEPT or more are added, with the kind their patterns say.  They are known from then
   on, at their score, and 2 to 4 are repeated until nothing is added; a pattern's surroundings are counted once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, rows_below, same_id, signed, store, table, texts
from .words import STEP, Words, bit_table, in_bits

KINDS = ("email", "ip", "card", "phone")
MIN_INSTANCES = 3
ROUNDS = 3
ACCEPT = 0.7
#: a pattern below this mean score says nothing about its instances
PATTERN = 0.5
TEXT_AT_ONCE = 1 << 19

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EDGE = ".,;:!?()[]{}\"'*#$%&|<>"
_PAIRS = (("(", ")"), ("[", "]"), ("{", "}"))
_BREAKS = np.frombuffer(b".,;:!?", np.uint8)
_CLOSING = np.frombuffer(b")]}\"'", np.uint8)
_MARKS = np.frombuffer(b"+-/()#_:=.", np.uint8)

#: white space ends a token; A-Z are lower-cased and digits become 0, so that contexts generalise
_TOKEN = np.arange(256, dtype=np.uint8)
_TOKEN[[0, 9, 10, 11, 12, 13, 32]] = 0
_TOKEN[65:91] += 32
_TOKEN[48:58] = 48


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, not overlapping: the longest run of local characters before an @ that a dotted domain follows."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches that pass their checks, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _join(a: np.ndarray, b: np.ndarray, form: int) -> np.ndarray:
    return mix64(mix64(a + np.uint64(form)) * STEP + b) | np.uint64(1)


@dataclass
class Candidates:
    """Token ranges first..last; ``start``: whether no other candidate that counts starts at the same token;
    ``plain``: tokens that neither belong to a candidate nor touch a base span."""

    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    plain: np.ndarray


def _candidates(w: Words, texts_: list[str], touched: np.ndarray) -> Candidates:
    n = len(w.start)
    if not n:
        none = np.zeros(0, np.int64)
        return Candidates(none, none, none.astype(bool), none.astype(bool))
    raw = np.frombuffer("\n".join(texts_).encode() + b"\n", np.uint8)

    def upto(mask: np.ndarray) -> np.ndarray:
        return np.cumsum(np.r_[0, mask])

    def count(mask: np.ndarray) -> np.ndarray:
        c = upto(mask)
        return c[w.stop] - c[w.start]

    length, digits, ats = w.stop - w.start, count((raw >= 48) & (raw <= 57)), count(raw == 64)
    capital = count((raw >= 65) & (raw <= 90)) == length
    mark = count(np.isin(raw, _MARKS)) == length
    core = (digits + ats > 0) & ~touched
    joins = ~core & ~touched & ((capital & (length <= 4)) | mark)
    edge = joins & ((capital & (length <= 2)) | ((raw[w.start] == 43) & (length == 1)))
    stops = np.isin(raw[w.stop - 1], _BREAKS) | (np.isin(raw[w.stop - 1], _CLOSING) & np.isin(raw[w.stop - 2], _BREAKS))
    line = upto((raw == 10) | (raw == 13))
    link = np.r_[False, (w.text[1:] == w.text[:-1]) & (line[w.start[1:]] == line[w.stop[:-1]]) & (mark | ~stops)[:-1], False]
    before, after = link[:-1], link[1:]  # to the token before, to the one after

    def shifted(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return before & np.r_[False, mask[:-1]], after & np.r_[mask[1:], False]

    left, right = shifted(core)
    member = core | (joins & left & right)
    left, right = shifted(member)
    first, last = np.flatnonzero(member & ~left), np.flatnonzero(member & ~right)
    more_left, more_right = shifted(edge)
    more_left, more_right = more_left[first], more_right[last]
    wide = more_left | more_right
    plain = ~member & ~touched
    plain[first[more_left] - 1] = False
    plain[last[more_right] + 1] = False
    run = np.cumsum(member & ~left) - 1
    part = np.flatnonzero(core & (digits + 5 * ats >= 5))
    part = part[first[run[part]] < last[run[part]]]
    return Candidates(np.r_[first, (first - more_left)[wide], part], np.r_[last, (last + more_right)[wide], part],
                      np.r_[np.ones(len(first), bool), more_left[wide], first[run[part]] < part], plain)


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without the marks around, except brackets whose partner is inside."""
    token = text[a:b]
    start, end = a + len(token) - len(token.lstrip(_EDGE)), b - (len(token) - len(token.rstrip(_EDGE)))
    for left, right in _PAIRS if start < end else ():
        inside = text[start:end].count(left) - text[start:end].count(right)
        if inside < 0 and start > a and text[start - 1] == left:
            start -= 1
        elif inside > 0 and end < b and text[end] == right:
            end += 1
    return start, end


def _contexts(w: Words, first: np.ndarray, last: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the two forms of context of targets that span tokens first..last of their text; 0: none."""
    n = len(w.hash)
    out = []
    for i, j, form in ((first - 2, first - 1, 1), (first - 1, last + 1, 2)):
        whole = (i >= 0) & (j < n)
        i, j = np.clip(i, 0, n - 1), np.clip(j, 0, n - 1)
        whole &= (w.text[i] == owner) & (w.text[j] == owner)
        out.append(np.where(whole, _join(w.hash[i], w.hash[j], form), np.uint64(0)))
    return out[0], out[1]


def _offsets(text: str) -> np.ndarray:
    """Byte offset of every code point, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.r_[0, np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))]


def _touched(w: Words, texts_: list[str], bases: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Tokens that touch a base span."""
    out, byte = np.zeros(len(w.start), bool), 0
    for text, spans, first, n in zip(texts_, bases, w.first, w.count, strict=True):
        if n and spans:
            at, own = _offsets(text), slice(first, first + n)
            for a, _, b in spans:
                out[own] |= (w.stop[own] > at[a] + byte) & (w.start[own] < at[b] + byte)
        byte += len(text.encode()) + 1
    return out


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, key (hash of the text), base spans, and all identifiers with their contexts.

    ``found`` are (start, end, kind or null, instance, contexts).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_below(frames, "text", TEXT_AT_ONCE):
            base, found = [[] for _ in range(len(frame))], [[] for _ in range(len(frame))]
            some = [i for i, t in enumerate(frame["text"]) if re.search(r"[0-9@]", t)]
            own_texts = [frame["text"].iloc[i] for i in some]
            bases = [base_spans(t) for t in own_texts]
            w = Words(own_texts, _TOKEN)
            c = _candidates(w, own_texts, _touched(w, own_texts, bases))
            order = np.argsort(w.text[c.first], kind="stable")
            cuts = np.searchsorted(w.text[c.first][order], np.arange(len(some) + 1))
            ends = np.cumsum(w.count)
            byte = 0
            for k, (i, text, spans) in enumerate(zip(some, own_texts, bases, strict=True)):
                base[i] = [{"start": a, "kind": kind, "end": b} for a, kind, b in spans]
                own = np.arange(w.first[k], ends[k])
                at = _offsets(text)
                targets = [(a, b, KINDS[kind], True) for a, kind, b in spans]
                start = np.array([at[a] for a, _, _ in spans], np.int64) + byte
                stop = np.array([at[b] for _, _, b in spans], np.int64) + byte
                one = own[:1].sum() + np.searchsorted(w.stop[own], start, "right")
                two = own[:1].sum() + np.searchsorted(w.start[own], stop, "left") - 1
                mine = order[cuts[k]:cuts[k + 1]]
                bounds = [_trimmed(text, a, b) for a, b in zip(np.searchsorted(at, w.start[c.first[mine]] - byte).tolist(),
                                                              np.searchsorted(at, w.stop[c.last[mine]] - byte).tolist(), strict=True)]
                kept = np.array([a < b for a, b in bounds], bool)
                targets += [(a, b, None, bool(x)) for (a, b), x in zip(bounds, c.start[mine], strict=True) if a < b]
                if targets and len(own):
                    c1, c2 = _contexts(w, np.r_[one, c.first[mine][kept]], np.r_[two, c.last[mine][kept]], np.full(len(targets), k))
                    found[i] = [{"start": a, "end": b, "kind": kind,
                                 "instance": xxhash.xxh64_intdigest(text[a:b].encode()) - (1 << 63),
                                 "contexts": [{"pattern": h, "counts": x} for h, x in
                                              zip(signed(np.array([p, q], np.uint64)).tolist(), (new, True), strict=True) if h]}
                                for (a, b, kind, new), p, q in zip(targets, c1, c2, strict=True)]
                byte += len(text.encode()) + 1
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "base": base, "found": found,
                                "key": [xxhash.xxh64_intdigest(t.encode()) - (1 << 63) for t in frame["text"]]})

    return store(texts(docs).mapInPandas(
        run, "doc_id long, key long, base array<struct<start: int, kind: int, end: int>>, "
             "found array<struct<start: int, end: int, kind: string, instance: long, "
             "contexts: array<struct<pattern: long, counts: boolean>>>>"), "pii-found")


def _surroundings(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, others): how often a pattern surrounds a token that belongs to no candidate."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(patterns.select(F.col("pattern").alias("shingle"))))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_below(frames, "text", TEXT_AT_ONCE):
            own = frame["text"].tolist()
            w = Words(own, _TOKEN)
            touched = _touched(w, own, [base_spans(t) if re.search(r"[0-9@]", t) else [] for t in own])
            plain = np.flatnonzero(_candidates(w, own, touched).plain)
            for c in _contexts(w, plain, plain, w.text[plain]) if len(plain) else ():
                hit, n = np.unique(c[in_bits(bits.value, c)], return_counts=True)
                yield pd.DataFrame({"pattern": signed(hit), "others": n})

    return texts(docs).select("text").mapInPandas(count, "pattern long, others long").groupBy("pattern").agg(
        F.sum("others").alias("others"))


def bootstrap(docs: DataFrame, found: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT) -> tuple[DataFrame, DataFrame]:
    """(instance, kind, score) of the identifiers accepted beside the seeds, and (pattern, kind, score).

    Each generation derives patterns from the seeds and all identifiers accepted so far and scores the graph in
    ``rounds`` rounds; the search ends when a generation accepts nothing new.
    """
    edges = (found.select(F.explode("found").alias("f")).select("f.kind", "f.instance", F.explode("f.contexts").alias("c"))
             .groupBy("c.pattern", "instance").agg(F.min("kind").alias("kind"), F.max("c.counts").alias("counts")))
    edges = store(edges, "pii-edges")
    size = edges.filter("counts").groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).filter(F.col("instances") >= MIN_INSTANCES)
    seeds = edges.filter("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("named")).withColumn("known", F.lit(1.0))
    seen = taken = None
    while True:
        known = seeds if taken is None else seeds.unionByName(taken.select("instance", F.col("kind").alias("named"), F.col("score").alias("known")))
        own = edges.join(known, "instance").groupBy("pattern", "named").agg(F.count(F.lit(1)).alias("n"))
        said = own.groupBy("pattern").agg(F.max_by("named", F.struct("n", "named")).alias("says"))
        patterns = store(size.join(said, "pattern"), "pii-patterns")
        fresh = patterns if seen is None else patterns.join(seen, "pattern", "left_anti")
        others = fresh.select("pattern").join(_surroundings(docs, fresh), "pattern", "left").fillna(0, ["others"])
        seen = store(others if seen is None else seen.unionByName(others), "pii-others")
        patterns = store(patterns.join(seen, "pattern"), "pii-patterns")
        graph = store(edges.join(patterns.select("pattern", "says"), "pattern").join(known, "instance", "left"), "pii-graph")
        scores = graph.groupBy("instance").agg(F.max("known").alias("known"))
        scores = scores.select("instance", "known", F.coalesce("known", F.lit(0.0)).alias("score"))
        for _ in range(rounds):
            worth = (graph.filter("counts").select("instance", "pattern").join(scores, "instance")
                     .groupBy("pattern").agg(F.sum("score").alias("sum")).join(patterns, "pattern")
                     .select("pattern", "says", (F.col("sum") / (F.col("instances") + F.col("others"))).alias("worth")))
            worth = store(worth, "pii-worth")
            miss = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("worth"))))
            right = (graph.join(worth.filter(F.col("worth") >= PATTERN).select("pattern", "worth"), "pattern")
                     .groupBy("instance").agg((1 - F.exp(miss)).alias("found")))
            scores = store(scores.join(right, "instance", "left").select(
                "instance", "known", F.coalesce("known", "found", F.lit(0.0)).alias("score")), "pii-scores")
        more = scores.filter(F.col("known").isNull() & (F.col("score") >= accept)).select("instance", "score")
        more = (graph.select("instance", "pattern", "says").join(more, "instance").join(worth.select("pattern", "worth"), "pattern")
                .groupBy("instance", "says", "score").agg(F.sum("worth").alias("w"))
                .groupBy("instance", "score").agg(F.max_by("says", F.struct("w", "says")).alias("kind")))
        more = store(more, "pii-accepted")
        done = more.isEmpty()
        if taken is None or not done:
            taken = more if taken is None else store(taken.unionByName(more), "pii-accepted")
        if done:
            return taken, worth.withColumnRenamed("says", "kind")


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every document: arrays of (start, kind index, end) in code points, sorted.

    Base matches that fail their checks are dropped without another try.  Edge cases: null and empty texts
    have no spans; rows that repeat an id or a text each get a row; a span that the method adds never overlaps
    a base span; without seeds, or in an empty table, nothing is added.
    """
    found = find(docs)
    taken, _ = bootstrap(docs, found)
    order = F.array([F.lit(k) for k in KINDS])
    span = F.struct((F.col("start") - F.col("end")).alias("length"), (-F.col("score")).alias("score"), "start",
                    (F.array_position(order, F.col("kind")) - 1).cast("int").alias("kind"), "end")
    spans = "array<struct<start: int, kind: int, end: int>>"

    def longest(kept, x):  # of candidates that overlap, the longest, then the one of the best score
        free = ~F.exists(kept, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"]))
        own = F.array(F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).cast(spans)
        return F.when(free, F.concat(kept, own)).otherwise(kept)

    hits = (found.select("doc_id", "key", F.explode("found").alias("f")).filter("f.kind IS NULL")
            .select("doc_id", "key", "f.start", "f.end", "f.instance").join(taken, "instance")
            .groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.array_sort(F.collect_set(span)).alias("all"))
            .select("__id", "__key", F.aggregate("all", F.array().cast(spans), longest).alias("added")))
    joined = found.join(hits, same_id(found["doc_id"], F.col("__id")) & (F.col("key") == F.col("__key")), "left")
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce(
        "added", F.array().cast(spans)))).alias("spans"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array([F.lit(k) for k in KINDS])

    def text(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id", *[count(kind) for kind in range(len(KINDS))],
        F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))
