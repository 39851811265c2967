"""Phrase collocations by set-oriented mining (SETM): occurrence relations are joined with themselves.

The relation of length k has a row (place, phrase) for each occurrence of a frequent phrase of k words, sorted
by place; places of neighbouring words within a piece follow each other, and pieces leave gaps.  A round
merge-joins the relation with itself at adjacent places: the occurrence at p and the one at p + 1 overlap in
k - 1 words and make one of k + 1 words, named by the pair of both phrases.  Pairs are counted per block,
summed by Spark, and a semi-join with the frequent pairs keeps the occurrences that the next round extends.

The relations are written in blocks of at most BLOCK places, as arrays, in tables bucketed by block, so a round
doesn't shuffle them.  A block also holds the next words after its end, which it joins but doesn't count, so
phrases across two blocks are found and counted once.  A block's distinct pairs go to the hash shards they
belong to, as one row of arrays a shard; a shard sums what all blocks send and replies to each block which pairs
are frequent.  A pair comes once from a block at most, however often it stands there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix64, store, store_bucketed, table

LEAST = 100
LONGEST = 5
TOP = 2000
#: places of a block, and about the most entries of a shard
BLOCK = 1 << 20
#: bytes of text of one bucket of blocks
BUCKET_BYTES = 1 << 24
#: bytes of text that are cut into words at once
SLICE = 1 << 22
#: words that a task remembers before it starts a new list
WORDS = 1 << 20
SALTS = 64
NO_LANG = "und"

#: what each byte becomes: piece separators ``.,;:!?`` and \n to \r a full stop, a tab a blank, A-Z lower case
_BYTES = bytes(0x2E if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c
               for c in range(256))


def word_slices(text: str, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, and b"." wherever a piece may end; a list for each ``size`` bytes or so."""
    data = text.encode().translate(_BYTES)
    a = 0
    while a < len(data):
        b = data.find(b" ", a + size)  # a cut at a blank splits no word
        b = len(data) if b < 0 else b
        yield data[a:b].replace(b".", b" . ").split()  # blanks are the only white space left
        a = b


class _Names(dict):
    """Numbers of one lang's words; ``order`` lists the words of all langs."""

    def __init__(self, lang: str, order: list):
        super().__init__({b".": -1})
        self.lang, self.order = lang, order

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.order)
        self.order.append((self.lang, word))
        return number


def _blocks(frames: Iterator[pd.DataFrame], size: int, tail: int) -> Iterator[tuple[np.ndarray, int, list]]:
    """(numbers of the words at each place, -1 at a piece's end; places owned; names by number) of each block."""
    names, order, parts, held = {}, [], [], 0

    def cut() -> tuple[np.ndarray, int, list]:
        nonlocal names, order, parts, held
        codes = np.concatenate(parts)
        out = codes[:size + tail], min(size, len(codes)), order
        rest = codes[size:].copy()
        if len(order) > WORDS:  # the rest gets a list of its own
            kept, new = np.unique(rest[rest >= 0], return_inverse=True)
            names, order = {}, []
            for i in kept.tolist():
                lang, word = out[2][i]
                names.setdefault(lang, _Names(lang, order))[word]
            rest[rest >= 0] = new
        parts, held = [rest], len(rest)
        return out

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            for words in word_slices(text):
                own = names.setdefault(lang, _Names(lang, order))
                parts.append(np.fromiter(map(own.__getitem__, words), np.int32, len(words)))
                held += len(words)
                while held >= size + tail:
                    yield cut()
            parts.append(np.array([-1], np.int32))
            held += 1
    while held:
        yield cut()


def _packed(x: np.ndarray) -> bytes:
    """The bytes of whole numbers, first all lowest bytes, and so on: most of the others are alike."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unpacked(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _packed_pairs(l: np.ndarray, r: np.ndarray) -> dict:
    """Pairs sorted by l, then r, as steps: of l, and of r from one pair with the same l to the next."""
    same = np.r_[False, l[1:] == l[:-1]]
    return {"l": _packed(np.diff(l, prepend=0)), "r": _packed(np.where(same, np.diff(r, prepend=0), r))}


def _unpacked_pairs(l: bytes, r: bytes) -> tuple[np.ndarray, np.ndarray]:
    l, r = _unpacked(l, np.int64), _unpacked(r, np.int64)
    start = np.flatnonzero(np.r_[True, l[1:] != 0])
    total = np.cumsum(r)
    before = total[start] - r[start]  # what came before each run of equal l
    return np.cumsum(l), total - np.repeat(before, np.diff(np.r_[start, len(l)]))


def _relation(block: int, owned: int, place: np.ndarray, code: np.ndarray) -> dict:
    steps = np.diff(place, prepend=0).astype(np.int32)
    return {"block": block, "owned": owned, "places": int((place < owned).sum()), "place": _packed(steps),
            "code": _packed(code.astype(np.int32))}


#: rows of a block: its relation (place, code), or what it sends to a shard: the entries' numbers from ``first`` on,
#: how often the block owns each, and the words, or both parts of the pairs
_SENT = ("block long, owned long, places long, place binary, code binary, shard long, first long, n binary, words binary, "
         "l binary, r binary")
#: rows of a shard: a frequent phrase (id, a), a lang's words (lang, a), or its reply to a block (codes, ids)
_SHARD = "kind string, id long, lang string, phrase string, l long, r long, a long, block long, codes binary, ids binary"


def _filled(rows: list[dict], schema: str) -> pd.DataFrame:
    """A frame with all columns of the schema: what a row leaves out is null."""
    kinds = dict(x.split() for x in schema.split(", "))
    out = pd.DataFrame(rows, columns=list(kinds), dtype=object)
    return out.astype({c: "Int64" for c, k in kinds.items() if k == "long"})


def _shares(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers in a sorted array."""
    if not len(shard):
        return
    start = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    for a, b in zip(start, [*start[1:], len(shard)], strict=True):
        yield int(shard[a]), slice(int(a), int(b))


def _occurrences(docs: DataFrame, size: int, longest: int, shards: int, buckets: int) -> DataFrame:
    """The blocks of the relation of single words, and their distinct words for the shards."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = TaskContext.get().partitionId() << 32
        for i, (codes, owned, names) in enumerate(_blocks(frames, size, longest - 1)):
            place = np.flatnonzero(codes >= 0)
            codes = codes[place]
            kept = np.flatnonzero(np.bincount(codes, minlength=1))
            words = [names[k][1] + b"." + quote(names[k][0]).encode() for k in kept.tolist()]  # a word has no full stop
            shard = np.array([zlib.crc32(w) for w in words], np.int64) % shards
            by_shard = np.argsort(shard, kind="stable")
            number = np.zeros(len(names) + 1, np.int64)
            number[kept[by_shard]] = np.arange(len(kept))
            codes = number[codes]
            n = np.bincount(codes[place < owned], minlength=len(kept)).astype(np.int32)
            rows = [_relation(start + i, owned, place, codes)]
            for k, own in _shares(shard[by_shard]):
                rows.append({"block": start + i, "shard": k, "first": own.start, "n": _packed(n[own]),
                             "words": b"\n".join(words[j] for j in by_shard[own].tolist())})
            yield _filled(rows, _SENT)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return store_bucketed(rows.mapInPandas(read, _SENT), "phrase_words", "block", buckets)


def _replies(frame: pd.DataFrame, entry: np.ndarray, ids: np.ndarray, size: np.ndarray) -> Iterator[dict]:
    """To each block its frequent entries: ``entry`` numbers the shard's phrases, ids has -1 for those that are not."""
    found = ids[entry]
    for block, first, a, n in zip(frame["block"], frame["first"], np.cumsum(size) - size, size, strict=True):
        own = np.flatnonzero(found[a:a + n] >= 0)
        if len(own):
            yield {"kind": "reply", "block": block, "codes": _packed((own + int(first)).astype(np.int32)),
                   "ids": _packed(found[a:a + n][own])}


def _frequent(entry: np.ndarray, n: np.ndarray, shard: int, shards: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, ids) of a shard's phrases; the id of a phrase that is not frequent is -1.

    Ids of all shards interleave, so they are about as small as there are frequent phrases."""
    sums = np.zeros(int(entry.max(initial=-1)) + 1, np.int64)
    np.add.at(sums, entry, n)
    ids = np.full(len(sums), -1, np.int64)
    ids[sums >= least] = shard + shards * np.arange((sums >= least).sum())
    return sums, ids


def _words_of(least: int, shards: int):
    """A shard of words: sums, the langs' totals, and replies."""
    def summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = [_unpacked(x, np.int32) for x in frame["n"]]
        size = np.array([len(x) for x in n])
        entry, names = pd.factorize(np.array([w for x in frame["words"] for w in x.split(b"\n")], object))
        sums, ids = _frequent(entry, np.concatenate(n), int(key[0]), shards, least)
        rows, totals = [], {}
        for i, name in enumerate(names):
            word, _, lang = name.decode().partition(".")
            lang = unquote(lang)
            totals[lang] = totals.get(lang, 0) + int(sums[i])
            if ids[i] >= 0:
                rows.append({"kind": "phrase", "id": ids[i], "lang": lang, "phrase": word, "a": sums[i]})
        rows += [{"kind": "total", "lang": lang, "a": a} for lang, a in totals.items()]
        return _filled([*rows, *_replies(frame, entry, ids, size)], _SHARD)

    return summed


def _pairs_of(least: int, shards: int):
    """A shard of pairs: sums and replies."""
    def summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = [_unpacked(x, np.int32) for x in frame["n"]]
        size = np.array([len(x) for x in n])
        l, r = map(np.concatenate, zip(*map(_unpacked_pairs, frame["l"], frame["r"]), strict=True))
        order = np.lexsort((r, l))
        new = np.r_[True, (l[order][1:] != l[order][:-1]) | (r[order][1:] != r[order][:-1])]
        entry = np.empty(len(l), np.int64)
        entry[order] = np.cumsum(new) - 1
        sums, ids = _frequent(entry, np.concatenate(n), int(key[0]), shards, least)
        kept = np.flatnonzero(ids >= 0)
        where = order[new][kept]
        rows = [{"kind": "phrase", "id": i, "l": x, "r": y, "a": a}
                for i, x, y, a in zip(ids[kept], l[where], r[where], sums[kept], strict=True)]
        return _filled([*rows, *_replies(frame, entry, ids, size)], _SHARD)

    return summed


def _extended(relation: DataFrame, replies: DataFrame, shards: int, k: int, buckets: int) -> DataFrame:
    """One round: semi-join of the relation of length k with its frequent phrases, then the merge-join at adjacent
    places.  Gives the relation of length k + 1 and its pairs for the shards."""
    def join(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _filled([], _SENT)
        place = np.cumsum(_unpacked(left["place"][0], np.int32), dtype=np.int64)
        code = _unpacked(left["code"][0], np.int32)
        owned = int(left["owned"][0])
        codes = np.concatenate([_unpacked(x, np.int32) for x in right["codes"]])
        ids = np.concatenate([_unpacked(x, np.int64) for x in right["ids"]])
        number = np.full(max(int(code.max(initial=0)), int(codes.max(initial=0))) + 1, -1, np.int64)
        number[codes] = np.arange(len(ids))
        phrase = number[code]
        place, phrase = place[phrase >= 0], phrase[phrase >= 0]
        next_to = np.flatnonzero(place[1:] == place[:-1] + 1)
        pair, code = np.unique(phrase[next_to] * len(ids) + phrase[next_to + 1], return_inverse=True)
        place = place[next_to]
        l, r = ids[pair // len(ids)], ids[pair % len(ids)]
        shard = (mix64(mix64(l.view(np.uint64)) + r.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        by_shard = np.lexsort((r, l, shard))
        rank = np.empty(len(pair), np.int64)
        rank[by_shard] = np.arange(len(pair))
        code, l, r = rank[code], l[by_shard], r[by_shard]
        n = np.bincount(code[place < owned], minlength=len(pair)).astype(np.int32)
        rows = [_relation(key[0], owned, place, code)]
        for s, own in _shares(shard[by_shard]):
            rows.append({"block": key[0], "shard": s, "first": own.start, "n": _packed(n[own]),
                         **_packed_pairs(l[own], r[own])})
        return _filled(rows, _SENT)

    other = replies.select(F.col("block").alias("home"), "codes", "ids")
    joined = relation.groupBy("block").cogroup(other.groupBy("home")).applyInPandas(join, _SENT)
    return store_bucketed(joined, f"phrase_pairs_{k + 1}", "block", buckets)


def _lowest_cut(pre: str, suf: str) -> Column:
    """(score, k, l, r) of the cut with the lowest score, then the least k.

    Numbers are decimals of 38 digits: exact for counts below 10**17.
    """
    def big(x):
        return x.cast("decimal(38,0)")

    def cut(l, k):
        r = F.element_at(F.col(suf), F.size(suf) - k)
        top = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)")
        score = F.call_function("div", big(top * F.col("n").cast("decimal(17,0)")),
                                big(l.cast("decimal(19,0)") * r.cast("decimal(19,0)")))
        return F.struct(score.alias("score"), (k + 1).alias("k"), l.alias("l"), r.alias("r"))

    return F.array_min(F.transform(F.col(pre), cut))


def _first(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each lang: first among some of its rows, then among what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for by in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
            F.col("rank") <= top)
    return found.withColumn("rank", F.col("rank").cast("long"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = 100,
                 block: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each lang's first ``top`` collocations.

    A candidate is a phrase of 2 to ``longest`` words within a piece that occurs a >= ``least`` times in its
    lang's texts.  n counts the lang's words, l and r the occurrences of the first and the second part at the
    cut with the lowest score floor(1000 * a * n / (l * r)).  A candidate within a longer one that occurs at
    least ``percent`` (1 to 100) per cent as often is left out.

    Edge cases: null and empty texts have no words; a null lang is ``und`` (together with texts marked so); rows
    that repeat an id or a text count as often as they stand there; ties go by phrase in UTF-8 byte order; an
    empty table, or one without candidates, gives an empty result; only ``lang`` and ``text`` are read.  A very
    long text is cut into words by slices and spreads over as many blocks as it needs.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent is from 1 to 100")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    number = 1 + size // (6 * block)
    sent = _occurrences(docs, block, longest, number, buckets)
    shards = sent.filter("words IS NOT NULL").select("block", "shard", "first", "n", "words")
    counted = store(shards.groupBy("shard").applyInPandas(_words_of(least, number), _SHARD), "phrase-shards-1")
    total = counted.filter("kind = 'total'").groupBy("lang").agg(F.sum("a").alias("n"))
    none = F.array().cast("array<long>")
    phrases = store(counted.filter("kind = 'phrase'").select(
        "id", "lang", "phrase", F.col("phrase").alias("last"), "a", none.alias("pre"), none.alias("suf")), "phrases-1")
    found = []
    for k in range(1, longest):
        relation = sent.filter("place IS NOT NULL").select("block", "owned", "places", "place", "code")
        places = relation.agg(F.sum("places")).first()[0] or 0
        number = 1 + places // block
        sent = _extended(relation, counted.filter("kind = 'reply'"), number, k, buckets)
        shards = sent.filter("l IS NOT NULL").select("block", "shard", "first", "n", "l", "r")
        counted = store(shards.groupBy("shard").applyInPandas(_pairs_of(least, number), _SHARD), f"phrase-shards-{k + 1}")
        kept = counted.filter("kind = 'phrase'").select("id", "l", "r", "a")
        left, right = phrases.select("id", "lang", "phrase", "a", "pre").alias("x"), phrases.select("id", "last", "a", "suf").alias("y")
        longer = store(kept.alias("z").join(left, F.col("z.l") == F.col("x.id")).join(right, F.col("z.r") == F.col("y.id")).select(
            "z.id", "z.l", "z.r", "x.lang", F.concat_ws(" ", "x.phrase", "y.last").alias("phrase"), "y.last", "z.a",
            F.concat("x.pre", F.array("x.a")).alias("pre"), F.concat("y.suf", F.array("y.a")).alias("suf")), f"phrases-{k + 1}")
        if k > 1:
            found.append(_maximal(phrases, longer, percent))
        phrases = longer
    if longest > 1:
        found.append(phrases.select(*_KEPT))
    everything = found[0] if found else phrases.limit(0).select(*_KEPT)
    for more in found[1:]:
        everything = everything.unionByName(more)
    scored = everything.join(total, "lang").withColumn("cut", _lowest_cut("pre", "suf")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return _first(scored, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_KEPT = ["lang", "phrase", "a", "pre", "suf"]


def _maximal(phrases: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Phrases without a longer one around them that occurs often enough.

    Looking at one word more is enough: between a phrase and a longer one around it stands one with one word
    more than the first, and it occurs at least as often as the longer one.
    """
    around = longer.select(F.explode(F.array("l", "r")).alias("id"), "a").groupBy("id").agg(F.max("a").alias("most"))
    return phrases.join(around, "id", "left").filter(
        F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).select(*_KEPT)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT doc, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
q AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, w[i:i + k - 1] AS ws, k FROM q, range(1, 6) AS g(k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
n AS (SELECT lang, count(*) AS n FROM o WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, ws, k, count(*) AS a FROM o GROUP BY lang, ws, k HAVING count(*) >= 100),
cuts AS (SELECT c.lang, c.ws, c.k, c.a, n.n, x.k AS cut, x.a AS l, y.a AS r,
                (1000::HUGEINT * c.a * n.n) // (x.a::HUGEINT * y.a) AS score
         FROM f c JOIN n USING (lang), f x, f y
         WHERE c.k > 1 AND x.lang = c.lang AND y.lang = c.lang AND x.k < c.k AND y.k = c.k - x.k
           AND x.ws = c.ws[1:x.k] AND y.ws = c.ws[x.k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) = 1),
inner_parts AS (SELECT lang, a, unnest([ws[1:k - 1], ws[2:]]) AS ws FROM f WHERE k > 2),
gone AS (SELECT DISTINCT b.lang, b.ws FROM best b JOIN inner_parts i ON i.lang = b.lang AND i.ws = b.ws AND 100 * i.a >= 100 * b.a),
kept AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM best ANTI JOIN gone USING (lang, ws)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
