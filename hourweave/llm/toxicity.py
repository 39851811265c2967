"""Toxicity: a learnt lexicon in a trie, Levenshtein automata over it, and scores of the context windows.

* The lexicon comes from labelled documents: whole words, and stems where many words share a beginning, that
  toxic documents hold far oftener than clean ones (texts whose words are SAME alike count once).
* Words of a text run through the deterministic automaton of the trie's intersection with the Levenshtein
  automata of its words and the Levenshtein prefix automata of its stems (each entry's own number of edits, by
  its length).  It is built as words ask for it, and most words leave it after a few letters.
* Ordinary words, which clean labelled documents hold as often as chance would have it, are no misspelling of
  a term.
* Every term found is weighed by the window around it: quotation marks and words of reporting speak for
  quotation, address, exclamation and further terms for abuse.
* A logistic model over the weighed sums gives the score, its weights learnt from the same labelled sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, mix64, one_text, signed, store, table, texts
from .words import STEP

TOXIC = 0.5
#: at most so many labelled rows of each label are learnt from, those with the least hashes of their ids
SAMPLE_EACH = 3000
STEMS = range(3, 9)
LIFT = 10.0
#: log-likelihood ratio from which an entry is no chance find among all words and beginnings
EVIDENCE = 11.0
CONTEXT = 8
#: share of a term's uses that are taken to be misspelt when its variants are weighed
SLIPS = 0.05
CACHE = 500_000
#: texts whose words have at least this Jaccard similarity are copies
SAME = 0.8
BANDS = 8
FEATURES = ("words", "stems", "misspelt", "quoted", "density")
#: mean of the weights' prior (intercept first): what terms mean before any label is seen
PRIOR = np.array([-3.0, 3.0, 3.0, 1.5, 0.3, 0.0])

_WORD = re.compile(r"[^\W_]+(?:[@$*][^\W_]+)*")
_QUOTES = "\"“”„«»‹›"
#: cue words in the corpus' languages
REPORTING = frozenset("said says saying wrote writes called quote quoted quotes word words term terms means meaning "
                      "dit disait mot mots terme sagte sagt wort wörter begriff dijo dice palabra palabras término".split())
ADDRESS = frozenset("you your youre are tu toi vous es êtes du dich dein ihr euch bist tú usted ustedes eres sois".split())


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Entry:
    term: str
    stem: bool
    edits: int
    weight: float
    slips: tuple[float, ...] = ()  # weights with 1, 2, ... edits; none: the same

    def value(self, edits: int) -> float:
        return self.slips[edits - 1] if edits and self.slips else self.weight


class Automaton:
    """Deterministic automaton of words within an entry's edits of it, or longer than a stem
    they start with; built on demand."""

    def __init__(self, entries: list[Entry]):
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]  # the word that ends at a node
        self.stems: list[int] = [-1]  # the stem that ends there
        for i, e in enumerate(entries):
            node = 0
            for c in e.term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.stems.append(-1)
                node = self.children[node][c]
            (self.stems if e.stem else self.ends)[node] = i
        self.most = [0] * len(self.children)  # edits that any entry below a node allows
        for node in range(len(self.children) - 1, -1, -1):
            own = [entries[i].edits for i in (self.ends[node], self.stems[node]) if i >= 0]
            self.most[node] = max([0, *own, *(self.most[x] for x in self.children[node].values())])
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.word_end: list[tuple[int, int] | None] = []  # (edits, entry) if a word ends here
        self.stem_end: list[tuple[int, int] | None] = []  # (edits, entry) of a stem complete here
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        todo = list(items)
        while todo:  # letters of the entry left out in the text
            node, e = todo.pop()
            for x in self.children[node].values():
                if e < self.most[x] and (x, e + 1) not in items:
                    items.add((x, e + 1))
                    todo.append((x, e + 1))
        best: dict[int, int] = {}
        for node, e in items:
            best[node] = min(e, best.get(node, e))
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            for ends, out in ((self.ends, self.word_end), (self.stems, self.stem_end)):
                out.append(min(((e, ends[n]) for n, e in key if ends[n] >= 0 and e <= self.entries[ends[n]].edits), default=None))
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            for x, child in self.children[node].items():
                if x == c:
                    out.add((child, e))
                elif e < self.most[child]:
                    out.add((child, e + 1))
            if e < self.most[node]:
                out.add((node, e + 1))
        to = self._state(out) if out else -1
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the match of fewest edits, of equal ones a whole word's, then the shortest stem's."""
        state, stem = self.start, None
        for c in word:
            here = self.stem_end[state]  # a stem has more letters after it
            if here and (stem is None or here[0] < stem[0]):
                stem = here
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                return stem
        found = self.word_end[state]
        return stem if found is None or (stem and stem[0] < found[0]) else found


@dataclass
class Model:
    entries: list[Entry]
    weights: np.ndarray
    ordinary: frozenset[str] = frozenset()  # no misspellings
    automaton: Automaton = field(init=False, repr=False)

    def __post_init__(self):
        self.automaton, self.known = Automaton(self.entries), {}

    def __reduce__(self):
        return Model, (self.entries, self.weights, self.ordinary)

    def match(self, word: str):
        if word not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.automaton.match(word)
            self.known[word] = None if found and found[0] and word in self.ordinary else found
        return self.known[word]

    def terms(self, text: str) -> list[dict]:
        """The terms of a text: entry, surface, start, end (code points of the lower-cased text), edits, and the
        weight of abuse (1) against quotation (0) in the window around."""
        low = text.lower()
        if not any(map(self.match, set(_WORD.findall(low)))):
            return []
        spans = [(m[0], m.start(), m.end()) for m in _WORD.finditer(low)]
        hits = [i for i, (w, _, _) in enumerate(spans) if self.match(w) is not None]
        places, out = np.array(hits), []
        for i in hits:
            surface, start, end = spans[i]
            edits, entry = self.match(surface)
            around = {w for w, _, _ in spans[max(0, i - CONTEXT):i + CONTEXT + 1]}
            before, after = low[max(0, start - 120):start], low[end:end + 120]
            marks = sum(before.count(q) for q in _QUOTES)
            quoted = bool(marks % 2) and any(q in after for q in _QUOTES)
            near = int(((places >= i - CONTEXT) & (places <= i + CONTEXT)).sum()) - 1
            quotation = 0.6 * quoted + 0.2 * bool(around & REPORTING)
            abuse = 0.1 * min(near, 2) + 0.1 * bool(around & ADDRESS) + 0.1 * ("!" in after[:20])
            out.append({"entry": entry, "surface": surface, "start": start, "end": end, "edits": edits,
                        "abuse": min(1.0, max(0.1, 1 - quotation + (abuse if quotation else 0)))})
        return out

    def features(self, text: str, slip: bool = False) -> list[float]:
        """What the score weighs; ``slip``: as if every exact term that takes edits had one, and without the others."""
        found = self.terms(text)
        if slip:
            found = [{**t, "edits": t["edits"] or 1} for t in found if t["edits"] or self.entries[t["entry"]].edits]
        if not found:
            return [0.0] * len(FEATURES)
        word = stem = wrong = quoted = 0.0
        for t in found:
            e = self.entries[t["entry"]]
            value = t["abuse"] * min(e.value(t["edits"]), 4) / 4
            quoted += 1 - t["abuse"]
            if t["edits"]:
                wrong += value
            elif e.stem:
                stem += value
            else:
                word += value
        density = 100 * len(found) / max(50, len(text) / 6)
        return [*np.log1p([word, stem, wrong, quoted]).tolist(), min(density, 10) / 10]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + rows @ self.weights[1:], -30, 30)))


def _keys(words: set[str]) -> set[str]:
    """What a document may teach: whole words, marked by a final $, and the beginnings of words."""
    return {w + "$" for w in words if len(w) > 2} | {w[:n] for w in words for n in STEMS if len(w) > n}


def edits_of(length: int) -> int:
    """Edits that an entry of so many letters takes: a transposition is two."""
    return 1 if length < 6 else 2 if length < 12 else 3


def _copy(words: list[str]) -> int:
    """Texts with the same sequence of words share it."""
    return xxhash.xxh64_intdigest("\n".join(words).encode()) - (1 << 63)


def _hashes(words: set[str]) -> np.ndarray:
    return np.array(sorted(xxhash.xxh64_intdigest(w.encode()) for w in words), np.uint64)


def _bands(hashes: np.ndarray) -> list[int]:
    """Pairs of min-hashes: texts whose words are SAME alike share one of BANDS with probability 0.9997."""
    if not len(hashes):
        return []
    least = [mix64(hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))).min() for k in range(1, 2 * BANDS + 1)]
    pairs = np.array(least, np.uint64).reshape(BANDS, 2)
    return signed(mix64(pairs[:, 0] * STEP + pairs[:, 1] + np.arange(BANDS, dtype=np.uint64))).tolist()


def without_copies(rows: DataFrame) -> DataFrame:
    """One row of equal texts of a label, and none whose words are SAME alike to those of a row with a lesser id.

    ``rows`` have doc_id, label, copy, words, bands.  Each row is compared with the least row of each of its bands,
    so that large groups of copies cost no more than others.
    """
    columns = [c for c in rows.columns if c not in ("label", "copy")]
    rows = store(rows.groupBy("label", "copy").agg(F.min_by(F.struct(*columns), "doc_id").alias("r"))
                 .select("label", "copy", "r.*"), "toxicity-texts")
    bands = rows.select("label", "doc_id", "copy", F.explode("bands").alias("band"))
    first = bands.groupBy("label", "band").agg(F.min(F.struct("doc_id", "copy")).alias("first"))
    pairs = (bands.join(first, ["label", "band"]).filter(F.col("first.copy") != F.col("copy"))
             .select("label", "copy", F.col("first.copy").alias("other")).distinct())
    words = rows.select("label", "copy", "words")
    both = F.size(F.array_intersect("words", "others"))
    near = (pairs.join(words, ["label", "copy"])
            .join(words.select("label", F.col("copy").alias("other"), F.col("words").alias("others")), ["label", "other"])
            .filter(both >= SAME * (F.size("words") + F.size("others") - both)).select("label", "copy").distinct())
    return rows.join(near, ["label", "copy"], "left_anti")


def choose_entries(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> list[Entry]:
    """Entries from (key, toxic documents, clean documents): the keys of most evidence that no chosen one covers.

    Of keys with the same documents a whole word comes first, then the longest beginning.  A stem covers the longer
    words that take no more edits than it.
    """
    share = toxic / max(toxic + clean, 1)

    def evidence(a: int, b: int) -> float:
        return sum(n * np.log(n / ((a + b) * p)) for n, p in ((a, share), (b, 1 - share)) if n)

    lift = {k: (a / max(toxic, 1)) / ((b + 0.5) / max(clean, 1)) for k, a, b in counts}
    good = {k: e for k, a, b in counts if lift[k] >= LIFT and (e := evidence(a, b)) >= EVIDENCE}
    stems, chosen = set(), []
    for k in sorted(good, key=lambda k: (-round(good[k], 6), not k.endswith("$"), -len(k), k)):
        term, stem = k.rstrip("$"), not k.endswith("$")
        if any(term[:n] in stems and (stem or edits_of(n) >= edits_of(len(term))) for n in range(1, len(term))) or (
                stem and any(e.term.startswith(term) for e in chosen)):
            continue
        if stem:
            stems.add(term)
        chosen.append(Entry(term, stem, edits_of(len(term)), float(np.log(lift[k]))))
    return chosen


def weigh_slips(entries: list[Entry], hits: dict[int, int], near: list[tuple[int, int, str, int, int]],
                toxic: int, clean: int) -> tuple[list[Entry], frozenset[str]]:
    """Entries with the weights of their misspellings, and the ordinary words among these.

    ``hits`` are the toxic documents of each entry, ``near`` (entry, edits, word, toxic documents, clean documents)
    of the sample's words some edits away.  A word without LIFT is ordinary.  Ordinary words of one clean document
    say how many more the sample has not seen; an entry takes edits while misspellings outweigh those.
    """
    lift = {w: (a / max(toxic, 1)) / ((b + 0.5) / max(clean, 1)) for _, _, w, a, b in near}
    single = Counter((i, d) for i, d, w, a, b in near if b == 1 and lift[w] < LIFT)
    out = []
    for i, e in enumerate(entries):
        share = SLIPS * hits.get(i, 0) / max(toxic, 1)
        slips = [np.log(max(share, 1e-9) * max(clean, 1) / (single[i, d] + 0.5)) for d in range(1, e.edits + 1)]
        slips = [min(e.weight, float(x)) for x in slips]
        takes = next((d for d, x in enumerate(slips) if x <= 0), len(slips))
        out.append(replace(e, edits=takes, slips=tuple(slips[:takes])))
    return out, frozenset(w for _, _, w, _, b in near if b and lift[w] < LIFT)


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 2.0) -> np.ndarray:
    """Weights (intercept first) by Newton's method, drawn towards ``prior``."""
    x, w = np.c_[np.ones(len(x)), x], prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> Model:
    """Learn lexicon and weights from labelled documents that are not held out; a repeated id's largest label counts."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    own = own.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    first = [own.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for k in (0, 1)]

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [words_of(t) for t in frame["text"]]
            hashes = [_hashes(set(w)) for w in found]
            yield frame[["doc_id", "label", "text"]].assign(
                copy=[_copy(w) for w in found], words=[signed(h).tolist() for h in hashes],
                bands=[_bands(h) for h in hashes], keys=[sorted(_keys(set(w))) for w in found])

    # at most 2 * each rows are broadcast, written by key and, as numbers, come back
    sample = one_text(texts(docs).join(F.broadcast(first[0].union(first[1])), "doc_id"), "label").select(
        "doc_id", "label", "text").mapInPandas(
        keys, "doc_id long, label int, text string, copy long, words array<long>, bands array<long>, keys array<string>")
    sample = store(without_copies(sample).select("doc_id", "label", "text", "keys"), "toxicity-sample")
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    counts = (sample.select("label", F.explode("keys").alias("key")).groupBy("key")
              .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
              .filter((F.col("a") >= 4) & (F.col("a") * max(clean, 1) >= LIFT * F.col("b") * max(toxic, 1))))
    first = Model(choose_entries([tuple(r) for r in counts.collect()], toxic, clean), PRIOR)

    def matches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for label, text in zip(frame["label"], frame["text"], strict=True):
                near = [(w, first.match(w)) for w in set(words_of(text))]
                out += {(label, *m, w if m[0] else "") for w, m in near if m}
            yield pd.DataFrame(out, columns=["label", "edits", "entry", "word"])

    found = (sample.mapInPandas(matches, "label int, edits int, entry int, word string").groupBy("entry", "edits", "word")
             .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).collect())  # words of the sample at most
    entries, ordinary = weigh_slips(first.entries, {r["entry"]: r["a"] for r in found if not r["edits"]},
                                    [tuple(r) for r in found if r["edits"]], toxic, clean)
    model = Model(entries, PRIOR, ordinary)
    # words of one clean document stand for those that the sample has not seen
    trained = Model(entries, PRIOR, frozenset(r["word"] for r in found if r["b"] > 1 and r["word"] in ordinary))

    @F.pandas_udf("array<array<double>>")
    def measure(text: pd.Series) -> pd.Series:
        return pd.Series([[trained.features(t), trained.features(t, True)] for t in text], dtype=object)

    rows = sample.select("doc_id", "label", measure("text").alias("x")).toPandas().sort_values("doc_id")
    if len(rows):
        x = np.array([[list(v) for v in r] for r in rows["x"]], np.float64)  # as written, and with slips
        y = rows["label"].to_numpy(np.float64)
        more = (y == 0) | x[:, 1].any(axis=1)
        model.weights = logistic(np.r_[x[:, 0], x[more, 1]], np.r_[y, y[more]], PRIOR)
    return model


def score_column(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            rows = np.array([model.features(t) for t in text], np.float64).reshape(-1, len(FEATURES))
            yield pd.Series(model.scores(rows))

    return score(F.coalesce(text.cast("string"), F.lit("")))


def find_terms(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, term, surface, start, end, edits, abuse): every term found, with its context's score."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(d, model.entries[t["entry"]].term, t["surface"], t["start"], t["end"], t["edits"], t["abuse"])
                   for d, text in zip(frame["doc_id"].astype("Int64"), frame["text"], strict=True) for t in model.terms(text)]
            out = pd.DataFrame(out, columns=["doc_id", "term", "surface", "start", "end", "edits", "abuse"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return texts(docs).mapInPandas(find, "doc_id long, term string, surface string, start int, end int, edits int, abuse double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Only the text enters a score.  Edge cases: null and empty texts hold no terms and get the score of a text
    without any; labels with a null id, a null or an unknown value are not learnt from; without toxic labels
    the lexicon is empty and all documents score alike, below TOXIC; a null doc_id is never held out; repeated
    rows get a row each; an empty table gives none.
    """
    model = fit(docs, labels)
    return texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                              score_column(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= TOXIC).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
