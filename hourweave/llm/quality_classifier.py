"""Quality classifier: Bradley-Terry scores learnt from preference pairs, cut at a score quantile.

A document's worth is a linear function of text features.  From labelled documents, pairs (one of label 1, one
of label 0) say which is preferred; the weights minimise the logistic loss of the pairs' feature differences, as
in a Bradley-Terry model.  The worth at which documents are accepted is a quantile of the labelled documents'
worths (the one with the fewest labels on the wrong side), and scores are the logistic of the distance from it, shifted so
that acceptance is a score of ACCEPT or more.

Fitting uses a bounded sample (SAMPLE labelled rows, PAIRS pairs); scoring is one pass over all whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, one_text, table, texts
from .words import Words

ACCEPT = 0.3
#: at most so many labelled rows are learnt from, those with the least hashes of their ids
SAMPLE = 12_000
PAIRS = 60_000
RIDGE = 1e-3
TEXT_AT_ONCE = 1 << 19
#: characters added to a text's length in shares, so that a few of a kind mean little in a short text
FEW = 30

_SYMBOLS, _UPPER, _LETTER, _DIGIT, _MARK, _HIGH = (np.zeros(256, bool) for _ in range(6))
_SYMBOLS[list(b"#*$%&|<>=@^~_{}[]\\/")] = True
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT[48:58] = True
_MARK[list(b"!?")] = True
_HIGH[128:] = True

FEATURES = ("log_words", "log_bytes", "word_length", "upper", "symbols", "marks", "digits", "non_ascii", "letters",
            "distinct", "runs", "top_word", "pairs", "lines", "distinct_lines", "empty")


def features(texts_: list[str]) -> np.ndarray:
    """One row of FEATURES per text."""
    data = [t.encode() for t in texts_]
    w = Words(texts_)
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    size = np.array([len(x) for x in data], np.float64)
    start = np.cumsum([0, *(len(x) + 1 for x in data)])[:-1]

    def share(kind: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind[raw].astype(np.int32), start) / (size + FEW)

    def distinct(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many distinct keys each text has, and how often its commonest comes."""
        many, top = np.zeros(len(texts_)), np.zeros(len(texts_))
        if len(key):
            order = np.lexsort((key, owner))
            k, o = key[order], owner[order]
            new = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
            np.maximum.at(top, o[new], np.diff(np.r_[new, len(k)]))
            np.add.at(many, o[new], 1)
        return many, top

    n = w.count.astype(np.float64)
    some = np.maximum(n, 1)
    kinds, top = distinct(w.hash, w.text)
    same = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
    runs = np.bincount(w.text[1:][same], minlength=len(texts_)) if len(w.hash) else np.zeros(len(texts_))
    two = w.shingles(2)
    pair_kinds, _ = distinct(two[two != 0], w.text[two != 0])
    lines = [t.split("\n") for t in texts_]
    n_lines = np.array([len(x) for x in lines], np.float64)
    line_kinds = np.array([len(set(x)) for x in lines], np.float64)
    letters = share(_LETTER) + share(_HIGH)
    return np.stack([
        np.log1p(n), np.log1p(size), np.minimum(size / some, 50) / 10, share(_UPPER) / (share(_LETTER) + 0.05),
        10 * share(_SYMBOLS), 10 * share(_MARK), 10 * share(_DIGIT), share(_HIGH), letters + 0.8 * FEW / (size + FEW), (kinds + 2) / (n + 2), runs / (n + 2),
        np.maximum(top - 1, 0) / (n + 2), (pair_kinds + 2) / (np.maximum(n - 1, 0) + 2), (n_lines - 1) / (n + FEW), line_kinds / n_lines,
        (n == 0).astype(np.float64)], 1)


def _in_pieces(text: pd.Series) -> list[np.ndarray]:
    """Features of a batch, a bounded number of characters at once."""
    block = (text.str.len().cumsum() // TEXT_AT_ONCE).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(text)]
    return [features(text.iloc[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


@dataclass
class Ranker:
    """Standardisation, weights and the accepted worth."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def worth(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        shift = np.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + np.exp(-np.clip(self.worth(rows) - self.cut + shift, -30, 30)))


def bradley_terry(rows: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = 7) -> Ranker:
    """Fit weights on ``pairs`` random preferences and the cut on the rows' worths."""
    mean, scale = rows.mean(0) if len(rows) else np.zeros(len(FEATURES)), rows.std(0) if len(rows) else np.ones(len(FEATURES))
    ranker = Ranker(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(len(FEATURES)), 0.0)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        ranker.cut = -8.0 if len(good) or not len(bad) else 8.0  # one label alone: all alike
        return ranker
    x = np.clip((rows - ranker.mean) / ranker.scale, -8, 8)
    r = np.random.default_rng(seed)
    better = np.concatenate([good, r.choice(good, max(0, pairs - len(good)))])
    worse = np.concatenate([bad, r.choice(bad, max(0, len(better) - len(bad)))])[:len(better)]
    gap = x[better] - x[r.permutation(worse)]
    w = ranker.weights
    for _ in range(25):  # Newton steps on the mean logistic loss of the gaps
        p = 1 / (1 + np.exp(np.clip(gap @ w, -30, 30)))
        slope = -(gap * p[:, None]).mean(0) + ridge * w
        bend = (gap * (p * (1 - p))[:, None]).T @ gap / len(gap) + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    ranker.weights = w
    worth = ranker.worth(rows)
    # the quantile of worth with the fewest labels on the wrong side, between two neighbouring worths
    order = np.argsort(worth, kind="stable")
    lost, caught = np.cumsum(label[order] == 1), np.cumsum(label[order] == 0)
    best = int(np.argmax(caught - lost))
    after = order[min(best + 1, len(order) - 1)]
    ranker.cut = float((worth[order[best]] + worth[after]) / 2)
    return ranker


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranker:
    """Learn from labelled documents that are not held out; of a repeated id one text and its least label count."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    own = own.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("doc_id")))
    chosen = own.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @F.pandas_udf("array<double>")
    def measure(text: pd.Series) -> pd.Series:
        return pd.Series(list(np.concatenate(_in_pieces(text))) if len(text) else [], dtype=object)

    # at most ``sample`` rows are broadcast and come back as numbers, however often an id repeats
    found = one_text(texts(docs).join(F.broadcast(chosen), "doc_id"), "label").select("doc_id", "label", measure("text").alias("x"))
    rows = found.toPandas().sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return bradley_terry(x, rows["label"].to_numpy(np.int64))


def score_column(text: Column, ranker: Ranker) -> Column:
    """Score of a text column: 0 to 1, accepted from ACCEPT on."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([ranker.score(x) for x in _in_pieces(text)]) if len(text) else [], dtype=float)

    return score(F.coalesce(text.cast("string"), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Only the text enters a score.  Edge cases: null and empty texts are scored by their (empty) features;
    labels with a null id, a null or an unknown value are not learnt from; without labels of both kinds all
    documents score alike (accepted unless only label 0 is known); a null doc_id is never held out; repeated
    rows get a row each; an empty table gives none.
    """
    ranker = fit(docs, labels)
    return texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                              score_column(F.col("text"), ranker).alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored below ACCEPT go."""
    ranker = fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(score_column(F.col("text"), ranker) >= ACCEPT)
