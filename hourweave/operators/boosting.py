"""Histogram gradient boosting for many runs at once.

Features are binned once to bytes and written in blocks of at most BLOCK_ROWS rows.  A tree grows best-first: the
leaf with the greatest gain is split until ``leaves`` leaves stand.  A leaf's histogram holds the number of rows
and the sum of residuals per feature and bin; of two siblings only the smaller one is counted, the other is the
parent less the first.  All runs (feature subsets, seeds) share the blocks and grow in lockstep: one map pass over
the blocks counts the wanted leaves of every run, partial histograms are merged by a tree reduction, and the
driver, which sees histograms only, chooses the splits.  A pass counts every leaf that may still be split, so a
tree needs about as many passes as it is deep.

If all blocks together are within LOCAL_BYTES there is nothing to merge, and a pass would cost more to schedule
than to run: then each run grows in a task of its own, with the same code.  Both ways give the same trees.

Residuals are counted in whole steps of 2**-k (about 2**-19 of the largest), so sums are exact whatever the order
and the partitions, and a run repeats to the last bit.  Rows and columns that a seed draws for an iteration come
from hashes of (seed, iteration, row key or column name).
"""

from __future__ import annotations

import heapq
import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BINS = 256
#: rows of a block: sums of 2**16 residuals of 2**19 steps and their number fit into the 53 bits of a double
BLOCK_ROWS = 1 << 16
_STEPS = 1 << 19
_COUNT = float(1 << 36)
#: bytes of binned rows up to which a run grows in one task
LOCAL_BYTES = 64 << 20
#: rows (as drawn by their hash) from which bin edges are taken
EDGE_ROWS = 1 << 16
#: trees after which the rows' predictions are checkpointed
CHECKPOINT = 25


@dataclass(frozen=True)
class Run:
    """One fit: its feature columns and what it draws."""

    features: tuple[str, ...]
    seed: int = 42
    row_rate: float = 1.0
    column_rate: float = 1.0


@dataclass(frozen=True)
class Growth:
    """How trees grow; the same for all runs of a fit."""

    iterations: int = 150
    rate: float = 0.05
    leaves: int = 31
    least: int = 30
    l2: float = 1.0


@dataclass
class Tree:
    """Node i splits on bin <= cut[i] of feature[i] into left[i] and left[i] + 1; feature -1: a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> int:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for own, x in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.value, 0.0)):
            own += [x, x]
        return self.left[node]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ x >> np.uint64(31)


def _drawn(keys: np.ndarray, seed: int, iteration: int, rate: float) -> np.ndarray:
    """Which keys a seed draws in an iteration."""
    salt = _mix(np.array([seed % 2**32 * 2**32 + iteration], np.uint64))
    return _mix(keys ^ salt[0]) < np.uint64(min(rate, 1.0) * (2**64 - 2**12))


def _columns(run: Run, iteration: int) -> np.ndarray:
    """Columns of the run that an iteration may split on: at least one."""
    if run.column_rate >= 1:
        return np.arange(len(run.features))
    names = np.array([zlib.crc32(f.encode()) for f in run.features], np.uint64)
    kept = np.flatnonzero(_drawn(names + (np.uint64(1) << np.uint64(40)), run.seed, iteration, run.column_rate))
    return kept if len(kept) else np.array([int(np.argmin(_mix(names)))])


class _Rows:
    """A block's rows in one tree: which rows each node holds, and histograms over them."""

    def __init__(self, bins: np.ndarray, residual: np.ndarray, scale: float, drawn: np.ndarray | None):
        self.bins, self.drawn = bins, drawn
        self.packed = np.rint(residual * scale) + _COUNT
        self.at = {0: np.arange(bins.shape[1])}

    def follow(self, tree: Tree) -> None:
        """Rows of the nodes that the tree has by now; children have greater numbers than their parents."""
        for node in range(len(tree.feature)):
            if tree.feature[node] >= 0:
                self.split(tree, node)

    def split(self, tree: Tree, node: int) -> None:
        rows = self.at.pop(node)
        low = self.bins[tree.feature[node], rows] <= tree.cut[node]
        self.at[tree.left[node]], self.at[tree.left[node] + 1] = rows[low], rows[~low]

    def histogram(self, node: int, columns: np.ndarray) -> np.ndarray:
        """(2, columns, BINS): numbers of rows and sums of steps."""
        rows = self.at[node]
        if self.drawn is not None:
            rows = rows[self.drawn[rows]]
        weights = self.packed[rows]
        whole = len(rows) == self.bins.shape[1]
        out = np.empty((len(columns), BINS))
        for i, c in enumerate(columns):
            own = self.bins[c]
            out[i] = np.bincount(own if whole else own[rows], weights, BINS)
        count = np.rint(out / _COUNT)
        return np.stack([count, out - count * _COUNT]).astype(np.int64)


class _Grower:
    """One run's current tree: asks for histograms and grows best-first once it has them."""

    def __init__(self, run: Run, features: dict[str, int], growth: Growth, iteration: int, scale: float):
        self.columns = _columns(run, iteration)
        self.place = np.array([features[f] for f in run.features])[self.columns]
        self.growth, self.scale, self.tree = growth, scale, Tree()
        self.hist: dict[int, np.ndarray] = {}
        self.best: dict[int, tuple] = {}
        self.path = {0: ""}  # equal gains go by the place in the tree, however its nodes are numbered
        #: splits whose children are counted: node -> children; they may exceed what the tree takes in the end
        self.tried: dict[int, int] = {}
        self.asked: dict[int, int] = {}  # child to count -> its parent, -1 for the root

    def _find(self, node: int) -> None:
        n, s = self.hist[node]
        rows, total = int(n[0].sum()), int(s[0].sum())
        self.tree.value[node] = self.growth.rate * total / self.scale / (rows + self.growth.l2) if rows else 0.0
        nl, sl = np.cumsum(n, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1] / self.scale
        nr, sr = rows - nl, total / self.scale - sl
        gain = sl * sl / (nl + self.growth.l2) + sr * sr / (nr + self.growth.l2) - (total / self.scale)**2 / (rows + self.growth.l2)
        gain[(nl < self.growth.least) | (nr < self.growth.least)] = -np.inf
        top = int(np.argmax(gain))
        f, cut = divmod(top, BINS - 1)
        if gain[f, cut] > 0:
            self.best[node] = (-float(gain[f, cut]), self.path[node], node, int(self.place[f]), cut,
                               int(nl[f, cut]) <= int(nr[f, cut]))

    def wanted(self, ahead: bool) -> list[int]:
        """Nodes to count now; with ``ahead`` the children of all leaves that may still be split."""
        if not self.hist:
            self.asked = {0: -1}
            return [0]
        spare = self.growth.leaves - 1
        heap, taken = [self.best[0]] if 0 in self.best else [], []
        while heap and spare:
            top = heapq.heappop(heap)
            if top[2] not in self.tried:
                taken.append(top)
                if not ahead:
                    break
            else:
                child = self.tried[top[2]]
                for c in (child, child + 1):
                    if c in self.best:
                        heapq.heappush(heap, self.best[c])
            spare -= 1
        self.asked = {}
        for _, path, node, feature, cut, small_left in taken:
            child = self.tree.split(node, feature, cut)
            self.tried[node] = child
            self.path[child], self.path[child + 1] = path + "0", path + "1"
            self.asked[child if small_left else child + 1] = node
        return list(self.asked)

    def take(self, counted: dict[int, np.ndarray]) -> None:
        for node, parent in self.asked.items():
            self.hist[node] = counted[node]
            self._find(node)
            if parent >= 0:
                other = 2 * self.tried[parent] + 1 - node
                self.hist[other] = self.hist.pop(parent) - counted[node]
                self._find(other)

    def grown(self) -> Tree:
        """The best-first tree: splits beyond its leaves, tried ahead, are left out."""
        out, spare, name = Tree(), self.growth.leaves - 1, {0: 0}
        heap = [self.best[0]] if 0 in self.best else []
        while heap and spare:
            _, _, node, feature, cut, _ = heapq.heappop(heap)
            child = out.split(name[node], feature, cut)
            for k in (0, 1):
                name[self.tried[node] + k] = child + k
                if self.tried[node] + k in self.best:
                    heapq.heappush(heap, self.best[self.tried[node] + k])
            spare -= 1
        for node, at in name.items():
            out.value[at] = self.tree.value[node]
        return out


def _leaf_values(tree: Tree, bins: np.ndarray) -> np.ndarray:
    node = np.zeros(bins.shape[1], np.int32)
    feature, cut, left, value = (np.array(x) for x in (tree.feature, tree.cut, tree.left, tree.value))
    row = np.arange(bins.shape[1])
    while len(row):
        row = row[feature[node[row]] >= 0]
        at = node[row]
        node[row] = left[at] + (bins[feature[at], row] > cut[at])
    return value[node]


def _scale(bound: float) -> float:
    """Steps per unit, a power of two, so that the largest residual has at most _STEPS steps."""
    return 2.0 ** math.floor(math.log2(_STEPS / bound)) if bound > 0 else 1.0


def _grow_here(bins: np.ndarray, keys: np.ndarray, y: np.ndarray, run: Run, features: dict[str, int], growth: Growth,
               base: float) -> list[Tree]:
    """All trees of a run whose rows are here, a block of BLOCK_ROWS after the other."""
    cuts = range(0, len(y), BLOCK_ROWS)
    pred, trees = np.full(len(y), base), []
    bound = float(np.abs(y - base).max(initial=0.0))
    for t in range(growth.iterations):
        residual = y - pred
        largest = float(np.abs(residual).max(initial=0.0))
        grower = _Grower(run, features, growth, t, _scale(bound))
        drawn = _drawn(keys, run.seed, t, run.row_rate) if run.row_rate < 1 else None
        blocks = [_Rows(bins[:, a:a + BLOCK_ROWS], residual[a:a + BLOCK_ROWS], grower.scale,
                        None if drawn is None else drawn[a:a + BLOCK_ROWS]) for a in cuts]
        while wanted := grower.wanted(ahead=False):
            parent = grower.asked[wanted[0]]
            if parent >= 0:
                for b in blocks:
                    b.split(grower.tree, parent)
            grower.take({node: sum(b.histogram(node, grower.place) for b in blocks) for node in wanted})
        tree = grower.grown()
        # the rows of each leaf are known: best-first growth without trying ahead splits exactly these nodes
        for b, a in zip(blocks, cuts, strict=True):
            for node, rows in b.at.items():
                pred[a + rows] += grower.tree.value[node]
        trees.append(tree)
        bound = largest * (1 + growth.rate)
    return trees


# ---------------------------------------------------------------- binned rows


def bin_edges(train: DataFrame, features: list[str], key: list[str], rows: int = EDGE_ROWS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature but the last: at most 255, between distinct values.

    They come from the rows whose key hash is below a bound, about ``rows`` of them (all rows if there are no
    more), so they don't depend on the partitions.  Missing values get bin 255, above all others.
    """
    n = train.count()
    some = train if n <= rows else train.filter(F.xxhash64(*key, F.lit(1)) < F.lit(int(-2**63 + 2**64 * (rows / n))))
    values = some.select(*[F.col(f).cast("double").alias(f) for f in features]).toPandas()
    out = []
    for f in features:
        x = np.sort(values[f].dropna().to_numpy(float))
        kept = np.unique(x)
        if len(kept) > BINS - 1:
            kept = np.unique(x[(np.arange(1, BINS - 1) * len(x)) // (BINS - 1)])
            out.append(kept)
        else:
            out.append((kept[:-1] + kept[1:]) / 2)
    return out


def _to_bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.searchsorted(edges, values, "left").astype(np.uint8)
    out[np.isnan(values)] = BINS - 1
    return out


def binned(train: DataFrame, features: list[str], label: str, key: list[str], edges: list[np.ndarray]) -> DataFrame:
    """Blocks (rows, bins, key, y) of at most BLOCK_ROWS rows, written under the checkpoint folder."""
    from ..session import materialize

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def block():
            x = [np.concatenate([h[i] for h in held], axis=-1) for i in range(3)]
            return pd.DataFrame({"rows": [len(x[1])], "bins": [x[0].tobytes()], "key": [x[1].tobytes()], "y": [x[2].tobytes()]})

        for frame in frames:
            for a in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[a:a + BLOCK_ROWS]
                if n + len(part) > BLOCK_ROWS:
                    yield block()
                    held, n = [], 0
                bins = np.stack([_to_bins(part[f].to_numpy(float), e) for f, e in zip(features, edges, strict=True)])
                held.append((bins, part["__key"].to_numpy(np.int64).view(np.uint64), part["__y"].to_numpy(float)))
                n += len(part)
        if n:
            yield block()

    rows = train.select(*[F.col(f).cast("double").alias(f) for f in features], F.xxhash64(*key).alias("__key"),
                        F.col(label).cast("double").alias("__y")).filter("__y IS NOT NULL AND NOT isnan(__y)")
    return materialize(rows.mapInPandas(pack, "rows long, bins binary, key binary, y binary"), "binned")


def _arrays(row, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["bins"], np.uint8).reshape(features, -1), np.frombuffer(row["key"], np.uint64),
            np.frombuffer(row["y"], np.float64))


# ---------------------------------------------------------------- fitting


@dataclass
class BoostedModel:
    """Trees over binned features; ``transform`` adds the column ``y_pred``."""

    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]

    def staged(self, frame: pd.DataFrame) -> Iterator[np.ndarray]:
        """Predictions after each iteration."""
        bins = np.stack([_to_bins(frame[f].to_numpy(float), np.array(e)) for f, e in zip(self.features, self.edges, strict=True)])
        pred = np.full(len(frame), self.base)
        for tree in self.trees:
            pred = pred + _leaf_values(tree, bins)
            yield pred

    def predict(self, frame: pd.DataFrame) -> np.ndarray:
        pred = np.full(len(frame), self.base)
        for pred in self.staged(frame):
            pass
        return pred

    def transform(self, df: DataFrame, name: str = "y_pred") -> DataFrame:
        @F.pandas_udf("double")
        def predicted(x: pd.DataFrame) -> pd.Series:
            return pd.Series(self.predict(x))

        return df.withColumn(name, predicted(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features])))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(json.dumps(asdict(self)),)]
        spark.createDataFrame(rows, "value string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        x = json.loads(spark.read.text(path).first()["value"])
        return cls(x["features"], x["edges"], x["base"], [Tree(**t) for t in x["trees"]])


def _start(blocks, features: int) -> tuple[float, float]:
    """The labels' mean and the largest distance from it, the same on any partitions."""
    def extent(it):
        y = [_arrays(r, features)[2] for r in it]
        return [(min(map(np.min, y)), max(map(np.max, y)))] if y else []

    seen = blocks.mapPartitions(extent).collect()
    if not seen:
        raise ValueError("cannot fit on an empty training set")
    low, high = float(min(x[0] for x in seen)), float(max(x[1] for x in seen))
    scale = 2.0 ** (40 - math.frexp(max(abs(low), abs(high), 1e-300))[1])

    def total(it):
        x = [_arrays(r, features)[2] for r in it]
        return [(sum(len(y) for y in x), sum(int(np.rint(y[a:a + 1024] * scale).astype(np.int64).sum()) for y in x
                                            for a in range(0, len(y), 1024)))]

    n, s = map(sum, zip(*blocks.mapPartitions(total).collect(), strict=True))
    base = s / scale / n
    return base, max(abs(low - base), abs(high - base))


def fit_many(train: DataFrame, runs: list[Run], label: str = "target", key: list[str] | None = None, growth: Growth = Growth(),
             local_bytes: int = LOCAL_BYTES) -> list[BoostedModel]:
    """A boosted model for every run, all over the same rows; rows without a label are left out.

    ``key`` names columns that tell rows apart (default: all but the features); draws and edges hash them.
    """
    features = list(dict.fromkeys(f for r in runs for f in r.features))
    key = key or [c for c in train.columns if c not in features and c != label] or features
    edges = bin_edges(train, features, key)
    blocks = binned(train, features, label, key, edges)
    rdd = blocks.rdd
    base, bound = _start(rdd, len(features))
    number = {f: i for i, f in enumerate(features)}
    size = blocks.agg(F.sum("rows")).first()[0] * (len(features) + 16)
    grown = (_fit_local(blocks, runs, number, growth, base) if size <= local_bytes
             else _fit_lockstep(rdd, runs, number, growth, base, bound))
    out = []
    for run, trees in zip(runs, grown, strict=True):
        own = {number[f]: i for i, f in enumerate(run.features)}
        for t in trees:
            t.feature = [own.get(f, -1) for f in t.feature]
        out.append(BoostedModel(list(run.features), [edges[number[f]].tolist() for f in run.features], base, trees))
    return out


def _fit_local(blocks: DataFrame, runs: list[Run], number: dict[str, int], growth: Growth, base: float) -> list[list[Tree]]:
    """Each run in a task of its own; all blocks together are within LOCAL_BYTES."""
    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        parts = [_arrays(r, len(number)) for r in frame.to_dict("records")]
        bins, keys, y = (np.concatenate([p[i] for p in parts], axis=-1) for i in range(3))
        trees = _grow_here(bins, keys, y, runs[key[0]], number, growth, base)
        return pd.DataFrame({"run": [key[0]], "trees": [json.dumps([asdict(t) for t in trees])]})

    spread = blocks.withColumn("run", F.explode(F.array(*[F.lit(i) for i in range(len(runs))])))
    # one partition per run, or runs that fall together would wait for each other
    found = spread.repartitionByRange(len(runs), "run").groupBy("run").applyInPandas(fit, "run int, trees string").collect()
    return [[Tree(**t) for t in json.loads(r["trees"])] for r in sorted(found)]


def _fit_lockstep(rdd, runs: list[Run], number: dict[str, int], growth: Growth, base: float, bound: float) -> list[list[Tree]]:
    """All runs tree by tree: map passes over the blocks, histograms merged by tree reduction."""
    def begin(row):
        bins, keys, y = _arrays(row, len(number))
        return bins, keys, y, np.full((len(runs), len(y)), base)

    def merged(a, b):
        return {k: np.maximum(x, b[k]) if k[1] < 0 else x + b[k] for k, x in a.items()} if a and b else a or b

    state = rdd.map(begin).persist(StorageLevel.MEMORY_AND_DISK)
    depth = 2 if state.getNumPartitions() <= 64 else 3
    trees: list[list[Tree]] = [[] for _ in runs]
    bounds = [bound] * len(runs)
    for t in range(growth.iterations):
        growers = [_Grower(r, number, growth, t, _scale(b)) for r, b in zip(runs, bounds, strict=True)]
        active = {i: g.wanted(ahead=True) for i, g in enumerate(growers)}
        while active := {i: w for i, w in active.items() if w}:
            asked = [(i, w, growers[i].tree, growers[i].place, growers[i].scale) for i, w in active.items()]

            def count(blocks, asked=asked, t=t):
                out = {}
                for bins, keys, y, pred in blocks:
                    for i, nodes, tree, place, scale in asked:
                        drawn = _drawn(keys, runs[i].seed, t, runs[i].row_rate) if runs[i].row_rate < 1 else None
                        residual = y - pred[i]
                        rows = _Rows(bins, residual, scale, drawn)
                        rows.follow(tree)
                        part = {(i, n): rows.histogram(n, place) for n in nodes}
                        part[i, -1] = np.abs(residual).max(initial=0.0)
                        for k, x in part.items():
                            out[k] = x if k not in out else max(out[k], x) if k[1] < 0 else out[k] + x
                return [out]

            counted = state.mapPartitions(count).treeReduce(merged, depth)
            for i, nodes in active.items():
                growers[i].take({n: counted[i, n] for n in nodes})
                bounds[i] = float(counted[i, -1]) * (1 + growth.rate)
            active = {i: growers[i].wanted(ahead=True) for i in active}
        new = [g.grown() for g in growers]
        for own, tree in zip(trees, new, strict=True):
            own.append(tree)

        def add(block, new=new):
            bins, keys, y, pred = block
            return bins, keys, y, pred + np.stack([_leaf_values(tree, bins) for tree in new])

        before, state = state, state.map(add).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % CHECKPOINT == 0:
            from ..session import checkpoint_root

            checkpoint_root(SparkSession.getActiveSession())
            state.checkpoint()
        state.count()
        before.unpersist()
    state.unpersist()
    return trees


def histories(models: dict[str, BoostedModel], valid: DataFrame, label: str = "target") -> DataFrame:
    """(run_id, epoch, val_rmse): validation RMSE after each iteration of every model, from one pass."""
    features = list(dict.fromkeys(f for m in models.values() for f in m.features))

    def errors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, model in models.items():
                sse = [float(((frame["__y"] - p)**2).sum()) for p in model.staged(frame)]
                yield pd.DataFrame({"run_id": name, "epoch": np.arange(1, len(sse) + 1), "sse": sse, "n": len(frame)})

    rows = valid.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("__y"))
    parts = rows.filter("__y IS NOT NULL").mapInPandas(errors, "run_id string, epoch long, sse double, n long")
    return parts.groupBy("run_id", "epoch").agg(F.sqrt(F.sum("sse") / F.sum("n")).alias("val_rmse"))
