"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature owns a lookup table over its bins. Boosting goes round the features in a
cycle: each turn fits one shallow tree to the current gradients, looking at that feature
alone, and adds its leaves to the table. Afterwards the pairs of features whose
residuals gain most from a joint cut get tables of their own, boosted the same way. A
score is a sum of table entries: one addition per feature and pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parceltide.llm import text_features
from parceltide.llm.bytes_math import text_chunks

FOLDS, HELD_OUT = 3, 1  # documents with crc32(id) mod 3 = 1 are never learnt from


@dataclass(frozen=True)
class Settings:
    """``most_rows`` bounds the labelled rows that are fitted; everything is scored."""

    most_rows: int = 20_000
    bins: int = 64
    pair_bins: int = 16
    pairs: int = 10
    leaves: int = 3
    rounds: int = 200
    pair_rounds: int = 80
    rate: float = 0.1
    pair_rate: float = 0.1
    least_weight: float = 5.0  # hessian sum of a leaf
    penalty: float = 1.0  # added to the hessian sum of a leaf
    bags: int = 4
    check_share: float = 0.2  # of a bag's rows decide when its boosting stops
    patience: int = 20


@dataclass
class Model:
    """Bin edges and tables of the features; pairs as (i, j, table) over the coarse edges."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    bias: float = 0.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        out = np.full(len(features), self.bias)
        for k, table in enumerate(self.tables):
            out += table[binned(features[:, k], self.edges[k])]
        rough = {k: binned(features[:, k], self.coarse[k]) for pair in self.pairs for k in pair[:2]}
        for i, j, table in self.pairs:
            out += table[rough[i], rough[j]]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 ascending edges at quantiles; equal values are never parted."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher")) if len(values) else np.zeros(0)


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


# -- shallow trees over bins; g and h are gradient and hessian sums per bin


def _gain(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    return g * g / (h + penalty)


def best_cut(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[float, int]:
    """(gain, first bin of the right side) of the best cut of a run of bins; a gain of 0 if none is allowed."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gains = _gain(gl, hl, s.penalty) + _gain(gr, hr, s.penalty) - _gain(g.sum(), h.sum(), s.penalty)
    gains[(hl < s.least_weight) | (hr < s.least_weight)] = 0.0
    at = int(gains.argmax())
    return float(gains[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """Leaf value of every bin: the run is cut where it gains most until there are ``leaves`` parts."""
    parts = [(0, len(g))]
    cuts = {(0, len(g)): best_cut(g, h, s)}
    while len(parts) < s.leaves:
        low, high = max(parts, key=lambda p: cuts[p][0])
        gain, at = cuts[low, high]
        if gain <= 1e-12:
            break
        parts.remove((low, high))
        for part in ((low, low + at), (low + at, high)):
            parts.append(part)
            cuts[part] = best_cut(g[part[0] : part[1]], h[part[0] : part[1]], s)
    out = np.zeros(len(g))
    for low, high in parts:
        out[low:high] = -g[low:high].sum() / (h[low:high].sum() + s.penalty)
    return out


def _cross(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[float, np.ndarray]:
    """Best cut of the rows, then of the columns on either side; gain and leaf value of every cell."""
    _, at = best_cut(g.sum(axis=1), h.sum(axis=1), s)
    out, gain = np.zeros(g.shape), -float(_gain(g.sum(), h.sum(), s.penalty))
    for rows in (slice(0, at), slice(at, len(g))) if at else (slice(0, len(g)),):
        gs, hs = g[rows].sum(axis=0), h[rows].sum(axis=0)
        found, cut = best_cut(gs, hs, s)
        for columns in (slice(0, cut), slice(cut, len(gs))) if found > 0 else (slice(0, len(gs)),):
            total, weight = gs[columns].sum(), hs[columns].sum()
            out[rows, columns] = -total / (weight + s.penalty)
            gain += float(_gain(total, weight, s.penalty))
    return gain, out


def cross_tree(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[float, np.ndarray]:
    """The better of the two orders of cutting a table of cells."""
    one, other = _cross(g, h, s), _cross(g.T, h.T, s)
    return one if one[0] >= other[0] else (other[0], other[1].T)


def _loss(y: np.ndarray, logits: np.ndarray) -> float:
    return float((np.logaddexp(0, logits) - y * logits).mean()) if len(y) else 0.0


class _Boost:
    """Cyclic boosting of tables over cells: ``cells`` holds one cell number per row for every table."""

    def __init__(self, y: np.ndarray, logits: np.ndarray, learn: np.ndarray, s: Settings):
        self.y, self.logits, self.learn, self.s = y, logits.copy(), learn, s

    def slopes(self) -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(self.logits[self.learn])
        return p - self.y[self.learn], p * (1 - p)

    def run(self, cells: list[np.ndarray], shapes: list[tuple[int, ...]], rounds: int, rate: float) -> list[np.ndarray]:
        tables = [np.zeros(shape) for shape in shapes]
        rest = ~self.learn
        kept, least, waited = [t.copy() for t in tables], _loss(self.y[rest], self.logits[rest]), 0
        kept_logits = self.logits.copy()
        learnt = [c[self.learn] for c in cells]
        for _ in range(rounds):
            for k, shape in enumerate(shapes):
                g, h = self.slopes()
                size = int(np.prod(shape))
                gs = np.bincount(learnt[k], weights=g, minlength=size).reshape(shape)
                hs = np.bincount(learnt[k], weights=h, minlength=size).reshape(shape)
                step = shallow_tree(gs, hs, self.s) if len(shape) == 1 else cross_tree(gs, hs, self.s)[1]
                tables[k] += rate * step
                self.logits += rate * step.ravel()[cells[k]]
            now = _loss(self.y[rest], self.logits[rest])
            if now < least - 1e-7 or not rest.any():
                kept, least, waited, kept_logits = [t.copy() for t in tables], now, 0, self.logits.copy()
            else:
                waited += 1
                if waited >= self.s.patience:
                    break
        self.logits = kept_logits
        return kept


def rank_pairs(cells: list[np.ndarray], sizes: list[int], g: np.ndarray, h: np.ndarray, s: Settings) -> list[tuple[int, int]]:
    """The pairs of features whose joint cut gains most beyond the better single cut, on given gradients."""
    found = []
    for i, j in combinations(range(len(cells)), 2):
        shape = (sizes[i], sizes[j])
        cell = cells[i] * sizes[j] + cells[j]
        gs = np.bincount(cell, weights=g, minlength=shape[0] * shape[1]).reshape(shape)
        hs = np.bincount(cell, weights=h, minlength=shape[0] * shape[1]).reshape(shape)
        alone = max(best_cut(gs.sum(axis=1), hs.sum(axis=1), s)[0], best_cut(gs.sum(axis=0), hs.sum(axis=0), s)[0])
        found.append((cross_tree(gs, hs, s)[0] - alone, -i, -j))
    found = sorted((f for f in found if f[0] > 1e-9), reverse=True)[: s.pairs]
    return [(-i, -j) for _, i, j in found]


def fit_gam(features: np.ndarray, y: np.ndarray, s: Settings = Settings(), seed: int = 0) -> Model:
    """The model averaged over bags, each of which leaves out other rows to stop its boosting.

    Rows of one class only, or no rows, give the constant logit of their share, smoothed by one row of either class.
    """
    n, d = features.shape
    edges = [edges_of(features[:, k], s.bins) for k in range(d)]
    coarse = [edges_of(features[:, k], s.pair_bins) for k in range(d)]
    bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(edges, coarse, tables, [], bias)
    if n == 0 or y.min() == y.max():
        return model
    cells = [binned(features[:, k], edges[k]) for k in range(d)]
    rough = [binned(features[:, k], coarse[k]) for k in range(d)]
    sizes = [len(c) + 1 for c in coarse]
    rng = np.random.default_rng(seed)
    fold = rng.permutation(n) % max(1, round(1 / s.check_share))
    bags = []
    for bag in range(s.bags):
        boost = _Boost(y, np.full(n, bias), fold != bag % (fold.max() + 1) if n > 1 else np.ones(n, bool), s)
        main = boost.run(cells, [(len(e) + 1,) for e in edges], s.rounds, s.rate)
        bags.append((boost, main))
    # one choice of pairs for all bags, on the residuals of every row under the averaged tables
    mean = [np.mean([m[k] for _, m in bags], axis=0) for k in range(d)]
    p = sigmoid(bias + sum(mean[k][cells[k]] for k in range(d)))
    chosen = rank_pairs(rough, sizes, p - y, p * (1 - p), s)
    joint = [rough[i] * sizes[j] + rough[j] for i, j in chosen]
    shapes = [(sizes[i], sizes[j]) for i, j in chosen]
    extra = [boost.run(joint, shapes, s.pair_rounds, s.pair_rate) if chosen else [] for boost, _ in bags]
    model.tables = mean
    model.pairs = [(i, j, np.mean([e[k] for e in extra], axis=0)) for k, (i, j) in enumerate(chosen)]
    return centred(model, cells, joint)


def centred(model: Model, cells: list[np.ndarray], joint: list[np.ndarray]) -> Model:
    """The same model with tables of mean 0 over the fitted rows; the means go to the bias."""
    for k, c in enumerate(cells):
        mean = float(model.tables[k][c].mean())
        model.tables[k] = model.tables[k] - mean
        model.bias += mean
    for k, ((i, j, table), c) in enumerate(zip(model.pairs, joint)):
        mean = float(table.ravel()[c].mean())
        model.pairs[k] = (i, j, table - mean)
        model.bias += mean
    return model


# -- on Spark


def held_out(id_column: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in text_chunks(batch.column(2)):
            rows = text_features.measure(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).slice(first, len(texts)) for k in (0, 1)] + [pa.array(list(rows), pa.list_(pa.float64()))],
                ["doc_id", "label", "features"],
            )


def training_sample(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label_column: str = "quality",
    id_column: str = "doc_id", text_column: str = "text",
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most_rows`` labelled documents outside the held-out fold.

    They come in the order of a hash of their id. Rows with a null id or label are left out; of several labels of one
    document the largest counts, of several texts the one with the smallest features.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    known = (
        labels.where(F.col(label_column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(label_column).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.most_rows)
    )
    rows = (
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        .join(F.broadcast(known), "doc_id")  # bounded by most_rows
        .select("doc_id", "label", "text")
        .mapInArrow(_measures, f"doc_id {kind}, label int, features array<double>")
        .groupBy("doc_id").agg(F.min("features").alias("features"), F.max("label").alias("label"))
        .orderBy("doc_id").collect()
    )
    features = np.array([r.features for r in rows]).reshape(len(rows), len(text_features.NAMES))
    return features, np.array([r.label for r in rows], dtype=np.float64)


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label_column: str = "quality",
    id_column: str = "doc_id", text_column: str = "text",
) -> Model:
    return fit_gam(*training_sample(docs, labels, settings, label_column, id_column, text_column), settings)


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                score = sigmoid(model.logits(text_features.measure(texts)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(score)], ["id", "score"])

    return run


def scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every row, judged by its text alone: null is empty, repeated rows get a score each."""
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bins and pair_bins bound the tables
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        _scoring(shared), f"id {kind}, score double"
    )
