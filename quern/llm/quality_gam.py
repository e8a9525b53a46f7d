"""Quality classifier: a generalised additive model with pairwise terms.

A score is the logistic of a sum of lookup tables: one table per feature over
its bins and one grid per chosen pair of features.  Tables are learned by
cyclic boosting: features are visited in turn, and each visit fits a shallow
tree (two splits) on the feature's bins to the current gradients and adds a
small step of it to the feature's table; then the pairs whose grids explain
most of what is left are boosted the same way (a split on each feature of the
pair).  Scoring finds the bins of a batch and adds table entries, vectorised.

Features come from the text alone: shares of symbols, bars, capitals,
punctuation, digits, distinct and repeated words, line shapes.

Training: labelled rows whose crc32 of the id, as text, mod 5 is not 0, at
most ``TRAIN_ROWS`` of them (a documented bound, taken in order of the id's
md5).  Only their features reach the driver, which fits the tables; every
other row is featurised and scored where it is read, with no shuffle.

Defined results: a null or empty text has features 0 and gets a score like any
other; labels other than 0 and 1, and labels without a document, are left out;
without labels of both kinds the score is the share of label 1 (0.5 without
labels); an id labelled twice counts with its lower label; null ids are held out
(no crc32) and scored; an empty table gives an empty one; other columns are
passed on by ``keep_good`` and not read by ``score``.
"""

from __future__ import annotations

import operator
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = ("log_words", "mean_word", "distinct_share", "repeat_share", "symbol_share", "bar_share", "capital_share",
            "exclaim_share", "stop_share", "comma_share", "digit_share", "ended_lines", "distinct_lines", "words_per_line",
            "symbol_words", "worst_distinct", "worst_symbols")
_SYMBOLS = "#*$%&<>=~^_{}[]\\/@"
_PART = 200  # words per part, for the worst parts of long texts


def features(text: str | None) -> list[float]:
    """Feature values of one whole text, in the order of ``FEATURES``."""
    t = text or ""
    w = t.split()
    n, c = len(w), len(t)
    if not n:
        return [0.0] * len(FEATURES)
    symbols = sum(map(t.count, _SYMBOLS))
    raw = t.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, string.ascii_uppercase.encode()))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    lines = [x for x in t.split("\n") if x.strip()]
    parts = [w[i:i + _PART] for i in range(0, n, _PART)]
    parts[-1] = w[-_PART:]  # the text's last words, none left out
    worst_d = min(len(set(p)) / len(p) for p in parts)
    worst_s = max(sum(map(p.count, _SYMBOLS + "|!")) / len(p) for p in map(" ".join, parts))
    return [float(np.log1p(n)), c / n, len(set(w)) / n, sum(map(operator.eq, w, w[1:])) / n, symbols / c, t.count("|") / n,
            capitals / c, t.count("!") / n, t.count(".") / n, t.count(",") / n, digits / c,
            sum(x.rstrip()[-1] in ".!?…:;\"'»”" for x in lines) / len(lines), len(set(lines)) / len(lines), n / len(lines),
            sum(x[-1] in _SYMBOLS for x in w) / n, worst_d, worst_s]


@dataclass
class Model:
    """Bin edges and tables; ``bias`` alone is a constant model."""
    bias: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, f], side="right")]
        coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], side="right") for p in self.pairs for f in p}
        for (a, b), g in zip(self.pairs, self.grids):
            z += g[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-z))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """(gain, last bin of the left side) of the best split of the bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    at = int(np.argmax(gain))
    return float(gain[at]), at


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Step per bin of a tree with up to two splits."""
    bounds = [0, len(g)]
    for _ in range(2):
        best = max(((*_best_cut(g[a:b], h[a:b], ridge), a) for a, b in zip(bounds, bounds[1:])), default=(0, 0, 0))
        if best[0] <= 1e-9:
            break
        bounds = sorted({*bounds, best[2] + best[1] + 1})
    out = np.zeros(len(g))
    for a, b in zip(bounds, bounds[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """(gain, step per cell) of the best tree that splits a grid by rows, then
    each side by columns (every row cut is tried: a pair may show no gain in
    its rows alone)."""
    best, whole = (0.0, np.zeros(g.shape)), g.sum() ** 2 / (h.sum() + ridge)
    for r in range(len(g) - 1):
        out, gain = np.zeros(g.shape), -whole
        for rows in (slice(0, r + 1), slice(r + 1, None)):
            gs, hs = g[rows].sum(0), h[rows].sum(0)
            _, c = _best_cut(gs, hs, ridge)
            for cols in (slice(0, c + 1), slice(c + 1, None)):
                gg, hh = gs[cols].sum(), hs[cols].sum()
                out[rows, cols] = gg / (hh + ridge)
                gain += gg ** 2 / (hh + ridge)
        if gain > best[0]:
            best = (float(gain), out)
    return best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, pair_bins: int = 10, n_pairs: int = 8,
        pair_rounds: int = 30, rate: float = 0.15, ridge: float = 2.0) -> Model:
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        return Model(float(np.log(share / (1 - share))))
    share = float(y.mean())
    m = Model(float(np.log(share / (1 - share))), [_edges(v, bins) for v in x.T], pair_edges=[_edges(v, pair_bins) for v in x.T])
    at = [np.searchsorted(e, v, side="right") for e, v in zip(m.edges, x.T)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    z = np.full(len(y), m.bias)
    for _ in range(rounds):
        for f, i in enumerate(at):
            p = 1 / (1 + np.exp(-z))
            step = rate * _tree(np.bincount(i, y - p, len(m.tables[f])), np.bincount(i, p * (1 - p), len(m.tables[f])), ridge)
            m.tables[f] += step
            z += step[i]
    wide = [np.searchsorted(e, v, side="right") for e, v in zip(m.pair_edges, x.T)]
    sizes = [len(e) + 1 for e in m.pair_edges]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(wide[a] * sizes[b] + wide[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
    p = 1 / (1 + np.exp(-z))
    gains = sorted(((_pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)), ridge)[0], a, b)
                    for a in range(len(sizes)) for b in range(a + 1, len(sizes))), reverse=True)
    m.pairs = [(a, b) for _, a, b in gains[:n_pairs]]
    m.grids = [np.zeros((sizes[a], sizes[b])) for a, b in m.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(m.pairs):
            p = 1 / (1 + np.exp(-z))
            step = rate * _pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)), ridge)[1]
            m.grids[k] += step
            z += step[wide[a], wide[b]]
    return m


def held_out(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``limit`` labelled rows outside the held-out fifth."""
    y = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
         .groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").cast("int").alias("y"))
         .orderBy(F.md5(F.col("labelled").cast("string")), "labelled").limit(limit))
    # At most ``limit`` (id, label) rows: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(y), F.col("doc_id") == F.col("labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])
    got = sorted(rows.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, x array<double>").collect())
    x = np.array([r[2] for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r[1] for r in got], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)], float).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["doc_id", "score"])
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(True)).alias("held_out"), "score")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, unchanged."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(at)], float).reshape(b.num_rows, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))
    return docs.mapInArrow(run, docs.schema)


def crc32_mod5(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5
