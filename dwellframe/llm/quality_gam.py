"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; a look-up table gives every bin its share of the log-odds. The tables
are learned by cyclic boosting: feature after feature a shallow tree is fitted to what the others leave
unexplained, and its leaves are added to the table. Then the same is done for the pairs of features with the
most left to explain, on a grid of bins. A text is scored by adding up look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from dwellframe.llm.common import labelled_sample, map_texts

FEATURES = (
    "log_words word_bytes symbols capitals digits stops exclamations white lines_per_word non_ascii distinct_words "
    "top_word repeated_lines factor line_words longest_word short_words entropy"
).split()

#: Bound of the training sample, in documents.
SAMPLE = 16_000
BINS, PAIR_BINS = 32, 8
CYCLES, PAIR_CYCLES, PAIRS = 120, 40, 6
RATE, RIDGE, LEAST_ROWS = 0.15, 1.0, 8.0


def features(text: str | None, compress) -> list[float]:
    """The values of ``FEATURES``; all 0 for a null or empty text. Read over the whole text."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, words = len(raw), raw.split()
    of = lambda chars: counts[list(chars)].sum() / n
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    ids: dict[bytes, int] = {}
    at = [ids.setdefault(w, len(ids)) for w in words]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    p = counts[counts > 0] / n
    return [
        float(np.log1p(len(words))), float(sizes.mean()), of(b"#*$%&|<>"), counts[65:91].sum() / n, counts[48:58].sum() / n, of(b".,"),
        of(b"!"), of(b" \t\n\r\x0b\x0c"), counts[10] / max(1, len(words)), counts[128:].sum() / n, len(ids) / max(1, len(words)),
        float(np.bincount(at).max() / len(words)) if words else 0.0, 1 - len(set(lines)) / max(1, len(lines)), n / len(compress(raw)),
        float(np.log1p(len(words) / max(1, len(lines)))), float(np.log1p(sizes.max())), float((sizes <= 3).mean()), float(-(p * np.log2(p)).sum()),
    ]


def _leaf_values(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """Values of a tree over ordered bins: sums of gradients and curvatures, split where the gain is largest."""
    if depth and len(g) > 1:
        left = [np.cumsum(x)[:-1] for x in (g, h, n)]
        right = [x.sum() - part for x, part in zip((g, h, n), left, strict=True)]
        gain = left[0] ** 2 / (left[1] + RIDGE) + right[0] ** 2 / (right[1] + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
        gain[(left[2] < LEAST_ROWS) | (right[2] < LEAST_ROWS)] = 0
        if gain.max() > 1e-9:
            k = int(gain.argmax()) + 1
            return np.concatenate([_leaf_values(g[:k], h[:k], n[:k], depth - 1), _leaf_values(g[k:], h[k:], n[k:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + RIDGE))


def _grid_values(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over a grid: the best cut of one axis, then of the other on either side. Returns values and gain."""
    best, gain = np.full(g.shape, g.sum() / (h.sum() + RIDGE)), 0.0
    fit = lambda v, g, h: float((v * g).sum() - (v**2 * (h + RIDGE / h.size)).sum() / 2)
    for axis in (0, 1):
        a, b, c = (x if axis == 0 else x.T for x in (g, h, n))
        for k in range(1, len(a)):
            halves = [_leaf_values(a[s].sum(0), b[s].sum(0), c[s].sum(0), 1) for s in (slice(k), slice(k, None))]
            values = np.repeat(np.stack(halves), [k, len(a) - k], axis=0)
            if (now := fit(values, a, b)) > gain:
                best, gain = values if axis == 0 else values.T, now
    return best, gain


@dataclass
class Additive:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Base, plus a look-up for each feature, plus one for each pair."""
        out = np.full(len(x), self.base)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, k], side="right")]
        if self.pairs:
            grid = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.pair_edges)]
            for a, b, table in self.pairs:
                out += table[grid[a], grid[b]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, k], cuts)) for k in range(x.shape[1])]


def fit_additive(x: np.ndarray, y: np.ndarray) -> Additive:
    """Learn all tables from features ``x`` and labels ``y`` (0 or 1)."""
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    made = Additive(float(np.log(share / (1 - share))), _edges(x, BINS), [])
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(made.edges)]
    made.tables = [np.zeros(len(e) + 1) for e in made.edges]
    z = np.full(len(y), made.base)
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, made.tables, strict=True)]
    for _ in range(CYCLES):
        for b, table, n in zip(bins, made.tables, sizes, strict=True):
            p = 1 / (1 + np.exp(-z))
            step = RATE * _leaf_values(np.bincount(b, y - p, len(table)), np.bincount(b, p * (1 - p), len(table)), n, 2)
            table += step
            z += step[b]
    made.pair_edges = _edges(x, PAIR_BINS)
    grid = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(made.pair_edges)]

    def sums(a, b):
        p = 1 / (1 + np.exp(-z))
        shape = len(made.pair_edges[a]) + 1, len(made.pair_edges[b]) + 1
        cell = grid[a] * shape[1] + grid[b]
        return cell, [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p), np.ones(len(y)))]

    gains = sorted(((_grid_values(*sums(a, b)[1])[1], a, b) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    made.pairs = [(a, b, np.zeros((len(made.pair_edges[a]) + 1, len(made.pair_edges[b]) + 1))) for gain, a, b in gains[:PAIRS] if gain > 0]
    for _ in range(PAIR_CYCLES):
        for a, b, table in made.pairs:
            cell, parts = sums(a, b)
            step = RATE * _grid_values(*parts)[0]
            table += step
            z += step.ravel()[cell]
    return made


def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: Column, rows: int = SAMPLE) -> Additive | None:
    """Learn from at most ``rows`` labelled texts, whose features come from Spark; None without both labels."""

    def make():
        compress = _compressor()
        return lambda texts: [[features(t, compress) for t in texts]]

    sample = labelled_sample(docs, labels, "quality", train_rows, rows)
    got = map_texts(sample, make, [T.StructField("x", T.ArrayType(T.DoubleType()))], keep=("y",)).collect()
    if len({r["y"] for r in got}) < 2:
        return None
    got.sort(key=lambda r: (r["y"], r["x"]))
    return fit_additive(np.array([r["x"] for r in got]), np.array([float(r["y"]) for r in got]))


def score_quality(docs: DataFrame, model: Additive | None) -> DataFrame:
    """doc_id and ``score`` (0 to 1) of every row of ``docs``.

    Row by row: a null text counts as empty; a null id stays null; repeated rows get equal scores; other
    columns are ignored; without a model (no labels of both kinds) every score is 0.5.
    """

    def make():
        compress = _compressor()

        def work(texts):
            x = np.array([features(t, compress) for t in texts])
            return [model.probability(x).tolist() if model is not None else [0.5] * len(texts)]

        return work

    return map_texts(docs, make, [T.StructField("score", T.DoubleType())])
