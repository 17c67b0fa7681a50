"""Language identification by a convolutional network over bytes, trained in numpy.

A window of bytes is embedded, filters of several widths slide over it, each filter's largest response is
kept, and a softmax over the languages follows. A text is cut into windows of one length, all of them are
scored in batches, and their probabilities are averaged by the bytes they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import map_texts, stage

WINDOW = 128
WIDTHS = (2, 3, 4)
#: Windows convolved at once: the responses of a batch stay in the cache.
BATCH = 48
#: Bounds of the training sample: documents for each language, and windows spread evenly over each of them.
SAMPLE_DOCS = 1200
SAMPLE_WINDOWS = 4
#: Up to so many languages their levels are sent to all tasks, else joined by shuffle.
FEW_LANGUAGES = 100_000

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def windows_of(raw: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text as bytes (the last padded with 0), and how many bytes each holds."""
    n = max(1, -(-len(raw) // size))
    held = np.zeros(n * size, np.uint8)
    held[: len(raw)] = np.frombuffer(raw, np.uint8)
    weight = np.full(n, size)
    weight[-1] = len(raw) - (n - 1) * size
    return held.reshape(n, size), weight


@dataclass
class ByteNet:
    """``filters`` has one column per filter, for the bytes of the widest; a narrower filter's lower rows stay 0."""

    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    shifts: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], size: int = 6, filters: int = 16, seed: int = 7) -> ByteNet:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        columns = filters * len(WIDTHS)
        net = cls(
            languages, normal(256, size, scale=0.5), normal(max(WIDTHS) * size, columns, scale=0.3), np.zeros(columns, np.float32),
            normal(columns, len(languages), scale=0.1), np.zeros(len(languages), np.float32),
        )
        net.filters *= net.mask()
        return net

    def mask(self) -> np.ndarray:
        """1 where a filter of its width has a weight."""
        rows, columns = self.filters.shape
        width = np.repeat(WIDTHS, columns // len(WIDTHS))
        return (np.arange(rows)[:, None] < width * self.embed.shape[1]).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shifts, self.dense, self.bias]

    def _responses(self, x: np.ndarray) -> np.ndarray:
        """windows x places x filters; past the end of a window come zero vectors."""
        e = self.embed[x]
        n, size, d = e.shape
        reach = max(WIDTHS)
        e = np.concatenate([e.reshape(n, size * d), np.zeros((n, (reach - 1) * d), np.float32)], axis=1)
        patches = np.ascontiguousarray(sliding_window_view(e, reach * d, axis=1)[:, ::d])
        return (patches.reshape(-1, reach * d) @ self.filters).reshape(n, size, -1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = [self._responses(x[i : i + BATCH]).max(axis=1) for i in range(0, len(x), BATCH)]
        return softmax(np.maximum(np.concatenate(out) + self.shifts, 0) @ self.dense + self.bias)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of ``parameters``."""
        n, d, reach = len(x), self.embed.shape[1], max(WIDTHS)
        r = self._responses(x)
        at = r.argmax(axis=1)
        hidden = np.maximum(np.take_along_axis(r, at[:, None], 1)[:, 0] + self.shifts, 0)
        error = softmax(hidden @ self.dense + self.bias)
        error[np.arange(n), y] -= 1
        error /= n
        g = (error @ self.dense.T) * (hidden > 0)
        place = at[:, :, None] + np.arange(reach)  # windows x filters x reach: the bytes under each best response
        inside = place < x.shape[1]
        under = x[np.arange(n)[:, None, None], np.minimum(place, x.shape[1] - 1)]
        seen = (self.embed[under] * inside[..., None]).reshape(n, -1, reach * d)
        to_bytes = (g[:, :, None] * self.filters.T).reshape(n, -1, reach, d) * inside[..., None]
        g_embed = np.stack([np.bincount(under.ravel(), to_bytes[..., k].ravel(), 256) for k in range(d)], axis=1)
        return [g_embed, np.einsum("nfk,nf->kf", seen, g) * self.mask(), g.sum(0), hidden.T @ error, error.sum(0)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, names: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.004, seed: int = 7) -> ByteNet:
    """Fit by Adam. Each language weighs alike: rows are drawn so that all are as frequent as the largest."""
    languages = sorted(set(names.tolist()))
    y = np.searchsorted(languages, names)
    net, rng = ByteNet.new(languages, seed=seed), np.random.default_rng(seed)
    held = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    most, step = np.bincount(y).max(), 0
    for _ in range(epochs):
        order = np.concatenate([np.resize(rng.permutation(np.flatnonzero(y == k)), most) for k in range(len(languages))])
        rng.shuffle(order)
        for i in range(0, len(order), batch):
            step += 1
            take = order[i : i + batch]
            for p, g, (m, v) in zip(net.parameters(), net.gradients(x[take], y[take]), held, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def sample_windows(docs: DataFrame, train_rows: Column, per_language: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS) -> DataFrame:
    """(raw, lang): windows spread evenly over the first ``per_language`` documents of each language by a hash of the id.

    Rows with a null id, text or lang take no part; of a repeated id with one lang the first text by bytes does. A hash of
    the id, spread over its whole range, is cut at a level that keeps some more than are needed, so no task ranks a whole
    language. Every lang value is learned, however rare.
    """
    from pyspark.sql import Window

    rows = docs.filter(train_rows & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("h"))
    # a level that ten standard deviations keep from giving too few
    share = F.least(F.lit(1.0), (per_language + 10 * per_language**0.5 + 10) / F.col("n"))
    counts = rows.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"))
    cuts = stage(counts.select("of", (share * (1 << 40)).alias("cut")), "levels")
    few = F.broadcast(cuts) if cuts.count() <= FEW_LANGUAGES else cuts
    near = rows.join(few, (F.col("lang") == F.col("of")) & (F.col("h") < F.col("cut")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    once = near.groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text"))
    texts = once.withColumn("place", place).filter(F.col("place") <= per_language)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws, langs = [], []
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                spare = max(0, len(raw) - WINDOW)
                for at in sorted({spare * k // max(1, windows - 1) for k in range(windows)}):
                    raws.append(raw[at : at + WINDOW])
                    langs.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()), pa.array(langs, pa.string())], ["raw", "lang"])

    return texts.select("text", "lang").mapInArrow(cut_out, "raw binary, lang string")


def fit_language(docs: DataFrame, train_rows: Column, **bounds: int) -> ByteNet | None:
    """Train on a bounded sample of labelled documents; None if there is none."""
    got = sorted((bytes(r["raw"]), r["lang"]) for r in sample_windows(docs, train_rows, **bounds).collect() if r["raw"])
    if not got:
        return None
    x = np.concatenate([windows_of(raw)[0] for raw, _ in got])
    return train(x, np.array([lang for _, lang in got]))


def predict_language(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """doc_id, lang_pred and score (mean probability of that language) for every row of ``docs``.

    Row by row: ``und`` with score 0 if the text is null or has no letter, or if nothing was learned; a
    null id stays null; repeated rows get equal results; equal probabilities go to the first language by
    name; other columns are ignored. Every byte of a text lies in one window.
    """

    def make():
        def work(texts):
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            rows = [k for k, t in enumerate(texts) if net is not None and t is not None and any(map(str.isalpha, t))]
            if rows:
                cut = [windows_of(texts[k].encode()) for k in rows]
                starts = np.concatenate([[0], np.cumsum([len(w) for _, w in cut])[:-1]])
                weight = np.concatenate([w for _, w in cut])
                p = net.probabilities(np.concatenate([x for x, _ in cut])).astype(float) * weight[:, None]
                mean = np.add.reduceat(p, starts) / np.add.reduceat(weight, starts)[:, None]
                for k, best, score in zip(rows, mean.argmax(axis=1), mean.max(axis=1), strict=True):
                    names[k], scores[k] = net.languages[best], min(1.0, float(score))
            return [names, scores]

        return work

    return map_texts(docs, make, FIELDS)
