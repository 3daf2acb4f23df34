"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, of neighbouring words and of words
one apart, each present or not. FTRL-proximal gives every coordinate its own learning rate
and an L1 penalty: a hash has weight 0 until the evidence for it outgrows the penalty, so
what remains is a short list of weights, small enough to send to every task.

Learning reads a bounded sample of the labelled rows (``sample_rows``, the rows with the
smallest id hashes, so the sample does not depend on how the table is laid out); tasks hash
the texts, one task runs the sequential updates over the bounded sample. Scoring covers every
row and the whole of every text, row by row, without a shuffle.

Defined results: NULL and empty texts have no feature and get the score of the intercept.
Labels that are NULL teach nothing, nor does a doc_id whose labels contradict each other; equal
labels of a doc_id are one. A labelled doc_id that several rows have teaches with each of them.
With labels of one kind or none the score is the smoothed share of label 1, (k + 1) / (n + 2),
and :func:`keep_clean`, which then can tell no document from another, keeps every row. Extra
columns are ignored by :func:`score` and carried by :func:`keep_clean`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import fold, id_hash, table


@dataclass(frozen=True)
class FtrlOptions:
    """``bits`` of the hash space; ``alpha``, ``beta``, ``l1``, ``l2`` of FTRL-proximal;
    ``epochs`` over the sample; ``sample_rows``: most labelled rows to learn from;
    ``tokens``: what a word is; ``grams``: whether neighbours and skips are features;
    ``held``: words whose hashes a task remembers."""

    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 4
    sample_rows: int = 16_000
    tokens: str = r"[^\W_]+"
    grams: bool = True
    threshold: float = 0.5
    held: int = 300_000


class Hasher:
    """Distinct feature hashes of a text."""

    def __init__(self, opts: FtrlOptions):
        self.opts, self.known = opts, {}
        self.find, self.mask = re.compile(opts.tokens).findall, np.uint64((1 << opts.bits) - 1)

    def _words(self, text: str | None) -> np.ndarray:
        if len(self.known) > self.opts.held:
            self.known.clear()
        known, out = self.known, []
        for w in self.find(text.lower()) if text else ():
            h = known.get(w)
            if h is None:
                # spread, since crc32 alone is linear in its input
                h = known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def all(self, text: str | None) -> np.ndarray:
        """Hashes of every occurrence."""
        h = self._words(text)
        parts = [h >> np.uint64(40) & self.mask]
        if self.opts.grams and len(h) > 1:
            for step, salt in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F)):
                mixed = (h[:-step] ^ np.uint64(salt)) * np.uint64(0xE7037ED1A0B428DB) + h[step:]
                mixed *= np.uint64(0x8EBC6AF09C88C6E3)
                parts.append(mixed >> np.uint64(40) & self.mask)
        return np.concatenate(parts).astype(np.int64)

    def distinct(self, text: str | None) -> np.ndarray:
        return np.unique(self.all(text))


class Ftrl:
    """Sequential FTRL-proximal over binary features and a penalty-free intercept."""

    def __init__(self, opts: FtrlOptions):
        self.o = opts
        self.z, self.n = np.zeros((1 << opts.bits) + 1), np.zeros((1 << opts.bits) + 1)

    def _weights(self, at: np.ndarray) -> np.ndarray:
        z, o = self.z[at], self.o
        l1 = np.where(at == len(self.z) - 1, 0.0, o.l1)
        w = (np.sign(z) * l1 - z) / ((o.beta + np.sqrt(self.n[at])) / o.alpha + o.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, y: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self._weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.o.alpha * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, weights) of the coordinates that are not 0; the intercept is last."""
        w = self._weights(np.arange(len(self.z)))
        at = np.flatnonzero(w)
        return at, w[at]


@dataclass(frozen=True)
class LinearModel:
    """One sparse weight vector per class (a single one for yes/no)."""

    opts: FtrlOptions
    at: list[np.ndarray]
    weights: list[np.ndarray]
    intercepts: list[float]

    def dense(self) -> np.ndarray:
        out = np.zeros((1 << self.opts.bits, len(self.at)))
        for k, (at, w) in enumerate(zip(self.at, self.weights)):
            out[at, k] = w
        return out


def bounded_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(order, y, text) of at most ``rows`` labelled documents; ``labels`` holds (doc_id, y)."""
    picked = (
        labels.where(F.col("y").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("__other"))
        .where(F.col("y") == F.col("__other"))
        .select("doc_id", "y", id_hash("doc_id").alias("order"))
        .orderBy("order", "doc_id")
        .limit(rows)
    )
    # a doc_id that occurs more than once brings all its rows, up to twice the bound
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return found.orderBy("order", "doc_id", F.xxhash64("text")).limit(2 * rows)


def fit(sample: DataFrame, classes: int, opts: FtrlOptions) -> LinearModel:
    """One-against-rest models of ``y`` in 0..classes-1 (classes = 1: y is 0 or 1)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(opts)
        for b in batches:
            ids = [hasher.distinct(t).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("order"), b.column("doc_id"), b.column("y"), pa.array(ids, pa.binary())],
                ["order", "doc_id", "y", "ids"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (o, i, int(y), np.frombuffer(ids, dtype=np.int32))
            for b in batches
            for o, i, y, ids in zip(*(b.column(c).to_pylist() for c in ("order", "doc_id", "y", "ids")))
        ]
        rows.sort(key=lambda r: (r[0], r[1], r[2], len(r[3])))
        out = []
        for k in range(classes):
            target = [int(r[2] == (1 if classes == 1 else k)) for r in rows]
            n, hits = len(target), sum(target)
            if 0 < hits < n:
                model = Ftrl(opts)
                for _ in range(opts.epochs):
                    for r, y in zip(rows, target):
                        model.learn(r[3], y)
                at, w = model.sparse()
            else:
                at, w = np.array([1 << opts.bits]), np.array([np.log((hits + 1) / (n - hits + 1))])
            out.append(pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.int32()), pa.array(at), pa.array(w)], ["k", "at", "w"]))
        yield from out

    ids = sample.select("order", "doc_id", F.col("y").cast("int").alias("y"), "text").mapInArrow(
        hashed, "order long, doc_id long, y int, ids binary"
    )
    # one task on purpose: the updates are sequential and the sample is bounded
    got = ids.repartition(1).mapInArrow(learn, "k int, at long, w double").toPandas()
    places, weights, intercepts = [], [], []
    for k in range(classes):
        mine = got[got["k"] == k].sort_values("at")
        last = mine["at"] == 1 << opts.bits
        places.append(mine["at"][~last].to_numpy(np.int64))
        weights.append(mine["w"][~last].to_numpy())
        intercepts.append(float(mine["w"][last].sum()))
    return LinearModel(opts, places, weights, intercepts)


def log_odds(model: LinearModel):
    """A function from a text to the log-odds of each class, for use inside a task."""
    hasher, dense, base = Hasher(model.opts), model.dense(), np.array(model.intercepts)
    used = dense.any(axis=1)

    def run(text: str | None) -> np.ndarray:
        at = hasher.all(text)
        return dense[np.unique(at[used[at]])].sum(0) + base

    return run


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -700, 700))))


def score(docs: DataFrame, model: LinearModel, *carried: Column | str) -> DataFrame:
    """(carried..., score, predicted) of the column ``text``."""
    rows = docs.select(*carried, F.col("text").alias("__text"))
    own = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, limit = log_odds(model), model.opts.threshold
        for b in batches:
            s = np.array([_sigmoid(odds(t)[0]) for t in b.column("__text").to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in own), pa.array(s), pa.array((s >= limit).astype(np.int32))],
                [*own, "score", "predicted"],
            )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kinds}score double, predicted int")


def keep_clean(docs: DataFrame, model: LinearModel) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with all their columns; all rows if the
    model has no weight but its intercept."""
    if not len(model.at[0]):
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, limit = log_odds(model), model.opts.threshold
        for b in batches:
            clean = [_sigmoid(odds(t)[0]) < limit for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, opts: FtrlOptions = FtrlOptions()) -> LinearModel:
    """The model of ``labels.toxic`` from documents outside fold 0 of 5."""
    known = labels.where(fold("doc_id", 5) != 0).select("doc_id", F.col("toxic").alias("y"))
    return fit(bounded_sample(docs, known, opts.sample_rows), 1, opts)


def op7_hashed_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, "doc_id", (fold("doc_id", 5) == 0).alias("held_out"))
