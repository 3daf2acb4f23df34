"""Mixing to target weights with soft domain membership.

Nobody knows a document's domain; a classifier learnt from a labelled table gives it a
posterior over domains. A document sampled at rate w then brings w * tokens * p_k expected
tokens to domain k. The rates are the nonnegative least-squares fit of these totals to the
targets, changed as little as possible from rate 1, by projected gradient: each round is one
aggregate of the domain totals over all documents, one step, and the projection of all rates to
at least zero.

Steps add up before they are projected, so a rate is max(0, 1 - p . pull) with one ``pull`` number
per domain, and no rates are stored between rounds. The step is scaled by the K x K matrix
sum(n p p') over the documents with a positive rate, which the same aggregate adds up, and
halved until the objective falls: as long as no rate ends at zero, one step meets the targets.
``keep`` weighs a rate's distance from 1 against the squares of what the totals are off.

**Posteriors** are calibrated: the classifier learns from four fifths of the labelled sample, a
slope and one shift per domain from half of the rest, and on the other half it is measured how
far the domains' mean posteriors are off (``DomainModel.off``).

Defined results: NULL and empty texts have no tokens, the posterior of the intercepts, and
take part with weight 0. A domain without any expected tokens cannot be filled and is left
out of the fit. Targets that no nonnegative rates reach are met as closely as they can be:
``target_gap`` says on every row how far the worst domain is off, as a share of its
target (of a thousandth of all tokens, if the target is smaller).
Repeated rows are documents of their own; rows without doc_id are mixed too. Extra columns are
ignored. With an empty table the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import fold, id_hash, table, words, written
from txengine.llm.hashed_ftrl import FtrlOptions, LinearModel, bounded_sample, fit, log_odds


@dataclass(frozen=True)
class MixOptions:
    """``weights``: domain -> share of all tokens; ``total``: tokens wanted, None: as many as
    there are; the fit ends when every domain is within ``tolerance`` of its target, when a step
    changes nothing, or after ``rounds`` aggregates; ``keep``: see above; ``ridge`` holds the
    calibration near the classifier's own log-odds; ``learner``: options of the classifier, whose
    ``sample_rows`` bounds the labelled rows it learns from."""

    weights: dict[str, float] = field(default_factory=lambda: {"clean": 0.9, "low": 0.06, "toxic": 0.04})
    total: float | None = None
    tolerance: float = 1e-3
    rounds: int = 60
    keep: float = 1e-6
    ridge: float = 1e-2
    learner: FtrlOptions = FtrlOptions(tokens=r"[^\W_]+|[^\w\s]+", grams=False, bits=18)


@dataclass(frozen=True)
class DomainModel:
    """Posteriors are softmax(slope * log-odds + shift); ``off``: domain -> mean posterior minus
    share, over ``judged`` labelled rows that neither the classifier nor the calibration saw."""

    linear: LinearModel
    slope: float
    shift: np.ndarray
    off: dict[str, float]
    judged: int

    def posterior(self, odds: np.ndarray) -> np.ndarray:
        z = self.slope * np.clip(odds, -30, 30) + self.shift
        p = np.exp(z - z.max(axis=-1, keepdims=True))
        return p / p.sum(axis=-1, keepdims=True)


def domain_of_labels() -> Column:
    """The domain that a row of ``labels`` states: toxic, else low quality, else clean."""
    return (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
        .when((F.col("toxic") == 0) & (F.col("quality") == 1), "clean")
    )


def calibration(odds: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The slope and shifts that make softmax(slope * odds + shift) most likely, by Newton steps;
    ``ridge`` (a share of a row each) pulls them to 1 and 0."""
    k = odds.shape[1]
    x = np.concatenate([odds[:, :, None], np.broadcast_to(np.eye(k), (len(odds), k, k))], axis=2)
    start = np.concatenate([[1.0], np.zeros(k)])
    theta = start.copy()
    for _ in range(50):
        z = x @ theta
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = np.einsum("ik,ikj->j", p, x) - x[np.arange(len(y)), y].sum(0) + ridge * (theta - start)
        mean = np.einsum("ik,ikj->ij", p, x)
        curve = np.einsum("ik,ikj,ikl->jl", p, x, x) - mean.T @ mean + ridge * np.eye(k + 1)
        step = np.linalg.solve(curve, grad)
        theta -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), theta[1:]


def fit_domains(docs: DataFrame, labelled: DataFrame, opts: MixOptions) -> DomainModel:
    """A one-against-rest classifier from (doc_id, domain), calibrated; domains that have no
    weight and NULLs teach nothing, nor does a doc_id with two domains."""
    names = list(opts.weights)
    y = F.lit(None).cast("int")
    for k, name in enumerate(names):
        y = F.when(F.col("domain") == name, F.lit(k)).otherwise(y)
    known = labelled.select("doc_id", y.alias("y"))
    sample = written(bounded_sample(docs, known, opts.learner.sample_rows), "labelled")
    linear = fit(sample.where(fold("doc_id", 5) != 0), len(names), opts.learner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = log_odds(linear)
        for b in batches:
            rows = [odds(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("half"), b.column("y"), pa.array(rows, pa.list_(pa.float64()))], ["half", "y", "odds"])

    rest = sample.where(fold("doc_id", 5) == 0).select(fold("doc_id", 10).alias("half"), "y", "text")
    got = rest.mapInArrow(run, "half long, y int, odds array<double>").toPandas()  # a fifth of the bounded sample
    odds = np.array(got["odds"].tolist(), dtype=np.float64).reshape(len(got), len(names))
    truth, own = got["y"].to_numpy(np.int64), got["half"].to_numpy() == 0
    slope, shift = calibration(np.clip(odds[own], -30, 30), truth[own], opts.ridge)
    model = DomainModel(linear, slope, shift, {}, int((~own).sum()))
    if model.judged:
        share = np.bincount(truth[~own], minlength=len(names)) / model.judged
        model.off.update(zip(names, (model.posterior(odds[~own]).mean(0) - share).tolist()))
    return model


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """(doc_id, n_tokens, p) of (doc_id, text): ``p`` has one number per domain, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = log_odds(model.linear)
        for b in batches:
            texts = b.column("text").to_pylist()
            p = [model.posterior(odds(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(words(t)) for t in texts], pa.int64()),
                    pa.array(p, pa.list_(pa.float64())),
                ],
                ["doc_id", "n_tokens", "p"],
            )

    of = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {of}, n_tokens long, p array<double>")


def _rates(p: np.ndarray, pull: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, 1.0 - p @ pull)


def _totals(rows: DataFrame, k: int, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Expected tokens of each domain at the rates under ``pull``, sum(n p p') over the documents
    with a positive rate, and sum(n rate^2)."""
    names = [f"t{i}" for i in range(k * (k + 1) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, curve, squares = np.zeros(k), np.zeros((k, k)), 0.0
        for b in batches:
            p = b.column("p").flatten().to_numpy().reshape(-1, k)
            n = b.column("n_tokens").to_numpy().astype(np.float64)
            w = _rates(p, pull)
            total += (n * w) @ p
            curve += (p * np.where(w > 0, n, 0.0)[:, None]).T @ p
            squares += float(n @ (w * w))
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*total, *curve.ravel(), squares)], names)

    parts = rows.select("n_tokens", "p").mapInArrow(run, ", ".join(f"{n} double" for n in names))
    got = np.array([x or 0.0 for x in parts.agg(*(F.sum(n) for n in names)).first()])
    return got[:k], got[k:-1].reshape(k, k), float(got[-1])


def fit_pull(rows: DataFrame, opts: MixOptions) -> tuple[np.ndarray, float, int]:
    """The pull of the fit over the written posteriors, how far the worst domain stays off its
    target, as a share of it, and how many aggregates it took."""
    k = len(opts.weights)
    share = np.array(list(opts.weights.values()), dtype=np.float64)
    have, curve, squares = _totals(rows, k, np.zeros(k))
    target = share / share.sum() * (have.sum() if opts.total is None else opts.total)
    fills = have > 0
    hold = opts.keep * np.where(fills, have, 1.0)

    def gap(total: np.ndarray) -> float:
        return float(max((np.abs(total - target)[fills] / np.maximum(target[fills], 1e-3 * have.sum())), default=0.0))

    pull, now, rounds = np.zeros(k), have, 1
    objective = squares / 2
    while gap(now) > opts.tolerance and rounds < opts.rounds:
        off = np.where(fills, now - target - hold * pull, 0.0)
        step = np.linalg.solve(curve + np.diag(hold), off)
        part = 1.0
        while True:
            to = pull + part * step
            then, curve_then, squares = _totals(rows, k, to)
            rounds += 1
            falls = squares / 2 + target[fills] @ to[fills] + (hold * to**2).sum() / 2
            if falls <= objective - 1e-4 * part * (off @ step) or rounds >= opts.rounds or part < 1e-3:
                break
            part /= 2
        if falls >= objective - 1e-12 * abs(objective):
            break
        pull, now, curve, objective = to, then, curve_then, falls
    return pull, gap(now), rounds


def mix(docs: DataFrame, model: DomainModel, opts: MixOptions = MixOptions()) -> DataFrame:
    """One row per document: doc_id, n_tokens, p_<domain>..., rate, copies (the rate rounded up or
    down by the document's hash, so that copies are the rate on average), target_gap."""
    rows = written(posteriors(docs, model), "posteriors")
    (pull, gap, _), k = fit_pull(rows, opts), len(opts.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column("p").flatten().to_numpy().reshape(-1, k)
            rate = _rates(p, pull)
            copies = np.floor(rate + b.column("u").to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_tokens"), *(pa.array(p[:, i]) for i in range(k)), pa.array(rate), pa.array(copies)],
                ["doc_id", "n_tokens", *(f"p_{x}" for x in opts.weights), "rate", "copies"],
            )

    of = rows.schema["doc_id"].dataType.simpleString()
    kinds = "".join(f"p_{x} double, " for x in opts.weights)
    u = (id_hash("doc_id") / F.lit(float(1 << 32))).alias("u")
    out = rows.select("*", u).mapInArrow(run, f"doc_id {of}, n_tokens long, {kinds}rate double, copies long")
    return out.withColumn("target_gap", F.lit(gap))


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, opts = table(spark, sf_dir, "documents").select("doc_id", "text"), MixOptions()
    labelled = table(spark, sf_dir, "labels").select("doc_id", domain_of_labels().alias("domain"))
    return mix(docs, fit_domains(docs, labelled, opts), opts)
