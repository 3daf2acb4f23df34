"""Language-model scores by a log-bilinear neural model trained with noise-contrastive
estimation.

The words before a token are mapped to vectors, turned by one matrix per distance and added
up; the result is matched with the vector and the bias of every possible next symbol. Symbols
are the most frequent words, the end of a text, and groups of rarer words that end alike; a
rare word's share of its group is its smoothed count. Symbols are dealt to classes, so that a
normalised probability is p(class | context) p(symbol | class, context) and costs two small
matrix products instead of one over the whole vocabulary.

Training never normalises: at either level the model learns to tell the true symbol from noise
drawn from the unigram counts. Training documents are dealt by hash into parts of about
``part_tokens`` tokens, in order of their hash, whatever files they come from; a task runs
mini-batches over the whole of its part, all from the same start, and Spark averages the models,
weighted by tokens. So what is learnt depends on the documents only, and each model that is
averaged has seen enough tokens to be one. A first round over one part of the documents gives the
second round, over all others, its start. Every training document is used once, and what is
added up grows with the corpus.

Counts cover every training document. Only ``dictionary`` words (the most frequent ones) are
held by tasks; rarer words leave the scoring pass as (row, word, n) and meet their counts in
a join, which has no hot keys since all frequent words are gone.

Tokens are the words of a text (split at blanks and U+0009..U+000D, A-Z lower-cased) and one
end. Defined results: a NULL text is empty (one token, its end). Without training documents
every count is 0 and all symbols are equally likely. Repeated rows are scored, and learned
from, each. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import fold, table, words, written

END = b""  # no word is empty
TILE = 64  # rows of one class that are multiplied together


@dataclass(frozen=True)
class BilinearOptions:
    """``side``: classes, and symbols in a class; ``groups`` of rare words; ``context`` words;
    ``dim`` of the vectors; ``noise`` samples for each token; ``batch`` tokens a step;
    ``rate`` of AdaGrad; ``first``: share of the documents in the first round (1/first);
    ``part_tokens``: training tokens of a part, one task's work;
    ``dictionary``: most words that a task holds; ``held``: distinct words that a task counts
    before it passes its counts on; ``chunk`` tokens scored together."""

    side: int = 64
    groups: int = 512
    context: int = 3
    dim: int = 16
    noise: int = 8
    batch: int = 8192
    rate: float = 0.15
    first: int = 8
    part_tokens: int = 8_000_000
    dictionary: int = 300_000
    held: int = 300_000
    chunk: int = 16_384
    seed: int = 7

    @property
    def symbols(self) -> int:
        return self.side * self.side


# ---------------------------------------------------------------------------- counts
def word_counts(texts: DataFrame, opts: BilinearOptions) -> DataFrame:
    """(word, n) over all rows of (text); the end of a text is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for b in batches:
            for text in b.column("text").to_pylist():
                held.update(words(text))
                held[END] += 1
                if len(held) > opts.held:
                    yield flush()
        yield flush()

    parts = texts.select("text").mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def group_of(word: bytes, groups: int) -> int:
    """The group of a rare word: by its last three bytes."""
    return zlib.crc32(word[-3:]) % groups


@dataclass(frozen=True)
class Lexicon:
    """What the tasks need of the counts: ``place`` of each dictionary word, its symbol, its
    count and the log10 of its share of its symbol; per group the log10 of its total; the
    counts of symbols."""

    place: dict[bytes, int]
    symbol: np.ndarray
    count: np.ndarray
    share: np.ndarray
    group_total: np.ndarray
    symbol_count: np.ndarray
    total: int
    distinct: int
    opts: BilinearOptions

    def encode(self, tokens: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """(dictionary place or -1 - group for each token, the tokens outside)."""
        places = np.fromiter(map(self.place.get, tokens, repeat(-1)), np.int64, len(tokens))
        outside = np.flatnonzero(places < 0)
        rare = [tokens[i] for i in outside]
        if rare:
            places[outside] = [-1 - group_of(w, self.opts.groups) for w in rare]
        return places, rare

    def symbols(self, places: np.ndarray) -> np.ndarray:
        first = self.opts.symbols - self.opts.groups
        return np.where(places >= 0, self.symbol[np.maximum(places, 0)], first - 1 - places)


def lexicon(counts: DataFrame, opts: BilinearOptions) -> Lexicon:
    """From the written table (word, n)."""
    head = opts.symbols - opts.groups
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # levels of n, finer than any two frequent words need: a cut that holds few enough words
    level = F.floor(F.log2("n") * 64)
    per_level = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    cut, room = None, opts.dictionary
    for r in per_level:
        room -= r["count"]
        if room < 0:
            break
        cut = r["level"]
    top = counts.where(level >= cut if cut is not None else F.lit(False)).toPandas()
    top = top.assign(end=top["word"] != END).sort_values(["end", "n", "word"], ascending=[True, False, True])
    known, n = top["word"].tolist(), top["n"].to_numpy(np.int64)
    if not known or known[0] != END:  # no training text
        known, n = [END, *known], np.concatenate([[0], n]).astype(np.int64)
    # shares: count + 1 of all rare words of a group, and 1 for words never seen
    of_head = counts.sparkSession.createDataFrame([(w,) for w in known[:head]], "word binary")
    rare = counts.join(F.broadcast(of_head), "word", "left_anti")  # at most ``symbols`` rows
    group = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(opts.groups))
    totals = np.ones(opts.groups)
    seen = np.zeros(opts.groups)
    for r in rare.groupBy(group.alias("g")).agg(F.sum(F.col("n") + 1).alias("t"), F.sum("n").alias("n")).collect():
        totals[r["g"]] += r["t"]
        seen[r["g"]] = r["n"]
    symbol = np.array([i if i < head else head + group_of(w, opts.groups) for i, w in enumerate(known)])
    share = np.where(symbol < head, 0.0, np.log10(n + 1.0) - np.log10(totals[np.maximum(symbol - head, 0)]))
    symbol_count = np.zeros(opts.symbols)
    symbol_count[: min(head, len(known))] = n[:head]
    symbol_count[head:] = seen
    return Lexicon(
        {w: i for i, w in enumerate(known)}, symbol, n, share, np.log10(totals), symbol_count,
        int(total[0] or 0), int(total[1]), opts,
    )


# ----------------------------------------------------------------------------- model
class Model:
    """Parameters in float32. Symbol s is number s // side of class s % side, so that classes
    are alike in frequency."""

    NAMES = ("vec", "turn", "cls", "cls_b", "out", "out_b")

    def __init__(self, lex: Lexicon):
        o = self.o = lex.opts
        rng = np.random.default_rng(o.seed)
        n = (lex.symbol_count + 0.5).reshape(o.side, o.side).T  # class, number
        self.p_cls = n.sum(1) / n.sum()
        self.p_out = n / n.sum(1, keepdims=True)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.vec = draw(o.symbols, o.dim)
        self.turn = np.stack([np.eye(o.dim, dtype=np.float32) / (1 + i) for i in range(o.context)])
        self.cls, self.out = draw(o.side, o.dim), draw(o.side, o.side, o.dim)
        self.cls_b = np.log(self.p_cls).astype(np.float32)
        self.out_b = np.log(self.p_out).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self


class Scorer:
    """A trained model for scoring: the vectors of all words turned for each distance, and the
    weights as they are multiplied."""

    def __init__(self, model: Model):
        self.side = model.o.side
        self.turned = [model.vec @ t for t in model.turn]
        self.cls, self.cls_b = np.ascontiguousarray(model.cls.T), model.cls_b
        self.out, self.out_b = np.ascontiguousarray(model.out.transpose(0, 2, 1)), model.out_b
        self.ones = np.ones(self.side, dtype=np.float32)

    def _log_sum(self, s: np.ndarray) -> np.ndarray:
        """log sum exp of each row."""
        if np.abs(s).max() < 60:  # neither end leaves float32
            return np.log(np.exp(s) @ self.ones)
        top = s.max(axis=1)
        return top + np.log(np.exp(s - top[:, None]).sum(axis=1))

    def log_probabilities(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Normalised natural-log probabilities (nearest word of a context first)."""
        side = self.side
        order, ends = _by_class(symbol % side, side)
        cls, num = symbol[order] % side, symbol[order] // side
        at = np.arange(len(order))
        q = sum(t.take(context[order, i], axis=0) for i, t in enumerate(self.turned))
        s = q @ self.cls + self.cls_b
        logp = s[at, cls] - self._log_sum(s)
        for c in range(side):
            a, b = ends[c], ends[c + 1]
            if a < b:
                t = q[a:b] @ self.out[c] + self.out_b[c]
                logp[a:b] += t[at[: b - a], num[a:b]] - self._log_sum(t)
        out = np.empty_like(logp)
        out[order] = logp
        return out


def _by_class(cls: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their class, and where each class begins (and the end)."""
    order = np.argsort(cls.astype(np.uint16), kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(cls, minlength=side))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Trainer:
    """Noise-contrastive estimation with AdaGrad."""

    def __init__(self, model: Model):
        self.m, self.rng = model, np.random.default_rng(model.o.seed)
        self.seen = {k: np.full_like(getattr(model, k), 1e-6) for k in Model.NAMES}
        self.tokens = 0

    def _step(self, name: str, at, grad: np.ndarray) -> None:
        p, g = getattr(self.m, name), self.seen[name]
        g[at] += grad * grad
        p[at] -= self.m.o.rate * grad / np.sqrt(g[at])

    def learn(self, context: np.ndarray, symbol: np.ndarray) -> None:
        m, o = self.m, self.m.o
        before = [m.vec.take(context[:, i], axis=0) for i in range(o.context)]
        q = sum(x @ m.turn[i] for i, x in enumerate(before))
        n, k = np.float32(len(q)), o.noise
        # rows in the order of (class, number), so that sums by either are runs of rows
        code = (symbol % o.side * o.side + symbol // o.side).astype(np.uint16)
        order = np.argsort(code, kind="stable")
        q, code = q.take(order, axis=0), code[order].astype(np.int64)
        cls = code // o.side
        starts = _runs(code)

        # which class: true rows against one draw of noise classes for all rows
        noise = _draw(m.p_cls[None], self.rng, k)[0]
        shift = m.cls_b - np.log(k * m.p_cls).astype(np.float32)
        v = m.cls.take(cls, axis=0)
        true = _sigmoid(_dots(q, v) + shift[cls]) - np.float32(1)
        false = _sigmoid(q @ m.cls[noise].T + shift[noise])
        dq = true[:, None] * v + false @ m.cls[noise]
        by_cls = _runs(cls)
        dv, db = np.zeros_like(m.cls), np.zeros_like(m.cls_b)
        dv[cls[by_cls]] = np.add.reduceat(true[:, None] * q, by_cls)
        db[cls[by_cls]] = np.add.reduceat(true, by_cls)
        np.add.at(dv, noise, false.T @ q)
        np.add.at(db, noise, false.sum(0))

        # which symbol of the class: true rows against a draw for each class
        flat, flat_b = m.out.reshape(-1, o.dim), m.out_b.reshape(-1)
        shift = flat_b - np.log(k * m.p_out).astype(np.float32).reshape(-1)
        v = flat.take(code, axis=0)
        true = _sigmoid(_dots(q, v) + shift[code]) - np.float32(1)
        dq += true[:, None] * v
        dw, dwb = np.zeros_like(flat), np.zeros_like(flat_b)
        dw[code[starts]] = np.add.reduceat(true[:, None] * q, starts)
        dwb[code[starts]] = np.add.reduceat(true, starts)
        # rows of a class in tiles of equal height, so that all classes are one product
        counts = np.bincount(cls, minlength=o.side)
        tiles = -(-counts // TILE)
        place = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
        tile = np.repeat(np.cumsum(tiles) - tiles, counts) + place // TILE
        of_tile = np.repeat(np.arange(o.side), tiles)
        at = tile * TILE + place % TILE
        qt = np.zeros((len(of_tile), TILE, o.dim), dtype=np.float32)
        full = np.zeros((len(of_tile), TILE, 1), dtype=np.float32)
        qt.reshape(-1, o.dim)[at], full.reshape(-1)[at] = q, 1
        noise = _draw(m.p_out, self.rng, k) + np.arange(o.side)[:, None] * o.side
        drawn = noise[of_tile]
        vt = flat[drawn]
        false = _sigmoid(qt @ vt.transpose(0, 2, 1) + shift[drawn][:, None, :]) * full
        dq += (false @ vt).reshape(-1, o.dim).take(at, axis=0)
        by_tile = _runs(of_tile)
        drawn = noise[of_tile[by_tile]]
        np.add.at(dw, drawn, np.add.reduceat(false.transpose(0, 2, 1) @ qt, by_tile))
        np.add.at(dwb, drawn, np.add.reduceat(false.sum(1), by_tile))

        back = np.empty_like(dq)
        back[order] = dq
        self._step("out", ..., dw.reshape(m.out.shape) / n)
        self._step("out_b", ..., dwb.reshape(m.out_b.shape) / n)
        self._step("cls", ..., dv / n)
        self._step("cls_b", ..., db / n)
        grads = np.concatenate([back @ m.turn[i].T for i in range(o.context)])
        for i in range(o.context):
            self._step("turn", i, before[i].T @ back / n)
        word = context.T.ravel().astype(np.uint16)
        order = np.argsort(word, kind="stable")
        word = word[order]
        starts = _runs(word)
        self._step("vec", word[starts], np.add.reduceat(grads.take(order, axis=0), starts) / n)
        self.tokens += len(q)


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _draw(probs: np.ndarray, rng: np.random.Generator, k: int) -> np.ndarray:
    """``k`` numbers from each row of ``probs``."""
    u = rng.random((len(probs), k))
    return (np.cumsum(probs, axis=1)[:, None, :] < u[:, :, None]).sum(2).clip(max=probs.shape[1] - 1)


def windows(symbols: list[np.ndarray], context: int) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, symbols) of texts, each encoded with its end; before a text stand ends."""
    pad = np.zeros(context, dtype=np.int64)
    row = np.concatenate([x for s in symbols for x in (pad, s)])
    inside = np.concatenate([x for s in symbols for x in (pad > 0, np.ones(len(s), dtype=bool))])
    at = np.flatnonzero(inside)
    return np.stack([row[at - 1 - i] for i in range(context)], axis=1), row[at]


def in_parts(texts: DataFrame, tokens: float, opts: BilinearOptions) -> DataFrame:
    """(text) of (doc_id, text) with about ``tokens`` tokens, dealt by hash into parts of about
    ``part_tokens``, in order of the hash."""
    parts = max(1, round(tokens / opts.part_tokens))
    dealt = texts.withColumn("at", F.xxhash64("doc_id", "text")).repartition(parts, "at")
    return dealt.sortWithinPartitions("at", "doc_id").select("text")


def _trained(texts: DataFrame, lex: Lexicon, start: np.ndarray, blocks: int = 16) -> np.ndarray:
    """The token-weighted mean of the models that tasks train from ``start``, one for each part."""
    o = lex.opts

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Model(lex).load(start))
        held, n = [], 0
        for b in batches:
            for text in b.column("text").to_pylist():
                s = lex.symbols(lex.encode([*words(text), END])[0])
                held.append(s)
                n += len(s)
                if n >= o.batch:
                    context, symbol = windows(held, o.context)
                    for i in range(0, n, o.batch):
                        trainer.learn(context[i : i + o.batch], symbol[i : i + o.batch])
                    held, n = [], 0
        if n:
            trainer.learn(*windows(held, o.context))
        if trainer.tokens:
            parts = np.array_split(trainer.m.flat().astype(np.float64) * trainer.tokens, blocks)
            yield _model_rows(list(range(blocks)), [trainer.tokens] * blocks, [p.astype(np.float32) for p in parts])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for block, n, part in zip(*(b.column(c).to_pylist() for c in ("block", "n", "part"))):
                s = sums.setdefault(block, [0, 0.0])
                s[0] += n
                s[1] = s[1] + np.frombuffer(part, dtype=np.float32).astype(np.float64)
        if sums:
            yield _model_rows(list(sums), [s[0] for s in sums.values()], [(s[1] / s[0]).astype(np.float32) for s in sums.values()])

    kind = "block int, n long, part binary"
    parts = texts.select("text").mapInArrow(train, kind).repartition(blocks, "block").mapInArrow(add, kind)
    got = sorted(parts.collect(), key=lambda r: r["block"])
    return np.concatenate([np.frombuffer(r["part"], dtype=np.float32) for r in got]) if got else start


def _model_rows(blocks: list[int], n: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array(n, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
        ["block", "n", "part"],
    )


def train(texts: DataFrame, lex: Lexicon) -> np.ndarray:
    """Parameters after both rounds over (doc_id, text); a document's round depends on its hash."""
    o = lex.opts
    first = F.pmod(F.xxhash64("text", "doc_id"), F.lit(o.first)) == 0
    warm = _trained(in_parts(texts.where(first), lex.total / o.first, o), lex, Model(lex).flat())
    return _trained(in_parts(texts.where(~first), lex.total * (o.first - 1) / o.first, o), lex, warm)


# --------------------------------------------------------------------------- scoring
def _scored(docs: DataFrame, lex: Lexicon, flat: np.ndarray) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, known, base, score, rare): log10 sums without what
    the counts of ``rare`` words (word, n) still add."""
    o = lex.opts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, number = Scorer(Model(lex).load(flat)), TaskContext.get().partitionId() << 40
        log_count = np.log10(lex.count + 1.0)
        for b in batches:
            texts, n = b.column("text").to_pylist(), b.num_rows
            tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, score, n_rare = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
            rare_words, rare_times = [], []
            held: list[tuple[int, np.ndarray]] = []
            size = 0

            def flush() -> None:
                context, symbol = windows([s for _, s in held], o.context)
                owner = np.repeat([i for i, _ in held], [len(s) for _, s in held])
                logp = np.concatenate(
                    [model.log_probabilities(context[i : i + o.chunk], symbol[i : i + o.chunk]) for i in range(0, len(symbol), o.chunk)]
                )
                score[:] += np.bincount(owner, logp, n) / np.log(10)
                held.clear()

            for i, text in enumerate(texts):
                places, rare = lex.encode([*words(text), END])
                inside, groups = places[places >= 0], -1 - places[places < 0]
                tokens[i] = len(places)
                known[i] = int((lex.count[inside] > 0).sum())
                base[i] = log_count[inside].sum()
                score[i] += lex.share[inside].sum() - lex.group_total[groups].sum()
                of_text = Counter(rare)
                rare_words += of_text
                rare_times += of_text.values()
                n_rare[i] = len(of_text)
                held.append((i, lex.symbols(places)))
                size += len(places)
                if size >= o.chunk:
                    flush()
                    size = 0
            if held:
                flush()
            pairs = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_times, pa.int64())], ["word", "n"])
            offsets = np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32)
            rare_rows = pa.ListArray.from_arrays(pa.array(offsets), pairs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + n)), b.column("doc_id"), b.column("held_out"), pa.array(tokens),
                    pa.array(known), pa.array(base), pa.array(score), rare_rows,
                ],
                ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare"],
            )
            number += n

    of = docs.schema["doc_id"].dataType.simpleString()
    kind = f"row long, doc_id {of}, held_out boolean, n_tokens long, known long, base double, score double, rare array<struct<word: binary, n: bigint>>"
    return docs.select("doc_id", "held_out", "text").mapInArrow(run, kind)


def score_texts(docs: DataFrame, opts: BilinearOptions = BilinearOptions()) -> DataFrame:
    """One row per row of (doc_id, text, held_out), learning from those not held out:
    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    training = docs.where(~F.col("held_out")).select("doc_id", "text")
    counts = written(word_counts(training, opts), "word_counts")
    lex = lexicon(counts, opts)
    rows = written(_scored(docs, lex, train(training, lex)), "scored")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("k"))
    found = rare.join(counts, "word").groupBy("row").agg(
        F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("logs")
    )
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    norm = float(np.log10(lex.total + lex.distinct + 1))
    return rows.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )


def op4_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs.select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held_out")))
