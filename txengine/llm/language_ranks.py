"""Language by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams, most frequent first
(ties by the n-gram). A text's own list is compared with each profile by the out-of-place
distance: how far each n-gram's rank is from its rank in the profile, the list's length if
it is missing there. The nearest language wins (ties by name).

Learning counts every n-gram of every training text: tasks count, Spark adds up per
(language, n-gram) and keeps the top of each language before its window. Only the profiles
(languages x ``size`` rows) reach the driver and the tasks; that is bounded by the number of
language codes, which is checked.

Words are maximal runs of letters of the lower-cased text, padded by blanks, so an n-gram
knows where a word begins or ends. An n-gram of up to three characters is packed into one
64-bit number in reading order.

Defined results: NULL texts and texts without a letter are ``und`` with score 0, and so is
everything if there is no training text. Texts of any length are read whole. Rows are scored
one by one, so repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txengine.llm.common import fold, table

BETWEEN = re.compile(r"[\W\d_]")
UNKNOWN = "und"


@dataclass(frozen=True)
class RankOptions:
    """``size``: n-grams in a profile and in a text's list; ``longest`` n-gram (1 to 3);
    ``max_languages`` that may be learned; ``held``: characters that a task holds before it
    passes its counts on, and of a long text that it reads at a time."""

    size: int = 300
    longest: int = 3
    max_languages: int = 2000
    held: int = 2_000_000


class Packer:
    """n-grams of a text as packed numbers, by array operations over its characters."""

    def __init__(self, opts: RankOptions):
        self.longest, self.part = opts.longest, opts.held
        self.letter = np.array([chr(i).isalpha() for i in range(1 << 16)])

    def _is_letter(self, c: np.ndarray) -> np.ndarray:
        out = self.letter[np.minimum(c, 0xFFFF)]
        for x in np.unique(c[c > 0xFFFF]):
            out[c == x] = chr(x).isalpha()
        return out

    def characters(self, text: str) -> np.ndarray:
        """Code points with one blank for each run of other characters than letters, and a
        blank at either end; empty without a letter."""
        raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = self._is_letter(raw)
        if not letter.any():
            return raw[:0].astype(np.int64)
        before = np.concatenate(([True], letter[:-1]))
        c = np.where(letter, raw, 32).astype(np.int64)
        return c[letter | before]

    def _grams(self, text: str) -> np.ndarray:
        c = self.characters(text)
        inside = np.flatnonzero(c != 32)
        out = [c[inside] << 42]
        if self.longest > 1:
            out.append(c[:-1] << 42 | c[1:] << 21)
        if self.longest > 2:
            out.append(c[inside - 1] << 42 | c[inside] << 21 | c[inside + 1])
        return np.concatenate(out)

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(distinct n-grams ascending, how often each occurs). A text that is very long is
        read in parts that end between words."""
        parts, at = [], 0
        while at < len(text):
            cut = BETWEEN.search(text, at + self.part)
            end = cut.start() if cut else len(text)
            parts.append(np.unique(self._grams(text[at:end]), return_counts=True))
            at = end
        if len(parts) == 1:
            return parts[0]
        grams = np.concatenate([g for g, _ in parts] or [np.zeros(0, np.int64)])
        uniq, where = np.unique(grams, return_inverse=True)
        n = np.bincount(where, np.concatenate([n for _, n in parts]), len(uniq)) if parts else uniq
        return uniq, n.astype(np.int64)


def gram_counts(training: DataFrame, opts: RankOptions = RankOptions()) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held, chars = Packer(opts), {}, 0

        def flush() -> pa.RecordBatch:
            found = [(lang, *packer.counts("\n".join(texts))) for lang, texts in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, g, _ in found for _ in range(len(g))], pa.string()),
                    pa.array(np.concatenate([g for _, g, _ in found])),
                    pa.array(np.concatenate([n for _, _, n in found])),
                ],
                ["lang", "gram", "n"],
            )

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                held.setdefault(lang, []).append(text)
                chars += len(text)
                if chars > opts.held:
                    yield flush()
                    chars = 0
        if held:
            yield flush()

    rows = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    parts = rows.mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Profiles:
    """Languages by name, all n-grams of any profile, and the rank of each in each."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    opts: RankOptions = field(default_factory=RankOptions)

    def predict(self, uniq: np.ndarray, n: np.ndarray) -> tuple[str, float]:
        """Nearest language of a text's n-grams, and 1 - its share of the largest distance."""
        top = uniq[np.argsort(-n, kind="stable")[: self.opts.size]]
        at = np.searchsorted(self.grams, top).clip(max=len(self.grams) - 1)
        rank, own = self.ranks[at], np.arange(len(top))[:, None]
        found = (self.grams[at] == top)[:, None] & (rank >= 0)
        dist = np.where(found, np.abs(rank - own), self.opts.size).sum(0)
        best = int(dist.argmin())
        return self.langs[best], 1.0 - float(dist[best]) / (self.opts.size * len(top))


def learn(training: DataFrame, opts: RankOptions = RankOptions()) -> Profiles | None:
    """Profiles of all languages in (lang, text); None without a letter to learn from."""
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        gram_counts(training, opts)
        .withColumn("rank", F.row_number().over(by_rank) - 1)
        .where(F.col("rank") < opts.size)
        .select("lang", "gram", "rank")
        .limit(opts.max_languages * opts.size + 1)
        .collect()
    )
    if len(top) > opts.max_languages * opts.size:
        raise ValueError(f"more than {opts.max_languages} languages")
    if not top:
        return None
    langs, grams = sorted({r.lang for r in top}), np.unique([r.gram for r in top])
    ranks = np.full((len(grams), len(langs)), -1)
    for r in top:
        ranks[np.searchsorted(grams, r.gram), langs.index(r.lang)] = r["rank"]
    return Profiles(langs, grams, ranks, opts)


def identify(docs: DataFrame, profiles: Profiles | None, *carried: Column | str) -> DataFrame:
    """(carried columns..., lang_pred, score) of ``text``, row by row."""
    rows = docs.select(*carried, F.col("text").alias("__text"))
    own = [c for c in rows.columns if c != "__text"]
    opts = profiles.opts if profiles else RankOptions()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, learned = Packer(opts), profiles
        for b in batches:
            langs, scores = [], []
            for text in b.column("__text").to_pylist():
                grams, n = packer.counts(text) if text and learned else ((), ())
                lang, s = learned.predict(grams, n) if len(grams) else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(s)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in own), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*own, "lang_pred", "score"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(score, f"{kinds}, lang_pred string, score double")


def op2_language_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    profiles = learn(docs.where(~held_out))
    return identify(docs, profiles, "doc_id", held_out.alias("held_out"))
