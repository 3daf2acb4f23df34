"""Removal of repeated passages by super-k-mer partitioning.

A window is 13 consecutive words. Its minimiser is the smallest hash among the runs of ``mer``
words in it, so equal windows have equal minimisers. Consecutive windows of a text that share
their minimiser form a super-k-mer; it travels as one packed string (its words, once each) to
the bucket of its minimiser. There the windows of strings that share a minimiser are sorted, word
for word, which gives every window's smallest document exactly.

**Before the shuffle** texts are put together in blocks of ``block`` words. A string that occurs
more than once in a block travels once, with the smallest and largest document that it has
there, and the strings of a block for one bucket travel compressed in one row. So a passage
that a third of all documents hold is one string for each block. **After it** a bucket answers a
block, for each string that an earlier document shares, with every window's first document;
from the answers and the order of its strings the block finds the covered words of each text.

Blocks are numbered by task and kept in the written table that holds the answers, so they are
not cut anew. A bucket is what one task holds at a time: 4 buckets for every shuffle partition,
unless ``buckets`` says otherwise.

Defined results: NULL and empty texts have no words. Rows without doc_id are neither earlier nor
later than any document: they are returned whole. Rows that repeat a doc_id are answered each for
itself and never remove one another's words. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import table, written

U = np.uint64
WINDOW = 13


@dataclass(frozen=True)
class WindowOptions:
    """``mer``: words of a run whose hash may be a minimiser; ``longest``: windows of a
    super-k-mer (longer ones travel in parts); ``held``: words whose hashes a task remembers."""

    mer: int = 3
    block: int = 1_000_000
    buckets: int | None = None
    longest: int = 2000
    held: int = 300_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def minimisers(hashes: np.ndarray, mer: int) -> np.ndarray:
    """The minimiser of every window over words with these hashes."""
    runs = np.zeros(len(hashes) - mer + 1, dtype=U)
    for i in range(mer):
        runs = mixed(runs + U(0x9E3779B97F4A7C15) + hashes[i : i + len(runs)])
    wide, have = WINDOW - mer + 1, 1
    while have < wide:  # smallest of ``have`` neighbours, doubled up to the window's width
        more = min(have, wide - have)
        runs = np.minimum(runs[:-more], runs[more:])
        have += more
    return runs


def _squeezed(x: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x if isinstance(x, bytes) else x.tobytes())


def _whole(x: bytes, kind: type | None = None) -> np.ndarray | bytes:
    x = zstandard.ZstdDecompressor().decompress(x)
    return x if kind is None else np.frombuffer(x, dtype=kind)


#: Strings for a bucket (``bucket`` >= 0): their numbers in the block, minimisers (32 bits are
#: enough to find the strings to sort), smallest and largest documents, words. The block's own
#: row (``bucket`` < 0): for each of its texts in turn the numbers of its strings, how many
#: they are, the texts' ids and fingerprints, and the windows of each string.
PACKED = "bucket long, block long, numbers binary, tags binary, low binary, high binary, words binary"
PACKED_NAMES = ["bucket", "block", "numbers", "tags", "low", "high", "words"]


class Block:
    """Texts put together, with each of their packed strings once."""

    def __init__(self, buckets: int):
        self.buckets, self.n_words = buckets, 0
        self.number: dict[bytes, int] = {}
        self.bucket, self.tag, self.low, self.high, self.windows = [], [], [], [], []
        self.sequence, self.texts = [], []

    def add(self, doc_id: int, fp: int, words: list[bytes], minimiser: np.ndarray, longest: int) -> None:
        self.n_words += len(words)
        packed = b" ".join(words)
        at = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1, out=at[1:])
        n = len(minimiser)
        starts = np.concatenate([[0], np.flatnonzero(minimiser[1:] != minimiser[:-1]) + 1])
        if n > longest and (np.diff(starts, append=n) > longest).any():
            starts = np.concatenate([np.arange(s, e, longest) for s, e in zip(starts, [*starts[1:], n])])
        stops = np.append(starts[1:], n)
        own = minimiser[starts]
        number, low, high, sequence = self.number, self.low, self.high, self.sequence
        rows = (at[starts], at[stops + WINDOW - 1] - 1, own % U(self.buckets), own >> U(32), stops - starts)
        for s, e, bucket, tag, n_windows in zip(*(x.tolist() for x in rows)):
            string = packed[s:e]
            k = number.get(string)
            if k is None:
                k = number[string] = len(low)
                low.append(doc_id)
                high.append(doc_id)
                self.bucket.append(bucket)
                self.tag.append(tag)
                self.windows.append(n_windows)
            elif doc_id < low[k]:
                low[k] = doc_id
            elif doc_id > high[k]:
                high[k] = doc_id
            sequence.append(k)
        self.texts.append((doc_id, fp, len(starts)))

    def rows(self, block: int) -> pa.RecordBatch:
        out = []
        strings = list(self.number)
        bucket, tag = np.array(self.bucket, dtype=np.int64), np.array(self.tag, dtype=np.uint32)
        low, high = np.array(self.low, dtype=np.int64), np.array(self.high, dtype=np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for k in np.split(order, edges[1:]) if len(order) else []:
            text = b"\n".join([strings[i] for i in k.tolist()])
            out.append((int(bucket[k[0]]), block, *map(_squeezed, (k.astype(np.int32), tag[k], low[k], high[k], text))))
        ids, fps, sizes = (np.array(x, dtype=np.int64) for x in zip(*self.texts))
        windows = np.array(self.windows, dtype=np.int64)
        out.append((-1 - block, block, *map(_squeezed, (np.array(self.sequence, dtype=np.int32), sizes, ids, fps, windows))))
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], PACKED_NAMES)


def pack(docs: DataFrame, opts: WindowOptions, buckets: int) -> DataFrame:
    """``PACKED`` rows of (doc_id, fp, text as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known, block = TaskContext.get().partitionId() << 32, _Hashes(), Block(buckets)
        for b in batches:
            for doc_id, fp, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "fp", "text"))):
                words = text.split()
                if len(words) < WINDOW:
                    continue
                hashes = np.fromiter(map(known.__getitem__, words), dtype=U, count=len(words))
                block.add(doc_id, fp, words, minimisers(hashes, opts.mer), opts.longest)
                if len(known) > opts.held:
                    known.clear()
                if block.n_words >= opts.block:
                    yield block.rows(number)
                    number, block = number + 1, Block(buckets)
        if block.n_words:
            yield block.rows(number)

    return docs.where("doc_id is not null and text is not null").mapInArrow(run, PACKED)


# ------------------------------------------------------------------------------ buckets
def first_of_windows(strings: list[bytes], low: np.ndarray) -> list[np.ndarray]:
    """For each window of each string the smallest ``low`` among the strings that hold it."""
    code: dict[bytes, int] = {}
    coded = [[code.setdefault(w, len(code)) for w in s.split(b" ")] for s in strings]
    sizes = np.array([len(c) for c in coded])
    flat = np.concatenate([np.array(c, dtype=np.int32) for c in coded])
    begin = np.cumsum(sizes) - sizes
    n = sizes - WINDOW + 1
    own = np.repeat(np.arange(len(strings)), n)
    at = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + begin[own]
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[at])
    windows = windows.view(np.dtype((np.void, WINDOW * 4))).ravel()
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    least = np.minimum.reduceat(low[own[order]], edges)
    first = np.empty(len(own), dtype=np.int64)
    first[order] = np.repeat(least, np.diff(edges, append=len(order)))
    return np.split(first, np.cumsum(n)[:-1])


def answer_bucket(rows: pa.Table) -> pa.Table:
    """For every block the numbers of its strings that a document before their last one there
    shares, and as ``low`` the first document of each of their windows."""
    if rows["bucket"][0].as_py() < 0:
        return rows
    strings, tags, low, high, sizes = [], [], [], [], []
    numbers = [_whole(x, np.int32) for x in rows["numbers"].to_pylist()]
    for r in rows.select(["tags", "low", "high", "words"]).to_pylist():
        strings += _whole(r["words"]).split(b"\n")
        tags.append(_whole(r["tags"], np.uint32))
        low.append(_whole(r["low"], np.int64))
        high.append(_whole(r["high"], np.int64))
        sizes.append(len(tags[-1]))
    tags, low, high = (np.concatenate(x) for x in (tags, low, high))
    # equal strings are one
    place: dict[bytes, int] = {}
    which = np.array([place.setdefault(s, len(place)) for s in strings])
    least = np.full(len(place), np.iinfo(np.int64).max)
    np.minimum.at(least, which, low)
    tag_of = np.zeros(len(place), dtype=np.uint32)
    tag_of[which] = tags
    one_of = np.unique(tag_of, return_inverse=True, return_counts=True)
    several = one_of[2][one_of[1]] > 1
    distinct = list(place)
    to_sort = np.flatnonzero(several)
    found = dict(zip(to_sort.tolist(), first_of_windows([distinct[i] for i in to_sort], least[to_sort]))) if len(to_sort) else {}
    out, start = [], 0
    for block, number, size in zip(rows["block"].to_pylist(), numbers, sizes):
        told, firsts = [], []
        for k, u, last in zip(number.tolist(), which[start : start + size].tolist(), high[start : start + size].tolist()):
            first = found.get(u)
            if first is None:
                if least[u] < last:
                    told.append(k)
                    firsts.append(np.full(distinct[u].count(b" ") + 2 - WINDOW, least[u]))
            elif (first < last).any():
                told.append(k)
                firsts.append(first)
        start += size
        if told:
            out.append((0, block, _squeezed(np.array(told, dtype=np.int32)), None, _squeezed(np.concatenate(firsts)), None, None))
    return pa.Table.from_pylist([dict(zip(PACKED_NAMES, r)) for r in out], schema=rows.schema)


# ------------------------------------------------------------------------------- blocks
def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (n[i] of them), one after another."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


CUTS = "doc_id long, fp long, runs array<int>"


def cut_block(rows: pa.Table) -> pa.Table:
    """(doc_id, fp, runs): for each text of a block with covered words, the first and last of
    every run of consecutive windows that an earlier document holds."""
    none = pa.table({"doc_id": pa.array([], pa.int64()), "fp": pa.array([], pa.int64()), "runs": pa.array([], pa.list_(pa.int32()))})
    own, answers = None, []
    for r in rows.to_pylist():
        if r["bucket"] < 0:
            own = r
        else:
            answers.append(r)
    if not answers:
        return none
    sequence, sizes = _whole(own["numbers"], np.int32), _whole(own["tags"], np.int64)
    ids, fps, windows = (_whole(own[c], np.int64) for c in ("low", "high", "words"))
    begin = np.cumsum(windows) - windows
    first = np.full(int(windows.sum()), np.iinfo(np.int64).max)
    for r in answers:
        told = _whole(r["numbers"], np.int32)
        first[_spread(begin[told], windows[told])] = _whole(r["low"], np.int64)
    in_text = np.repeat(np.arange(len(ids)), sizes)  # of each string of the sequence
    text = np.repeat(in_text, windows[sequence])  # of each window
    covered = first[_spread(begin[sequence], windows[sequence])] < ids[text]
    n = np.bincount(text, minlength=len(ids))
    at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    before = np.concatenate([[False], covered[:-1] & (text[1:] == text[:-1])])
    after = np.concatenate([covered[1:] & (text[1:] == text[:-1]), [False]])
    runs = np.stack([at[covered & ~before], at[covered & ~after]], axis=1)
    of = text[covered & ~before]
    hit, start = np.unique(of, return_index=True)
    offsets = np.append(start, len(of)) * 2
    runs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(runs.ravel().astype(np.int32)))
    return pa.table({"doc_id": pa.array(ids[hit]), "fp": pa.array(fps[hit]), "runs": runs})


def covered_windows(docs: DataFrame, opts: WindowOptions) -> DataFrame:
    """``CUTS`` of (doc_id, fp, text as bytes), one row per id and fingerprint."""
    spark = docs.sparkSession
    buckets = opts.buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers = written(pack(docs, opts, buckets).groupBy("bucket").applyInArrow(answer_bucket, PACKED), "answers")
    cuts = answers.groupBy("block").applyInArrow(cut_block, CUTS)
    return written(cuts, "cuts").dropDuplicates(["doc_id", "fp"])


def without_repeats(docs: DataFrame, opts: WindowOptions = WindowOptions()) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept (the words
    that stay, joined by a space)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    docs = docs.withColumn("fp", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for text, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist()):
                words = text.split() if text else []
                n.append(len(words))
                if runs:
                    stays = np.ones(len(words), dtype=bool)
                    for first, last in zip(runs[::2], runs[1::2]):
                        stays[first : last + WINDOW] = False
                    words = list(compress(words, stays.tolist()))
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            sha = [hashlib.sha256(k).hexdigest() for k in kept]
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    cut = docs.join(covered_windows(docs, opts), ["doc_id", "fp"], "left").select("doc_id", "text", "runs")
    out = cut.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))


def op12_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


OP12_SQL = """
WITH rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT r, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i,
    unnest(list_transform(range(1, len(words) + 1),
      lambda s: CASE WHEN s + 12 <= len(words) THEN array_to_string(list_slice(words, s, s + 12), ' ') END)) AS w
  FROM rows_of
), judged AS (
  SELECT *, coalesce(w IS NOT NULL AND min(doc_id) OVER (PARTITION BY w) < doc_id, false) AS covered FROM placed
), marked AS (
  SELECT *, max(covered::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM judged
), kept AS (
  SELECT r, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
    sha256(coalesce(string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i), '')) AS kept_sha256
  FROM marked GROUP BY r
)
SELECT t.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
  coalesce(k.kept_sha256, sha256('')) AS kept_sha256
FROM rows_of t LEFT JOIN kept k ON k.r = t.r
"""
