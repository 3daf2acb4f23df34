"""Alignment of two tokenizers by divide and conquer at shared cuts.

Every text is encoded as space+text by a byte-level BPE (A) and by a piece BPE (B, which adds
the space itself). A byte offset where tokens of both end is a *shared cut*. An interval of
tokens between two shared cuts is divided: the common end nearest to its middle is located by
bisecting B's ends, and both halves are treated alike; an interval without one is a leaf, one
group. All intervals of a block of texts that are equally deep are divided together, as arrays.

**Links.** Cutting the bytes at all ends of either side leaves one piece for every pair of
tokens that overlap, so the links of a text are those pieces. Each row keeps its distinct id
pairs with how often each is linked; corpus-wide counts are added up from them. The most
frequent pairs (at most ``head``) are looked up in the tasks, all others meet their counts in
a join; B's highest counts are one number per id of the vocabulary.

**Speed.** In a plain text (:func:`is_plain`) neither tokenizer joins anything across a blank, so words are
encoded by themselves (A's from the entries of its own file) and remembered; any other text is
encoded as a whole.

Defined results: texts that are NULL or empty, or whose tokens do not spell space+text, have no
tokens: zeros and an empty digest. Every row is answered by itself, also where doc_id repeats or
is NULL (all rows count in the corpus-wide counts). Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txengine.llm.common import table, written


def _installed(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class AlignOptions:
    """``byte_bpe``, ``piece_bpe``: vocabulary files, at the same path on every executor;
    ``block``: characters of the texts that are handled together; ``held``: words that a task
    remembers; ``head``: id pairs whose counts the tasks hold."""

    byte_bpe: str = field(default_factory=lambda: _installed("byte_bpe_50k.json"))
    piece_bpe: str = field(default_factory=lambda: _installed("piece_bpe_32k.model"))
    block: int = 400_000
    held: int = 300_000
    head: int = 1_000_000


# Characters whose classes no Unicode version disputes: ASCII and the Latin letters.
PLAIN = frozenset("\t\n\r" + "".join(chr(c) for c in range(0x20, 0x180) if c < 0x7F or c >= 0xC0 and c not in (0xD7, 0xF7)))


def is_plain(text: str) -> bool:
    """Only such characters, no blank beside another one and none at an end: then A's and B's
    words both begin at every blank."""
    return PLAIN.issuperset(text) and not (
        "  " in text or "\n " in text or "\t " in text or "\r " in text or text[-1] in " \t\n\r" or text[0] in " \t\n\r"
    )


# Fixed value: how byte-level BPE cuts a text before merging, as its published pattern says.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes a printable byte as its character and the others, in order, as the
    characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers with the bytes of every token, and what the words seen lately encode to:
    word -> ids of A and of B as int32 bytes, None if they do not spell the word."""

    def __init__(self, opts: AlignOptions):
        self.a = Tokenizer.from_file(opts.byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=opts.piece_bpe)
        alphabet = byte_alphabet()
        of_a = self.a.get_vocab()
        self.a_bytes = [b""] * (max(of_a.values()) + 1)
        ranks = {}
        for entry, i in of_a.items():
            if all(c in alphabet for c in entry):
                self.a_bytes[i] = bytes(alphabet[c] for c in entry)
                ranks[self.a_bytes[i]] = i
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # words may be encoded by themselves if A's ids are its merges in order and no piece of B
        # goes from one word into the next
        merges = json.loads(Path(opts.byte_bpe).read_text())["model"]["merges"]
        merged = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
        self.by_word = all(of_a.get(m) == 256 + i for i, m in enumerate(merged)) and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.a_word = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.held, self.lately, self.before = opts.held, {}, {}

    def _learn(self, words: set[str]) -> None:
        """``words`` come from the older half of the memory, or are encoded."""
        if len(self.lately) > self.held // 2:
            self.before, self.lately = self.lately, {}
        words = words - self.lately.keys()
        again = words & self.before.keys()
        for w in again:
            self.lately[w] = self.before[w]
        new = list(words - again)
        if not new:
            return
        spelled = [(" " + w).encode() for w in new]
        want, parts = np.fromiter(map(len, spelled), np.int64, len(new)), []
        good = np.ones(len(new), dtype=bool)
        a, b = [self.a_word(" " + w) for w in new], self.b.encode(new, num_threads=1)
        for ids, length, of in ((a, self.a_len, self.a_bytes), (b, self.b_len, self.b_bytes)):
            stops = np.cumsum(np.fromiter(map(len, ids), np.int64, len(new)))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(stops[-1]))
            sizes = np.diff(np.concatenate([[0], np.cumsum(length[flat])])[stops], prepend=0)
            if (sizes != want).any() or b"".join([of[i] for i in flat.tolist()]) != b"".join(spelled):
                good &= [b"".join([of[i] for i in x]) == y for x, y in zip(ids, spelled)]
            held, at = flat.tobytes(), (stops * 4).tolist()
            parts.append([held[s:e] for s, e in zip([0, *at], at)])
        for w, ok, x, y in zip(new, good.tolist(), *parts):
            self.lately[w] = (x, y) if ok else None

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and of B of each text; None if it has no tokens."""
        words = [t.split(" ") if t and self.by_word and is_plain(t) else None for t in texts]
        self._learn(set().union(*(w for w in words if w)))
        return [self._whole(t) if w is None else self._joined(w) for t, w in zip(texts, words)]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        coded = [self.lately[w] for w in words]
        if None in coded:
            return None
        return tuple(np.frombuffer(b"".join([c[side] for c in coded]), dtype=np.int32) for side in (0, 1))

    def _whole(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not text:
            return None
        out, spaced = [], " " + text
        a, b = self.a.encode(spaced, add_special_tokens=False).ids, self.b.encode(text, num_threads=1)
        for ids, spelled in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join([spelled[i] for i in ids]) != spaced.encode("utf-8", "surrogatepass"):
                return None
            out.append(np.array(ids, dtype=np.int32))
        return out[0], out[1]


# ------------------------------------------------------------------------ shared cuts
def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of first[i]..last[i], one after another, and the i of each."""
    n = np.maximum(last - first + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner], owner


def _nearest_common(lo: np.ndarray, hi: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each interval of A's tokens lo..hi-1: the token before ``hi - 1`` nearest to the middle
    whose end is an end of B too, or -1. Ever wider rings around the middle are bisected."""
    mid = (lo + hi - 2) // 2
    found = np.full(len(lo), -1)
    left, inner, outer = np.flatnonzero(hi - lo > 1), -1, 0
    while len(left):
        l, h, m = lo[left], hi[left] - 2, mid[left]
        below, i = _ranges(np.maximum(l, m - outer), m - max(inner, 0) - (inner >= 0))
        above, j = _ranges(m + max(inner, 0) + 1, np.minimum(h, m + outer))
        kept = []
        for at, owner in ((below, i), (above, j)):  # both ascending, which makes bisecting cheap
            end = a_ends[at]
            hit = b_ends[np.searchsorted(b_ends, end)] == end
            kept.append((at[hit], owner[hit]))
        at, owner = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((at, np.abs(at - m[owner]), owner))
        at, owner = at[order], owner[order]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        found[left[owner[first]]] = at[first]
        more = (found[left] < 0) & ((m - outer > l) | (m + outer < h))
        left, inner, outer = left[more], outer, outer * 2 + 1
    return found


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of A's tokens end at a shared cut, in order. ``last``: the last token of each text,
    where both sides end."""
    hi = last + 1
    lo = np.concatenate([[0], hi[:-1]])
    cuts = [last]
    while len(lo):
        cut = _nearest_common(lo, hi, a_ends, b_ends)
        some = cut >= 0
        cut = cut[some]
        cuts.append(cut)
        lo, hi = (np.stack(x, axis=1).ravel() for x in ((lo[some], cut + 1), (cut + 1, hi[some])))
    return np.sort(np.concatenate(cuts))


class Aligner:
    """Aligns blocks of texts."""

    def __init__(self, opts: AlignOptions):
        self.enc = Encoders(opts)
        self.width = len(self.enc.b_bytes)
        # an id's digits followed by each mark that may follow it
        most = max(len(self.enc.a_bytes), self.width)
        self.shown = [str(i).encode() + mark for i in range(most) for mark in (b",", b"|", b";")]

    def block(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """Of each text: n_a, n_b, n_groups, n_links, groups_sha256; ``pairs`` and ``times``
        with ``offsets`` of each text's part."""
        n = len(texts)
        coded = self.enc.encode(texts)
        full = [i for i, c in enumerate(coded) if c is not None and len(c[0])]
        out = {k: np.zeros(n, dtype=np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {"groups_sha256": [""] * n, "pairs": np.zeros(0, np.int32), "times": np.zeros(0, np.int32), "offsets": np.zeros(n + 1, np.int32)}
        if not full:
            return out
        a, b = (np.concatenate([coded[i][side] for i in full]).astype(np.int64) for side in (0, 1))
        n_a, n_b = (np.array([len(coded[i][side]) for i in full]) for side in (0, 1))
        a_ends, b_ends = np.cumsum(self.enc.a_len[a]), np.cumsum(self.enc.b_len[b])
        a_stop, b_stop = np.cumsum(n_a), np.cumsum(n_b)
        cuts = shared_cuts(a_ends, b_ends, a_stop - 1)
        b_cuts = np.searchsorted(b_ends, a_ends[cuts])
        upto = np.searchsorted(cuts, a_stop)  # groups up to each text's end
        n_groups = np.diff(upto, prepend=0)
        self._digests(out["groups_sha256"], full, a, b, cuts, b_cuts, upto)
        # one piece between two neighbouring ends is one link
        ends = np.concatenate([a_ends, np.delete(b_ends, b_cuts)])
        ends.sort(kind="stable")
        pairs = a[np.searchsorted(a_ends, ends)] * self.width + b[np.searchsorted(b_ends, ends)]
        n_links = n_a + n_b - n_groups
        keyed, times = np.unique((np.repeat(np.arange(len(full)), n_links) << 32) | pairs, return_counts=True)
        per_text = np.bincount(keyed >> 32, minlength=len(full))
        for k, v in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links)):
            out[k][full] = v
        sizes = np.zeros(n, dtype=np.int64)
        sizes[full] = per_text
        out["pairs"], out["times"] = (keyed & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32)
        out["offsets"] = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return out

    def _digests(self, to: list[str], full: list[int], a: np.ndarray, b: np.ndarray, cuts: np.ndarray, b_cuts: np.ndarray, upto: np.ndarray) -> None:
        a_size, b_size = np.diff(cuts, prepend=-1), np.diff(b_cuts, prepend=-1)
        groups = np.arange(len(cuts))
        # a token comes after its own side's earlier ones and the other side's of earlier groups
        a_at = np.arange(len(a)) + np.repeat(np.cumsum(b_size) - b_size, a_size)
        b_at = np.arange(len(b)) + np.repeat(np.cumsum(a_size), b_size)
        index = np.empty(len(a) + len(b), dtype=np.int64)
        a_show, b_show = a * 3, b * 3
        a_show[cuts] += 1
        b_show[b_cuts] += 2
        index[a_at], index[b_at] = a_show, b_show
        stops = (cuts + 1 + b_cuts + 1)[upto - 1].tolist()
        shown = iter(map(self.shown.__getitem__, index.tolist()))
        start = 0
        for i, stop in zip(full, stops):
            text = b"".join(islice(shown, stop - start))[:-1]  # without the last ;
            to[i] = hashlib.sha256(text).hexdigest()
            start = stop


ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<int>, times array<int>"
)
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def align(docs: DataFrame, opts: AlignOptions) -> DataFrame:
    """``ALIGNED``: every row of (doc_id, text) with its alignment and its distinct id pairs (an
    A id times B's vocabulary plus a B id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = Aligner(opts), TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in _blocks(texts, opts.block):
                x = aligner.block(texts[start:stop])
                lists = [pa.ListArray.from_arrays(pa.array(x["offsets"]), pa.array(x[k])) for k in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + stop - start)),
                        batch.column("doc_id").slice(start, stop - start),
                        *(pa.array(x[k]) for k in NUMBERS),
                        pa.array(x["groups_sha256"], pa.string()),
                        *lists,
                    ],
                    ["row", "doc_id", *NUMBERS, "groups_sha256", "pairs", "times"],
                )
                row += stop - start

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


# ------------------------------------------------------------------ corpus-wide counts
def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def pair_counts(aligned: DataFrame, most: int = 4_000_000) -> DataFrame:
    """(pair, n): how many links of the whole corpus hold the id pair. Tasks add up ``most`` rows
    at a time before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            pairs, which = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            n = np.bincount(which, weights=np.concatenate([t for _, t in parts]), minlength=len(pairs))
            return pairs, n.astype(np.int64)

        def batch(p: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(n, pa.int64())], ["pair", "n"])

        parts, size = [], 0
        for b in batches:
            parts.append((_flat(b, "pairs"), _flat(b, "times")))
            size += len(parts[-1][0])
            if size > most:
                parts = [added(parts)]
                size = len(parts[0][0])
                if size > most // 2:
                    yield batch(*parts[0])
                    parts, size = [], 0
        if size:
            yield batch(*added(parts))

    per_task = aligned.select("pairs", "times").mapInArrow(run, "pair int, n long")
    return per_task.groupBy("pair").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pairs and their counts, in order of the pairs: all pairs from a count on,
    at most ``most`` of them."""
    step = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        total += r["pairs"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    got = counts.where(step >= least).toArrow()
    pairs = got["pair"].to_numpy()
    order = np.argsort(pairs)
    return pairs[order], got["n"].to_numpy()[order]


def alignments(docs: DataFrame, opts: AlignOptions | None = None) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    opts = opts or AlignOptions()
    spark = docs.sparkSession
    aligned = written(align(docs, opts), "aligned")
    counts = written(pair_counts(aligned), "pair_counts")
    width = sentencepiece.SentencePieceProcessor(model_file=opts.piece_bpe).get_piece_size()
    b_id = F.col("pair") % width
    highest = np.zeros(width, dtype=np.int64)  # one number per id of B
    for r in counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).collect():
        highest[r["b"]] = r["n"]
    held = spark.sparkContext.broadcast((*_head(counts, opts.head), highest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, top = held.value
        for b in batches:
            p, t = _flat(b, "pairs"), _flat(b, "times").astype(np.int64)
            offsets = b.column("pairs").offsets.to_numpy() - b.column("pairs").offsets[0].as_py()
            of = np.repeat(np.arange(len(b)), np.diff(offsets))
            place = np.searchsorted(pairs, p)
            known = np.zeros(len(p), dtype=bool)
            if len(pairs):
                place[place == len(pairs)] = 0
                known = pairs[place] == p
            c = n[place[known]]
            total = np.zeros(len(b), dtype=np.int64)
            best = np.zeros(len(b), dtype=np.int64)
            np.add.at(total, of[known], c * t[known])
            np.add.at(best, of[known], np.where(c == top[p[known] % len(top)], t[known], 0))
            rest = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[~known], minlength=len(b)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(k) for k in ("row", "doc_id", *NUMBERS, "groups_sha256")),
                    pa.array(best),
                    pa.array(total),
                    pa.ListArray.from_arrays(rest, pa.array(p[~known])),
                    pa.ListArray.from_arrays(rest, pa.array(t[~known].astype(np.int32))),
                ],
                ["row", "doc_id", *NUMBERS, "groups_sha256", "best", "total", "pairs", "times"],
            )

    kind = ALIGNED.replace("pairs", "best long, total long, pairs")
    scored = written(aligned.mapInArrow(run, kind), "scored")
    # pairs outside the head
    rest = scored.where("size(pairs) > 0").select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "t"))
    tops = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))
    known = counts.join(tops, b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("is_best"))
    added = rest.join(known, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("t").cast("long")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("t")).alias("more_total"),
    )
    out = scored.drop("pairs", "times").join(added, "row", "left")
    return out.select(
        "doc_id", *NUMBERS,
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more_total", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def op11_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents").select("doc_id", "text"))
