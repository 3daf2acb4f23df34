"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from its copy in a document by up to k edits (k: a share of the item's
length). Cut into k + 1 pieces, at least one piece of it must then stand in the document
unchanged. All pieces go into one automaton, every document runs through it once, and each
hit fixes the window in which the whole item would have to stand; there Myers' bit-parallel
algorithm gives the smallest edit distance. Nothing within the budget can be missed, and
nothing outside it is reported.

Texts are compared normalised: lower-cased, every run of other characters than letters and
digits one blank, so that case and punctuation cost no edits, and matches begin and end at
words (the blanks around an item belong to it).

Documents are never shuffled. The items are sent to the tasks in blocks of at most
``block_chars`` normalised characters, one pass over the documents per block, so a larger
benchmark means more passes and not larger tasks.

Defined results: an item without item_id is searched like any other (its matches have a NULL
item_id). NULL and empty items match nothing, NULL and empty texts hold nothing. Equal
items are all reported. Of several places in one document that with the smallest distance,
then the first, is given. Repeated rows are searched each; extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import table, written

NOT_WORD = re.compile(r"[\W_]+")
#: The same for ASCII texts, byte by byte.
ASCII_WORD = bytes(c if chr(c).isalnum() else 32 for c in bytes(range(128)).lower()) + b" " * 128


@dataclass(frozen=True)
class EditOptions:
    """``chars_per_edit``: one edit is allowed for so many characters of the item;
    ``block_chars``: characters of items that a task holds at a time."""

    chars_per_edit: int = 20
    block_chars: int = 1_000_000

    def budget(self, item: str) -> int:
        return len(item) // self.chars_per_edit


def normalised(text: str | None) -> str:
    """`` word word `` with a blank at either end; empty without a word."""
    if not text:
        return ""
    if text.isascii():
        bare = b" ".join(text.encode().translate(ASCII_WORD).split()).decode()
    else:
        bare = NOT_WORD.sub(" ", text.lower()).strip()
    return f" {bare} " if bare else ""


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(place, piece): ``k + 1`` pieces that make up the item."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, window: str, k: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of the whole ``item`` inside ``window``: smallest
    distance, then smallest end; None if it exceeds ``k``. Whole columns of the edit table
    are held as two integers of one bit per character of the item."""
    m = len(item)
    full, last = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    up, down, dist, best = full, 0, m, None
    for j, c in enumerate(window):
        eq = at.get(c, 0)
        same = eq | down
        diag = (((eq & up) + up) ^ up) | eq
        right, left = down | ~(diag | up) & full, up & diag
        if right & last:
            dist += 1
        elif left & last:
            dist -= 1
        right, left = right << 1 & full, left << 1 & full
        up, down = left | ~(same | right) & full, right & same
        if dist <= k and (best is None or dist < best[0]):
            best = (dist, j + 1)
    return best


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], opts: EditOptions):
        self.ids: dict[str, list[int]] = {}
        for item_id, text in items:
            if norm := normalised(text):
                self.ids.setdefault(norm, []).append(item_id)
        self.items = [(t, opts.budget(t)) for t in sorted(self.ids)]
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (t, k) in enumerate(self.items):
            for place, piece in pieces(t, k):
                where.setdefault(piece, []).append((n, place))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def windows(self, norm: str) -> dict[int, list[list[int]]]:
        """Item -> merged [begin, end) windows of the normalised text that may hold it."""
        out: dict[int, list[list[int]]] = {}
        for end, (length, at) in self.automaton.iter(norm):
            for n, place in at:
                item, k = self.items[n]
                begin = end + 1 - length - place
                a, b = max(0, begin - k), min(len(norm), begin + len(item) + k)
                if b - a < len(item) - k:
                    continue
                mine = out.setdefault(n, [])
                if mine and a <= mine[-1][1] and a >= mine[-1][0]:
                    mine[-1][1] = max(mine[-1][1], b)
                else:
                    mine.append([a, b])
        return out

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, first_word, last_word), words counted from 0."""
        norm, out = normalised(text), []
        if not norm or not self.items:
            return out
        for n, windows in self.windows(norm).items():
            item, k = self.items[n]
            best = None
            for a, b in windows:
                if hit := myers(item, norm[a:b], k):
                    found = (hit[0], a + hit[1])
                    best = min(best, found) if best else found
            if best:
                last = norm.count(" ", 0, best[1] - 1) - 1
                first = max(0, last - item.count(" ") + 2)
                out += [(i, best[0], first, last) for i in self.ids[item]]
        return out


def item_blocks(benchmark: DataFrame, opts: EditOptions) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one at a time; which block an item is in depends on its
    hash. Items without an id are searched like all others."""
    rows = benchmark.where("text is not null").select("item_id", "text")
    chars = rows.agg(F.sum(F.length("text") + 2)).first()[0] or 0
    n = int(-(-chars // opts.block_chars))
    for b in range(n):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r.item_id, r.text) for r in mine.toLocalIterator()]


def matches(
    docs: DataFrame, benchmark: DataFrame, opts: EditOptions = EditOptions()
) -> DataFrame:
    """(doc_id, item_id, distance, first_word, last_word), one row per document row and item
    found in it."""
    rows = docs.select("doc_id", "text")
    of = rows.schema["doc_id"].dataType.simpleString()
    kind = f"doc_id {of}, item_id long, distance int, first_word int, last_word int"
    out, before = rows.limit(0).selectExpr("doc_id", "0L as item_id", "0 as distance", "0 as first_word", "0 as last_word"), None
    for block in item_blocks(benchmark, opts):
        if before is not None:  # its matches are written before the next block comes to the driver
            out = out.unionAll(written(before, "matches"))

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, opts)
            for b in batches:
                found = [
                    (row, *f) for row, t in enumerate(b.column("text").to_pylist()) for f in matcher.find(t)
                ]
                cols = list(zip(*found)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").take(pa.array(cols[0], pa.int64())),
                        pa.array(cols[1], pa.int64()),
                        *(pa.array(c, pa.int32()) for c in cols[2:]),
                    ],
                    ["doc_id", "item_id", "distance", "first_word", "last_word"],
                )

        before = rows.mapInArrow(search, kind)
    return out if before is None else out.unionAll(before)


def keep_unseen(
    docs: DataFrame, benchmark: DataFrame, opts: EditOptions = EditOptions()
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    before, kind = None, docs.schema
    for block in item_blocks(benchmark, opts):
        if before is not None:  # as in matches()
            docs = written(before, "unseen")

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, opts)
            for b in batches:
                free = [not matcher.find(t) for t in b.column("text").to_pylist()]
                yield b.filter(pa.array(free, pa.bool_()))

        before = docs.mapInArrow(clean, kind)
    return docs if before is None else before


def op8_edit_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return matches(docs, table(spark, sf_dir, "benchmark"))
