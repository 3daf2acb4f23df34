"""Near-duplicates by fast similarity sketching, banding and exact verification.

**Sketch.** A text's set holds its distinct two-word shingles as 64-bit hashes. In round i a
hash function throws every element into one of ``bins`` bins; a bin that is still empty keeps
its smallest value. After ``bins`` rounds, round ``bins + b`` throws every element into bin b,
so every bin fills, and for sets of some size after two or three rounds. The share of equal
bins estimates the Jaccard similarity with concentration bounds.

**Banding.** ``bins / band`` keys per distinct set. Sets that share a key are candidates; at
similarity 0.8 a pair is missed with probability (1 - 0.8^6)^42 < 3 * 10^-6, at 0.85 with
less than 10^-9, while texts of one language that merely share common words rarely meet.

**Verification** is exact, on full sets, and does no work per pair of copies. Equal sets are
one set from the start. Every member of a key is compared with the key's first member only (its
leader), and components are formed. A key whose members lie in one component is done: no
further link can change anything. Otherwise some pairs that have not been compared may still
be links across components. Let D(x) be the difference of x from the leader. Two sets are
linked iff 9 |A ^ B| <= |A| + |B|, and |A ^ B| = |D(A)| + |D(B)| - 2 |D(A) & D(B)|, so a link
needs a number of shared *differences* that can be computed beforehand and is at least 1 when
one of the two is not linked with the leader. Differences from the cluster's hub that only one
member has are shared with none; prefix filtering on the others, in the order of how few members
have them, then yields the few pairs left.
Groups of such candidates that are still large are treated as keys were, around a far member;
each round takes that member out, so the rounds end.

Defined results: NULL and empty texts have an empty set and are linked with nothing. A row
without doc_id belongs to no component (NULL) and is kept. Rows that repeat a doc_id are one
document; if their sets differ, the one with the smallest fingerprint stands for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import table, words, written
from txengine.llm.components import components

U = np.uint64
M1, M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


@dataclass(frozen=True)
class SketchOptions:
    """``bins`` of a sketch (a power of two); ``band``: bins per key; ``shingle``: words in a
    shingle (fewer words than that: the whole sequence); ``num``/``den``: least similarity;
    ``cell``: members compared with a leader in one task; ``direct``: members of a leader up
    to which open pairs are joined as they are; ``small``: pairs for each member up to which
    a group of equal differences is joined; ``bits`` of the map (a multiple of 2^15) that
    spares the shuffle documents which no candidate needs; ``held``: words whose hashes a
    task remembers."""

    bins: int = 256
    band: int = 6
    shingle: int = 2
    num: int = 4
    den: int = 5
    cell: int = 500
    direct: int = 16
    small: int = 2000
    bits: int = 1 << 25
    held: int = 100_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * M1
    x = (x ^ (x >> U(27))) * M2
    return x ^ (x >> U(31))


class Sketcher:
    def __init__(self, opts: SketchOptions):
        self.o, self.known = opts, {}
        # one salt per round; the second half are the rounds that fill a given bin
        self.salts = mixed(np.arange(1, 2 * opts.bins + 1, dtype=U) * U(0x9E3779B97F4A7C15))
        self.shift = U(64 - (opts.bins.bit_length() - 1))
        self.top = U(0xFFFFFFFFFFFFFFFF)
        self.weights = mixed(np.arange(1, opts.band + 1, dtype=U) << U(32)) | U(1)
        self.bands = mixed(np.arange(1, opts.bins // opts.band + 1, dtype=U) << U(48))

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted set of shingle hashes."""
        if len(self.known) > self.o.held:
            self.known.clear()
        known, hashes = self.known, []
        for w in words(text):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        h = np.array(hashes, dtype=U)
        k = min(self.o.shingle, len(h))
        if not k:
            return h
        out = np.full(len(h) - k + 1, U(k), dtype=U)
        for i in range(k):
            out = mixed(out * U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
        return np.unique(out)

    def sketch(self, s: np.ndarray) -> np.ndarray:
        t = self.o.bins
        out, empty = np.zeros(t, dtype=U), np.ones(t, dtype=bool)
        for i, salt in enumerate(self.salts):
            h = mixed(s ^ salt)
            least = np.full(t, self.top)
            if i < t:
                np.minimum.at(least, (h >> self.shift).astype(np.int64), h)
                fills = empty & (least != self.top)
            else:
                least[i - t] = h.min()
                fills = empty & (np.arange(t) == i - t)
            out[fills] = least[fills]
            empty &= ~fills
            if not empty.any():
                break
        return out

    def keys(self, s: np.ndarray) -> np.ndarray:
        bands = self.o.bins // self.o.band
        rows = self.sketch(s)[: bands * self.o.band].reshape(bands, self.o.band)
        return mixed((rows * self.weights).sum(axis=1, dtype=U) ^ self.bands).astype(np.int64)


def _fingerprint(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketches(docs: DataFrame, opts: SketchOptions) -> DataFrame:
    """(doc_id, n_shingles, fp, keys): ``fp`` identifies the set, NULL where it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sk = Sketcher(opts)
        for b in batches:
            n, fp, keys = [], [], []
            for text in b.column("text").to_pylist():
                s = sk.shingles(text)
                n.append(len(s))
                fp.append(_fingerprint(s))
                keys.append(sk.keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "fp", "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, fp binary, keys array<long>")


def _bit_map(ids: DataFrame, bits: int) -> np.ndarray:
    """Bit ``xxhash64(id) mod bits`` set for every row of (id); bounded by ``bits``."""
    at = F.pmod(F.xxhash64("id"), F.lit(bits))
    maps = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")
    )
    out = np.zeros(bits // 8 + 4096, dtype=np.uint8)
    for r in maps.collect():  # position 0 is in bucket 0 or 1, by how buckets are numbered
        out[r["b"] * 4096 : r["b"] * 4096 + len(r["m"])] = np.frombuffer(r["m"], dtype=np.uint8)
    return out


def full_sets(docs: DataFrame, wanted: DataFrame, opts: SketchOptions) -> DataFrame:
    """(id, set) of (doc_id, text): the sorted hashes as bytes of the texts that have the set
    ``fp`` of ``wanted`` (id, fp)."""
    bitmap = _bit_map(wanted, opts.bits)
    at = F.pmod(F.xxhash64("doc_id"), F.lit(opts.bits))
    bucket, bit = F.bitmap_bucket_number(at), F.bitmap_bit_position(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sk = Sketcher(opts)
        for b in batches:
            byte, bit = (b.column(c).to_numpy(zero_copy_only=False) for c in ("byte", "bit"))
            hit = np.flatnonzero(bitmap[byte] >> bit.astype(np.uint8) & 1)
            sets = [sk.shingles(t) for t in b.column("text").take(pa.array(hit)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").take(pa.array(hit)),
                    pa.array([_fingerprint(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["id", "fp", "set"],
            )

    place = docs.where("doc_id is not null").select(
        "doc_id", "text", (bucket * 4096 + F.floor(bit / 8)).alias("byte"), (bit % 8).alias("bit")
    )
    found = place.mapInArrow(run, "id long, fp binary, set binary")
    # rows that repeat an id and its text are one; same keys as the join, so no further shuffle
    return found.join(wanted, ["id", "fp"]).groupBy("id", "fp").agg(F.first("set").alias("set")).select("id", "set")


# ----------------------------------------------------------------------- verification
def _dealt_beside(pairs: DataFrame, sets: DataFrame, opts: SketchOptions) -> DataFrame:
    """(leader, cell, id, set), dealt so that each cell of at most about ``cell`` members of a
    leader is in one task, after a row (id NULL) with the leader's own set."""
    cells = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / opts.cell).cast("int").alias("cells"))
    members = (
        pairs.join(cells, "leader")
        .select("leader", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int").alias("cell"), "id")
        .join(sets.select("id", "set"), "id")
        .select("leader", "cell", "id", "set")
    )
    leaders = (
        cells.join(sets.select(F.col("id").alias("leader"), "set"), "leader")
        .select("leader", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.lit(None).cast("long").alias("id"), "set")
    )
    dealt = members.unionAll(leaders).repartition("leader", "cell")
    return dealt.sortWithinPartitions("leader", "cell", F.col("id").asc_nulls_first())


def _each_member(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(leader, id, leader's set, member's set)."""
    own = None
    for b in batches:
        for leader, i, s in zip(*(b.column(c).to_pylist() for c in ("leader", "id", "set"))):
            s = np.frombuffer(s, dtype=U)
            if i is None:
                own = s
            else:
                yield leader, i, own, s


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of ``b`` are in ``a`` (both sorted)."""
    return a[np.searchsorted(a, b).clip(max=len(a) - 1)] == b


def compare(pairs: DataFrame, sets: DataFrame, opts: SketchOptions) -> DataFrame:
    """(leader, id, linked) of every pair, on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders, ids, linked = [], [], []
        for leader, i, a, b in _each_member(batches):
            both = int(_shared(a, b).sum())
            leaders.append(leader)
            ids.append(i)
            linked.append(opts.den * both >= opts.num * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaders, pa.int64()), pa.array(ids, pa.int64()), pa.array(linked, pa.bool_())], ["leader", "id", "linked"]
        )

    return _dealt_beside(pairs, sets, opts).mapInArrow(run, "leader long, id long, linked boolean")


def differences(pairs: DataFrame, sets: DataFrame, opts: SketchOptions) -> DataFrame:
    """(leader, id, size, e, shingle): a row for each shingle that only one of a member and its
    leader has. ``size`` = p |leader| and ``e`` = q d - p |x| for d such shingles, see
    :func:`difference_keys`."""
    p, q = opts.den - opts.num, opts.den + opts.num

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, np.ndarray]] = []

        def batch() -> pa.RecordBatch:
            n = [len(h[4]) for h in held]
            cols = [pa.array(np.repeat(np.array([h[k] for h in held], dtype=np.int64), n)) for k in range(4)]
            shingle = np.concatenate([h[4] for h in held]).astype(np.int64) if held else np.zeros(0, np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays([*cols, pa.array(shingle)], ["leader", "id", "size", "e", "shingle"])

        rows = 0
        for leader, i, a, b in _each_member(batches):
            diff = np.concatenate([b[~_shared(a, b)], a[~_shared(b, a)]])
            held.append((leader, i, p * len(a), q * len(diff) - p * len(b), diff))
            rows += len(diff)
            if rows > 200_000:
                yield batch()
                rows = 0
        yield batch()

    return _dealt_beside(pairs, sets, opts).mapInArrow(run, "leader long, id long, size long, e long, shingle long")


def difference_keys(diffs: DataFrame, opts: SketchOptions) -> DataFrame:
    """(key, near, id, far, d, e, rest, last, at) from the written :func:`differences`: the prefix
    of each member's difference from its leader, how many differences ``rest`` behind it, where
    ``last`` it ends in the order that all members share, and the place ``at`` of each in the
    member's own order.

    With similarity num/den, A and B are linked iff q |A ^ B| <= p (|A| + |B|), p = den - num,
    q = den + num. With |D(x)| differences and e = q |D(x)| - p |x|, x is linked with the leader
    iff e <= p |leader|, and a link of x and y needs at least (e_x + e_y) / 2q shared
    differences. A difference that no other member of the leader has is shared with none: ``d``
    counts the others, in order of how few members have them. ``far`` members are not linked with
    the leader. Two families of keys: far with near members (``near`` true) and far with far
    ones, each with the prefix its bound allows."""
    p, q = opts.den - opts.num, opts.den + opts.num
    many = diffs.groupBy("leader", "shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    common = diffs.join(many, ["leader", "shingle"])
    # at most as many as a member's own and its leader's set have
    own = common.groupBy("leader", "id").agg(
        F.first("size").alias("size"), F.first("e").alias("e"), F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("own")
    )
    far, d = F.col("e") > F.col("size"), F.size("own").cast("long")
    # least e of a partner: near, at least one difference; far, just not linked
    with_near = F.when(far, F.col("e") - F.col("size") + (q - p)).otherwise(F.col("e") + F.col("size") + 1)
    with_far = F.when(far, F.col("e") + F.col("size") + 1)
    bounds = F.array(F.struct(F.lit(True).alias("near"), with_near.alias("need")), F.struct(F.lit(False).alias("near"), with_far.alias("need")))
    shared = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("need") / (2 * q)).cast("long"))
    family = own.select("leader", "id", "e", far.alias("far"), d.alias("d"), "own", F.inline(bounds)).where("need is not null")
    family = family.withColumn("length", F.col("d") - shared + 1).where("length > 0")
    last = F.element_at("own", F.col("length").cast("int"))
    prefix = family.select(
        "leader", "id", "near", "far", "d", "e", (F.col("d") - F.col("length")).alias("rest"), last.alias("last"),
        F.posexplode(F.slice("own", F.lit(1), F.col("length").cast("int"))).alias("at", "one"),
    )
    return prefix.select(
        F.xxhash64("leader", "near", "one.shingle").alias("key"), "near", "id", "far", "d", "e", "rest", "last", "at"
    )


def _in_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` with the component of ``id`` (itself if it has no link)."""
    named = comps.select(F.col("node").alias("id"), F.col("component").alias("known"))
    return rows.join(named, "id", "left").withColumn("comp", F.coalesce("known", "id")).drop("known")


def _open_groups(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """The groups (group, id, mask, leader) whose members lie in more than one component,
    with comp, the group's first component ``low`` and its number of members."""
    k = _in_components(groups, comps)
    g = k.groupBy("group").agg(
        F.count(F.lit(1)).alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    return k.join(g.where("low < high").select("group", "members", "low"), "group")


def _hubs(links: DataFrame, comps: DataFrame) -> DataFrame:
    """(low, hub): for each component the node with most links, as (u, v) names them."""
    degree = links.groupBy(F.col("u").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", (-F.col("id")).alias("last")))["last"]
    return _in_components(degree, comps).groupBy(F.col("comp").alias("low")).agg((-best).alias("hub"))


def _beside_leaders(groups: DataFrame, hubs: DataFrame, comps: DataFrame) -> DataFrame:
    """(leader, id, apart): every member of an open group beside the group's leader if it was
    given one, else beside the hub of its first component, so that all keys which a cluster
    of copies shares lead to one hub. ``apart``: they are in different components."""
    named = groups.select("id", "comp", "low", "leader").distinct().join(hubs, "low", "left")
    named = named.select(F.coalesce("leader", "hub", "low").alias("leader"), "id", "comp")
    of_leader = _in_components(named.select(F.col("leader").alias("id")).distinct(), comps)
    of_leader = of_leader.select(F.col("id").alias("leader"), F.col("comp").alias("home"))
    named = named.where("leader <> id").join(of_leader, "leader")
    return named.select("leader", "id", (F.col("comp") != F.col("home")).alias("apart")).distinct()


def _difference_groups(keys: DataFrame, comps: DataFrame, opts: SketchOptions) -> DataFrame:
    """The rows of :func:`difference_keys` in groups that may still hold a link between two
    components, with comp, ``few`` (whether the group has at most ``small`` pairs to compare
    for each member) and ``leader``, its first far member."""
    k = _in_components(keys, comps)
    g = k.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.sum(F.col("far").cast("long")).alias("n_far"), F.max("near").alias("near_key"),
        F.min(F.when(F.col("far"), F.col("id"))).alias("leader"),
    )
    partners = F.when(F.col("near_key"), F.col("members") - F.col("n_far")).otherwise(F.col("n_far"))
    g = g.where((F.col("low") < F.col("high")) & (F.col("n_far") > 0) & (partners > 0))
    few = F.col("n_far") * partners <= opts.small * F.col("members")
    return k.join(g.select("key", "leader", few.alias("few")), "key")


def _may_meet(groups: DataFrame, opts: SketchOptions) -> DataFrame:
    """Members ``x`` and ``y`` of small difference groups that may be linked, for each key that
    they meet in."""
    few, q = groups.where("few"), opts.den + opts.num
    x, y = few.where("far").alias("x"), few.alias("y")
    # two that meet in this key share at most what stands before it in both, it, and what stands
    # behind it in both
    may = (
        "x.comp <> y.comp and ((x.near and not y.far) or (not x.near and y.far and x.id < y.id))"
        f" and {2 * q} * (least(x.at, y.at) + least(x.d - x.at, y.d - y.at)) >= x.e + y.e"
    )
    return x.join(y, "key").where(may)


def _small_pairs(groups: DataFrame, opts: SketchOptions) -> DataFrame:
    """(leader, id) of the pairs in small difference groups that the counts allow to link."""
    # what a pair shares: at most the prefix keys it meets in and what is behind the prefix that
    # ends first (an element behind it may still stand in the other prefix)
    rest = F.expr("CASE WHEN x.last < y.last THEN x.rest WHEN y.last < x.last THEN y.rest ELSE greatest(x.rest, y.rest) END")
    pairs = _may_meet(groups, opts).groupBy(F.col("x.id").alias("leader"), F.col("y.id").alias("id")).agg(
        F.count(F.lit(1)).alias("met"),
        F.max(rest).alias("rest"),
        F.min(F.col("x.e") + F.col("y.e")).alias("e"),
    )
    return pairs.where((F.col("met") + F.col("rest")) * (2 * (opts.den + opts.num)) >= F.col("e")).select("leader", "id")


def _links(checked: DataFrame) -> DataFrame:
    return checked.where("linked").select(F.col("leader").alias("u"), F.col("id").alias("v"))


def _one_set_per_id(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``seen`` for comparing (rows with an id and a set, one set per id) and for naming the
    component of every row (all rows, with the set that stands for their id)."""
    usable = seen.where("fp is not null and doc_id is not null")
    several = usable.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    several = several.where("a < b").select("doc_id", F.col("a").alias("stands"))
    if several.isEmpty():
        return usable, seen
    marked = seen.join(several, "doc_id", "left")
    return (
        marked.where("fp is not null and doc_id is not null and coalesce(stands = fp, true)"),
        marked.withColumn("fp", F.coalesce("stands", "fp")),
    )


def link_components(docs: DataFrame, opts: SketchOptions = SketchOptions()) -> DataFrame:
    """One row per row of (doc_id, text): (doc_id, n_shingles, component_id, kept)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable, named = _one_set_per_id(written(sketches(docs, opts), "sketches"))
    # equal sets are one from here on; its id is the smallest doc_id that has it
    reps = usable.groupBy("fp").agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"))
    reps = written(reps, "distinct_sets")

    exploded = reps.select("id", F.posexplode("keys").alias("band", "key"))
    shared = exploded.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
    # which bands a member shares with a leader: members without a common band are no pair
    mask = F.bit_or(F.expr("shiftleft(1L, band)")).alias("mask")
    pairs = (
        exploded.join(shared.where("leader < last").select("key", "leader"), "key")
        .where("id <> leader")
        .groupBy("leader", "id")
        .agg(mask)
    )
    pairs = written(pairs, "candidates")
    involved = pairs.select(F.col("leader").alias("id")).unionAll(pairs.select("id")).distinct()
    wanted = written(reps.join(involved, "id").select("id", "fp"), "involved")
    sets = written(full_sets(docs, wanted, opts), "sets")

    checked = written(compare(pairs.select("leader", "id"), sets, opts), "compared")
    links = written(_links(checked), "found")
    comps = written(components(links), "components")
    groups = pairs.select(F.col("leader").alias("group"), "id", "mask", F.lit(None).cast("long").alias("leader"))
    while True:
        groups = written(_open_groups(groups, comps), "open_groups")
        # pairs of few members cost less than their differences
        few = groups.where((F.col("members") <= opts.direct) & F.col("leader").isNull())
        x, y = few.alias("x"), few.alias("y")
        plain = x.join(y, "group").where("x.comp <> y.comp and x.id < y.id and (x.mask & y.mask) <> 0")
        plain = plain.select(F.col("x.id").alias("leader"), F.col("y.id").alias("id"))
        many = groups.where((F.col("members") > opts.direct) | F.col("leader").isNotNull())
        beside = written(_beside_leaders(many, _hubs(links, comps), comps), "beside_leaders")
        diffs = written(differences(beside.select("leader", "id"), sets, opts), "differences")
        keys = difference_keys(diffs, opts)
        inner = written(_difference_groups(keys, comps, opts), "difference_groups")
        todo = plain.unionAll(_small_pairs(inner, opts)).unionAll(
            beside.where("apart").select("leader", "id")
        )
        todo = written(todo.distinct(), "open_pairs")
        if not todo.isEmpty():
            checked = written(compare(todo, sets, opts), "compared")
            links = written(links.unionAll(_links(checked)), "found")
            known = comps.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
            comps = written(components(known.unionAll(_links(checked))), "components")
        large = inner.where("not few")
        if large.isEmpty():
            break
        groups = large.select(F.col("key").alias("group"), "id", F.lit(-1).cast("long").alias("mask"), "leader")
    by_set = _in_components(reps.select("id", "fp"), comps).select("fp", "comp")
    out = named.select("doc_id", "n_shingles", "fp").join(by_set, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, opts: SketchOptions = SketchOptions()) -> DataFrame:
    """One document of each component, with all columns of ``docs``: the rows whose doc_id
    is their component's. Rows that repeat a kept doc_id and its text are one; rows without
    doc_id stay. Where a doc_id has several texts, the one with the smallest hash is compared,
    and the others stay, one row each."""
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.where("doc_id is not null")
    several = named.groupBy(F.col("doc_id").alias("__id")).agg(F.min(text).alias("__own"), F.max(text).alias("__last"))
    several = written(several.where("__own < __last").select("__id", "__own"), "several_texts")
    marked = named.join(several, named["doc_id"] == several["__id"], "left")
    compared = marked.where(F.col("__own").isNull() | (F.col("__own") == text)).select(named["*"])
    others = marked.where(F.col("__own") != text).select(named["*"], text.alias("__text"))
    kept = link_components(compared, opts).where("kept").select("doc_id").distinct()
    ids = kept.select(F.col("doc_id").alias("__kept"))
    rows = compared.join(ids, F.col("doc_id").cast("long") == F.col("__kept"), "left_semi").dropDuplicates(["doc_id"])
    others = others.dropDuplicates(["doc_id", "__text"]).drop("__text")
    return rows.unionAll(others).unionAll(docs.where("doc_id is null"))


def op5_bin_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
