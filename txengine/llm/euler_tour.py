"""The prefix trie of conversations, summed up over its Euler tour.

**Trie.** A node is a sequence of first turns that some conversation starts with. Its key is a
sum of hashes of (place, turn), so a conversation's keys are running sums over its turns and a
node's key gives its parent's. A node is named by its smallest conversation and its depth.

**Euler tour.** Every node has an enter and an exit arc. An enter arc is followed by the enter
arc of the first child or, at a leaf, the node's own exit arc; an exit arc by the enter arc of
the next sibling or the parent's exit arc. Children are in order of their names.

**List ranking.** Nodes are dealt in order of their names, so that a conversation's own path lies
together. Every block of nodes ranks what it holds of the tour: each arc gets the sums from it to
the last arc before the tour leaves the block, and where it goes on. The places where the tour
enters a block are ranked by pointer jumping, which takes a number of rounds that grows with
the logarithm of their number; a join gives the sums from every arc to the tour's end. What lies
between a node's arcs is the difference of two such sums.

Nothing is gathered by conversation, parent or node: turns, siblings and members of a node are
dealt in order over all tasks, and what tasks pass on to later ones (counts, sums, first rows)
is one row for each task and group. The digest of a node's members is sequential by its
definition; it is read as a stream of pieces of ``PIECE`` ids.

Defined results: rows without conv_id are no conversation. A NULL role or text is empty, a NULL
turn number comes first; turns with equal numbers are in order of the MD5 of role and text, and
rows that repeat one turn are as many turns. No conversation, no node (not even the root).
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txengine.llm.common import id_hash, table, written

#: Ids of a node's members that are joined to one text before they are digested.
PIECE = 1000
LIMBS = ("s0", "s1", "s2", "s3")
SUMS = ("steps", "leaves", "saved")


# ----------------------------------------------------------------- order over all tasks
def in_order(rows: DataFrame, *cols: Column | str) -> DataFrame:
    """``rows`` dealt to tasks in order of ``cols``, as ``chunk`` numbers them; written, so that
    the numbers stay. Rows that are equal in ``cols`` may lie in two chunks."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *cols, "_tie")
    return written(dealt.drop("_tie").withColumn("chunk", F.spark_partition_id()), "in_order")


def running_sums(rows: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with the running sums of their group: within a chunk by a window, and what the
    group's earlier chunks hold from one row for each."""
    inner = Window.partitionBy(*group, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = rows.groupBy(*group, "chunk").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    before = per_chunk.select(*group, "chunk", *(F.sum(f"_{n}").over(earlier).alias(f"_{n}") for n in sums))
    kept = [c for c in rows.columns if c not in sums]
    within = rows.select(*kept, *(F.sum(c).over(inner).alias(n) for n, c in sums.items()))
    total = [(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in sums]
    return within.join(before, [*group, "chunk"]).select(*kept, *total)


def next_in_order(rows: DataFrame, group: list[str], of: str, to: str) -> DataFrame:
    """``rows`` (distinct in group and ``of``, dealt in this order) with the group's next ``of``."""
    inner = Window.partitionBy(*group, "chunk").orderBy(of)
    per_chunk = rows.groupBy(*group, "chunk").agg(F.min(of).alias("_first"))
    later = per_chunk.select(*group, "chunk", F.lead("_first").over(Window.partitionBy(*group).orderBy("chunk")).alias("_first"))
    within = rows.withColumn(to, F.lead(of).over(inner))
    return within.join(later, [*group, "chunk"]).withColumn(to, F.coalesce(to, "_first")).drop("_first", "chunk")


# ------------------------------------------------------------------------ conversations
def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words, chunk) of all turns, numbered from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    dealt = in_order(rows, "conv_id", F.col("turn").asc_nulls_first(), "digest")
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    return running_sums(dealt, ["conv_id"], order, {"pos": F.lit(1).cast("long")}).drop("turn")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of every conversation c its first turns from c - c % 20, then its own after as many:
    (conv_id, depth, digest, words, last, chunk) of its turns and (conv_id, length)."""
    turns = written(_turns(conversations), "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    sizes = sizes.withColumns({"home": F.col("conv_id") - F.col("conv_id") % 20, "h": id_hash("conv_id") % 4})
    at_home = sizes.select(F.col("conv_id").alias("home"), F.col("n").alias("n_home"))
    convs = sizes.join(at_home, "home", "left").select(
        "conv_id", "home", "n", "h", F.least("h", F.coalesce("n_home", F.lit(0))).alias("m")
    )
    convs = convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(convs, "rebuilt")
    first = turns.where("pos <= 3 and conv_id % 20 = 0").select(F.col("conv_id").alias("home"), "pos", "digest", "words")
    heads = convs.join(first, "home").where("pos <= h").select(
        "conv_id", F.col("pos").alias("depth"), "digest", "words", (F.col("pos") == F.col("length")).alias("last"), F.lit(-1).alias("chunk")
    )
    own = turns.join(convs.select("conv_id", "n", "h", "m"), "conv_id").where("pos > h")
    own = own.select(
        "conv_id", (F.col("m") + F.col("pos") - F.col("h")).alias("depth"), "digest", "words", (F.col("pos") == F.col("n")).alias("last"), "chunk"
    )
    return heads.unionAll(own), convs.select("conv_id", "length")


# --------------------------------------------------------------------------------- trie
def _key(depth: Column, limbs: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *(x.cast("string") for x in limbs)).cast("binary")))


def _root_key() -> Column:
    return _key(F.lit(0), [F.lit(0)] * len(LIMBS))


def members(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent_key, words, last): every conversation in each of its nodes
    but the root."""
    limb = {s: F.xxhash64(F.lit(i), "depth", "digest").bitwiseAND(F.lit(0xFFFFFFFF)) for i, s in enumerate(LIMBS)}
    own = turns.withColumns({f"own_{s}": x for s, x in limb.items()})
    summed = running_sums(own, ["conv_id"], [F.col("depth")], {s: F.col(f"own_{s}") for s in LIMBS})
    return summed.select(
        "conv_id", "depth", "words", "last",
        _key(F.col("depth"), [F.col(s) for s in LIMBS]).alias("key"),
        _key(F.col("depth") - 1, [F.col(s) - F.col(f"own_{s}") for s in LIMBS]).alias("parent_key"),
    )


def trie(in_nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, conv_id, depth, parent_conv_id, n_convs, own): the nodes, the root included;
    ``own``: tokens that sharing its last turn saves."""
    inner = in_nodes.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"),
        F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
    )
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = top.select(
        _root_key().alias("key"), "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("parent_key"), "n_convs", F.lit(0).cast("long").alias("words"),
    )
    nodes = written(inner.unionByName(root), "nodes")
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.where("depth > 0").join(parents, "parent_key").unionByName(
        nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    )
    return named.select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("own")
    )


# --------------------------------------------------------------------------- Euler tour
def _arcs_in_order(nodes: DataFrame) -> DataFrame:
    """``nodes`` with n_children, first_child and next_sibling (as conv_ids), in order of their
    names."""
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_child"))
    narrow = nodes.select("conv_id", "depth", "parent_conv_id", "own")
    dealt = in_order(narrow, "parent_conv_id", "depth", "conv_id").where("depth > 0")
    siblings = next_in_order(dealt, ["parent_conv_id", "depth"], "conv_id", "next_sibling")
    top = narrow.where("depth = 0").withColumn("next_sibling", F.lit(None).cast("long"))
    linked = siblings.unionByName(top).join(children, ["conv_id", "depth"], "left")
    linked = linked.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return linked.repartitionByRange(n, "conv_id", "depth").sortWithinPartitions("conv_id", "depth")


def rank_block(node: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What a block of nodes, in order of their names, holds of the tour. Arc 2 i enters node i,
    2 i + 1 leaves it. Of each arc: SUMS from it to the last arc in the block, the arc's successor
    outside (next_conv, next_arc = 2 depth + side; ``ends``: there is none) and ``head``: the
    tour comes to it from outside."""
    conv, depth, leaf = node["conv_id"], node["depth"], node["n_children"] == 0
    has_next, root = node["has_next"], depth == 0
    n = len(conv)
    to_conv, to_arc = np.empty(2 * n, np.int64), np.empty(2 * n, np.int64)
    to_conv[0::2] = np.where(leaf, conv, node["first_child"])
    to_arc[0::2] = np.where(leaf, 2 * depth + 1, 2 * depth + 2)
    to_conv[1::2] = np.where(has_next, node["next_sibling"], node["parent_conv_id"])
    to_arc[1::2] = np.where(has_next, 2 * depth, 2 * depth - 1)
    ends = np.zeros(2 * n, dtype=bool)
    ends[1::2] = root
    # the arc's place in the block
    names, of = np.unique(conv, return_inverse=True)
    wide = 2 * int(depth.max()) + 4
    own = of * wide + 2 * depth  # ascending, as the rows are
    i = np.searchsorted(names, to_conv).clip(max=len(names) - 1)
    wanted = i * wide + to_arc // 2 * 2
    at = np.searchsorted(own, wanted).clip(max=n - 1)
    inside = (names[i] == to_conv) & (own[at] == wanted) & ~ends
    jump = np.where(inside, 2 * at + to_arc % 2, np.arange(2 * n))
    head = np.ones(2 * n, dtype=bool)
    head[jump[inside]] = False
    sums = {k: np.zeros(2 * n, np.int64) for k in SUMS}
    sums["steps"][:], sums["leaves"][0::2], sums["saved"][0::2] = 1, leaf, node["own"]
    last = jump == np.arange(2 * n)
    # sums over [arc, jump), doubling; the last arc's own weight is added at the end
    part = {k: np.where(last, 0, v) for k, v in sums.items()}
    while not last[jump].all():
        part = {k: v + v[jump] for k, v in part.items()}
        jump = jump[jump]
    out = {k: part[k] + sums[k][jump] for k in SUMS}
    return out | {"next_conv": to_conv[jump], "next_arc": to_arc[jump], "ends": ends[jump], "head": head}


def _ranked_blocks(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, enter, exit): of both arcs of each node what :func:`rank_block` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            node = {c: b.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in b.schema.names}
            node["has_next"] = b.column("next_sibling").is_valid().to_numpy(zero_copy_only=False)
            x = rank_block(node)
            cols = [b.column("conv_id"), b.column("depth")]
            for side in (0, 1):
                none = x["ends"][side::2]
                cols += [pa.array(x[k][side::2], mask=none if k.startswith("next") else None) for k in ("next_conv", "next_arc", *SUMS, "head")]
            yield pa.RecordBatch.from_arrays(cols, names)

    fields = ("next_conv", "next_arc", *SUMS, "head")
    names = ["conv_id", "depth", *(f"{side}_{f}" for side in ("in", "out") for f in fields)]
    kind = ", ".join(f"{n} {'boolean' if n.endswith('head') else 'long'}" for n in names)
    return _arcs_in_order(nodes).mapInArrow(run, kind)


def jump_to_end(heads: DataFrame) -> DataFrame:
    """``heads`` (conv, arc, next_conv, next_arc, SUMS) with SUMS up to the end of the list: every
    round doubles how far each row looks."""
    now = written(heads, "heads")
    while True:
        going = now.where("next_conv is not null")
        if going.isEmpty():
            return now.select("conv", "arc", *SUMS)
        x, y = going.alias("x"), now.alias("y")
        on = (F.col("x.next_conv") == F.col("y.conv")) & (F.col("x.next_arc") == F.col("y.arc"))
        added = [(F.col(f"x.{k}") + F.col(f"y.{k}")).alias(k) for k in SUMS]
        step = x.join(y, on).select("x.conv", "x.arc", "y.next_conv", "y.next_arc", *added)
        now = written(step.unionAll(now.where("next_conv is null")), "heads")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens, enter_left, exit_left) of each node: sums over its
    subtree, and how many arcs of the tour there are from each of its own to the end."""
    blocks = written(_ranked_blocks(nodes), "blocks")
    arcs = [
        blocks.where(f"{side}_head").select(
            F.col("conv_id").alias("conv"), (F.col("depth") * 2 + i).alias("arc"),
            F.col(f"{side}_next_conv").alias("next_conv"), F.col(f"{side}_next_arc").alias("next_arc"),
            *(F.col(f"{side}_{k}").alias(k) for k in SUMS),
        )
        for i, side in enumerate(("in", "out"))
    ]
    ranked = jump_to_end(arcs[0].unionAll(arcs[1]))
    out = blocks
    for side in ("in", "out"):
        beyond = ranked.select(
            F.col("conv").alias(f"{side}_next_conv"), F.col("arc").alias(f"{side}_next_arc"), *(F.col(k).alias(f"{side}_far_{k}") for k in SUMS)
        )
        out = out.join(beyond, [f"{side}_next_conv", f"{side}_next_arc"], "left")

    def total(side: str, k: str) -> Column:
        return F.col(f"{side}_{k}") + F.coalesce(f"{side}_far_{k}", F.lit(0))

    return out.select(
        "conv_id", "depth",
        (total("in", "leaves") - total("out", "leaves")).alias("n_leaves"),
        (total("in", "saved") - total("out", "saved")).alias("saved_tokens"),
        total("in", "steps").alias("enter_left"), total("out", "steps").alias("exit_left"),
    )


# -------------------------------------------------------------------------------- members
def ends_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): SHA-256 of the ascending ids, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = b.column("key").to_pylist(), b.column("conv_id").to_pylist()
            out, start = [], 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start] or i - start == PIECE:
                    out.append((keys[start], ids[start], ",".join(map(str, ids[start:i]))))
                    start = i
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["key", "first", "piece"]
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
            cols = list(zip(*done)) if done else [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())], ["key", "ends_sha256"])

        key = sha = None
        for b in batches:
            done = []
            for k, piece in zip(b.column("key").to_pylist(), b.column("piece").to_pylist()):
                if k == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(piece.encode())
            yield batch(done)
        if key is not None:
            yield batch([(key, sha.hexdigest())])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ids = ends.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = sorted_ids.mapInArrow(pieces, "key binary, first long, piece string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, enter_left, exit_left."""
    turns, convs = rebuilt(conversations)
    in_nodes = written(members(turns), "members")
    nodes = written(trie(in_nodes, convs), "trie")
    sums = subtree_sums(nodes)
    at_root = convs.where("length = 0").select(_root_key().alias("key"), "conv_id")
    ends = ends_digests(in_nodes.where("last").select("key", "conv_id").unionAll(at_root))
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    out = nodes.join(sums, ["conv_id", "depth"]).join(children, ["conv_id", "depth"], "left").join(ends, "key", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "enter_left", "exit_left",
    )


def op13_euler_tour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("enter_left", "exit_left")


OP13_SQL = """
WITH given AS (
  SELECT conv_id::BIGINT AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
    md5(strlen(role) || ':' || role || text) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS pos
  FROM given
), sizes AS (
  SELECT conv_id, max(pos) AS n, conv_id - conv_id % 20 AS home,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) % 4 AS h
  FROM turns GROUP BY conv_id
), convs AS (
  SELECT s.*, least(s.h, coalesce(t.n, 0)) AS m FROM sizes s LEFT JOIN sizes t ON t.conv_id = s.home
), rebuilt AS (
  SELECT c.conv_id, t.pos AS depth, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.home AND t.pos <= c.m
  UNION ALL
  SELECT c.conv_id, c.m + t.pos - c.h, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), members AS (
  SELECT conv_id, depth, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node,
    depth = max(depth) OVER (PARTITION BY conv_id) AS last
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS own,
    string_agg(CASE WHEN last THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM members GROUP BY node, depth
), children AS (
  SELECT left(node, -32) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT m.node, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(u.own) AS saved_tokens
  FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.depth <= u.depth LEFT JOIN children c ON c.node = u.node
  GROUP BY m.node
)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0) AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v JOIN below b ON b.node = v.node
LEFT JOIN nodes p ON v.depth > 0 AND p.node = left(v.node, -32)
LEFT JOIN children c ON c.node = v.node
"""
