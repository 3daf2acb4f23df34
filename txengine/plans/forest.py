"""A random forest of two classes grown and scored by Spark jobs, for training sets whose forest
the driver cannot hold. Same trees as Spark ML's: Poisson bootstrap, 32 bins, Gini, a fresh feature
subset per node, leaves merged where both predict the same.

Nodes with many rows are split level by level: tasks add up histograms per (tree, node), Spark
shuffles them by tree, and the driver learns the chosen splits. Once a node has at most
``LOCAL_ROWS`` rows, these are shuffled by (tree, node), and one task grows the rest below it.
Trees are written, one row per tree, and meet the rows to be scored in a cross join of chunks.
The driver holds the few upper nodes only. The jobs are run by ``fit`` and ``transform``.
"""

from __future__ import annotations

import json
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.operators.joins import materialize
from txengine.session import scratch_path

BINS = 32
CHUNK_ROWS = 50_000  # rows that tasks handle at once
LOCAL_ROWS = 20_000  # of one node that one task grows on

NODE = np.dtype([("feature", "i1"), ("bin", "i1"), ("left", "<i4"), ("right", "<i4"), ("fraud", "<f8")])
Top = namedtuple("Top", "feature bin left right slot subset")
Tree = namedtuple("Tree", "depth numNodes")


# ------------------------------------------------------------------------------- bins
def split_points(quantiles: np.ndarray) -> np.ndarray:
    """At most ``BINS`` - 1 thresholds: between all values if they are few, else at equal steps."""
    values, counts = np.unique(quantiles, return_counts=True)
    middle = (values[:-1] + values[1:]) / 2
    if len(values) <= BINS:
        return middle
    step, seen, out = counts.sum() / BINS, np.cumsum(counts), []
    for before, after, point in zip(seen[:-1], seen[1:], middle):
        if abs(before - step * (len(out) + 1)) < abs(after - step * (len(out) + 1)):
            out.append(point)
    return np.array(out[: BINS - 1])


def _points(data: DataFrame, width: int) -> list[np.ndarray]:
    steps = [i / 1000 for i in range(1001)]
    one = data.agg(*(F.percentile_approx(F.col("x")[i], steps, 10000).alias(f"q{i}") for i in range(width))).first()
    return [split_points(np.array(q)) for q in one]


def _binned(x: pa.Array, points: list[np.ndarray]) -> np.ndarray:
    """``x <= points[b]`` is ``bin <= b``."""
    values = np.asarray(x.flatten()).reshape(-1, len(points))
    return np.stack([np.searchsorted(p, values[:, i]) for i, p in enumerate(points)], axis=1).astype("i1")


def _chunks(batches, rows: int = CHUNK_ROWS):
    """Arrow batches joined to tables of ``rows`` rows, each with a number of its own."""
    part, k, held, n = TaskContext.get().partitionId() << 32, 0, [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= rows:
            yield part + k, pa.Table.from_batches(held)
            k, held, n = k + 1, [], 0
    if n:
        yield part + k, pa.Table.from_batches(held)


def _spread(n: int) -> int:
    return max(1, -(-n // CHUNK_ROWS))


# ------------------------------------------------------------------------------- growing
def weights(seed: int, chunk: int, tree: int, n: int) -> np.ndarray:
    """How often the bootstrap of ``tree`` holds each row of a chunk, the same whenever asked."""
    return np.random.default_rng([seed, chunk, tree]).poisson(1.0, n)


def nodes_of(tree, x: np.ndarray) -> np.ndarray:
    """The node of each row that has no children."""
    at, moving = np.zeros(len(x), "i4"), np.arange(len(x))
    while len(moving):
        node = at[moving]
        feature = tree.feature[node]
        inner = feature >= 0
        moving, node, feature = moving[inner], node[inner], feature[inner]
        at[moving] = np.where(x[moving, feature] <= tree.bin[node], tree.left[node], tree.right[node])
    return at


def histogram(x, y, w, slot, subset) -> np.ndarray:
    """Weights by (slot, feature of its subset, bin, label)."""
    s, k = subset.shape
    cell = slot[:, None].astype("i8") * k + np.arange(k)
    key = (cell * BINS + x[np.arange(len(x))[:, None], subset[slot]]) * 2 + y[:, None]
    return np.bincount(key.ravel(), np.repeat(w, k), s * k * BINS * 2).astype("i8").reshape(s, k, BINS, 2)


def best_splits(hist: np.ndarray, subset: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature or -1, bin, left and right counts by label) of each slot: the largest Gini gain,
    which for two labels is in proportion to (l0 r1 - l1 r0)^2 / (l r); none if that is 0."""
    left = hist.cumsum(axis=2)
    right = left[:, :, -1:] - left
    cross = (left[..., 0] * right[..., 1] - left[..., 1] * right[..., 0]).astype("f8")
    gain = cross * cross / np.maximum(left.sum(-1).astype("f8") * right.sum(-1), 1.0)
    flat = gain.reshape(len(hist), -1)
    best, s = flat.argmax(axis=1), np.arange(len(hist))
    k, b = best // BINS, best % BINS
    feature = np.where(flat[s, best] > 0, subset[s, k], -1)
    return feature, b, left[s, k, b], right[s, k, b]


def subsets(rng: np.random.Generator, slots: int, width: int, k: int) -> np.ndarray:
    return np.argsort(rng.random((slots, width)), axis=1)[:, :k]


def merge_leaves(feature, left, right, counts, depth) -> None:
    """Inner nodes whose children are leaves of the same prediction become leaves, from below."""
    vote = counts[:, 1] > counts[:, 0]
    for d in range(int(depth.max()), -1, -1):
        at = np.flatnonzero((depth == d) & (feature >= 0))
        l, r = left[at], right[at]
        feature[at[(feature[l] < 0) & (feature[r] < 0) & (vote[l] == vote[r])]] = -1


def subtree(x, y, w, depth: int, max_depth: int, k: int, rng) -> dict[str, np.ndarray]:
    """All nodes below (and with) one node, by level; ``left`` and ``right`` count from it."""
    def leaves(counts: np.ndarray, depth: int) -> dict[str, np.ndarray]:
        none = {c: np.full(len(counts), -1, "i8") for c in ("feature", "bin", "left", "right")}
        return {**none, "counts": counts, "depth": np.full(len(counts), depth)}

    at = np.bincount(y, w, 2).astype("i8")[None]
    parts = [leaves(at, depth)]
    size, ids = 1, np.zeros(1, "i8")  # nodes so far; node of each slot, all in the last part
    slot = np.zeros(len(y), "i8")
    if depth >= max_depth or at.min() == 0:
        ids = ids[:0]
    while len(ids):
        depth += 1
        subset = subsets(rng, len(ids), x.shape[1], k)
        feature, b, lc, rc = best_splits(histogram(x, y, w, slot, subset), subset)
        cut = feature >= 0
        n, last, first = int(cut.sum()), parts[-1], size - len(parts[-1]["feature"])
        place = ids[cut] - first
        child = size + 2 * np.arange(n)
        last["feature"][place], last["bin"][place] = feature[cut], b[cut]
        last["left"][place], last["right"][place] = child, child + 1
        counts = np.stack([lc[cut], rc[cut]], axis=1).reshape(-1, 2)
        parts.append(leaves(counts, depth))
        goes_on = (counts.min(axis=1) > 0) & (depth < max_depth)
        ids = size + np.flatnonzero(goes_on)
        new = np.where(goes_on, np.cumsum(goes_on) - 1, -1)
        rank = np.cumsum(cut) - 1
        rows = np.flatnonzero(cut[slot])
        s = slot[rows]
        to = new[2 * rank[s] + (x[rows, feature[s]] > b[s])]
        rows, slot, size = rows[to >= 0], to[to >= 0], size + 2 * n
        x, y, w = x[rows], y[rows], w[rows]
        if not n:
            break
    out = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
    merge_leaves(out["feature"], out["left"], out["right"], out["counts"], out["depth"])
    return reachable(out)


def reachable(t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Without the nodes below merged leaves; children come behind their parents."""
    keep = np.zeros(len(t["feature"]), bool)
    keep[0] = True
    for d in range(int(t["depth"].min()), int(t["depth"].max()) + 1):
        at = np.flatnonzero(keep & (t["depth"] == d) & (t["feature"] >= 0))
        keep[t["left"][at]] = keep[t["right"][at]] = True
    new, inner = np.cumsum(keep) - 1, t["feature"] >= 0
    for c in ("left", "right"):
        t[c] = np.where(inner, new[np.where(inner, t[c], 0)], -1)
    return {c: v[keep] for c, v in t.items()}


class _Upper:
    """The upper nodes of one tree, as the driver knows them."""

    def __init__(self, tree: int):
        self.tree, self.feature, self.bin, self.left, self.right = tree, [-1], [0], [-1], [-1]
        self.counts, self.depth, self.open, self.local = [(0, 0)], [0], [0], []

    def task_view(self, rng, width: int, k: int) -> Top:
        slot = np.full(len(self.feature), -1, "i4")
        slot[self.open] = np.arange(len(self.open))
        return self.view(slot, subsets(rng, len(self.open), width, k))

    def view(self, slot, subset=None) -> Top:
        return Top(np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.right), slot, subset)

    def split(self, feature, b, left, right, max_depth: int) -> None:
        """The splits of the open nodes, in their order; then the children are open, local or leaves."""
        opened = self.open
        self.open = []
        for node, f, at, l, r in zip(opened, feature, b, left, right):
            if f < 0:
                continue
            self.feature[node], self.bin[node] = int(f), int(at)
            self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
            for c in (l, r):
                self.feature.append(-1), self.bin.append(0), self.left.append(-1), self.right.append(-1)
                self.counts.append((int(c[0]), int(c[1]))), self.depth.append(self.depth[node] + 1)
                new = len(self.feature) - 1
                if min(c) > 0 and self.depth[new] < max_depth:
                    (self.open if sum(c) > LOCAL_ROWS else self.local).append(new)


def grow(data: DataFrame, width: int, n: int, trees: int, max_depth: int, seed: int) -> tuple[str, list[list[float]]]:
    """Grow on ``data`` (x array<double>, y 0 or 1, ``n`` rows); the path of the written trees (tree,
    depth, nodes, packed), and the thresholds that their bins stand for."""
    spark, k = data.sparkSession, int(np.ceil(np.sqrt(width)))
    points = _points(data, width)

    def pack(batches):
        for chunk, t in _chunks(batches):
            x, y = _binned(t["x"].combine_chunks(), points), np.asarray(t["y"]).astype("i1")
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "x": [x.tobytes()], "y": [y.tobytes()]})

    chunks = materialize(spark, data.repartition(_spread(n)).mapInArrow(pack, "chunk long, x binary, y binary"), "forest_rows")
    upper = [_Upper(t) for t in range(trees)]

    def rows_of(batch):
        for chunk, x, y in zip(*(batch[c].to_pylist() for c in ("chunk", "x", "y"))):
            yield chunk, np.frombuffer(x, "i1").reshape(-1, width), np.frombuffer(y, "i1").astype("i8")

    def bootstrap(chunk, tree, x, y):
        w = weights(seed, chunk, tree, len(y))
        took = w > 0
        return x[took], y[took], w[took]

    for level in range(max_depth):
        rng = np.random.default_rng([seed, level])
        views = {u.tree: u.task_view(rng, width, k) for u in upper if u.open}
        if not views:
            break

        def count(batches, views=views):
            chunked = [c for b in batches for c in rows_of(b)]
            for tree, view in views.items():
                hist = 0
                for chunk, x, y in chunked:
                    x, y, w = bootstrap(chunk, tree, x, y)
                    slot = view.slot[nodes_of(view, x)]
                    on = slot >= 0
                    hist = hist + histogram(x[on], y[on], w[on], slot[on], view.subset)
                if chunked:
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "hist": [hist.tobytes()]})

        def choose(key, table):
            tree = key[0].as_py()
            subset = views[tree].subset
            hist = sum(np.frombuffer(h.as_py(), "i8") for h in table["hist"]).reshape(*subset.shape, BINS, 2)
            f, b, l, r = best_splits(hist, subset)
            whole = hist[:, 0].sum(axis=1)
            out = {"tree": pa.array([tree], pa.int32())}
            out |= {n: [np.ascontiguousarray(v, "i8").tobytes()] for n, v in zip("fblrw", (f, b, l, r, whole))}
            return pa.table(out)

        found = chunks.mapInArrow(count, "tree int, hist binary").groupBy("tree")
        for r in found.applyInArrow(choose, "tree int, f binary, b binary, l binary, r binary, w binary").collect():
            f, b, lc, rc, whole = (np.frombuffer(r[c], "i8") for c in "fblrw")
            u = upper[r.tree]
            for node, c in zip(u.open, whole.reshape(-1, 2).tolist()):
                u.counts[node] = tuple(c)
            u.split(f, b, lc.reshape(-1, 2), rc.reshape(-1, 2), max_depth)

    views = {u.tree: u.view(np.isin(np.arange(len(u.feature)), u.local)) for u in upper if u.local}
    depths = {(u.tree, n): u.depth[n] for u in upper for n in u.local}

    def send(batches):
        for batch in batches:
            for chunk, x, y in rows_of(batch):
                for tree, view in views.items():
                    bx, by, w = bootstrap(chunk, tree, x, y)
                    node = nodes_of(view, bx)
                    order = np.argsort(node, kind="stable")
                    order = order[view.slot[node[order]]]
                    node, start = np.unique(node[order], return_index=True)
                    rows = np.c_[bx, by, w].astype("i1")[order]
                    rows = [r.tobytes() for r in np.split(rows, start[1:])] if len(node) else []
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(node), tree), pa.int32()), pa.array(node, pa.int32()), pa.array(rows, pa.binary())],
                        ["tree", "node", "rows"],
                    )

    columns = ["tree", "node", "feature", "bin", "left", "right", "n0", "n1", "depth"]

    def grow_rest(key, table):
        tree, node = key[0].as_py(), key[1].as_py()
        # in an order of their own, whatever order they come in
        rows = np.frombuffer(b"".join(sorted(table["rows"].to_pylist())), "i1").reshape(-1, width + 2)
        rng = np.random.default_rng([seed, tree, node, 1])
        t = subtree(rows[:, :width], rows[:, width].astype("i8"), rows[:, -1].astype("i8"), depths[tree, node], max_depth, k, rng)
        number = np.arange(len(t["feature"])) + ((node + 1) << 32)
        number[0] = node
        inner = t["feature"] >= 0
        left, right = (np.where(inner, number[np.where(inner, t[c], 0)], -1) for c in ("left", "right"))
        same = np.full(len(number), tree)
        values = [same, number, t["feature"], t["bin"], left, right, t["counts"][:, 0], t["counts"][:, 1], t["depth"]]
        return pa.table([pa.array(v.astype("i8")) for v in values], columns)

    schema = ", ".join(f"{c} long" for c in columns)
    sent = chunks.mapInArrow(send, "tree int, node int, rows binary").groupBy("tree", "node")
    lower = materialize(spark, sent.applyInArrow(grow_rest, schema), "forest_lower")
    roots = {u.tree: {} for u in upper}
    for r in lower.where("node < 4294967296").select("tree", "node", "feature").collect():
        roots[r.tree][r.node] = r.feature
    # the upper nodes, merged where all below has become one leaf
    kept, gone = [], []
    for u in upper:
        feature = np.array(u.feature)
        for node, f in roots[u.tree].items():
            feature[node] = f
        t = dict(left=np.array(u.left), right=np.array(u.right), counts=np.array(u.counts), depth=np.array(u.depth))
        inner = np.array(u.feature) >= 0
        below = np.where(inner, feature, np.where(feature >= 0, BINS * 99, -1))  # grown by a task: not to be merged
        own = below.copy()
        for d in range(int(t["depth"].max()), -1, -1):
            at = np.flatnonzero((t["depth"] == d) & inner)
            l, r, vote = t["left"][at], t["right"][at], t["counts"][:, 1] > t["counts"][:, 0]
            own[at[(own[l] < 0) & (own[r] < 0) & (vote[l] == vote[r])]] = -1
        reach = {0}
        for node in range(len(own)):
            if node in reach and inner[node] and own[node] >= 0:
                reach |= {u.left[node], u.right[node]}
        for node in range(len(own)):
            if node not in reach:
                gone += [(u.tree, node)] * (node in roots[u.tree])
            elif node not in roots[u.tree]:
                f = int(own[node])
                to = (u.bin[node], u.left[node], u.right[node]) if f >= 0 else (-1, -1, -1)
                kept.append((u.tree, node, f, *to, *u.counts[node], u.depth[node]))
    removed = spark.createDataFrame(gone, "tree long, node long")
    nodes = lower.join(F.broadcast(removed), ["tree", "node"], "left_anti").unionByName(spark.createDataFrame(kept, schema))

    def pack_tree(key, table):
        c = {n: np.asarray(table[n]) for n in columns}
        order = np.argsort(c["node"])
        c = {n: v[order] for n, v in c.items()}
        out = np.zeros(len(order), NODE)
        out["feature"], out["bin"] = c["feature"], c["bin"]
        for side in ("left", "right"):
            out[side] = np.where(c["feature"] >= 0, np.searchsorted(c["node"], c[side]), -1)
        out["fraud"] = np.where(c["feature"] < 0, c["n1"] / np.maximum(c["n0"] + c["n1"], 1), np.nan)
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()], pa.int32()), "depth": pa.array([c["depth"].max()], pa.int32()),
                "nodes": pa.array([len(out)], pa.int64()), "packed": [out.tobytes()],
            }
        )

    path = scratch_path(spark, "forest")
    nodes.groupBy("tree").applyInArrow(pack_tree, "tree int, depth int, nodes long, packed binary").write.parquet(path)
    return path, [p.tolist() for p in points]


# ------------------------------------------------------------------------------- the model
class GrownForest(Model, MLWritable, MLReadable):
    """The written trees as a pipeline stage, with the columns and names of Spark ML's forest."""

    def __init__(self, path: str, points: list[list[float]], trees: int, max_depth: int, columns: dict[str, str]):
        super().__init__()
        self.path, self.points, self.columns = path, points, columns
        self.getNumTrees, self._max_depth = trees, max_depth

    def getMaxDepth(self) -> int:
        return self._max_depth

    def getPredictionCol(self) -> str:
        return self.columns["prediction"]

    def _table(self) -> DataFrame:
        return SparkSession.active().read.parquet(self.path)

    @property
    def trees(self) -> list[Tree]:
        return [Tree(*r) for r in self._table().orderBy("tree").select("depth", "nodes").collect()]

    def nodes(self) -> DataFrame:
        """(tree, node, feature, threshold, left_child, right_child, fraud), as ``forest_nodes`` has them."""
        points = [np.array(p) for p in self.points]

        def unpack(batches):
            for batch in batches:
                for tree, packed in zip(batch["tree"].to_pylist(), batch["packed"].to_pylist()):
                    t = np.frombuffer(packed, NODE)
                    leaf = t["feature"] < 0
                    cut = np.array([0.0 if f < 0 else points[f][b] for f, b in zip(t["feature"], t["bin"])])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(t), tree), pa.int32()), pa.array(np.arange(len(t)), pa.int32()),
                            pa.array(t["feature"].astype("i4"), pa.int32(), mask=leaf), pa.array(cut, mask=leaf),
                            pa.array(t["left"], pa.int32(), mask=leaf), pa.array(t["right"], pa.int32(), mask=leaf),
                            pa.array(t["fraud"], mask=~leaf),
                        ],
                        ["tree", "node", "feature", "threshold", "left_child", "right_child", "fraud"],
                    )

        schema = "tree int, node int, feature int, threshold double, left_child int, right_child int, fraud double"
        return self._table().select("tree", "packed").mapInArrow(unpack, schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, points, names = dataset.sparkSession, [np.array(p) for p in self.points], self.columns
        vector, trees = names["features"], self.getNumTrees
        plain = dataset.drop(vector)

        def pack(batches):
            for chunk, t in _chunks(batches):
                x = _binned(t["_x"].combine_chunks(), points)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, t.drop_columns(["_x"]).schema) as out:
                    out.write_table(t.drop_columns(["_x"]))
                yield pa.RecordBatch.from_pydict({"chunk": [chunk], "x": [x.tobytes()], "rows": [sink.getvalue().to_pybytes()]})

        given = dataset.withColumn("_x", vector_to_array(vector)).select(*plain.columns, "_x")
        chunks = materialize(spark, given.mapInArrow(pack, "chunk long, x binary, rows binary"), "forest_scoring")

        def vote(batches):
            for batch in batches:
                for chunk, x, packed in zip(*(batch[c].to_pylist() for c in ("chunk", "x", "packed"))):
                    tree = np.frombuffer(packed, NODE)
                    tree = Top(*(np.ascontiguousarray(tree[c]) for c in ("feature", "bin", "left", "right", "fraud")), None)
                    share = tree.slot[nodes_of(tree, np.frombuffer(x, "i1").reshape(-1, len(points)))]
                    yield pa.RecordBatch.from_pydict({"chunk": [chunk], "votes": [share.tobytes()]})

        def add(key, table):
            total = sum(np.frombuffer(v.as_py(), "f8") for v in table["votes"])
            return pa.table({"chunk": [key[0].as_py()], "votes": [total.tobytes()]})

        def unpack(batches):
            for batch in batches:
                for rows, votes in zip(batch["rows"].to_pylist(), batch["votes"].to_pylist()):
                    t = pa.ipc.open_stream(rows).read_all()
                    yield from t.append_column("_votes", pa.array(np.frombuffer(votes, "f8"))).to_batches()

        pairs = chunks.select("chunk", "x").crossJoin(self._table().select("packed"))
        votes = pairs.mapInArrow(vote, "chunk long, votes binary").groupBy("chunk").applyInArrow(add, "chunk long, votes binary")
        schema = plain.schema.add("_votes", "double")
        scored = chunks.select("chunk", "rows").join(votes, "chunk").mapInArrow(unpack, schema)
        fraud = F.col("_votes") / F.lit(float(trees))
        return scored.withColumns(
            {
                names["raw"]: array_to_vector(F.array(F.lit(float(trees)) - F.col("_votes"), F.col("_votes"))),
                names["probability"]: array_to_vector(F.array(F.lit(1.0) - fraud, fraud)),
                names["prediction"]: F.when(fraud > 0.5, 1.0).otherwise(0.0),
            }
        ).drop("_votes")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: GrownForest):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, SparkSession.active()
        kept = {"points": m.points, "trees": m.getNumTrees, "max_depth": m.getMaxDepth(), "columns": m.columns}
        DefaultParamsWriter.saveMetadata(m, path, spark, {"forest": json.dumps(kept)})
        m._table().write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> GrownForest:
        meta = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        model = GrownForest(path=f"{path}/trees", **json.loads(meta["forest"]))
        model._resetUid(meta["uid"])
        return model
