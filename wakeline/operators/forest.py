"""Random forests grown by tasks: the large form of ``model.train_forest``.

spark.ml grows a forest level by level, and for each node of a level every
partition fills and ships statistics of all bins of the node's features.  Deep
trees are mostly nodes of a few rows, so nearly all of that is empty.  Here

1. every feature is cut into at most ``maxBins`` bins, as spark.ml does (at all
   midpoints of up to that many values, else near equal shares of the weight);
2. nodes of more than ``LOCAL_ROWS`` rows are split by histograms added up over
   the partitions, some thousand nodes in a pass.  Only these top nodes are
   kept in the driver;
3. each partition deals its rows, in the tree's bootstrap sample, out to the
   nodes that are left, and one task grows all that lies below such a node.

Rules are those of spark.ml: Poisson bootstrap, a draw of features per node,
Gini impurity of weighted classes, a smallest number of rows per leaf, and
sibling leaves that predict alike are merged.  Statistics are whole numbers per
class, weighted when read, and draws hang on (seed, tree, number of the row) and
(seed, tree, node), so each pass and each task that is run again draws the same.
"""

from __future__ import annotations

import itertools
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_partitions, materialize
from .prefix import running_sum

#: Rows (repeats of the bootstrap counted) up to which one task grows all below a
#: node, and about as many are asked by one task.
LOCAL_ROWS = 500_000
#: Nodes split in one pass over the rows.
PASS_NODES = 1024
#: Trees dealt out in one record batch.
DEAL_TREES = 8
#: Votes are added up as whole numbers, so that their order does not matter.
VOTE = 1 << 48

#: The column that numbers the rows.
ROW = "__row"

DEALT = "tree int, node int, chunk int, n int, data binary"
GROWN = "tree int, node int, feature binary, bin binary, left binary, counts binary, gain binary, importance array<double>"
FOUND = "tree int, node int, feature int, bin int, gain double, total binary, low binary"

_FACTORIAL = np.cumprod(np.r_[1.0, np.arange(1, 20)])
_POISSON = np.cumsum(np.exp(-1.0) / _FACTORIAL)      # chance of at most 0, 1, ... draws


class Settings(NamedTuple):
    """What every task has to know."""
    splits: list[list[float]]    # of each feature: the thresholds between its bins
    weights: list[float]         # of each class
    trees: int
    take: int                    # features drawn per node
    depth: int
    min_leaf: int
    seed: int
    bootstrap: bool

    @property
    def bins(self) -> int:
        return max(map(len, self.splits)) + 1

    @property
    def used(self) -> list[int]:
        """The features that can split anything."""
        return [i for i, s in enumerate(self.splits) if s]


class Top(NamedTuple):
    """The split nodes of a tree that no task grows, and (feature -1) the nodes that tasks grow."""
    feature: list[int]
    bin: list[int]
    left: list[int]              # the right child comes next
    depth: list[int]             # levels that may follow, 0 for a leaf
    counts: list[list[int]]      # rows of each class, empty while not known
    gain: list[float]


def top_of(depth: int) -> Top:
    return Top([-1], [0], [-1], [depth], [[]], [0.0])


# ---------------------------------------------------------------- bins and draws

def split_points(rows: DataFrame, columns: Sequence[str], weight: str, bins: int) -> list[list[float]]:
    """The thresholds of each column, from all rows."""
    pairs = F.array(*[F.struct(F.lit(i).alias("_f"), F.col(c).alias("_v")) for i, c in enumerate(columns)])
    whole = F.greatest(F.lit(1), (F.col(weight) * 1e6).cast("long")).alias("_w")       # sums that do not hang on the order
    counted = rows.select(F.explode(pairs).alias("_p"), whole).select("_p.*", "_w").groupBy("_f", "_v").agg(F.sum("_w").alias("_w"))
    counted = counted.transform(materialize, "values")
    sizes = counted.groupBy("_f").agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w")).collect()   # one row per feature
    few, many = [r["_f"] for r in sizes if r["n"] <= bins], {r["_f"]: r["w"] for r in sizes if r["n"] > bins}
    spans = [(r["_f"], r["_v"], r["_v"]) for r in counted.where(F.col("_f").isin(few)).collect()]      # ``bins`` rows per feature at most
    if many:
        total = F.create_map(*[F.lit(x) for f, w in many.items() for x in (f, float(w))])[F.col("_f")]
        run = running_sum(counted.where(F.col("_f").isin(list(many))), ["_f"], "_v", "_w", out="_run")
        share = F.least(F.floor((F.col("_run") + F.col("_w") / 2) * bins / total), F.lit(bins - 1))
        ends = run.groupBy("_f", share.alias("_s")).agg(F.min("_v").alias("a"), F.max("_v").alias("b"))
        spans += [(r["_f"], r["a"], r["b"]) for r in ends.collect()]                                   # ``bins`` rows per feature at most
    out: list[list[float]] = [[] for _ in columns]
    spans.sort()
    for (f, _, b), (g, a, _) in zip(spans, spans[1:]):
        if f == g:
            middle = b + (a - b) / 2
            out[f].append(middle if b <= middle < a else b)
    return out


def _binned(batch: pa.RecordBatch, columns: Sequence[str], how: Settings) -> np.ndarray:
    """The used features of the rows as bins: value <= threshold k has bin k or less."""
    kept = [np.searchsorted(how.splits[i], batch.column(columns[i]).to_numpy(zero_copy_only=False), side="left") for i in how.used]
    return np.array(kept, dtype=np.uint8).reshape(len(kept), batch.num_rows).T.copy()


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64"""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bag(row: np.ndarray, tree: int, how: Settings) -> np.ndarray:
    """How often each row is in the tree's sample."""
    if not how.bootstrap:
        return np.ones(len(row), np.uint8)
    own = _mix(_mix(np.array([how.seed], np.int64).view(np.uint64)) ^ np.uint64(tree))
    u = (_mix(row.astype(np.uint64) + own) >> np.uint64(11)) * 2.0 ** -53
    return np.searchsorted(_POISSON, u, side="right").astype(np.uint8)


def _draw(rng: np.random.Generator, nodes: int, of: int, take: int) -> np.ndarray:
    """``take`` different features for each node (Floyd's sampling, for all nodes at once)."""
    out = np.empty((nodes, take), np.int32)
    for i, j in enumerate(range(of - take, of)):
        t = rng.integers(0, j + 1, nodes)
        out[:, i] = np.where((out[:, :i] == t[:, None]).any(axis=1), j, t)
    return out


def _rng(how: Settings, *of: int) -> np.random.Generator:
    return np.random.default_rng([how.seed & (2 ** 63 - 1), *of])


def _slots(how: Settings) -> np.ndarray:
    """Feature -> its place among the used ones, or -1."""
    out = np.full(len(how.splits), -1, np.int64)
    out[how.used] = np.arange(len(how.used))
    return out


# ---------------------------------------------------------------- splits

def _best(node: np.ndarray, counts: np.ndarray, totals: np.ndarray, weights: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """Cells (one feature's bins that hold rows, in order, node by node) -> of each
    node met: its best gain, the cell that ends its left side, and that side's rows by class."""
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    sizes = np.diff(np.r_[starts, len(node)])
    low = counts.cumsum(axis=0)
    low -= np.repeat(low[starts] - counts[starts], sizes, axis=0)
    total = totals[node]
    high = total - low
    fits = (low.sum(axis=1) >= min_leaf) & (high.sum(axis=1) >= max(1, min_leaf))
    a, b, w = low * weights, high * weights, total * weights
    sa, sb, s = a.sum(axis=1), b.sum(axis=1), w.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (((a * a).sum(axis=1) / sa + (b * b).sum(axis=1) / sb) - (w * w).sum(axis=1) / s) / s
    gain[~fits] = -1.0
    most = np.maximum.reduceat(gain, starts)
    at = np.flatnonzero(gain == np.repeat(most, sizes))
    first = at[np.r_[True, node[at[1:]] != node[at[:-1]]]]
    return node[starts], most, first, low[first]


def grow(x: np.ndarray, y: np.ndarray, c: np.ndarray, how: Settings, depth: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """All below a node: bins ``x`` of its rows, their classes and how often each row counts.
    Nodes come level by level; ``left`` is the place of the left child, the right one comes next."""
    weights, used, slot = np.array(how.weights), np.array(how.used, np.int64), _slots(how)
    k, n_used, flat = len(weights), x.shape[1], x.ravel()
    counts = np.bincount(y, weights=c, minlength=k).reshape(1, k)
    rows, rank, told = np.arange(len(y)), np.zeros(len(y), np.int64), (y.astype(np.int64) << 8) | c
    levels, size = [], 1
    while len(counts):
        m = len(counts)
        feature, cut, gains, left = np.full(m, -1, np.int64), np.zeros(m, np.int64), np.zeros(m), np.full(m, -1, np.int64)
        levels.append((feature, cut, left, counts, gains))
        opened = ((counts > 0).sum(axis=1) > 1) & (counts.sum(axis=1) >= 2 * how.min_leaf) & (depth > 0)
        keep = opened[rank]
        rows, rank, nodes, totals = rows[keep], (np.cumsum(opened) - 1)[rank[keep]], np.flatnonzero(opened), counts[opened]
        drawn = slot[_draw(rng, len(nodes), len(how.splits), how.take)]
        f, b, g = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes), np.int64), np.zeros(len(nodes))
        for s in range(drawn.shape[1]):
            mine = drawn[:, s][rank]
            has = np.flatnonzero(mine >= 0)
            if not len(has):
                continue
            # the sorted keys hold all that is needed: node, bin, class, repeats
            key = (((rank[has] << 8) | flat[rows[has] * n_used + mine[has]]) << 24) | told[rows[has]]
            key.sort()
            cell = key >> 24
            new = np.r_[True, cell[1:] != cell[:-1]]
            cell, at = cell[new], np.cumsum(new) - 1
            per_cell = np.bincount(at * k + ((key >> 8) & 0xFFFF), weights=key & 0xFF, minlength=len(cell) * k).reshape(-1, k)
            node, most, first, _ = _best(cell >> 8, per_cell, totals, weights, how.min_leaf)
            better = most > g[node]
            node, first = node[better], first[better]
            f[node], b[node], g[node] = drawn[node, s], cell[first] & 0xFF, most[better]
        split = f >= 0
        feature[nodes], cut[nodes], gains[nodes] = np.where(split, used[f] if len(used) else -1, -1), b, g
        q = int(split.sum())
        left[nodes[split]] = size + 2 * np.arange(q)
        keep = split[rank]
        rows, rank = rows[keep], rank[keep]
        rank = 2 * (np.cumsum(split) - 1)[rank] + (flat[rows * n_used + f[rank]] > b[rank])
        counts = np.bincount(rank * k + y[rows], weights=c[rows], minlength=2 * q * k).reshape(-1, k)
        size, depth = size + 2 * q, depth - 1
    return _merged(levels, weights)


def _merged(levels: list, weights: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes without sibling leaves that predict the same class: their parent is the leaf."""
    ends = np.cumsum([len(x[0]) for x in levels])
    feature, cut, left, counts, gain = (np.concatenate([x[i] for x in levels]) for i in range(5))
    says, live = (counts * weights).argmax(axis=1), np.ones(len(feature), bool)
    for end, level in zip(ends[::-1], levels[::-1]):
        at = np.arange(end - len(level[0]), end)
        at = at[feature[at] >= 0]
        a = left[at]
        same = (feature[a] < 0) & (feature[a + 1] < 0) & (says[a] == says[a + 1])
        feature[at[same]], gain[at[same]], live[a[same]], live[a[same] + 1] = -1, 0.0, False, False
    left = np.where(feature >= 0, (np.cumsum(live) - 1)[left], -1)
    out = {"feature": feature.astype(np.int32), "bin": cut.astype(np.uint8), "left": left.astype(np.int32), "counts": counts.astype(np.int32), "gain": gain}
    return {k: v[live] for k, v in out.items()}


def importances(feature: np.ndarray, counts: np.ndarray, gain: np.ndarray, how: Settings) -> np.ndarray:
    """Of each feature: the gains of the nodes it splits, times their weight."""
    split = feature >= 0
    worth = gain[split] * (counts[split].astype(float) @ np.array(how.weights))
    return np.bincount(feature[split], weights=worth, minlength=len(how.splits))


# ---------------------------------------------------------------- rows to nodes

def _routed(x: np.ndarray, slot: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at, go = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(go := go[feature[at[go]] >= 0]):
        here = at[go]
        at[go] = left[here] + (x[go, slot[feature[here]]] > cut[here])
    return at


def _open_node(x: np.ndarray, slot: np.ndarray, top: Top) -> np.ndarray:
    return _routed(x, slot, np.array(top.feature), np.array(top.bin), np.array(top.left))


def _dealer(columns: Sequence[str], tops: list[Top], how: Settings, training: bool, chunks: int) -> Callable:
    """Rows -> for each tree and each node that tasks grow: the bins of its rows, and in
    training class and repeats of a row, else its number.  Batches of rows go to ``chunks`` groups."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = _slots(how)
        for batch in batches:
            x, row = _binned(batch, columns, how), batch.column(ROW).to_numpy()
            y = batch.column("_class").to_numpy() if training else None
            chunk, out = int(_mix(row[:1].astype(np.uint64))[0] % chunks) if len(row) else 0, []
            for tree, top in enumerate(tops):
                c = _bag(row, tree, how) if training else None
                at = np.flatnonzero(c) if training else np.arange(len(row))
                node = np.zeros(len(at), np.int64)
                if top.feature[0] >= 0:
                    node = _open_node(x[at], slot, top)
                    order = np.argsort(node, kind="stable")
                    at, node = at[order], node[order]
                starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(at) else []
                for a, b in zip(starts, [*starts[1:], len(at)]):
                    part = at[a:b]
                    rest = y[part].astype("<u2").tobytes() + c[part].tobytes() if training else row[part].astype("<i8").tobytes()
                    out.append((tree, int(node[a]), chunk, len(part), x[part].T.tobytes() + rest))
                if tree % DEAL_TREES == DEAL_TREES - 1 or tree == len(tops) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in out], kind) for i, kind in enumerate([*[pa.int32()] * 4, pa.binary()])],
                        names=["tree", "node", "chunk", "n", "data"])
                    out = []
    return deal


def _received(table: pa.Table, how: Settings, *rest: str) -> list[np.ndarray]:
    """Dealt rows put together: their bins, then what else comes with each row."""
    u, parts = len(how.used), []
    for n, data in zip(table.column("n").to_pylist(), table.column("data")):
        view, at = data.as_buffer(), n * u
        part = [np.frombuffer(view, np.uint8, n * u).reshape(u, n).T]
        for kind in rest:
            part.append(np.frombuffer(view, kind, n, at))
            at += part[-1].nbytes
        parts.append(part)
    return [np.ascontiguousarray(np.concatenate(p)) for p in zip(*parts)]


# ---------------------------------------------------------------- growing

def _counter(columns: Sequence[str], tops: list[Top], drawn: dict[int, dict[int, np.ndarray]], how: Settings) -> Callable:
    """Rows -> of each node in ``drawn``: rows per class, then per drawn feature, bin and class."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, k, size = _slots(how), len(how.weights), how.bins * len(how.weights)
        sums = {(t, v): np.zeros(k + how.take * size) for t, nodes in drawn.items() for v in nodes}
        for batch in batches:
            x, row, y = _binned(batch, columns, how), batch.column(ROW).to_numpy(), batch.column("_class").to_numpy()
            for tree, nodes in drawn.items():
                c = _bag(row, tree, how)
                node = _open_node(x, slot, tops[tree])
                for v, features in nodes.items():
                    at = np.flatnonzero((node == v) & (c > 0))
                    total = sums[tree, v]
                    total[:k] += np.bincount(y[at], weights=c[at], minlength=k)
                    for i, f in enumerate(slot[features]):
                        if f >= 0:
                            total[k + i * size:][:size] += np.bincount(x[at, f].astype(np.int64) * k + y[at], weights=c[at], minlength=size)
        for (tree, node), total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([node], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             names=["tree", "node", "sums"])
    return count


def _chooser(drawn: dict[int, dict[int, np.ndarray]], how: Settings) -> Callable:
    """The partitions' counts of a node -> its rows per class and its best split."""
    def choose(table: pa.Table) -> pa.Table:
        k, weights, slot = len(how.weights), np.array(how.weights), _slots(how)
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        sums = sum(np.frombuffer(v.as_buffer()) for v in table.column("sums"))
        total, found = sums[:k], (-1, 0, 0.0, np.zeros(k))
        for i, f in enumerate(drawn[tree][node]):
            cells = sums[k + i * how.bins * k:][:how.bins * k].reshape(-1, k)
            bins = np.flatnonzero(cells.any(axis=1))
            if slot[f] >= 0 and len(bins):
                _, most, first, low = _best(np.zeros(len(bins), np.int64), cells[bins], total[None], weights, how.min_leaf)
                if most[0] > found[2]:
                    found = (int(f), int(bins[first[0]]), float(most[0]), low[0])
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "feature": pa.array([found[0]], pa.int32()),
                         "bin": pa.array([found[1]], pa.int32()), "gain": pa.array([found[2]]), "total": pa.array([total.tobytes()], pa.binary()),
                         "low": pa.array([found[3].tobytes()], pa.binary())})
    return choose


def _tops(rows: DataFrame, n: int, columns: Sequence[str], how: Settings) -> list[Top]:
    """Split the nodes that have too many rows for one task."""
    tops = [top_of(how.depth) for _ in range(how.trees)]
    todo = [(t, 0) for t in range(how.trees)] if n > LOCAL_ROWS and how.depth > 0 else []
    while todo:
        now, todo = todo[:PASS_NODES], todo[PASS_NODES:]
        drawn: dict[int, dict[int, np.ndarray]] = {}
        for t, v in now:
            drawn.setdefault(t, {})[v] = _draw(_rng(how, t, v), 1, len(how.splits), how.take)[0]
        sums = rows.mapInArrow(_counter(columns, tops, drawn, how), "tree int, node int, sums binary")
        for r in sums.groupBy("tree", "node").applyInArrow(_chooser(drawn, how), FOUND).collect():    # PASS_NODES rows at most
            top, v, total, low = tops[r["tree"]], r["node"], np.frombuffer(r["total"]), np.frombuffer(r["low"])
            top.counts[v] = total.astype(int).tolist()
            depth, top.depth[v] = top.depth[v], 0
            if r["feature"] < 0:
                continue
            top.feature[v], top.bin[v], top.left[v], top.gain[v] = r["feature"], r["bin"], len(top.feature), r["gain"]
            for side in (low, total - low):
                mixed = int((side > 0).sum()) > 1
                top.feature.append(-1)
                top.bin.append(0)
                top.left.append(-1)
                top.depth.append(depth - 1 if mixed else 0)
                top.counts.append(side.astype(int).tolist())
                top.gain.append(0.0)
                if mixed and depth > 1 and side.sum() > LOCAL_ROWS:
                    todo.append((r["tree"], len(top.feature) - 1))
    return tops


def _grower(tops: list[Top], how: Settings) -> Callable:
    def task(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        x, y, c = _received(table, how, "<u2", "u1")
        found = grow(x, y, c, how, tops[tree].depth[node], _rng(how, tree, node, 1))
        return _stored(tree, node, found, how)
    return task


def _stored(tree: int, node: int, found: dict[str, np.ndarray], how: Settings) -> pa.Table:
    worth = importances(found["feature"], found["counts"], found["gain"], how)
    return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32())}
                    | {k: pa.array([found[k].tobytes()], pa.binary()) for k in KINDS}
                    | {"importance": pa.array([worth.tolist()], pa.list_(pa.float64()))})


#: How the nodes of a stored subtree are written; ``counts`` has a number per class.
KINDS = {"feature": np.int32, "bin": np.uint8, "left": np.int32, "counts": np.int32, "gain": np.float64}


def read_nodes(row, how: Settings) -> dict[str, np.ndarray]:
    """A stored subtree; ``row`` gives bytes by name."""
    out = {k: np.frombuffer(row[k], kind) for k, kind in KINDS.items()}
    return out | {"counts": out["counts"].reshape(-1, len(how.weights))}


def _tasks(rows: DataFrame, n: int, how: Settings) -> int:
    return max(default_partitions(rows.sparkSession), -(-n * how.trees // LOCAL_ROWS))


def grow_forest(rows: DataFrame, n: int, columns: Sequence[str], how: Settings, path: str) -> list[Top]:
    """Grow all trees and store them under ``path``.  ``rows``: ``columns``, ``_class`` (number of
    the class) and ``ROW`` (a number of its own), read the same at every pass."""
    tops = _tops(rows, n, columns, how)
    dealt = rows.mapInArrow(_dealer(columns, tops, how, True, 1), DEALT).repartition(_tasks(rows, n, how), "tree", "node")
    dealt.groupBy("tree", "node").applyInArrow(_grower(tops, how), GROWN).write.parquet(path)
    if any(top.feature[0] >= 0 for top in tops):
        _merge_tops(rows.sparkSession, tops, how, path)
    return tops


def _merge_tops(spark, tops: list[Top], how: Settings, path: str) -> None:
    """Sibling leaves that predict alike, where their parent is a top node.  The children's
    rows stay stored: no row is dealt to them any more."""
    leaves, weights, more = {}, np.array(how.weights), []
    single = spark.read.parquet(path).where(F.octet_length("bin") == 1).select("tree", "node", "counts")
    for r in single.collect():                 # at most one row per node that a task began with
        leaves[r["tree"], r["node"]] = np.frombuffer(r["counts"], np.int32)
    for tree, top in enumerate(tops):
        for v in range(len(top.feature) - 1, -1, -1):
            a, b = (leaves.get((tree, top.left[v] + i)) for i in (0, 1)) if top.feature[v] >= 0 else (None, None)
            if a is not None and b is not None and (a * weights).argmax() == (b * weights).argmax():
                top.feature[v], top.gain[v], leaves[tree, v] = -1, 0.0, a + b
                found = {"feature": np.array([-1], np.int32), "bin": np.zeros(1, np.uint8), "left": np.array([-1], np.int32),
                         "counts": leaves[tree, v][None].astype(np.int32), "gain": np.zeros(1)}
                more += _stored(tree, v, found, how).to_pylist()
    if more:
        spark.createDataFrame(more, GROWN).write.mode("append").parquet(path)


# ---------------------------------------------------------------- using a stored forest

def votes(rows: DataFrame, n: int, columns: Sequence[str], tops: list[Top], how: Settings, path: str) -> DataFrame:
    """``(ROW, _votes)``: the trees' shares of each class, added up."""
    names = [f"v{i}" for i in range(len(how.weights))]

    def vote(dealt: pa.Table, stored: pa.Table) -> pa.Table:
        number, out = np.zeros(0, np.int64), np.zeros((0, len(names)), np.int64)
        if dealt.num_rows and stored.num_rows:      # a tree without any row in its sample has no vote
            x, number = _received(dealt, how, "<i8")
            found = read_nodes({k: stored.column(k)[0].as_buffer() for k in KINDS}, how)
            leaf = found["feature"] < 0
            weight = found["counts"] * np.array(how.weights)
            share = np.zeros(weight.shape, np.int64)
            share[leaf] = np.rint(weight[leaf] / weight[leaf].sum(axis=1, keepdims=True) * VOTE)
            out = share[_routed(x, _slots(how), found["feature"], found["bin"], found["left"])]
        return pa.table({ROW: number} | {name: np.ascontiguousarray(out[:, i]) for i, name in enumerate(names)})

    keys, tasks, chunks = ["tree", "node", "chunk"], _tasks(rows, n, how), -(-n // LOCAL_ROWS) or 1
    dealt = rows.mapInArrow(_dealer(columns, tops, how, False, chunks), DEALT).repartition(tasks, *keys)
    trees = rows.sparkSession.read.parquet(path).select("tree", "node", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), *KINDS)
    each = dealt.groupBy(*keys).cogroup(trees.repartition(tasks, *keys).groupBy(*keys)) \
                .applyInArrow(vote, ", ".join([f"{ROW} long", *[f"{x} long" for x in names]]))
    total = each.groupBy(ROW).agg(*[F.sum(x).alias(x) for x in names])
    return total.select(ROW, F.array(*[F.col(x) / float(VOTE) for x in names]).alias("_votes"))


def tree_importances(spark, tops: list[Top], how: Settings, path: str) -> np.ndarray:
    """One row per tree: its features' importances, as shares of their sum (zeros for a tree without a split)."""
    out = np.zeros((how.trees, len(how.splits)))
    each = spark.read.parquet(path).select("tree", F.posexplode("importance").alias("f", "w")).groupBy("tree", "f").agg(F.sum("w").alias("w"))
    for r in each.collect():                   # trees times features
        out[r["tree"], r["f"]] = r["w"]
    for tree, top in enumerate(tops):
        if top.feature[0] >= 0:
            split = [v for v, f in enumerate(top.feature) if f >= 0]
            out[tree] += importances(*(np.array([x[v] for v in split]) for x in (top.feature, top.counts, top.gain)), how)
    sums = out.sum(axis=1, keepdims=True)
    return np.divide(out, sums, out=out, where=sums > 0)


def node_rows(spark, first: int, last: int, tops: list[Top], how: Settings, path: str) -> Iterator[tuple]:
    """The nodes of the trees [first, last) as spark.ml stores them, tree by tree."""
    kept = spark.read.parquet(path).where(F.col("tree").between(first, last - 1)).select("tree", "node", *KINDS)
    stored = {(r["tree"], r["node"]): read_nodes(r, how) for r in kept.collect()}     # the trees of one part
    weights = np.array(how.weights)
    none = {"feature": [-1], "counts": [[0] * len(weights)]}                          # no row was in the sample
    for tree in range(first, last):
        top, queue, made = tops[tree]._asdict(), deque([(None, 0)]), 1
        for here in itertools.count():
            if not queue:
                break
            nodes, v = queue.popleft()
            if nodes is None and top["feature"][v] < 0:
                nodes, v = stored.get((tree, v), none), 0
            of = top if nodes is None else nodes
            f, w, n = int(of["feature"][v]), np.array(of["counts"][v]) * weights, int(sum(of["counts"][v]))
            gain, children, split = -1.0, (-1, -1), (-1, [], -1)
            if f >= 0:
                queue += [(nodes, int(of["left"][v])), (nodes, int(of["left"][v]) + 1)]
                gain, children, split, made = float(of["gain"][v]), (made, made + 1), (f, [float(how.splits[f][int(of["bin"][v])])], -1), made + 2
            gini = 1.0 - float((w * w).sum() / max(w.sum() ** 2, 1e-300)) if n else 0.0
            yield tree - first, (here, float(w.argmax()), gini, [*w.tolist(), 0.0], n, gain, *children, split)
