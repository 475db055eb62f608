"""Random forests of deep trees, grown where their rows are (M5, M6).

Spark's own fit sends the sums of every node of every level through a shuffle and the driver; a deep tree has nodes
for every two or three rows, so 200 trees cost minutes even on small tables.  Here a tree's large nodes are split by
sums over all tasks (a pass a level, only bounded sums on the driver); once a node has at most ``NODE_ROWS`` rows of
its tree, these are dealt to one task, which grows the whole subtree in numpy.  Rows to be scored are dealt along, so
a subtree votes where it was grown and no node leaves its task.

The trees are those of Spark's estimator: each row counts Poisson(1) times its weight, ``maxBins`` bins a place,
the square root of the places drawn for each node, Gini gain, ordered categories, and sibling leaves of one
prediction merged (but not across the border of a part).  Draws are hashes of the seed, the tree and the stored row
or the node's path, so they depend neither on tasks nor on where a tree is cut into parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.ml.sums import even, matrix, total
from sparkfold.session import cut_lineage, ship_package

#: A node with at most so many rows of its tree is grown in one task.
NODE_ROWS = 200_000
#: So many rows are dealt to trees at once (a row counts for every tree): what a wave of trees writes to disk is bounded.
WAVE_ROWS = 20_000_000
#: Bins of nodes that are summed at once in a task: bounds its memory on wide levels.
SUMMED_BINS = 1 << 20
#: A side with less than this share of a node's weight is empty, a gain up to it is none: what is left of rounding.
ROUNDING = 1e-12


# --- draws ------------------------------------------------------------------------------------------------------------
def mix(*parts) -> np.ndarray:
    """64 well-mixed bits of the given integers (splitmix64), broadcast against each other."""
    out = np.zeros(1, np.uint64)
    for p in parts:
        out = (out ^ np.atleast_1d(np.asarray(p)).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
        out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out = out ^ (out >> np.uint64(31))
    return out


POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def drawn(seed: int, tree: int, row: np.ndarray) -> np.ndarray:
    """How often each row counts in a tree: Poisson(1)."""
    return np.searchsorted(POISSON, (mix(seed, 1, tree, row) >> np.uint64(11)) * 2.0 ** -53, side="right")


def subset(seed: int, tree: int, paths: np.ndarray, width: int, m: int) -> np.ndarray:
    """The ``m`` places that each node may split on: one row a node."""
    if m >= width:
        return np.broadcast_to(np.arange(width), (len(paths), width))
    return np.argpartition(mix(seed, 2, tree, paths[:, None], np.arange(width)), m - 1, axis=1)[:, :m]


# --- bins -------------------------------------------------------------------------------------------------------------
@dataclass
class Bins:
    """Upper bounds of each numeric place's bins (without the last); the number of categories of the other places."""

    width: int
    cuts: dict[int, np.ndarray]
    arity: dict[int, int]

    def __post_init__(self):
        self.most = max([1, *(len(c) + 1 for c in self.cuts.values()), *self.arity.values()])
        self.dtype = np.dtype(np.uint8 if self.most <= 256 else np.uint32)
        self.numeric = np.array([p in self.cuts for p in range(self.width)])

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, self.dtype)
        for p in range(self.width):
            if p in self.cuts:
                out[:, p] = np.searchsorted(self.cuts[p], x[:, p])
            elif not ((x[:, p] >= 0) & (x[:, p] < self.arity[p])).all():
                raise ValueError(f"place {p} of the vector holds no category below {self.arity[p]}")
            else:
                out[:, p] = x[:, p]
        return out


def fit_bins(df: DataFrame, col: str, rows: int, max_bins: int) -> Bins:
    """At most ``max_bins`` bins a numeric place: one a value where that is enough, else between quantiles of all rows."""
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    arity = {a["idx"]: n for a in attrs.get("nominal", ()) if (n := a.get("num_vals") or len(a.get("vals", ())))}
    if arity and max(arity.values()) > max_bins:
        raise ValueError(f"maxBins {max_bins} is less than the {max(arity.values())} categories of a place")
    width = df.select(F.size(vector_to_array(col))).first()[0]
    cuts = {a["idx"]: np.array([0.5]) for a in attrs.get("binary", ())}
    places = [p for p in range(width) if p not in arity and p not in cuts]
    most = max(2, min(max_bins, rows))
    x = df.select(vector_to_array(col).alias("_x")).select(*[F.get("_x", F.lit(p)).alias(f"p{p}") for p in places])
    many = x.agg(*[F.approx_count_distinct(c).alias(c) for c in x.columns]).first().asDict() if places else {}
    few = [c for c in x.columns if many[c] <= 2 * most]
    found = x.agg(*[F.collect_set(c).alias(c) for c in few]).first().asDict() if few else {}
    for c, values in found.items():
        values = np.unique(np.array([v for v in values if not math.isnan(v)], dtype=np.float64))
        if len(values) <= most:
            with np.errstate(invalid="ignore"):
                middle = (values[:-1] + values[1:]) / 2
            cuts[int(c[1:])] = np.where(np.isfinite(middle), middle, values[:-1])
    rest = [c for c in x.columns if int(c[1:]) not in cuts]
    if rest:
        for c, q in zip(rest, x.approxQuantile(rest, [i / most for i in range(1, most)], 0.1 / most)):
            cuts[int(c[1:])] = np.unique(np.array(q, dtype=np.float64))
    return Bins(width, cuts, arity)


def packed(m: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(m)], pa.binary())


def unpacked(column: pa.Array, dtype: np.dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


# --- the best split of nodes ------------------------------------------------------------------------------------------
def best_cut(hist: np.ndarray, totals: np.ndarray, numeric: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each node the gain of its best split on one place, and which bins go left.

    ``hist``: (nodes, bins, 2) weights by class; ``totals``: (nodes, 2); ``numeric``: whether the node's place is one.
    Categories are ordered by their share of class 1; a category without rows goes right.
    """
    nodes, bins, _ = hist.shape
    by = np.flatnonzero(~numeric)
    if len(by):
        weight = hist[by].sum(2)
        order = np.argsort(np.where(weight > 0, hist[by, :, 1] / np.where(weight > 0, weight, 1), np.inf), axis=1, kind="stable")
        hist[by] = np.take_along_axis(hist[by], order[:, :, None], axis=1)
    l0, l1 = np.cumsum(hist[:, :, 0], axis=1), np.cumsum(hist[:, :, 1], axis=1)
    r0, r1 = totals[:, :1] - l0, totals[:, 1:] - l1
    left, right, weight = l0 + l1, r0 + r1, totals.sum(1)
    least = ROUNDING * weight[:, None]
    fits = (left > least) & (right > least)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(fits, (l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / right, -np.inf)
    at = score.argmax(1)
    gain = (score[np.arange(nodes), at] - (totals ** 2).sum(1) / weight) / weight
    goes = np.arange(bins) <= at[:, None]
    if len(by):
        plain = goes[by]
        back = np.empty_like(plain)
        np.put_along_axis(back, order, plain, axis=1)
        goes[by] = back
    return gain, goes


@dataclass
class Draw:
    """What all parts of a forest share."""

    bins: Bins
    m: int
    depth: int
    seed: int


# --- a whole subtree in one task --------------------------------------------------------------------------------------
def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, shown: np.ndarray, tree: int, path: int, by: Draw) -> tuple[np.ndarray, np.ndarray]:
    """Grow the subtree of the node ``path`` (1: the root; 2p and 2p + 1: the children of p) on binned rows, level by level.

    Returns the share of class 1 in the leaf of each row of ``shown``, and the weighted gain of each place."""
    bins, width = by.bins.most, by.bins.width
    rows, slot, other, other_slot = np.arange(len(x)), np.zeros(len(x), np.int64), np.arange(len(shown)), np.zeros(len(shown), np.int64)
    paths, depth = np.array([path], np.int64), path.bit_length() - 1
    ended = np.zeros((len(shown), 2), np.int64)  # level and slot of each shown row's leaf
    levels: list[tuple[np.ndarray, ...]] = []  # totals, rank among the split nodes or -1, place, weighted gain
    while len(paths):
        k = len(paths)
        totals = np.bincount(slot * 2 + y[rows], weights=w[rows], minlength=2 * k).reshape(k, 2)
        gain, place, goes = np.zeros(k), np.zeros(k, np.int64), np.zeros((k, bins), bool)
        mixed = np.flatnonzero((totals > 0).all(1)) if depth < by.depth else np.zeros(0, np.int64)
        step = max(1, SUMMED_BINS // bins)
        for some in (mixed[i:i + step] for i in range(0, len(mixed), step)):
            here = np.full(k, -1)
            here[some] = np.arange(len(some))
            own = here[slot]
            inside = own >= 0
            at, r = own[inside], rows[inside]
            label, weight, drawn_places = y[r], w[r], subset(by.seed, tree, paths[some], width, by.m)
            for j in range(drawn_places.shape[1]):
                column = drawn_places[:, j]
                hist = np.bincount((at * bins + x[r, column[at]]) * 2 + label, weights=weight, minlength=len(some) * bins * 2)
                more, left = best_cut(hist.reshape(len(some), bins, 2), totals[some], by.bins.numeric[column])
                better = more > np.maximum(gain[some], ROUNDING)
                won = some[better]
                gain[won], place[won], goes[won] = more[better], column[better], left[better]
        split = gain > 0
        rank = np.where(split, np.cumsum(split) - 1, -1)
        levels.append((totals, rank, place, gain * totals.sum(1)))
        leaf = ~split[other_slot]
        ended[other[leaf]] = np.stack([np.full(leaf.sum(), len(levels) - 1), other_slot[leaf]], axis=1)

        def down(table: np.ndarray, r: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            stays = split[s]
            r, s = r[stays], s[stays]
            return r, 2 * rank[s] + ~goes[s, table[r, place[s]]]

        (rows, slot), (other, other_slot) = down(x, rows, slot), down(shown, other, other_slot)
        paths, depth = (2 * paths[split][:, None] + np.arange(2)).ravel(), depth + 1
    # sibling leaves of one prediction are one leaf; a row of it votes with the shares of all its rows
    leaves = [rank < 0 for _, rank, _, _ in levels]
    for i in range(len(levels) - 2, -1, -1):
        split = np.flatnonzero(levels[i][1] >= 0)
        says = (levels[i + 1][0][:, 1] > levels[i + 1][0][:, 0]).reshape(-1, 2)
        leaves[i][split[leaves[i + 1].reshape(-1, 2).all(1) & (says[:, 0] == says[:, 1])]] = True
    gains, shares = np.zeros(width), []
    for i, (totals, rank, place, gain) in enumerate(levels):
        kept = ~leaves[i]
        gains += np.bincount(place[kept], weights=gain[kept], minlength=width)
        with np.errstate(invalid="ignore"):
            share = totals[:, 1] / totals.sum(1)
        if i:
            above = np.flatnonzero(levels[i - 1][1] >= 0)
            share = np.where(np.repeat(leaves[i - 1][above], 2), np.repeat(shares[-1][above], 2), share)
        shares.append(share)
    first = np.cumsum([0, *(len(s) for s in shares)])
    return np.concatenate(shares)[first[ended[:, 0]] + ended[:, 1]], gains


# --- the large nodes of a tree ----------------------------------------------------------------------------------------
@dataclass
class Top:
    """A tree's nodes that were split by sums over all tasks, and below them the open ones and the leaves."""

    tree: int
    rows: list[int]  # of the tree in each node, at most
    path: list[int] = field(default_factory=lambda: [1])
    place: list[int] = field(default_factory=lambda: [-1])  # that an inner node splits on
    goes: list = field(default_factory=lambda: [None])
    child: list[int] = field(default_factory=lambda: [0])  # the left one; the right one follows
    gain: list[float] = field(default_factory=lambda: [0.0])  # weighted
    totals: list = field(default_factory=lambda: [None])  # of a leaf or inner node: weight by class

    def open(self) -> list[int]:
        return [i for i in range(len(self.path)) if self.totals[i] is None]

    def split(self, i: int, place: int, goes: np.ndarray, gain: float, rows: tuple[int, int]) -> None:
        self.place[i], self.goes[i], self.gain[i], self.child[i] = place, goes, gain, len(self.path)
        for side in (0, 1):
            for held, value in ((self.path, 2 * self.path[i] + side), (self.rows, rows[side]), (self.place, -1), (self.goes, None), (self.child, 0), (self.gain, 0.0), (self.totals, None)):
                held.append(value)

    def merge(self) -> None:
        """Sibling leaves of one prediction are one leaf."""
        for i in range(len(self.path) - 1, -1, -1):
            below = [self.child[i], self.child[i] + 1]
            if self.place[i] >= 0 and all(self.place[b] < 0 and self.totals[b] is not None for b in below) and len({self.totals[b][1] > self.totals[b][0] for b in below}) == 1:
                self.place[i], self.gain[i] = -1, 0.0

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The node, open or a leaf, that each row is in."""
        at = np.zeros(len(x), np.int64)
        if self.place[0] < 0:
            return at
        place, child = np.array(self.place), np.array(self.child)
        goes = np.stack([np.zeros_like(self.goes[0]) if g is None else g for g in self.goes])
        while len(r := np.flatnonzero(place[at] >= 0)):
            a = at[r]
            at[r] = child[a] + ~goes[a, x[r, place[a]]]
        return at


def split_large(rows: DataFrame, tops: list[Top], by: Draw, node_rows: int) -> None:
    """Split the nodes of more than ``node_rows`` rows, a pass over the rows a level of all trees."""
    bins, width = by.bins.most, by.bins.width
    m = min(by.m, width)
    while asked := [(top, i) for top in tops for i in top.open() if top.rows[i] > node_rows]:
        places = np.concatenate([subset(by.seed, top.tree, np.array([top.path[i]]), width, m) for top, i in asked])

        def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((len(asked), m, bins, 3))
            for batch in batches:
                x, y, w, row = opened(batch, by.bins)
                for top in tops:
                    mine = [k for k, (t, _) in enumerate(asked) if t is top]
                    if not mine or not len(x):
                        continue
                    local = np.full(len(top.path), -1)
                    local[[asked[k][1] for k in mine]] = np.arange(len(mine))
                    times = drawn(by.seed, top.tree, row)
                    r = np.flatnonzero(times)
                    at = local[top.descend(x[r])]
                    r, at = r[at >= 0], at[at >= 0]
                    weight = w[r] * times[r]
                    for j in range(m):
                        key = at * bins + x[r, places[mine][at, j]]
                        out[mine, j, :, :2] += np.bincount(key * 2 + y[r], weights=weight, minlength=len(mine) * bins * 2).reshape(-1, bins, 2)
                        out[mine, j, :, 2] += np.bincount(key, minlength=len(mine) * bins).reshape(-1, bins)
            return out.ravel()

        hist = total(rows, add, len(asked) * m * bins * 3).reshape(len(asked), m, bins, 3)
        totals = hist[:, 0, :, :2].sum(1)
        cuts = [best_cut(hist[:, j, :, :2].copy(), totals, by.bins.numeric[places[:, j]]) for j in range(m)]
        for k, (top, i) in enumerate(asked):
            top.totals[i] = totals[k]
            j = max(range(m), key=lambda j: cuts[j][0][k])
            gain, goes = cuts[j][0][k], cuts[j][1][k]
            if gain > ROUNDING and (totals[k] > 0).all() and top.path[i].bit_length() - 1 < by.depth:
                left, every = (int(hist[k, j, b, 2].sum()) for b in (goes, slice(None)))
                top.split(i, int(places[k, j]), goes, gain * totals[k].sum(), (left, every - left))
    for top in tops:
        top.merge()


# --- the forest -------------------------------------------------------------------------------------------------------
STORED = "x binary, y double, w double, row long, shown boolean"
DEALT = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("part", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("w", pa.binary()), ("row", pa.binary())])


def opened(batch: pa.RecordBatch, bins: Bins) -> tuple[np.ndarray, ...]:
    """Bins, labels, weights and numbers of a batch of stored rows."""
    y, w, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "row"))
    return unpacked(batch.column("x"), bins.dtype, bins.width), y.astype(np.int64), w, row


def takes(est: RandomForestClassifier) -> bool:
    """Whether the forest asks for nothing that is not grown here."""
    plain = {"impurity": "gini", "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0, "bootstrap": True}
    return all(est.getOrDefault(k) == v for k, v in plain.items()) and est.getFeatureSubsetStrategy() in ("auto", "sqrt", "all")


def _stored(est: RandomForestClassifier, train: DataFrame, count: int, shown: DataFrame | None, row: str, bins: Bins) -> DataFrame:
    """Training rows, numbered, and those of ``shown``, numbered in ``row``, with their bins as bytes."""
    vector = vector_to_array(est.getFeaturesCol()).alias("_x")
    w = F.col(est.getWeightCol()).cast("double") if est.isDefined("weightCol") and est.getWeightCol() else F.lit(1.0)
    rows = even(train.select(vector, F.col(est.getLabelCol()).cast("double").alias("y"), w.alias("w")), count) \
        .select("_x", "y", "w", F.monotonically_increasing_id().alias("row"), F.lit(False).alias("shown"))
    if shown is not None:
        rows = rows.union(shown.select(vector, F.lit(0.0), F.lit(0.0), F.col(row), F.lit(True)))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, w = (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            if not np.isin(y, (0, 1)).all() or not (w >= 0).all():
                raise ValueError("labels must be 0 or 1, weights 0 or more")
            x = bins.of(matrix(b.column("_x"))) if len(y) else np.zeros((0, bins.width), bins.dtype)
            yield pa.RecordBatch.from_arrays([packed(x), *(b.column(c) for c in ("y", "w", "row", "shown"))], names=["x", "y", "w", "row", "shown"])

    return cut_lineage(rows.mapInArrow(binned, STORED))


def _dealt(rows: DataFrame, tops: list[Top], by: Draw) -> DataFrame:
    """A record for each batch, tree and node with the rows of it: those the tree drew, and those to be scored.
    Rows to be scored that end in a leaf stay apart by task."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for b in batches:
            x, y, w, row = opened(b, by.bins)
            shown = b.column("shown").to_numpy(zero_copy_only=False)
            for top in tops:
                times = np.where(shown, 0, drawn(by.seed, top.tree, row))
                at, out = top.descend(x), []
                for kind in (False, True):
                    mine = np.flatnonzero(shown if kind else times)
                    order = mine[np.argsort(at[mine], kind="stable")]
                    for r in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                        ends = len(r) and top.totals[at[r[0]]] is not None
                        if not len(r) or ends and not kind:
                            continue
                        data = (x[r].tobytes(), b"", b"", row[r].tobytes()) if kind else (x[r].tobytes(), y[r].astype(np.uint8).tobytes(), (w[r] * times[r]).tobytes(), b"")
                        out.append((top.tree, int(at[r[0]]), task if ends else 0, *data))
                yield pa.RecordBatch.from_pylist([dict(zip(DEALT.names, o)) for o in out], schema=DEALT)

    sql = "tree int, node long, part int, x binary, y binary, w binary, row binary"
    groups, cores = sum(len(top.open()) for top in tops), rows.sparkSession.sparkContext.defaultParallelism
    return rows.mapInArrow(deal, sql).repartition(max(1, min(groups, 4 * cores)), "tree", "node", "part")


def _grown(est: RandomForestClassifier, train: DataFrame, count: int, shown: DataFrame | None, row: str) -> Iterator[tuple[list[Top], DataFrame]]:
    """Waves of trees: their tops, and a frame (tree, key, value) of the votes of all rows of ``shown`` (key: its number),
    or without it of the weighted gains below the tops (key: the place)."""
    ship_package(train.sparkSession)
    bins = fit_bins(train, est.getFeaturesCol(), count, est.getMaxBins())
    few = est.getFeatureSubsetStrategy() == "sqrt" or est.getFeatureSubsetStrategy() == "auto" and est.getNumTrees() > 1
    m = math.ceil(math.sqrt(bins.width)) if few else bins.width
    by = Draw(bins, m, est.getMaxDepth(), est.getSeed())
    rows = _stored(est, train, count, shown, row, bins)
    trees, most = est.getNumTrees(), max(1, WAVE_ROWS // max(1, rows.count()))
    for lo in range(0, trees, most):
        tops = [Top(t, [count]) for t in range(lo, min(lo + most, trees))]
        split_large(rows.where("not shown"), tops, by, NODE_ROWS)
        votes = shown is not None

        def finish(group: pa.Table) -> pa.Table:
            tree, node = group["tree"][0].as_py(), group["node"][0].as_py()
            top = tops[tree - lo]
            numbers = group["row"].to_pylist()
            kinds = [[g for g, r in zip(group[c].to_pylist(), numbers) if bool(r) == kind] for c, kind in (("x", False), ("x", True), ("y", False), ("w", False))]
            x, scored, y, w = (np.frombuffer(b"".join(parts), d) for parts, d in zip(kinds, (bins.dtype, bins.dtype, np.uint8, np.float64)))
            x, scored, row = x.reshape(-1, bins.width), scored.reshape(-1, bins.width), np.frombuffer(b"".join(numbers), np.int64)
            if top.totals[node] is not None:
                share = np.full(len(row), top.totals[node][1] / top.totals[node].sum())
            else:
                share, gains = grow(x, y.astype(np.int64), w, scored, tree, top.path[node], by)
            key, value = (row, share) if votes else (np.flatnonzero(gains), gains[gains != 0])
            return pa.table({"tree": pa.array(np.full(len(key), tree), pa.int32()), "key": pa.array(key, pa.int64()), "value": pa.array(value, pa.float64())})

        yield tops, _dealt(rows, tops, by).groupBy("tree", "node", "part").applyInArrow(finish, "tree int, key long, value double")


def votes(est: RandomForestClassifier, train: DataFrame, count: int, shown: DataFrame, row: str) -> list[DataFrame]:
    """Frames (``row``, _for, _all) of each wave of trees: the sum of their shares of class 1 and their number, for each row of ``shown``."""
    return [cut_lineage(grown.groupBy(F.col("key").alias(row)).agg(F.sum("value").alias("_for"), F.count("value").cast("double").alias("_all")))
            for _, grown in _grown(est, train, count, shown, row)]


def importances(est: RandomForestClassifier, train: DataFrame, count: int) -> np.ndarray:
    """The mean over the trees that split of each place's share of a tree's weighted gain."""
    held: dict[int, dict[int, float]] = {}
    for tops, grown in _grown(est, train, count, None, ""):
        below = [tuple(r) for r in grown.groupBy("tree", "key").agg(F.sum("value")).collect()]
        for tree, place, gain in [*below, *((t.tree, t.place[i], t.gain[i]) for t in tops for i in range(len(t.path)) if t.place[i] >= 0)]:
            held.setdefault(tree, {})[place] = held.get(tree, {}).get(place, 0.0) + gain
    width = train.select(F.size(vector_to_array(est.getFeaturesCol()))).first()[0]
    out = np.zeros(width)
    for gains in held.values():
        for place, gain in gains.items():
            out[place] += gain / sum(gains.values())
    return out / max(1, len(held))
