"""Classification trees of any depth, any number of them grown in the same scans.

Rows are packed into blocks once, with a weight for every tree: one per fold, bag or setting. A scan adds up class
weights by open node, feature and bin for all trees; the driver splits every open node at its best cut. Nodes of at
most ``LOCAL`` rows are not split that way: when only such nodes are left, their rows meet by tree and node, and each
group grows its subtree to the end on the values themselves, so a small table's tree is exact. The number of scans
follows the depth of the large nodes, not the number of trees or of leaves.

A tree splits wherever a cut leaves enough rows on both sides, even without a gain, and ends at pure or minimal leaves or
at the depth asked for. Since growth is greedy, a tree cut off at a depth is the tree of that depth: a grid of depths
needs one tree. Ties go to the first feature and the lowest cut. The trees themselves live on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import over_blocks, packed, per_batch, summed
from tabloom.functions.expressions import argmax_index
from tabloom.models.adaboost import cut_points
from tabloom.session import dealt, keep

LOCAL = 20_000  # rows of a node that one task may finish
BINS = 128
HISTOGRAM = 4_000_000  # numbers that a scan adds up at once; more open nodes take more scans
NODE = "tree int, node int, at int, feature int, threshold double, low int, high int, counts array<double>"


class Tree:
    """Nodes as parallel lists; a leaf has feature -1. ``counts`` are the class weights of a node's training rows."""

    def __init__(self, counts: np.ndarray):
        self.feature, self.threshold, self.low, self.high, self.counts, self.depth = [-1], [0.0], [-1], [-1], [counts], [0]

    def split(self, node: int, feature: int, threshold: float, low: np.ndarray, high: np.ndarray) -> tuple[int, int]:
        at = len(self.feature)
        for counts in (low, high):
            for values, v in zip((self.feature, self.threshold, self.low, self.high, self.counts, self.depth), (-1, 0.0, -1, -1, counts, self.depth[node] + 1)):
                values.append(v)
        self.feature[node], self.threshold[node], self.low[node], self.high[node] = feature, threshold, at, at + 1
        return at, at + 1

    def arrays(self, depth: int | None = None) -> tuple:
        """feature, threshold, low, high, class shares; nodes at ``depth`` are leaves."""
        feature = np.array(self.feature, np.int32)
        if depth is not None and depth >= 0:
            feature = np.where(np.array(self.depth) >= depth, -1, feature)
        counts = np.array(self.counts, np.float64)
        return feature, np.array(self.threshold), np.array(self.low, np.int32), np.array(self.high, np.int32), counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300)


def _descend() -> Callable:
    """The node of every row in a tree, as a function that carries nothing but itself."""

    def run(x, feature, threshold, low, high):
        import numpy

        node, rows = numpy.zeros(len(x), dtype="int64"), numpy.arange(len(x))
        while len(rows):
            rows = rows[feature[node[rows]] >= 0]
            at = node[rows]
            node[rows] = numpy.where(x[rows, feature[at]] <= threshold[at], low[at], high[at])
        return node

    return run


def _local_growth(classes: int, least: float) -> Callable:
    """Grow a group's subtree exactly: ``grow(x, y, w, depth)`` gives (at, feature, threshold, low, high, counts)."""

    def grow(x, y, w, depth):
        import numpy

        hot = numpy.zeros((len(y), classes))
        hot[numpy.arange(len(y)), y] = w
        out, open_ = [], [(0, numpy.arange(len(y)), depth)]
        made = 1
        while open_:
            at, rows, left = open_.pop()
            mine = hot[rows]
            counts = mine.sum(axis=0)
            best = None
            if left != 0 and counts.sum() > counts.max():
                for f in range(x.shape[1]):
                    values = x[rows, f]
                    order = numpy.argsort(values, kind="stable")
                    ranked = values[order]
                    below = numpy.cumsum(mine[order], axis=0)[:-1]
                    cuts = numpy.flatnonzero(ranked[1:] > ranked[:-1])
                    if not len(cuts):
                        continue
                    below = below[cuts]
                    sums = below.sum(axis=1)
                    above = counts - below
                    rest = counts.sum() - sums
                    # the purest sides have the largest sum of squares over their size
                    purity = (below**2).sum(axis=1) / sums + (above**2).sum(axis=1) / rest
                    purity[(sums < least) | (rest < least)] = -numpy.inf
                    i = int(purity.argmax())
                    if purity[i] > -numpy.inf and (best is None or purity[i] > best[0] * (1 + 1e-12)):
                        a, b = ranked[cuts[i]], ranked[cuts[i] + 1]
                        middle = a + (b - a) / 2
                        best = purity[i], f, float(middle if a <= middle < b else a)
            if best is None:
                out.append((at, -1, 0.0, -1, -1, counts))
                continue
            low = x[rows, best[1]] <= best[2]
            out.append((at, best[1], best[2], made, made + 1, counts))
            open_ += [(made, rows[low], left - 1), (made + 1, rows[~low], left - 1)]
            made += 2
        return out

    return grow


def grow_together(
    blocks: DataFrame, rows: DataFrame, features: str, trees: int, classes: int, depth: int = -1, least: float = 1, local: int = LOCAL, bins: int = BINS
) -> list[Tree]:
    """One tree for each role of packed blocks; a row's role is its weight there. ``rows`` give the cut points."""
    width = rows.select(features).first()[0].size

    def add_classes(total, x, y, r):
        import numpy

        known = ~numpy.isnan(y)
        for c in range(classes):
            total[c::classes] += r[known & (y == c)].sum(axis=0)

    grown = [Tree(c) for c in summed(blocks, over_blocks(add_classes), trees * classes).reshape(trees, classes)]
    pending = [(t, 0) for t in range(trees)]
    cuts: list[np.ndarray] | None = None
    small: list[tuple[int, int]] = []

    def ends(t: int, node: int) -> bool:
        counts, at = grown[t].counts[node], grown[t].depth[node]
        return counts.sum() == counts.max() or counts.sum() < 2 * least or 0 <= depth <= at

    while True:
        pending = [(t, node) for t, node in pending if not ends(t, node)]
        small += [p for p in pending if grown[p[0]].counts[p[1]].sum() <= local]
        pending = [p for p in pending if grown[p[0]].counts[p[1]].sum() > local]
        if not pending:
            break
        if cuts is None:
            cuts = cut_points(rows.select(vector_to_array(features).alias("x")), width, bins)
        lengths = [len(c) + 1 for c in cuts]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        chunk = max(1, HISTOGRAM // (int(starts[-1]) * classes))
        following: list[tuple[int, int]] = []
        for begin in range(0, len(pending), chunk):
            part = pending[begin : begin + chunk]
            table = _histograms(blocks, grown, part, cuts, starts, classes)
            for (t, node), counts in zip(part, table):
                following += [(t, child) for child in _split(grown[t], node, counts, cuts, starts, least)]
        pending = following
    if small:
        _finish(blocks, grown, small, classes, depth, least)
    return grown


def _histograms(blocks, grown, part, cuts, starts, classes) -> np.ndarray:
    """(node, bin of all features, class) weights of open nodes, in one scan."""
    descend, total_bins = _descend(), int(starts[-1])
    by_tree: dict[int, dict[int, int]] = {}
    for place, (t, node) in enumerate(part):
        by_tree.setdefault(t, {})[node] = place
    plans = []
    for t, places in by_tree.items():
        arrays = grown[t].arrays()[:4]
        slot = np.full(len(arrays[0]), -1)
        slot[list(places)] = list(places.values())
        plans.append((t, arrays, slot))

    def add(total, x, y, r):
        import numpy

        known = ~numpy.isnan(y)
        coded = numpy.empty(x.shape, dtype="int64")
        for f, c in enumerate(cuts):
            coded[:, f] = starts[f] + numpy.searchsorted(c, x[:, f], side="left")
        for t, arrays, slot in plans:
            here = numpy.flatnonzero(known & (r[:, t] > 0))
            place = slot[descend(x[here], *arrays)]
            here, place = here[place >= 0], place[place >= 0]
            index = (place[:, None] * total_bins + coded[here]) * classes + y[here].astype("int64")[:, None]
            total += numpy.bincount(index.ravel(), numpy.repeat(r[here, t].astype("float64"), x.shape[1]), minlength=len(total))

    return summed(blocks, over_blocks(add), len(part) * total_bins * classes).reshape(len(part), total_bins, classes)


def _split(tree: Tree, node: int, table: np.ndarray, cuts, starts, least: float) -> Sequence[int]:
    """Split a node at the best cut of its histogram; none leaves it a leaf."""
    counts, best = tree.counts[node], None
    for f, c in enumerate(cuts):
        below = table[starts[f] : starts[f + 1]].cumsum(axis=0)[: len(c)]
        sums = below.sum(axis=1)
        rest, above = counts.sum() - sums, counts - below
        fits = (sums >= max(least, 1e-9)) & (rest >= max(least, 1e-9))
        if not fits.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            purity = np.where(fits, (below**2).sum(axis=1) / sums + (above**2).sum(axis=1) / rest, -np.inf)
        i = int(purity.argmax())
        if best is None or purity[i] > best[0] * (1 + 1e-12):
            best = purity[i], f, float(c[i]), below[i], above[i]
    return [] if best is None else tree.split(node, *best[1:])


def _finish(blocks, grown, small, classes, depth, least) -> None:
    """Grow the subtrees of small nodes where their rows meet."""
    descend, grow = _descend(), _local_growth(classes, max(least, 1e-9))
    plans = []
    for t in sorted({t for t, _ in small}):
        arrays = grown[t].arrays()[:4]
        wanted = np.zeros(len(arrays[0]), bool)
        wanted[[node for tree, node in small if tree == t]] = True
        plans.append((t, arrays, wanted))
    left = {(t, node): (depth - grown[t].depth[node] if depth >= 0 else -1) for t, node in small}

    def send(batches):
        import numpy
        import pyarrow

        for batch in batches:
            for n, *values in zip(*(column.to_pylist() for column in batch.columns)):
                x, y, r = (numpy.frombuffer(v, k).reshape(n, -1) for v, k in zip(values, ("float64", "float64", "int8")))
                for t, arrays, wanted in plans:
                    here = numpy.flatnonzero(~numpy.isnan(y[:, 0]) & (r[:, t] > 0))
                    node = descend(x[here], *arrays)
                    here, node = here[wanted[node]], node[wanted[node]]
                    flat = pyarrow.array(numpy.ascontiguousarray(x[here]).ravel())
                    offsets = pyarrow.array(numpy.arange(0, flat.__len__() + 1, max(x.shape[1], 1))[: len(here) + 1], "int32")
                    columns = [numpy.full(len(here), t, "int32"), node.astype("int32"), y[here, 0].astype("int32"), r[here, t].astype("float64")]
                    yield pyarrow.RecordBatch.from_arrays(
                        [*map(pyarrow.array, columns), pyarrow.ListArray.from_arrays(offsets, flat)], ["tree", "node", "y", "w", "x"]
                    )

    def subtree(key, group):
        import numpy
        import pyarrow

        t, node = (k.as_py() for k in key)
        x = group.column("x").combine_chunks()
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)
        y, w = (group.column(c).to_numpy() for c in ("y", "w"))
        order = numpy.lexsort((*x.T, y))  # whatever order the rows arrived in
        found = grow(x[order], y[order], w[order], left[t, node])
        columns = list(zip(*found))
        kinds = ["int32", "int32", "float64", "int32", "int32"]
        return pyarrow.table(
            [pyarrow.array([t] * len(found), "int32"), pyarrow.array([node] * len(found), "int32"), *(pyarrow.array(c, k) for c, k in zip(columns, kinds)), pyarrow.array([c.tolist() for c in columns[5]])],
            names=["tree", "node", "at", "feature", "threshold", "low", "high", "counts"],
        )

    rows = blocks.mapInArrow(send, "tree int, node int, y int, w double, x array<double>")
    parts: dict[tuple[int, int], dict[int, tuple]] = {}
    for r in rows.groupBy("tree", "node").applyInArrow(subtree, NODE).collect():
        parts.setdefault((r["tree"], r["node"]), {})[r["at"]] = r
    for (t, node), nodes in sorted(parts.items()):
        queue = [(node, 0)]
        while queue:
            place, at = queue.pop(0)
            r = nodes[at]
            if r["feature"] >= 0:
                counts = [np.array(nodes[r[side]]["counts"]) for side in ("low", "high")]
                made = grown[t].split(place, r["feature"], r["threshold"], *counts)
                queue += list(zip(made, (r["low"], r["high"])))


def scorer(trees: Sequence[Tree], depth: int | None = None) -> Callable[[np.ndarray], np.ndarray]:
    """A function from a matrix to the mean class shares of the trees."""
    descend, plans = _descend(), [t.arrays(depth) for t in trees]

    def score(x):
        total = 0.0
        for *arrays, shares in plans:
            total = total + shares[descend(x, *arrays)]
        return total / len(plans)

    return score


class GrownTree(Estimator):
    """One tree. ``max_depth`` -1 has no limit."""

    def __init__(self, classes, max_depth=5, min_samples_leaf=1, features="features", label="label", local=LOCAL, bins=BINS):
        super().__init__()
        self.classes, self.max_depth, self.min_samples_leaf = max(classes, 2), max_depth, min_samples_leaf
        self.features, self.label, self.local, self.bins = features, label, local, bins

    def _fit(self, df: DataFrame) -> GrownModel:
        trees = grown_trees(df, [F.lit(1)], self.classes, self.max_depth, self.min_samples_leaf, self.features, self.label, self.local, self.bins)
        return GrownModel(trees, self.features)


def grown_trees(df, weights: Sequence[Column], classes, depth, least, features, label, local=LOCAL, bins=BINS) -> list[Tree]:
    """Pack the rows and grow a tree for each weight column (small whole numbers)."""
    wanted = df.select(features, label, F.array(*[w.cast("tinyint") for w in weights]).alias("_weights"))
    width = df.select(features).first()[0].size
    blocks = keep(packed(dealt(wanted, df.count(), width), features, label, F.col("_weights")))
    trees = grow_together(blocks, df, features, len(weights), classes, depth, least, local, bins)
    blocks.unpersist()
    return trees


class GrownModel(Model):
    """Adds ``probability`` (mean class shares of the trees) and ``prediction``."""

    def __init__(self, trees: Sequence[Tree], features: str):
        super().__init__()
        self.trees, self.features = list(trees), features

    @property
    def models(self) -> list[Tree]:
        """The trees, by the name that ensembles of other models have."""
        return self.trees

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("_p", per_batch(scorer(self.trees), vector_to_array(self.features)))
        return scored.withColumn("probability", array_to_vector("_p")).withColumn("prediction", argmax_index("_p").cast("double")).drop("_p")
