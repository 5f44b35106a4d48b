"""Support vector machines on the kernel itself, by decomposition of the dual problem.

There is one machine for every pair of classes, and the classes vote. Training rows lie in packed blocks
with their multipliers and margins. A step is one job for all machines: every block adds the last step's
changes to its margins and offers its worst violators; the worst of all (at most ``working`` rows a machine)
reach the driver, which solves the problem of these rows exactly and sends the changed multipliers back. The
step's cost is rows x ``working`` kernel values, and no kernel matrix of all rows exists anywhere.

Equal rows of one class are one row with a higher bound, so copies cost nothing. A fit ends when no pair of
rows violates the optimality conditions by more than ``tol``; otherwise it warns. ``machines`` reports the
violation, the duality gap and the number of support vectors.
"""

from __future__ import annotations

import itertools
import warnings

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.blocks import per_batch, summed
from tabloom.session import dealt, keep, stored

BLOCK_ROWS = 1024
MODEL_BYTES = 32 << 20  # support vectors up to this size travel to the tasks; more are joined in blocks
STEPS_BETWEEN_WRITES = 10  # the blocks are written to the shared folder after so many steps
GROUP_BLOCKS, BUCKETS = 8, 32  # sides of the grid on which packs of rows meet blocks of support vectors
STATE = "block long, n int, x binary, y binary, w binary, a binary, f binary"
CANDIDATE = "machine int, up boolean, score double, block long, place int, y double, a double, cap double, f double, x binary"


def kernel_function(kind: str, gamma: float, degree: int, coef0: float):
    """Kernel values of the rows of two matrices."""

    def kernel(x, z):
        if kind == "rbf":
            distance = (x * x).sum(axis=1)[:, None] + (z * z).sum(axis=1)[None, :] - 2 * (x @ z.T)
            return np.exp(-gamma * np.maximum(distance, 0))
        inner = x @ z.T
        if kind == "linear":
            return inner
        return (gamma * inner + coef0) ** degree if kind == "poly" else np.tanh(gamma * inner + coef0)

    return kernel


def solve_pairs(kernel: np.ndarray, y: np.ndarray, cap: np.ndarray, a: np.ndarray, f: np.ndarray, tol: float) -> np.ndarray:
    """Multipliers of a small problem, all other rows fixed: the best pair moves until none violates by ``tol``."""
    a, v = a.copy(), y - f
    own = np.diag(kernel)
    for _ in range(200 * len(y)):
        up, low = np.where(y > 0, a < cap, a > 0), np.where(y > 0, a > 0, a < cap)
        i = int(np.argmax(np.where(up, v, -np.inf)))
        gap = np.where(low, v[i] - v, -np.inf)
        if not up[i] or gap.max() <= tol:
            break
        curve = np.maximum(own[i] + own - 2 * kernel[i], 1e-12)
        j = int(np.argmax(np.where(gap > 0, gap * gap / curve, -1.0)))
        room_i = cap[i] - a[i] if y[i] > 0 else a[i]
        room_j = a[j] if y[j] > 0 else cap[j] - a[j]
        step = min(gap[j] / curve[j], room_i, room_j)
        for k, move, room in ((i, y[i] * step, room_i), (j, -y[j] * step, room_j)):
            # a multiplier that uses all its room lies on its bound exactly
            a[k] = (cap[k] if move > 0 else 0.0) if step == room else a[k] + move
        v -= step * (kernel[i] - kernel[j])
    return a


class ExactKernelMachine(Estimator):
    """Hinge loss with a bias, ``cost`` a row, on the kernel itself; see the module for the method.

    Rows without a label or features are left out. A class without rows is never voted for; a pair of classes of
    which only one has rows always votes for that one. Most votes win, ties go to the smaller class. With an
    indefinite kernel (sigmoid) the fit ends at a stationary point, and the duality gap is no bound.
    """

    def __init__(
        self, classes, kernel="sigmoid", cost=1.0, gamma=0.1, degree=3, coef0=0.0, tol=1e-3, max_iter=500,
        working=512, model_bytes=MODEL_BYTES, features="features", label="label",
    ):
        super().__init__()
        if kernel not in ("linear", "rbf", "sigmoid", "poly") or classes < 2:
            raise ValueError(f"kernel {kernel} or {classes} classes cannot be fitted")
        self.classes, self.cost, self.tol, self.max_iter = classes, float(cost), float(tol), max_iter
        self.kernel = kernel_function(kernel, float(gamma), int(degree), float(coef0))
        self.working, self.model_bytes, self.features, self.label = working, model_bytes, features, label
        self.pairs = list(itertools.combinations(range(classes), 2))

    def _fit(self, df: DataFrame) -> ExactKernelMachineModel:
        state = self._blocks(df)
        count = len(self.pairs)
        for step in range(self.max_iter + 1):
            offered = self._violators(state)
            updates, ends = [], []
            for m in range(count):
                rows = [r for r in offered if r["machine"] == m]
                best = [max((r["score"] for r in rows if r["up"] == side), default=-np.inf) for side in (True, False)]
                ends.append(best)
                if sum(best) > self.tol and step < self.max_iter:
                    updates.append((m, *self._solved(rows)))
            if not updates:
                break
            following = self._advanced(state, updates)
            if step % STEPS_BETWEEN_WRITES == STEPS_BETWEEN_WRITES - 1:
                following = stored(following, "kernel-rows")
            else:
                keep(following).count()  # the step before is no longer needed once this one is cached
            state.unpersist()
            state = following
        model = self._model(state, np.array(ends))
        state.unpersist()
        violation = max((r["violation"] for r in model.report), default=0.0)
        if violation > self.tol:
            warnings.warn(f"kernel machine stopped at a violation of {violation:.3g} after {self.max_iter} steps", stacklevel=2)
        return model

    def _blocks(self, df: DataFrame) -> DataFrame:
        """Different rows of each class with their number, packed, multipliers and margins zero."""
        width, count = len(self.pairs), BLOCK_ROWS
        named = df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
        rows = keep(named.where(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("x", "y").agg(F.count("*").cast("double").alias("w")))
        size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("p")).first()

        def pack(batches):
            import pyarrow

            for batch in batches:
                for start in range(0, batch.num_rows, count):
                    part = batch.slice(start, count)
                    n = part.num_rows
                    x = part.column(0).flatten().to_numpy(zero_copy_only=False)
                    y, w = (part.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
                    empty = np.zeros((n, width))
                    cells = [pyarrow.array([np.ascontiguousarray(v, dtype="float64").tobytes()], "binary") for v in (x, y, w, empty, empty)]
                    yield pyarrow.RecordBatch.from_arrays([pyarrow.array([n], "int32"), *cells], ["n", "x", "y", "w", "a", "f"])

        packed = dealt(rows, size["n"], size["p"] or 1).mapInArrow(pack, "n int, x binary, y binary, w binary, a binary, f binary")
        # numbers of blocks hold once they are written
        blocks = stored(packed.select(F.monotonically_increasing_id().alias("block"), "*"), "kernel-rows")
        rows.unpersist()
        return blocks

    def _advanced(self, state: DataFrame, updates: list) -> DataFrame:
        """The blocks after the changes of one step."""
        kernel, machines = self.kernel, len(self.pairs)

        def advance(batches):
            import pyarrow

            for batch in batches:
                a_cells, f_cells = [], []
                for block, n, x, _, _, a, f in zip(*(c.to_pylist() for c in batch.columns)):
                    x = np.frombuffer(x).reshape(n, -1)
                    a, f = (np.frombuffer(v).reshape(n, machines).copy() for v in (a, f))
                    for m, points, change, blocks, places, values in updates:
                        f[:, m] += kernel(x, points) @ change
                        here = blocks == block
                        a[places[here], m] = values[here]
                    a_cells.append(a.tobytes())
                    f_cells.append(f.tobytes())
                cells = [*batch.columns[:5], pyarrow.array(a_cells, "binary"), pyarrow.array(f_cells, "binary")]
                yield pyarrow.RecordBatch.from_arrays(cells, batch.schema.names)

        return state.mapInArrow(advance, STATE)

    def _offers(self, state: DataFrame) -> DataFrame:
        """The rows of every partition that violate most, ``working / 2`` of each side and machine."""
        pairs, cost, half = self.pairs, self.cost, max(1, self.working // 2)

        def offer(batches):
            import pyarrow

            names = ("machine", "up", "score", "block", "place", "y", "a", "cap", "f", "x")
            types = ("int32", "bool", "float64", "int64", "int32", "float64", "float64", "float64", "float64", "binary")
            worst = {}  # by machine and side: the numbers of its worst rows so far, and their inputs
            for batch in batches:
                for block, n, x, label, w, a, f in zip(*(c.to_pylist() for c in batch.columns)):
                    x, label, cap = np.frombuffer(x).reshape(n, -1), np.frombuffer(label), cost * np.frombuffer(w)
                    a, f = (np.frombuffer(v).reshape(n, len(pairs)) for v in (a, f))
                    for m, (first, second) in enumerate(pairs):
                        y = np.where(label == first, 1.0, np.where(label == second, -1.0, 0.0))
                        free, used = a[:, m] < cap, a[:, m] > 0
                        for up in (True, False):
                            able = np.where((y > 0) == up, free, used)
                            score = np.where(able & (y != 0), (y - f[:, m]) * (1 if up else -1), -np.inf)
                            order = np.argsort(-score, kind="stable")[:half]
                            order = order[np.isfinite(score[order])]
                            found = [score[order], np.full(len(order), block), order, y[order], a[order, m], cap[order], f[order, m], x[order]]
                            if (m, up) in worst:
                                found = [np.concatenate(v) for v in zip(worst[m, up], found)]
                            kept = np.lexsort((found[2], found[1], -found[0]))[:half]
                            worst[m, up] = [v[kept] for v in found]
            for (m, up), (*values, x) in worst.items():
                if k := len(x):
                    values = (np.full(k, m), np.full(k, up), *values, [row.tobytes() for row in x])
                    yield pyarrow.RecordBatch.from_arrays([pyarrow.array(v, t) for v, t in zip(values, types)], names)

        return state.mapInArrow(offer, CANDIDATE)

    def _violators(self, state: DataFrame) -> list:
        """The rows that violate most of all, ``working / 2`` of each side and machine."""
        half = max(1, self.working // 2)
        best = Window.partitionBy("machine", "up").orderBy(F.desc("score"), "block", "place")
        return self._offers(state).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= half).collect()

    def _solved(self, rows: list) -> tuple:
        """Points, changes of signed multipliers, places and multipliers of one machine's working rows."""
        rows = list({(r["block"], r["place"]): r for r in rows}.values())
        points = np.array([np.frombuffer(r["x"]) for r in rows])
        y, cap, a, f = (np.array([r[c] for r in rows]) for c in ("y", "cap", "a", "f"))
        after = solve_pairs(self.kernel(points, points), y, cap, a, f, self.tol / 10)
        moved = after != a
        blocks, places = np.array([r["block"] for r in rows]), np.array([r["place"] for r in rows])
        return points[moved], ((after - a) * y)[moved], blocks[moved], places[moved], after[moved]

    def _model(self, state: DataFrame, ends: np.ndarray) -> ExactKernelMachineModel:
        pairs, cost, machines = self.pairs, self.cost, len(self.pairs)

        def over(take):
            def add(total, batch):
                parts = total.reshape(machines, -1)
                for _, n, x, label, w, a, f in zip(*(c.to_pylist() for c in batch.columns)):
                    label, cap = np.frombuffer(label), cost * np.frombuffer(w)
                    a, f = (np.frombuffer(v).reshape(n, machines) for v in (a, f))
                    for m, (first, second) in enumerate(pairs):
                        y = np.where(label == first, 1.0, np.where(label == second, -1.0, 0.0))
                        parts[m] += take(m, y, cap, a[:, m], f[:, m])

            return add

        def sums(m, y, cap, a, f):
            free = (a > 0) & (a < cap)
            return free.sum(), (y - f)[free].sum(), a.sum(), (a * y * f).sum(), (a > 0).sum(), (y > 0).sum(), (y < 0).sum()

        free, margin, total, quadratic, vectors, first, second = summed(state, over(sums), machines * 7).reshape(machines, 7).T
        only = np.sign(first) - np.sign(second)  # one class of the pair, or none, has rows
        both = (first > 0) & (second > 0)
        middle = np.where(both, np.subtract(*ends.T, where=both, out=np.zeros(machines)) / 2, 0)
        bias = np.where(both, np.where(free > 0, margin / np.maximum(free, 1), middle), only)
        losses = summed(state, over(lambda m, y, cap, a, f: ((cap * np.maximum(0, 1 - y * (f + bias[m])))[y != 0].sum(),)), machines)
        report = [
            {
                "first": i, "second": j, "vectors": int(vectors[m]), "bias": float(bias[m]),
                "violation": float(max(ends[m].sum(), 0.0)) if both[m] else 0.0,
                "gap": float(quadratic[m] + losses[m] - total[m]) if both[m] else 0.0, "dual": float(total[m] - quadratic[m] / 2),
            }
            for m, (i, j) in enumerate(pairs)
        ]

        def supports(batches):
            import pyarrow

            for batch in batches:
                for block, n, x, label, _, a, _ in zip(*(c.to_pylist() for c in batch.columns)):
                    x, label, a = np.frombuffer(x).reshape(n, -1), np.frombuffer(label), np.frombuffer(a).reshape(n, machines)
                    used = (a > 0).any(axis=1)
                    if used.any():
                        signs = np.array([np.where(label == i, 1.0, np.where(label == j, -1.0, 0.0)) for i, j in pairs]).T
                        cells = (np.ascontiguousarray(v[used]).tobytes() for v in (x, a * signs))
                        values = [pyarrow.array([block], "int64"), pyarrow.array([int(used.sum())], "int32"), *(pyarrow.array([c], "binary") for c in cells)]
                        yield pyarrow.RecordBatch.from_arrays(values, ["block", "n", "x", "c"])

        table = stored(state.mapInArrow(supports, "block long, n int, x binary, c binary"), "support-vectors")
        return ExactKernelMachineModel(self, table, bias, both | (only != 0), report)


class ExactKernelMachineModel(Model):
    """Adds ``prediction`` and ``rawPrediction``: two classes have the margin and its negative, more have votes plus squashed margins."""

    def __init__(self, fit: ExactKernelMachine, vectors: DataFrame, bias: np.ndarray, decides: np.ndarray, report: list):
        super().__init__()
        self.fit_settings, self.vectors, self.bias, self.decides, self.report = fit, vectors, bias, decides, report

    def machines(self) -> DataFrame:
        """A row for each pair of classes: support vectors, bias, violation, duality gap and dual value."""
        columns = "first int, second int, vectors long, bias double, violation double, gap double, dual double"
        return self.vectors.sparkSession.createDataFrame(self.report, columns)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fit_settings
        size = self.vectors.agg(F.sum(F.length("x") + F.length("c"))).first()[0] or 0
        scored = self._carried(df) if size <= s.model_bytes else self._joined(df)
        classes, pairs, bias, decides = s.classes, s.pairs, self.bias, self.decides

        def decide(margins):
            margins = margins + bias
            votes, leaning = np.zeros((len(margins), classes)), np.zeros((len(margins), classes))
            for m, (i, j) in enumerate(pairs):
                if decides[m]:
                    ahead = margins[:, m] > 0
                    votes[:, i] += ahead
                    votes[:, j] += ~ahead
                    leaning[:, i] += margins[:, m]
                    leaning[:, j] -= margins[:, m]
            raw = leaning if classes == 2 else votes + leaning / (3 * (np.abs(leaning) + 1))
            return np.column_stack([votes.argmax(axis=1), raw])

        decided = scored.withColumn("_decided", per_batch(decide, F.col("_margins")))
        raw = F.slice("_decided", 2, classes)
        return decided.select(*df.columns, F.col("_decided")[0].alias("prediction"), array_to_vector(raw).alias("rawPrediction"))

    def _carried(self, df: DataFrame) -> DataFrame:
        """Margins from support vectors within the tasks, one scan."""
        kernel, machines = self.fit_settings.kernel, len(self.fit_settings.pairs)
        rows = self.vectors.select("n", "x", "c").collect()
        blocks = [(np.frombuffer(r["x"]).reshape(r["n"], -1), np.frombuffer(r["c"]).reshape(r["n"], machines)) for r in rows]

        def margins(x):
            total = np.zeros((len(x), machines))
            for points, change in blocks:
                total += kernel(x, points) @ change
            return total

        return df.withColumn("_margins", per_batch(margins, vector_to_array(self.fit_settings.features)))

    def _joined(self, df: DataFrame) -> DataFrame:
        """Margins from any number of support vectors: packs of different rows meet the blocks in an equality join."""
        kernel, machines, features = self.fit_settings.kernel, len(self.fit_settings.pairs), self.fit_settings.features
        different = df.select(vector_to_array(features).alias("_x")).where(F.col("_x").isNotNull()).distinct()

        def pack(batches):
            import pyarrow

            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(start, BLOCK_ROWS)
                    x = np.ascontiguousarray(part.column(0).flatten().to_numpy(zero_copy_only=False))
                    values = [pyarrow.array([part.num_rows], "int32"), pyarrow.array([x.tobytes()], "binary")]
                    yield pyarrow.RecordBatch.from_arrays(values, ["rows", "q"])

        def multiply(batches):
            import pyarrow

            for batch in batches:
                for rows, q, n, x, c in zip(*(column.to_pylist() for column in batch.columns)):
                    q, x, c = np.frombuffer(q).reshape(rows, -1), np.frombuffer(x).reshape(n, -1), np.frombuffer(c).reshape(n, machines)
                    part = kernel(q, x) @ c
                    values = [pyarrow.array(list(q)), pyarrow.array(list(part))]
                    yield pyarrow.RecordBatch.from_arrays(values, ["_x", "_part"])

        packs = different.mapInArrow(pack, "rows int, q binary")
        # a grid: a pack goes to every group of blocks, a block to every bucket of packs, and each pair meets once
        groups = max(1, self.vectors.count() // GROUP_BLOCKS)
        sent = packs.select("rows", "q", F.pmod(F.xxhash64("q"), F.lit(BUCKETS)).cast("int").alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
        grouped = self.vectors.select("n", "x", "c", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("bucket"))
        parts = sent.join(grouped, ["group", "bucket"]).select("rows", "q", "n", "x", "c").mapInArrow(multiply, "_x array<double>, _part array<double>")
        sums = parts.groupBy("_x").agg(*[F.sum(F.col("_part")[m]).alias(f"_m{m}") for m in range(machines)])
        margins = sums.select("_x", F.array(*[f"_m{m}" for m in range(machines)]).alias("_margins"))
        return df.withColumn("_x", vector_to_array(features)).join(margins, "_x").drop("_x")
