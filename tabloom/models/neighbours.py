"""k-nearest-neighbour classification; every training row counts.

Of equal training rows only the k with the smallest keys can be among the k nearest, so each fit first keeps those. Where
they are at most ``BLOCK_ROWS``, they are a block that goes to the workers, and queries are scanned once, where they are.

Otherwise, and with ``exact``, rows and queries meet in cells. The cells are boxes: cuts at medians of a sample, which
decides on places only. A cell's rows lie packed in blocks of at most ``block_rows`` rows. Different queries are packed
by cell; the first block of a query's own cell gives an upper bound of its k-th distance, and then the query goes to the blocks
whose box comes that near. Both times the blocks and the queries that need them are sorted by block and streamed,
so a task holds one block and a few thousand queries, whatever the skew. Only the k best of a block leave its task.

``max_train_rows`` is for callers that want votes from a sample: the rows with the smallest hashes of each class, in
proportion to the classes. ``neighbours`` of such a model goes the exact way over all training rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.functions.blocks import per_batch
from tabloom.functions.expressions import argmax_index, order_key
from tabloom.session import keep, shared_folder

DIGITS = 9  # distances are compared after rounding to this many digits
BLOCK_ROWS = 50_000  # rows that go to every worker
CELL_ROWS = 8192
SAMPLE_ROWS = 40_000  # rows whose values place the cells
PACKET_ROWS = 2048  # queries packed together
PACK_VALUES = 2_000_000  # numbers in a packed block
LARGE_ROWS = 16  # packed rows in one Arrow batch


class NearestNeighbours(Estimator):
    """Ties: smaller distance, then smaller training key; equal votes go to the smaller class.

    ``pivots`` (cells only) is the number of cells; the default grows with the rows up to ``max_pivots``.
    """

    def __init__(
        self, classes, n_neighbors=3, key="id", features="features", label="label", exact=False,
        max_train_rows: int | None = None, block_rows=20_000, pivots: int | None = None, max_pivots=4096, seed=0,
    ):
        super().__init__()
        self.classes, self.n_neighbors, self.key = classes, n_neighbors, key
        self.features, self.label, self.seed = features, label, seed
        self.exact, self.max_train_rows = exact, max_train_rows
        self.block_rows, self.pivots, self.max_pivots = block_rows, pivots, max_pivots

    def _fit(self, df: DataFrame) -> Model:
        rows = df.select(
            F.col(self.key).alias("_tid"),
            vector_to_array(self.features).alias("_tx"),
            F.col(self.label).cast("double").alias("_ty"),
        )
        sampled = None if self.exact or self.max_train_rows is None else self._fit_sample(rows)
        return sampled or self._fit_all(rows, BLOCK_ROWS if not self.exact else 0)

    def _fit_all(self, rows: DataFrame, most: int = 0) -> Model:
        """All training rows: one block where at most ``most`` can be chosen, else cells."""
        chosen = keep(self._chosen(rows))
        n = chosen.count()
        model = self._fit_cells(chosen, n) if n > most else BlockNeighboursModel(self, chosen.orderBy("_tid", "_ty").toArrow())
        chosen.unpersist()
        return model

    def _chosen(self, rows: DataFrame) -> DataFrame:
        """The training rows that can be among the k nearest: of equal ones those with the k smallest keys."""
        choosable = _choosable(self.n_neighbors)

        def cut(batches):
            import pyarrow.compute

            for batch in batches:
                order = [("_tid", "ascending"), ("_ty", "ascending")]
                batch = batch.take(pyarrow.compute.sort_indices(batch, sort_keys=order, null_placement="at_start"))
                if batch.num_rows:
                    x = batch.column("_tx").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    yield batch.take(pyarrow.array(choosable(x)))

        # cut in every batch first, so that a point with very many rows sends few of them
        few = rows.mapInArrow(cut, rows.schema)
        order = Window.partitionBy("_tx").orderBy("_tid", "_ty")
        return few.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= self.n_neighbors).drop("_r")

    def _fit_sample(self, rows: DataFrame) -> BlockNeighboursModel | None:
        """A model of at most ``max_train_rows`` rows; None where there are no more."""
        sizes = {r["_ty"]: r["n"] for r in rows.groupBy("_ty").agg(F.count("*").alias("n")).collect()}
        total = sum(sizes.values())
        if total <= self.max_train_rows:
            return None
        share = {c: max(1, self.max_train_rows * n // total) for c, n in sizes.items()}
        # hashes are even, so few rows beyond the share lie below its place; where copies of a key leave too few, all are ordered
        near = {c: min(1.0, (n + 8 * math.sqrt(n) + 16) / sizes[c]) for c, n in share.items()}
        block = self._smallest(rows, share, near)
        if len(block) < sum(share.values()):
            block = self._smallest(rows, share, dict.fromkeys(share, 1.0))
        return BlockNeighboursModel(self, block, rows)

    def _smallest(self, rows: DataFrame, share: dict, near: dict):
        """The rows with the smallest hashes of each class, ``share`` of them, among those whose hash lies below the part ``near``."""
        mark, parts = order_key(self.seed, F.col("_tid").cast("string")), []
        for c, n in share.items():
            mine = rows.where(F.col("_ty").eqNullSafe(F.lit(c)))
            if near[c] < 1:
                mine = mine.where(mark < F.lit(f"{int(near[c] * 2**32):08x}"))
            parts.append(mine.orderBy(mark, "_tid").limit(n))
        return reduce(DataFrame.unionByName, parts).orderBy("_tid").toArrow()

    def _fit_cells(self, rows: DataFrame, n: int) -> NearestNeighboursModel:
        """``rows``: ``n`` rows that can be chosen."""
        part = 1_000_000
        bound = part if n <= SAMPLE_ROWS else max(1, part * SAMPLE_ROWS // n)
        drawn = rows.where(F.pmod(F.xxhash64(F.lit(self.seed), "_tx"), F.lit(part)) < bound).select("_tx").limit(2 * SAMPLE_ROWS).toArrow()
        if not len(drawn):
            drawn = rows.select("_tx").limit(SAMPLE_ROWS).toArrow()
        points = drawn["_tx"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(drawn), -1)
        width = points.shape[1]
        route, cells = _boxes(points, self.pivots or min(max(1, -(-n // CELL_ROWS)), self.max_pivots))
        most = max(1, min(self.block_rows, PACK_VALUES // max(width, 1)))
        named = rows.withColumn("_cell", per_batch(route, F.col("_tx"))[0].cast("int"))
        key = rows.schema["_tid"].dataType.simpleString()
        packs = (
            named.select("_cell", "_tx", "_tid", "_ty")
            .repartition(_parts(rows, cells), "_cell")
            .sortWithinPartitions("_cell", "_tid", "_ty")
            .mapInArrow(_pack_rows(most), f"number bigint, cell int, first boolean, x array<double>, ids array<{key}>, labels array<double>, low array<double>, high array<double>")
        )
        return NearestNeighboursModel(self, rows.sparkSession, _put(packs, "neighbour-blocks"), packs.schema, n, width, route, cells, key)


class BlockNeighboursModel(Model):
    """Neighbours among a block of training rows that every worker holds."""

    def __init__(self, settings: NearestNeighbours, block, everything: DataFrame | None = None):
        """``everything``: all training rows, where the block is a sample of them."""
        super().__init__()
        self.settings, self.block, self.everything, self.exact = settings, block, everything, None
        self.k = min(settings.n_neighbors, len(block))
        points = block["_tx"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(block), -1)
        # found here, not by every batch: places in the block of the rows that can be chosen, and only those are sent
        self.kept = _choosable(self.k)(points)
        self.points = points[self.kept]

    def unpersist(self) -> None:
        """Nothing is cached: the block is on the driver, cells are written."""

    def _found(self, df: DataFrame):
        """Positions and distances of the k nearest rows of every query, as one array."""
        best, points, kept, k = _nearest(self.k), self.points, self.kept, self.k

        def search(x):
            rows, columns, distance = best(x, points, cut=True)
            return np.hstack([kept[columns].reshape(len(x), k), distance.reshape(len(x), k)])

        return per_batch(search, vector_to_array(self.settings.features))

    def neighbours(self, df: DataFrame) -> DataFrame:
        """``key, rank, distance, neighbour, neighbour_label`` of the k nearest of all training rows."""
        if self.everything is not None:
            self.exact = self.exact or self.settings._fit_all(self.everything)
            return self.exact.neighbours(df)
        s, k, spark = self.settings, self.k, df.sparkSession
        places = list(range(len(self.block)))
        names = spark.createDataFrame(self.block.select(["_tid", "_ty"]).append_column("_at", pa.array(places, pa.int32())))
        found = df.select(F.col(s.key), self._found(df).alias("_f"))
        each = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda r: F.struct(r.alias("rank"), F.get("_f", r + k - 1).alias("distance"), F.get("_f", r - 1).cast("int").alias("_at")))
        long = found.select(s.key, F.inline(each))
        return long.join(F.broadcast(names), "_at").select(
            s.key, "rank", "distance", F.col("_tid").alias("neighbour"), F.col("_ty").alias("neighbour_label")
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        s, k = self.settings, self.k
        labels = self.block["_ty"].to_numpy(zero_copy_only=False)[self.kept]
        best, points, classes = _nearest(k), self.points, s.classes

        def votes(x):
            rows, columns, _ = best(x, points, cut=True)
            out = np.zeros((len(x), classes))
            for c in range(classes):
                out[:, c] = (labels[columns] == c).reshape(len(x), k).sum(axis=1)
            return out

        return (
            df.withColumn("_votes", per_batch(votes, vector_to_array(s.features)))
            .withColumn("prediction", argmax_index("_votes").cast("double"))
            .withColumn("probability", array_to_vector(F.transform("_votes", lambda v: v / F.lit(float(k)))))
            .drop("_votes")
        )


class NearestNeighboursModel(Model):
    """Neighbours among all training rows, which lie packed by cell in the folder ``packs``."""

    def __init__(
        self, settings: NearestNeighbours, spark: SparkSession, packs: str, schema: StructType, n: int, width: int, route: Callable, cells: int, key: str
    ):
        super().__init__()
        self.settings, self.packs, self.schema, self.n, self.width = settings, packs, schema, n, width
        self.route, self.cells, self.key = route, cells, key
        self.k = min(settings.n_neighbors, n)
        boxes = _got(spark, packs, schema).select("number", "cell", "first", "low", "high").toArrow()
        self.numbers = boxes["number"].to_numpy()
        self.homes = np.where(boxes["first"].to_numpy(zero_copy_only=False), boxes["cell"].to_numpy(), -1)
        self.low, self.high = (boxes[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(boxes), -1) for c in ("low", "high"))

    def unpersist(self) -> None:
        """Nothing is cached: the blocks are written."""

    def _ranked(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The k nearest rows of every different query (``packet, place, rank, _d, _tid, _ty``), and the queries (``packet, place, _qx``)."""
        k, width, spark = self.k, self.width, df.sparkSession
        points = df.select(vector_to_array(self.settings.features).alias("_qx")).where(F.col("_qx").isNotNull()).distinct()
        named = points.select(per_batch(self.route, F.col("_qx"))[0].cast("int").alias("_cell"), "_qx")
        # a cell with very many queries is dealt to several tasks
        dealt_out = named.repartition(_parts(df, self.cells), "_cell", F.pmod(F.xxhash64("_qx"), F.lit(4)))
        packets = dealt_out.sortWithinPartitions("_cell").mapInArrow(_pack_queries(PACKET_ROWS), "key bigint, packet bigint, places array<int>, x array<double>")
        at = _put(packets, "neighbour-queries")
        none = {"ids": f"array<{self.key}>", "labels": "array<double>", "packet": "bigint", "places": "array<int>", "bound": "array<double>"}
        found = f"packet bigint, x array<double>, bound array<double>, at array<int>, d array<double>, ids array<{self.key}>, labels array<double>"
        # packed rows are large: a session of its own has few of them in a batch, whatever other threads do meanwhile
        large = spark.newSession()
        large.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(LARGE_ROWS))

        def meeting(blocks: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
            """Blocks and the queries that need them, each block before its queries, to be streamed."""
            sides = []
            for side, asks in ((blocks, False), (queries, True)):
                missing = {c: F.lit(None).cast(t) for c, t in none.items() if c not in side.columns}
                sides.append(side.withColumns({**missing, "asks": F.lit(asks)}).select("key", "asks", "x", *none))
            return sides[0].unionByName(sides[1]).repartition(parts, "key").sortWithinPartitions("key", "asks")

        packs, packets = _got(large, self.packs, self.schema), _got(large, at, packets.schema)
        own = meeting(packs.where("first").select(F.col("cell").cast("bigint").alias("key"), "x", "ids", "labels"), packets, _parts(df, self.cells))
        near = [_put(own.mapInArrow(_block_search(k, width, True), found), "neighbours-home")]
        reach = _reached(self.numbers, self.homes, self.low, self.high, self.route, width)
        asked = _got(large, near[0], found).select("packet", "x", "bound").mapInArrow(reach, "key bigint, packet bigint, places array<int>, x array<double>, bound array<double>")
        rest = meeting(packs.select(F.col("number").alias("key"), "x", "ids", "labels"), asked, _parts(df, len(self.numbers)))
        near.append(_put(rest.mapInArrow(_block_search(k, width, False), found), "neighbours-away"))
        zipped = F.arrays_zip(F.col("at").alias("place"), F.col("d").alias("_d"), F.col("ids").alias("_tid"), F.col("labels").alias("_ty"))
        listed = _got(spark, near, found).select("packet", F.inline(zipped))
        order = Window.partitionBy("packet", "place").orderBy("_d", "_tid", "_ty")
        ranked = listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        one = F.transform("places", lambda p: F.struct(p.alias("place"), F.slice("x", p * width + 1, F.lit(width)).alias("_qx")))
        return ranked, _got(spark, at, packets.schema).select("packet", F.inline(one))

    def neighbours(self, df: DataFrame) -> DataFrame:
        """``key, rank, distance, neighbour, neighbour_label`` of the k nearest training rows; with ``exact`` a repeated key is asked once."""
        s = self.settings
        asked = df.select(s.key, vector_to_array(s.features).alias("_qx"))
        if s.exact:
            asked = asked.dropDuplicates([s.key])
        ranked, queries = self._ranked(df)
        found = queries.join(ranked, ["packet", "place"]).drop("packet", "place")
        return (
            asked.join(found, "_qx")
            .select(s.key, "rank", F.col("_d").alias("distance"), F.col("_tid").alias("neighbour"), F.col("_ty").alias("neighbour_label"))
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.settings
        ranked, queries = self._ranked(df)
        votes = F.array(*[F.count_if(F.col("_ty") == c).cast("double") for c in range(s.classes)])
        voted = ranked.groupBy("packet", "place").agg(votes.alias("_votes"))
        scored = queries.join(voted, ["packet", "place"]).select(
            "_qx",
            argmax_index("_votes").cast("double").alias("prediction"),
            array_to_vector(F.transform("_votes", lambda v: v / F.lit(float(self.k)))).alias("probability"),
        )
        # by value: keys may repeat or be missing, and equal queries have one answer
        return df.withColumn("_qx", vector_to_array(s.features)).join(scored, "_qx", "left").select(*df.columns, "prediction", "probability")


def _runs():
    """A function for an order that puts equal rows side by side, each run as it was, and where runs begin."""

    def runs(rows):
        import numpy

        order = numpy.lexsort(rows.T[::-1]) if rows.shape[1] else numpy.arange(len(rows))
        ranked = rows[order]
        begins = numpy.ones(len(rows), dtype=bool)
        begins[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
        return order, begins

    return runs


def _choosable(k: int):
    """Places of the training rows that can be among the k nearest: the first k of equal ones."""
    runs = _runs()

    def choosable(t):
        import numpy

        order, begins = runs(t)
        first = numpy.flatnonzero(begins)
        rank = numpy.arange(len(t)) - numpy.repeat(first, numpy.diff(numpy.append(first, len(t))))
        return numpy.sort(order[rank < k])

    return choosable


def _nearest(k: int):
    """(query rows, training columns, rounded distances) of the k nearest training rows, by row and rank.

    Training rows are in key order, so that the smaller key wins a tie. Of equal training rows only the first k can be
    chosen (``cut``: the others are not among them any more), and equal queries are answered once. Which rows may be
    among the k nearest is found by groups of training rows: the k-th smallest of the groups' least distances is an upper
    bound of the k-th distance, and only groups that reach below it are looked into.
    """
    digits, runs, choosable = DIGITS, _runs(), _choosable(k)

    def closest(q, t, take):
        import numpy

        width = t.shape[1]
        group = max(1, min(64, len(t) // (8 * take)))
        groups = -(-len(t) // group)
        # one product gives norms - 2 q t; rows that only fill the last group are out of reach; members of a group lie a
        # stride apart, so that its least value is a minimum of whole rows
        sides = numpy.zeros((width + 1, groups * group))
        numpy.multiply(t.T, -2.0, out=sides[:-1, : len(t)])
        for at in range(0, len(t), 4096):
            sides[-1, at : min(at + 4096, len(t))] = (t[at : at + 4096] ** 2).sum(axis=1)
        highest = sides[-1, : len(t)].max()
        sides[-1, len(t) :] = 1e300
        picked_q, picked_t, picked_d = [], [], []
        step = max(1, 1_000_000 // (groups * group))
        # where many distances are equal, all pairs of a step are measured again: that many of them at once
        some_groups = max(1, min(20_000, 1_000_000 // (group * max(width, 1))))
        for start in range(0, len(q), step):
            part = q[start : start + step]
            rough = (numpy.column_stack([part, numpy.ones(len(part))]) @ sides).reshape(len(part), group, groups)
            least = rough.min(axis=1)
            limit = numpy.partition(least, take - 1, axis=1)[:, take - 1]
            # everything that rounding could move into the k best is measured again exactly
            limit = limit + 1e-9 * ((part**2).sum(axis=1) + highest + 1.0)
            near, which = numpy.nonzero(least <= limit[:, None])
            found_q, found_t, found_d = [], [], []
            for at in range(0, len(near), some_groups):
                some, places = near[at : at + some_groups], which[at : at + some_groups]
                pair, member = numpy.nonzero(rough[some, :, places] <= limit[some][:, None])
                r, c = some[pair], member * groups + places[pair]
                found_q.append(r)
                found_t.append(c)
                apart = part[r]
                apart -= t[c]
                apart *= apart
                found_d.append(numpy.sqrt(apart.sum(axis=1)))
            if not found_q:
                continue
            rows, columns, distance = (numpy.concatenate(v) for v in (found_q, found_t, found_d))
            distance = numpy.round(distance, digits)
            order = numpy.lexsort((columns, distance, rows))
            rows, columns, distance = rows[order], columns[order], distance[order]
            best = numpy.arange(len(rows)) - numpy.searchsorted(rows, rows, side="left") < take
            picked_q.append(rows[best] + start)
            picked_t.append(columns[best])
            picked_d.append(distance[best])
        if not picked_q:
            return numpy.zeros(0, dtype="int64"), numpy.zeros(0, dtype="int64"), numpy.zeros(0)
        return numpy.concatenate(picked_q), numpy.concatenate(picked_t), numpy.concatenate(picked_d)

    def search(q, t, cut=False):
        import numpy

        take = min(k, len(t))
        kept = None if cut else choosable(t)
        t = t if cut else t[kept]
        order, begins = runs(q)
        different, copy = order[begins], numpy.empty(len(q), dtype="int64")
        copy[order] = numpy.cumsum(begins) - 1
        rows, columns, distance = closest(q[different], t, take)
        starts = numpy.searchsorted(rows, numpy.arange(len(different) + 1), side="left")
        counts = (starts[1:] - starts[:-1])[copy]
        at = numpy.repeat(starts[:-1][copy], counts) + numpy.arange(counts.sum()) - numpy.repeat(numpy.cumsum(counts) - counts, counts)
        columns = columns[at] if cut else kept[columns[at]]
        return numpy.repeat(numpy.arange(len(q)), counts), columns, distance[at]

    return search


def _put(df: DataFrame, name: str) -> str:
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _got(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))


def _parts(df: DataFrame, wanted: int) -> int:
    """Partitions for so many keys: enough for all cores, and no more than a driver can plan."""
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, min(wanted, 2000))


def _boxes(points: np.ndarray, cells: int) -> tuple[Callable, int]:
    """A function that gives each row's cell as a column, and the number of cells: the largest is cut at a median until there are so many."""
    axes, cuts, children, depths = [0], [np.inf], [[0, 0]], [0]
    waiting, leaves = [(-len(points), 0, np.arange(len(points)))], 1
    while waiting and leaves < cells:
        _, node, rows = waiting.pop(0)
        x = points[rows]
        axis = int(x.var(axis=0).argmax())
        values = x[:, axis]
        cut, top = np.median(values), values.max()
        if cut >= top:
            lower = values[values < top]
            if not len(lower):
                continue  # equal points stay together
            cut = lower.max()
        axes[node], cuts[node], leaves = axis, float(cut), leaves + 1
        for side, part in enumerate((rows[values <= cut], rows[values > cut])):
            new = len(axes)
            children[node][side] = new
            axes.append(0), cuts.append(np.inf), children.append([new, new]), depths.append(depths[node] + 1)
            waiting.append((-len(part), new, part))
        waiting.sort(key=lambda w: w[:2])
    axes, cuts, children, depth = np.array(axes), np.array(cuts), np.array(children), max(depths)

    def route(x):
        import numpy

        node, every = numpy.zeros(len(x), dtype="int64"), numpy.arange(len(x))
        for _ in range(depth):
            node = children[node, (x[every, axes[node]] > cuts[node]).astype("int64")]
        return node[:, None]

    return route, leaves


def _pack_rows(most: int):
    """Rows sorted by cell and key to blocks of at most ``most`` rows of one cell, with their boxes."""

    def pack(batches):
        import numpy
        import pyarrow
        from pyspark import TaskContext

        made, held, rows, last, first = 0, [], 0, None, True

        def done():
            nonlocal made, held, rows, first
            table = pyarrow.Table.from_batches(held).combine_chunks()
            flat = table["_tx"].combine_chunks().flatten()
            x = flat.to_numpy(zero_copy_only=False).reshape(rows, -1)

            def one(values):
                return pyarrow.ListArray.from_arrays(pyarrow.array([0, len(values)], "int32"), values)

            low, high = (pyarrow.array(v) for v in (x.min(axis=0), x.max(axis=0)))
            lists = [one(v) for v in (flat, table["_tid"].combine_chunks(), table["_ty"].combine_chunks(), low, high)]
            number = (TaskContext.get().partitionId() << 20) + made
            out = [pyarrow.array([number], "int64"), pyarrow.array([last], "int32"), pyarrow.array([first]), *lists]
            made, held, rows, first = made + 1, [], 0, False
            return pyarrow.RecordBatch.from_arrays(out, ["number", "cell", "first", "x", "ids", "labels", "low", "high"])

        for batch in batches:
            cell = batch.column(0).to_numpy()
            at = 0
            while at < len(cell):
                if rows and cell[at] != last:
                    yield done()
                if cell[at] != last:
                    last, first = int(cell[at]), True
                upto = min(int(numpy.searchsorted(cell, last, side="right")), at + most - rows)
                held.append(batch.slice(at, upto - at))
                rows, at = rows + upto - at, upto
                if rows == most:
                    yield done()
        if rows:
            yield done()

    return pack


def _pack_queries(most: int):
    """Queries sorted by cell to packets of at most ``most`` queries of one cell."""

    def pack(batches):
        import numpy
        import pyarrow
        from pyspark import TaskContext

        made, held, rows, last = 0, [], 0, None

        def done():
            nonlocal made, held, rows
            flat = pyarrow.concat_arrays(held)

            def one(values):
                return pyarrow.ListArray.from_arrays(pyarrow.array([0, len(values)], "int32"), values)

            number = (TaskContext.get().partitionId() << 32) + made
            out = [pyarrow.array([last], "int64"), pyarrow.array([number], "int64"), one(pyarrow.array(numpy.arange(rows), "int32")), one(flat)]
            made, held, rows = made + 1, [], 0
            return pyarrow.RecordBatch.from_arrays(out, ["key", "packet", "places", "x"])

        for batch in batches:
            cell = batch.column(0).to_numpy()
            at = 0
            while at < len(cell):
                if rows and cell[at] != last:
                    yield done()
                last = int(cell[at])
                upto = min(int(numpy.searchsorted(cell, last, side="right")), at + most - rows)
                held.append(batch.column(1).slice(at, upto - at).flatten())
                rows, at = rows + upto - at, upto
                if rows == most:
                    yield done()
        if rows:
            yield done()

    return pack


def _reached(numbers: np.ndarray, homes: np.ndarray, low: np.ndarray, high: np.ndarray, route: Callable, width: int):
    """Which blocks besides the first of its own cell may hold one of the k nearest rows of a query: a row for each block and packet."""

    def reached(batches):
        import numpy
        import pyarrow

        def one(values):
            return pyarrow.ListArray.from_arrays(pyarrow.array([0, len(values)], "int32"), values)

        for batch in batches:
            for i in range(batch.num_rows):
                packet, flat, bound = (batch.column(c)[i] for c in range(3))
                x = flat.values.to_numpy(zero_copy_only=False).reshape(-1, width)
                bound = bound.values.to_numpy(zero_copy_only=False)
                cell = int(route(x[:1])[0, 0])
                limit = (bound * (1 + 1e-9) + 1e-8) ** 2
                for number, home, lo, hi in zip(numbers, homes, low, high):
                    if home == cell:
                        continue
                    apart = numpy.maximum(numpy.maximum(lo - x, x - hi), 0.0)
                    places = numpy.flatnonzero((apart**2).sum(axis=1) <= limit)
                    if len(places):
                        lists = [pyarrow.array(places, "int32"), pyarrow.array(x[places].ravel()), pyarrow.array(bound[places])]
                        yield pyarrow.RecordBatch.from_arrays(
                            [pyarrow.array([number], "int64"), pyarrow.array([packet.as_py()], "int64"), *map(one, lists)], ["key", "packet", "places", "x", "bound"]
                        )

    return reached


def _block_search(k: int, width: int, home: bool, together: int = 8192):
    """The k best of a block for each of its queries, from a stream of blocks, each followed by its queries.

    ``home``: the queries have no bound yet; they are passed on with the k-th distance found. Else rows beyond a query's bound are left out.
    """
    nearest = _nearest(k)

    def search(batches):
        import numpy
        import pyarrow

        points, ids, labels, waiting, rows = None, None, None, [], 0

        def one(values):
            return pyarrow.ListArray.from_arrays(pyarrow.array([0, len(values)], "int32"), values)

        def answered():
            nonlocal waiting, rows
            x = numpy.concatenate([w[2] for w in waiting])
            asked, chosen, distance = nearest(x, points, cut=True)
            take = min(k, len(points))
            if not home:
                near = distance <= numpy.concatenate([w[3] for w in waiting])[asked]
                asked, chosen, distance = asked[near], chosen[near], distance[near]
            start = 0
            for packet, places, own, bound in waiting:
                a, b = numpy.searchsorted(asked, [start, start + len(own)])
                if home:
                    bound = distance[a:b].reshape(len(own), take)[:, -1] if take == k else numpy.full(len(own), numpy.inf)
                some = pyarrow.array(chosen[a:b])
                lists = [pyarrow.array(places[asked[a:b] - start], "int32"), pyarrow.array(distance[a:b]), ids.take(some), labels.take(some)]
                passed = [pyarrow.array(v if home else []).cast("float64") for v in (own.ravel(), bound)]
                start += len(own)
                if home or b > a:
                    yield pyarrow.RecordBatch.from_arrays(
                        [pyarrow.array([packet], "int64"), *map(one, passed + lists)], ["packet", "x", "bound", "at", "d", "ids", "labels"]
                    )
            waiting, rows = [], 0

        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                x = c["x"][i].values.to_numpy(zero_copy_only=False).reshape(-1, width)
                if c["asks"][i].as_py():
                    bound = None if home else c["bound"][i].values.to_numpy(zero_copy_only=False)
                    waiting.append((c["packet"][i].as_py(), c["places"][i].values.to_numpy(zero_copy_only=False), x, bound))
                    rows += len(x)
                    if rows >= together:
                        yield from answered()
                else:
                    if rows:
                        yield from answered()
                    points, ids, labels = x, c["ids"][i].values, c["labels"][i].values
        if rows:
            yield from answered()

    return search
