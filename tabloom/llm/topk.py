"""Exact top-k search by block-at-a-time pruning.

Vectors of integers are ordered so that similar ones lie near each other, and cut into ranges of ``RANGE``
documents. A range stores its forward index (ids and vectors) and, for each term, that is each component in
each sign, the largest weight in every block of ``BLOCK`` documents. For a query the summed term maxima bound
every score in a block. Blocks are taken in the order of their bounds and scored through the forward index,
until the next bound falls below the query's k-th score.

Each range first answers its own queries, which gives them a k-th score to start from. Then ranges are put in groups
and every group gets all batches of queries, once for the group. Both are sorted by group and streamed, the ranges
first: a task holds the ranges of one group (at most ``GROUP_VALUES`` numbers) and some hundred queries. A range raises
the k-th scores for those after it. No side is broadcast: the planner's estimate knows nothing of the copies. The
k best of all groups are merged.

Edge cases: vectors that are null or hold a null or a non-finite component take no part; shorter vectors count
as ending in zeros; a null id is a candidate but no query, and comes last among ties; a repeated id is another
candidate, only the query's own row is left out; components whose floors exceed 53 bits are outside of what
is exact; an empty table gives no rows. Only vec_id and embedding are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import batches_of, written

K = 5
EVERY = 50
SCALE = 256.0
BLOCK = 64
RANGE = 4096
GROUP_VALUES = 4_000_000
TOGETHER = 1024  # queries that search a range at once
NULL_ID = np.iinfo(np.int64).max


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and the components' integer parts, for vectors that take part."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    valid = F.col("embedding").isNotNull() & F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(valid, F.lit(False))).select("vec_id", F.transform(wide, lambda x: F.floor(x * SCALE).cast("double")).alias("v"))


def ranges(vectors: DataFrame) -> DataFrame:
    """One row for each range: number, width, ids, nulls, vectors (packed doubles).

    The order is by the two strongest components and their signs, then by id.
    """
    sized = F.transform("v", lambda x, i: F.struct(F.abs(x).alias("size"), i.alias("i"), (x < 0).alias("sign")))
    strong = F.slice(F.sort_array(sized, False), 1, 2)
    keyed = vectors.select("vec_id", "v", F.transform(strong, lambda s: s["i"] * 2 + s["sign"].cast("int")).alias("cell"))
    parts = max(1, -(-keyed.count() // RANGE))
    dealt = keyed.repartitionByRange(parts, "cell", "vec_id").sortWithinPartitions("cell", "vec_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, part, made = [], [], TaskContext.get().partitionId(), 0

        def done() -> pa.RecordBatch:
            nonlocal made, ids, rows
            width = max(map(len, rows))
            matrix = np.zeros((len(rows), width))
            for i, r in enumerate(rows):
                matrix[i, : len(r)] = r
            null = [x is None for x in ids]
            own = np.array([NULL_ID if x is None else x for x in ids], dtype=np.int64)
            out = pa.record_batch(
                [
                    pa.array([(part << 20) + made], pa.int64()),
                    pa.array([width], pa.int32()),
                    pa.array([own.tobytes()], pa.binary()),
                    pa.array([bytes(null)], pa.binary()),
                    pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
                ],
                names=["number", "width", "ids", "nulls", "vectors"],
            )
            made, ids, rows = made + 1, [], []
            return out

        for batch in batches:
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(vec_id)
                rows.append(v)
                if len(ids) == RANGE:
                    yield done()
        if ids:
            yield done()

    packed = dealt.select("vec_id", "v").mapInArrow(pack, "number bigint, width int, ids binary, nulls binary, vectors binary")
    return written(packed.withColumn("part", F.shiftright("number", 20).cast("int")), "vector-ranges")


class Index:
    """A range's forward index and the term maxima of its blocks."""

    def __init__(self, ids: bytes, width: int, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = np.frombuffer(vectors, "<f8").reshape(len(self.ids), width)
        starts = np.arange(0, len(self.ids), BLOCK)
        self.high = np.maximum.reduceat(self.vectors, starts, axis=0)
        self.low = np.minimum.reduceat(self.vectors, starts, axis=0)

    def search(self, queries: np.ndarray, kth: np.ndarray, own: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, position, score) of every query's best candidates that reach ``kth``; own: positions to leave out."""
        width = min(queries.shape[1], self.vectors.shape[1])
        q, vectors = queries[:, :width], self.vectors[:, :width]
        bounds = np.maximum(q, 0) @ self.high[:, :width].T + np.minimum(q, 0) @ self.low[:, :width].T
        order = np.argsort(-bounds, axis=1, kind="stable")
        best = [np.empty((0, 2)) for _ in q]
        kth = kth.copy()
        alive = np.arange(len(q))
        for turn in range(order.shape[1]):
            block = order[alive, turn]
            keep = bounds[alive, block] >= kth[alive]  # an equal score may still win by its id
            alive, block = alive[keep], block[keep]
            if not len(alive):
                break
            for b in np.unique(block):
                here = alive[block == b]
                at = np.arange(b * BLOCK, min((b + 1) * BLOCK, len(self.ids)))
                scores = q[here] @ vectors[at].T
                if own is not None:
                    scores[own[here][:, None] == at[None, :]] = -np.inf
                reach = (scores >= kth[here][:, None]) & (scores > -np.inf)
                for row in np.flatnonzero(reach.any(axis=1)):
                    i, good = here[row], np.flatnonzero(reach[row])
                    merged = np.concatenate([best[i], np.column_stack([scores[row][good], at[good]])])
                    first = np.lexsort((self.ids[merged[:, 1].astype(np.int64)], -merged[:, 0]))[:k]
                    best[i] = merged[first]
                    if len(first) == k:
                        kth[i] = max(kth[i], best[i][-1, 0])
        number = np.repeat(np.arange(len(q)), [len(b) for b in best])
        found = np.concatenate(best) if best else np.empty((0, 2))
        return number, found[:, 1].astype(np.int64), found[:, 0]


HITS = "range bigint, place int, query_id bigint, vec_id bigint, is_null boolean, score bigint"


def _hits(query_range, places, query_ids, number, ids, nulls, positions, scores) -> pa.RecordBatch:
    null = np.frombuffer(nulls, np.uint8)[positions].astype(bool)
    return pa.record_batch(
        [
            pa.array(query_range, pa.int64()),
            pa.array(places[number], pa.int32()),
            pa.array(query_ids[number], pa.int64()),
            pa.array(ids[positions], pa.int64()),
            pa.array(null),
            pa.array(np.rint(scores).astype(np.int64)),
        ],
        names=["range", "place", "query_id", "vec_id", "is_null", "score"],
    )


def _others(k: int):
    """Hits of all queries in the ranges of a group, from a stream of ranges followed by batches of queries; a query's own range is left out."""

    def others(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ranges, waiting, rows = None, [], [], 0

        def answered() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, rows
            width = max(w[1].shape[1] for w in waiting)
            home = np.concatenate([np.full(len(w[1]), w[0]) for w in waiting])
            queries = np.concatenate([np.pad(w[1], ((0, 0), (0, width - w[1].shape[1]))) for w in waiting])
            places, ids, kth = (np.concatenate([w[i] for w in waiting]) for i in (2, 3, 4))
            for number, nulls, here in ranges:
                at = np.flatnonzero(home != number)
                if not len(at):
                    continue
                found, positions, scores = here.search(queries[at], kth[at], None, k)
                if len(found):
                    yield _hits(home[at][found], places[at], ids[at], found, here.ids, nulls, positions, scores)
                    counts = np.bincount(found, minlength=len(at))
                    full = np.flatnonzero(counts >= k)
                    kth[at[full]] = np.maximum(kth[at[full]], scores[np.cumsum(counts)[full] - 1])
            waiting, rows = [], 0

        for batch in parts:
            for r in batch.to_pylist():
                if r["group"] != group:
                    if rows:
                        yield from answered()
                    group, ranges = r["group"], []
                if not r["asks"]:
                    ranges.append((r["number"], r["nulls"], Index(r["ids"], r["width"], r["vectors"])))
                    continue
                places, ids = np.frombuffer(r["places"], np.int64), np.frombuffer(r["query_ids"], np.int64)
                waiting.append((r["number"], np.frombuffer(r["vectors"]).reshape(len(ids), r["width"]), places, ids, np.frombuffer(r["kth"])))
                rows += len(ids)
                if rows >= TOGETHER:
                    yield from answered()
        if rows:
            yield from answered()

    return others


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """The contract's columns: query_id, rank, vec_id, score."""
    index = ranges(integers(vectors))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each range answers its own queries; a row for each batch of queries with what it has found."""
        for batch in batches:
            for r in batch.to_pylist():
                here = Index(r["ids"], r["width"], r["vectors"])
                places = np.flatnonzero((here.ids % every == 0) & (np.frombuffer(r["nulls"], np.uint8) == 0))
                if not len(places):
                    continue
                queries = here.vectors[places]
                number, positions, scores = here.search(queries, np.full(len(places), -np.inf), places, k)
                kth = np.full(len(places), -np.inf)
                counts = np.bincount(number, minlength=len(places))
                ends = np.cumsum(counts) - 1
                full = counts >= k
                kth[full] = scores[ends[full]]
                yield pa.record_batch(
                    [pa.array([x], t) for x, t in (
                        (r["number"], pa.int64()), (r["width"], pa.int32()), (places.astype(np.int64).tobytes(), pa.binary()), (here.ids[places].tobytes(), pa.binary()),
                        (queries.tobytes(), pa.binary()), (kth.tobytes(), pa.binary()), (number.tobytes(), pa.binary()), (here.ids[positions].tobytes(), pa.binary()),
                        (np.frombuffer(r["nulls"], np.uint8)[positions].tobytes(), pa.binary()), (scores.tobytes(), pa.binary()),
                    )],
                    names=["home", "query_width", "places", "query_ids", "queries", "kth", "number", "found", "found_null", "scores"],
                )

    columns = "home bigint, query_width int, places binary, query_ids binary, queries binary, kth binary, number binary, found binary, found_null binary, scores binary"
    spark = vectors.sparkSession
    with batches_of(spark, 16):  # a packed range has some megabytes
        batches = written(index.mapInArrow(own, columns), "vector-queries")

    def unpack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for r in batch.to_pylist():
                number = np.frombuffer(r["number"], np.int64)
                places, ids = np.frombuffer(r["places"], np.int64), np.frombuffer(r["query_ids"], np.int64)
                found, scores = np.frombuffer(r["found"], np.int64), np.frombuffer(r["scores"], np.float64)
                yield _hits(np.full(len(number), r["home"]), places, ids, number, found, r["found_null"], np.arange(len(number)), scores)

    # as many ranges a group as a task may hold, but groups for all cores
    size = index.agg(F.count("*").alias("n"), F.max("width").alias("width")).first()
    most = max(1, GROUP_VALUES // (RANGE * max(size["width"] or 1, 1)))
    groups = max(1, -(-size["n"] // max(1, min(most, size["n"] // (4 * spark.sparkContext.defaultParallelism)))))
    # ranges that lie near each other go to different groups, so that the work is even, whether of one part or of several
    none = F.lit(None).cast("binary")
    turn = F.pmod(F.col("part") + F.col("number") % (1 << 20), F.lit(groups)).cast("int")
    held = index.select(turn.alias("group"), F.lit(False).alias("asks"), "number", "width", "ids", "nulls", "vectors", *[none.alias(c) for c in ("places", "query_ids", "kth")])
    asked = batches.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(True).alias("asks"), F.col("home").alias("number"), F.col("query_width").alias("width"),
        none.alias("ids"), none.alias("nulls"), F.col("queries").alias("vectors"), "places", "query_ids", "kth",
    )
    met = held.unionByName(asked).repartition(4 * groups, "group").sortWithinPartitions("group", "asks", "number")
    with batches_of(spark, 16):
        far = written(met.mapInArrow(_others(k), HITS), "vector-hits")
    hits = batches.mapInArrow(unpack, HITS).unionByName(far)
    best = Window.partitionBy("range", "place").orderBy(F.desc("score"), "is_null", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(~F.col("is_null"), F.col("vec_id")).alias("vec_id"), "score")
