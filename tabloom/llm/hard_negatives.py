"""Hard negatives through Hilbert-ordered blocks with zone maps.

Candidates are laid along a Hilbert curve over their ``DIMS`` most spread components and written as a table of blocks
of ``BLOCK`` rows. A block keeps the smallest and largest value of every component (its zone map) and its labels. For
an anchor, interval arithmetic over a zone map bounds every score in the block from both sides, so a block is read only
if it holds a wanted label and its interval meets one of the anchor's windows above what has been found there.

A search takes windows of scores. Positives are one window without bounds over the anchor's own label; negatives are
a window for each positive, from half to 0.95 of its score, over the other labels. Either search reads the blocks
that hold the anchors first, which gives each window a score to beat, and then the blocks that the bounds choose.
Anchors travel in packets to the blocks that they need; a hot block is copied for each group of packets, so no
task meets more than ``GROUP`` batches of anchors at once.

Edge cases: rows with a null label or a vector that is null or holds a null or a non-finite component take no part;
shorter vectors count as ending in zeros; repeated rows are one candidate with a number of copies, each of which takes
a rank of its own, and repeated anchors repeat their result; a null id is a candidate but no anchor, and comes last
among ties; components or scores beyond 53 bits are outside of what is exact; an empty table gives no rows. Only
vec_id, embedding and label are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import written

EVERY, SHIFTED, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
SCALE = 256.0
DIMS, BITS = 8, 7  # of the curve; a place on it is one long
BLOCK = 512
PART = 8192  # rows laid out by one task
BATCH = 256  # anchors that travel together
GROUP = 8  # parts whose anchors meet a block in one task
PAGES = 8  # parts whose zone maps meet a group of anchors in one task
NULL_ID = np.iinfo(np.int64).max


# --- layout ------------------------------------------------------------------------------------


def candidates(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v (integers as doubles) and copies: every different row that takes part, once."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.where(F.coalesce(valid, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), shifted.alias("label"), F.transform(wide, lambda x: F.floor(x * SCALE).cast("double")).alias("v")
    )
    return rows.groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("copies"))


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of every row of ``cells``, whole numbers of ``bits`` bits.

    Skilling's transform: from the highest bit down, what lies in the upper half of an axis mirrors or exchanges the
    lower bits of the first axis; a Gray code then joins the axes.
    """
    x = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in range(len(x)):
            upper = (x[axis] >> bit) & 1 == 1
            exchanged = np.where(upper, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(upper, below, exchanged)
            x[axis] ^= exchanged
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= flips
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            place = place << 1 | (x[axis] >> bit) & 1
    return place


def matrix_of(column: pa.Array) -> np.ndarray:
    """An array column as a matrix; shorter rows end in zeros."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if not len(ends):
        return np.zeros((0, 0))
    if (ends == ends[0]).all():
        return flat.reshape(len(ends), -1)
    matrix = np.zeros((len(ends), ends.max()))
    matrix[np.arange(ends.max())[None, :] < ends[:, None]] = flat
    return matrix


def spread(rows: DataFrame) -> list[tuple[int, float, float]]:
    """(component, mean, deviation) of the components with the greatest variance; one row a component reaches the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros((2, 0))
        for batch in batches:
            v = matrix_of(batch.column(0))
            if v.shape[1] > sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, v.shape[1] - sums.shape[1])))
            sums[:, : v.shape[1]] += [v.sum(axis=0), (v * v).sum(axis=0)]
            n += len(v)
        at = np.arange(sums.shape[1])
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(np.full(len(at), n)), pa.array(sums[0]), pa.array(sums[1])], names=["i", "n", "s", "q"])

    found = rows.select("v").mapInArrow(partial, "i int, n bigint, s double, q double")
    total = found.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    most = max([r["n"] for r in total], default=0)
    listed = [(r["i"], r["s"] / most, max(r["q"] / most - (r["s"] / most) ** 2, 0.0) ** 0.5) for r in total if most]
    return sorted(listed, key=lambda t: (-t[2], t[0]))[:DIMS]


BLOCKS = "part int, number bigint, width int, ids binary, labels binary, copies binary, vectors binary, low array<double>, high array<double>, kinds array<bigint>"


def blocks(vectors: DataFrame) -> DataFrame:
    """The candidates as a written table of Hilbert-ordered blocks with their zone maps."""
    rows = written(candidates(vectors), "negative-rows")
    chosen = spread(rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix_of(batch.column(2))
            cells = np.zeros((len(v), DIMS), np.int64)
            for axis, (component, mean, deviation) in enumerate(chosen):
                if component < v.shape[1] and deviation > 0:
                    # two deviations on either side of the mean fill the axis
                    cells[:, axis] = np.clip((v[:, component] - mean) / deviation / 4 + 0.5, 0, 1 - 1e-9) * (1 << BITS)
            yield pa.record_batch([*batch.columns, pa.array(hilbert_places(cells, BITS))], names=[*batch.schema.names, "place"])

    placed = rows.mapInArrow(place, "vec_id bigint, label bigint, v array<double>, copies bigint, place bigint")
    order = ["place", "vec_id", F.xxhash64("v", "label")]  # equal vectors are spread by their ids
    dealt = placed.repartitionByRange(max(1, -(-rows.count() // PART)), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= BLOCK:
                whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                yield packed(whole.slice(0, BLOCK), part, made)
                made += 1
                rest = whole.slice(BLOCK)
                waiting = [rest] if rest.num_rows else []
        if sum(b.num_rows for b in waiting):
            yield packed(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0], part, made)

    return written(dealt.select("vec_id", "label", "v", "copies").mapInArrow(pack, BLOCKS), "negative-blocks")


def packed(rows: pa.RecordBatch, part: int, made: int) -> pa.RecordBatch:
    """One block. Its rows are in order of their ids, so that a stable sort by score settles ties."""
    ids = rows.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    labels, copies = (rows.column(i).to_numpy(zero_copy_only=False) for i in (1, 3))
    v = matrix_of(rows.column(2))
    order = np.lexsort((np.asarray(rows.column(0).is_null()), ids))
    values = [part, (part << 20) + made, v.shape[1], *(a[order].tobytes() for a in (ids, labels, copies, v))]
    values += [v.min(axis=0).tolist(), v.max(axis=0).tolist(), np.unique(labels).tolist()]
    nulls = int(rows.column(0).null_count)
    # null ids stand last; their number is kept with the copies
    values[5] += np.array([nulls], np.int64).tobytes()
    types = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4, *[pa.list_(pa.float64())] * 2, pa.list_(pa.int64())]
    return pa.record_batch([pa.array([x], t) for x, t in zip(values, types)], names=[f.split()[0] for f in BLOCKS.split(", ")])


# --- anchors -----------------------------------------------------------------------------------

BATCHES = (
    "group int, batch bigint, width int, ids binary, labels binary, copies binary, homes binary, spots binary, vectors binary"
)


def anchors(table: DataFrame, every: int) -> DataFrame:
    """Batches of anchors with the block and the row where each lies, as a written table."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                counts = np.frombuffer(r["copies"], np.int64)
                nulls = int(counts[-1])
                spots = np.flatnonzero((ids % every == 0) & (np.arange(len(ids)) < len(ids) - nulls))
                vectors = np.frombuffer(r["vectors"]).reshape(len(ids), r["width"])
                for start in range(0, len(spots), BATCH):
                    at = spots[start : start + BATCH]
                    values = [r["part"] // GROUP, r["number"] * (BLOCK // BATCH + 1) + start // BATCH, r["width"]]
                    values += [a.tobytes() for a in (ids[at], np.frombuffer(r["labels"], np.int64)[at], counts[at], np.full(len(at), r["number"]), at, vectors[at])]
                    types = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
                    yield pa.record_batch([pa.array([x], t) for x, t in zip(values, types)], names=[f.split()[0] for f in BATCHES.split(", ")])

    read = table.select("part", "number", "width", "ids", "labels", "copies", "vectors")
    return written(read.mapInArrow(collect, BATCHES), "negative-anchors")


class Anchors:
    """A batch of anchors with its windows: low and high scores and the score to beat in each (anchor, window)."""

    def __init__(self, r: dict):
        self.group, self.batch = r["group"], r["batch"]
        self.ids, self.labels, self.homes, self.spots = (np.frombuffer(r[c], np.int64) for c in ("ids", "labels", "homes", "spots"))
        self.vectors = np.frombuffer(r["vectors"]).reshape(len(self.ids), r["width"])
        windows = r["windows"] or []
        many = 1 + max((w["window"] for w in windows), default=-1)
        self.low, self.high = np.full((len(self.ids), many), np.inf), np.full((len(self.ids), many), -np.inf)
        for w in windows:
            self.low[w["anchor"], w["window"]], self.high[w["anchor"], w["window"]] = w["low"], w["high"]

    def packet(self, number: int, chosen: np.ndarray, spots: np.ndarray) -> list:
        """The chosen anchors and their windows, addressed to a block."""
        return [
            self.group, number, self.batch, self.low.shape[1], self.vectors.shape[1],
            *(a.tobytes() for a in (chosen, spots, self.labels[chosen], self.vectors[chosen], self.low[chosen], self.high[chosen])),
        ]


PACKETS = "group int, number bigint, batch bigint, windows int, width int, chosen binary, spots binary, labels binary, vectors binary, low binary, high binary"
PACKET_NAMES = [f.split()[0] for f in PACKETS.split(", ")]
PACKET_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 6]


def _packets(rows: list[list]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(PACKET_TYPES)], names=PACKET_NAMES)


def home_packets(batches: DataFrame) -> DataFrame:
    """Every anchor to the block where it lies itself."""

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                a = Anchors(r)
                made = [a.packet(int(n), at := np.flatnonzero(a.homes == n), a.spots[at]) for n in np.unique(a.homes)]
                yield from _packets(made).to_batches()

    return batches.mapInArrow(send, PACKETS)


def chosen_packets(table: DataFrame, batches: DataFrame, same: bool) -> DataFrame:
    """Every anchor to the other blocks that may hold something for one of its windows, by their zone maps alone."""
    last_part, = table.agg(F.max("part")).first()
    last_page = (last_part or 0) // PAGES
    last_group = (last_part or 0) // GROUP
    zones = table.select("number", "low", "high", "kinds", F.expr(f"part div {PAGES}").cast("int").alias("page"))
    zones = zones.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(last_group))))
    sent = batches.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(last_page))))

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        made: list[list] = []
        if not left.num_rows or not right.num_rows:
            return _packets(made)
        low, high = (matrix_of(right.column(c).combine_chunks()) for c in ("low", "high"))
        numbers, kinds = right.column("number").to_pylist(), right.column("kinds").to_pylist()
        for r in left.to_pylist():
            a = Anchors(r)
            width = min(a.vectors.shape[1], low.shape[1])
            up, down = np.maximum(a.vectors[:, :width], 0), np.minimum(a.vectors[:, :width], 0)
            most = up @ high[:, :width].T + down @ low[:, :width].T
            least = up @ low[:, :width].T + down @ high[:, :width].T
            for at, (number, labels) in enumerate(zip(numbers, kinds)):
                wanted = np.isin(a.labels, labels) if same else (len(labels) > 1) | (a.labels != labels[0])
                meets = (most[:, at, None] >= a.low) & (least[:, at, None] <= a.high) & (a.low <= a.high)
                chosen = np.flatnonzero(wanted & meets.any(axis=1) & (a.homes != number))
                if len(chosen):
                    made.append(a.packet(number, chosen, np.full(len(chosen), -1)))
        return _packets(made)

    return sent.groupBy("group", "page").cogroup(zones.groupBy("group", "page")).applyInArrow(choose, PACKETS)


HITS = "batch bigint, anchor int, window int, score bigint, vec_id bigint, is_null boolean, copies bigint"


def read_blocks(table: DataFrame, packets: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best of each block for every window of every anchor sent to it. Blocks nobody asks for are not sent."""
    packets = written(packets, "negative-packets")
    asked = packets.select(F.col("group").alias("for_group"), F.col("number").alias("for_number")).distinct()
    bodies = table.select(F.col("number").alias("for_number"), F.col("width").alias("body_width"), "ids", F.col("labels").alias("body_labels"), "copies", F.col("vectors").alias("body"))
    copied = asked.join(bodies, "for_number")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = []
        for block in right.to_pylist():
            ids, counts = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["copies"], np.int64)
            nulls, labels = int(counts[-1]), np.frombuffer(block["body_labels"], np.int64)
            rows = np.frombuffer(block["body"]).reshape(len(ids), block["body_width"])
            for r in left.to_pylist():
                chosen, spots, own = (np.frombuffer(r[c], np.int64) for c in ("chosen", "spots", "labels"))
                q = np.frombuffer(r["vectors"]).reshape(len(chosen), r["width"])
                low, high = (np.frombuffer(r[c]).reshape(len(chosen), r["windows"]) for c in ("low", "high"))
                width = min(q.shape[1], rows.shape[1])
                scores = q[:, :width] @ rows[:, :width].T
                fits = (labels[None, :] == own[:, None]) == same
                here = np.flatnonzero(spots >= 0)
                fits[here, spots[here]] &= counts[spots[here]] > 1  # an anchor's copies are other rows
                scores[~fits] = -np.inf
                order = np.argsort(-scores, axis=1, kind="stable")
                ranked = np.take_along_axis(scores, order, axis=1)
                for w in range(r["windows"]):
                    first = (ranked > high[:, w, None]).sum(axis=1)
                    at = first[:, None] + np.arange(k)[None, :]
                    inside = at < len(ids)
                    at = np.minimum(at, len(ids) - 1)
                    score = np.take_along_axis(ranked, at, axis=1)
                    row, column = np.nonzero(inside & (score >= low[:, w, None]) & (score > -np.inf))
                    spot = order[row, at[row, column]]
                    many = counts[spot] - ((spots[row] == spot) & (spots[row] >= 0))
                    out.append([np.full(len(row), r["batch"]), chosen[row], np.full(len(row), w), score[row, column], ids[spot], spot >= len(ids) - nulls, many])
        types = [np.int64, np.int32, np.int32, np.int64, np.int64, bool, np.int64]
        columns = [np.concatenate([o[i] for o in out]).astype(t) if out else np.empty(0, t) for i, t in enumerate(types)]
        return pa.table([pa.array(c) for c in columns], names=[f.split()[0] for f in HITS.split(", ")])

    return packets.groupBy("group", "number").cogroup(copied.groupBy("for_group", "for_number")).applyInArrow(search, HITS)


def best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each (batch, anchor, window), copies counted, with their rank."""
    each = hits.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("copies"), F.lit(k).cast("long")))))
    order = Window.partitionBy("batch", "anchor", "window").orderBy(F.desc("score"), "is_null", "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("batch", "anchor", "window", "rank", "score", F.when(~F.col("is_null"), F.col("vec_id")).alias("vec_id"), "is_null")


def with_windows(batches: DataFrame, windows: DataFrame) -> DataFrame:
    """Batches with their windows (batch, anchor, window, low, high) attached; a batch has few hundred of them."""
    listed = windows.groupBy("batch").agg(F.collect_list(F.struct("anchor", "window", "low", "high")).alias("windows"))
    return batches.join(listed, "batch", "left").select(*batches.columns, "windows")


def searched(table: DataFrame, batches: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows of every window: (batch, anchor, window, rank, score, vec_id)."""
    first = written(read_blocks(table, home_packets(with_windows(batches, windows)), same, k), "negative-home-hits")
    beaten = best(first, k).where(F.col("rank") == k).select("batch", "anchor", "window", F.col("score").alias("_kth"))
    # an equal score may still win by its id
    raised = windows.join(beaten, ["batch", "anchor", "window"], "left")
    raised = raised.select("batch", "anchor", "window", F.greatest("low", F.col("_kth").cast("double")).alias("low"), "high")
    rest = read_blocks(table, chosen_packets(table, with_windows(batches, raised), same), same, k)
    return best(first.unionByName(rest), k)


def mined(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """The contract's columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    table = blocks(vectors)
    batches = anchors(table, every)

    def listed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                ids, copies = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["copies"], np.int64)
                columns = [np.full(len(ids), r["batch"]), np.arange(len(ids), dtype=np.int32), ids, copies]
                yield pa.record_batch([pa.array(c) for c in columns], names=["batch", "anchor", "anchor_id", "anchor_copies"])

    of = batches.select("batch", "ids", "copies").mapInArrow(listed, "batch bigint, anchor int, anchor_id bigint, anchor_copies bigint")
    whole = of.select("batch", "anchor", F.lit(0).alias("window"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
    found = written(searched(table, batches, whole, True, positives), "negative-positives")

    def per_cent(share: int) -> Column:
        return F.col("score").cast("decimal(20,0)") * share

    windows = found.select(
        "batch", "anchor", (F.col("rank") - 1).alias("window"), F.ceil(per_cent(50) / 100).cast("double").alias("low"), F.floor(per_cent(95) / 100).cast("double").alias("high")
    )
    chosen = searched(table, batches, written(windows, "negative-windows"), False, negatives)
    pairs = found.select("batch", "anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = chosen.join(pairs, ["batch", "anchor", "window"]).join(of, ["batch", "anchor"])
    each = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("anchor_copies"))))
    return each.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= {NEGATIVES}"""
