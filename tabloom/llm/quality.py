"""A byte-level convolutional quality classifier in numpy.

Filters of eight bytes slide over the whole text, two bytes at a time. Their responses are max-pooled over
overlapping chunks (each the maximum of two neighbouring half-chunks); the mean, the largest and the
smallest chunk maximum of every filter enter one logistic output. Training runs on the driver on a bounded
sample of labelled rows; scoring reads every byte of every text, in slabs of bounded size.

Edge cases: a null text is an empty one and gets the score of a text of padding; rows without a label are
scored like all others; conflicting labels of one id count as the rounded mean; training takes one
row of an id, the text with the smallest hash; without both classes in the
sample every score is the share of label 1 (0.5 without labels); an empty table gives no rows. Only doc_id,
text and the labels are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import batches_of, written

WIDTH, STRIDE, FILTERS = 8, 2, 24
HALF = 256  # bytes of a half-chunk; a chunk is 512 bytes and overlaps its neighbours by half
SAMPLE_ROWS = 2000  # training rows of each label, at most
SAMPLE_CHUNKS = 8  # chunks of a training row, spread evenly over its text
EPOCHS, BATCH, RATE = 12, 64, 0.01
THRESHOLD = 0.3
SLAB = 1 << 21  # bytes that a worker convolves at once


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS): what a byte at an offset adds to a filter's response
    bias: np.ndarray
    weights: np.ndarray  # for the mean, largest and smallest chunk maximum
    constant: float

    def pairs(self) -> np.ndarray:
        """The same filters over byte pairs: (WIDTH / 2, 65536, FILTERS)."""
        tables = [self.filters[2 * k][:, None, :] + self.filters[2 * k + 1][None, :, :] for k in range(WIDTH // 2)]
        return np.stack([t.reshape(65536, -1) for t in tables]).astype(np.float32)


def padded(text: bytes) -> bytes:
    """Whole half-chunks, at least two."""
    size = max(2, -(-len(text) // HALF)) * HALF
    return text.ljust(size, b"\0")


def half_maxima(data: bytes, pairs: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each half-chunk of padded bytes; windows may reach into the next one."""
    codes = np.frombuffer(data, dtype=">u2").astype(np.int32)
    codes = np.concatenate([codes, np.zeros(WIDTH // 2 - 1, np.int32)])
    count = len(data) // 2
    total = pairs[0][codes[:count]]
    for k in range(1, WIDTH // 2):
        total += pairs[k][codes[k : k + count]]
    pooled = total.reshape(-1, HALF // 2, total.shape[1]).max(axis=1)
    return np.maximum(pooled + bias, 0)


def document_maxima(text: bytes, pairs: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Half-chunk maxima of one text of any length, slab by slab; a slab sees the start of the next one."""
    data, parts = padded(text), []
    for at in range(0, len(data), SLAB):
        piece = data[at : at + SLAB + HALF]
        parts.append(half_maxima(piece, pairs, bias)[: -(-min(SLAB, len(data) - at) // HALF)])
    return np.concatenate(parts)


def probability(halves: np.ndarray, net: Network) -> float:
    chunks = np.maximum(halves[:-1], halves[1:])
    features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
    return float(1 / (1 + np.exp(-np.clip(features @ net.weights + net.constant, -30, 30))))


def train(samples: list[list[bytes]], labels: np.ndarray, weights: np.ndarray, seed: int = 3) -> Network:
    """Adam on the weighted log loss; gradients reach the filters through the winning positions only."""
    rng = np.random.default_rng(seed)
    net = {
        "f": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "b": np.zeros(FILTERS, np.float32),
        "w": rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32),
        "c": np.zeros(1, np.float32),
    }
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    bytes_of = [np.frombuffer(b"".join(chunks), np.uint8).reshape(len(chunks), -1) for chunks in samples]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            chunks = np.concatenate([bytes_of[i] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(bytes_of[i]) for i in chosen])
            count = (chunks.shape[1] - WIDTH) // STRIDE + 1
            total = net["f"][0][chunks[:, 0 : 2 * count : 2]]
            for o in range(1, WIDTH):
                total += net["f"][o][chunks[:, o : o + 2 * count : 2]]
            winner = total.argmax(axis=1)
            top = np.take_along_axis(total, winner[:, None, :], axis=1)[:, 0] + net["b"]
            pooled = np.maximum(top, 0)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            mean = np.add.reduceat(pooled, starts, axis=0) / sizes[:, None]
            high, low = np.maximum.reduceat(pooled, starts, axis=0), np.minimum.reduceat(pooled, starts, axis=0)
            features = np.concatenate([mean, high, low], axis=1)
            score = 1 / (1 + np.exp(-np.clip(features @ net["w"] + net["c"], -30, 30)))
            error = (score - labels[chosen]) * weights[chosen] / weights[chosen].sum()
            back = error[:, None] * net["w"][None, :]
            of_mean, of_high, of_low = back[:, :FILTERS], back[:, FILTERS : 2 * FILTERS], back[:, 2 * FILTERS :]
            at_high, at_low = (pooled == high[owner]), (pooled == low[owner])
            many_high, many_low = (np.add.reduceat(a.astype(np.float32), starts, axis=0) for a in (at_high, at_low))
            grad = of_mean[owner] / sizes[owner][:, None] + at_high * (of_high / many_high)[owner] + at_low * (of_low / many_low)[owner]
            grad = (grad * (top > 0)).astype(np.float32)
            by_filter = np.zeros_like(net["f"])
            row, column = np.nonzero(grad)
            for o in range(WIDTH):
                np.add.at(by_filter[o], (chunks[row, winner[row, column] * STRIDE + o], column), grad[row, column])
            slopes = {"f": by_filter, "b": grad.sum(axis=0), "w": features.T @ error + 1e-4 * net["w"], "c": np.array([error.sum()])}
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                pace = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                net[k] = (net[k] - pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return Network(net["f"], net["b"], net["w"].astype(np.float64), float(net["c"][0]))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is a multiple of 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            data = padded(text or b"")
            last = len(data) // HALF - 2
            at = sorted({round(k * last / (SAMPLE_CHUNKS - 1)) for k in range(SAMPLE_CHUNKS)})
            out.append([data[a * HALF : (a + 2) * HALF] for a in at])
        yield pa.record_batch([batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.binary()))], names=["quality", "weight", "chunks"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network | float:
    """The network, or a constant score when the labels are all the same."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.round(F.avg("quality")).cast("int").alias("quality"))
    )
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    mark = F.xxhash64(F.lit(5), "doc_id")
    chosen = [known.where(F.col("quality") == q).orderBy(mark, "doc_id").limit(sample_rows) for q in (0, 1)]
    scale = F.when(F.col("quality") == 0, max(1.0, counts[0] / sample_rows)).otherwise(max(1.0, counts[1] / sample_rows))
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]).withColumn("weight", scale))  # 2 x sample_rows ids
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(chosen, "doc_id")
    # one row of each id, however often it is repeated
    rows = rows.groupBy("doc_id", "quality", "weight").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "quality", "weight")
    with batches_of(docs.sparkSession, 200):
        found = rows.mapInArrow(_sample, "quality int, weight double, chunks array<binary>").collect()
    found.sort(key=lambda r: (r["quality"], r["chunks"]))
    if len({r["quality"] for r in found}) < 2:
        return float(found[0]["quality"]) if found else 0.5
    samples = [[bytes(c) for c in r["chunks"]] for r in found]
    return train(samples, np.array([r["quality"] for r in found], float), np.array([r["weight"] for r in found]))


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """doc_id and score of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    if isinstance(net, float):
        return docs.select("doc_id", F.lit(net).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # 200 kB whatever the input

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pairs = model.pairs()
        for batch in batches:
            found = [probability(document_maxima(t.as_py() or b"", pairs, model.bias), model) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scores, f"doc_id {kind}, score double")


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, held_out, score, predicted."""
    net = fit(docs, labels)
    with batches_of(docs.sparkSession, 500):
        scores = written(score(docs, net), "quality-scores")
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose predicted label is 1."""
    net = fit(docs, labels)
    if isinstance(net, float):
        return docs.where(F.lit(net >= THRESHOLD))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pairs = model.pairs()
        for batch in batches:
            found = [probability(document_maxima((t.as_py() or "").encode(), pairs, model.bias), model) >= THRESHOLD for t in batch.column(place)]
            yield batch.filter(pa.array(found, pa.bool_()))

    with batches_of(docs.sparkSession, 500):
        return written(docs.mapInArrow(keep, docs.schema), "quality-accepted")
