"""Language-model scores by prediction by partial matching over bytes.

Every context of up to four bytes of the training texts counts, with the counts of the bytes that follow
(``pruned`` leaves out contexts of three and four under 1/65,536 of the training bytes). A trie in every worker
is the fast path: the most frequent contexts, at most 65,536 of each length, each with its whole distribution.
Where it lacks contexts, the bytes after a context of four that is not in it are counted by text, joined with
the written counts by context and by its last three bytes, and added up by text; the numbers are the same.
Byte 0xFF, which UTF-8 never uses, stands before a text and ends it. Escapes are estimated by
method C: a context seen n times with q different successors escapes with q / (n + q). What a longer context
has already offered is excluded from the shorter ones, and after the empty context the rest is shared evenly,
so every row is a probability distribution. The model is pretrained; a text's score follows each byte's
context down the trie and adds up one entry per byte.

The base score is a word unigram model. Tokens with at least 1/65,536 of all occurrences, which are at most
65,536 tokens, are counted inside the scoring pass; the rest are joined with the corpus counts by token.

Edge cases: a null text is an empty one; a null id counts as an empty id and so as held out; repeated rows
are scored each; without training rows all counts are 0; an empty table gives no rows. Only doc_id and text
are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import batches_of, written

ORDER = 4  # bytes of the longest context
FREQUENT = 65_536
HELD = 1_000_000  # distinct tokens or grams that a worker adds up before it passes them on
SLAB = 1 << 21  # bytes of text that a worker codes at once
TEXTS = 300
END = " "  # no word holds a blank


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def slabs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Consecutive pieces of texts, joined: (bytes, piece starts, number of the text of each piece).

    A text is led by ORDER edge bytes and ended by one. A piece longer than SLAB is cut, and the next piece
    starts with the ORDER bytes before it. The first ORDER bytes of a piece are context only.
    """
    buffer, starts, numbers, size = [], [], [], 0
    for number, text in enumerate(texts):
        data = b"\xff" * ORDER + text + b"\xff"
        for at in range(0, len(data) - ORDER, SLAB):
            piece = data[at : at + SLAB + ORDER]
            starts.append(size)
            numbers.append(number)
            buffer.append(piece)
            size += len(piece)
            if size >= SLAB:
                yield np.frombuffer(b"".join(buffer), np.uint8), np.array(starts), numbers
                buffer, starts, numbers, size = [], [], [], 0
    if buffer:
        yield np.frombuffer(b"".join(buffer), np.uint8), np.array(starts), numbers


def grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of a byte and the ORDER bytes before it (the oldest highest), with counts."""
    return np.unique(coded(data)[scored_places(data, starts)], return_counts=True)


def coded(data: np.ndarray) -> np.ndarray:
    wide = data.astype(np.int64)
    codes = wide.copy()
    for back in range(1, ORDER + 1):
        codes[back:] |= wide[:-back] << (8 * back)
    return codes


def scored_places(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """False for the first ORDER bytes of every piece."""
    inner = np.ones(len(data), bool)
    for lead in range(ORDER):
        inner[starts + lead] = False
    return inner


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def words(text: bytes) -> list[bytes]:
    """A-Z lowered, split at the six ASCII blanks; both are what bytes methods do."""
    return text.lower().split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: (token, code, n, c); a token or, with a null token, the code of a gram."""
    seen: Counter = Counter()
    train: Counter = Counter()
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def rows(tokens: list | None, codes: np.ndarray | None, n, c) -> pa.RecordBatch:
        size = len(n)
        first = pa.nulls(size, pa.string()) if tokens is None else pa.array(tokens, pa.string())
        second = pa.nulls(size, pa.int64()) if codes is None else pa.array(codes, pa.int64())
        return pa.record_batch([first, second, pa.array(n, pa.int64()), pa.array(c, pa.int64())], names=["token", "code", "n", "c"])

    def tokens() -> pa.RecordBatch:
        keys = list(seen)
        batch = rows([k.decode("utf-8", "replace") for k in keys], None, [seen[k] for k in keys], [train.get(k, 0) for k in keys])
        seen.clear()
        train.clear()
        return batch

    for batch in batches:
        texts = [t or b"" for t in batch.column(0).to_pylist()]
        learns = batch.column(1).to_pylist()
        for text, learn in zip(texts, learns):
            found = words(text)
            found.append(END.encode())
            seen.update(found)
            if learn:
                train.update(found)
            if len(seen) > HELD:
                yield tokens()
        for data, starts, _ in slabs([t for t, learn in zip(texts, learns) if learn]):
            parts.append(grams(data, starts))
            if sum(len(c) for c, _ in parts) > HELD:
                parts = [merged(parts)]
                if len(parts[0][0]) > HELD // 2:
                    yield rows(None, parts[0][0], parts[0][1], parts[0][1])
                    parts = []
    if seen:
        yield tokens()
    if parts:
        codes, counts = merged(parts)
        yield rows(None, codes, counts, counts)


class Trie:
    """log10 probabilities by context; a context's children are the contexts with one more byte before it."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], whole: bool = True):
        """levels: for contexts of 1, 2, ... bytes, the sorted codes of grams (the oldest byte highest) and their counts.

        ``whole``: no context was left out.
        """
        self.whole = whole
        one = np.zeros((256, 256))
        np.add.at(one, (levels[0][0] >> 8, levels[0][0] & 255), levels[0][1])
        zero = one.sum(axis=0, keepdims=True)
        counts, parents, depth = [one], [np.full(256, -1)], [np.arange(256)]
        first = [0]
        for codes, n in levels[1:]:
            contexts, flat = np.unique(codes >> 8, return_inverse=True)
            table = None  # the longest contexts are laid out by parts below
            if len(first) + 1 < len(levels):
                table = np.zeros((len(contexts), 256), np.float32 if len(contexts) > 4096 else np.float64)
                table[flat, codes & 255] = n
            shift = 8 * (len(first))
            parents.append(first[-1] + np.searchsorted(depth[-1], contexts & ((1 << shift) - 1)))
            first.append(first[-1] + len(depth[-1]))
            counts.append(table)
            depth.append(contexts)
        size = first[-1] + len(depth[-1])
        self.dead, self.inner = size, first[-1]  # the longest contexts have no children
        self.child = np.full((self.inner + 1, 256), size, np.int32)
        for level in range(1, len(counts)):
            self.child[parents[level], depth[level] >> (8 * level)] = first[level] + np.arange(len(depth[level]))
        self.table = np.empty((size, 256), np.float32)
        for level, rows in enumerate(counts):
            for at in range(0, len(depth[level]), 2048):
                here = np.arange(at, min(at + 2048, len(depth[level])))
                if rows is None:
                    low, high = np.searchsorted(flat, [at, at + 2048])
                    part = np.zeros((len(here), 256))
                    part[flat[low:high] - at, codes[low:high] & 255] = n[low:high]
                else:
                    part = rows[here]
                chain = [part]
                for up in range(level, 0, -1):
                    here = parents[up][here] - first[up - 1]
                    chain.append(counts[up - 1][here])
                chain.append(np.repeat(zero, len(here), axis=0))
                self.table[first[level] + at : first[level] + at + len(here)] = blended(chain)

    def costs(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each byte given those before it, and whether the whole context is in the trie.

        The first ORDER entries of a piece mean nothing.
        """
        row = np.zeros(len(data), np.int32)
        row[1:] = data[:-1]
        at, child = row.copy(), self.child.reshape(-1)
        for back in range(2, ORDER + 1):
            older = np.zeros(len(data), np.int64)
            older[back:] = data[:-back]
            at = child[np.minimum(at, self.inner).astype(np.int64) * 256 + older]
            row = np.where(at == self.dead, row, at)
        return self.table.reshape(-1)[row.astype(np.int64) * 256 + data], at != self.dead

    def cost(self, data: np.ndarray) -> np.ndarray:
        return self.costs(data)[0]


class Packed:
    """The counts of a trie for a broadcast; a worker lays the trie out once."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], whole: bool):
        self.whole = whole
        self.parts = [tuple(zlib.compress(a.astype(np.int64).tobytes(), 1) for a in (np.diff(c, prepend=0), n)) for c, n in levels]

    def levels(self, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Those of contexts of up to ``size`` bytes."""
        plain = [tuple(np.frombuffer(zlib.decompress(a), np.int64) for a in p) for p in self.parts[:size]]
        return [(np.cumsum(c), n.astype(np.float64)) for c, n in plain]

    @cached_property
    def trie(self) -> Trie:
        return Trie(self.levels(ORDER), self.whole)


def blended(levels: list[np.ndarray]) -> np.ndarray:
    """log10 of the distributions of rows of counts, longest context first."""
    left = np.ones((len(levels[0]), 1))
    out = np.zeros(levels[0].shape)
    excluded = np.zeros(out.shape, bool)
    for counts in levels:
        counts = np.where(excluded, 0, counts)
        n, q = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        out += left * counts / np.maximum(n + q, 1)
        left = left * np.where(q > 0, q / np.maximum(n + q, 1), 1.0)
        excluded |= counts > 0
    rest = (~excluded).sum(axis=1, keepdims=True)
    out += np.where(excluded, 0, left / np.maximum(rest, 1))
    return np.log10(out)


def learn(docs: DataFrame, pruned: bool) -> tuple[DataFrame, DataFrame, Packed]:
    """Token counts (token, n in all texts, c in training texts) and counts of all grams (code, c) as written tables, and the trie."""
    rows = docs.select(F.col("text").cast("binary").alias("text"), (~held_out(F.col("doc_id"))).alias("learn"))
    with batches_of(docs.sparkSession, TEXTS):
        partial = rows.mapInArrow(_counts, "token string, code bigint, n bigint, c bigint")
        counts = written(partial.groupBy("token", "code").agg(F.sum("n").alias("n"), F.sum("c").alias("c")), "lm-counts")
    seen = counts.where("token is null").select("code", "c")
    levels, whole, lowest = [], True, 0
    least = -(-(seen.agg(F.sum("c")).first()[0] or 0) // FREQUENT) if pruned else 1
    for order in range(1, ORDER + 1):
        level = seen.groupBy(_tail("code", order + 1).alias("code")).agg(F.sum("c").alias("c"))
        if order > 2:
            context = F.shiftright("code", 8)
            # classes of counts: a context's last bytes are in the same class or a higher one, so the trie has them too
            often = level.groupBy(context.alias("context")).agg(F.sum("c").alias("n")).where(F.col("n") >= least)
            often = often.select("context", F.floor(F.log2("n") * 16).alias("times"))
            many = 0
            for times, n in sorted((tuple(r) for r in often.groupBy("times").count().collect()), reverse=True):
                many += n
                if many > FREQUENT:
                    lowest, whole = max(lowest, times + 1), False
                    break
            if lowest or pruned:
                level = level.join(often.where(F.col("times") >= lowest), context == F.col("context"), "left_semi")
        found = level.toPandas().sort_values("code")  # at most FREQUENT contexts
        levels.append((found["code"].to_numpy(np.int64), found["c"].to_numpy(np.float64)))
    return counts.where("token is not null").select("token", "n", "c"), seen, Packed(levels, whole)


def _tail(code: str, size: int) -> Column:
    """The last ``size`` bytes of a code."""
    return F.col(code).bitwiseAND(F.lit((1 << (8 * size)) - 1))


def gram_costs(wanted: DataFrame, seen: DataFrame, trie: Packed) -> DataFrame:
    """code and cost (log10 probability of the last byte) of the distinct grams ``wanted``, from the counts of all grams.

    Contexts of one and two bytes are all in the trie. A context has one row, with at most 256 successors.
    """
    following = F.collect_list(F.struct(_tail("code", 1).cast("int").alias("byte"), F.col("c")))
    four = seen.groupBy(F.shiftright("code", 8).alias("context")).agg(following.alias("four"))
    shorter = seen.groupBy(_tail("code", ORDER).alias("code")).agg(F.sum("c").alias("c"))
    three = shorter.groupBy(F.shiftright("code", 8).alias("short")).agg(following.alias("three"))
    asked = wanted.groupBy(F.shiftright("code", 8).alias("context")).agg(F.collect_list(_tail("code", 1).cast("int")).alias("bytes"))
    joined = asked.join(four, "context", "left").withColumn("short", _tail("context", ORDER - 1)).join(three, "short", "left")
    shared = wanted.sparkSession.sparkContext.broadcast(trie.levels(2))

    def dense(column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), 256))
        flat = column.flatten()
        at = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        out[at, flat.field(0).to_numpy(zero_copy_only=False)] = flat.field(1).to_numpy(zero_copy_only=False)
        return out

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one_codes, one_counts), (two_codes, two_counts) = shared.value
        one = np.zeros((256, 256))
        one[one_codes >> 8, one_codes & 255] = one_counts
        zero = one.sum(axis=0, keepdims=True)
        two_contexts, flat = np.unique(two_codes >> 8, return_inverse=True)
        two = np.zeros((len(two_contexts) + 1, 256), np.float32)  # the last row: contexts never seen
        two[flat, two_codes & 255] = two_counts
        place = np.full(65536, len(two_contexts))
        place[two_contexts] = np.arange(len(two_contexts))
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                context = batch.column(0).to_numpy(zero_copy_only=False)
                chain = [dense(batch.column(2)), dense(batch.column(3)), two[place[context & 65535]], one[context & 255], np.repeat(zero, len(context), axis=0)]
                table = blended(chain).astype(np.float32)
                asked_bytes = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(context)), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
                yield pa.record_batch([pa.array(context[row] << 8 | asked_bytes), pa.array(table[row, asked_bytes].astype(np.float64))], names=["code", "cost"])

    return joined.select("context", "bytes", "four", "three").mapInArrow(costs, "code bigint, cost double")


def _by_text(numbers: list[np.ndarray], codes: list[np.ndarray], texts: int) -> tuple[pa.Array, pa.Array]:
    """The distinct codes of each text and how often it has them."""
    number, code = (np.concatenate(p) if p else np.empty(0, np.int64) for p in (numbers, codes))
    order = np.lexsort((code, number))
    number, code = number[order], code[order]
    first = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (code[1:] != code[:-1])][: len(code)])
    times = np.diff(np.r_[first, len(code)])
    offsets = pa.array(np.searchsorted(number[first], np.arange(texts + 1)), pa.int32())
    return (pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in (code[first], times))


def scored(docs: DataFrame, pruned: bool = True) -> DataFrame:
    """The contract's columns. ``pruned`` is the model without rare contexts; without it every context counts."""
    spark = docs.sparkSession
    counts, seen_grams, trie = learn(docs, pruned)
    total = counts.agg(F.sum("n"), F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n_all, n_train, distinct = (v or 0 for v in total)
    lowest = max(1, -(-n_all // FREQUENT))
    frequent = {r["token"].encode(): r["c"] for r in counts.where(F.col("n") >= lowest).collect()}  # at most FREQUENT rows
    shared = spark.sparkContext.broadcast((frequent, trie))
    unit = math.log10(n_train + 0.1 * (distinct + 1))
    kind = dict(docs.dtypes)["doc_id"]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packed = shared.value
        model = packed.trie
        logs = {k: math.log10(c + 0.1) for k, c in known.items()}
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            score = np.zeros(len(texts))
            owners, codes = [], []
            for data, starts, numbers in slabs(texts):
                cost, known_context = model.costs(data)
                inner = scored_places(data, starts)
                here = inner if model.whole else inner & known_context
                np.add.at(score, numbers, np.add.reduceat(np.where(here, cost.astype(np.float64), 0), starts))
                if not model.whole:
                    away = inner & ~known_context
                    owners.append(np.repeat(numbers, np.diff(np.r_[starts, len(data)]))[away])
                    codes.append(coded(data)[away])
            codes, times = _by_text(owners, codes, len(texts))
            n, hits, base, rare = [], [], [], []
            for text in texts:
                found = words(text)
                found.append(END.encode())
                some, seen, others = 0.0, 0, []
                for w in found:
                    value = logs.get(w)
                    if value is None:
                        others.append(w)
                    else:
                        some += value
                        seen += known[w] > 0
                n.append(len(found))
                hits.append(seen)
                base.append(some)
                rare.append([w.decode("utf-8", "replace") for w in others])
            ids = pa.array(range(number, number + len(texts)), pa.int64())
            number += len(texts)
            yield pa.record_batch(
                [ids, batch.column(0), pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(base, pa.float64()), pa.array(score), pa.array(rare, pa.list_(pa.string())), codes, times],
                names=["row", "doc_id", "n_tokens", "known", "base", "score", "rare", "codes", "times"],
            )

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    with batches_of(spark, TEXTS):
        columns = f"row bigint, doc_id {kind}, n_tokens bigint, known bigint, base double, score double, rare array<string>, codes array<bigint>, times array<bigint>"
        passed = written(rows.mapInArrow(first_pass, columns), "lm-rows")
    rare = passed.select("row", F.explode("rare").alias("token"))
    found = rare.join(counts.where(F.col("n") < lowest).select("token", "c"), "token", "left")
    count = F.coalesce("c", F.lit(0))
    by_row = found.groupBy("row").agg(F.sum(F.log10(count + 0.1)).alias("more"), F.count(F.when(count > 0, 1)).alias("more_known"))
    ready = passed.drop("rare", "codes", "times").join(by_row, "row", "left")
    score = F.col("score")
    if not trie.whole:
        away = passed.select("row", F.explode(F.arrays_zip("codes", "times")).alias("g")).select("row", "g.codes", "g.times").withColumnRenamed("codes", "code")
        costs = gram_costs(away.select("code").distinct(), seen_grams, trie)
        by_grams = away.join(costs, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("away"))
        ready, score = ready.join(by_grams, "row", "left"), score + F.coalesce("away", F.lit(0.0))
    return ready.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * unit).alias("base_score"),
        score.alias("score"),
    )
