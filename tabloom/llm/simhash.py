"""SimHash near-duplicates through an inverted index on byte positions, with count filtering.

Two 64-bit fingerprints that differ in 3 bits or fewer agree in at least 5 of their 8 bytes. The index
posts every distinct fingerprint under three bytes at three fixed positions: of any 5 agreeing positions
at least 3 lie in one half, so the 4 + 4 triples of the two halves lose no pair. Within a list the shared
positional bytes of a pair are tallied; pairs with 5 or more are verified bit by bit. A list longer than
``LONG`` is posted anew under all five-byte keys that extend its triple, and there a member looks up its
at most 2,324 neighbours among 24 free bits, so work grows with the list and not with its square.
A list returns a spanning forest of its links, never all its pairs; the links' components are found
by repeated star contractions.

Edge cases: a null text is an empty one; texts without words share fingerprint 0 and are linked; a
component whose ids are all null has a null id; repeated rows stay rows; an empty table gives no rows.
Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import batches_of, written

SHINGLE = 3
DIFFER = 3
SHARED = 8 - DIFFER  # each differing bit spoils one byte at most
TRIPLES = list(combinations(range(4), 3)) + list(combinations(range(4, 8), 3))
LONG = 8192
SEED = 42


def fingerprint(text: bytes) -> int:
    """SimHash of a text's 3-word shingles, repeats included."""
    words = text.lower().split()  # for bytes, lower changes A-Z only and split knows the six ASCII blanks only
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 65536):
        hashes = np.array([digest(s, SEED) for s in shingles[at : at + 65536]], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(shingles), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), dtype=np.uint64, count=len(texts))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed long) of every row."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash bigint, fp bigint")


def _key(fp: Column, which: int, positions: tuple[int, ...]) -> Column:
    """The bytes at the positions, above them the number of the position set."""
    key = F.lit(which).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255).cast("long")))
    return key


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the trees of i and j; every root is the smallest index of its tree."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root[:] = further


def _linked(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs reach the guaranteed number of shared bytes and differ in few enough bits."""
    x = fps[i] ^ fps[j]
    tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    enough = tally >= SHARED
    enough[enough] = np.bitwise_count(x[enough]) <= DIFFER
    return enough


def _within_lists(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges of all lists in rows sorted by key."""
    root = np.arange(len(keys))
    at, step = np.arange(max(0, len(keys) - 1)), 1
    while True:
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        good = at[_linked(fps, at, at + step)]
        _union(root, good, good + step)
        step += 1
    child = np.flatnonzero(root != np.arange(len(root)))
    return fps[root[child]], fps[child]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(keys, fps, long) of rows sorted by key: whole lists, or the parts of a list longer than LONG."""
    empty = (np.empty(0, np.int64), np.empty(0, np.uint64))
    keys, fps = empty
    long_key = None
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
        if long_key is not None:
            same = keys == long_key
            if same.any():
                yield keys[same], fps[same], True
            keys, fps = keys[~same], fps[~same]
            if not len(keys):
                continue
            long_key = None
        last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if last:
            yield keys[:last], fps[:last], False
        keys, fps = keys[last:], fps[last:]
        if len(keys) > LONG:
            long_key = keys[0]
            yield keys, fps, True
            keys, fps = empty
    if len(keys):
        yield keys, fps, False


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of short lists (long false: two fingerprints) and members of long ones (long true: key, fingerprint)."""

    def rows(a: np.ndarray, b: np.ndarray, long: bool) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.full(len(a), long)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["long", "a", "b"])

    for keys, fps, long in _runs(batches):
        if not long:
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            over = np.repeat(np.diff(np.r_[starts, len(keys)]) > LONG, np.diff(np.r_[starts, len(keys)]))
            if over.any():
                yield rows(keys[over], fps[over], True)
                keys, fps = keys[~over], fps[~over]
            a, b = _within_lists(keys, fps)
            if len(a):
                yield rows(a, b, False)
        elif len(keys):
            yield rows(keys, fps, True)


def _near_in_long(fps: np.ndarray, positions: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges among distinct fingerprints that agree outside three byte positions."""
    free = np.zeros(len(fps), dtype=np.int64)
    for k, p in enumerate(positions):
        free |= ((fps >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) << (8 * k)
    order = np.argsort(free)
    free, fps = free[order], fps[order]
    root = np.arange(len(fps))
    masks = [sum(1 << bit for bit in bits) for n in range(1, DIFFER + 1) for bits in combinations(range(24), n)]
    if len(fps) <= len(masks):
        for step in range(1, len(fps)):
            at = np.arange(len(fps) - step)
            good = at[np.bitwise_count(free[at] ^ free[at + step]) <= DIFFER]
            _union(root, good, good + step)
    else:
        for mask in masks:
            wanted = free ^ mask
            to = np.minimum(np.searchsorted(free, wanted), len(free) - 1)
            good = np.flatnonzero((free[to] == wanted) & (wanted > free))
            _union(root, good, to[good])
    child = np.flatnonzero(root != np.arange(len(root)))
    return fps[root[child]], fps[child]


FIVES = list(combinations(range(8), SHARED))


def _long_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of five-byte lists; a list has at most 2**24 distinct members."""

    def solved(key: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        agreed = FIVES[key >> 40]
        a, b = _near_in_long(np.concatenate(parts), tuple(p for p in range(8) if p not in agreed))
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    key, parts = None, []
    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
        for s, e in zip(starts, np.r_[starts[1:], len(keys)].astype(int) if len(keys) else []):
            if keys[s] != key:
                if parts:
                    yield solved(int(key), parts)
                key, parts = keys[s], []
            parts.append(fps[s:e].copy())
    if parts:
        yield solved(int(key), parts)


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly what pairs at 3 differing bits or fewer connect; ``distinct`` has fp."""
    posted = F.explode(F.array(*[_key(F.col("fp"), n, t) for n, t in enumerate(TRIPLES)]))
    lists = distinct.select(posted.alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    found = written(lists.mapInArrow(_postings, "long boolean, a bigint, b bigint"), "simhash-lists")
    fp = F.col("b")
    five = [F.when(F.shiftright("a", 24).isin(*[n for n, t in enumerate(TRIPLES) if set(t) <= set(s)]), _key(fp, m, s)) for m, s in enumerate(FIVES)]
    again = found.where("long").select(F.explode(F.array_compact(F.array(*five))).alias("key"), fp.alias("fp")).distinct()
    rest = again.repartition("key").sortWithinPartitions("key").mapInArrow(_long_lists, "a bigint, b bigint")
    return found.where("not long").select("a", "b").unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node that has an edge.

    Large-star and small-star rounds: first each node sends its larger neighbours to its smallest one,
    then its smaller ones. A round is two joins on a node, whose hot keys Spark splits.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that names the component) and component_id of every row."""
    spark = docs.sparkSession
    with batches_of(spark, 500):
        prints = written(fingerprints(docs), "simhash-prints")
    smallest = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(smallest.select("fp")))
    members = smallest.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    members = written(members, "simhash-members")
    ids = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(members.join(ids, "root").select("fp", "root", "component_id"), "fp", "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id."""
    return grouped(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each component: the one with the smallest id, of several with that id the one with the smallest hash."""
    marked = grouped(docs).select("root", F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).alias("key"))
    chosen = marked.groupBy("root", "key").agg(F.count(F.lit(1)).alias("copies")).groupBy("root").agg(F.min(F.struct("key", "copies")).alias("best"))
    chosen = chosen.select(F.col("best.key.id").alias("chosen_id"), F.col("best.key.hash").alias("chosen_hash"), F.col("best.copies").alias("copies"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_hash"))
    kept = rows.join(written(chosen, "simhash-chosen"), F.col("key_id").eqNullSafe(F.col("chosen_id")) & (F.col("key_hash") == F.col("chosen_hash")))
    # only rows that are there more than once need to be told apart
    single = kept.where("copies = 1").select("row")
    several = kept.where("copies > 1").groupBy("key_id", "key_hash").agg(F.first("row").alias("row")).select("row")
    return single.unionByName(several).select("row.*")
