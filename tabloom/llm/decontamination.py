"""Benchmark decontamination with spaced seeds that lose nothing.

An item counts as found on a diagonal (place in the document minus place in the item) if some window of
``WINDOW`` of its words (all of them, if it is shorter) agrees in at least ``SIMILAR`` of its places; words
that the document does not have, before its start or beyond its end, are unequal. Seeds are hashes of the words
under a fixed mask that ignores some positions. ``MASKS`` has a family of masks for each number of unequal words
that a window may have: wherever those lie in a window of the family's size, one mask fits between them at some
place. A longer window has such a window in it, so it is covered too; a test enumerates every case.

Seeds of all places of all items meet those of all documents in an equality join that carries ids and places
only. Each diagonal that is hit is kept once, and the words of the documents with hits are then laid beside the
item's to count equal places.

Words are maximal runs of letters and digits, lower-cased. Items under ``LEAST`` words are too short to tell
and find nothing. The SQL uses no seeds: it counts equal words on all diagonals.

Edge cases: null texts have no words; null ids stay null in the result; repeated rows of the same id and text
give one result; repeated items of the same id and text too; empty tables give no rows. Only doc_id and text,
item_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import written

# By the size of a window, masks that cover all its accepted patterns. A 1 takes part in the hash.
MASKS = {
    5: ("1011", "1101"),
    10: ("11001011", "111011", "11010011"),
    15: ("1011100101", "10100010111", "111001010001"),
    16: ("11110001001", "1001001111"),
}
LEAST = 5
WINDOW = 16
SIMILAR = 0.8


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words. Equal words have equal hashes; verification compares these."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def family(words: int) -> int:
    """The window size whose masks serve items of so many words."""
    return max(size for size in MASKS if size <= min(words, WINDOW))


def placed(rows: DataFrame, keys: list[str], masks: list[str]) -> DataFrame:
    """The keys with each place and seed of their ``words``; the words stay behind.

    The words are laid beside themselves moved by one, two, ... places, so that a place has its next words as columns.
    """
    span, count = max(map(len, masks)), F.size("words")
    moved = [F.slice("words", i + 1, F.greatest(count - i, F.lit(0))).alias(f"w{i}") for i in range(span)]
    # the outer form: the plain one makes the planner split every text once more to see whether it has words
    beside = rows.select(*keys, F.posexplode_outer(F.arrays_zip(*moved)).alias("place", "at"))

    def seed(mask: str) -> Column:
        picked = [F.col(f"at.w{i}") for i, bit in enumerate(mask) if bit == "1"]
        number = [m for family in MASKS.values() for m in family].index(mask)
        return F.when(picked[-1].isNotNull(), F.xxhash64(F.lit(number), *picked))

    made = beside.select(*keys, "place", F.explode(F.array(*map(seed, masks))).alias("seed"))
    return made.where("seed IS NOT NULL")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, overlap, equal_words, best_window, text_hash for every verified diagonal."""
    items = written(
        benchmark.select("item_id", F.xxhash64("text").alias("item_hash"), word_hashes(F.col("text")).alias("words")).distinct(), "benchmark-items"
    )
    words = F.size("words")
    serving = F.lit(None).cast("int")
    for size in sorted(MASKS):
        serving = F.when(words >= size, F.lit(size)).otherwise(serving)
    used = [size for (size,) in items.select(serving.alias("f")).where("f IS NOT NULL").distinct().collect()]  # at most four
    of_items = None
    for size in used or [WINDOW]:
        part = placed(items.where(serving == size), ["item_id", "item_hash"], list(MASKS[size]))
        of_items = part if of_items is None else of_items.unionByName(part)
    # written, so that the planner knows its bytes when it picks the join
    of_items = written(of_items.withColumnRenamed("place", "item_place"), "benchmark-seeds")

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    masks = [mask for size in used or [WINDOW] for mask in MASKS[size]]
    of_docs = placed(texts.select("doc_id", "text_hash", word_hashes(F.col("text")).alias("words")), ["doc_id", "text_hash"], masks)
    diagonal = (F.col("place") - F.col("item_place")).alias("diagonal")
    hits = written(of_docs.join(of_items, "seed").select("doc_id", "text_hash", "item_id", "item_hash", diagonal).distinct(), "benchmark-hits")

    def same(id_: str, hash_: str, other: str) -> Column:
        return F.col(id_).eqNullSafe(F.col(f"{other}_id")) & F.col(hash_).eqNullSafe(F.col(f"{other}_hash"))

    hit = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    texts = texts.join(hit, same("doc_id", "text_hash", "hit"), "left_semi")
    # a text that many rows repeat is laid beside the item once
    sides = texts.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).agg(F.first("text").alias("text"))
    sides = sides.select("of_id", "of_hash", word_hashes(F.col("text")).alias("doc_words"))
    item = items.select(F.col("item_id").alias("by_id"), F.col("item_hash").alias("by_hash"), F.col("words").alias("item_words"))
    both = hits.join(sides, same("doc_id", "text_hash", "of")).join(item, same("item_id", "item_hash", "by"))

    start = F.greatest(-F.col("diagonal"), F.lit(0))
    length = F.least(F.size("item_words"), F.size("doc_words") - F.col("diagonal")) - start
    aligned = both.select(
        "doc_id", "text_hash", "item_id", "item_hash", "diagonal", start.alias("item_start"), F.size("item_words").alias("item_size"),
        F.zip_with(
            F.slice("doc_words", F.col("diagonal") + start + 1, length), F.slice("item_words", start + 1, length), lambda a, b: (a == b).cast("int")
        ).alias("equal"),
    )
    window = F.least(F.lit(WINDOW), F.col("item_size"))
    add = lambda values: F.aggregate(values, F.lit(0), lambda total, v: total + v)
    within = F.array_max(F.transform(F.sequence(F.lit(1), F.size("equal") - window + 1), lambda s: add(F.slice(F.col("equal"), s, window))))
    best = F.when(F.size("equal") >= window, within).otherwise(add(F.col("equal")))  # a shorter overlap fits into one window
    return (
        aligned.withColumn("equal_words", add(F.col("equal")))
        .where(F.col("equal_words") >= F.ceil(window * SIMILAR))
        .withColumn("best_window", best)
        .where(F.col("best_window") >= F.ceil(window * SIMILAR))
        .select(
            "doc_id",
            "item_id",
            (F.col("diagonal") + F.col("item_start")).alias("doc_start"),
            "item_start",
            F.size("equal").alias("overlap"),
            "equal_words",
            "best_window",
            "text_hash",
            "item_hash",
        )
        .distinct()
        .drop("item_hash")
    )


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return overlaps(docs, benchmark).drop("text_hash")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a verified overlap."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_hash"))
    kept = rows.join(bad, F.col("key_id").eqNullSafe(F.col("bad_id")) & (F.col("key_hash") == F.col("bad_hash")), "left_anti")
    return kept.select("row.*")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
b AS (SELECT row_number() OVER () AS j, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
dp AS (SELECT i, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
bp AS (SELECT j, unnest(w) AS word, unnest(range(len(w))) AS q, len(w) AS size FROM b WHERE len(w) >= {LEAST}),
g AS (SELECT i, j, p - q AS g FROM dp JOIN bp USING (word) GROUP BY i, j, p - q, size HAVING count(*) >= ceil(least({WINDOW}, size) * {SIMILAR})),
sides AS (SELECT i, j, doc_id, item_id, g, greatest(-g, 0) AS s, least(len(b.w), len(d.w) - g) - greatest(-g, 0) AS n, d.w AS dw, b.w AS bw
  FROM g JOIN d USING (i) JOIN b USING (j)),
e AS (SELECT *, least({WINDOW}, len(bw)) AS width,
  list_transform(range(n), lambda x: CASE WHEN dw[g + s + x + 1] = bw[s + x + 1] THEN 1 ELSE 0 END) AS eq FROM sides),
f AS (SELECT *, CASE WHEN n < width THEN list_sum(eq)
  ELSE list_max(list_transform(range(1, n - width + 2), lambda x: list_sum(eq[x:x + width - 1]))) END AS best FROM e)
SELECT doc_id, item_id, CAST(g + s AS INTEGER) AS doc_start, CAST(s AS INTEGER) AS item_start, CAST(n AS INTEGER) AS overlap,
  CAST(list_sum(eq) AS INTEGER) AS equal_words, CAST(best AS INTEGER) AS best_window
FROM f WHERE best >= ceil(width * {SIMILAR})"""
