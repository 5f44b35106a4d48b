"""License scans as an exact set-similarity join.

Every text is a sequence of words, cut into blocks of ``BLOCK`` words that start every ``STEP`` words. A
template is a set of words with a threshold: the share of its words that a block must hold. Words are ordered
by how many documents hold them, rarest first. If a block reaches a template's threshold, their rarest words
meet: the join runs over the prefixes of both, then drops pairs by length (too few words of any template in
the block) and by position (too few words left after the first common one), and verifies the rest.

Base phrases are templates whose words must all be there; in blocks that the join finds, their places are read
off word by word. A block owns the places that begin in its first ``STEP`` words, and every phrase fits into
the rest.

Edge cases: a null text has no words; a text without words has no labels and score 0; repeated rows stay rows;
an empty table gives no rows. Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import small_table, written

BLOCK, STEP = 32, 16
THRESHOLD = 0.9
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose places are counted, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Notices in public license texts, with their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
TEMPLATES = tuple((t, label, 1.0, True) for t, label in PHRASES) + tuple((t, label, THRESHOLD, False) for t, label in NOTICES)
VOCABULARY = sorted({w for t, *_ in TEMPLATES for w in t.split()})


def words(text: Column) -> Column:
    """Words of the text with A-Z lowered.

    Lowering more letters changes no ASCII word but one: the Kelvin sign, which is kept from becoming a k.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00b0")))
    return F.split(lowered, NOT_WORD)


def word_list(text: Column) -> Column:
    """Words without the empty strings that split leaves at the two ends."""
    split = words(text)
    first = F.when(F.element_at(split, 1) == "", 2).otherwise(1)
    last = F.when(F.element_at(split, -1) == "", F.size(split) - 1).otherwise(F.size(split))
    return F.slice(split, first, F.greatest(last - first + 1, F.lit(0)))


def frequency_order(texts: DataFrame) -> list[str]:
    """Template words by the number of documents that hold them, rarest first, ties by the alphabet."""
    held = texts.select(F.explode(F.array_intersect("words", F.array(*[F.lit(w) for w in VOCABULARY]))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}  # one row per template word
    return sorted(VOCABULARY, key=lambda w: (counts.get(w, 0), w))


def needed(words_of: int, threshold: float) -> int:
    return max(1, math.ceil(words_of * threshold - 1e-9))


def scan(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("hash"), word_list(F.col("text")).alias("words"))
    order = frequency_order(texts)
    rank = {w: i for i, w in enumerate(order)}
    templates = []
    for number, (text, label, threshold, phrase) in enumerate(TEMPLATES):
        ranks = sorted({rank[w] for w in text.split()})
        least = needed(len(ranks), threshold)
        templates.append({"template": number, "label": label, "phrase": phrase, "ranks": ranks, "least": least, "text": text.split()})
    template_rows = [{**t, "prefix_rank": r, "place": i} for t in templates for i, r in enumerate(t["ranks"][: len(t["ranks"]) - t["least"] + 1])]
    prefixes = sorted({order[r["prefix_rank"]] for r in template_rows})
    shortest = min(t["least"] for t in templates)

    # blocks of documents that hold a prefix word at all, as sorted ranks of their template words
    vocabulary = F.array(*[F.lit(w) for w in order])
    some = texts.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in prefixes])))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(STEP))
    blocks = some.select("doc_id", "hash", F.explode(F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(F.col("words"), s + 1, BLOCK).alias("words")))).alias("block"))
    blocks = blocks.select("doc_id", "hash", "block.start", F.col("block.words").alias("block_words")).withColumn(
        "held", F.array_sort(F.transform(F.array_intersect("block_words", vocabulary), lambda w: F.array_position(vocabulary, w).cast("int") - 1))
    )
    blocks = blocks.where(F.size("held") >= shortest)

    # prefix join: the rarest words of the block, as many as leave fewer than the smallest need
    prefix = F.slice("held", 1, F.size("held") - shortest + 1)
    posted = blocks.select("doc_id", "hash", "start", "block_words", "held", F.posexplode(prefix).alias("block_place", "prefix_rank"))
    side = F.broadcast(
        small_table(spark, template_rows, "template int, label string, phrase boolean, ranks array<int>, least int, text array<string>, prefix_rank int, place int")
    )
    met = posted.join(side, "prefix_rank")
    # length filter, then positional filter: what can still follow the common word on either side
    met = met.where(F.size("held") >= F.col("least"))
    # each pair once, at its first common word: all common words before it would have met earlier
    pair_first = F.size(F.array_intersect(F.slice("held", 1, F.col("block_place")), F.slice("ranks", 1, F.col("place")))) == 0
    rest = F.least(F.size("held") - F.col("block_place"), F.size("ranks") - F.col("place"))
    met = met.where(rest >= F.col("least")).where(pair_first)
    common = F.size(F.array_intersect("held", "ranks"))
    found = met.withColumn("common", common).where(F.col("common") >= F.col("least"))

    # exact check of phrases, at the places that the block owns
    offsets = F.sequence(F.lit(0), F.least(F.lit(STEP), F.size("block_words") - F.size("text") + 1) - 1)
    equal = F.filter(offsets, lambda i: F.slice(F.col("block_words"), i + 1, F.size("text")) == F.col("text"))
    fits = F.size("block_words") >= F.size("text")
    places = F.when(F.col("phrase") & fits, F.transform(equal, lambda i: i + F.col("start"))).otherwise(F.array().cast("array<int>"))
    found = found.select(
        "doc_id", "hash", "label", "phrase", "start", places.alias("places"), (F.col("common") / F.size("ranks")).alias("share")
    ).where(~F.col("phrase") | (F.size("places") > 0))
    # equal rows come once for each copy, so places are counted as distinct ones
    distinct = found.select("doc_id", "hash", "label", "phrase", "share", F.explode_outer("places").alias("place")).distinct()
    place = F.col("place").cast("long")
    labels = distinct.groupBy("doc_id", "hash").agg(
        F.count("place").alias("n_base"),
        F.min(place).alias("first_word"),
        F.max(place).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    labels = labels.withColumnRenamed("doc_id", "found_id").withColumnRenamed("hash", "found_hash")
    sized = written(texts.select("doc_id", "hash", F.size("words").cast("long").alias("n_words")), "license-words")
    joined = sized.join(written(labels, "license-labels"), F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("hash") == F.col("found_hash")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce(F.array_join("base_labels", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("labels", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _oracle() -> str:
    phrases = ", ".join("(" + ", ".join([f"'{label}'", "[" + ", ".join(f"'{w}'" for w in t.split()) + "]"]) + ")" for t, label in PHRASES)
    notices = ", ".join(
        "(" + ", ".join([f"'{label}'", "[" + ", ".join(f"'{w}'" for w in sorted(set(t.split()))) + "]", str(needed(len(set(t.split())), THRESHOLD))]) + ")" for t, label in NOTICES
    )
    return rf"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases(label, t) AS (VALUES {phrases}),
notices(label, t, least) AS (VALUES {notices}),
places AS (SELECT r, label, unnest(list_filter(range(len(w) - len(t) + 1), lambda i: w[i + 1:i + len(t)] = t)) AS p FROM numbered, phrases WHERE len(w) >= len(t)),
blocks AS (SELECT r, unnest(list_transform(range(0, len(w), {STEP}), lambda s: list_distinct(w[s + 1:s + {BLOCK}]))) AS b FROM numbered),
shares AS (SELECT r, label, len(list_intersect(b, t)) / len(t) AS share FROM blocks, notices WHERE len(list_intersect(b, t)) >= least),
base AS (SELECT r, count(*) AS n, min(p) AS low, max(p) AS high, list_sort(list_distinct(list(label))) AS l FROM places GROUP BY r),
more AS (SELECT r, list(label) AS l, max(share) AS share FROM shares GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, base.low AS first_word, base.high AS last_word,
  coalesce(array_to_string(base.l, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.l, more.l))), ','), '') AS labels,
  CASE WHEN base.r IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(more.share, 0.0)::DOUBLE END AS score
FROM numbered LEFT JOIN base USING (r) LEFT JOIN more USING (r)"""


ORACLE = _oracle()
