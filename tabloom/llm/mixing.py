"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source, its records in a hashed order, form one stream that is cut into blocks. A
source's quota is an exact number of words: whole passes over its stream, then a permuted sequence
of its blocks, the last one in part. A binary tree over the output shards splits all sources' quotas
at once: at each node one multivariate-hypergeometric draw decides what its left half gets. Every
shard then owns disjoint ranges of each source's permuted sequence, and is shuffled on its own. Beyond ``MAX_SOURCES`` sources the same quotas are made in a table of sources, and the
draws for the shards are made in hashed groups of sources, each with even shares of its draws.

Edge cases: a null source is a source of its own, ordered last; a null or empty text has no words and
takes none; repeated rows are records of their own; no words at all gives targets of 0; an empty table
gives no rows. Only doc_id, text and source are read, so extra columns cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import small_table, written

WEIGHTS = (1, 2, 3)
MOST = 3  # a target stops at this many times its source
BLOCKS = 512  # at most, for each source
BUCKETS = 1024  # a source's stream is laid out in so many hashed pieces, each ordered by itself
MAX_SOURCES = 10_000  # quotas of that many sources are made on the driver, those of more in a table
PIECES = "array<struct<i: bigint, low: bigint, high: bigint, upto: bigint, place: int>>"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


@dataclass
class Plan:
    """Quotas of one source: words in its stream and block, its target, passes and words beyond them."""

    words: int
    target: float
    quota: int
    block: int

    @property
    def blocks(self) -> int:
        return -(-self.words // self.block) if self.words else 0


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[float]:
    """Shares of all words by weight, none above ``most`` times its size; the excess goes to the rest by weight."""
    fixed: dict[int, float] = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, weight = sum(sizes) - sum(fixed.values()), sum(weights[i] for i in free)
        share = {i: left * weights[i] / weight for i in free}
        above = [i for i in free if share[i] > most * sizes[i]]
        if not above:
            return [fixed.get(i, share.get(i, 0.0)) for i in range(len(sizes))]
        fixed |= {i: float(most * sizes[i]) for i in above}


def split_tree(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Draws of every source (columns) for every shard (rows): exact column sums, row sums at most one apart."""
    generator = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    nodes = [(0, shards, np.array(quotas, dtype=np.int64))]
    while nodes:
        low, high, colours = nodes.pop()
        if high - low == 1:
            out[low] = colours
            continue
        middle, total = (low + high) // 2, int(colours.sum())
        whole, rest = divmod(total, high - low)
        left = whole * (middle - low) + min(rest, middle - low)
        drawn = generator.multivariate_hypergeometric(colours, left, method="marginals") if total else colours
        nodes += [(low, middle, drawn), (middle, high, colours - drawn)]
    return out


def sized(docs: DataFrame, columns: list[str], seed: int) -> DataFrame:
    """The given columns with source_key, size in words, and the hash and bucket that order a source's stream."""
    text = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(SPACES))
    size = F.when(text == "", 0).otherwise(F.size(F.split(text, SPACE))).cast("long")
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    keep = F.struct(*columns).alias("row")  # under one name, so that no column of the table can clash
    return docs.select(
        keep, key.alias("source_key"), size.alias("size"), mark.alias("mark"), F.pmod(mark, F.lit(BUCKETS)).cast("int").alias("bucket")
    )


def laid_out(records: DataFrame, counted: DataFrame) -> DataFrame:
    """Adds ``first``: the place of a record's first word in its source's stream.

    ``counted`` has the same rows as ``records``, narrow ones. Equal rows change places freely.
    """
    in_bucket = Window.partitionBy("source_key", "bucket").orderBy("mark", F.col("row.doc_id")).rowsBetween(Window.unboundedPreceding, -1)
    by_bucket = counted.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.select("source_key", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_first"))
    return (
        records.withColumn("in_bucket", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
        .join(starts, ["source_key", "bucket"])
        .withColumn("first", F.col("bucket_first") + F.col("in_bucket"))
        .drop("bucket_first", "in_bucket", "bucket")
    )


def plans(records: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, blocks: int = BLOCKS) -> dict[str, Plan]:
    """The quota of every source, sources by code point with the null source last."""
    found = records.groupBy("source_key").agg(F.sum("size").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them before mixing")
    words = {r["source_key"]: r["words"] for r in found}
    keys = sorted(words, key=lambda k: (k[0] == "n", k.encode("utf-32-be")))
    goals = targets([words[k] for k in keys], [weights[i % len(weights)] for i in range(len(keys))], most)
    return {
        k: Plan(words[k], goal, min(round(goal), most * words[k]), max(1, -(-words[k] // blocks))) for k, goal in zip(keys, goals)
    }


def block_draws(spark, plan: dict[str, Plan], shards: int, seed: int) -> DataFrame:
    """A row for each source: its totals and ``extra``, by block, how many of its first words the last pass takes.

    ``part`` has, by block, the shard that draws it in that pass (-1: none does).
    """
    rows = []
    for k, p in plan.items():
        rows.append({"source_key": k, "words": p.words, "target": p.target, "block": p.block, "passes": p.quota // max(p.words, 1), "rest": p.quota % max(p.words, 1), "blocks": p.blocks})
    base = small_table(spark, rows, "source_key string, words bigint, target double, block bigint, passes int, rest bigint, blocks int")
    # the splitting tree deals out whole draws: all passes over all blocks, then the blocks of the last pass
    keys = list(plan)
    draws = [plan[k].blocks * (plan[k].quota // max(plan[k].words, 1)) + -(-(plan[k].quota % max(plan[k].words, 1)) // plan[k].block) for k in keys]
    cuts = np.cumsum(split_tree(draws, shards, seed), axis=0).T
    bounds = small_table(
        spark, [{"source_key": k, "cuts": [int(c) for c in row]} for k, row in zip(keys, cuts)], "source_key string, cuts array<bigint>"
    )
    return with_draws(base, seed).join(bounds, "source_key")


def with_draws(base: DataFrame, seed: int) -> DataFrame:
    """Adds ``draws`` to rows of sources: by block, what the last pass takes and its place in the permuted order."""
    each = base.withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0)))))
    length = F.least(F.col("block"), F.greatest(F.col("words") - F.col("i") * F.col("block"), F.lit(0)))
    permuted = Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(seed), "source_key", "i"), "i").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("length", length).withColumn("ahead", F.coalesce(F.sum("length").over(permuted), F.lit(0)))
    taken = F.greatest(F.lit(0), F.least(F.col("rest") - F.col("ahead"), F.col("length"))).cast("bigint")
    place = F.row_number().over(Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(seed), "source_key", "i"), "i")) - 1
    each = each.withColumn("taken", taken).withColumn("place", place)
    return each.groupBy("source_key", "words", "target", "block", "passes", "blocks").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "taken", "place"))), lambda s: F.struct(s["taken"], s["place"])).alias("draws")
    )


def many_plans(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, blocks: int = BLOCKS) -> DataFrame:
    """What ``plans`` gives, for any number of sources (source_key, words), as a written table."""
    ordered = sources.select("source_key", "words").orderBy(F.col("source_key") == "n", "source_key")
    numbered = ordered.rdd.zipWithIndex().map(lambda p: (p[0][0], p[0][1], weights[p[1] % len(weights)]))
    table = written(sources.sparkSession.createDataFrame(numbered, "source_key string, words bigint, weight int"), "mix-weights")
    limit = F.col("words") * most
    total, fixed, known = table.agg(F.sum("words")).first()[0] or 0, F.lit(False), 0
    while True:  # the rounds of targets(), one aggregation each
        taken, weight = table.agg(F.sum(F.when(fixed, limit)), F.sum(F.when(~fixed, F.col("weight")))).first()
        share = F.lit(float(total - (taken or 0))) * F.col("weight") / F.lit(float(weight))
        above = fixed | (share > limit)
        found = table.where(above).count()
        if found == known:
            break
        fixed, known = above, found
    goal = F.when(fixed, limit.cast("double")).otherwise(share)
    quota = F.least(F.bround(goal).cast("bigint"), limit)
    sized = table.select("source_key", "words", goal.alias("target"), F.greatest(F.lit(1), F.expr(f"(words + {blocks - 1}) div {blocks}")).cast("bigint").alias("block"), quota.alias("quota"))
    return written(
        sized.selectExpr(
            "source_key", "words", "target", "block", "cast(quota div greatest(words, 1) as int) passes", "quota % greatest(words, 1) rest",
            "cast((words + block - 1) div block as int) blocks",
        ),
        "mix-plans",
    )


def many_draws(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """What ``block_draws`` gives, for any number of sources; a group's shares of the shards follow those of the group before."""
    base = written(with_draws(many_plans(sources), seed), "mix-draws")
    group = F.pmod(F.xxhash64(F.lit(seed), "source_key"), F.lit(MAX_SOURCES)).cast("int")
    drawn = base.select("source_key", group.alias("group"), F.expr("blocks * cast(passes as bigint) + size(filter(draws, d -> d.taken > 0))").alias("draws"))
    shares, at = [], 0
    for g, n in sorted(tuple(x) for x in drawn.groupBy("group").agg(F.sum("draws")).collect()):  # MAX_SOURCES rows at most
        shares.append({"group": g, "parts": [(at + n + shards - 1 - k) // shards - (at + shards - 1 - k) // shards for k in range(shards)]})
        at += n
    parts = small_table(sources.sparkSession, shares, "group int, parts array<bigint>")

    def dealt(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source_key")
        colours, out = rows["draws"].to_numpy(np.int64).copy(), []
        generator = np.random.default_rng([seed, int(rows["group"].iloc[0])])
        for n in rows["parts"].iloc[0]:
            out.append(generator.multivariate_hypergeometric(colours, n, method="marginals") if n else np.zeros_like(colours))
            colours -= out[-1]
        return pd.DataFrame({"source_key": rows["source_key"].to_numpy(), "cuts": list(np.cumsum(out, axis=0).T)})

    bounds = drawn.join(F.broadcast(parts), "group").groupBy("group").applyInPandas(dealt, "source_key string, cuts array<bigint>")
    return base.join(bounds, "source_key")


def overlaps(draws: Column, block: Column, first: Column, size: Column) -> Column:
    """By block that a record's words touch: from and to within the record, and how far the last pass goes."""
    from_block, to_block = F.floor(first / block), F.floor((first + size - 1) / block)

    def piece(i: Column) -> Column:
        at = i * block
        draw = F.element_at(draws, (i + 1).cast("int"))
        low, high = F.greatest(first, at) - first, F.least(first + size, at + block) - first
        return F.struct(
            i.alias("i"),
            low.alias("low"),
            high.alias("high"),
            F.greatest(low, F.least(high, at + draw["taken"] - first)).alias("upto"),
            draw["place"].alias("place"),
        )

    return F.when(size > 0, F.transform(F.sequence(from_block, to_block), piece))


def drawn(docs: DataFrame, columns: list[str], shards: int, seed: int) -> DataFrame:
    """``row`` (the given columns, doc_id among them) of every record with its source's numbers and ``pieces``."""
    spark = docs.sparkSession
    narrow = written(sized(docs, ["doc_id"], seed), "mix-records")
    sources = written(narrow.groupBy("source_key").agg(F.sum("size").alias("words")), "mix-sources")
    if sources.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        per_source = many_draws(sources, shards, seed)
    else:
        per_source = F.broadcast(block_draws(spark, plans(sources.withColumnRenamed("words", "size")), shards, seed))  # MAX_SOURCES x BLOCKS draws at most
    records = narrow if columns == ["doc_id"] else sized(docs, columns, seed)
    joined = laid_out(records, narrow).join(per_source, "source_key")
    pieces = overlaps(F.col("draws"), F.col("block").cast("bigint"), F.col("first"), F.col("size"))
    return joined.withColumn("pieces", F.coalesce(pieces, F.array().cast(PIECES)))


def mixed(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """One row per record: doc_id, size, source_size, target, taken."""
    extra = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda total, p: total + p["upto"] - p["low"])
    return drawn(docs, ["doc_id"], shards, seed).select(
        "row.doc_id",
        "size",
        F.col("words").alias("source_size"),
        "target",
        (F.col("size") * F.col("passes") + extra).cast("long").alias("taken"),
    )


def cut(text: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
    """The words low to high (exclusive) of each text, with what stands between them."""
    out = []
    for t, a, b in zip(text, low, high):
        places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        out.append(t[places[a][0] : places[b - 1][1]])
    return pd.Series(out, dtype=object)


def mix(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of ``docs`` and ``mix_shard``, every shard in a shuffled order.

    Each pass gives a whole copy of a record. What the last pass takes of it is a copy too if it takes
    all, else a row for each run of words; its ``n_chars``, if there is such a column, follows the text.
    Records without words are in no block, and so not in the mix.
    """
    columns = docs.columns
    rows = drawn(docs, columns, shards, seed).where("size > 0")
    full = F.struct(F.lit(0).cast("bigint").alias("low"), F.col("size").alias("high"))
    place = F.element_at(F.col("pieces"), 1)["place"]
    runs = F.aggregate(
        F.filter("pieces", lambda p: p["upto"] > p["low"]),
        F.array().cast("array<struct<low: bigint, high: bigint, place: int>>"),
        lambda out, p: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["high"] == p["low"]),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1)["low"].alias("low"), p["upto"].alias("high"), F.element_at(out, -1)["place"].alias("place"))),
            ),
        ).otherwise(F.array_append(out, F.struct(p["low"].alias("low"), p["upto"].alias("high"), p["place"].alias("place")))),
    )
    passes = F.when(
        F.col("passes") > 0, F.transform(F.sequence(F.lit(0), F.col("passes") - 1), lambda j: F.struct(j.alias("epoch"), full["low"].alias("low"), full["high"].alias("high"), place.alias("place")))
    ).otherwise(F.array().cast("array<struct<epoch: int, low: bigint, high: bigint, place: int>>"))
    last = F.transform(runs, lambda r: F.struct(F.col("passes").alias("epoch"), r["low"].alias("low"), r["high"].alias("high"), r["place"].alias("place")))
    copies = rows.withColumn("copy", F.explode(F.concat(passes, last)))
    draw = F.col("copy.epoch") * F.col("blocks") + F.col("copy.place")
    shard = F.size(F.filter("cuts", lambda c: c <= draw)).cast("int")
    order = F.xxhash64(F.lit(seed), "mark", "copy.epoch", "copy.low")
    copies = copies.select("row", "size", "copy", shard.alias("mix_shard"), order.alias("mix_order"))
    whole = F.col("copy.high") - F.col("copy.low") == F.col("size")
    parts = copies.where(~whole).withColumn("piece", F.pandas_udf(cut, "string")(F.col("row.text"), F.col("copy.low"), F.col("copy.high")))
    both = copies.where(whole).withColumn("piece", F.col("row.text")).unionByName(parts)
    replaced = {"text": F.col("piece"), "n_chars": F.when(whole, F.col("row.n_chars")).otherwise(F.char_length("piece")) if "n_chars" in columns else None}
    types = dict(docs.dtypes)
    out = [(replaced.get(c) if replaced.get(c) is not None else F.col("row")[c]).cast(types[c]).alias(c) for c in columns]
    return both.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order").select(*out, "mix_shard")
