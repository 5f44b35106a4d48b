"""Exact order statistics of a hashed row key, found by counting instead of sorting.

Rows are ordered by md5(seed, key). To split a table exactly, only the keys at a few ranks
are needed: count rows per key prefix, descend into the prefix that holds the wanted rank,
and rank the few rows left. The rows themselves are then labelled by comparing their own
key with those cut keys, so the full table is scanned but never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.expressions import as_column, order_key
from tabloom.session import driver_table, stored

FIRST_PREFIX = 2  # hex digits of the first counting pass: 256 counters per stratum
PREFIX_STEP = 3  # hex digits added by every further pass: 4,096 counters per wanted rank
RANK_LIMIT = 100_000  # rows ranked together in the last pass


def stratum_text(strata: Sequence[Column | str]) -> Column:
    """Strata columns as one text; null is a stratum of its own."""
    if not strata:
        return F.lit("")
    return F.concat_ws("\u0001", *[F.coalesce(as_column(s).cast("string"), F.lit("\u0000")) for s in strata])


def even_cuts(
    df: DataFrame, ids: Sequence[str], seed: int, parts: int, strata: Sequence[Column | str], rank_limit: int = RANK_LIMIT
) -> DataFrame:
    """``_s`` and ``_cuts``: for every stratum the last keys of the first ``parts`` - 1 of equal parts, the first ones larger by one."""
    rows = df.select(stratum_text(strata).alias("_s"), order_key(seed, *ids).alias("_k"))
    digits = FIRST_PREFIX
    counted = stored(rows.groupBy("_s", F.substring("_k", 1, digits).alias("_q")).agg(F.count("*").alias("n")), "stratum-prefixes")
    n, i = F.col("n"), F.col("_i")
    sizes = counted.groupBy("_s").agg(F.sum("n").alias("n"))
    ranks = sizes.select("_s", F.explode(F.sequence(F.lit(1), F.lit(parts - 1))).alias("_i"), "n").where(F.lit(parts > 1))
    wanted = ranks.select("_s", F.lit("").alias("_p"), "_i", (i * F.floor(n / parts) + F.least(i.cast("long"), n % parts)).alias("_r"))

    def located(counts: DataFrame, order: str) -> DataFrame:
        """Which of the ordered counts holds each wanted rank, and the rank within it."""
        upto = Window.partitionBy("_s", "_p").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ended = counts.withColumn("_end", F.sum("n").over(upto))
        return ended.join(wanted, ["_s", "_p"]).where((F.col("_end") - n < F.col("_r")) & (F.col("_r") <= F.col("_end")))

    found = located(counted.withColumn("_p", F.lit("")), "_q")
    while True:
        narrowed = found.select("_s", F.col("_q").alias("_p"), "_i", (F.col("_r") - (F.col("_end") - n)).alias("_r"), n.alias("_rows"))
        wanted = stored(narrowed, "stratum-ranks")
        inside = rows.withColumn("_p", F.substring("_k", 1, digits)).join(wanted.select("_s", "_p").distinct(), ["_s", "_p"])
        most = wanted.agg(F.max("_rows")).first()[0]
        if most is None or most <= rank_limit or digits == 32:
            break
        digits = min(digits + PREFIX_STEP, 32)
        found = located(inside.groupBy("_s", "_p", F.substring("_k", 1, digits).alias("_q")).agg(F.count("*").alias("n")), "_q")
    # rows with an equal key are one entry, so a repeated key cannot grow the window
    keys = located(inside.groupBy("_s", "_p", "_k").agg(F.count("*").alias("n")), "_k")
    cuts = keys.groupBy("_s").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_k"))), lambda c: c["_k"]).alias("_cuts"))
    return stored(cuts, "stratum-cuts")


def stratum_cuts_passed(df: DataFrame, ids: Sequence[str], seed: int, cuts: DataFrame, strata: Sequence[Column | str], name: str = "passed") -> DataFrame:
    """Add the number of its stratum's cut keys that lie before a row's own key."""
    keyed = df.withColumns({"_key": order_key(seed, *ids), "_s": stratum_text(strata)})
    passed = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<string>")), lambda c: F.col("_key") > c))
    return keyed.join(cuts, "_s", "left").withColumn(name, passed).drop("_key", "_s", "_cuts")


def cut_keys(
    df: DataFrame,
    ids: Sequence[str],
    seed: int,
    ranks_of: Callable[[int], Sequence[int]],
    rank_limit: int = RANK_LIMIT,
) -> dict[str, list[str]]:
    """The keys at the 1-based ranks that ``ranks_of(size)`` asks for, under the empty stratum.

    Rank 0 gives the empty text, which sorts before every key. The driver holds one entry per rank.
    """
    rows = df.select(F.lit("").alias("_s"), order_key(seed, *ids).alias("_k"))
    counted = rows.groupBy("_s", F.substring("_k", 1, FIRST_PREFIX).alias("_p")).agg(F.count("*").alias("n"))
    buckets: dict[str, list[tuple[str, int]]] = {}
    for r in counted.collect():
        buckets.setdefault(r["_s"], []).append((r["_p"], r["n"]))
    cuts, wanted = {}, {}
    # wanted: (stratum, position) -> (prefix, rank within the prefix, rows with the prefix)
    for stratum, listed in buckets.items():
        ranks = ranks_of(sum(n for _, n in listed))
        cuts[stratum] = [""] * len(ranks)
        for i, rank in enumerate(ranks):
            if rank > 0:
                wanted[stratum, i] = _bucket_of(rank, sorted(listed))
    if not wanted:
        return cuts
    spark = df.sparkSession
    digits = FIRST_PREFIX

    def with_prefix(length: int) -> DataFrame:
        """Rows that share a prefix with a wanted rank; the prefix table has one row per cut."""
        prefixes = sorted({(s, p) for (s, _), (p, _, _) in wanted.items()})
        table = F.broadcast(driver_table(spark, prefixes, "_s string, _p string"))
        return rows.withColumn("_p", F.substring("_k", 1, length)).join(table, ["_s", "_p"])

    def targets() -> DataFrame:
        listed = [(s, p, i, r) for (s, i), (p, r, _) in wanted.items()]
        return F.broadcast(driver_table(spark, listed, "_s string, _p string, _i int, _r bigint"))

    while True:
        longer = min(digits + PREFIX_STEP, 32)
        counts = (
            with_prefix(digits)
            .groupBy("_s", "_p", F.substring("_k", 1, longer).alias("_q"))
            .agg(F.count("*").alias("n"))
        )
        upto = Window.partitionBy("_s", "_p").orderBy("_q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        located = (
            counts.withColumn("end", F.sum("n").over(upto))
            .join(targets(), ["_s", "_p"])
            .where((F.col("end") - F.col("n") < F.col("_r")) & (F.col("_r") <= F.col("end")))
            .collect()
        )
        wanted = {(r["_s"], r["_i"]): (r["_q"], r["_r"] - (r["end"] - r["n"]), r["n"]) for r in located}
        digits = longer
        if max(n for _, _, n in wanted.values()) <= rank_limit or digits == 32:
            break

    # rows with an equal key are one entry, so a repeated key cannot grow the window
    keys = with_prefix(digits).groupBy("_s", "_p", "_k").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("_s", "_p").orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        keys.withColumn("end", F.sum("n").over(upto))
        .join(targets(), ["_s", "_p"])
        .where((F.col("end") - F.col("n") < F.col("_r")) & (F.col("_r") <= F.col("end")))
        .select("_s", "_i", "_k")
        .collect()
    )
    for r in found:
        cuts[r["_s"]][r["_i"]] = r["_k"]
    return cuts


def _bucket_of(rank: int, listed: Sequence[tuple[str, int]]) -> tuple[str, int, int]:
    """The prefix that holds a rank, the rank within it and its rows; ``listed`` is sorted."""
    before = 0
    for prefix, n in listed:
        if rank <= before + n:
            return prefix, rank - before, n
        before += n
    raise ValueError("rank beyond the rows")


def cuts_passed(df: DataFrame, ids: Sequence[str], seed: int, cuts: dict[str, list[str]], name: str = "passed") -> DataFrame:
    """Add the number of cut keys that lie before a row's own key."""
    keyed = df.withColumn("_key", order_key(seed, *ids))
    passed = sum(((F.col("_key") > F.lit(c)).cast("int") for c in cuts.get("", [])), F.lit(0))
    return keyed.withColumn(name, passed).drop("_key")
