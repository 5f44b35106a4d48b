"""Sharding over fixed virtual slots.

A record is hashed into one of a few thousand slots. Bytes are added up per slot, and a versioned
map says which shard owns a slot. Rebalancing edits the map: it moves the fewest, best-fitting slots
from heavy to light shards and stores the result as the next version; records are never rehashed.

A slot is a hash of id and text, so repeated rows would pile up in one. Pairs of id and text that hold more than a
quarter of a mean slot's bytes, at most four times as many as there are slots, are spread over all slots by a hash of
the row's number as well. Only narrow rows are numbered within their slots; whole rows are joined to their numbers.

Edge cases: a null text counts one byte, like an empty one, and its checksum is 0; a null id is
hashed by its text; repeated rows share a slot unless they are many, and get positions of their own; an empty table
gives no rows. Result columns whose names the given columns have already get underscores behind them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import small_table, written
from tabloom.session import shared_folder

SLOTS = 4096  # fixed for the life of a corpus; also the size of every table that the driver sees


def initial_map(slots: int, shards: int) -> dict[int, int]:
    """Version 1: equal contiguous ranges of slots."""
    return {slot: slot * shards // slots for slot in range(slots)}


def rebalanced(owner: Mapping[int, int], sizes: Mapping[int, int], shards: int) -> dict[int, int]:
    """The next version of a map.

    Again and again the heaviest shard gives the lightest the slot that comes closest to half of
    what lies between them, until no single move brings the two nearer.
    """
    owner = dict(owner)
    loads, held = [0] * shards, [dict() for _ in range(shards)]
    for slot, shard in owner.items():
        if sizes.get(slot):
            loads[shard] += sizes[slot]
            held[shard][slot] = sizes[slot]
    while True:
        heavy = max(range(shards), key=lambda s: (loads[s], -s))
        light = min(range(shards), key=lambda s: (loads[s], s))
        gap = loads[heavy] - loads[light]
        movable = [(abs(2 * size - gap), slot) for slot, size in held[heavy].items() if size < gap]
        if not movable:
            return owner
        slot = min(movable)[1]
        size = held[heavy].pop(slot)
        held[light][slot] = size
        loads[heavy] -= size
        loads[light] += size
        owner[slot] = light


def measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``row`` (the given columns) with size, text_crc32, the hash of id and text, and the row's number."""
    return docs.select(
        F.struct(*columns).alias("row"),
        F.col("doc_id").alias("id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("hash"),
        F.monotonically_increasing_id().alias("number"),
    )


def in_slots(records: DataFrame, slots: int) -> DataFrame:
    """Narrow records with their virtual slots: id, size, text_crc32, number, virtual_slot."""
    total = records.agg(F.sum("size")).first()[0] or 0
    by_hash = records.groupBy(F.col("hash").alias("heavy")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # each has its share of all bytes, so there are at most 4 * slots of them
    heavy = by_hash.where((F.col("bytes") > total / (4 * slots)) & (F.col("rows") > 1)).select("heavy")
    hashed = F.when(F.col("heavy").isNull(), F.col("hash")).otherwise(F.xxhash64("hash", "number"))
    found = records.join(F.broadcast(heavy), F.col("hash") == F.col("heavy"), "left")
    return found.select("id", "size", "text_crc32", "number", F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot"))


def assign(
    docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """``row`` (doc_id, or the given columns) with size, text_crc32, shard, slot, virtual_slot, map_version.

    ``slot`` is the record's position in its shard, gapless from 0. The map goes to ``map_path``
    (the shared folder by default) as rows (version, slot, shard); if versions are there already,
    the latest is the one that is edited.
    """
    spark = docs.sparkSession
    base = written(measured(docs, columns or ["doc_id"]), "shard-records")
    records = written(in_slots(base, slots), "shard-slots")
    stats = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    sizes = {r["virtual_slot"]: r["bytes"] for r in stats}
    counts = {r["virtual_slot"]: r["rows"] for r in stats}

    path = map_path or shared_folder(spark, "slot-map")
    version, owner = latest_map(spark, path) if map_path else (0, {})
    if not owner:
        version, owner = 1, initial_map(slots, shards)
        store_map(spark, path, version, owner)
    edited = rebalanced(owner, sizes, shards)
    if edited != owner:
        version, owner = version + 1, edited
        store_map(spark, path, version, owner)

    ahead, rows = [0] * shards, []
    for slot in sorted(owner):
        rows.append({"virtual_slot": slot, "shard": owner[slot], "first": ahead[owner[slot]]})
        ahead[owner[slot]] += counts.get(slot, 0)
    owners = F.broadcast(small_table(spark, rows, "virtual_slot int, shard int, first bigint"))  # one row per slot
    in_slot = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size", "number")
    placed = records.withColumn("place", F.row_number().over(in_slot) - 1).join(owners, "virtual_slot")
    results = [
        "size",
        "text_crc32",
        "shard",
        (F.col("first") + F.col("place")).cast("long").alias("slot"),
        "virtual_slot",
        F.lit(version).alias("map_version"),
    ]
    if columns is None:
        return placed.select(F.struct(F.col("id").alias("doc_id")).alias("row"), *results)
    return base.select("row", "number").join(placed.select("number", *results), "number").drop("number")


def store_map(spark, path: str, version: int, owner: Mapping[int, int]) -> None:
    rows = [{"version": version, "slot": slot, "shard": shard} for slot, shard in sorted(owner.items())]
    small_table(spark, rows, "version int, slot int, shard int").write.mode("append").parquet(path)


def latest_map(spark, path: str) -> tuple[int, dict[int, int]]:
    """The newest version in a map table, or (0, {}) when there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return 0, {}
    stored = spark.read.parquet(path)
    last = stored.agg(F.max("version")).first()[0]
    return last, {r["slot"]: r["shard"] for r in stored.where(F.col("version") == last).collect()}


RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version")


def sharded(docs: DataFrame, shards: int = 16, columns: list[str] | None = None) -> DataFrame:
    """The contract's columns: doc_id, or the given columns, and the results under free names."""
    placed = assign(docs, shards, columns=columns).withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
    taken, renamed = [c.lower() for c in columns or ["doc_id"]], []
    for name in RESULT:
        free = name
        while free.lower() in taken:  # column names are compared without case
            free += "_"
        taken.append(free)
        renamed.append(F.col(name).alias(free))
    return placed.select(*[F.col("row")[c].alias(c) for c in columns or ["doc_id"]], *renamed)
