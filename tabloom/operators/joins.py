"""Key joins that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _parts(key: str, split: Mapping) -> Column:
    pieces = [F.lit(v) for k, n in split.items() for v in (k, n)]
    return F.coalesce(F.create_map(*pieces)[F.col(key)], F.lit(1)) if pieces else F.lit(1)


def join_on_key(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str | None = None,
    name: str = "track_id",
    left_columns: Sequence[str] | None = None,
    right_columns: Sequence[str] | None = None,
    split_left: Mapping | None = None,
    split_right: Mapping | None = None,
) -> DataFrame:
    """Inner join whose key comes out as text.

    Keys of one type are compared in that type and cast afterwards, which keeps bucketed
    layouts usable and moves fewer bytes; keys of different types are compared as text.
    Only the wanted columns enter the join, so both scans are pruned. The planner picks the
    strategy, and adaptive execution splits the partitions of hot keys. Where keys are known to
    be too hot for that, ``split_left`` and ``split_right`` name them with a number of parts:
    rows of such a key are dealt out by a hash of their values, and the other side's rows of
    the key are repeated once for each part.
    """
    right_key = right_key or left_key
    same = left.schema[left_key].dataType == right.schema[right_key].dataType

    def side(df: DataFrame, key: str, columns: Sequence[str] | None) -> DataFrame:
        kept = [c for c in (columns if columns is not None else df.columns) if c != key]
        return df.select((F.col(key) if same else F.col(key).cast("string")).alias(name), *kept)

    a, b = side(left, left_key, left_columns), side(right, right_key, right_columns)
    if not split_left and not split_right:
        return a.join(b, name, "inner").withColumn(name, F.col(name).cast("string"))

    def own(df: DataFrame, split: Mapping) -> Column:
        # the part follows from the row's values, so a recomputed row lands in the same part
        return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), _parts(name, split)).cast("int")

    def every(split: Mapping) -> Column:
        return F.explode(F.sequence(F.lit(0), _parts(name, split) - 1))

    split_left, split_right = split_left or {}, split_right or {}
    a = a.withColumn("_a", own(a, split_left)).withColumn("_b", every(split_right))
    b = b.withColumn("_b", own(b, split_right)).withColumn("_a", every(split_left))
    joined = a.join(b, [name, "_a", "_b"], "inner").drop("_a", "_b")
    return joined.withColumn(name, F.col(name).cast("string"))
