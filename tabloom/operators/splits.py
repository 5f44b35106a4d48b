"""Exact, reproducible hold-out and fold assignment by a key column.

Every split is a new column; sizes are exact when the key is unique, and rows that share a
key always land on the same side. Tables are scanned, not shuffled (see ``ranks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import half_even, order_key
from tabloom.operators.ranks import RANK_LIMIT, cut_keys, cuts_passed, even_cuts, stratum_cuts_passed


def _listed(ids: str | Sequence[str]) -> list[str]:
    return [ids] if isinstance(ids, str) else list(ids)


def holdout(
    df: DataFrame,
    ids: str | Sequence[str],
    test: float,
    seed: int = 0,
    name: str = "split",
    rank_limit: int = RANK_LIMIT,
) -> DataFrame:
    """Mark exactly round(N * test) rows as ``test`` and the rest as ``train``."""
    if not 0 <= test <= 1:
        raise ValueError("the test share must lie in [0, 1]")
    ids = _listed(ids)
    cuts = cut_keys(df, ids, seed, lambda n: [half_even(n * test)], rank_limit=rank_limit)
    marked = cuts_passed(df, ids, seed, cuts, name="_passed")
    return marked.withColumn(name, F.when(F.col("_passed") == 0, "test").otherwise("train")).drop("_passed")


def holdout3(
    df: DataFrame,
    ids: str | Sequence[str],
    validation: float,
    test: float,
    seed: int = 0,
    name: str = "split",
    rank_limit: int = RANK_LIMIT,
) -> DataFrame:
    """Mark rows as ``test``, ``validation`` or ``train`` with exact sizes."""
    share = validation + test
    if not share < 1:
        raise ValueError("validation and test shares must sum to less than 1")

    def ranks(n: int) -> list[int]:
        held = half_even(n * share)
        return [half_even(held * (1 - validation / share)) if share else 0, held]

    ids = _listed(ids)
    marked = cuts_passed(df, ids, seed, cut_keys(df, ids, seed, ranks, rank_limit=rank_limit), name="_passed")
    side = F.when(F.col("_passed") == 0, "test").when(F.col("_passed") == 1, "validation").otherwise("train")
    return marked.withColumn(name, side).drop("_passed")


def kfold(
    df: DataFrame,
    ids: str | Sequence[str],
    k: int,
    seed: int = 0,
    strata: Sequence[Column | str] = (),
    name: str = "fold",
    rank_limit: int = RANK_LIMIT,
) -> DataFrame:
    """Folds 1..k whose sizes differ by at most one, within every stratum when given."""
    if k < 1:
        raise ValueError("k must be at least 1")

    ids = _listed(ids)
    if strata:
        marked = stratum_cuts_passed(df, ids, seed, even_cuts(df, ids, seed, k, strata, rank_limit), strata, "_passed")
    else:
        cuts = cut_keys(df, ids, seed, lambda n: [i * (n // k) + min(i, n % k) for i in range(1, k)], rank_limit)
        marked = cuts_passed(df, ids, seed, cuts, "_passed")
    return marked.withColumn(name, F.col("_passed") + 1).drop("_passed")


def stratified_kfold(df, ids, label, k, seed: int = 0, name: str = "fold", rank_limit: int = RANK_LIMIT) -> DataFrame:
    """``kfold`` within every label value: Boolean, one-hot columns (a list) or any labels."""
    return kfold(df, ids, k, seed, label if isinstance(label, (list, tuple)) else [label], name, rank_limit)


def sample_rows(
    df: DataFrame, ids: str | Sequence[str], n: int, seed: int = 0, rank_limit: int = RANK_LIMIT
) -> DataFrame:
    """A reproducible sample of exactly ``n`` rows, or all rows when there are fewer."""
    ids = _listed(ids)
    cuts = cut_keys(df, ids, seed, lambda size: [min(n, size)], rank_limit=rank_limit)
    last = cuts.get("", [""])[0]
    return df.where(order_key(seed, *ids) <= F.lit(last))


def sample_columns(columns: Sequence[str], n: int, seed: int = 0) -> list[str]:
    """At most ``n`` column names, chosen by a hash of the name, in their original order."""
    import hashlib

    chosen = set(sorted(columns, key=lambda c: hashlib.md5(f"{seed}:{c}".encode()).hexdigest())[:n])
    return [c for c in columns if c in chosen]


def ordered_slice(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order (top-n per task, then one merge of n rows)."""
    return df.orderBy(*keys).limit(n)


def split_problems(df: DataFrame, ids: str | Sequence[str], name: str, allowed: Sequence) -> DataFrame:
    """Keys that sit on two sides of a split or have a side that is not allowed; empty when sound."""
    ids = _listed(ids)
    return (
        df.groupBy(*ids)
        .agg(
            F.count_distinct(name).alias("sides"),
            F.count_if(F.col(name).isNull() | ~F.col(name).isin(*allowed)).alias("outside"),
        )
        .where((F.col("sides") > 1) | (F.col("outside") > 0))
    )
