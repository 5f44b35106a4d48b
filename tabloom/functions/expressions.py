"""Column expressions: validity, hashing order, dates, bins, scores. All stay inside the JVM."""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")

# Texts read as missing.
MISSING_TOKENS = ("", "NA", "NaN")


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def is_valid(column: Column | str) -> Column:
    """Neither null nor NaN."""
    c = as_column(column)
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def valid_or_null(column: Column | str) -> Column:
    """The value as a double, with NaN turned into null so that aggregates skip it."""
    c = as_column(column).cast("double")
    return F.when(~F.isnan(c), c)


def order_key(seed: int, *ids: Column | str) -> Column:
    """A pseudo-random but reproducible sort key: md5 of the seed and the row's key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[as_column(i).cast("string") for i in ids]))


def derived_seed(seed: int, purpose: str) -> int:
    """A seed of its own for a nested split, so that splits within splits stay independent."""
    return zlib.crc32(f"{purpose}:{seed}".encode())


def uniform_hash(seed: int, *ids: Column | str) -> Column:
    """A reproducible number in [0, 1) per row and seed."""
    head = F.conv(F.substring(order_key(seed, *ids), 1, 8), 16, 10).cast("double")
    return head / F.lit(float(2**32))


def parse_date(column: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first layout that parses wins; null when none does.

    A layout is tried only on texts of its shape, since a failed parse is far dearer than a
    pattern test. Months and days may have one or two digits.
    """
    text = as_column(column).cast("string")
    tries = []
    for f in formats:
        shape = "^" + f.replace("yyyy", r"\d{4}").replace("MM", r"\d{1,2}").replace("dd", r"\d{1,2}") + "$"
        loose = f.replace("MM", "M").replace("dd", "d")
        tries.append(F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(loose)).cast("date")))
    return F.coalesce(*tries)


def missing_to_null(column: Column | str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    c = as_column(column)
    return F.when(~F.trim(c).isin(*tokens), c)


def log_popularity(column: Column | str) -> Column:
    """log10(v + 1)."""
    return F.log10(as_column(column).cast("double") + F.lit(1.0))


def equal_width_bin(column: Column | str, low: Column, high: Column, bins: int) -> Column:
    """Zero-based bin of a value in [low, high]; the last bin is closed, a single value goes to bin 0."""
    v = as_column(column)
    position = F.floor((v - low) / (high - low) * F.lit(float(bins))).cast("int")
    return F.when(high > low, F.least(position, F.lit(bins - 1))).otherwise(F.lit(0))


def half_even(value: float) -> int:
    """Round to the nearest integer, halves to even."""
    floor = math.floor(value)
    rest = value - floor
    if rest > 0.5 or (rest == 0.5 and floor % 2 == 1):
        return floor + 1
    return floor


def argmax_index(scores: Column | str) -> Column:
    """Zero-based index of the largest entry of an array column, the first one on ties."""
    s = as_column(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def score_to_class(scores: Sequence[Column | str], threshold: float = 0.5) -> Column:
    """One score column: 1 when it reaches the threshold. Several: index of the largest."""
    if len(scores) == 2:
        raise ValueError("two score columns are ambiguous; pass one column or at least three")
    if len(scores) == 1:
        return (as_column(scores[0]) >= F.lit(threshold)).cast("int")
    return argmax_index(F.array(*[as_column(s).cast("double") for s in scores]))


def last_token(column: Column | str, separator: str = "_") -> Column:
    return F.element_at(F.split(as_column(column), separator), -1)


def group_title(column: Column | str) -> Column:
    """Underscores to blanks, first letters upper case."""
    return F.initcap(F.replace(as_column(column), F.lit("_"), F.lit(" ")))
