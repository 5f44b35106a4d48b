"""Secret scans over a trigram inverted index.

From the regular expression of each rule follows a Boolean query over trigrams that every match must hold: the
parts of a sequence are joined by AND, branches by OR, and what is optional or a class adds nothing. The index
posts, for the trigrams that occur in any query, the rows that hold them. Intersecting postings gives each
rule's candidate rows; only these are searched with the rule's pattern. A rule whose query is empty (a
class run has no mandatory trigram) scans every row.

Trigrams are taken from the text with ASCII letters lowered, so that rules in either case share them.

Edge cases: a null text is an empty one; a text without spans has an empty string and the hash of the empty
text; repeated rows stay rows; an empty table gives no rows. Only doc_id and text are read, so extra columns
cannot clash.
"""

from __future__ import annotations

import re._constants as C
import re._parser as P
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import digest, small_table, spans, written


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # the same meaning in Python and Java
    base: bool = False
    value_least: int = 0  # the last group must be that long
    length_least: int = 0  # the match must be that long


# The base rules, in the order in which their kinds are listed, then well-known key formats.
RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, value_least=6),
    Rule("access", r"AKIA[A-Z0-9]+", True, length_least=20),
    Rule("hex", r"[0-9a-f]{24,}", True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

# A query is a tuple of clauses, all of which must hold; a clause is a set of alternatives, each a set of
# trigrams that must all be there.
Query = tuple[frozenset[frozenset[str]], ...]


def trigrams(text: str) -> frozenset[str]:
    text = text.lower()
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _choices(parsed) -> list[list[str | None]]:
    """The expression as alternatives of literal runs; None stands where anything may come."""
    out: list[list[str | None]] = [[""]]

    def add(alternatives: list[list[str | None]]) -> None:
        nonlocal out
        joined = []
        for left in out:
            for right in alternatives:
                first = right[0]
                head = left[:-1] + [left[-1] + first] if left and left[-1] is not None and first is not None else left + [first]
                joined.append(head + right[1:])
        out = joined

    for code, value in parsed:
        if code is C.LITERAL:
            add([[chr(value)]])
        elif code is C.SUBPATTERN:
            add(_choices(value[3]))
        elif code is C.BRANCH:
            add([a for branch in value[1] for a in _choices(branch)])
        elif code in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] >= 1:
            add([a + ([None] if value[1] != 1 else []) for a in _choices(value[2])])
        elif code in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] == 1:
            add([[""]] + _choices(value[2]))
        elif code is not C.AT:
            add([[None]])
    return out


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Alternatives of trigram sets that a text with a match must hold one of; empty when some match needs none."""
    alternatives = set()
    for runs in _choices(P.parse(pattern)):
        needed = frozenset(t for run in runs if run for t in trigrams(run))
        if not needed:
            return frozenset()
        alternatives.add(needed)
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """id, hash and the ``rules`` (numbers) whose trigram query the row's text meets."""
    queries = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    vocabulary = sorted({t for q in queries.values() for a in q for t in a})
    lowered = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.col("lowered").contains(t), F.lit(n)) for n, t in enumerate(vocabulary)]))
    index = written(
        texts.select("id", "hash", lowered.alias("lowered")).select("id", "hash", F.explode(held).alias("trigram")).distinct(), "trigram-index"
    )
    rows = [
        {"rule": n, "alternative": i, "trigram": vocabulary.index(t), "needed": len(a)}
        for n, q in queries.items()
        for i, a in enumerate(sorted(q, key=sorted))
        for t in a
    ]
    terms = F.broadcast(small_table(texts.sparkSession, rows, "rule int, alternative int, trigram int, needed int"))
    met = index.join(terms, "trigram").groupBy("id", "hash", "rule", "alternative", "needed").count().where(F.col("count") == F.col("needed"))
    return met.groupBy("id", "hash").agg(F.collect_set("rule").alias("rules"))


def matches(text: Column, rule: Rule) -> Column:
    """Structs (kind, start, end) of a rule's matches that are long enough."""
    found = spans(text, rule.pattern)
    if rule.value_least:
        values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(2))
        found = F.transform(F.arrays_zip(found.alias("s"), values.alias("v")), lambda z: F.struct(z["s"]["start"].alias("start"), z["s"]["end"].alias("end"), z["v"].alias("match")))
        found = F.filter(found, lambda s: F.char_length(s["match"]) >= rule.value_least)
    if rule.length_least:
        found = F.filter(found, lambda s: s["end"] - s["start"] >= rule.length_least)
    return F.transform(found, lambda s: F.struct(F.lit(rule.kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The contract's columns, and n_added."""
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chosen = candidates(texts, rules).select(F.col("id").alias("found_id"), F.col("hash").alias("found_hash"), "rules")
    rows = texts.join(chosen, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("hash") == F.col("found_hash")), "left")
    nothing = F.array().cast("array<struct<kind: string, start: int, end: int>>")

    def of(number: int, rule: Rule) -> Column:
        found = matches(F.col("text"), rule)
        return F.when(F.array_contains("rules", number), found).otherwise(nothing) if trigram_query(rule.pattern) else found

    found = rows.select("id", *[of(n, r).alias(r.kind) for n, r in enumerate(rules)])
    found = written(found, "secret-spans")
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def in_order(columns: list[str]) -> Column:
        keyed = F.transform(
            F.concat(*columns), lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("number"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
        return F.array_sort(keyed)

    base, others = [r.kind for r in rules if r.base], [r.kind for r in rules if not r.base]
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(digest(in_order(base)), 256).alias("base_sha256"),
        digest(in_order(base + others)).alias("spans"),
        sum((F.size(k) for k in others), F.lit(0)).cast("long").alias("n_added"),
    )
