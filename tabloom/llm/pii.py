"""Personal data by weak supervision.

Strict patterns give the base spans. Looser patterns of each kind give further candidates, and three labelers
vote on every candidate, strict or loose: a pattern labeler (the strict form and its arithmetic), a gazetteer
labeler (known domain endings, first octets, issuer digits and calling codes) and a context labeler (cue words
around the span). Expectation maximisation with one hidden class per kind estimates how reliable each labeler
is, from counts of vote patterns over all documents. The posteriors train a logistic span classifier on the
votes and the shape of the span. Loose candidates that it accepts are added; base spans always stay.

Only counts of patterns reach the driver; their number is bounded by the product of the vote and shape values
(``PATTERNS``), however many documents there are.

Edge cases: a null text is an empty one; a text without spans has empty strings and the hash of the empty
text; added spans never overlap other spans; repeated rows stay rows; without candidates the classifier adds
nothing; an empty table gives no rows. Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import digest, spans, written

KINDS = ("email", "ip", "card", "phone")
VOTES = ("pattern", "gazetteer", "context")
SHAPES = 4
PATTERNS = len(KINDS) * 3 ** len(VOTES) * SHAPES * 2  # at most so many rows on the driver
ACCEPT = 0.9
ROUNDS = 40
AROUND = 40

# The strict patterns. Starts that could only fail again are skipped by look-behinds.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Looser forms of the same kinds.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+@-])[a-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)|\{at\}) ?[a-z0-9-]{1,63}+ ?(?:(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[a-z0-9-]{2,63}+){1,4}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}+[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}+(?![ -]?[0-9])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{2,4}\) ?|0?[0-9]{2,3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
# Gazetteers. Endings of domains, issuer digits of cards, calling codes.
ENDINGS = "com org net edu gov io info biz de fr es uk eu us ca au ch at nl it pl"
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 62 63 64 65 66 81 82 86 90 91 351 352 353 358 380 420 971 972"
ISSUERS = "34 37 4 51 52 53 54 55 6011 65"
# Cue words near a span, and words that speak against it.
CUES = {
    "email": "mail email e-mail contact contacto kontakt courriel correo",
    "ip": "ip host server address addr login client",
    "card": "card visa mastercard amex credit payment karte carte tarjeta",
    "phone": "phone tel call fax mobile cell telefon telefono telephone",
}
AGAINST = {
    "email": "", "ip": "version release section chapter", "card": "isbn order invoice tracking part", "phone": "isbn order invoice part page",
}


def _one_of(words: str) -> str:
    return "(?:" + "|".join(words.split()) + ")"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _votes(kind: str, strict: bool, s: Column) -> dict[str, Column]:
    """1 for, -1 against, 0 none, by labeler; and the shape of the span."""
    match, digits = s["match"], _digits(s["match"])
    near = F.lower(F.concat(s["before"], F.lit(" "), s["after"]))
    cue = near.rlike(rf"(?<![a-z]){_one_of(CUES[kind])}(?![a-z])")
    against = near.rlike(rf"(?<![a-z]){_one_of(AGAINST[kind])}(?![a-z])") if AGAINST[kind] else F.lit(False)
    if kind == "email":
        known = F.lower(match).rlike(rf"[.)\]}}] ?{_one_of(ENDINGS)}$")
        shape = F.when(match.rlike("[0-9]"), 1).otherwise(0) + F.when(F.length(match) > 20, 2).otherwise(0)
    elif kind == "ip":
        known = match.rlike(r"^(?!0\.|255\.|0+:)[0-9A-Fa-f]")
        shape = F.when(match.contains(":"), 2).otherwise(0) + F.when(F.length(match) > 11, 1).otherwise(0)
    elif kind == "card":
        known = digits.rlike(rf"^{_one_of(ISSUERS)}")
        shape = F.when(match.rlike("[ -]"), 1).otherwise(0) + F.when(F.length(digits) < 16, 2).otherwise(0)
    else:
        known = match.startswith("+") & digits.rlike(rf"^{_one_of(CODES)}") | match.rlike(r"^\(?0?[2-9]")
        shape = F.when(match.startswith("+"), 1).otherwise(0) + F.when(match.contains("("), 2).otherwise(0)
    arithmetic = F.call_function("luhn_check", digits) if kind == "card" else F.lit(strict)
    return {
        "pattern": F.when(arithmetic, 1).otherwise(-1 if kind == "card" else 0),
        "gazetteer": F.when(known, 1).otherwise(-1),
        "context": F.when(against, -1).when(cue, 1).otherwise(0),
        "shape": shape,
    }


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and, for every row, ``base`` (spans by kind, then start) and ``loose`` (others), each with its votes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    gates = {"email": text.contains("@"), "ip": text.contains("."), "card": F.lit(True), "phone": text.contains("+")}

    def of(kind: str, strict: bool) -> Column:
        if strict:
            found = F.filter(spans(text, STRICT[kind], gates[kind], AROUND), lambda s: _valid(kind, s["match"]))
        else:
            found = spans(text, LOOSE[kind], {"email": text.rlike(r"(?i)[\[({]at[\])}]"), "ip": text.contains(":")}.get(kind, F.lit(True)), AROUND)

        def packed(s: Column) -> Column:
            votes = [v.cast("int").alias(n) for n, v in _votes(kind, strict, s).items()]
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(strict).alias("strict"), *votes)

        return F.transform(found, packed)

    return docs.select("doc_id", *[of(k, strict).alias(f"{k}_{int(strict)}") for k in KINDS for strict in (True, False)]).select(
        "doc_id", F.concat(*[f"{k}_1" for k in KINDS]).alias("base"), F.concat(*[f"{k}_0" for k in KINDS]).alias("loose")
    )


FREE = "array<struct<start: int, end: int, kind: string, strict: boolean, pattern: int, gazetteer: int, context: int, shape: int>>"


def disjoint(base: Column, loose: Column) -> Column:
    """Loose spans, by start, that touch no base span and no loose span taken before them.

    Two sweeps over all spans in order: backwards, a loose span must end before the next base span
    starts; forwards, it must start where the last span that counts has ended, or later.
    """
    packed = F.transform(
        F.concat(base, loose), lambda s: F.struct(*[s[n].alias(n) for n in ("start", "end", "kind", "strict", *VOTES, "shape")])
    )
    none = F.array().cast(FREE)

    def before(state: Column, s: Column) -> Column:
        keep = s["strict"] | (s["end"] <= state["next"])
        return F.struct(
            F.when(s["strict"], F.least(state["next"], s["start"])).otherwise(state["next"]).alias("next"),
            F.when(keep, F.array_append(state["out"], s)).otherwise(state["out"]).alias("out"),
        )

    def after(state: Column, s: Column) -> Column:
        taken = ~s["strict"] & (s["start"] >= state["last"])
        return F.struct(
            F.when(s["strict"] | taken, F.greatest(state["last"], s["end"])).otherwise(state["last"]).alias("last"),
            F.when(taken, F.array_append(state["out"], s)).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(2**31 - 1).alias("next"), none.alias("out"))
    clear = F.aggregate(F.reverse(F.array_sort(packed)), start, before, lambda s: F.reverse(s["out"]))
    return F.aggregate(clear, F.struct(F.lit(0).alias("last"), none.alias("out")), after, lambda s: s["out"])


def reliabilities(counts: dict[tuple, int]) -> dict[tuple, float]:
    """Posterior of being personal data for every pattern (kind, pattern, gazetteer, context, shape, strict).

    One hidden class per kind, labelers independent given it, starting from their majority.
    """
    out = {}
    for kind in KINDS:
        mine = {k: n for k, n in counts.items() if k[0] == kind}
        posterior = {k: (0.9 if sum(k[1:4]) > 0 else 0.1 if sum(k[1:4]) < 0 else 0.5) for k in mine}
        for _ in range(ROUNDS):
            mass = [1.0, 1.0]
            seen = [[defaultdict(lambda: 0.5) for _ in VOTES] for _ in range(2)]
            for k, n in mine.items():
                for z, p in enumerate((1 - posterior[k], posterior[k])):
                    mass[z] += n * p
                    for j in range(len(VOTES)):
                        seen[z][j][k[1 + j]] += n * p
            for k in mine:
                logs = [math.log(mass[z]) + sum(math.log(seen[z][j][k[1 + j]] / (mass[z] + 0.5)) for j in range(len(VOTES))) for z in range(2)]
                posterior[k] = 1 / (1 + math.exp(min(50.0, max(-50.0, logs[0] - logs[1]))))
        out |= posterior
    return out


def features(k: tuple) -> list[str]:
    kind, pattern, gazetteer, context, shape, _ = k
    return [kind, f"pattern {kind} {pattern}", f"gazetteer {kind} {gazetteer}", f"context {context}", f"shape {kind} {shape}"]


def classifier(counts: dict[tuple, int], posterior: dict[tuple, float], steps: int = 400) -> dict[str, float]:
    """Weights of a logistic model of the posteriors, by gradient steps with a small penalty."""
    weights: dict[str, float] = defaultdict(float)
    total = sum(counts.values()) or 1
    for _ in range(steps):
        slope: dict[str, float] = defaultdict(float)
        for k, n in counts.items():
            z = sum(weights[f] for f in features(k))
            error = n / total * (1 / (1 + math.exp(-z)) - posterior[k])
            for f in features(k):
                slope[f] += error
        for f, g in slope.items():
            weights[f] -= 2.0 * (g + 1e-5 * weights[f])
    return dict(weights)


def detected(docs: DataFrame) -> DataFrame:
    """The contract's columns, and n_added."""
    found = written(candidates(docs).select("doc_id", "base", disjoint(F.col("base"), F.col("loose")).alias("loose")), "pii-candidates")
    pattern = ("kind", *VOTES, "shape", "strict")
    columns = [F.col(f"s.{c}") for c in pattern]
    spans_of = found.select(F.explode("base").alias("s")).select(*columns).unionByName(found.select(F.explode("loose").alias("s")).select(*columns))
    rows = spans_of.groupBy(*pattern).count().collect()
    counts = {tuple(r[c] for c in pattern): r["count"] for r in rows}
    posterior = reliabilities(counts)
    weights = classifier(counts, posterior)
    scores = {k: 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in features(k)))) for k in counts}
    accepted = sorted(k for k in counts if not k[-1] and scores[k] >= ACCEPT and posterior[k] >= 0.5)

    def good(s: Column) -> Column:
        same = [(s["kind"] == k[0]) & (s["pattern"] == k[1]) & (s["gazetteer"] == k[2]) & (s["context"] == k[3]) & (s["shape"] == k[4]) for k in accepted]
        test = F.lit(False)
        for one in same:
            test = test | one
        return test

    added = F.filter("loose", good)
    listed = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(
        F.concat(
            *[
                F.transform(
                    part,
                    lambda s: F.struct(F.array_position(listed, s["kind"]).alias("number"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
                )
                for part in (F.col("base"), added)
            ]
        )
    )

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(ordered).alias("spans"),
        F.size(added).cast("long").alias("n_added"),
    )
