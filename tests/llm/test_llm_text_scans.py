"""PII, license and secret scans against plain regular expressions."""

import hashlib
import math
import re
from collections import Counter

import fixtures
import pytest
from pyspark.sql import functions as F

from tabloom.llm import licenses, pii, secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    text = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def joined(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def by_row(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_personal_base(spark, seed):
    docs = fixtures.documents(spark, 300, seed)
    found = by_row(pii.detected(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    wanted = Counter()
    for r in fixtures.rows(300, seed):
        spans = personal(r[1])
        n = Counter(k for k, *_ in spans)
        wanted[(r[0], n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(joined(spans).encode()).hexdigest())] += 1
    assert found == wanted


def test_personal_added_spans(spark):
    cases = [(i, f"please mail joe{i % 7} [at] example.com or call +49 30 1234567 now") for i in range(60)]
    cases += [(100 + i, f"contact me by e-mail: ann.{i}@example.org today") for i in range(60)]
    cases += [(200 + i, "nothing to see here, order 12 345 of part 7") for i in range(60)]
    got = {r.doc_id: r for r in pii.detected(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    for i, text in cases[:60]:
        start = text.index("joe")
        assert f"email:{start}:{text.index(' or ')}" in got[i].spans.split(",") and got[i].n_added == 1 and got[i].n_phone == 1
    assert all(got[i].n_added == 0 for i, _ in cases[60:]) and all(got[i].spans == "" for i, _ in cases[120:])


def test_personal_spans_hold_base_and_do_not_overlap(spark):
    for r in pii.detected(fixtures.documents(spark, 200, 9)).collect():
        items = [x.split(":") for x in r.spans.split(",") if x]
        assert len(items) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
        order = [(pii.KINDS.index(k), int(a)) for k, a, _ in items]
        assert order == sorted(order)


def test_em_rates_a_random_labeler_lower():
    counts = {}
    for pattern in (0, 1):
        for gazetteer in (-1, 1):
            for context in (0, 1):
                agree = pattern == (gazetteer == 1)
                counts[("ip", pattern, gazetteer, context, 0, True)] = 90 if agree else 10
    posterior = pii.reliabilities(counts)
    assert posterior[("ip", 1, 1, 0, 0, True)] > 0.9 > 0.1 > posterior[("ip", 0, -1, 0, 0, True)]
    weights = pii.classifier(counts, posterior)
    score = lambda k: 1 / (1 + math.exp(-sum(weights.get(f, 0) for f in pii.features(k))))
    assert score(("ip", 1, 1, 1, 0, True)) > 0.8 > 0.3 > score(("ip", 0, -1, 1, 0, True))


def test_personal_long_run(spark):
    text = "a" * 5000 + " " + "1 " * 20_000 + "b@c.de " * 3000
    (r,) = pii.detected(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert r.n_email == 3000 and r.base_sha256 == hashlib.sha256(joined(personal(text)).encode()).hexdigest()


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def licensed(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += here
        base |= {label} if here else set()
    labels, score = set(base), 1.0 if base else 0.0
    for at in range(0, len(words), licenses.STEP):
        block = set(words[at : at + licenses.BLOCK])
        for text_of, label in licenses.NOTICES:
            t = set(text_of.split())
            if len(block & t) >= licenses.needed(len(t), licenses.THRESHOLD):
                labels.add(label)
                score = max(score, len(block & t) / len(t))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9)


@pytest.mark.parametrize("seed", [1, 2])
def test_licenses(spark, seed):
    extra = [
        (5000 + i, " ".join(["wort"] * i) + " This work is licensed under the GNU General Public License, version 3. permission is hereby granted free of charge", None, None, 0) + fixtures.CLASH
        for i in range(40)
    ]
    docs = fixtures.documents(spark, 300, seed).unionByName(spark.createDataFrame(extra, fixtures.SCHEMA))
    rows = licenses.scan(docs).withColumn("score", F.round("score", 9))
    found = by_row(rows, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert found == Counter((r[0], *licensed(r[1])) for r in fixtures.rows(300, seed) + extra)


def secret(text):
    text, out = text or "", []
    for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII):
        if len(m.group(2)) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    order = ("assign", "access", "hex")
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_secrets_base(spark, seed):
    found = by_row(secrets.scan(fixtures.documents(spark, 300, seed)), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    wanted = Counter()
    for r in fixtures.rows(300, seed):
        # the pattern's letters are ASCII ones, which re takes wider for a few other letters
        spans = secret(r[1])
        n = Counter(k for k, *_ in spans)
        wanted[(r[0], n["assign"], n["access"], n["hex"], hashlib.sha256(joined(spans).encode()).hexdigest())] += 1
    assert found == wanted


def test_secrets_added(spark):
    rows = [(1, "x ghp_" + "a1B2" * 9 + " y"), (2, "-----BEGIN RSA PRIVATE KEY-----"), (3, "-----BEGIN PUBLIC KEY-----"), (4, "xoxb-123")]
    got = {r.doc_id: (r.spans, r.n_added) for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("github:2:42", 1), 2: ("pem:0:31", 1), 3: ("", 0), 4: ("", 0)}


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{24,}") == frozenset()
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == {frozenset({"aki", "kia"})}
    either = secrets.trigram_query(r"(?i:(token|api_?key))\x20*[:=]")
    assert either == {frozenset({"tok", "oke", "ken"}), frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"})}


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_trigram_queries_hold_for_matches(rule):
    query = secrets.trigram_query(rule.pattern)
    for text in fixtures.texts(400, 4):
        if re.search(rule.pattern, text):
            have = secrets.trigrams(text)
            assert not query or any(a <= have for a in query)


@pytest.mark.parametrize("scan", [pii.detected, licenses.scan, secrets.scan])
def test_no_rows(spark, scan):
    assert scan(fixtures.none(spark)).collect() == []
