"""Whitening, BPE and hard negatives against plain versions."""

import collections
import hashlib
import itertools
import math
import random
from fractions import Fraction

import fixtures
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import bpe, hard_negatives, whitening
from tabloom.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id bigint, embedding array<float>, label int, y string, v string, copies string, part string, place string, batch string"
CLASH = ("x",) * 6
BAD = [None, [1.0, None], [1.0, float("nan")], [float("inf"), 0.0]]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], VECTORS).repartition(4)


def random_rows(seed, count, width=4, ids=None):
    rng = random.Random(seed)
    return [(i if ids is None else ids[i], [rng.uniform(-1, 1) for _ in range(width)], rng.randrange(3)) for i in range(count)]


# --- whitening ---------------------------------------------------------------------------------


def plain_whitening(rows, limit=16):
    """{(vec_id, component): values} by floating-point eigenvectors of the plain covariance."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    off = (fit * n - sums).astype(float) / n
    values, columns = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)
    for i, x in kept:
        centred = np.array(x, object) * n - sums
        for c, at in enumerate(order[:limit]):
            yield i, c + 1, n, int((centred * centred).sum()), float(centred.astype(float) @ columns[:, at] / n / values[at] ** 0.5), values[at] / values.sum()


def test_whitening_equals_plain(spark):
    rows = random_rows(5, 60, 6) + random_rows(6, 3, 6, [3, 3, None]) + random_rows(5, 4, 6) + [(90 + i, b, 0) for i, b in enumerate(BAD)]
    got = collections.defaultdict(list)
    for r in whitening.whiten(vectors(spark, rows)).collect():
        got[r.vec_id, r.component].append(r)
    wanted = collections.defaultdict(list)
    for w in plain_whitening(rows):
        wanted[w[0], w[1]].append(w)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in wanted.items()}
    for component in range(1, 7):
        sign = math.copysign(1, got[1, component][0].whitened * wanted[1, component][0][4])
        for key in (k for k in got if k[1] == component):
            a, b = sorted((r.n, r.deviation, sign * r.whitened, r.explained) for r in got[key]), sorted(w[2:] for w in wanted[key])
            for x, y in zip(a, b):
                assert x[:2] == y[:2] and x[2] == pytest.approx(y[2], abs=1e-9) and x[3] == pytest.approx(y[3], rel=1e-9)
    assert all(0 <= r.identity_error < 1e-10 for r in itertools.chain(*got.values()))


def test_whitening_of_equal_and_missing_roots(spark):
    # a square and its copies on a line: two equal roots, one without variance
    rows = [(i, [1.0 * (i % 2), 1.0 * (i // 2 % 2), 5.0], 0) for i in range(8)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 16 and {r.n for r in got} == {4}
    assert all(r.explained == pytest.approx(0.5) and r.identity_error < 1e-12 for r in got)
    assert whitening.whiten(vectors(spark, rows[:1] * 3)).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None, 0)])).collect() == []
    assert whitening.whiten(vectors(spark, rows).limit(0)).collect() == []
    ragged = whitening.whiten(vectors(spark, [(1, [1.0], 0), (2, [0.5, 2.0], 0), (3, [1.0, 0.0], 0)])).collect()
    assert {r.n for r in ragged} == {2} and {r.component for r in ragged} == {1}


def test_polynomial_is_exact(spark):
    rng = random.Random(2)
    base = np.array([[rng.randrange(-50, 50) for _ in range(7)] for _ in range(5)], object)
    base[3] = 2 * base[1]
    a = base.T @ base  # rank 4 of 7
    coefficients = whitening.characteristic_polynomial(spark, a)

    def determinant(m):
        m, value = [[Fraction(int(x)) for x in row] for row in m], Fraction(1)
        for i in range(len(m)):
            pivot = next((r for r in range(i, len(m)) if m[r][i]), None)
            if pivot is None:
                return 0
            if pivot != i:
                m[i], m[pivot], value = m[pivot], m[i], -value
            value *= m[i][i]
            for r in range(i + 1, len(m)):
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i])]
        return value

    for t in (-3, 0, 1, 1000, 12345678):
        assert sum(c * t**i for i, c in enumerate(coefficients)) == determinant(t * np.eye(7, dtype=object) - a)
    assert coefficients[:3] == [0, 0, 0] and coefficients[3] != 0
    roots = whitening.largest_roots(coefficients, 16)
    assert [m for _, m in roots] == [1] * 4
    assert [float(r) for r, _ in roots] == pytest.approx(np.linalg.eigvalsh(a.astype(float))[::-1][:4], rel=1e-12)


def test_roots_that_repeat():
    # (t - 2)^2 (t - 3) (t - 5)^3 t, multiplied out
    coefficients = [1]
    for root in (2, 2, 3, 5, 5, 5, 0):
        coefficients = [a - root * b for a, b in zip([0, *coefficients], [*coefficients, 0])]
    assert [(round(float(r), 12), m) for r, m in whitening.largest_roots(coefficients, 16)] == [(5, 3), (3, 1), (2, 2)]
    assert [(round(float(r), 12), m) for r, m in whitening.largest_roots(coefficients, 4)] == [(5, 3), (3, 1)]


def test_large_products_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randrange(-(1 << 61), 1 << 61) for _ in range(3)]) for i in range(50)]
    fit = spark.createDataFrame(rows, "i int, y array<bigint>").select("y").repartition(3)
    n, sums, squares = whitening.moments(fit, 3)
    assert n == 50 and sums == [sum(r[1][d] for r in rows) for d in range(3)]
    assert all(squares[i, j] == sum(r[1][i] * r[1][j] for r in rows) for i in range(3) for j in range(3))


# --- BPE ---------------------------------------------------------------------------------------


def library():
    return Tokenizer.from_file(PATH)


def test_tokens_equal_the_library(spark):
    docs = fixtures.documents(spark)
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in bpe.encoded(docs, bpe.read_vocabulary(PATH)).collect())
    rows = fixtures.rows()
    found = library().encode_batch([r[1] or "" for r in rows], add_special_tokens=False)
    assert got == collections.Counter((r[0], tuple(f.ids)) for r, f in zip(rows, found))


def test_round_trip(spark):
    docs = fixtures.documents(spark)
    got = collections.Counter(map(tuple, bpe.round_trip(docs, PATH).collect()))
    t, wanted = library(), collections.Counter()
    for r in fixtures.rows():
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        wanted[r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert got == wanted
    assert bpe.round_trip(fixtures.none(spark), PATH).collect() == []


def odd_texts(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        kind = rng.randrange(4)
        if kind == 0:
            planes = (lambda: rng.randrange(32, 127), lambda: rng.randrange(0x250), lambda: rng.randrange(0xD800), lambda: rng.randrange(0xE000, 0x110000))
            yield "".join(chr(rng.choice(planes)()) for _ in range(rng.randrange(40)))
        elif kind == 1:
            yield rng.choice("ab \n") * rng.randrange(2000)
        elif kind == 2:
            yield "".join(rng.choice(["<|endoftext|>", "a", "'s", " ", "  ", "\n", "1", "é", "'ll", "aa", " a"]) for _ in range(50))
        else:
            yield "".join(rng.choice("aAbB \t") for _ in range(300))


@pytest.mark.parametrize("window", [37, bpe.WINDOW])
def test_odd_texts(window, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", window)
    monkeypatch.setattr(bpe, "GROUP", 500)
    monkeypatch.setattr(bpe, "KNOWN", 1000)
    texts = list(odd_texts(600, window))
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    assert [np.frombuffer(ids, np.int32).tolist() for ids in encoder.encode(texts)] == [w.ids for w in library().encode_batch(texts, add_special_tokens=False)]


def test_every_settled_character_splits_alike():
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    splitter = encoder.library()
    for c in [*map(chr, range(128)), *sorted(encoder.settled)[::7]]:
        text = f"a{c}b 1{c} {c}{c}  {c}2 ?{c}"
        if c.isascii():
            assert encoder.ascii_pattern.findall(text[: text.index("?") + 2]) == encoder.pattern.findall(text[: text.index("?") + 2])
        assert encoder.pattern.findall(text) == [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]


def test_decoding_odd_ids(spark):
    ids = spark.createDataFrame([(1, [72, 99_999_999, 50256]), (2, None), (3, []), (4, [128, 300])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decoded(ids, bpe.read_vocabulary(PATH)).collect()}
    assert got == {1: library().decode([72, 50256], skip_special_tokens=False), 2: None, 3: "", 4: library().decode([128, 300], skip_special_tokens=False)}


def test_files_that_are_no_ordered_merges():
    source = bpe.read_vocabulary(PATH)
    with pytest.raises(ValueError):
        bpe.Vocabulary(source.replace('"add_prefix_space":false', '"add_prefix_space":true').replace('"add_prefix_space": false', '"add_prefix_space": true'))


# --- hard negatives ----------------------------------------------------------------------------


def plain_negatives(rows, every=50):
    kept = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in v], label))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for at, (anchor, a, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), i, other) for j, (i, v, other) in enumerate(kept) if j != at]
        for score, positive, _ in sorted((s for s in scored if s[2] == label), key=order)[:5]:
            fits = sorted((s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score), key=order)[:3]
            for rank, (value, negative, _) in enumerate(fits):
                yield anchor, positive, rank + 1, negative, score, value


@pytest.mark.parametrize("block", [4, hard_negatives.BLOCK])
def test_negatives_equal_plain(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "PART", 4 * block)
    monkeypatch.setattr(hard_negatives, "BATCH", 3)
    rows = random_rows(3, 150, 5) + [(i, [0.5, 0.5], 1) for i in (200, 250, 251, 252)] + random_rows(4, 30, 6, [None] * 30)
    rows += [rows[50]] * 4 + [rows[7]] * 9 + [(300, [0.9, 0.1, 0.0, 0.2, 0.3], 2)] * 3 + [(301, [1.0], None), (400, [], 1)]
    rows += [(302 + i, b, 1) for i, b in enumerate(BAD)]
    got = collections.Counter(map(tuple, hard_negatives.mined(vectors(spark, rows)).collect()))
    wanted = collections.Counter(plain_negatives(rows))
    assert got == wanted and len(wanted) > 30


def test_negatives_of_tables_without_anchors(spark):
    assert hard_negatives.mined(vectors(spark, random_rows(1, 5)).limit(0)).collect() == []
    assert hard_negatives.mined(vectors(spark, [(1, [1.0], 0), (None, [1.0], 1)])).collect() == []


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    rng = random.Random(5)
    centres = [[rng.choice((-1, 1)) * 0.9 for _ in range(6)] for _ in range(12)]
    rows = [(i, [c + rng.uniform(-0.02, 0.02) for c in centres[i % 12]], i % 12) for i in range(600)]
    blocks = hard_negatives.blocks(vectors(spark, rows))
    batches = hard_negatives.anchors(blocks, 50)
    ids = batches.count()
    whole = spark.createDataFrame([(r["batch"], a, 0, 2000.0, 1e9) for r in batches.collect() for a in range(len(r["ids"]) // 8)], "batch bigint, anchor int, window int, low double, high double")
    packets = hard_negatives.chosen_packets(blocks, hard_negatives.with_windows(batches, whole), True).count()
    assert 0 < packets < 0.5 * ids * blocks.count()


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        places = hard_negatives.hilbert_places(cells, bits)
        assert sorted(places) == list(range(len(cells)))
        path = cells[np.argsort(places)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_sample_tables(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    tokens = bpe.decoded(bpe.encoded(docs, bpe.read_vocabulary(PATH), keep=("doc_id", "text")), bpe.read_vocabulary(PATH))
    assert tokens.where(~F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0
