"""Sharding, search, language model, decontamination, near-duplicates, quality and mixing against plain versions."""

import collections
import itertools
import math
import random
import re
import zlib

import fixtures
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tabloom.llm import decontamination, mixing, ppm, quality, sharding, simhash, topk
from tabloom.llm.common import table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


# --- sharding --------------------------------------------------------------------------------


def test_shards_of_all_rows(spark):
    got = sharding.sharded(fixtures.documents(spark), 4).collect()
    wanted = collections.Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in fixtures.rows()
    )
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == wanted
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_near_equal_and_repeatable(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sharding.sharded(docs).collect()
    loads = collections.Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values()) / 16
    again = sharding.sharded(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in rows) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_shards_stay_balanced_where_rows_repeat(spark):
    rows = [(7, "the same long row " * 20, "en", "b")] * 1500 + [(i, "text " * (i % 90), "en", "a") for i in range(100, 2600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, slot string, size string").repartition(6)
    got = sharding.sharded(docs, columns=docs.columns)
    assert got.columns == [*docs.columns, "size_", "text_crc32", "law", "shard", "slot_", "grown_shard", "virtual_slot", "map_version"]
    loads, slots = collections.Counter(), collections.Counter()
    found = got.collect()
    for r in found:
        loads[r.shard] += r.size_
        slots[r.virtual_slot] += 1
    mean = sum(loads.values()) / 16
    assert len(loads) == 16 and max(loads.values()) < 1.05 * mean and max(slots.values()) < 20
    assert collections.Counter((r.doc_id, r.text, r.size, r.slot) for r in found) == collections.Counter((a, b, d, c) for a, b, c, d in rows)
    for shard in range(16):
        assert sorted(r.slot_ for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    narrow = sharding.sharded(docs).collect()
    assert collections.Counter((r.doc_id, r.size) for r in narrow) == collections.Counter((r.doc_id, r.size_) for r in found)
    empty = sharding.sharded(docs.limit(0), columns=docs.columns)
    assert empty.collect() == [] and empty.columns == got.columns


def test_rebalancing_edits_the_stored_map(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    docs = table(spark, SMALL, "documents")
    sharding.assign(docs, 4, 256, path).count()
    version, owner = sharding.latest_map(spark, path)
    first = {r["slot"]: r["shard"] for r in spark.read.parquet(path).where("version = 1").collect()}
    assert version == 2 and first == sharding.initial_map(256, 4) and 0 < sum(owner[s] != first[s] for s in owner) < 128
    sharding.assign(docs, 4, 256, path).count()
    assert sharding.latest_map(spark, path) == (version, owner)  # balanced already
    grown = sharding.rebalanced(owner, {s: 10 for s in owner}, 5)
    assert all(grown[s] == 4 or sum(v == owner[s] for v in grown.values()) >= 51 for s in owner)
    assert sorted(collections.Counter(grown.values()).values()) == [51, 51, 51, 51, 52]


# --- top-k -----------------------------------------------------------------------------------


def plain_top_k(rows, every=50, k=5):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(vectors):
        if i is None or i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j is None, j) for b, (j, w) in enumerate(vectors) if a != b]
        out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(sorted(scored, key=lambda t: (t[0], t[1], t[2] or 0))[:k])]
    return collections.Counter(out)


def test_top_k_of_edge_cases(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.3, 0.5]) for _ in range(rng.choice([4, 4, 4, 2, 0]))]) for i in range(300)]
    rows += [(50, [0.5, 0.5, 0.5, 0.5]), (None, [1.0, 1.0, 1.0, 1.0]), (400, None), (450, [None, 1.0]), (500, [float("nan")]), (550, [float("inf")])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("number", F.lit(1))
    assert collections.Counter(tuple(r) for r in topk.top_k(df).collect()) == plain_top_k(rows)
    assert topk.top_k(df.limit(0)).collect() == []
    few = [(0, [0.5]), (1, [0.25]), (2, [0.25])]
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame(few, "vec_id long, embedding array<float>")).orderBy("rank").collect()] == [(0, 1, 1, 8192), (0, 2, 2, 8192)]


def test_top_k_over_several_ranges(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 0.3, (20, 16))
    vectors = (centres[rng.integers(0, 20, 9000)] + rng.normal(0, 0.05, (9000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    whole = np.floor(256 * vectors.astype(np.float64))
    wanted = set()
    for q in range(0, 9000, 50):
        scores = whole @ whole[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(9000), -scores))[:5]
        wanted |= {(q, n + 1, int(b), int(scores[b])) for n, b in enumerate(best)}
    assert {tuple(r) for r in topk.top_k(df).collect()} == wanted


def test_top_k_sends_no_copies_of_queries_through_the_driver(spark):
    """Queries are copied to every group of ranges, which the planner's estimate leaves out: neither side may be broadcast."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.3, (9000, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    plans, write = [], topk.written

    def noted(part, name):
        plans.append(part._jdf.queryExecution().executedPlan().toString())
        return write(part, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(topk, "written", noted)
        plans.append(topk.top_k(df)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)


def test_search_stops_before_hopeless_blocks():
    vectors = np.concatenate([np.full((topk.BLOCK, 2), 9.0), np.full((topk.BLOCK, 2), 1.0)])
    index = topk.Index(np.arange(len(vectors)).tobytes(), 2, vectors.astype("<f8").tobytes())
    _, positions, scores = index.search(np.ones((1, 2)), np.array([17.0]), None, 5)
    assert positions.tolist() == [0, 1, 2, 3, 4] and set(scores) == {18.0}


# --- language model --------------------------------------------------------------------------


def held(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == 0


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")) if w] + [" "]


def plain_ppm(rows):
    """PPM with method C and exclusion, straight from its definition, over contexts of up to four bytes."""
    counts = collections.defaultdict(collections.Counter)
    for i, text, *_ in rows:
        if held(i, 10):
            continue
        data = b"\xff" * 4 + (text or "").encode() + b"\xff"
        for at in range(4, len(data)):
            for order in range(5):
                counts[data[at - order : at]][data[at]] += 1
    total = sum(counts[b""].values())
    deep = {c for c, n in counts.items() if len(c) <= 2 or sum(n.values()) >= -(-total // ppm.FREQUENT)}

    def log10(data, at):
        p, excluded = 1.0, set()
        order = next((n for n in (4, 3, 2, 1) if all(data[at - k : at] in deep for k in range(1, n + 1))), 1)
        for n in range(order, -1, -1):
            seen = {s: c for s, c in counts[data[at - n : at]].items() if s not in excluded}
            size, kinds = sum(seen.values()), len(seen)
            if data[at] in seen:
                return math.log10(p * seen[data[at]] / (size + kinds))
            if kinds:
                p *= kinds / (size + kinds)
            excluded |= set(seen)
        return math.log10(p / (256 - len(excluded)))

    def score(text):
        data = b"\xff" * 4 + (text or "").encode() + b"\xff"
        return sum(log10(data, at) for at in range(4, len(data)))

    return score


def test_language_model(spark):
    rows = fixtures.rows(150)
    got = ppm.scored(fixtures.documents(spark, 150)).collect()
    counts = collections.Counter(w for r in rows if not held(r[0], 10) for w in plain_words(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    score = plain_ppm(rows)
    wanted = collections.defaultdict(list)
    for r in rows:
        w = plain_words(r[1])
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        wanted[r[0]].append((held(r[0], 10), len(w), sum(counts[x] > 0 for x in w), total, base, score(r[1])))
    found = collections.defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert found.keys() == wanted.keys()
    for i in wanted:
        for a, b in zip(sorted(found[i]), sorted(wanted[i]), strict=True):
            assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-5)


@pytest.mark.parametrize("trie_contexts", [40, 1_000, 65_536])
def test_language_model_counts_every_context(spark, monkeypatch, trie_contexts):
    rows = fixtures.rows(150)
    with monkeypatch.context() as m:
        m.setattr(ppm, "FREQUENT", 1 << 40)  # for the plain version: a context seen once counts
        score = plain_ppm(rows)
    monkeypatch.setattr(ppm, "FREQUENT", trie_contexts)
    found, wanted = collections.defaultdict(list), collections.defaultdict(list)
    for r in ppm.scored(fixtures.documents(spark, 150), pruned=False).collect():
        found[r.doc_id].append(r.score)
    for r in rows:
        wanted[r[0]].append(score(r[1]))
    assert found.keys() == wanted.keys()
    for i in wanted:
        assert sorted(found[i]) == pytest.approx(sorted(wanted[i]), rel=1e-5)


def test_language_model_without_rows(spark):
    assert ppm.scored(fixtures.none(spark)).collect() == []
    alone = next(i for i in range(100) if held(i, 10))  # nothing to learn from
    (r,) = ppm.scored(spark.createDataFrame([(alone, "ab")], "doc_id long, text string")).collect()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0) and r.score == pytest.approx(-3 * math.log10(256), rel=1e-5)


def test_trie_rows_are_distributions():
    texts = [t.encode() for t in fixtures.texts(50, 3)]
    codes, n = ppm.merged([ppm.grams(d, s) for d, s, _ in ppm.slabs(texts)])
    levels = []
    for order in range(1, ppm.ORDER + 1):
        u, at = np.unique(codes & ((1 << (8 * (order + 1))) - 1), return_inverse=True)
        levels.append((u, np.bincount(at, n)))
    trie = ppm.Trie(levels)
    assert np.allclose((10.0 ** trie.table.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_slabs_cut_long_texts(monkeypatch):
    text = bytes(range(32, 120)) * 50
    whole = ppm.merged([ppm.grams(d, s) for d, s, _ in ppm.slabs([text, b"", text])])
    monkeypatch.setattr(ppm, "SLAB", 100)
    cut = ppm.merged([ppm.grams(d, s) for d, s, _ in ppm.slabs([text, b"", text])])
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


# --- decontamination -------------------------------------------------------------------------


def test_substituted_passages_are_found(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(20)] + [(100, "six words that are quite rare"), (101, "too short"), (102, None), (None, "")]
    docs = []
    for i, (_, text) in enumerate(items[:20]):
        passage = text.split()[: 40 if i < 10 else 24]
        for at in range(3, len(passage), 9):
            passage[at] = word()
        docs.append((i, ", ".join([word() for _ in range(50)] + passage + [word() for _ in range(50)]).upper()))
        docs.append((50 + i, " ".join([word() for _ in range(60)] + text.split()[:6])))  # six words are no passage
    docs += [(200, "so Six words, that are: quite RARE!"), (201, "too short"), (202, None), (203, ""), (None, items[0][1]), (204, items[1][1]), (204, items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("seed", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminations(df, bench).collect()}
    assert got == {(i, i) for i in range(20)} | {(200, 100), (None, 0), (204, 1)}
    kept = decontamination.decontaminated(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [50 + i for i in range(20)] + [201, 202, 203] and kept.columns == df.columns
    assert decontamination.contaminations(df.limit(0), bench).collect() == []
    assert decontamination.contaminations(df, bench.limit(0)).collect() == []


def plain_overlaps(docs, items):
    """All diagonals of all pairs, without seeds; words that a document lacks are unequal."""
    found = set()
    for (d, text), (i, item) in itertools.product(docs, items):
        a, b = text.split(), item.split()
        width = min(16, len(b))
        for g in range(1 - len(b), len(a)) if len(b) >= 5 else ():
            equal = [0 <= g + j < len(a) and a[g + j] == b[j] for j in range(len(b))]
            best = max(sum(equal[s : s + width]) for s in range(len(b) - width + 1))
            if best >= math.ceil(width * 0.8):
                found.add((d, i, max(g, 0), max(-g, 0), sum(equal), best))
    return found


def overlaps_of(spark, docs, items):
    got = decontamination.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return collections.Counter((r.doc_id, r.item_id, r.doc_start, r.item_start, r.equal_words, r.best_window) for r in got.collect())


def test_every_accepted_pattern_of_substitutions_is_found(spark):
    items = [(n, " ".join(f"w{n}x{j}" for j in range(n))) for n in range(4, 18)]
    docs = []
    for n, text in items:
        width = min(16, n)
        for k in range(width - math.ceil(width * 0.8) + 2):  # one more than the rule accepts, too
            for places in itertools.combinations(range(width), k):
                words = text.split()
                for at in places:
                    words[at] = "other"
                docs.append((len(docs), " ".join(["left"] * 3 + words[:width] + ["right"] * 3)))
    wanted = set()
    for n, text in items:
        wanted |= plain_overlaps([d for d in docs if f"w{n}x" in d[1]], [(n, text)])
    assert len({w[0] for w in wanted}) > 1000 and overlaps_of(spark, docs, items) == collections.Counter(wanted)


@pytest.mark.parametrize("words", range(5, 41))
def test_masks_are_spaced_and_fit_between_all_accepted_substitutions(words):
    width = min(decontamination.WINDOW, words)
    masks = decontamination.MASKS[decontamination.family(words)]
    assert all(m[0] == m[-1] == "1" and "0" in m and len(m) <= width for m in masks)
    for places in itertools.combinations(range(width), width - math.ceil(width * decontamination.SIMILAR)):
        assert any(
            all(bit == "0" or start + i not in places for i, bit in enumerate(m)) for m in masks for start in range(width - len(m) + 1)
        ), places


def test_passages_at_the_edges_of_documents_are_found(spark):
    words = [f"w{j}" for j in range(40)]
    items = [(0, " ".join(words)), (1, " ".join(f"v{j}" for j in range(9)))]
    docs = [(0, " ".join(words[4:18])), (1, " ".join(["left"] * 9 + words[:13])), (2, " ".join(words[:6] + ["other"] + words[7:14] + ["right"]))]
    docs += [(3, " ".join(words[27:] + ["right"] * 9)), (4, " ".join(words[:12])), (5, " ".join(f"v{j}" for j in range(1, 9))), (6, " ".join(f"v{j}" for j in range(7)))]
    wanted = plain_overlaps(docs, items)
    assert {w[0] for w in wanted} == {0, 1, 2, 3, 5} and overlaps_of(spark, docs, items) == collections.Counter(wanted)


# --- near-duplicates -------------------------------------------------------------------------


def plain_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def plain_groups(prints):
    """Smallest id reachable, by comparing all pairs."""
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    least = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return collections.Counter((d, f"{p:016x}", min(least[root(i)], default=None)) for i, (d, p) in enumerate(prints))


def test_near_duplicates(spark):
    rows = fixtures.rows()
    base = " ".join(fixtures.texts(300, 8))
    rows += [(2000 + i, base + f" end{i}", None, None, 0) + fixtures.CLASH for i in range(40)]
    df = spark.createDataFrame(rows, fixtures.SCHEMA).repartition(5)
    wanted = plain_groups([(r[0], plain_print(r[1])) for r in rows])
    assert collections.Counter(tuple(r) for r in simhash.near_duplicates(df).collect()) == wanted
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == len({c for _, _, c in wanted})
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in wanted}
    assert simhash.near_duplicates(fixtures.none(spark)).collect() == []


def test_near_duplicates_of_documents(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    wanted = plain_groups([(r.doc_id, plain_print(r.text)) for r in rows])
    got = simhash.near_duplicates(table(spark, "/root/testdata/sf0.01", "documents")).collect()
    assert collections.Counter(tuple(r) for r in got) == wanted


def connected(fps, edges):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    groups = collections.defaultdict(set)
    for f in fps:
        groups[root(f)].add(f)
    return {frozenset(g) for g in groups.values()}


def near_pairs(fps):
    return [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3]


@pytest.mark.parametrize("members", [300, 2600])
def test_long_list(members):
    rng = random.Random(members)
    positions = (1, 4, 6)
    fps = sorted({0xABCDEF0123456789 ^ sum(rng.getrandbits(8) << (8 * p) for p in positions) for _ in range(members)})
    a, b = simhash._near_in_long(np.array(fps, np.uint64), positions)
    assert len(a) < len(fps) and connected(fps, zip(a.tolist(), b.tolist())) == connected(fps, near_pairs(fps))


def test_long_lists_are_posted_again(spark, monkeypatch):
    """The whole way, with lists cut at 20 members: driver-side, as the workers see their own constant."""
    monkeypatch.setattr(simhash, "LONG", 20)
    rng = random.Random(1)
    fps = sorted({0x1122334455667788 ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(20)) for _ in range(250)} | {rng.getrandbits(64) for _ in range(50)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    posted = F.explode(F.array(*[simhash._key(F.col("fp"), n, t) for n, t in enumerate(simhash.TRIPLES)]))
    rows = df.select(posted.alias("key"), "fp").orderBy("key").collect()
    batches = [pa.record_batch([pa.array([r.key for r in rows[i : i + 17]]), pa.array([r.fp for r in rows[i : i + 17]])], names=["key", "fp"]) for i in range(0, len(rows), 17)]
    out = [r for b in simhash._postings(iter(batches)) for r in b.to_pylist()]
    assert any(r["long"] for r in out) and not all(r["long"] for r in out)
    edges = [(r["a"] % 2**64, r["b"] % 2**64) for r in out if not r["long"]]
    again = collections.defaultdict(set)
    for r in out:
        if r["long"]:
            for n, five in enumerate(simhash.FIVES):
                if set(simhash.TRIPLES[r["a"] >> 24]) <= set(five):
                    fp = r["b"] % 2**64
                    key = n
                    for p in five:
                        key = key << 8 | fp >> (8 * p) & 255
                    again[key].add(fp)
    rows = sorted((k, f) for k, v in again.items() for f in v)
    batches = [pa.record_batch([pa.array([k for k, _ in rows[i : i + 13]], pa.int64()), pa.array(np.array([f for _, f in rows[i : i + 13]], np.uint64).view(np.int64))], names=["key", "fp"]) for i in range(0, len(rows), 13)]
    edges += [(r["a"] % 2**64, r["b"] % 2**64) for b in simhash._long_lists(iter(batches)) for r in b.to_pylist()]
    assert connected(fps, edges) == connected(fps, near_pairs(fps))


# --- quality ---------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    got = quality.rated(docs, labels)
    pairs = [(r.score, r.quality, r.predicted) for r in got.where("held_out").join(labels.select("doc_id", "quality"), "doc_id").collect()]
    good, bad = [s for s, q, _ in pairs if q == 1], [s for s, q, _ in pairs if q == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9 and sum(p == 1 for _, q, p in pairs if q == 1) > 0.97 * len(good)
    assert got.count() == docs.count() and got.where("held_out != (crc32(cast(doc_id AS string)) % 5 = 0)").count() == 0
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("predicted = 1").count()


def test_quality_of_edge_cases(spark):
    docs = fixtures.documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(None, 1, 0), (5, None, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.rated(docs, labels).collect()
    assert len(rows) == len(fixtures.rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert {r.score for r in quality.rated(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.rated(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert quality.rated(fixtures.none(spark), labels).collect() == []


def test_convolution_covers_the_whole_text(monkeypatch):
    rng = np.random.default_rng(1)
    net = quality.Network(rng.normal(size=(8, 256, 24)).astype(np.float32), np.zeros(24, np.float32), rng.normal(size=72), 0.1)
    text = bytes(rng.integers(0, 256, 5000).tolist())
    data = quality.padded(text) + bytes(8)
    wanted = np.zeros((20, 24))
    for at in range(0, 5120, 2):
        wanted[at // 256] = np.maximum(wanted[at // 256], sum(net.filters[o][data[at + o]] for o in range(8)))
    assert np.allclose(quality.document_maxima(text, net.pairs(), net.bias), wanted, atol=1e-4)
    monkeypatch.setattr(quality, "SLAB", 1024)
    assert np.allclose(quality.document_maxima(text, net.pairs(), net.bias), wanted, atol=1e-4)


# --- mixing ----------------------------------------------------------------------------------


def plain_targets(sizes):
    total, weights = sum(sizes), [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    low, high = 0.0, 1e12
    for _ in range(300):  # the level at which capped shares add up to all words
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * s, level * w) for s, w in zip(sizes, weights)) < total else (low, level)
    return [min(3 * s, high * w) for s, w in zip(sizes, weights)]


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed", [17, 18])
def test_mix_takes_its_targets(spark, seed):
    rows = fixtures.rows(200)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += words_of(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, plain_targets([sizes[s] for s in order])))
    docs = fixtures.documents(spark, 200)
    got = mixing.mixed(docs, seed=seed).collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((r[0], words_of(r[1])) for r in rows)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[(r.source_size, round(r.target, 6))] += r.taken
    for s in order:
        assert taken[(sizes[s], round(goal[s], 6))] == pytest.approx(goal[s], abs=1)
    again = mixing.mixed(docs.repartition(3), seed=seed).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mixed(fixtures.none(spark)).collect() == []


def test_mix_rows_hold_what_is_taken(spark):
    docs = fixtures.documents(spark, 200)
    mix = mixing.mix(docs)
    assert mix.columns == [*docs.columns, "mix_shard"]
    rows = mix.collect()
    held = collections.Counter()
    for r in rows:
        held[r.doc_id] += words_of(r.text)
    taken = collections.Counter()
    for r in mixing.mixed(docs).collect():
        taken[r.doc_id] += r.taken
    assert +held == +taken
    texts = collections.defaultdict(list)
    for r in fixtures.rows(200):
        texts[r[0]].append(r[1] or "")
    assert all(any(r.text in t for t in texts[r.doc_id]) for r in rows)
    assert {r.mix_shard for r in rows} <= set(range(16))


def test_splitting_tree():
    quotas = [1000, 0, 37, 512, 3]
    tree = mixing.split_tree(quotas, 7, 1)
    assert tree.sum(axis=0).tolist() == quotas and np.ptp(tree.sum(axis=1)) <= 1 and (tree >= 0).all()
    assert np.array_equal(tree, mixing.split_tree(quotas, 7, 1)) and not np.array_equal(tree, mixing.split_tree(quotas, 7, 2))


def test_more_sources_than_the_driver_holds(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 900])), None if i % 41 == 0 else f"s{rng.randrange(30)}é") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = sorted(tuple(r) for r in mixing.mixed(docs).collect())
    whole = collections.Counter((r.doc_id, r.text) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "MAX_SOURCES", 4)
    assert sorted(tuple(r) for r in mixing.mixed(docs).collect()) == few
    many = mixing.mix(docs, shards=4).collect()
    assert collections.Counter((r.doc_id, r.text) for r in many) == whole and {r.mix_shard for r in many} == {0, 1, 2, 3}
    sources = mixing.sized(docs, ["doc_id"], 17).groupBy("source_key").agg(F.sum("size").alias("words"))
    drawn = mixing.many_draws(sources, 4, 17).collect()
    assert len(drawn) == 31
    loads = np.diff(np.array([r.cuts for r in drawn]), axis=1, prepend=0).sum(axis=0)
    assert loads.max() - loads.min() <= 1


def test_training_takes_one_row_of_an_id(spark, monkeypatch):
    ids = [i for i in range(60) if not held(i, 5)]
    docs = spark.createDataFrame([(i, f"text {i} " * 9) for i in ids] + [(ids[0], f"other {n}") for n in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    taken = []
    monkeypatch.setattr(quality, "train", lambda samples, *a: taken.append(len(samples)))
    quality.fit(docs, labels)
    quality.fit(docs, labels, sample_rows=5)
    assert taken == [len(ids), 10]
