"""The quality query against a plain scorer, and a training step against numerical gradients."""

import zlib

import numpy as np

from tabloom.llm import catalog, quality

FOLDER = "/root/testdata/sf0.001"


def plain_score(text, net):
    """The network on one text, window by window in double precision."""
    size = max(512, -(-len(text) // 256) * 256)
    data = text + bytes(size - len(text) + 8)
    responses = np.array([sum(net.filters[o, data[at + o]].astype(float) for o in range(8)) for at in range(0, size, 2)])
    responses = np.maximum(responses + net.bias, 0)
    chunks = np.array([responses[at : at + 256].max(axis=0) for at in range(0, len(responses) - 128, 128)])
    features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
    return 1 / (1 + np.exp(-(features @ net.weights + net.constant)))


def test_query_equals_a_plain_scorer(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    net = quality.fit(docs, labels)
    wanted = {r.doc_id: plain_score((r.text or "").encode(), net) for r in docs.select("doc_id", "text").collect()}
    rows = catalog.QUERIES["op9_quality"](spark, FOLDER).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        assert abs(r.score - wanted[r.doc_id]) < 1e-4
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def plain_loss(samples, labels, weights, filters, bias, w, c):
    total = 0.0
    for chunks, label, weight in zip(samples, labels, weights):
        pooled = []
        for chunk in chunks:
            codes = np.frombuffer(chunk, np.uint8)
            pooled.append(np.maximum(sum(filters[o][codes[o : o + 505 : 2]] for o in range(8)).max(axis=0) + bias, 0))
        pooled = np.array(pooled)
        score = 1 / (1 + np.exp(-(np.concatenate([pooled.mean(axis=0), pooled.max(axis=0), pooled.min(axis=0)]) @ w + c)))
        total -= weight * (label * np.log(score) + (1 - label) * np.log(1 - score))
    return total / sum(weights) + 1e-4 / 2 * w @ w


def test_a_step_follows_the_gradient(monkeypatch):
    rng = np.random.default_rng(6)
    samples = [[bytes(rng.integers(97, 105, 512, dtype=np.uint8)) for _ in range(1 + i % 3)] for i in range(6)]
    labels, weights = np.array([0, 1, 0, 1, 1, 0.0]), np.array([1, 1, 2, 1, 3, 1.0])
    monkeypatch.setattr(quality, "EPOCHS", 0)
    start = quality.train(samples, labels, weights)
    monkeypatch.setattr(quality, "EPOCHS", 1)  # all samples are one batch, so this is one step
    after = quality.train(samples, labels, weights)
    values = [start.filters.astype(float), start.bias.astype(float), start.weights.copy(), np.array([start.constant])]
    moved = [after.filters, after.bias, after.weights, np.array([after.constant])]
    checked = 0
    picks = [(0, (o, b, f)) for o in range(8) for b in range(97, 105) for f in range(0, quality.FILTERS, 6)]
    picks += [(1, (f,)) for f in range(quality.FILTERS)] + [(2, (k,)) for k in range(3 * quality.FILTERS)] + [(3, (0,))]
    for which, place in picks:
        losses = []
        for sign in (1, -1):
            changed = [v.copy() for v in values]
            changed[which][place] += sign * 1e-5
            losses.append(plain_loss(samples, labels, weights, *changed[:3], changed[3][0]))
        slope = (losses[0] - losses[1]) / 2e-5
        if abs(slope) > 1e-4:
            # the first step of Adam moves every parameter by the rate against the sign of its slope
            assert np.isclose(moved[which][place] - values[which][place], -quality.RATE * np.sign(slope), rtol=0.01)
            checked += 1
    assert checked > 100
