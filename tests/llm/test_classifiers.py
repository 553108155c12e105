"""The risk of operator 6 and the network of operator 5 against plain loops."""

import math
import zlib

import numpy as np
import pytest

from ridelake.llm import quality, toxicity


def soft(z):
    return max(z, 0) + math.log1p(math.exp(-abs(z)))


def plain_risk(w, positive, unlabelled, prior, decay):
    """pi E_P[l(f, +)] + max(0, E_U[l(f, -)] - pi E_P[l(f, -)]) and the decay, document by document."""
    def score(s):
        return w[0] + sum(w[c] for c in s)
    plus = sum(soft(-score(s)) for s in positive) / len(positive)
    minus_p = sum(soft(score(s)) for s in positive) / len(positive)
    minus_u = sum(soft(score(s)) for s in unlabelled) / len(unlabelled)
    return prior * plus + max(0.0, minus_u - prior * minus_p) + decay / 2 * sum(x * x for x in w[1:])


def packed(docs):
    found = {}
    for s in docs:
        key = np.array(sorted(s), "<i4").tobytes()
        found[key] = found.get(key, 0) + 1
    return list(found), np.array(list(found.values()))


def example(seed, clamped):
    rng = np.random.default_rng(seed)
    draw = lambda n, p: [set((np.flatnonzero(rng.random(6) < p) + 1).tolist()) for _ in range(n)]
    positive, unlabelled = draw(30, 0.5), draw(80, 0.2)
    w = rng.normal(size=7)
    if clamped:  # unlabelled text scored low and confirmed high: the corrected risk falls below zero
        positive, unlabelled = [{1}] * 30, [set()] * 70 + [{1}] * 10
        w = np.array([-6.0, 14, 0, 0, 0, 0, 0])
    return positive, unlabelled, w


@pytest.mark.parametrize("clamped", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_risk_and_gradient(seed, clamped):
    positive, unlabelled, w = example(seed, clamped)
    prior, decay = 0.3, 0.01
    p, u = packed(positive), packed(unlabelled)

    def value(x):
        return toxicity.risk(x, toxicity.parts_of(x, *p), toxicity.parts_of(x, *u), prior, decay)

    got, gradient = value(w)
    assert abs(got - plain_risk(w, positive, unlabelled, prior, decay)) < 1e-9
    minus = (np.mean([soft(w[0] + sum(w[c] for c in s)) for s in unlabelled])
             - prior * np.mean([soft(w[0] + sum(w[c] for c in s)) for s in positive]))
    assert (minus < 0) == clamped
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-5
        around = [plain_risk(w + s, positive, unlabelled, prior, decay) for s in (step, -step)]
        assert abs((around[0] - around[1]) / 2e-5 - gradient[i]) < 1e-6


def test_the_fit_lowers_the_risk_to_its_least():
    positive, unlabelled, _ = example(5, False)
    p, u = packed(positive), packed(unlabelled)

    def value(x):
        return toxicity.risk(x, toxicity.parts_of(x, *p), toxicity.parts_of(x, *u), 0.2, 0.01)

    w = toxicity.minimise(value, np.zeros(7), 200)
    rng = np.random.default_rng(0)
    assert all(value(w)[0] <= value(w + rng.normal(size=7) * s)[0] + 2e-4 for s in (0.01, 0.1, 1, 5) for _ in range(20))
    assert value(w)[0] < value(np.zeros(7))[0]


def test_all_unlabelled_rows_count(spark):
    """Nothing is left out of the unlabelled text: its counts are those of all rows of the fold."""
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('word', id % 7, ' common') AS text")
    counts, n = toxicity._counts(docs, None)
    common = zlib.crc32(b"common") & (toxicity.BUCKETS - 1)
    assert n == 500 and counts[common] == 500
    assert counts[zlib.crc32(b"word3") & (toxicity.BUCKETS - 1)] == len([i for i in range(500) if i % 7 == 3])


def test_trained_weights_are_those_of_a_single_process(spark):
    bad = ["awful", "nasty"]
    rows = [(i, f"plain text {i % 5} " + (bad[i % 2] if i % 4 == 0 else "fine")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    scorer = toxicity.train(docs, labels)
    fold = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    confirmed = [i for i in fold if i % 4 == 0 and i < 200]
    prior = len(confirmed) / len([i for i in fold if i < 200])
    sets = {i: toxicity.buckets_of(rows[i][1].encode()) for i in fold}
    support, common = (np.bincount(np.concatenate([sets[i] for i in ids]), minlength=toxicity.BUCKETS) for ids in (confirmed, fold))
    kept = np.flatnonzero((support >= min(toxicity.LEAST_SUPPORT, max(1, len(confirmed) // 20)))
                          & (support / len(confirmed) >= toxicity.LEAST_LIFT * common / len(fold)))
    p, u = (packed([set((np.searchsorted(kept, b[np.isin(b, kept)]) + 1).tolist()) for b in (sets[i] for i in ids)]) for ids in (confirmed, fold))
    start = np.zeros(len(kept) + 1)
    start[0] = math.log(prior / (1 - prior))
    w = toxicity.minimise(lambda x: toxicity.risk(x, toxicity.parts_of(x, *p), toxicity.parts_of(x, *u), prior, toxicity.DECAY), start)
    assert abs(scorer.base - w[0]) < 1e-6 and np.abs(scorer.weights[kept] - w[1:]).max() < 1e-5
    assert scorer.score(b"an awful text") > 0.5 > scorer.score(b"a fine text")


def test_forward_against_plain_loops():
    model = quality.GatedAttention()
    docs = [b"a b c " * 60, b"", b"X!! Y!! " * 40, b"one"]
    buckets, first, stats, doc_first = quality.encode_passages(docs)
    got = model.forward(buckets, first, stats, doc_first)["score"]
    p = model.weights
    ends = [*first[1:], len(buckets)]
    for k in range(len(docs)):
        last = doc_first[k + 1] if k + 1 < len(docs) else len(first)
        hidden, raw = [], []
        for j in range(doc_first[k], last):
            mean = sum(p["words"][b].astype(float) for b in buckets[first[j]:ends[j]]) / (ends[j] - first[j])
            x = np.concatenate([(stats[j] - model.mean) / model.scale, mean])
            h = np.array([math.tanh(sum(x[i] * p["w"][i, c] for i in range(len(x))) + p["b"][c]) for c in range(p["w"].shape[1])])
            t = [math.tanh(float(h @ p["v"][:, c])) for c in range(p["v"].shape[1])]
            s = [1 / (1 + math.exp(-float(h @ p["u"][:, c]))) for c in range(p["u"].shape[1])]
            hidden.append(h)
            raw.append(sum(a * b * c for a, b, c in zip(t, s, p["a"], strict=True)))
        share = np.exp(np.array(raw) - max(raw))
        share /= share.sum()
        z = sum(a * h for a, h in zip(share, hidden, strict=True))
        assert abs(1 / (1 + math.exp(-float(z @ p["c"] + p["d"][0]))) - got[k]) < 1e-4


def test_gradients_of_words_and_biases():
    model = quality.GatedAttention()
    bag = quality.encode_passages([b"a b c " * 60, b"", b"X!! Y!! " * 40])
    y = np.array([1, 0, 1], np.float32)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        s = model.forward(*bag)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = model.gradients(bag, y)
    places = [("b", i) for i in (0, 1)] + [("d", 0)] + [("words", int(bag[0][0]) * model.weights["words"].shape[1] + c) for c in (0, 3)]
    for k, i in places:
        flat = model.weights[k].reshape(-1)
        old, around = flat[i], []
        for step in (1e-4, -1e-4):
            flat[i] = old + step
            around.append(loss())
        flat[i] = old
        assert abs((around[0] - around[1]) / 2e-4 - grads[k].reshape(-1)[i]) < 1e-3
