import random
import zlib

import numpy as np
from helpers import ODD, frame, sentences

from tillhouse.llm.toxicity import (
    CHAR_BITS, WINDOW, WORD_BITS, Network, Scorer, score_toxicity, train, windows_of, words_of)


def corpus(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i, text in enumerate(sentences(n, 90, seed=seed)):
        toxic = i % 4 == 0
        words = text.split()
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["badword", "grimly" + rng.choice("abcdef")]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_windows_cover_and_overlap():
    for n in (0, 1, WINDOW, WINDOW + 1, 100, 1000):
        starts = windows_of(n)
        assert set(range(n)) <= {p for s in starts for p in range(s, s + WINDOW)}
        assert all(b - a < WINDOW for a, b in zip(starts, starts[1:]))


def test_gradients():
    rng = np.random.default_rng(1)
    net = Network(np.zeros(1 << WORD_BITS, np.float32), np.zeros(1 << CHAR_BITS, np.float32))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = [b"one", b"two", b"three", b"four"]
    index, labels = rng.integers(0, 5, (3, WINDOW)), np.array([1., 0., 1.])
    grad = net.gradients(words, index, labels)

    def loss():
        z = net.forward(net.project(net.inputs(words)[0])[index], (index > 0).astype(float))
        return np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels))

    for name in grad:
        at = np.unravel_index(np.argmax(np.abs(grad[name])), grad[name].shape)
        keep = net.w[name][at]
        step = 1e-2 if name in ("word", "char") else 1e-3
        net.w[name][at] = keep + step
        up = loss()
        net.w[name][at] = keep - step
        down = loss()
        net.w[name][at] = keep
        assert abs((up - down) / (2 * step) - grad[name][at]) < 2e-3 * max(1, abs(grad[name][at])), name


def test_held_out_accuracy_and_batching():
    rows = corpus(700)
    net = train([t.encode() for _, t, _ in rows[:500]], np.array([y for *_, y in rows[:500]]), .25)
    texts = [t.encode() for _, t, _ in rows[500:]]
    p = Scorer(net).probabilities(texts)
    y = np.array([y for *_, y in rows[500:]])
    assert ((p >= .3) == y).mean() > .95
    assert np.allclose(p, [Scorer(net).probabilities([t])[0] for t in texts], atol=1e-4)
    assert Scorer(net).probabilities([b""])[0] < .3
    long = b" ".join(texts)
    assert Scorer(net).raw([long])[0] >= Scorer(net).raw(texts).max() - 1.0
    assert words_of(b"It's, OK!") == [b"its", b"ok"]


def test_job(spark):
    rows = corpus(260, 3)
    docs = frame(spark, [(i, t) for i, t, _ in rows] + ODD).selectExpr("*", "1 as toxic", "2 as score")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (5, None, None), (99999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(ODD)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= .3)
        assert r.held_out == (True if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    none = score_toxicity(docs, labels.limit(0)).collect()
    assert len({round(r.score, 9) for r in none}) == 1
    assert score_toxicity(docs.limit(0), labels).count() == 0
