import random
from collections import Counter

import numpy as np
from helpers import ODD, WORD, frame, sentences

from tillhouse.llm.quality import (
    BINS,
    FLOORS,
    SHARE,
    STEP,
    STEPS,
    chi_square_cdf,
    chi_square_quantile,
    judge,
    kept_documents,
    robust_estimates,
)


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_base_equals_brute_force(spark):
    rng = random.Random(3)
    rows = ODD + [(100 + i, " ".join(rng.choice("ab cd# ef\n g*".split(" ")) for _ in range(rng.randint(1, 60))))
                  for i in range(120)]
    rows += [(300, "a b c d e f a b c d e"), (301, "x y z w v x y z w v x"), (302, "\n\na\na\n b\na")]
    docs = frame(spark, rows).selectExpr("*", "1 as n_words", "2 as grp", "3 as x0")
    got = judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((r[0], *base(r[1]))) for r in rows)


def test_outliers_go_and_clean_stays(spark):
    rows, junk = [], set()
    for i, text in enumerate(sentences(400, 80, pool=3000)):
        if i % 7 == 0:
            junk.add(i)
            text = " ".join(w + "%#&$"[j % 4] * 3 for j, w in enumerate(text.split()))
        rows.append((i, text, ["en", "de", None][i % 3], ["s", None][i % 2]))
    docs = frame(spark, rows)
    kept = {r.doc_id for r in kept_documents(docs).collect()}
    assert kept == {i for i in range(400)} - junk
    again = {(r.doc_id, r.distance2) for r in judge(docs).collect()}
    assert again == {(r.doc_id, r.distance2) for r in judge(docs.repartition(5)).collect()}


def test_columns_and_small_pools(spark):
    docs = frame(spark, [(1, " ".join("abcdefghijklm")), (2, "short")]).selectExpr("*", "1 as kept", "2 as carried", "3 as D2")
    out = kept_documents(docs)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [1]
    assert judge(docs.limit(0)).count() == 0


def test_chi_square():
    rng = np.random.default_rng(0)
    x = (rng.standard_normal((200_000, 6)) ** 2).sum(axis=1)
    q = chi_square_quantile(.6, 6)
    assert abs((x <= q).mean() - .6) < .01 and abs(chi_square_cdf(q, 6) - .6) < 1e-9


def brute_estimate(x):
    n, p = x.shape
    floors = np.diag((np.array(FLOORS) / STEP) ** 2)
    radius, usual = chi_square_quantile(SHARE, p), chi_square_quantile(.99, p)

    def estimate(rows, scale):
        mean = rows.mean(axis=0)
        return mean, np.linalg.cholesky((rows.T @ rows / len(rows) - np.outer(mean, mean)) * scale + floors)

    def distances(centre, factor):
        return (np.linalg.solve(factor, (x - centre).T) ** 2).sum(axis=0)

    ordered = np.sort(x, axis=0)
    q1, q2, q3 = (ordered[int(np.ceil(n * q)) - 1] for q in (.25, .5, .75))
    found = []
    for now in ((q2, np.sqrt(np.diag(((q3 - q1) / 1.349) ** 2) + floors)), estimate(x, 1.0)):
        for _ in range(STEPS):
            bins = np.floor(np.log(distances(*now) + 1e-9) * BINS)
            last = np.sort(bins)[int(np.ceil(n * SHARE)) - 1]
            now = estimate(x[bins <= last], SHARE / chi_square_cdf(radius, p + 2))
        found.append((np.log(np.diag(now[1])).sum(), now))
    best = min(found, key=lambda f: f[0])[1]
    return estimate(x[distances(*best) <= usual], .99 / chi_square_cdf(usual, p + 2))


def test_estimates_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    groups = {}
    for name, n, bad in (("a", 900, 200), ("b", 120, 0), ("c", 333, 100)):
        good = rng.normal(size=(n - bad, 6)) @ rng.normal(size=(6, 6)) * 40 + 100
        groups[name] = np.rint(np.vstack([good, rng.normal(size=(bad, 6)) * 20 + 900]))
    rows = [(g, *map(float, r)) for g, x in groups.items() for r in x]
    df = spark.createDataFrame(rows, "grp string, " + ", ".join(f"x{i} double" for i in range(6))).repartition(5)
    for r in robust_estimates(df).collect():
        centre, factor = brute_estimate(groups[r.grp])
        np.testing.assert_allclose([r[f"m{i}"] for i in range(6)], centre, rtol=1e-7)
        np.testing.assert_allclose([r[f"l{i}_{j}"] for i in range(6) for j in range(i + 1)],
                                   [factor[i, j] for i in range(6) for j in range(i + 1)], rtol=1e-6, atol=1e-6)
