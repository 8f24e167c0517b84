import hashlib
from collections import defaultdict

import duckdb
import pytest

from helpers import ODD, WORD, frame, sentences
from tillhouse.llm.mixing import mix, mixed_documents
from tillhouse.llm.queries import ORACLES, QUERIES


def brute(rows, weights=(5, 2, 1), share=1.5):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    source = [r[3] if len(r) > 3 else "a" for r in rows]
    total = defaultdict(int)
    for s, n in zip(source, size):
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(total.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * total[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in full}
        left -= sum(2 * total[s] for s in full)
        open_ -= full
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    h = [md5(f"{'' if r[0] is None else r[0]}:{md5(r[1] or '')}")[:15] for r in rows]
    out = []
    for i, r in enumerate(rows):
        s = source[i]
        passes = int(target[s] / total[s]) if total[s] else 0
        rest = target[s] - passes * total[s]
        same = sum(n for n, t, k in zip(size, source, h) if t == s and k == h[i])
        below = sum(n for n, t, k in zip(size, source, h) if t == s and k < h[i])
        copies = min(2, passes + (below + same / 2 <= rest))
        out.append((r[0], size[i], total[s], round(target[s], 6), copies * size[i]))
    return out


def key(rows):
    return sorted(rows, key=repr)


def test_equals_brute_force(spark):
    rows = [(i, t, "en", s) for i, (t, s) in enumerate(zip(sentences(90, 30), ["b", None, "a", "b", "b", "é"] * 15))]
    rows += [(r[0], r[1], "en", "a") for r in ODD]
    got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mix(frame(spark, rows)).collect()]
    assert key(got) == key(brute(rows))


def test_mixed_rows_repeat_and_keep_columns(spark):
    rows = [(i, t, "en", "ab"[i % 2]) for i, t in enumerate(sentences(40, 25))]
    docs = frame(spark, rows).selectExpr("*", "1 as copies", "2 as H", "3 as target")
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.copies for r in mix(docs).collect()}
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in taken.items() if v}


def test_nested(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(sentences(60, 20))])
    small = {r.doc_id: r.copies for r in mix(docs, share=.3).collect()}
    large = {r.doc_id: r.copies for r in mix(docs, share=.8).collect()}
    assert all(large[k] >= v for k, v in small.items()) and sum(large.values()) > sum(small.values())


def test_empty(spark):
    assert mix(frame(spark, [(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_mix_sources", "op5_line_dedup"])
def test_oracle(spark, name):
    path = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, path).toPandas()
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{path}/documents.parquet'")
    want = db.sql(ORACLES[name]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a, b = (x[columns].sort_values("doc_id").reset_index(drop=True) for x in (got, want))
    assert a.astype(str).equals(b.astype(str))
