import hashlib

import xxhash
from helpers import ODD, WORD, frame, sentences
from pyspark.sql import functions as F

from tillhouse.llm.fingerprints import LIMIT, fingerprint_documents, likeness, merge, with_hashes, with_sketch


def test_edits_and_next_document(spark):
    rows = [(100 + i * 7, t) for i, t in enumerate(sentences(50, 70))] + [r for r in ODD if r[0] != 10]
    docs = frame(spark, rows, 5).selectExpr("*", "1 as id", "2 as half", "3 as sketch")
    got = {r.doc_id: r for r in fingerprint_documents(docs).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    assert len(got) == len(rows)
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        assert got[doc_id].n_chars == len(text)
        assert got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[doc_id].near_next <= 1 and 0 <= got[doc_id].near_edited <= 1


def test_equal_texts_equal_prints(spark):
    text = " ".join(sentences(1, 300))
    got = {r.doc_id: r for r in fingerprint_documents(frame(spark, [(3, text), (2, text), (1, None)])).collect()}
    assert got[3].fingerprint == got[2].fingerprint != "" and got[3].near_next == 1.0
    assert got[1].fingerprint == "" and got[1].near_edited == 1.0 and got[1].near_next == 0.0


def test_repeated_ids_keep_their_rows(spark):
    got = fingerprint_documents(frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x"), (2, "q w e r t y")])).collect()
    assert len(got) == 4
    assert {r.edited_sha256 for r in got if r.doc_id == 2} == {hashlib.sha256(b"q w e x").hexdigest()}
    assert fingerprint_documents(frame(spark, [(1, "x")]).limit(0)).count() == 0


def chained(words):
    """As Spark chains several columns: the hash of one is the seed of the next."""
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h >> 1


def hashes(text):
    words = WORD.findall(text or "")
    return {chained(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {chained(words)} if words else set()


def sketch_of(full):
    return {h for h in full if h <= LIMIT} or ({min(full)} if full else set())


def brute_likeness(a, b):
    a_full, b_full = hashes(a), hashes(b)
    a_sketch, b_sketch = sketch_of(a_full), sketch_of(b_full)
    if not a_sketch or not b_sketch:
        return float(a_sketch == b_sketch)
    a_mark, b_mark = min(a_sketch) > LIMIT, min(b_sketch) > LIMIT
    if a_mark or b_mark:
        return float((a_mark and min(a_sketch) in b_full) or (b_mark and min(b_sketch) in a_full))
    return len(a_sketch & b_sketch) / min(len(a_sketch), len(b_sketch))


def test_likeness_equals_brute_force(spark):
    long = sentences(12, 120, seed=3)
    rows = []
    for i, t in enumerate(long):  # parts of a long text before and after it
        words = t.split()
        rows += [(1000 + 10 * i, " ".join(words[20:28])), (1001 + 10 * i, t), (1002 + 10 * i, " ".join(words[50:57])),
                 (1003 + 10 * i, " ".join(words[50:90])), (1004 + 10 * i, words[3])]
    rows += [r for r in ODD if r[0] != 10]
    got = {r.doc_id: r for r in fingerprint_documents(frame(spark, rows, 4)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        r = got[doc_id]
        assert r.fingerprint == "".join(f"{h:016x}" for h in sorted(sketch_of(hashes(text))))
        assert (r.near_edited, r.near_next) == (brute_likeness(text, edited), brute_likeness(text, after)), doc_id


def test_short_parts_of_long_texts_are_found_in_them(spark):
    words = " ".join(sentences(1, 1500, seed=9)).split()
    rows = [(2 * i + 1, " ".join(words[7 * i:7 * i + 8])) for i in range(200)] + [(2 * i, " ".join(words)) for i in range(200)]
    got = [r for r in fingerprint_documents(frame(spark, rows, 4)).collect() if r.doc_id % 2]
    assert [r.near_next for r in got] == [1.0] * 200


def test_texts_are_dealt_once(spark):
    plan = fingerprint_documents(frame(spark, [(i, t) for i, t in enumerate(sentences(20, 30))]))
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("REPARTITION_BY_COL") == 1 + final.count("ReusedExchange")


def test_sketch_keeps_hashes_below_the_threshold_and_merges(spark):
    a, b = sentences(2, 500)
    short, other = "just four words here", "and five other words here"
    texts = [a, b, a + " " + b, short, other]
    rows = with_sketch(with_hashes(frame(spark, list(enumerate(texts))), "text", "all"), "all", "sketch").collect()
    sketch = {r.doc_id: r.sketch for r in rows}
    assert [sketch[i] for i in range(5)] == [sorted(sketch_of(hashes(t))) for t in texts]
    both = spark.createDataFrame([(i, j, sketch[i], sketch[j], sketch[2]) for i, j in [(0, 1), (0, 3), (3, 4), (3, 3)]],
                                 "i int, j int, a array<long>, b array<long>, c array<long>")
    for r in both.select("i", "j", merge(F.col("a"), F.col("b")).alias("m"), likeness(F.col("a"), F.col("c")).alias("l")).collect():
        assert r.m == sorted(sketch_of(hashes(texts[r.i]) | hashes(texts[r.j])))
        assert r.i or r.l == 1.0
