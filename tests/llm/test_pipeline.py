from collections import Counter

import corpus_pipeline
from helpers import sentences
from test_linededup import passages_brute
from test_mixing import brute as brute_mix
from test_quality_rules import base
from test_simhash import groups, print_of

from tillhouse.llm.common import scratch_paths
from tillhouse.sources.sinks import exists


def test_stages_against_brute_force(spark, tmp_path):
    rows = []
    for i, text in enumerate(sentences(150, 60, pool=2000)):
        words = text.split()
        rows.append((i, "\n".join(" ".join(words[j:j + 10]) for j in range(0, 60, 10)), "en", "ab"[i % 2], len(text)))
    shared = rows[0][1]
    # a passage of 60 words as one line, which no chunk of several lines holds
    passage = sentences(1, 60, seed=11)[0]
    rows += [(600 + i, f"{t}\n{passage}\nlast line {i}", "en", "b", 1) for i, t in enumerate(sentences(6, 40, seed=13))]
    rows += [(200 + i, shared + f"\nown line {i} " + t, "en", "a", 1) for i, t in enumerate(sentences(10, 30, seed=9))]
    rows += [(300 + i, rows[i][1], "en", "b", 1) for i in range(10)]
    rows += [(400 + i, "few words", "en", "a", 1) for i in range(3)] + [(500, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "pack_sequences"]

    docs, stages = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        stages[name] = docs.collect()
        assert name == names[-1] or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    kept = {r.doc_id for r in stages["quality_rules"]}
    assert kept == {r[0] for r in rows if not base(r[1])[-1]}
    lines = {r.doc_id: r.text for r in stages["line_dedup"]}
    want = passages_brute([(r.doc_id, r.text) for r in stages["quality_rules"]])
    assert lines == want and sum(len(t) for t in want.values()) < sum(len(r.text) for r in stages["quality_rules"])
    assert [passage in lines[600 + i] for i in range(6)] == [True] + [False] * 5
    ids = sorted(lines)
    roots = groups([print_of(lines[i]) for i in ids])
    assert {r.doc_id for r in stages["near_dedup"]} == {ids[g] for g in set(roots)}
    mixed = brute_mix([(r.doc_id, r.text, r.lang, r.source) for r in stages["near_dedup"]])
    copies = Counter(r.doc_id for r in stages["mix_sources"])
    assert {d: n for d, n in copies.items() if lines[d].strip()} == {d: taken // size for d, size, _, _, taken in mixed if taken}
    pieces = Counter(r.doc_id for r in stages["pack_sequences"] if r.piece == 0)
    assert pieces == copies
    already = set(scratch_paths())
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert sum(exists(spark, p) for p in set(scratch_paths()) - already) <= 5
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in result.collect()) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in stages["pack_sequences"])
