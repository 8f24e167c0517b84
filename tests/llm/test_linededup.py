import hashlib
import random

from helpers import ODD, WORD, frame

from tillhouse.llm.linededup import dedup_lines, dedup_passages


def chunks(text):
    lines = text.split("\n")
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    h = [md5(x) for x in lines]
    r = [md5((h[i - 1] if i else "") + x) for i, x in enumerate(h)]
    starts = [0] + [i + 1 for i in range(1, len(lines) - 1) if r[i] < r[i - 1] and r[i] <= r[i + 1]]
    return ["\n".join(lines[a:b]) for a, b in zip(starts, [*starts[1:], len(lines)])]


def brute(rows):
    seen, out = {}, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept = []
        for c in chunks(text or ""):
            if "\n" in c and WORD.search(c) and seen.setdefault(c, doc_id) != doc_id:
                continue
            kept.append(c)
        out.append((doc_id, None if text is None else "\n".join(kept)))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(5)
    passages = [[f"line {p} {i} of a passage" for i in range(rng.randint(3, 9))] for p in range(6)]
    rows = [r for r in ODD if r[0] is not None and r[0] != 10]
    for i in range(60):
        lines = [f"own {i} {j} {rng.random()}" for j in range(rng.randint(0, 12))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = p
        rows.append((100 + i, "\n".join(lines)))
    docs = frame(spark, rows).selectExpr("*", "'x' as removed", "1 as key", "2 as Lines", "3 as gone")
    out = dedup_lines(docs)
    assert out.columns == [*docs.columns, "_removed"]
    got = out.select("doc_id", "text", "_removed", "removed").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(brute(rows), key=repr)
    assert sum(r._removed.chunks for r in got) > 10 and {r.removed for r in got} == {"x"}


def test_rows_given_twice_keep_alike_and_copies_go(spark):
    text = "\n".join(f"line {i}" for i in range(8))
    body = [c for c in chunks(text)]
    got = dedup_lines(frame(spark, [(1, text), (1, text), (2, text), (None, text), (None, text)])).collect()
    left = "\n".join(c for c in body if "\n" not in c)
    assert sorted((r.doc_id or 9, r.text) for r in got) == [(1, text), (1, text), (2, left), (9, left), (9, left)]


def test_boundaries_shift_with_insertions():
    text = [f"line {i}" for i in range(60)]
    before, after = (set(chunks("\n".join(x))) for x in (text, text[:20] + ["new line"] + text[20:]))
    assert len(before & after) >= len(before) - 3


def test_empty(spark):
    assert dedup_lines(frame(spark, [(1, "x")]).limit(0)).count() == 0


def passages_brute(rows):
    """Lines with a word that stand earlier, with a neighbour or, if long, alone; runs of over 50 words go, and chunks."""
    seen, seen_chunks, out = set(), set(), {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if WORD.search(x)]
        covered, gone = set(), set()
        for k, i in enumerate(full):
            units = [(1, lines[i])] if len(WORD.findall(lines[i])) > 50 else []
            units += [(2, lines[i], lines[full[k + 1]])] if k + 1 < len(full) else []
            for u in units:
                if u in seen:
                    covered |= set(range(k, k + u[0]))
                seen.add(u)
        for k in sorted(covered):
            if k - 1 in covered:
                continue
            end = k
            while end + 1 in covered:
                end += 1
            inside = range(full[k], full[end] + 1)
            if sum(len(WORD.findall(lines[i])) for i in inside) > 50:
                gone |= set(inside)
        at = 0
        for c in chunks(text):
            n = c.count("\n") + 1
            if n > 1 and WORD.search(c):
                if c in seen_chunks:
                    gone |= set(range(at, at + n))
                seen_chunks.add(c)
            at += n
        out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_planted_passages_of_one_to_six_lines_go(spark):
    rng = random.Random(8)
    # 60 words each, in 1 to 6 lines, between lines that stand once; a short one that is no passage
    passages = [[" ".join(f"w{n}x{i}x{j}" for j in range(60 // n)) for i in range(n)] for n in range(1, 7)]
    own = lambda d, n: [f"own {d} {i} {rng.random()}" for i in range(n)]
    rows, want = [], {}
    for d in range(90):
        p = passages[d % 6]
        before, after = own(d, rng.randint(1, 6)), own(f"{d}b", rng.randint(1, 6))
        rows.append((d, "\n".join([*before, *p, *after])))
        want[d] = rows[-1][1] if d < 6 else "\n".join(before + after)
    rows.append((90, "\n".join([*own(90, 2), *passages[5][:2], *own("90b", 2)])))
    want[90] = rows[-1][1]
    got = {r.doc_id: r for r in dedup_passages(frame(spark, rows)).collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(got[d].removed.lines == d % 6 + 1 and len(got[d].removed.spans) == 1 for d in range(6, 90))
    chunks_only = {r.doc_id: r.text for r in dedup_lines(frame(spark, rows)).collect()}
    assert sum(chunks_only[d] != want[d] for d in range(91)) > 60


def test_passages_equal_brute_force(spark):
    rng = random.Random(6)
    pool = [[" ".join(f"p{p}w{i}x{j}" for j in range(rng.randint(1, 30))) for i in range(rng.randint(1, 7))] for p in range(8)]
    rows = []
    for d in range(120):
        lines = [f"own {d} {j} {rng.random()}" for j in range(rng.randint(0, 8))]
        for p in rng.sample(pool, rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = rng.choice([p, p[1:], [x for line in p for x in (line, "", " ")]])
        lines += [lines[0]] * rng.choice([0, 0, 9]) if lines else []
        rows.append((d, "\n".join(lines)))
    docs = frame(spark, rows).selectExpr("*", "'x' as removed", "1 as key", "2 as Lines", "3 as runs")
    out = dedup_passages(docs)
    assert out.columns == [*docs.columns, "_removed"]
    assert {r.doc_id: r.text for r in out.collect()} == passages_brute(rows)


def test_passages_odd_rows(spark):
    text = "\n".join(f"line {i} " + "word " * 9 for i in range(8))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, text), (7, None), (8, ""), (9, " \t\n ")]
    got = sorted((r.doc_id or 99, r.text) for r in dedup_passages(frame(spark, rows)).collect() if r.doc_id != 7)
    assert got == [(1, text), (1, text), (2, ""), (8, ""), (9, " \t\n "), (99, ""), (99, "")]
    assert [r.text for r in dedup_passages(frame(spark, rows)).where("doc_id = 7").collect()] == [None]
    assert dedup_passages(frame(spark, rows).limit(0)).count() == 0
