import hashlib
from collections import Counter

import pytest
import sentencepiece
from helpers import ODD, frame, sentences
from tokenizers import Tokenizer

from tillhouse.llm import tokenalign
from tillhouse.llm.tokenalign import A_FILE, B_FILE, Aligner, align_tokenizers, byte_level_alphabet, public_path

TEXTS = ["it's <|endoftext|> and </s> <unk> twice", "a ▁ lower block", "  two  blanks\n\n\ttab  ", "ﬁne ①  ½ naïve 日本語 🙂👩‍👩‍👧",
         "one\n two \t three\u3000 four\x1c five\u2581 six ", " lead", "trail ", "a  b   c", "é è ü\n\n  z", "\n", "a\u00a0 b \u2009c", "it' s 's",
         "=" * 700, "ab" * 3000, "1234567890" * 40, "\x00\x01 odd \x7f", " ", "x"]


def brute(texts):
    whole = Tokenizer.from_file(public_path(A_FILE))
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_path(B_FILE))
    alphabet = byte_level_alphabet()

    def cuts(tokens):
        at, out = 0, []
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    docs = []
    for text in texts:
        groups = []
        if text:
            a = [(i, bytes(alphabet[c] for c in whole.id_to_token(i)))
                 for i in whole.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode())
                 for i in model.encode(text) for p in [model.id_to_piece(i)]]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a, b = cuts(a), cuts(b)
                ends = sorted({e for *_, e in a} & {e for *_, e in b})
                groups = [([i for i, s, e in a if lo <= s and e <= hi], [i for i, s, e in b if lo <= s and e <= hi])
                          for lo, hi in zip([0, *ends], ends)]
        docs.append((groups, Counter((x, y) for xs, ys in groups for x in xs for y in ys)))
    count = Counter(p for _, links in docs for p in links)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for groups, links in docs:
        written = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return out


def test_equals_brute_force(spark):
    rows = [(100 + i, t) for i, t in enumerate(sentences(60, 50))] + ODD[:-1] + [(12, "long " * 300)]
    rows += [(300 + i, t) for i, t in enumerate(TEXTS)] + [(400, TEXTS[0]), (400, TEXTS[0])]
    docs = frame(spark, rows, 4).selectExpr("*", "1 as block", "2 as pair", "3 as kind")
    got = [tuple(r) for r in align_tokenizers(docs).collect()]
    want = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows]), strict=True)]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("expand", [1, 7, 1000])
def test_blocks_do_not_depend_on_how_much_is_written_out_at_once(monkeypatch, expand):
    aligner = Aligner(public_path(A_FILE), public_path(B_FILE))
    texts = [None, *TEXTS, "", *sentences(3, 30)]
    want = aligner.block(texts)
    monkeypatch.setattr(tokenalign, "EXPAND", expand)
    got = aligner.block(texts)
    assert all(list(w) == list(g) for w, g in zip(want, got, strict=True))
    # a single token on each side is counted in the vector; what is left for the shuffle is no identity pair
    code = got.pair % (aligner.n_a * aligner.n_b)
    assert (aligner.same[code // aligner.n_b] != code % aligner.n_b).all()


def test_text_ids_and_empty_tables(spark):
    docs = frame(spark, [(1, "some words here"), (2, "more words")]).selectExpr("concat('d', doc_id) as doc_id", "text")
    got = align_tokenizers(docs)
    assert {r.doc_id for r in got.collect()} == {"d1", "d2"}
    assert align_tokenizers(docs.limit(0)).count() == 0
