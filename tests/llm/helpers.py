"""Fixtures that several tests of this folder use."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, partitions=3):
    """Rows (doc_id, text[, lang[, source]]) as a documents table."""
    full = [(*r, *("en", "a")[len(r) - 2:], len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def sentences(n, words=40, seed=0, pool=400):
    import random
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(pool)]
    return [" ".join(rng.choice(vocabulary) for _ in range(words)) for _ in range(n)]


ODD = [(None, "no id at all here"), (7, None), (8, ""), (9, " \t\n "), (10, "same words"), (10, "same words"),
       (11, "Ärger, naïve 日本語  x"), (12, "long " * 20_000)]
