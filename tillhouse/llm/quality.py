"""Quality rules: base limits, then robust multivariate outliers within each language and source.

All of it is DataFrame expressions. One pass over the texts makes a narrow table of statistics; the robust estimates
are found over that table alone. Minimum covariance determinant: from a start, keep the half of a group that is
nearest by Mahalanobis distance, estimate again from those, repeat. The distance below which a share of a group lies
comes from counts over logarithmic bins of the squared distance, so no group is ever gathered or sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import stored, words_of

FEATURES = ("word_length", "symbols", "punctuation", "capitals", "repeats", "dup_lines")
# Spread below which a feature is not told apart from the estimate's centre, in units of the transformed features.
FLOORS = (0.06, 0.12, 0.10, 0.10, 0.10, 0.12)
STEP = 1.0 / 256      # features are rounded to this, so sums over a group are exact and reruns agree
SHARE = 0.6           # of a group that the determinant is minimised over
STEPS = 4             # concentration steps
MIN_ROWS = 60         # smaller groups are pooled within their language, then with all small ones
BINS = 32             # per factor e of squared distance
REJECT = 0.9999999    # quantile of the chi-square distribution beyond which a document is an outlier
PRIOR_WORDS = 60      # typical words mixed into every ratio, so that a short text is not judged by a few words
PRIOR_CHARS = 5.5     # their length


def base_statistics(text: Column) -> dict[str, Column]:
    """Columns over one text column, by name; later ones use earlier ones, so they are applied one after another."""
    text = F.coalesce(text, F.lit(""))
    words, hashes, places = F.col("_words"), F.col("_hashes"), F.col("_places")
    window = F.transform(F.slice(words, 5, F.greatest(F.size(words) - 4, F.lit(0))), lambda last, i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2), F.get(words, i + 3), last))
    sorted_windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = F.col("_ordered")
    repeated = F.filter(ordered, lambda x, k: (x.h == F.get(ordered, k - 1).h) | (x.h == F.get(ordered, k + 1).h))
    covered = F.transform(places, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(places, k + 1) - x, F.lit(5))))
    nothing = F.lit(None).cast("array<struct<h:bigint,i:int>>")
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "_words": words_of(text),
        "_lines": lines,
        "_hashes": window,
        "_ordered": F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), sorted_windows).otherwise(nothing),
        "_places": F.sort_array(F.transform(repeated, lambda x: x.i)),
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
        "_n_lines": F.size("_lines"),
        "_marks": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")),
        "_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")),
    }


def _features() -> list[Column]:
    """Ratios with a prior, on scales where equal steps matter alike; rounded to STEP."""
    n = F.col("n_words") + PRIOR_WORDS
    raw = [
        F.log((F.col("word_chars") - F.col("_marks") + PRIOR_WORDS * PRIOR_CHARS) / n),
        F.log1p(10 * F.col("n_symbols") / n),
        F.log1p(3 * F.col("_marks") / n),
        F.log1p(3 * F.col("_capitals") / n),
        F.col("n_repeat_words") / n * 3,
        F.col("n_dup_lines") / (F.col("_n_lines") + 5) * 3,
    ]
    return [F.round(x / STEP) for x in raw]


def chi_square_cdf(x: float, even: int) -> float:
    term, total = 1.0, 1.0
    for k in range(1, even // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(share: float, even: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, even) < share else (low, middle)
    return low


def _moments(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, sums and sums of products: all mergeable, so hot groups are summed where they lie."""
    p = range(len(FEATURES))
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in p]]
    return rows.groupBy(*keys).agg(
        *sums, *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i in p for j in range(i + 1)])


def _estimate(moments: DataFrame, keys: Sequence[str], scale: float) -> DataFrame:
    """Centre m<i>, Cholesky factor l<i>_<j> of the scaled covariance plus the floors, and its log determinant."""
    p = range(len(FEATURES))
    mean = [F.col(f"s{i}") / F.col("n") for i in p]
    out = moments.select(*keys, *[mean[i].alias(f"m{i}") for i in p], *[
        ((F.col(f"s{i}_{j}") / F.col("n") - mean[i] * mean[j]) * scale
         + F.lit((FLOORS[i] / STEP) ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i in p for j in range(i + 1)])
    return _factor(out, keys)


def _factor(covariances: DataFrame, keys: Sequence[str]) -> DataFrame:
    p = range(len(FEATURES))
    out = covariances
    for i in p:
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            # the floors keep every pivot positive but for rounding
            out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j
                                 else rest / F.col(f"l{j}_{j}"))
    spread = F.lit(0.0)
    for i in p:
        spread = spread + F.log(f"l{i}_{i}")
    return out.select(*keys, *[f"m{i}" for i in p], *[f"l{i}_{j}" for i in p for j in range(i + 1)],
                      spread.alias("spread"))


def _with_distance(rows: DataFrame, estimate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add d2, the squared Mahalanobis distance; rows of groups without an estimate get null."""
    p = range(len(FEATURES))
    known = estimate.select(*[F.col(k).alias(f"e_{k}") for k in keys], *[c for c in estimate.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"e_{k}"))
    out = rows.join(known, same, "left")
    for i in p:
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}_{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    d2 = F.lit(0.0)
    for i in p:
        d2 = d2 + F.col(f"y{i}") * F.col(f"y{i}")
    return out.select(*rows.columns, d2.alias("d2"))


def _nearest_moments(rows: DataFrame, estimate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of the rows of each group within the distance that holds SHARE of it.

    Moments are summed by group and bin of the distance, where the rows lie; a group's few hundred bins are all that
    meets afterwards, to be taken from the nearest on until they hold the share.
    """
    near = _with_distance(rows, estimate, keys).withColumn(
        "bin", F.coalesce(F.floor(F.log(F.col("d2") + 1e-9) * BINS).cast("int"), F.lit((1 << 31) - 1)))
    # stored, so that it is dealt by bin as well: for the windows alone Spark would deal all of a group to one task
    bins = stored(_moments(near, [*keys, "bin"]), "quality-bins")
    group = Window.partitionBy(*keys)
    nearer = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = bins.withColumn("nearer", nearer).withColumn("all", F.sum("n").over(group)).where(F.col("nearer") < F.col("all") * SHARE)
    return taken.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in bins.columns if c not in (*keys, "bin")])


def _spread_start(rows: DataFrame) -> DataFrame:
    """Medians and quartile spreads of each feature, from counts of its rounded values."""
    p = range(len(FEATURES))
    long = rows.select("grp", F.posexplode(F.array(*[F.col(f"x{i}") for i in p])).alias("i", "v"))
    counts = long.groupBy("grp", "i", "v").agg(F.count(F.lit(1)).alias("c"))
    feature = Window.partitionBy("grp", "i")
    counts = (counts.withColumn("upto", F.sum("c").over(feature.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("all", F.sum("c").over(feature)))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("v")))
    per = counts.groupBy("grp", "i").agg(quartile(0.25).alias("q1"), quartile(0.5).alias("q2"), quartile(0.75).alias("q3"))
    per = per.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col(q))).alias(f"{q}_{i}")
                                   for i in p for q in ("q1", "q2", "q3")])
    per = per.select("grp", F.lit(0).alias("start"), *[F.col(f"q2_{i}").alias(f"m{i}") for i in p], *[
        (F.pow((F.col(f"q3_{i}") - F.col(f"q1_{i}")) / 1.349, F.lit(2)) + (FLOORS[i] / STEP) ** 2 if i == j
         else F.lit(0.0)).alias(f"c{i}_{j}") for i in p for j in range(i + 1)])
    return _factor(per, ["grp", "start"])


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant centre and factor per grp, of rows (grp, x0..): from two starts, medians and
    plain moments, STEPS concentration steps each; the smaller determinant wins and is estimated once more from all
    rows that it takes for ordinary."""
    p, keys = len(FEATURES), ["grp", "start"]
    radius = chi_square_quantile(SHARE, p)
    scale = SHARE / chi_square_cdf(radius, p + 2)
    plain = _estimate(_moments(rows, ["grp"]), ["grp"], 1.0).withColumn("start", F.lit(1))
    estimate = stored(_spread_start(rows).unionByName(plain), "quality-start")
    twice = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for step in range(STEPS):
        estimate = stored(_estimate(_nearest_moments(twice, estimate, keys), keys, scale), f"quality-step{step}")
    columns = [c for c in estimate.columns if c not in ("grp", "spread")]
    best = (estimate.groupBy("grp").agg(F.min(F.struct("spread", *columns)).alias("b")).select("grp", "b.*"))
    best = stored(best.drop("start"), "quality-best")
    usual = chi_square_quantile(0.99, p)
    ordinary = _with_distance(rows, best, ["grp"]).where(F.col("d2") <= usual)
    again = 0.99 / chi_square_cdf(usual, p + 2)
    return stored(_estimate(_moments(ordinary, ["grp"]), ["grp"], again), "quality-final")


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          min_words: int = 10, max_repeat_percent: int = 20, reject: float = REJECT,
          carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    distance2 (null where base_failed), and `carried`, a struct of the carried columns, if any are named.

    Null texts have no words and fail. Null languages and sources are groups of their own. Documents that fail the
    base rules take no part in the estimates. Groups below MIN_ROWS are pooled within their language, then among
    all; a pool that is still smaller judges nobody, so its documents are kept. Null ids and repeated rows are
    ordinary, every row gets its verdict; an empty table gives none. Other columns are ignored.
    """
    out = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang"),
                      F.col(source).alias("_source"), *([F.struct(*carry).alias("carried")] if carry else []))
    for name, column in base_statistics(F.col("_text")).items():
        out = out.withColumn(name, column)
    out = out.withColumn("base_failed", (F.col("n_words") < min_words)
                         | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    named = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    table = stored(out.select(*named, "_lang", "_source", *[x.alias(f"x{i}") for i, x in enumerate(_features())],
                              *(["carried"] if carry else [])), "quality-docs")
    groups = table.where("not base_failed").groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n"))
    # three names, none of which another level can take: both, the language's rest, the rest of all
    groups = (groups.withColumn("own", F.col("n") >= MIN_ROWS)
              .withColumn("pool", F.sum(F.when(~F.col("own"), F.col("n"))).over(Window.partitionBy("_lang")))
              .withColumn("grp", F.when(F.col("own"), F.to_json(F.array(F.lit("own"), "_lang", "_source")))
                          .when(F.col("pool") >= MIN_ROWS, F.to_json(F.array(F.lit("lang"), "_lang")))
                          .otherwise(F.lit("rest")))
              .select(F.col("_lang").alias("g_lang"), F.col("_source").alias("g_source"), "grp"))
    groups = stored(groups, "quality-groups")
    member = F.col("_lang").eqNullSafe(F.col("g_lang")) & F.col("_source").eqNullSafe(F.col("g_source"))
    x = [f"x{i}" for i in range(len(FEATURES))]
    rows = table.where("not base_failed").select("_lang", "_source", *x).join(groups, member).select("grp", *x)
    estimates = robust_estimates(rows)
    large = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_ROWS).select("grp")
    estimates = stored(estimates.join(large, "grp", "left_semi"), "quality-large")
    judged = _with_distance(table.join(groups, member, "left").drop("g_lang", "g_source"), estimates, ["grp"])
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    far = chi_square_quantile(reject, len(FEATURES))
    return judged.select(*named, (~F.col("base_failed") & F.coalesce(distance <= far, F.lit(True))).alias("kept"),
                         distance.alias("distance2"), *(["carried"] if carry else []))


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    out = judge(docs, carry=docs.columns, **options).where("kept")
    return out.select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])
