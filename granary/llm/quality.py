"""Quality rules: text statistics and robust multivariate outliers by minimum covariance determinant, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.common import ws_words

#: A determinant is less than another if its logarithm is by so much.
WINDOW, SUPPORT, STABLE = 5, 0.75, 1e-3
#: Features, and the standard deviation that each has where a group's estimate is singular in it (most texts have no symbol and no equal line): log of the mean word length; log of symbols, equal lines and repeated words per word. About what one symbol or one line more makes in 300 words. Where the estimate is wider, it is left as it is.
FEATURES = {"f0": 0.01, "f1": 0.5, "f2": 0.3, "f3": 0.5}
#: Word lengths are taken with so many words of five letters more, or short texts would differ by chance alone.
PRIOR_WORDS, PRIOR_LETTERS = 30, 5
#: Random starts of each group, and how many of all starts go on after two steps.
RANDOM, BEST = 8, 3
P = len(FEATURES)
#: The 0.99999 quantile of chi square with 4 degrees of freedom.
CUTOFF = 28.47
_WS = " \t\n\x0b\f\r"


def consistency(support: float = SUPPORT) -> float:
    """What the covariance of the inner share of a 4-dimensional normal is multiplied by."""
    lo, hi = 0.0, 100.0
    for _ in range(100):
        q = (lo + hi) / 2
        lo, hi = (q, hi) if 1 - math.exp(-q / 2) * (1 + q / 2) < support else (lo, q)
    return support / (1 - math.exp(-q / 2) * (1 + q / 2 + q * q / 8))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """docs (text, ...) -> keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed. Row by row, no shuffle. Null text: zeros, failed.

    Windows are compared by 64-bit hashes within one text; the costlier listing of repeated ones runs only where the distinct count shows that there are any.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _WS, "") != "")
    d = docs.select(*keep, text.alias("_t"), ws_words(F.col("text")).alias("_w"), lines.alias("_l"))
    windows = F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)]))
    bare = F.translate("_t", _WS, "")
    d = d.select(*keep, F.size("_w").cast("long").alias("n_words"), F.length(bare).cast("long").alias("word_chars"), (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), F.when(F.size("_w") > WINDOW, windows).alias("_h"))
    pairs = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs)).drop("_h")
    again = F.transform("_s", lambda x, j: F.when(F.get("_s", j - 1)["h"].eqNullSafe(x["h"]) | F.get("_s", j + 1)["h"].eqNullSafe(x["h"]), x["i"]))
    d = d.withColumn("_p", F.array_sort(F.array_compact(again))).drop("_s")
    cover = F.aggregate(F.transform("_p", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("long")).drop("_p")
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _features() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    logs = [F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_LETTERS) / (F.col("n_words") + PRIOR_WORDS)), F.log1p(1000 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))), F.log1p(100 * F.col("n_dup_lines") / n), F.log1p(100 * F.col("n_repeat_words") / n)]
    return [F.round(x * 1000).cast("long").alias(k) for k, x in zip(FEATURES, logs)]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the Cholesky factor l_ij."""
    z: list[Column] = []
    for i in range(P):
        x = F.col(f"f{i}") - F.col(f"c{i}")
        for j in range(i):
            x = x - F.col(f"l{i}{j}") * z[j]
        z.append(x / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


#: Columns of an estimate: centre and Cholesky factor.
CENTRE, FACTOR = [f"c{i}" for i in range(P)], [f"l{i}{j}" for i in range(P) for j in range(i + 1)]
GROUP = ["lang", "source", "start"]


def _sums(rows: DataFrame, *by: str) -> DataFrame:
    """Count, sums and sums of products. Features are integers, so they are exact whatever their order."""
    products = [F.sum((F.col(f"f{i}") * F.col(f"f{j}")).cast("decimal(38,0)")).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1)]
    return rows.groupBy(*GROUP, *by).agg(F.count("*").alias("n"), *[F.sum(f"f{i}").alias(f"s{i}") for i in range(P)], *products)


def _moments(g: DataFrame, scale: float, least: list[float]) -> DataFrame:
    """Centre and Cholesky factor from the sums of each group. A pivot below ``least`` is singular and becomes that."""
    g = g.select(*GROUP, *[(F.col(f"s{i}") / F.col("n")).alias(f"c{i}") for i in range(P)], *[(F.col(f"q{i}{j}").cast("double") / F.col("n")).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1)])
    for i in range(P):
        for j in range(i + 1):
            v = (F.col(f"q{i}{j}") - F.col(f"c{i}") * F.col(f"c{j}")) * scale
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            g = g.withColumn(f"l{i}{j}", F.greatest(F.sqrt(F.greatest(v, F.lit(0.0))), F.lit(1000.0 * least[i])) if i == j else v / F.col(f"l{j}{j}"))
    return g.select(*GROUP, *CENTRE, *FACTOR)


def _inner(rows: DataFrame) -> DataFrame:
    """Sums over the rows of each group whose distances are the least SUPPORT of all. Distances are counted on a log scale, 64 steps for a doubling; the steps of a group, not its rows, are ordered."""
    bins = _sums(rows.withColumn("b", F.floor(64 * F.log2(1 + _distance()))), "b")
    w = Window.partitionBy(*GROUP)
    below = bins.withColumn("before", F.coalesce(F.sum("n").over(w.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("all", F.sum("n").over(w))
    names = [c for c in bins.columns if c not in (*GROUP, "b")]
    return below.where(F.col("before") < F.ceil(SUPPORT * F.col("all"))).groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in names])


def _with(rows: DataFrame, groups: DataFrame, *on: str) -> DataFrame:
    """Each row with the columns of its group, once for each start if ``on`` is without it."""
    r, g = rows.alias("r"), groups.alias("g")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in on]
    for c in same[1:]:
        same[0] = same[0] & c
    return r.join(g, same[0]).select("r.*", *[F.col(f"g.{c}") for c in groups.columns if c not in on])


def _starts(rows: DataFrame) -> DataFrame:
    """Starts around the coordinate-wise medians, on values divided by their quartile ranges: no correlations; those of hyperbolic tangents; of directions only; of the half nearest to the medians. And random ones, of about P + 2 rows that a hash of the values picks. Medians and ranges are exact, and merged from counts of the rounded values."""
    least = list(FEATURES.values())
    g = rows.groupBy("lang", "source").agg(*[F.percentile(f"f{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}") for i in range(P)])
    g = g.select("lang", "source", *[F.col(f"p{i}")[1].alias(f"m{i}") for i in range(P)], *[F.greatest((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, F.lit(1000.0 * x)).alias(f"w{i}") for i, x in enumerate(least)]).checkpoint()
    z = [(F.col(f"f{i}") - F.col(f"m{i}")) / F.col(f"w{i}") for i in range(P)]
    near = F.sqrt(sum((x * x for x in z[1:]), z[0] * z[0]))
    d = _with(rows, g, "lang", "source").select("lang", "source", *[x.alias(f"z{i}") for i, x in enumerate(z)], near.alias("near"))
    half = d.withColumn("b", F.floor(64 * F.log2(1 + F.col("near")))).groupBy("lang", "source").agg(F.percentile("b", 0.5).alias("half"))
    d = _with(d, half, "lang", "source")
    inner = F.floor(64 * F.log2(1 + F.col("near"))) <= F.col("half")
    kinds = [[F.tanh(f"z{i}") for i in range(P)], [F.col(f"z{i}") / F.greatest("near", F.lit(1e-9)) for i in range(P)], [F.when(inner, F.col(f"z{i}")) for i in range(P)]]
    each = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("start"), *[F.round(1000 * x).cast("long").alias(f"f{i}") for i, x in enumerate(kind)]) for k, kind in enumerate(kinds)]))
    other = _moments(_sums(d.select("lang", "source", each.alias("x")).select("lang", "source", "x.*").where("f0 is not null")), 1.0, [1e-2] * P)
    none = g.select("lang", "source", F.lit(0).alias("start"), *[F.lit(0.0).alias(c) for c in CENTRE], *[F.lit(1000.0 if c[1] == c[2] else 0.0).alias(c) for c in FACTOR])
    found = _with(none.unionByName(other), g, "lang", "source")
    found = found.select(*GROUP, *[F.col(f"m{i}").alias(f"c{i}") for i in range(P)], *[(F.col(f"l{i}{j}") * F.col(f"w{i}") / 1000).alias(f"l{i}{j}") for i in range(P) for j in range(i + 1)])
    size = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    turn = F.pmod(F.xxhash64(*FEATURES, "start"), F.lit(1_000_000)) * F.col("n") < 1_000_000 * (P + 2)
    few = _with(rows, size, "lang", "source").withColumn("start", F.explode(F.sequence(F.lit(4), F.lit(3 + RANDOM)))).where(turn)
    return found.unionByName(_moments(_sums(few), 1.0, least))


def estimates(stats: DataFrame) -> DataFrame:
    """stats (lang, source, features) -> the minimum-covariance-determinant estimate of each (lang, source): centre, Cholesky factor, det (half the logarithm).

    Concentration steps on all rows, for every group and start at once: rows of the nearest 75 % give the next centre and covariance. An estimate is replaced only if its determinant falls; after two steps a group's best BEST starts go on; the steps end when no determinant falls, and of a group's starts the one with the least determinant stays. No group is ordered or collected, and a reordering of rows changes nothing.
    """
    size = sum((F.log(f"l{i}{i}") for i in range(1, P)), F.log("l00"))
    steps, rank = 0, Window.partitionBy("lang", "source").orderBy("det", "start")
    groups = _starts(stats).withColumns({"det": F.lit(float("inf")), "less": F.lit(True)}).checkpoint()  # what a start says is no determinant of a subset
    while not groups.where("less").isEmpty():
        new = _moments(_inner(_with(stats, groups.where("less").drop("det", "less"), "lang", "source")), consistency(), list(FEATURES.values())).withColumn("det", size)
        o, n = groups.alias("o"), new.alias("n")
        less = F.coalesce(F.col("n.det") < F.col("o.det") - STABLE, F.lit(False))
        both = o.join(n, F.col("o.lang").eqNullSafe(F.col("n.lang")) & F.col("o.source").eqNullSafe(F.col("n.source")) & (F.col("o.start") == F.col("n.start")), "left")
        groups = both.select(*[f"o.{c}" for c in GROUP], *[F.when(less, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in [*CENTRE, *FACTOR, "det"]], less.alias("less"))
        steps += 1
        groups = (groups.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= BEST).drop("rank") if steps == 2 else groups).checkpoint()
    return groups.groupBy("lang", "source").agg(F.min(F.struct("det", "start", *CENTRE, *FACTOR)).alias("x")).select("lang", "source", *[f"x.{c}" for c in ["det", *CENTRE, *FACTOR]])


def outliers(stats: DataFrame) -> DataFrame:
    """stats with d2: Mahalanobis distance from the MCD estimate of the row's (lang, source)."""
    return _with(stats, estimates(stats), "lang", "source").withColumn("d2", _distance()).drop("det", *CENTRE, *FACTOR)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, d2 of docs (doc_id, text, lang, source).

    kept: not base_failed, and d2 at most the cutoff. Estimates are made from the documents that pass the base rules. Null lang or source: a group of its own. Null text: failed. A group of one: its own centre, kept. Very long texts count whole. Other columns are ignored. Equal rows count. Empty table: no rows.
    """
    stats = statistics(docs.select("doc_id", "text", "lang", "source"), "doc_id", "lang", "source").select("*", *_features()).checkpoint()
    good, bad = stats.where("not base_failed"), stats.where("base_failed")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return outliers(good).select(*cols, (F.col("d2") <= CUTOFF).alias("kept"), "d2").unionAll(bad.select(*cols, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("d2")))
