"""Benchmark metrics of labels: confusion, F1, risk and coverage, calibration, entropy."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.expressions import abstains


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    n = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("truth")), 6))


def per_class_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of every class of the truth; 0 where undefined. One pass: pairs are counted first."""
    n = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    side = n.select(F.explode(F.array(F.struct(F.col("t").alias("c"), F.when(F.col("t").eqNullSafe(F.col("p")), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called")), F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called")))).alias("x")).select("x.*").where("c is not null")
    s = side.groupBy(F.col("c").alias("class")).agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("called").alias("called")).where("support > 0")
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6)).otherwise(0.0)
    return s.select("class", "support", ratio(F.col("tp"), F.col("called")).alias("precision"), ratio(F.col("tp"), F.col("support")).alias("recall"), ratio(2 * F.col("tp"), F.col("called") + F.col("support")).alias("f1"))


def macro_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    f = per_class_f1(df, truth, predicted).agg(F.round(F.avg("f1"), 5).alias("macro_f1"), F.count("*").alias("n_classes"))
    a = df.agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col(truth).eqNullSafe(F.col(predicted)), 1.0).otherwise(0.0)), 5).alias("accuracy"))
    return f.join(a)


def bootstrap_f1(df: DataFrame, truth: str, predicted: str, key: str, rounds: int = 1000, seed: int = 0) -> DataFrame:
    """Percentile interval of macro-F1 over resamples. A row's weight in a round is a Poisson(1) draw from a hash of (key, round): rounds are independent of partitioning."""
    u = (F.pmod(F.xxhash64(F.col(key), F.col("round"), F.lit(seed)), F.lit(1_000_003)) + 0.5) / 1_000_003
    cuts, p, total = [], 0.36787944117144233, 0.0
    for k in range(8):
        total += p
        cuts.append(total)
        p /= k + 1
    w = sum((F.when(u > c, 1).otherwise(0) for c in cuts[1:]), F.when(u > cuts[0], 1).otherwise(0))
    n = df.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("w", w).groupBy("round", F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.sum("w").alias("n"))
    side = n.select("round", F.explode(F.array(F.struct(F.col("t").alias("c"), F.when(F.col("t").eqNullSafe(F.col("p")), 2 * F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("s"), F.col("n").alias("all")), F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("s"), F.col("n").alias("all")))).alias("x")).select("round", "x.*")
    f = side.groupBy("round", "c").agg((F.sum("tp") / F.sum("all")).alias("f"), F.sum("s").alias("s")).where("s > 0").groupBy("round").agg(F.avg("f").alias("f"))
    return f.agg(F.round(F.percentile("f", 0.025), 6).alias("low"), F.round(F.percentile("f", 0.975), 6).alias("high"), F.count("*").alias("rounds"))


def ablation(df: DataFrame, truth: str, voters: list[str]) -> DataFrame:
    """Accuracy of the majority of every non-empty subset of voters; ties go to the first voter. Abstentions don't vote. All subsets in one pass."""
    def majority(some):
        votes = [F.when(~abstains(F.col(c)), F.col(c)) for c in some]
        count = [sum((F.when(v.eqNullSafe(w) & v.isNotNull(), 1).otherwise(0) for w in votes), F.lit(0)) for v in votes]
        best = F.greatest(*count) if len(count) > 1 else count[0]
        return F.coalesce(*[F.when((c == best) & v.isNotNull(), v) for c, v in zip(count, votes)])

    subsets = [s for k in range(1, len(voters) + 1) for s in combinations(voters, k)]
    rows = df.select(F.explode(F.array(*[F.struct(F.lit("+".join(s)).alias("voters"), (majority(s) == F.col(truth)).alias("hit")) for s in subsets])).alias("x"))
    return rows.groupBy("x.voters").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("x.hit"), F.lit(False))).alias("hits")).withColumn("accuracy", F.round(F.col("hits") / F.col("n"), 6))


def risk_coverage(df: DataFrame, correct: str, confidence: str, key: str, slices: int = 256) -> DataFrame:
    """Running accuracy by falling confidence, null last, ties by key. Range-partitioned slices carry the sums of those before, so no task orders all rows."""
    c = F.coalesce(F.col(confidence), F.lit(-1.0))
    d = df.select(key, F.col(correct).cast("int").alias("hit"), c.alias("c")).withColumn("slice", slices - 1 - F.floor(F.greatest(F.least(F.col("c"), F.lit(1.0)), F.lit(0.0)) * (slices - 2)).cast("int") - F.when(F.col("c") < 0, -1).otherwise(0))
    sums = d.groupBy("slice").agg(F.count("*").alias("n"), F.sum("hit").alias("h"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("h").over(before), F.lit(0)).alias("h0"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    w = Window.partitionBy("slice").orderBy(F.desc("c"), key)
    d = d.join(sums, "slice").withColumn("k", F.col("n0") + F.row_number().over(w)).withColumn("h", F.col("h0") + F.sum("hit").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.select(key, "k", F.round(F.col("k") / F.col("total"), 6).alias("coverage"), F.round(F.col("h") / F.col("k"), 6).alias("accuracy"), F.round(1 - F.col("h") / F.col("k"), 6).alias("error"))


def aurc(curve: DataFrame) -> DataFrame:
    """Area under error against coverage. Points are equally spaced, so the trapezoids are the sum of errors less half of the ends."""
    e = F.round(F.col("error") * 1_000_000).cast("long")
    return curve.agg(F.count("*").alias("n"), F.sum(e).alias("s"), F.min_by(e, "k").alias("a"), F.max_by(e, "k").alias("z")).select("n", F.round((F.col("s") - (F.col("a") + F.col("z")) / 2) / F.col("n") / 1e6, 5).alias("aurc"))


def risk_at(curve: DataFrame, coverage: float) -> DataFrame:
    return curve.where(F.col("coverage") >= coverage).agg(F.min_by("error", "k").alias("risk"))


def calibration(df: DataFrame, correct: str, confidence: str, bins: int = 10) -> DataFrame:
    c = F.col(confidence)
    b = F.greatest(F.ceil(F.round(c * bins, 9)) - 1, F.lit(0)).cast("int")
    return df.where(c.isNotNull() & ~F.isnan(c)).groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg(F.round(c * 1000).cast("long")) / 1000, 5).alias("mean_confidence"), F.round(F.avg(F.col(correct).cast("int")), 5).alias("accuracy")).withColumn("gap", F.round(F.abs(F.col("mean_confidence") - F.col("accuracy")), 5))


def calibration_error(bins: DataFrame) -> DataFrame:
    return bins.agg(F.round(F.sum(F.round(F.col("n") * F.col("gap") * 100_000).cast("long")) / F.sum("n") / 100_000, 5).alias("ece"), F.max("gap").alias("mce"))


def vote_entropy(df: DataFrame, key: str, voters: list[str]) -> DataFrame:
    """Bits over a row's votes; null without votes."""
    votes = F.filter(F.array(*map(F.col, voters)), lambda v: ~abstains(v))
    n = F.size("v")
    each = F.transform(F.array_distinct("v"), lambda x: F.size(F.filter("v", lambda y: y == x)) / n)
    return df.select(key, votes.alias("v")).select(key, F.when(n > 0, F.round(F.abs(F.aggregate(each, F.lit(0.0), lambda a, p: a + p * F.log2(p))), 5)).alias("entropy"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation of average ranks. Values are counted first, so ranks are made over distinct values."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())

    def ranks(c):
        n = d.groupBy(c).agg(F.count("*").alias("n"))
        return n.select(c, (F.sum("n").over(Window.orderBy(c)) - (F.col("n") - 1) / 2).alias(f"r_{c}"))

    return d.join(ranks(a), a).join(ranks(b), b).agg(F.count("*").alias("n"), F.round(F.corr(f"r_{a}", f"r_{b}"), 5).alias("rho"))


def held_out(df: DataFrame, truth: str, methods: list[str], confidence: str) -> DataFrame:
    """For each held-out type and method: how often it abstains (no call, the type itself censored, or confidence under 0.5) and how often it errs with confidence."""
    long = df.unpivot([truth, confidence], methods, "method", "label")
    censored = F.when(F.col("label") == F.col(truth), None).otherwise(F.col("label"))
    quiet = abstains(censored) | (F.coalesce(F.col(confidence), F.lit(1.0)) < 0.5)
    return long.withColumn("quiet", quiet).groupBy(F.col(truth).alias("held_out"), "method").agg(F.count("*").alias("n"), F.round(F.avg(F.col("quiet").cast("int")), 6).alias("abstention_rate"), F.round(F.avg((~F.col("quiet")).cast("int")), 6).alias("confident_error_rate"))


def resolution(df: DataFrame, columns: list[str]) -> DataFrame:
    long = df.unpivot([], columns, "column", "label")
    return long.groupBy("column").agg(F.count("*").alias("n"), F.count_if(abstains(F.col("label"))).alias("abstained"), F.countDistinct("label").alias("n_labels")).withColumn("abstained_fraction", F.round(F.col("abstained") / F.col("n"), 6))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information of two labellings, from the table of their pairs."""
    n = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    rows, cols = n.groupBy("a").agg(F.sum("n").alias("r")), n.groupBy("b").agg(F.sum("n").alias("c"))
    two = lambda x: (F.col(x) * (F.col(x) - 1) / 2).cast("long")
    t = n.agg(F.sum("n").alias("n"), F.sum(two("n")).alias("ij")).join(rows.agg(F.sum(two("r")).alias("si"))).join(cols.agg(F.sum(two("c")).alias("sj")))
    d = lambda c: F.col(c).cast("double")  # noqa: E731  products of pairs pass 64 bits
    exp = d("si") * d("sj") / F.greatest(d("n") * (d("n") - 1) / 2, F.lit(1.0))  # one row has no pairs
    ari = F.when((d("si") + d("sj")) / 2 == exp, 1.0).otherwise((d("ij") - exp) / ((d("si") + d("sj")) / 2 - exp))
    m = n.join(rows, "a").join(cols, "b").join(t.select(F.col("n").alias("total")))
    mi = m.agg(F.sum(d("n") / d("total") * F.log(d("n") * d("total") / (d("r") * d("c")))).alias("mi"))
    h = lambda d, x: d.join(t.select(F.col("n").alias("total"))).agg((-F.sum(F.col(x) / F.col("total") * F.log(F.col(x) / F.col("total")))).alias(f"h_{x}"))
    return t.join(mi).join(h(rows, "r")).join(h(cols, "c")).select(F.round(ari, 6).alias("ari"), F.round(F.when(F.col("h_r") + F.col("h_c") == 0, 1.0).otherwise(2 * F.col("mi") / (F.col("h_r") + F.col("h_c"))), 6).alias("nmi"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
