"""Doublets by simulation: sums of two seeded cells are embedded together with the cells; a cell with many of them near it is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.operators import numeric
from granary.operators.clusters import component_scores
from granary.operators.graphs import BLOCK, neighbours
from granary.operators.lineage import settled

#: Simulated pairs for each cell; rate that is expected; genes and components of the embedding; neighbours; bins of the scores.
PAIRS, RATE, GENES, COMPONENTS, NEAR, BINS = 2, 0.06, 200, 20, 30, 50


def pairs(cells: DataFrame, times: int = PAIRS, seed: int = 0) -> DataFrame:
    """(t, a, b): about ``times`` pairs for each cell. The cells in two seeded orders meet place by place in 1024 slices, so nothing is ordered whole; a cell that meets itself, or nothing, makes no pair."""
    one = cells.select(F.col("cell_id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("t"))

    def order(name: str, salt: int) -> DataFrame:
        by = Window.partitionBy("t", "slice").orderBy(F.xxhash64(name, "t", F.lit(salt + 2)), name)
        return one.select(F.col("a").alias(name), "t", F.pmod(F.xxhash64("a", "t", F.lit(salt)), F.lit(1024)).alias("slice")).withColumn("at", F.row_number().over(by))

    return order("a", seed).join(order("b", seed + 1), ["t", "slice", "at"]).where("a <> b").select("t", "a", "b")


def features(counts: DataFrame, genes: int) -> DataFrame:
    """counts (cell_id, gene_id, count, simulated) -> (id, features): log-normalised values of the variable genes that a cell has, as (at, value) in order. Genes are chosen on real cells."""
    real = counts.where("not simulated")
    moments = numeric.gene_moments(numeric.lognorm(real), real.select("cell_id").distinct().agg(F.count("*").alias("n")))
    top = numeric.variable_genes(moments, top=genes).where("highly_variable").select("gene_id", (F.row_number().over(Window.orderBy("gene_id")) - 1).alias("at"))
    at = counts.join(F.broadcast(settled(top)), "gene_id", "left")  # the cell's total and its few variable genes in one pass
    one = at.groupBy(F.col("cell_id").alias("id")).agg(F.sum("count").alias("total"), F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "count")))).alias("x"))
    return one.select("id", F.transform("x", lambda y: F.struct(y["at"].alias("at"), F.log1p(y["count"] * 1e4 / F.col("total")).alias("value"))).alias("features"))


def otsu(scores: DataFrame, bins: int = BINS) -> float:
    """The cut of scores from 0 to 1 that parts them best in two. Only the counts of bins reach the driver."""
    n = [0] * bins
    for r in scores.groupBy(F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int").alias("b")).count().collect():
        n[r.b] = r["count"]
    total, mass = sum(n), sum(i * c for i, c in enumerate(n))
    best, cut, low, below = -1.0, 1.0, 0, 0
    for i in range(bins - 1):
        low, below = low + n[i], below + i * n[i]
        if 0 < low < total:
            between = low * (total - low) * (below / low - (mass - below) / (total - low)) ** 2
            if between > best:
                best, cut = between, (i + 1) / bins
    return cut


def doublets(spark: SparkSession, counts: DataFrame, cells: DataFrame, *, times: int = PAIRS, rate: float = RATE, genes: int = GENES, components: int = COMPONENTS, k: int = NEAR, seed: int = 0, leaf: int = BLOCK, follow: int | None = None) -> DataFrame:
    """counts (cell_id, gene_id, count), cells (cell_id) -> cell_id, doublet_score, is_doublet.

    The score is the chance that a cell is a doublet, given the share of simulated pairs among its k nearest and the expected rate; the threshold parts the shares of the simulated pairs, which have two modes: pairs of like and of unlike cells. Cells without counts: score 0. No cells: no rows.

    Cells with equal values of the variable genes are one vector of their number; where only some of a group are among the k nearest, its share counts, so ties depend on no order. ``cell_id`` is unique.
    """
    sides = pairs(cells, times, seed).unionByName(cells.select(F.lit(-1).alias("t"), F.col("cell_id").alias("a"), F.lit(None).cast("long").alias("b")))
    key = settled(sides.select((F.col("a") * (times + 1) + F.col("t") + 1).alias("id"), "a", "b", (F.col("t") >= 0).alias("simulated")))
    parts = key.select("id", "simulated", F.explode(F.filter(F.array("a", "b"), lambda x: x.isNotNull())).alias("cell_id"))
    summed = parts.join(counts.where("count > 0"), "cell_id").groupBy(F.col("id").alias("cell_id"), "simulated", "gene_id").agg(F.sum("count").alias("count"))
    rows = settled(features(settled(summed), genes).withColumn("simulated", F.pmod("id", F.lit(times + 1)) > 0))
    groups = settled(rows.groupBy("features").agg(F.min("id").alias("vec"), F.count("*").alias("n"), F.count_if("simulated").alias("s")))
    value = F.map_from_entries("features")
    dense = groups.select(F.col("vec").alias("id"), F.col("n").alias("weight"), F.transform(F.sequence(F.lit(0), F.lit(genes - 1)), lambda i: F.coalesce(F.element_at(value, i), F.lit(0.0))).alias("features"))
    vectors = component_scores(spark, settled(dense), components).select("id", F.col("scores").cast("array<float>").alias("embedding"))
    near = neighbours(settled(vectors), k, leaf=leaf, follow=follow)
    weighed = near.join(groups.select(F.col("vec").alias("neighbour"), "n", "s"), "neighbour").groupBy(F.col("id").alias("vec")).agg(F.array_sort(F.collect_list(F.struct("rank", "n", "s"))).alias("x"))
    both = groups.join(weighed, "vec", "left").withColumn("simulated", F.explode(F.array(F.lit(False), F.lit(True))))
    own = F.struct(F.lit(0).alias("rank"), (F.col("n") - 1).alias("n"), (F.col("s") - F.col("simulated").cast("long")).alias("s"))
    none = F.struct(F.lit(float(k)).alias("left"), F.lit(0.0).alias("s"))

    def met(so_far, y):
        take = F.least(so_far["left"], y["n"])
        return F.struct((so_far["left"] - take).alias("left"), (so_far["s"] + take * y["s"] / F.greatest(y["n"], F.lit(1))).alias("s"))

    both = both.select("features", "simulated", F.aggregate(F.concat(F.array(own), F.coalesce("x", F.array_repeat(own, 0))), none, met).alias("m")).select("features", "simulated", F.col("m.s").alias("s"), (k - F.col("m.left")).alias("n"))
    both, empty = settled(both), F.size("features") == 0  # a large group has no join of its own
    share = rows.where(~empty).join(both.where(~empty), ["features", "simulated"]).select("id", "s", "n").unionAll(rows.where(empty).join(F.broadcast(both.where(empty).drop("features")), "simulated").select("id", "s", "n"))
    q = (F.col("s") + 1) / (F.col("n") + 2.0)
    chance = q * rate / times / (1 - rate - q * (1 - rate - rate / times))
    known = F.col("n").isNotNull()
    scored = settled(key.join(share, "id", "left").select("a", "simulated", F.when(known, q).otherwise(0.0).alias("score"), F.when(known, F.round(F.least(F.greatest(chance, F.lit(0.0)), F.lit(1.0)), 6)).otherwise(0.0).alias("chance")))
    cut = otsu(scored.where("simulated"))
    return scored.where("not simulated").select(F.col("a").alias("cell_id"), F.col("chance").alias("doublet_score"), (F.col("score") > cut).alias("is_doublet"))
