"""Normalisation, variable genes, rank and t tests, panels, over-representation, neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.expressions import benjamini_hochberg, two_sided_normal

#: Rows of a tile of distances in the exact search.
SCAN = 512
#: Rounds in which neighbours may change their labels at once.
LOOSE = 8


def lognorm(counts: DataFrame, target: float = 1e4) -> DataFrame:
    """ln(1 + count * target / cell total). The total is a partial aggregate joined back on the cell."""
    total = counts.groupBy("cell_id").agg(F.sum("count").alias("total"))
    return counts.join(total, "cell_id").select("cell_id", "gene_id", F.log1p(F.col("count") * target / F.col("total")).alias("value"))


def lognorm_micro(counts: DataFrame, target: float = 1e4) -> DataFrame:
    """(cell_id, gene_id, micro, some): lognorm in millionths, and whether the count is above 0. Totals are made where the rows of a cell are, so counts that are partitioned by cell are not shuffled."""
    total = F.sum("count").over(Window.partitionBy("cell_id"))
    value = counts.where("cell_id is not null").withColumn("value", F.log1p(F.col("count") * target / total))
    return value.select("cell_id", "gene_id", F.round(F.col("value") * 1e6).cast("long").alias("micro"), (F.col("count") > 0).alias("some"))


def _exact(x: F.Column) -> F.Column:
    return F.sum(F.round(x * 1e6).cast("long"))


def group_means(values: DataFrame, cells: DataFrame, by: str) -> DataFrame:
    """Mean over all cells of a group; zeros are the cells that have no row. Values enter in millionths, so sums don't depend on their order."""
    size = cells.groupBy(by).agg(F.count("*").alias("n"))
    s = values.join(cells.select("cell_id", by), "cell_id").groupBy(by, "gene_id").agg(_exact(F.col("value")).alias("s"), F.count("*").alias("detected")).join(size, by)
    return s.select(by, "gene_id", F.round(F.col("s") / 1e6 / F.col("n"), 5).alias("mean"), F.round(F.col("detected") / F.col("n"), 6).alias("detected"))


def gene_moments(values: DataFrame, n_cells: DataFrame) -> DataFrame:
    """mean and variance over all cells, zeros included."""
    s = values.groupBy("gene_id").agg(_exact(F.col("value")).alias("s"), _exact(F.col("value") * F.col("value")).alias("q")).join(n_cells)
    m, q = F.col("s") / 1e6 / F.col("n"), F.col("q") / 1e6 / F.col("n")
    return s.select("gene_id", m.alias("mean"), ((q - m * m) * F.col("n") / (F.col("n") - 1)).alias("variance"))


def variable_genes(moments: DataFrame, bins: int = 20, top: int = 200) -> DataFrame:
    """Dispersion, standardised within bins of the mean. There is a row per gene, a bounded dimension."""
    d = moments.where("mean > 0 and variance > 0").withColumn("dispersion", F.round(F.log(F.col("variance") / F.col("mean")), 4)).withColumn("bin", F.ntile(bins).over(Window.orderBy(F.round("mean", 4), "gene_id")))
    by = Window.partitionBy("bin")
    z = F.round((F.col("dispersion") - F.avg("dispersion").over(by)) / F.stddev("dispersion").over(by), 3)
    return d.withColumn("z", z).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("z"), "gene_id"))).withColumn("highly_variable", F.col("rank") <= top).select("gene_id", "bin", "z", "highly_variable")


def scaled(values: DataFrame, moments: DataFrame, most: float = 10.0) -> DataFrame:
    return values.join(moments.where("variance > 0"), "gene_id").select("cell_id", "gene_id", F.round(F.least((F.col("value") - F.col("mean")) / F.sqrt("variance"), F.lit(most)), 4).alias("z"))


def t_test(values: DataFrame, cells: DataFrame, by: str) -> DataFrame:
    """Welch t of each group against all other cells, from sufficient statistics."""
    size = cells.groupBy(by).agg(F.count("*").alias("n"))
    s = values.join(cells.select("cell_id", by), "cell_id").groupBy(by, "gene_id").agg(_exact(F.col("value")).alias("s"), _exact(F.col("value") * F.col("value")).alias("q"))
    total = s.groupBy("gene_id").agg(F.sum("s").alias("ts"), F.sum("q").alias("tq"))
    x = s.join(size, by).join(total, "gene_id").join(size.agg(F.sum("n").alias("tn")))
    n2 = F.col("tn") - F.col("n")
    m1, m2 = F.col("s") / 1e6 / F.col("n"), (F.col("ts") - F.col("s")) / 1e6 / n2
    v1 = (F.col("q") / 1e6 - F.col("n") * m1 * m1) / (F.col("n") - 1)
    v2 = ((F.col("tq") - F.col("q")) / 1e6 - n2 * m2 * m2) / (n2 - 1)
    se = F.sqrt(v1 / F.col("n") + v2 / n2)
    lfc = F.log2((F.exp(m1) - 1 + 1e-9) / (F.exp(m2) - 1 + 1e-9))
    return x.where((F.col("n") > 1) & (n2 > 1)).select(by, "gene_id", F.when(se > 0, F.round((m1 - m2) / se, 3)).alias("t"), F.round(lfc, 3).alias("log2_fold_change"))


def rank_sum(values: DataFrame, cells: DataFrame, by: str) -> DataFrame:
    """Rank-sum of each group against the rest for every gene. The zeros, cells without a row, are one tied block: only stored values are ranked, after counting equal ones."""
    size = cells.groupBy(by).agg(F.count("*").alias("n1"))
    total = size.agg(F.sum("n1").alias("n"))
    n = values.join(cells.select("cell_id", by), "cell_id").groupBy("gene_id", by, F.col("value").alias("v")).agg(F.count("*").alias("k"))
    at = n.groupBy("gene_id", "v").agg(F.sum("k").alias("t"))
    w = Window.partitionBy("gene_id").orderBy("v")
    at = at.join(total).withColumn("nz", F.sum("t").over(Window.partitionBy("gene_id"))).withColumn("zeros", F.col("n") - F.col("nz")).withColumn("rank", F.col("zeros") + F.sum("t").over(w) - (F.col("t") - 1) / 2)
    ties = at.groupBy("gene_id").agg((F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")) + F.max(F.col("zeros").cast("decimal(38,0)") * F.col("zeros") * F.col("zeros") - F.col("zeros"))).cast("double").alias("ties"), F.max("zeros").alias("zeros"))
    s = n.join(at.select("gene_id", "v", "rank"), ["gene_id", "v"]).groupBy("gene_id", by).agg(F.sum(F.col("rank") * F.col("k")).alias("r"), F.sum("k").alias("k"))
    x = s.join(size, by).join(ties, "gene_id").join(total)
    n1, n_ = F.col("n1").cast("double"), F.col("n").cast("double")
    n2 = n_ - n1
    u = F.col("r") + (n1 - F.col("k")) * (F.col("zeros") + 1) / 2 - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n_ + 1 - F.col("ties") / (n_ * (n_ - 1))))
    return x.select(by, "gene_id", u.alias("u"), F.when(sd > 0, F.round((u - n1 * n2 / 2) / sd, 4)).alias("z"))


def adjusted(df: DataFrame, p: str, ties: str, *groups: str) -> DataFrame:
    """Adds q, Benjamini-Hochberg."""
    r, n, q = benjamini_hochberg(p, ties, *groups)
    return df.withColumns({"_r": r, "_n": n}).withColumn("q", F.round(q("_r", "_n"), 6)).drop("_r", "_n")


#: Samples of at most so many without ties have exact tails.
EXACT = 8


def rank_sum_counts(n1: int, n2: int) -> list[int]:
    """Arrangements of n1 and n2 different values by their U, from 0 to n1 * n2: those where the greatest value is of the first sample, which then adds n2, and those where it is of the second."""
    table = {}
    for a in range(n1 + 1):
        for b in range(n2 + 1):
            counts = [0] * (a * b + 1)
            if a and b:
                for u, c in enumerate(table[a - 1, b]):
                    counts[u + b] += c
                for u, c in enumerate(table[a, b - 1]):
                    counts[u] += c
            else:
                counts[0] = 1
            table[a, b] = counts
    return table[n1, n2]


def exact_rank_sum(u: F.Column, n1: F.Column, n2: F.Column) -> F.Column:
    """Two-sided exact p of U without ties: the share of arrangements as far out or farther, doubled, at most 1. Sizes come in few kinds, so each distribution is counted once a task."""

    @F.pandas_udf("double")
    def p(u, n1, n2):
        import pandas as pd

        known, out = {}, []
        for x, a, b in zip(u, n1, n2):
            a, b = int(a), int(b)
            if (a, b) not in known:
                known[a, b] = rank_sum_counts(a, b)
            c = known[a, b]
            low = int(min(x, a * b - x))
            out.append(min(1.0, 2 * sum(c[: low + 1]) / sum(c)))
        return pd.Series(out)

    return p(u.cast("double"), n1.cast("double"), n2.cast("double"))


def mann_whitney_exact(df: DataFrame, value: str, arm: str, a: str, b: str, *by: str, exact: int = EXACT) -> DataFrame:
    """As mann_whitney, with exact tails where there are no ties and the smaller sample has at most ``exact`` values; ``method`` says which p it is. Null with fewer than 3 a side."""
    d = df.where(F.col(arm).isin(a, b))
    ties = d.groupBy(*by, value).agg(F.count("*").alias("t")).groupBy(*by).agg(F.max("t").alias("most"))
    m = mann_whitney(df, value, arm, a, b, *by)
    m = m.join(ties, list(by)) if by else m.join(ties)
    small = (F.least("n1", "n2") >= 3) & (F.least("n1", "n2") <= exact) & (F.greatest("n1", "n2") <= 200) & (F.col("most") == 1)
    fine = exact_rank_sum(F.when(small, F.col("u")).otherwise(0), F.when(small, F.col("n1")).otherwise(0), F.when(small, F.col("n2")).otherwise(0))
    return m.select(*by, "n1", "n2", "u", F.when(small, F.round(fine, 6)).otherwise(F.col("p")).alias("p"), F.when(F.least("n1", "n2") < 3, None).when(small, "exact").otherwise("normal").alias("method"))


def mann_whitney(df: DataFrame, value: str, arm: str, a: str, b: str, *by: str) -> DataFrame:
    """U of arm a, and a two-sided normal p with tie and continuity correction; null with fewer than 3 a side, 1 if all are equal."""
    d = df.where(F.col(arm).isin(a, b))
    n = d.groupBy(*by, value).agg(F.count_if(F.col(arm) == a).alias("k"), F.count("*").alias("t"))
    w = Window.partitionBy(*by).orderBy(value)
    n = n.withColumn("rank", F.sum("t").over(w) - (F.col("t") - 1) / 2)
    s = n.groupBy(*by).agg(F.sum(F.col("rank") * F.col("k")).alias("r"), F.sum("k").alias("n1"), F.sum("t").alias("n"), F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("ties"), F.count("*").alias("values"))
    n1, n2 = F.col("n1"), F.col("n") - F.col("n1")
    u = F.col("r") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12.0 * (F.col("n") + 1 - F.col("ties") / (F.col("n") * (F.col("n") - 1))))
    z = F.greatest(F.abs(u - n1 * n2 / 2.0) - 0.5, F.lit(0.0)) / sd
    return s.select(*by, "n1", n2.alias("n2"), u.alias("u"), F.when((n1 < 3) | (n2 < 3), None).when(F.col("values") == 1, 1.0).otherwise(F.round(F.least(two_sided_normal(z), F.lit(1.0)), 6)).alias("p"))


def top_markers(tested: DataFrame, by: str, top: int = 50, least: float = 0.1) -> DataFrame:
    """Positive markers, detected in the least share of cells unless none is, by fold change, score, gene."""
    d = tested.where("log2_fold_change > 0 and t is not null").withColumn("ok", F.col("detected") >= least)
    d = d.withColumn("some", F.max("ok").over(Window.partitionBy(by))).where("ok or not some")
    return d.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("log2_fold_change"), F.desc("t"), "gene_id"))).where(F.col("rank") <= top).select(by, "gene_id", "rank", "log2_fold_change", "t", "detected")


def panel_scores(values: DataFrame, panels: DataFrame, cells: DataFrame, cluster: str) -> DataFrame:
    """Mean share of each panel's genes that a cell detects, by cluster; the best panel, Other under 0.02."""
    size = panels.groupBy("panel").agg(F.count("*").alias("genes"))
    n = cells.groupBy(cluster).agg(F.count("*").alias("cells"))
    hit = values.where("count > 0").join(panels, "gene_id").join(cells.select("cell_id", cluster), "cell_id").groupBy(cluster, "panel").agg(F.count("*").alias("k"))
    s = hit.join(size, "panel").join(n, cluster).withColumn("score", F.round(F.col("k") / F.col("genes") / F.col("cells"), 6))
    best = s.withColumn("r", F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc("score"), "panel"))).where("r = 1")
    return best.select(cluster, F.when(F.col("score") >= 0.02, F.col("panel")).otherwise("Other").alias("lineage"), "score")


def state_fraction(markers: DataFrame, programmes: DataFrame, cluster: str, top: int = 15, dominated: float = 0.4) -> DataFrame:
    """Share of the first markers that lie in any state programme, and the largest programme."""
    m = markers.where(F.col("rank") <= top)
    n = m.groupBy(cluster).agg(F.count("*").alias("n"))
    hit = m.join(programmes, "gene_id")
    one = hit.groupBy(cluster, "programme").agg(F.countDistinct("gene_id").alias("k")).groupBy(cluster).agg(F.max(F.struct("k", "programme")).alias("x"))
    anyone = hit.groupBy(cluster).agg(F.countDistinct("gene_id").alias("k"))
    f = F.coalesce(F.col("k"), F.lit(0)) / F.col("n")
    return n.join(anyone, cluster, "left").join(one, cluster, "left").select(cluster, "n", F.round(f, 4).alias("state_fraction"), F.coalesce("x.programme", F.lit("")).alias("dominant_programme"), (f >= dominated).alias("state_dominated"))


def over_representation(genes: DataFrame, sets: DataFrame, universe: DataFrame) -> DataFrame:
    """Overlap, set size, list size, universe, odds ratio (half added) and a normal-approximated enrichment z for each set."""
    u = universe.select("gene_id").distinct()
    s, g = sets.join(u, "gene_id", "left_semi").distinct(), genes.select("gene_id").distinct().join(u, "gene_id", "left_semi")
    total = u.agg(F.count("*").alias("universe")).join(g.agg(F.count("*").alias("listed")))
    n = s.groupBy("set").agg(F.count("*").alias("size")).join(s.join(g, "gene_id").groupBy("set").agg(F.count("*").alias("overlap")), "set", "left").na.fill(0, ["overlap"]).join(total)
    k, m, l, t = (F.col(c).cast("double") for c in ("overlap", "size", "listed", "universe"))
    odds = ((k + 0.5) * (t - m - l + k + 0.5)) / ((m - k + 0.5) * (l - k + 0.5))
    sd = F.sqrt(l * m / t * (t - m) / t * (t - l) / (t - 1))
    return n.select("set", "overlap", "size", "listed", "universe", F.round(odds, 5).alias("odds_ratio"), F.when(sd > 0, F.round((k - l * m / t) / sd, 5)).alias("z"))


def nearest(queries: DataFrame, rows: DataFrame, k: int = 15, batch: str | None = None) -> DataFrame:
    """Exact k nearest rows (id, embedding) of a stated set of queries, each row's own id left out; with batch, the k nearest of every batch.

    Queries are sent in blocks of bounded size; each task meets its rows in tiles and keeps the k best for each query (and batch), so it holds one tile of distances, and what is shuffled is at most k rows a query, batch and task. Distances have four decimals, halves up; ties go to the least id.
    """
    spark, cols = rows.sparkSession, ["id", "embedding", *([batch] if batch else [])]
    out, block = [], []

    def scan(items):
        import numpy as np

        sent = spark.sparkContext.broadcast((np.array([i for i, _ in items], np.int64), np.array([e for _, e in items], np.float64)))

        def run(parts):
            import numpy as np
            import pandas as pd

            ids, q = sent.value
            qq, best = (q * q).sum(-1), {}
            tiles = (p.iloc[i : i + SCAN] for p in parts for i in range(0, len(p), SCAN)) if len(ids) else ()
            for t in tiles:
                for key, g in t.groupby(batch, dropna=False) if batch else [(None, t)]:
                    key = None if key is None or key != key else key
                    v, rid = np.stack(g["embedding"].to_numpy()).astype(np.float64), g["id"].to_numpy()
                    dist, who = best.setdefault(key, (np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)))
                    vv = (v * v).sum(1)
                    d = qq[:, None] + vv - 2 * q @ v.T
                    d[ids[:, None] == rid] = np.inf
                    # all that may round to the kth distance or less
                    err = 1e-12 * (qq + vv.max())
                    most = (dist[:, -1] + 6e-5) ** 2 + err
                    if len(rid) >= k and np.isinf(most).any():
                        most = np.minimum(most, (np.sqrt(np.maximum(np.partition(d, k - 1, axis=1)[:, k - 1], 0) + err) + 2e-4) ** 2 + err)
                    hit, col = np.divmod(np.flatnonzero(d <= np.minimum(most, np.finfo(float).max)[:, None]), len(rid))
                    if len(hit):
                        far = np.concatenate([np.sqrt(((q[hit[j : j + 65536]] - v[col[j : j + 65536]]) ** 2).sum(1)) for j in range(0, len(hit), 65536)])
                        some = np.unique(hit)
                        of, x, y = np.concatenate([hit, np.repeat(some, k)]), np.concatenate([np.floor(far * 1e4 + 0.5) / 1e4, dist[some].ravel()]), np.concatenate([rid[col], who[some].ravel()])
                        order = np.lexsort((y, x, of))
                        of, x, y = of[order], x[order], y[order]
                        take = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])[:, None] + np.arange(k)
                        dist[some], who[some] = x[take], y[take]
            for key, (dist, who) in best.items():
                of, n = np.nonzero(np.isfinite(dist))
                yield pd.DataFrame({"id": ids[of], "neighbour": who[of, n], "distance": dist[of, n]} | ({batch: pd.Series([key] * len(of), dtype=object)} if batch else {}))

        kind = f", {batch} {rows.schema[batch].dataType.simpleString()}" if batch else ""
        return rows.select(*cols).mapInPandas(run, f"id long, neighbour long, distance double{kind}")

    for r in queries.select("id", "embedding").toLocalIterator():
        block.append((r.id, list(r.embedding)))
        if len(block) == 4096:
            out.append(scan(block))
            block = []
    out.append(scan(block))
    from granary.operators.metrics import union_all

    by = Window.partitionBy("id", *([batch] if batch else [])).orderBy("distance", "neighbour")
    return union_all(out).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def centroid_silhouette(rows: DataFrame, label: str) -> DataFrame:
    """Mean simplified silhouette: distances to centroids, not to all pairs. One pass to make the centroids, one to use them."""
    x = rows.select(F.col("id"), F.col(label).alias("l"), F.posexplode("embedding").alias("d", "x"))
    c = x.groupBy("l", "d").agg(F.avg("x").alias("c"))
    far = x.withColumnRenamed("l", "own").join(c, "d").groupBy("id", "own", "l").agg(F.sqrt(F.sum((F.col("x") - F.col("c")) * (F.col("x") - F.col("c")))).alias("dist"))
    s = far.groupBy("id", "own").agg(F.min(F.when(F.col("l") == F.col("own"), F.col("dist"))).alias("a"), F.min(F.when(F.col("l") != F.col("own"), F.col("dist"))).alias("b"))
    return s.groupBy(F.col("own").alias(label)).agg(F.count("*").alias("n"), F.round(F.avg((F.col("b") - F.col("a")) / F.greatest("a", "b")), 4).alias("silhouette"))


def principal_components(rows: DataFrame, k: int = 8) -> DataFrame:
    """Variance and share of the first components. The covariance is summed in Spark; its size is that of the features."""
    import numpy as np

    x = rows.select("id", F.posexplode("embedding").alias("i", "x"))
    n = rows.count()
    mean = {r.i: r.m for r in x.groupBy("i").agg(F.avg("x").alias("m")).collect()}
    dims = len(mean)
    sums = rows.select(F.posexplode("embedding").alias("i", "x"), "embedding").select("i", F.posexplode(F.transform("embedding", lambda y: y * F.col("x"))).alias("j", "xy")).groupBy("i", "j").agg(F.sum("xy").alias("s")).collect()
    cov = np.zeros((dims, dims))
    for r in sums:
        cov[r.i, r.j] = r.s / n - mean[r.i] * mean[r.j]
    values = np.sort(np.linalg.eigvalsh(cov * n / max(1, n - 1)))[::-1]
    return rows.sparkSession.createDataFrame([(i + 1, float(v), float(v / values.sum())) for i, v in enumerate(values[:k])], "component int, variance double, share double")


def size_factors(bulk: DataFrame) -> DataFrame:
    """Median-of-ratios size factor of each sample, over genes counted in every sample."""
    n = bulk.select("sample").distinct().agg(F.count("*").alias("samples"))
    g = bulk.where("count > 0").groupBy("gene_id").agg(F.avg(F.log("count")).alias("ref"), F.count("*").alias("k")).join(n).where("k = samples")
    return bulk.join(g, "gene_id").groupBy("sample").agg(F.round(F.exp(F.percentile(F.round(F.log("count") - F.col("ref"), 6), 0.5)), 5).alias("size_factor"))


def wald_moments(bulk: DataFrame, samples: DataFrame, factors: DataFrame, focus: str, ref: str) -> DataFrame:
    """Negative binomial contrast by moments: dispersion from the pooled variance of normalised counts, delta-method error of the log ratio, normal p, BH. Not the shrunken maximum-likelihood fit."""
    x = bulk.join(factors, "sample").join(samples, "sample").where(F.col("grp").isin(focus, ref)).withColumn("y", F.col("count") / F.col("size_factor"))
    n = samples.where(F.col("grp").isin(focus, ref)).groupBy("grp").agg(F.count("*").alias("n"))
    s = x.groupBy("gene_id", "grp").agg(F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q")).join(n, "grp").withColumn("m", F.col("s") / F.col("n")).withColumn("v", (F.col("q") - F.col("n") * F.col("m") * F.col("m")) / (F.col("n") - 1))
    pick = lambda c, g: F.coalesce(F.max(F.when(F.col("grp") == g, F.col(c))), F.lit(0.0))
    w = s.groupBy("gene_id").agg(pick("m", focus).alias("a"), pick("m", ref).alias("b"), pick("v", focus).alias("va"), pick("v", ref).alias("vb"), F.max("n").alias("n"))
    base = (F.col("a") + F.col("b")) / 2
    disp = F.greatest(F.lit(1e-8), ((F.col("va") + F.col("vb")) / 2 - base) / (base * base))
    se = F.sqrt((1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5) + 2 * disp) / F.col("n"))
    lfc = F.log((F.col("a") + 0.5) / (F.col("b") + 0.5))
    w = w.select("gene_id", F.round(base, 4).alias("base_mean"), F.round(lfc / 0.6931471805599453, 4).alias("log2_fold_change"), F.round(two_sided_normal(lfc / se), 6).alias("p_value"))
    return adjusted(w, "p_value", "gene_id").withColumnRenamed("q", "p_value_adj")


def label_propagation(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Communities of a graph (src, dst, weight): each node takes the label of most weight around it, ties to the least, until no node has a better one, or for so many rounds. A substitute for modularity clustering, not its equal.

    In the first rounds half of the nodes that have a better label take it. After these, only those with no neighbour before them that has one too: each such round raises the weight of edges within communities, or lowers labels at the same weight, so it ends. Weights enter in millionths, so sums don't depend on their order.
    """
    w = F.round(F.col("weight") * 1e6).cast("long").alias("weight")
    both = edges.select("src", "dst", w).unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), w)).where("src <> dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight")).checkpoint()
    labels, r = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("label", F.col("id")).checkpoint(), 0
    while rounds is None or r < rounds:
        votes = both.join(labels, both.dst == labels.id).groupBy("src", "label").agg(F.sum("weight").alias("w"))
        best = votes.groupBy(F.col("src").alias("id")).agg(F.min(F.struct((-F.col("w")).alias("w"), "label")).alias("best"))
        better = labels.join(best, "id").where("best.label <> label").select("id", F.col("best.label").alias("better"), F.xxhash64("id", F.lit(r)).alias("turn")).checkpoint()
        if better.isEmpty():
            break
        if r < LOOSE:
            moves = better.where("turn % 2 = 0")
        else:
            a, b = better.alias("a"), better.alias("b")
            behind = both.join(a, F.col("src") == F.col("a.id")).join(b, F.col("dst") == F.col("b.id")).where(F.struct("b.turn", "b.id") < F.struct("a.turn", "a.id")).select(F.col("a.id").alias("id")).distinct()
            moves = better.join(behind, "id", "left_anti")
        labels, r = labels.join(moves, "id", "left").select("id", F.coalesce("better", "label").alias("label")).checkpoint(), r + 1
    return labels


def linear_probabilities(features: DataFrame, model: DataFrame, bias: DataFrame) -> DataFrame:
    """Softmax of a standardised linear model: features (id, feature, x), model (class, feature, mean, scale, weight), bias (class, b)."""
    z = features.join(model, "feature").groupBy("id", "class").agg(F.sum((F.col("x") - F.col("mean")) / F.col("scale") * F.col("weight")).alias("z")).join(bias, "class").withColumn("z", F.col("z") + F.col("b"))
    by = Window.partitionBy("id")
    e = F.exp(F.col("z") - F.max("z").over(by))
    return z.withColumn("e", e).select("id", "class", F.round(F.col("e") / F.sum("e").over(by), 6).alias("probability"))
