"""Mixed clusters in order, component scores, diffusion components and pseudotime."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: cells of the smallest child of a cluster.
SMALLEST = 30

def mixed_clusters(flags: DataFrame, sizes: DataFrame, cluster: str, least: int = 2 * SMALLEST) -> DataFrame:
    """Flagged clusters that are large enough, the largest first."""
    return flags.where("mixed").join(sizes, cluster).where(F.col("n") >= least).select(cluster, "n").orderBy(F.desc("n"), cluster)


def component_scores(spark: SparkSession, values: DataFrame, k: int = 50) -> DataFrame:
    """values (id, features array<double>, and weight if rows stand for several) -> (id, scores array<double>): principal component scores of the centred features, the largest first; the sign makes the largest loading positive.

    Features are a bounded dimension d (variable genes): the d x d sums of products are made in the cluster, one partial a batch; only they reach the driver, where the directions are found.
    """
    import numpy as np

    def partial(batches):
        import pandas as pd

        for df in batches:
            x = np.stack([np.asarray(v, float) for v in df["features"]]) if len(df) else np.zeros((0, 0))
            if len(x):
                y = x if "weight" not in df else x * df["weight"].to_numpy(float)[:, None]
                yield pd.DataFrame({"i": range(-1, x.shape[1]), "n": len(x) if "weight" not in df else int(df["weight"].sum()), "v": [y.sum(0).tolist(), *(y.T @ x).tolist()]})

    sums = values.drop("id").mapInPandas(partial, "i int, n long, v array<double>").select("i", "n", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    if not sums:
        return values.select("id", F.array().cast("array<double>").alias("scores"))
    d, n = max(r.j for r in sums) + 1, sums[0].n
    m = np.zeros((d + 1, d))
    for r in sums:
        m[r.i + 1, r.j] = r.x
    mean = m[0] / n
    _, vectors = np.linalg.eigh(m[1:] / n - np.outer(mean, mean))
    w = vectors[:, ::-1][:, : min(k, d)]
    w = w * np.sign(w[np.abs(w).argmax(0), range(w.shape[1])])
    sent = spark.sparkContext.broadcast((mean, w))  # d x k numbers

    @F.pandas_udf("array<double>")
    def project(x):
        import pandas as pd

        mean, w = sent.value
        return pd.Series([((np.asarray(v, float) - mean) @ w).tolist() for v in x])

    return values.select("id", project("features").alias("scores"))


def diffusion(edges: DataFrame, k: int = 3, rounds: int = 60) -> DataFrame:
    """edges (src, dst, weight, both ways) -> (id, components array): the slowest k directions of the random walk on the graph, by power iteration on normalised weights, each made orthogonal to those before. Only a few sums of each round reach the driver; rounds are checkpointed. ``rounds`` is the iteration's depth: a gap of eigenvalues g leaves g ** rounds."""
    deg = edges.groupBy("src").agg(F.sum("weight").alias("d")).checkpoint()
    a = deg.select("src", F.col("d").alias("ds")).join(edges, "src").join(deg.toDF("dst", "dd"), "dst").select("src", "dst", (F.col("weight") / F.sqrt(F.col("ds") * F.col("dd"))).alias("w")).checkpoint()
    total = deg.agg(F.sum("d")).first()[0]
    state = deg.select(F.col("src").alias("id"), F.array(F.sqrt(F.col("d") / total)).alias("done")).checkpoint()
    for c in range(k):
        at = state.select("id", "done", (F.pmod(F.xxhash64("id", F.lit(c)), F.lit(2001)) / 1000.0 - 1.0).alias("x"))
        at = at.checkpoint()
        for _ in range(rounds):
            walked = a.join(at.select(F.col("id").alias("dst"), "x"), "dst").groupBy("src").agg(F.sum(F.col("w") * F.col("x")).alias("y"))
            at = at.join(walked, at["id"] == walked["src"], "left").select("id", "done", ((F.col("x") + F.coalesce("y", F.lit(0.0))) / 2).alias("x")).checkpoint()
            sums = at.agg(F.sum(F.col("x") * F.col("x")), *[F.sum(F.col("x") * F.col("done")[j]) for j in range(c + 1)]).first()
            norm = max(sums[0] - sum(p * p for p in sums[1:]), 1e-300) ** 0.5
            at = at.select("id", "done", ((F.col("x") - sum((p * F.col("done")[j] for j, p in enumerate(sums[1:])), F.lit(0.0))) / norm).alias("x"))
        state = at.select("id", F.concat("done", F.array("x")).alias("done")).checkpoint()
    return state.select("id", F.transform(F.slice("done", 2, k), lambda x: x / F.col("done")[0]).alias("components"))


def root_cell(cells: DataFrame, group: str, root: str) -> DataFrame:
    """cells (id, group, components) -> the id at the root group's end of the first component: the least if the group's mean lies at or below the mean of all, else the greatest."""
    x = F.col("components")[0]
    of = F.when(F.col(group) == root, x)
    return cells.agg(F.when(F.avg(of) <= F.avg(x), F.min_by("id", F.when(F.col(group) == root, F.struct(x, "id")))).otherwise(F.max_by("id", F.when(F.col(group) == root, F.struct(x, F.col("id"))))).alias("id"))


def pseudotime(components: DataFrame, root: DataFrame) -> DataFrame:
    """Distance of each cell from the root in diffusion space, from 0 to 1. The root is one row."""
    r = root.join(components, "id").select(F.col("components").alias("r"))
    d = components.join(r).withColumn("t", F.sqrt(F.aggregate(F.zip_with("components", "r", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)))
    return d.join(d.agg(F.max("t").alias("most"))).select("id", F.when(F.col("most") > 0, F.col("t") / F.col("most")).otherwise(0.0).alias("pseudotime"))
