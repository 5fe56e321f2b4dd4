"""Clusters, components and pseudotime with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.operators import clusters


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_mixed_clusters(spark):
    flags, sizes = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "k string, mixed boolean"), spark.createDataFrame([("a", 60), ("b", 90), ("c", 99)], "k string, n long")
    assert [r.k for r in clusters.mixed_clusters(flags, sizes, "k").collect()] == ["b", "a"]


def test_scores_equal_numpy(spark):
    x = np.random.default_rng(0).normal(size=(60, 5)) @ np.diag([5, 3, 2, 1, 0.5])
    got = {r.id: r.scores for r in clusters.component_scores(spark, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>"), 3).collect()}
    c = x - x.mean(0)
    _, _, v = np.linalg.svd(c, full_matrices=False)
    want = c @ v[:3].T
    assert np.allclose(np.abs([got[i] for i in range(60)]), np.abs(want))


def test_pseudotime_along_a_path(spark):
    n = 6
    e = [(i, i + 1, 1.0) for i in range(n - 1)]
    edges = spark.createDataFrame(e + [(b, a, w) for a, b, w in e], "src long, dst long, weight double")
    c = clusters.diffusion(edges, k=1, rounds=25).withColumn("g", F.when(F.col("id") < 2, "base").otherwise("other")).checkpoint()
    root = clusters.root_cell(c, "g", "base")
    assert root.first().id == 0
    t = {r.id: r.pseudotime for r in clusters.pseudotime(c.select("id", "components"), root).collect()}
    assert t[0] == 0 and t[n - 1] == 1 and all(t[i] < t[i + 1] for i in range(n - 1))
