"""Simulated doublets: planted ones are found."""

import numpy as np
import pytest

from granary.operators import doublets


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_planted_doublets(spark):
    r = np.random.default_rng(3)
    means = r.gamma(0.3, 3.0, (4, 60)) + 0.05
    kind = r.integers(0, 4, 240)
    x = r.poisson(means[kind])
    planted = {}
    for i in range(240, 260):
        a, b = r.choice(4, 2, replace=False)
        planted[i] = r.poisson(means[a]) + r.poisson(means[b])
    rows = [(i, g, int(c)) for i, v in [*enumerate(x), *planted.items()] for g, c in enumerate(v) if c]
    cells = spark.createDataFrame([(i,) for i in range(261)], "cell_id long")
    got = {y.cell_id: y for y in doublets.doublets(spark, spark.createDataFrame(rows, "cell_id long, gene_id long, count long"), cells, genes=40, components=8, k=15, rate=0.08, leaf=2000).collect()}
    assert len(got) == 261 and got[260].doublet_score == 0 and not got[260].is_doublet
    assert sum(got[i].is_doublet for i in planted) >= 15
    assert sum(got[i].is_doublet for i in range(240)) <= 24


def test_pairs(spark):
    cells = spark.range(0, 3000).withColumnRenamed("id", "cell_id")
    got = doublets.pairs(cells, 2).collect()
    assert len(got) == len({(p.t, p.a, p.b) for p in got}) and 2000 < len(got) <= 6000 and all(p.a != p.b for p in got)
    assert sorted(got) == sorted(doublets.pairs(cells.repartition(5), 2).collect())


def test_threshold_parts_two_modes(spark):
    rows = [(0.1 + 0.001 * i,) for i in range(50)] + [(0.8 + 0.001 * i,) for i in range(30)]
    assert 0.15 <= doublets.otsu(spark.createDataFrame(rows, "score double")) <= 0.8
