"""What failed on larger tables, in the smallest form that shows it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import granary.plans.annotation  # noqa: F401
from granary.operators import doublets, gate, graphs, metrics, numeric


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_agreement_of_a_million_rows_and_of_one(spark):
    """The product of the pair counts passes 64 bits."""
    rows = spark.range(1_000_000).select((F.col("id") % 5).alias("a"), (F.col("id") % 10).alias("b"))
    got = metrics.agreement(rows, "a", "b").first()
    n, five, ten = 1_000_000, 5 * 200_000 * 199_999 // 2, 10 * 100_000 * 99_999 // 2
    by_chance = five * ten / (n * (n - 1) / 2)
    assert abs(got.ari - (ten - by_chance) / ((five + ten) / 2 - by_chance)) < 2e-6 and abs(got.nmi - 0.822816) < 2e-6
    one = metrics.agreement(rows.limit(1), "a", "b").first()
    assert (one.ari, one.nmi) == (1.0, 1.0)
    assert metrics.agreement(rows.limit(0), "a", "b").first().ari is None


@pytest.mark.parametrize("kind", ["uniform", "clusters", "copies", "none"])
def test_neighbours_are_those_of_all_pairs(spark, kind):
    """Also of equal vectors, ties to the least id; vectors are not copied for the cells that they are searched in."""
    r = np.random.default_rng(0)
    x = {"uniform": r.normal(size=(500, 16)), "clusters": r.normal(size=(500, 8)) + 30 * r.normal(size=(9, 8))[r.integers(0, 9, 500)], "copies": np.concatenate([np.zeros((200, 4)), r.integers(0, 3, size=(300, 4))]), "none": np.zeros((0, 4))}[kind].astype(np.float32).astype(float)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).round(6)
    want = [(i, j, d[i, j], n + 1) for i in range(len(x)) for n, j in enumerate(sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[i, j], j))[:7])]
    got = graphs.neighbours(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<float>"), 7, leaf=64, tile=50)
    assert sorted(tuple(y) for y in got.select("id", "neighbour", "distance", "rank").collect()) == sorted(want)


def test_communities_of_several_blocks(spark, monkeypatch):
    """Blocks that move at once find the planted communities too, and one block needs one round of moves a level."""
    r = np.random.default_rng(1)
    edges = [(a, b, 1.0) for c in range(4) for a in range(20 * c, 20 * c + 20) for b in range(a + 1, 20 * c + 20) if r.random() < 0.6] + [(int(a), int(b) + 40, 1.0) for a, b in r.integers(0, 40, (12, 2))]
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    rounds, settled = [], graphs.settled
    monkeypatch.setattr(graphs, "settled", lambda d, *gone: rounds.append("then" in d.columns) or settled(d, *gone))
    assert {x.id: x.community for x in graphs.leiden(df).collect()} == {i: i // 20 * 20 for i in range(80)}
    assert 1 <= sum(rounds) <= 4
    monkeypatch.setattr(graphs, "NODES", 20)
    assert {x.id: x.community for x in graphs.leiden(df).collect()} == {i: i // 20 * 20 for i in range(80)}


def test_refinement_does_not_copy_vectors_to_the_disk(spark, tmp_path_factory):
    """2,000 vectors of 256 bytes; a search by copies wrote each twelve times."""
    from granary.plans.registry import QUERIES

    folder = tmp_path_factory.mktemp("shared")
    spark.sparkContext.setCheckpointDir(str(folder))
    assert QUERIES["mixed_cluster_refinement"](spark, "/root/testdata/sf0.1").count() == 2000
    assert sum(f.stat().st_size for f in folder.rglob("*.parquet")) < 4 * 2000 * 256


def test_equal_cells_count_by_their_share(spark):
    """400 cells without a variable gene and 30 with some: equal cells have equal scores, whatever the partitions."""
    r = np.random.default_rng(2)
    rows = [(i, int(g), 2) for i in range(400) for g in (100 + i % 7, 110)] + [(400 + i, int(g), 1 + int(r.integers(30))) for i in range(30) for g in r.integers(0, 8, 5)]
    counts = spark.createDataFrame(rows, "cell_id long, gene_id long, count long").groupBy("cell_id", "gene_id").agg(F.sum("count").alias("count"))
    cells = counts.select("cell_id").distinct()
    run = lambda c, x: {y.cell_id: (y.doublet_score, y.is_doublet) for y in doublets.doublets(spark, c, x, genes=8, components=4, k=10).collect()}
    got = run(counts, cells)
    assert len(got) == 430 and all(0 < s < 0.2 for s, _ in (got[i] for i in range(400)))
    for kind in range(7):
        assert len({got[i] for i in range(kind, 400, 7)}) == 1
    assert run(counts.repartition(7), cells.repartition(5)) == got


@pytest.mark.parametrize("batch", [None, "label"])
def test_exact_search_keeps_ties_of_rounded_distances(spark, batch):
    """Rows whose distances are equal in four decimals are in order of their ids, as in SQL, over several tiles; 1 / 32 rounds up."""
    rows = [(0, [0.0, 0.0], 0)] + [(i, [1 + (2000 - i) * 1e-8, 0.0], i % 2) for i in range(1, 1500)] + [(9000, [0.03125, 0.0], 1), (9001, [5.0, 0.0], None)]
    v = spark.createDataFrame(rows, "id long, embedding array<double>, label int")
    got = {}
    for y in numeric.nearest(v.where("id = 0"), v, 3, batch).orderBy("rank").collect():
        got.setdefault(y[batch] if batch else 0, []).append((y.neighbour, y.distance))
    assert got == ({0: [(2, 1.0), (4, 1.0), (6, 1.0)], 1: [(9000, 0.0313), (1, 1.0), (3, 1.0)], None: [(9001, 5.0)]} if batch else {0: [(9000, 0.0313), (1, 1.0), (2, 1.0)]})


def test_gate_has_a_row_a_cell(spark):
    """The same as by cells and panels, and no join or shuffle of a row for each."""
    r = np.random.default_rng(4)
    rows = [(c, int(g), int(r.integers(0, 30))) for c in range(300) for g in r.choice(40, 4, replace=False)]
    counts = spark.createDataFrame(rows, "cell_id long, gene_id long, count long").where("cell_id % 17 > 0 or count > 0")
    cells = spark.range(310).select(F.col("id").alias("cell_id"), (F.col("id") % 3).alias("cluster"))
    panels = spark.createDataFrame([("abcd"[g % 4], g) for g in range(36)], "panel string, gene_id long")
    values = numeric.lognorm(counts)
    controls = gate.control_genes(values.groupBy("gene_id").agg(F.sum("value").alias("mean")), panels, bins=4, controls=5)
    marks = panels.where("panel = 'a' and gene_id % 8 = 0")
    scores = gate.panel_cell_scores(values, panels, controls, cells)
    for least in (0.1, -0.2):
        want = gate.lineage_gate(scores, cells, "cluster", gated="a", expressing=counts.where("count > 0").join(marks, "gene_id").select("cell_id"), least=least)
        got = gate.gated_lineages(numeric.lognorm_micro(counts), panels, controls, cells, "cluster", gated="a", marks=marks, least=least)
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
