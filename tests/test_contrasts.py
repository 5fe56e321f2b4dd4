"""Contrasts on simulated donors, enrichment against exact sums, options."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.operators import contrasts, enrichment, numeric, policy


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def donors(spark, effect, genes=300, seed=0):
    rng = np.random.default_rng(seed)
    base, disp = rng.gamma(2, 60, genes) + 5, 0.05
    rows = []
    for arm, name in enumerate(("CONTROL", "CASE")):
        for k in range(4):
            depth = rng.uniform(0.7, 1.4)
            mu = base * depth * np.where(np.arange(genes) < genes // 10, 2.0 ** (effect * arm), 1)
            y = rng.negative_binomial(1 / disp, 1 / (1 + mu * disp))
            rows += [(f"{name}_{k}", name, g, int(v)) for g, v in enumerate(y)]
    df = spark.createDataFrame(rows, "sample string, grp string, gene_id long, count long")
    return df.select("sample", "gene_id", "count"), df.select("sample", "grp").distinct()


def test_null_and_spiked_contrasts(spark):
    bulk, samples = donors(spark, 0.0)
    null = contrasts.likelihood_contrast(bulk, samples, numeric.size_factors(bulk), "CASE", "CONTROL", effect=0.0)
    assert null.where("p_value_adj < 0.05").count() <= 6
    assert 0.01 < null.where("p_value < 0.05").count() / 300 < 0.12
    bulk, samples = donors(spark, 3.0)
    out, records = contrasts.all_pairs(bulk, samples)
    got = {r.gene_id: r for r in out.collect()}
    assert [(r["focus_group"], r["reference_group"], r["status"]) for r in records] == [("CASE", "CONTROL", "ok")]
    assert sum(got[g].regulation == "up" for g in range(30)) >= 27 and sum(got[g].regulation != "no_change" for g in range(30, 300)) <= 5
    assert abs(np.median([got[g].log2_fold_change_mle for g in range(30)]) - 3) < 0.3
    assert all(abs(r.log2_fold_change) <= abs(r.log2_fold_change_mle) + 1e-6 for r in got.values())
    assert 0.02 < np.median([r.dispersion for r in got.values()]) < 0.12
    assert got[0].unit_of_replication == "sample" and records[0]["n_up"] >= 27


def test_driver_and_boundaries(spark):
    bulk, samples = donors(spark, 2.0, genes=40, seed=1)
    cells = bulk.select("sample").distinct().join(samples, "sample").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumns({"cell_id": F.concat_ws("_", "sample", "k"), "type": F.when(F.col("k") <= 2, "rare").otherwise("T")})
    counts = bulk.join(cells.select("sample", "cell_id"), "sample").select("cell_id", "gene_id", (F.col("count") / 12).cast("long").alias("count"))
    out, records = contrasts.pseudobulk_de(counts, cells, celltype="type")
    assert {r["stratum"]: r["status"] for r in records} == {"overall": "ok", "T": "ok"}
    assert {r[0] for r in out.select("stratum").distinct().collect()} == {"overall", "T"}
    with pytest.raises(ValueError):
        contrasts.pseudobulk_de(counts, cells.where("grp = 'CASE'"))
    with pytest.raises(ValueError):
        contrasts.check_uncorrected(counts.withColumn("X_harmony", F.lit(1)))
    values = counts.withColumn("value", F.log1p("count")).drop("count")
    level = contrasts.cell_level(values, cells, "type")
    assert {r[0] for r in level.select("type").distinct().collect()} == {"T", "rare"} and level.where("replication like 'pseudo%'").count() == level.count()
    assert contrasts.provenance(samples, None)["contrasts"] == ["CASE vs CONTROL"]
    assert contrasts.shrinkage_coefficient(["Intercept", "grp[T.B]", "grp[T.A]"], "A") == "grp[T.A]" and contrasts.shrinkage_coefficient(["Intercept", "x"], "A") == "x"
    m = contrasts.without_p_values(spark.createDataFrame([("0", "g1", 2, 0.1), ("0", "g2", 1, 0.2)], "cluster string, gene string, at int, pvals double"), "cluster", "at")
    assert {r.gene: r["rank"] for r in m.collect()} == {"g2": 1, "g1": 2} and "pvals" not in m.columns


def test_enrichment(spark):
    u = spark.createDataFrame([(i,) for i in range(20)], "gene_id long")
    lists = spark.createDataFrame([("a", i) for i in (0, 1, 2, 3, 99)] + [("b", 19)], "cluster string, gene_id long")
    sets = spark.createDataFrame([("s", i) for i in (0, 1, 2, 10, 11)] + [("t", 15)], "set string, gene_id long")
    got = {(r.cluster, r.set): r for r in enrichment.over_represented(lists, sets, u, "cluster").collect()}
    want = sum(math.comb(5, k) * math.comb(15, 4 - k) for k in (3, 4)) / math.comb(20, 4)
    assert set(got) == {("a", "s")} and abs(got["a", "s"].p_value - want) < 1e-9 and got["a", "s"].genes == "0;1;2"
    paths = spark.createDataFrame([("d", "P", 0.01, 1.0, [1.0, 0.0]), ("d", "Q", 0.02, 1.0, [0.95, 0.05]), ("d", "R", 0.03, 1.0, [0.0, 1.0]), ("e", "X", 0.1, 1.0, None), ("e", "x ", 0.2, 1.0, None)], "db string, pathway string, padj double, score double, vector array<double>")
    assert sorted(r.pathway for r in enrichment.semantic_dedup(paths, "db").collect()) == ["P", "R", "X"]
    sig = enrichment.signature_scores(spark.createDataFrame([("0", "A"), ("0", "B")], "cluster string, gene string"), spark.createDataFrame([("d", "A", 0.2), ("d", "B", 0.5), ("d", "C", 1.0)], "signature string, gene string, weight double"), "cluster").first()
    assert (sig.score, sig.hits) == (0.7, ["B", "A"])
    rel = enrichment.relevant_markers(spark.createDataFrame([("T cell", "CD3E"), ("Neuron", "X")], "celltype string, gene string"), spark.createDataFrame([("CD8 T cells",)], "label string"))
    assert [r.gene for r in rel.collect()] == ["CD3E"]


def test_options(spark):
    assert policy.thresholds("", None, 10) == policy.Thresholds(200, 6000, 10.0)
    for bad in ({"min_genes": True}, {"min_genes": -1}, {"max_genes": 100}, {"max_mito": 0}, {"max_mito": 101}):
        with pytest.raises(ValueError):
            policy.thresholds(**bad)
    assert policy.resolution_column(0.2) == "leiden_res_0_2" and policy.resolutions([1, 0.2, 0.20]) == [0.2, 0.5, 1.0]
    with pytest.raises(ValueError):
        policy.resolutions([0])
    assert policy.excluded_tiers("x") == ["x"] and policy.excluded_tiers([]) == ["Low/Review"]
    assert policy.looks_like_ensembl(spark.createDataFrame([("ensg1",), ("ENSG2",), ("x",)], "id string"), "id") and not policy.looks_like_ensembl(spark.createDataFrame([("a",)], "id string"), "id")
    with pytest.raises(ValueError, match="did you mean 'seed'"):
        policy.merged({"seed": 1}, seeds=2)
    assert policy.flattened({"a": {"seed": 1, "b": {"zz": 2}}}, {"seed"}) == ({"seed": 1}, ["a.b.zz"])
    assert policy.contract_faults({"a", "mode"}, lambda a, b: 0, ours={"mode"}) == {"not_taken": [], "not_set": ["b"]}
    cells = spark.createDataFrame([("b1", "A"), ("b2", "B")], "batch string, grp string")
    assert "nested" in policy.integration_policy(cells, "harmony", "batch")["warnings"][0] and policy.integration_policy(cells, None, None)["scope"] == "none"
    with pytest.raises(ValueError):
        policy.preflight(spark.createDataFrame([("x", "fail", 1)], "check string, status string, n long"))
    assert policy.biocontext("9606", "auto", lambda: "lung") == ("human", "lung")
    assert policy.refined_model("g", {"dominant_lineage": "Immune", "fraction": 0.95}, {"Immune": "i"}) == "i"
    assert policy.rerun_plan(["b c", "a"]) == "annotate --held-out a --out heldout_a\nannotate --held-out 'b c' --out heldout_b_c\n"
    assert policy.annotation_provenance({"m": 1}, {"m": 2})["changed"] == ["m"]
