"""Small cases with answers worked out by hand."""

import gzip

import pytest
from pyspark.sql import functions as F

from granary.functions import expressions as X
from granary.operators import cohort, consensus, metrics, numeric
from granary.sources import tables as T
from granary.streaming import metrics as S


def test_matrix_market(spark, tmp_path):
    (tmp_path / "barcodes.tsv").write_text("A\nB\n")
    (tmp_path / "features.tsv").write_text("f1\tG1\tGene Expression\nf2\n")
    with gzip.open(tmp_path / "matrix.mtx.gz", "wt") as f:
        f.write("%%MatrixMarket matrix coordinate integer general\n2 2 3\n1 1 7\n2 1 1\n2 2 4\n")
    got = sorted(tuple(r) for r in T.matrix_market(spark, str(tmp_path)).select("barcode", "feature_name", "count").collect())
    assert got == [("A", "G1", 7.0), ("A", "f2", 1.0), ("B", "f2", 4.0)]
    with pytest.raises(FileNotFoundError):
        T.matrix_market(spark, str(tmp_path / "none"))
    (tmp_path / "matrix.mtx.gz").unlink()
    (tmp_path / "matrix.mtx").write_text("nonsense\n")
    with pytest.raises(ValueError):
        T.matrix_market(spark, str(tmp_path))


def test_raw_count_check(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (-1.0,), (float("nan"),)], "count double")
    assert tuple(T.check_raw_counts(df).first()) == (1, 1, 1)


def test_group_map(spark, tmp_path):
    p = tmp_path / "g.csv"
    p.write_text("Sample,GROUP\ns1,A\ns2,_x\ns3,nan\ns1,B\n")
    assert [tuple(r) for r in T.group_map(spark, str(p)).collect()] == [("s1", "B")]


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "names int, padj int, p_value_adj int")
    assert T.canonical(df).columns == ["gene", "padj", "p_value_adj"]


def test_qc_by_hand(spark):
    counts = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 1), ("c", 2, 9)], "cell_id string, gene_id long, count long")
    genes = spark.createDataFrame([(1, False), (2, True)], "gene_id long, mito boolean")
    cells = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "cell_id string")
    m = {r.cell_id: tuple(r)[1:] for r in cohort.qc_metrics(counts, genes, cells).collect()}
    assert m == {"a": (2, 10, 50.0), "b": (1, 1, 0.0), "c": (1, 9, 100.0), "d": (0, 0, None)}
    kept = cohort.qc_filter(cohort.qc_metrics(counts, genes, cells), min_genes=0, max_genes=6, max_mito=60.0)
    assert sorted(r.cell_id for r in kept.collect()) == ["a", "b"]


def test_pseudobulk_gate(spark):
    cells = spark.createDataFrame([(f"{s}{i}", s, "A" if s < "s3" else "B") for s, n in (("s1", 12), ("s2", 12), ("s3", 12), ("s4", 5)) for i in range(n)], "cell_id string, sample string, grp string")
    counts = cells.select("cell_id", F.lit(1).cast("long").alias("gene_id"), F.lit(2).cast("long").alias("count"))
    got = {r["sample"]: r["count"] for r in cohort.pseudobulk(counts, cells, "sample").collect()}
    assert got == {"s1": 24, "s2": 24, "s3": 24}


def test_tally_cases(spark):
    votes = [("u", v, "T", 0.5) for v in "abc"] + [("m", "a", "T", 0.9), ("m", "b", "T", 0.9), ("m", "c", "B", 0.9)] + [("t", "a", "T", 0.2), ("t", "b", "B", 0.9)] + [("n", "a", "unknown", 1.0), ("n", "b", None, 1.0)]
    t = {r.k: r for r in consensus.tally(spark.createDataFrame(votes, "k string, voter string, label string, confidence double"), "k").collect()}
    assert t["u"].unanimous and not t["u"].majority
    assert t["m"].winner == "T" and t["m"].majority
    assert t["t"].winner == "B" and t["t"].tied and not t["t"].majority
    assert t["n"].winner == "Unassigned" and t["n"].voters == 0


def test_mixed_cluster(spark):
    rows = [("x", "T")] * 11 + [("x", "NK")] * 9 + [("y", "T")] * 15 + [("y", "NK")] * 5
    m = {r.c: r for r in consensus.mode_by_cluster(spark.createDataFrame(rows, "c string, l string"), "c", "l").collect()}
    assert (m["x"].dominant_fraction, m["x"].second_fraction, m["x"].entropy, m["x"].mixed) == (0.55, 0.45, 0.9928, True)
    assert m["y"].mixed and m["y"].dominant_fraction == 0.75


def test_harmonise_and_lineage(spark):
    df = spark.createDataFrame([("Kupffer cell",), (None,), ("CD56bright",), ("odd",), ("CD561",)], "l string")
    assert [r[0] for r in df.select(consensus.harmonise(F.col("l"))).collect()] == ["Macrophage", "Unassigned", "NK cell", "Other: odd", "Other: CD561"]
    assert [r[0] for r in df.select(consensus.coarse_lineage(F.col("l"))).collect()] == ["Immune", "Other", "Immune", "Other", "Other"]


def test_metrics_perfect_and_constant(spark):
    df = spark.createDataFrame([("a", "a", "a"), ("b", "b", "a"), ("b", "b", "a")], "t string, p string, c string")
    assert metrics.macro_f1(df, "t", "p").first().macro_f1 == 1.0
    assert metrics.macro_f1(df, "t", "c").first().macro_f1 == 0.25
    assert metrics.agreement(df, "t", "p").first().ari == 1.0


def test_risk_coverage_by_hand(spark):
    df = spark.createDataFrame([(1, True, 0.9), (2, False, 0.8), (3, True, None)], "id int, ok boolean, c double")
    assert [(r.k, r.error) for r in metrics.risk_coverage(df, "ok", "c", "id").orderBy("k").collect()] == [(1, 0.0), (2, 0.5), (3, 0.333333)]


def test_benjamini_hochberg_nulls(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.04), (3, 0.03), (4, None)], "i int, p double")
    assert [r.q for r in numeric.adjusted(df, "p", "i").orderBy("i").collect()] == [0.03, 0.04, 0.04, None]


def test_evidence_confidence(spark):
    df = spark.createDataFrame([("high", 4, 2, 0, "T", 5), ("high", 4, 0, 0, "T", 5), ("high", 4, 2, 0, "unknown", 5), ("high", 0, 1, 3, "T", 0)], "b string, s int, c int, x int, l string, a int")
    got = [round(r[0], 6) for r in df.select(X.evidence_confidence(*[F.col(k) for k in "bscxla"])).collect()]
    assert got == [1.0, 0.6, 0.2, 0.25]


def test_safe_names(spark):
    df = spark.createDataFrame([("a/b: c",), ("con",), ("..",), ("x" * 200,)], "s string")
    got = [r[0] for r in df.select(X.safe_name(F.col("s"))).collect()]
    assert got == ["a_b_c", "_con", "unnamed", "x" * 120]


def test_label_propagation(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    e = [(a, b, 1.0) for g in (0, 10) for a in range(g, g + 4) for b in range(a + 1, g + 4)] + [(0, 10, 0.1)]
    got = {r.id: r.label for r in numeric.label_propagation(spark.createDataFrame(e, "src long, dst long, weight double"), 6).collect()}
    assert len({got[i] for i in range(4)}) == 1 and len({got[i] for i in range(10, 14)}) == 1


def test_streamed_totals_equal_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = {(r.start, r.event_type): r.n for r in S.windowed_totals(spark.read.parquet(src)).collect()}
    q = S.windowed_totals(spark.readStream.schema(spark.read.parquet(src).schema).parquet(src + "*")).writeStream.outputMode("complete").format("memory").queryName("totals").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.start, r.event_type): r.n for r in spark.table("totals").collect()} == batch


def test_resolver_ladder(spark):
    from granary.operators import resolver

    nodes = spark.createDataFrame([("t_cell", 1), ("gd_t_cell", 2), ("mono", 1)], "node_id string, level int")
    aliases = spark.createDataFrame([("T cells", "t_cell"), ("gamma-delta T cell", "gd_t_cell"), ("CD14+ monocyte", "mono"), ("classical monocyte", "mono")], "raw_label string, node_id string")
    labels = spark.createDataFrame([("T cells",), ("T-cell",), ("γδ T cell",), ("γ-δ T cells",), ("MONO",), ("CD14 + Monocyte",), ("clasical monocyte",), ("",), (None,), ("hepatocyte",)], "label string")
    got = {r.label: (r.node_id, r.confidence, r.method) for r in resolver.resolve(labels, aliases, nodes).collect()}
    assert got["T cells"] == ("t_cell", 1.0, "exact") and got["T-cell"] == ("t_cell", 0.95, "normalised")
    assert got["γ-δ T cells"] == ("gd_t_cell", 0.95, "normalised") and got["MONO"] == ("mono", 1.0, "node_id")
    assert got["CD14 + Monocyte"] == ("mono", 0.95, "normalised") and got["clasical monocyte"] == ("mono", 0.55, "fuzzy")
    assert got[""][2] == got[None][2] == got["hepatocyte"][2] == "unresolved"


def test_exact_rank_sum_by_enumeration(spark):
    from itertools import combinations

    for n1, n2 in ((3, 3), (4, 6), (5, 5), (3, 7)):
        us = [sum(1 for x in some for y in set(range(n1 + n2)) - set(some) if x > y) for some in combinations(range(n1 + n2), n1)]
        assert numeric.rank_sum_counts(n1, n2) == [us.count(u) for u in range(n1 * n2 + 1)]
    data = [("g", "a", float(v)) for v in (1, 2, 3, 4)] + [("g", "b", float(v)) for v in (5, 6, 7, 3.5)] + [("h", x, 1.0) for x in "aaabbb"] + [("i", "a", 1.0), ("i", "b", 2.0)]
    got = {r.g: (r.u, r.p, r.method) for r in numeric.mann_whitney_exact(spark.createDataFrame(data, "g string, arm string, v double"), "v", "arm", "a", "b", "g").collect()}
    us = [sum(1 for x in some for y in set(range(8)) - set(some) if x > y) for some in combinations(range(8), 4)]
    assert got["g"] == (1.0, round(2 * sum(u <= 1 for u in us) / len(us), 6), "exact")
    assert got["h"][2] == "normal" and got["i"][1:] == (None, None)
