"""Sources and sinks on small folders."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from granary.sources import cohorts as C
from granary.sources import tables as T


def test_folders_and_metadata(spark, tmp_path):
    for p in ("B/s2", "B/s1", "A"):
        (tmp_path / p).mkdir(parents=True)
    assert [(g, s) for g, s, _ in C.sample_folders(spark, str(tmp_path))] == [("A", "A"), ("B", "s1"), ("B", "s2")]
    assert C.study_metadata(spark, str(tmp_path)) is None
    (tmp_path / "GSE1.json").write_text('{"title": "other"}')
    (tmp_path / "GSE1_metadata.json").write_text(json.dumps({"title": "t", "samples": [{"title": "a"}], "x": {"y": {"z": 1}}}))
    assert C.study_metadata(spark, str(tmp_path)).first().title == "t"
    assert C.report_table(spark, str(tmp_path / "GSE1_metadata.json")).select("`x.y.z`").first()[0] == 1
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n")
    assert C.report_table(spark, str(tmp_path / "t.tsv")).first().asDict() == {"a": 1, "b": "x"}
    assert C.report_table(spark, str(tmp_path / "none.csv")) is None and C.report_table(spark, str(tmp_path / "t.doc")) is None


def test_raw_sources(spark):
    part, whole = spark.createDataFrame([(0.0,), (1.5,)], "count double"), spark.createDataFrame([(0.0,), (3.0,)], "count double")
    assert C.integer_valued(whole) and not C.integer_valued(part) and not C.integer_valued(whole.where("count = 0"))
    assert C.raw_source({"counts": None, "x": part, "raw": whole})[0] == "raw"
    with pytest.raises(ValueError):
        C.raw_source({"x": part})


def test_vocabularies_and_manifests(spark, tmp_path):
    (tmp_path / "v.txt").write_text("b\na\n\na\n")
    (tmp_path / "v.csv").write_text("id,Cell_Type\n1,T\n2,B\n")
    assert [r.label for r in C.vocabulary(spark, str(tmp_path / "v.txt"), "s").collect()] == ["a", "b"]
    assert [r.label for r in C.vocabulary(spark, str(tmp_path / "v.csv"), "s").collect()] == ["B", "T"]
    (tmp_path / "m.csv").write_text("cell_type,marker\nT,cd3e\nT,CD3E\nB, ms4a1\n")
    assert sorted(C.marker_reference(spark, None, str(tmp_path / "no.csv"), str(tmp_path / "m.csv")).collect()) == [("B", "MS4A1"), ("T", "CD3E")]
    assert C.marker_reference(spark, None).collect() == []
    files = tmp_path / "files"
    files.mkdir()
    for k, v in (("a.bin", b"a"), ("b.bin", b"bb"), ("c.bin", b"c"), ("e.bin", b"e")):
        (files / k).write_bytes(v)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    (tmp_path / "SHA256SUMS.txt").write_text(f"# list\n{sha(b'a')} 1 a.bin\n{sha(b'bb')} 3 b.bin\n{sha(b'x')}  c.bin\n{sha(b'd')}  d.bin\n")
    listed = C.manifest(spark, str(tmp_path / "SHA256SUMS.txt"))
    assert {r.file: r.status for r in C.verified(spark, str(files), listed).collect()} == {"a.bin": "ok", "b.bin": "size", "c.bin": "digest", "d.bin": "missing", "e.bin": "unlisted"}
    with pytest.raises(ValueError):
        C.verified(spark, str(files), listed, required=True)
    (tmp_path / "bad.txt").write_text("nonsense\n")
    with pytest.raises(ValueError):
        C.manifest(spark, str(tmp_path / "bad.txt"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    at = str(tmp_path / "out")
    C.write_csv(df, at)
    with pytest.raises(ZeroDivisionError):
        C.write_atomic(spark, at, lambda p: 1 / 0)
    assert spark.read.option("header", True).csv(at).first().b == "x" and [p.name for p in tmp_path.iterdir()] == ["out"]
    C.write_text(spark, str(tmp_path / "t.txt"), "grüß\n")
    assert (tmp_path / "t.txt").read_text("utf-8") == "grüß\n"
    record = C.run_manifest(spark, str(tmp_path / "run.json"), name="n", seed=1, params={"k": [1, 2]}, cells=df, genes=df)
    assert json.loads((tmp_path / "run.json").read_text())["n_obs"] == 1
    rows = {r.label: r.value for r in C.resource_rows(spark, record).collect()}
    assert rows["params.k"] == "1, 2" and rows["seed"] == "1"
    assert C.clean_up(spark, str(tmp_path), "*.json", "*.log") == 1
    assert C.output_folder(spark, "a/../b", str(tmp_path)) == f"{tmp_path}/b" and (tmp_path / "b").is_dir()
    for name, root in (("x", None), ("../x", str(tmp_path)), (" ", str(tmp_path))):
        with pytest.raises(ValueError):
            C.output_folder(spark, name, root)
    lines = spark.createDataFrame([("Samples: 4",), ("  T cell: 1,200 cells",), ("nothing",)], "value string")
    assert sorted(map(tuple, C.summary_fields(lines).collect())) == [("count", "T cell", "1200"), ("field", "Samples", "4")]


def test_10x_round_trip(spark, tmp_path):
    counts = spark.createDataFrame([(7, 1, 3), (7, 2, 0), (9, 2, 5)], "cell_id long, gene_id long, count long")
    cells, genes = spark.createDataFrame([(7, "s", "T"), (9, "s", "B")], "cell_id long, sample string, celltype string"), spark.createDataFrame([(1, "G1"), (2, "G2"), (3, "G3")], "gene_id long, gene string")
    assert C.write_10x(counts, cells, genes, str(tmp_path)) == (3, 2, 2)
    assert (tmp_path / "matrix.mtx").read_text().splitlines()[:2] == ["%%MatrixMarket matrix coordinate integer general", "3 2 2"]
    got = sorted((r.barcode, r.feature_name, r["count"]) for r in T.matrix_market(spark, str(tmp_path)).collect())
    assert got == [("7", "G1", 3.0), ("9", "G2", 5.0)]
    T.write_cohort(counts, cells.withColumn("leiden", F.lit("0")), genes, str(tmp_path / "cohort"))
    assert C.observations(spark, str(tmp_path / "cohort"), "cell_id").columns == ["cell_id"]
    to = C.export_deconvolution(spark, str(tmp_path / "cohort"))
    assert spark.read.parquet(f"{to}/cells").columns == ["cell_id", "sample", "celltype"] and spark.read.parquet(f"{to}/counts").count() == 3
    with pytest.raises(ValueError):
        C.deconvolution_ready(counts, cells.drop("celltype"))


def test_hierarchy_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("a", "", 0, "a"), ("b", "a", 1, "a|b")], "node_id string, parent_id string, level int, path string")
    C.write_hierarchy(nodes, spark.createDataFrame([("v", "A", "a")], "vocabulary string, raw_label string, node_id string"), str(tmp_path))
    got, aliases = C.hierarchy(spark, str(tmp_path))
    assert {r.node_id: (r.level, r.path) for r in got.collect()} == {"a": (0, ["a"]), "b": (1, ["a", "b"])} and aliases.first().node_id == "a"
