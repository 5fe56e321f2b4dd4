"""Folders of samples, study metadata, report tables and vocabularies; sinks for tables and small texts. Paths go through Hadoop's file systems, so that any store that Spark reads will do."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.expressions import CANONICAL

#: Values looked at to tell whether a matrix holds counts; a documented bound of the probe.
PROBE = 100_000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def sample_folders(spark: SparkSession, base: str) -> list[tuple[str, str, str]]:
    """(group, sample, folder) below <base>/<group>/<sample>/, in order; a group folder without folders is one sample itself."""
    fs, top = _fs(spark, base)
    inside = lambda p: sorted(((s.getPath().getName(), s.getPath()) for s in fs.listStatus(p) if s.isDirectory()), key=lambda x: x[0])
    out = []
    for group, at in inside(top):
        below = inside(at)
        out += [(group, name, str(p)) for name, p in below] if below else [(group, group, str(at))]
    return out


def study_metadata(spark: SparkSession, folder: str) -> DataFrame | None:
    """The study's JSON: the first of GSE*_metadata.json, *_metadata.json, GSE*.json; None without any."""
    fs, _ = _fs(spark, folder)
    for pattern in ("GSE*_metadata.json", "*_metadata.json", "GSE*.json"):
        found = sorted(str(x.getPath()) for x in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, pattern)) or [])
        if found:
            return spark.read.option("multiLine", True).json(found[0])
    return None


def flat(df: DataFrame) -> DataFrame:
    """Structs as columns with dotted names, at any depth."""
    def fields(schema, at):
        for f in schema.fields:
            if hasattr(f.dataType, "fields"):
                yield from fields(f.dataType, [*at, f.name])
            else:
                yield [*at, f.name]

    return df.select(*[F.col(".".join(f"`{x}`" for x in p)).alias(".".join(p)) for p in fields(df.schema, [])])


def report_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A CSV, TSV or JSON table by its suffix, JSON flattened; None if it is missing, of another kind or can't be read."""
    kind = path.lower().removesuffix(".gz").rsplit(".", 1)[-1]
    try:
        if kind == "json":
            return flat(spark.read.option("multiLine", True).json(path))
        if kind in ("csv", "tsv", "txt"):
            return spark.read.option("header", True).option("inferSchema", True).option("sep", "," if kind == "csv" else "\t").csv(path)
    except Exception as e:  # a report goes on without the table
        if "AnalysisException" not in type(e).__name__:
            raise
    return None


def observations(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The cells of a stored cohort (see ``write_cohort``) without its matrix; only these columns are read."""
    df = spark.read.parquet(f"{path}/cells")
    return df.select(*columns) if columns else df


def integer_valued(df: DataFrame, column: str = "count", probe: int = PROBE) -> bool:
    """Whether the first stored values that are not zero are all integers; False without any."""
    x = F.col(column).cast("double")
    r = df.where(x != 0).limit(probe).agg(F.count("*").alias("n"), F.count_if(F.isnan(x) | (F.abs(x - F.rint(x)) > 1e-8 + 1e-5 * F.abs(F.rint(x)))).alias("bad")).first()
    return r.n > 0 and r.bad == 0


def raw_source(candidates: dict[str, DataFrame | None], column: str = "count") -> tuple[str, DataFrame]:
    """Name and table of the first candidate, in the given order, that holds integers; raises if none does."""
    for name, df in candidates.items():
        if df is not None and integer_valued(df, column):
            return name, df
    raise ValueError(f"no raw counts among {list(candidates)}")


def first_existing(spark: SparkSession, *paths: str | None) -> str | None:
    """The first of the paths that is there; Nones are passed over."""
    for p in paths:
        if p:
            fs, at = _fs(spark, p)
            if fs.exists(at):
                return p
    return None


def marker_reference(spark: SparkSession, *paths: str | None) -> DataFrame:
    """cell_type, gene of the first marker list that is there; no rows without one."""
    at = first_existing(spark, *paths)
    if at is None:
        return spark.createDataFrame([], "cell_type string, gene string")
    df = spark.read.option("header", True).csv(at)
    named = {c.lower(): c for c in df.columns}
    pick = lambda *names: F.col(next(named[n] for n in names if n in named))
    return df.select(F.trim(pick("cell_type", "celltype", "label")).alias("cell_type"), F.upper(F.trim(pick("gene", "marker", "gene_symbol", "symbol"))).alias("gene")).where("cell_type <> '' and gene <> ''").distinct()


def vocabulary(spark: SparkSession, path: str, source: str) -> DataFrame:
    """source, label: a list of lines, or the label column of a CSV or TSV; distinct, sorted."""
    kind = path.lower().rsplit(".", 1)[-1]
    if kind in ("csv", "tsv"):
        df = spark.read.option("header", True).option("sep", "," if kind == "csv" else "\t").csv(path)
        named = {c.lower(): c for c in df.columns}
        column = next((named[c] for c in ("label", "cell_type", "celltype", "raw_label") if c in named), None)
        if column is None:
            raise ValueError(f"{path}: no label column")
        df = df.select(F.col(f"`{column}`").alias("label"))
    else:
        df = spark.read.text(path).toDF("label")
    return df.select(F.lit(source).alias("source"), F.trim("label").alias("label")).where("label <> ''").distinct().orderBy("label")


def hierarchy(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Nodes, with the path as an array, and aliases, as ``write_hierarchy`` leaves them."""
    read = lambda name: spark.read.option("header", True).csv(f"{folder}/{name}.csv")
    return read("nodes").withColumns({"path": F.split("path", r"\|"), "level": F.col("level").cast("int")}), read("aliases")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, digest, size of a checksum list; lines are '<digest> [<size>] <file>', # starts a comment. Malformed lines raise."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "^﻿|#.*$", "")).alias("v")).where("v <> ''")
    rx = r"^([0-9a-fA-F]{64})\s+(?:(\d+)\s+)?\*?(\S.*)$"
    if lines.where(~F.col("v").rlike(rx)).limit(1).count():
        raise ValueError(f"{path}: malformed line")
    return lines.select(F.regexp_extract("v", rx, 3).alias("file"), F.lower(F.regexp_extract("v", rx, 1)).alias("digest"), F.nullif(F.regexp_extract("v", rx, 2), F.lit("")).cast("long").alias("size"))


def verified(spark: SparkSession, folder: str, listed: DataFrame, *, required: bool = False) -> DataFrame:
    """file, status of the files of a folder against a manifest: ok, size, digest, unlisted or missing. With ``required``, raises unless all are ok."""
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("have"), F.sha2("content", 256).alias("found"))
    d = files.join(listed, "file", "full").select("file", F.when(F.col("digest").isNull(), "unlisted").when(F.col("found").isNull(), "missing").when(F.col("size") != F.col("have"), "size").when(F.col("digest") != F.col("found"), "digest").otherwise("ok").alias("status"))
    if required and (bad := d.where("status <> 'ok'").limit(5).collect()):
        raise ValueError(f"files that are not as listed: {[(r.file, r.status) for r in bad]}")
    return d


def write_atomic(spark: SparkSession, path: str, write) -> None:
    """``write(temporary path)`` beside the target, then two renames: what was there goes aside first and is deleted last. A failure at any point puts it back."""
    fs, to = _fs(spark, path)
    named = lambda kind: spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{kind}-{uuid.uuid4().hex}")
    new, old, done = named("tmp"), named("old"), False
    try:
        write(new.toString())
        if fs.exists(to) and not fs.rename(to, old):
            raise OSError(f"can't move {path} aside")
        done = fs.rename(new, to)
        if not done:
            raise OSError(f"can't rename to {path}")
    finally:
        if fs.exists(old):
            if done:
                fs.delete(old, True)
            else:
                fs.rename(old, to)
        if fs.exists(new):
            fs.delete(new, True)


def write_csv(df: DataFrame, path: str, *, one_file: bool = False) -> None:
    """CSV with a header, as a folder of parts; one file only where asked, for tables that people read."""
    write_atomic(df.sparkSession, path, lambda p: (df.coalesce(1) if one_file else df).write.option("header", True).csv(p))


def write_canonical(df: DataFrame, path: str, *, one_file: bool = False) -> None:
    """CSV under the canonical column names; values stay."""
    taken, names = set(df.columns), {}
    for c in df.columns:
        to = CANONICAL.get(c)
        if to and to not in taken:
            taken.add(to)
            names[c] = to
    write_csv(df.withColumnsRenamed(names), path, one_file=one_file)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as UTF-8, written beside its place and renamed."""
    def put(part):
        fs, at = _fs(spark, part)
        out = fs.create(at)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    write_atomic(spark, path, put)


def write_consensus(df: DataFrame, folder: str, name: str) -> None:
    """The consensus table, a row a cluster."""
    write_csv(df, f"{folder}/{name}_consensus", one_file=True)


def deconvolution_ready(counts: DataFrame, cells: DataFrame, drop: tuple[str, ...] = ("leiden", "pct_counts_mt", "total_counts")) -> tuple[DataFrame, DataFrame]:
    """Raw counts and cells without what was derived; the cells keep sample and celltype, and must have both."""
    if missing := {"sample", "celltype"} - set(cells.columns):
        raise ValueError(f"cells lack {sorted(missing)}")
    return counts.join(cells.select("cell_id"), "cell_id", "left_semi").select("cell_id", "gene_id", "count"), cells.drop(*drop)


def export_deconvolution(spark: SparkSession, source: str, target: str | None = None) -> str:
    """Reads a stored cohort, makes it ready and writes it beside, as <name>_deconvolution_ready."""
    to = target or f"{source.rstrip('/')}_deconvolution_ready"
    counts, cells = deconvolution_ready(spark.read.parquet(f"{source}/counts").drop("sample"), spark.read.parquet(f"{source}/cells"))
    write_atomic(spark, to, lambda p: (counts.write.parquet(f"{p}/counts"), cells.write.parquet(f"{p}/cells")))
    return to


def write_10x(counts: DataFrame, cells: DataFrame, genes: DataFrame, folder: str) -> tuple[int, int, int]:
    """matrix.mtx with its header, barcodes.tsv and features.tsv of one sample; returns genes, cells and entries.

    Numbers are places in the sorted lists. Ranks are made over the lists of cells and genes, which are dimensions, never over the entries. The text format wants one file each, so it is for one sample at a time; entries are written by one task.
    """
    g = genes.select("gene_id", "gene").distinct().withColumn("g", F.row_number().over(Window.orderBy("gene_id")))
    c = cells.select("cell_id").distinct().withColumn("c", F.row_number().over(Window.orderBy("cell_id")))
    entries = counts.where("count <> 0").join(g, "gene_id").join(c, "cell_id").select("g", "c", F.col("count").cast("long").alias("count"))
    shape = (g.count(), c.count(), entries.count())
    spark = counts.sparkSession
    head = spark.createDataFrame([(0, 0, "%%MatrixMarket matrix coordinate integer general"), (0, 1, " ".join(map(str, shape)))], "c int, g int, value string")
    body = head.unionAll(entries.select("c", "g", F.concat_ws(" ", "g", "c", "count"))).repartition(1).sortWithinPartitions("c", "g").select("value")
    one = lambda df, name: write_atomic(spark, f"{folder}/{name}", lambda p: _single(spark, df, p))
    one(body, "matrix.mtx")
    one(c.orderBy("c").select(F.col("cell_id").cast("string").alias("value")), "barcodes.tsv")
    one(g.orderBy("g").select(F.concat_ws("\t", F.col("gene_id").cast("string"), "gene", F.lit("Gene Expression")).alias("value")), "features.tsv")
    return shape


def _single(spark: SparkSession, lines: DataFrame, path: str) -> None:
    """Lines as one plain file at the path."""
    parts = f"{path}.parts"
    lines.coalesce(1).write.text(parts)
    fs, at = _fs(spark, parts)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(parts, "part-*"))
    fs.rename(found[0].getPath(), spark._jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(at, True)


def run_manifest(spark: SparkSession, path: str, *, name: str, seed: int, params: dict, cells: DataFrame, genes: DataFrame, extra: dict | None = None) -> dict:
    """A JSON record of a run: seed, time, sizes, parameters, versions; written and returned."""
    import datetime
    import platform

    record = {"analysis_name": name, "seed": seed, "created": datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds"), "n_obs": cells.count(), "n_vars": genes.count(), "params": params, "versions": {"spark": spark.version, "python": platform.python_version()}} | (extra or {})
    write_text(spark, path, json.dumps(record, indent=2, sort_keys=True, default=str))
    return record


def resource_rows(spark: SparkSession, record: dict) -> DataFrame:
    """A run record as (label, value) rows, nested keys dotted, lists joined; empty values are left out."""
    def walk(x, at):
        for k, v in x.items():
            if isinstance(v, dict):
                yield from walk(v, [*at, k])
            elif v not in (None, "", []):
                yield ".".join([*at, k]), ", ".join(map(str, v)) if isinstance(v, list) else str(v)

    return spark.createDataFrame(list(walk(record, [])), "label string, value string")


def summary_fields(lines: DataFrame) -> DataFrame:
    """lines (value) of a summary text -> kind, name, value: 'key: value' fields, and '<name>: <n> cells' rows as counts."""
    v = F.trim("value")
    rx_n, rx_f = r"^(.+?)\s*:\s*([\d,]+)\s+cells?\b", r"^([^:]+?)\s*:\s*(\S.*)$"
    n = F.regexp_extract(v, rx_n, 2)
    return lines.where(v.rlike(rx_f)).select(F.when(n != "", "count").otherwise("field").alias("kind"), F.when(n != "", F.regexp_extract(v, rx_n, 1)).otherwise(F.regexp_extract(v, rx_f, 1)).alias("name"), F.when(n != "", F.replace(n, F.lit(","), F.lit(""))).otherwise(F.regexp_extract(v, rx_f, 2)).alias("value"))


def write_hierarchy(nodes: DataFrame, aliases: DataFrame, folder: str) -> None:
    """Nodes (path joined by |) and aliases as CSV, which ``hierarchy`` reads."""
    write_csv(nodes, f"{folder}/nodes.csv", one_file=True)
    write_csv(aliases, f"{folder}/aliases.csv", one_file=True)


def clean_up(spark: SparkSession, folder: str, *patterns: str) -> int:
    """Deletes what the patterns name directly below the folder; returns how many."""
    fs, top = _fs(spark, folder)
    found = {str(s.getPath()): s.getPath() for p in patterns for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(top, p)) or []}
    return sum(bool(fs.delete(p, True)) for p in found.values())


def output_folder(spark: SparkSession, name: str, root: str | None, *, create: bool = True) -> str:
    """The folder of an output. A relative name needs a root and must stay below it."""
    import posixpath

    if not name.strip():
        raise ValueError("an output needs a name")
    if "://" not in name and not name.startswith("/"):
        if not root:
            raise ValueError(f"{name!r} is relative: a root is needed")
        parts = posixpath.normpath(name)
        if parts == ".." or parts.startswith("../"):
            raise ValueError(f"{name!r} leaves {root}")
        name = f"{root.rstrip('/')}/{parts}"
    if create:
        fs, at = _fs(spark, name)
        fs.mkdirs(at)
    return name
