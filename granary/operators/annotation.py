"""Annotation evidence: references, panels, subtypes, literature, exports and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.expressions import LOW_INFORMATION, abstains, incomplete


def union_samples(frames: list[DataFrame], sample: list[str]) -> DataFrame:
    """Outer union of samples on gene symbols: triples are appended, absent is 0, cells get their sample's prefix."""
    out = None
    for f, s in zip(frames, sample):
        f = f.withColumn("cell_id", F.concat_ws("_", F.lit(s), F.col("cell_id").cast("string")))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_missing, complete of label columns."""
    one = df.agg(*[F.count_if(incomplete(F.col(c))).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "n_missing").withColumn("complete", F.col("n_missing") == 0)


def reuse_column(report: dict[str, bool], preferred: list[str], explicit: str | None = None) -> str | None:
    """Which complete final column an analysis may reuse: the explicit one, else the first of the preferred."""
    if explicit is not None:
        return explicit if report.get(explicit) else None
    return next((c for c in preferred if report.get(c)), None)


def stamp_inclusion(table: DataFrame, cells: DataFrame, cluster: str) -> DataFrame:
    """include = any cell of the cluster is included; clusters without cells stay included."""
    inc = cells.groupBy(cluster).agg(F.max("include").alias("include"))
    return table.join(inc, cluster, "left").withColumn("include", F.coalesce("include", F.lit(True)))


def write_back(genes: DataFrame, selected: DataFrame) -> DataFrame:
    """The selection on all genes; what it lacks is False."""
    return genes.join(selected.select("gene_id", "highly_variable"), "gene_id", "left").withColumn("highly_variable", F.coalesce("highly_variable", F.lit(False)))


def unique_panel_genes(panels: DataFrame) -> DataFrame:
    """Panel rows of genes that lie in one panel only."""
    one = panels.groupBy("gene_id").agg(F.countDistinct("panel").alias("k")).where("k = 1")
    return panels.join(one, "gene_id", "left_semi").distinct()


def top_panel(markers: DataFrame, panel: str, gene: str, score: str, k: int) -> DataFrame:
    """Best k genes of each panel, each gene once by its best score."""
    best = markers.groupBy(panel, gene).agg(F.max(score).alias(score))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(panel).orderBy(F.desc(score), gene))).where(F.col("rank") <= k)


def reference_correlation(means: DataFrame, reference: DataFrame, cluster: str, label: str) -> DataFrame:
    """means (cluster, gene_id, mean) against reference (label, gene_id, mean): the label of best Spearman over shared genes. An equi-join on the gene; both sides are profiles, not cells."""
    m, r = means.select(cluster, "gene_id", F.col("mean").alias("x")), reference.select(label, "gene_id", F.col("mean").alias("y"))
    j = m.join(r, "gene_id")
    by = Window.partitionBy(cluster, label)

    def rank(c):
        return F.rank().over(by.orderBy(c)) + (F.count("*").over(Window.partitionBy(cluster, label, c)) - 1) / 2

    rho = j.withColumn("rx", rank("x")).withColumn("ry", rank("y")).groupBy(cluster, label).agg(F.round(F.corr("rx", "ry"), 5).alias("rho"), F.count("*").alias("n_genes"))
    return rho.where("rho is not null").withColumn("r", F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc("rho"), label))).where("r = 1").select(cluster, label, "rho", "n_genes")


def agreement_matrix(df: DataFrame, key: str, consensus: str, voters: list[str]) -> DataFrame:
    """1, 0 or null for each voter, with how many were tested and agree."""
    a = {f"{v}_agrees": F.when(abstains(F.col(v)), None).otherwise((F.col(v) == F.col(consensus)).cast("int")) for v in voters}
    out = df.select(key, *[c.alias(k) for k, c in a.items()])
    return out.withColumn("tested", sum((F.col(k).isNotNull().cast("int") for k in a), F.lit(0))).withColumn("agree", sum((F.coalesce(F.col(k), F.lit(0)) for k in a), F.lit(0)))


def method_calls(df: DataFrame, key: str, consensus: str, voters: list[str]) -> DataFrame:
    """key, voter, call: agree, differ or abstain."""
    long = df.unpivot([key, consensus], voters, "voter", "label")
    return long.select(key, "voter", F.when(abstains(F.col("label")), "abstain").when(F.col("label") == F.col(consensus), "agree").otherwise("differ").alias("call"))


def marker_display(markers: DataFrame, by: str, gene: str, k: int = 10) -> DataFrame:
    """First k distinct genes of each group in rank order, joined by commas."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", gene))), lambda x: x[gene])
    return markers.where(F.col("rank") <= 10 * k).groupBy(by).agg(F.array_join(F.slice(F.array_distinct(ordered), 1, k), ", ").alias("genes"))


def clean_markers(markers: DataFrame, by: str, gene: str, k: int = 30) -> DataFrame:
    """Upper case, uninformative genes out, first of repeats, first k."""
    m = markers.withColumn(gene, F.upper(gene)).where(~F.col(gene).rlike(LOW_INFORMATION)).groupBy(by, gene).agg(F.min("rank").alias("rank"))
    return m.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy("rank", gene))).where(F.col("rank") <= k)


def tier_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"), *[F.count_if(F.col("tier") == t).alias(n) for t, n in (("High", "high"), ("Medium", "medium"), ("Low/Review", "low_review"))], F.count_if(F.col("consensus") == "Unassigned").alias("unassigned"))


def query_ladder(genes: Column, disease: str, tissue: str, species: str) -> list[Column]:
    """Three boolean searches, narrow to broad, on the first 12 genes."""
    g = F.concat(F.lit("("), F.array_join(F.slice(genes, 1, 12), " OR "), F.lit(")"))
    a = [g, F.lit(f'"{disease}"'), F.lit(f'"{tissue}"'), F.lit('("cell type" OR "marker")'), F.lit(species)]
    return [F.concat_ws(" AND ", *a), F.concat_ws(" AND ", a[0], a[2], a[3], a[4]), F.concat_ws(" AND ", a[0], a[3], a[4])]


def species_of(taxon: Column) -> Column:
    t = F.lower(taxon)
    return F.when(t.contains("homo") | t.contains("sapiens"), "human").when(t.contains("mus ") | t.contains("musculus"), "mouse")


def extract_json(text: Column, schema: str) -> Column:
    """The outermost braces of a reply, fences or not, parsed; null if it can't be."""
    return F.from_json(F.regexp_extract(text, r"(?s)(\{.*\})", 1), schema)


def coerce_confidence(c: Column) -> Column:
    x = c.try_cast("double")
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def coerce_flag(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)) == "true", F.lit(False))


def coerce_number(c: Column) -> Column:
    return F.when(F.trim(c) == "", None).otherwise(F.trim(c).try_cast("double"))


def pick_subtype(candidates: DataFrame, key: str) -> DataFrame:
    """candidates (key, pos, source, subtype, parent, final, supported): the first that belongs to the final label, is finer than it and is supported."""
    ok = candidates.where((F.col("parent") == F.col("final")) & (F.col("subtype") != F.col("final")) & F.col("supported"))
    return ok.groupBy(key).agg(F.min_by(F.struct("source", "subtype"), "pos").alias("x")).select(key, "x.source", "x.subtype")


def rule_support(claims: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """claims (key, subtype, markers) against rules (token, requires_any, contradicted_by): all rules whose token is a word of the subtype must hold. Null markers: not checked."""
    j = claims.join(rules, F.array_contains(F.split(F.lower("subtype"), r"[^a-z0-9+]+"), F.col("token")), "left")
    holds = F.col("token").isNull() | F.col("markers").isNull() | (F.arrays_overlap("markers", "requires_any") & ~F.coalesce(F.arrays_overlap("markers", "contradicted_by"), F.lit(False)))
    return j.groupBy(key, "subtype").agg(F.min(F.coalesce(holds, F.lit(False))).alias("supported"), F.count("token").alias("n_rules"))


def dotplot(values: DataFrame, cells: DataFrame, panel: DataFrame, by: str) -> DataFrame:
    """Mean value, scaled 0 to 1 for each gene over the groups, and share of cells that express it."""
    from granary.operators.numeric import group_means

    m = group_means(values.join(panel.select("gene_id"), "gene_id", "left_semi"), cells, by)
    w = Window.partitionBy("gene_id")
    span = F.max("mean").over(w) - F.min("mean").over(w)
    return m.withColumn("scaled", F.when(span > 0, F.round((F.col("mean") - F.min("mean").over(w)) / span, 5)).otherwise(0.0))


def volcano(de: DataFrame, *, padj: float = 0.05, lfc: float = 1.0, k: int = 10) -> DataFrame:
    """-log10 of the clipped p, significance and the k labelled genes."""
    sig = (F.col("padj") < padj) & (F.abs("lfc") > lfc)
    d = de.withColumn("height", F.round(-F.log10(F.greatest("padj", F.lit(1e-300))), 5)).withColumn("significant", sig)
    return d.withColumn("labelled", F.col("significant") & (F.row_number().over(Window.orderBy(F.desc("significant"), F.desc("height"), F.desc(F.abs("lfc")), "gene_id")) <= k))


def overlap_score(markers: DataFrame, panels: DataFrame, by: str, *, least: int = 2, k: int = 3) -> DataFrame:
    """sum(1 + score) of shared genes over the root of the panel's size; the k best of each group."""
    size = panels.groupBy("panel").agg(F.count("*").alias("size"))
    s = markers.join(panels, "gene_id").groupBy(by, "panel").agg(F.sum(1 + F.col("score")).alias("s"), F.count("*").alias("overlap")).where(F.col("overlap") >= least).join(size, "panel")
    s = s.select(by, "panel", "overlap", F.round(F.col("s") / F.sqrt("size"), 5).alias("score"))
    w = Window.partitionBy(by).orderBy(F.desc("score"), "panel")
    return s.withColumn("rank", F.row_number().over(w)).withColumn("confidence", F.round((F.col("score") - F.coalesce(F.lead("score").over(w), F.lit(0.0))) / F.col("score"), 5)).where(F.col("rank") <= k)


def subset_genes(c: Column, k: int = 8) -> Column:
    return F.array_join(F.slice(F.filter(F.split(c, r"[,\s;/]+"), lambda x: x != ""), 1, k), ", ")


def cache_key(**parts: Column) -> Column:
    """SHA-256 of the request as JSON with sorted names."""
    return F.sha2(F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)])), 256)


def compare_adjacent(sweep: DataFrame) -> DataFrame:
    """Each resolution's cluster count with the one before."""
    return sweep.withColumn("previous", F.lag("n_clusters").over(Window.orderBy("resolution"))).withColumn("gained", F.col("n_clusters") - F.col("previous"))


def coverage(aliases: DataFrame) -> DataFrame:
    """aliases (vocabulary, lineage, node_id): distinct nodes by vocabulary, by lineage and overall, in one pass of grouping sets."""
    return aliases.groupingSets([[F.col("vocabulary")], [F.col("lineage")], []], "vocabulary", "lineage").agg(F.countDistinct("node_id").alias("n_nodes"))


def doublet_scores(counts: DataFrame, cells: DataFrame, *, ratio: int = 2) -> DataFrame:
    """A simple doublet score by sample: how far a cell's library and gene count exceed the sample's medians, in median absolute deviations. A substitute for simulated doublets, not their equal."""
    m = counts.groupBy("cell_id").agg(F.log1p(F.sum("count")).alias("l"), F.log1p(F.count("*")).alias("g")).join(cells.select("cell_id", "sample"), "cell_id")
    c = m.groupBy("sample").agg(F.median("l").alias("ml"), F.median("g").alias("mg"))
    d = m.join(c, "sample").withColumn("dl", F.col("l") - F.col("ml")).withColumn("dg", F.col("g") - F.col("mg"))
    s = d.groupBy("sample").agg(F.median(F.abs("dl")).alias("sl"), F.median(F.abs("dg")).alias("sg"))
    score = F.least(F.col("dl") / (1.4826 * F.col("sl") + 1e-9), F.col("dg") / (1.4826 * F.col("sg") + 1e-9))
    return d.join(s, "sample").select("cell_id", "sample", F.round(score, 4).alias("score"), (score > ratio).alias("doublet"))


