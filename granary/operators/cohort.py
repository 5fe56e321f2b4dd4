"""Quality control, pseudobulk, composition and design of cohorts of sparse counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.expressions import is_baseline


def qc_metrics(counts: DataFrame, genes: DataFrame, cells: DataFrame) -> DataFrame:
    """cell_id, n_genes, total_counts, pct_mito; cells without counts stay, with a null share."""
    m = counts.where("count > 0").join(genes.select("gene_id", "mito"), "gene_id").groupBy("cell_id").agg(F.count("*").alias("n_genes"), F.sum("count").alias("total_counts"), F.sum(F.when(F.col("mito"), F.col("count")).otherwise(0)).alias("mito"))
    return cells.select("cell_id").join(m, "cell_id", "left").select("cell_id", F.coalesce("n_genes", F.lit(0)).alias("n_genes"), F.coalesce("total_counts", F.lit(0)).alias("total_counts"), (100.0 * F.col("mito") / F.col("total_counts")).alias("pct_mito"))


def _rules(min_genes: int, max_genes: int, max_mito: float):
    return F.col("n_genes") > min_genes, F.col("n_genes") < max_genes, F.coalesce(F.col("pct_mito") < max_mito, F.lit(False))


def qc_filter(metrics: DataFrame, *, min_genes: int = 200, max_genes: int = 6000, max_mito: float = 15.0) -> DataFrame:
    a, b, c = _rules(min_genes, max_genes, max_mito)
    return metrics.where(a & b & c)


def qc_report(metrics: DataFrame, *, min_genes: int = 200, max_genes: int = 6000, max_mito: float = 15.0) -> DataFrame:
    """One row: cells in and out, and what each rule alone would remove."""
    a, b, c = _rules(min_genes, max_genes, max_mito)
    return metrics.agg(F.count("*").alias("cells_in"), F.count_if(~a).alias("below_min_genes"), F.count_if(~b).alias("above_max_genes"), F.count_if(~c).alias("above_max_mito"), F.count_if(a & b & c).alias("cells_out"))


def gene_min_cells(counts: DataFrame, least: int = 3) -> DataFrame:
    return counts.where("count > 0").groupBy("gene_id").agg(F.count("*").alias("n_cells")).where(F.col("n_cells") >= least)


def unique_names(genes: DataFrame) -> DataFrame:
    """Repeated names get -1, -2, ... in order of gene_id."""
    r = F.row_number().over(Window.partitionBy("gene").orderBy("gene_id")) - 1
    return genes.select("gene_id", F.when(r == 0, F.col("gene")).otherwise(F.concat_ws("-", "gene", r.cast("string"))).alias("gene"))


def pseudobulk(counts: DataFrame, cells: DataFrame, *by: str, min_cells: int = 10) -> DataFrame:
    """Summed counts by the sample columns and gene; samples below min_cells are dropped. Partial sums are made before the shuffle."""
    enough = cells.groupBy(*by).agg(F.count("*").alias("n_cells")).where(F.col("n_cells") >= min_cells)
    return counts.join(cells.select("cell_id", *by), "cell_id").groupBy(*by, "gene_id").agg(F.sum("count").alias("count")).join(enough, list(by))


def contrast(bulk: DataFrame, samples: DataFrame, focus: str, ref: str) -> DataFrame:
    """Per gene, log2 of the ratio of the arms' mean counts per 10,000 with one pseudo-count each; positive is higher in focus."""
    size = bulk.groupBy("sample").agg(F.sum("count").alias("total")).join(samples, "sample").where(F.col("grp").isin(focus, ref))
    arms = size.groupBy("grp").agg(F.count("*").alias("n"))
    x = bulk.join(size, "sample").groupBy("grp", "gene_id").agg(F.sum(F.round(F.col("count") * 1e4 / F.col("total"), 6).cast("decimal(28,6)")).cast("double").alias("s")).join(arms, "grp")
    f, r = F.max(F.when(F.col("grp") == focus, F.col("s") / F.col("n"))), F.max(F.when(F.col("grp") == ref, F.col("s") / F.col("n")))
    out = x.groupBy("gene_id").agg(F.coalesce(f, F.lit(0.0)).alias("focus_mean"), F.coalesce(r, F.lit(0.0)).alias("reference_mean"))
    return out.withColumn("log2_fold_change", F.round(F.log2((F.col("focus_mean") + 1) / (F.col("reference_mean") + 1)), 6)).withColumns({"focus_group": F.lit(focus), "reference_group": F.lit(ref)})


def oriented_pairs(groups: DataFrame, column: str) -> DataFrame:
    """Every pair of labels; a baseline is the reference, else the alphabetically first. The labels of a design are few."""
    g = groups.select(F.col(column).alias("x")).distinct()
    a, b = g.toDF("a"), g.toDF("b")
    base_b = is_baseline(F.col("b")) & ~is_baseline(F.col("a"))
    return a.join(b, F.col("a") < F.col("b")).select(F.when(base_b, F.col("a")).otherwise(F.col("b")).alias("focus_group"), F.when(base_b, F.col("b")).otherwise(F.col("a")).alias("reference_group"))


def sample_groups(cells: DataFrame) -> DataFrame:
    return cells.groupBy("sample").agg(F.countDistinct("grp").alias("n_groups"), F.min("grp").alias("grp"), F.count("*").alias("n_cells"))


def replication(cells: DataFrame, least: int = 2) -> DataFrame:
    return cells.groupBy("grp").agg(F.countDistinct("sample").alias("n_samples")).withColumn("replicated", F.col("n_samples") >= least)


def batch_design(cells: DataFrame, batch: str, group: str) -> DataFrame:
    """One row: nested if every batch lies in one group and there are two groups at least, else crossed."""
    per = cells.groupBy(batch).agg(F.countDistinct(group).alias("g"), F.min(group).alias("one"))
    return per.agg(F.count("*").alias("n_batches"), F.max("g").alias("most_groups"), F.countDistinct("one").alias("n_groups")).withColumn("design", F.when((F.col("most_groups") == 1) & (F.col("n_groups") >= 2), "nested").otherwise("crossed"))


def composition(cells: DataFrame, by: str, label: str) -> DataFrame:
    """n_cells, total and fraction of each label in each group."""
    n = cells.groupBy(by, label).agg(F.count("*").alias("n_cells"))
    total = F.sum("n_cells").over(Window.partitionBy(by))
    return n.withColumn("total", total).withColumn("fraction", F.round(F.col("n_cells") / F.col("total"), 6))


def donor_proportions(cells: DataFrame, sample: str, label: str) -> DataFrame:
    """Zero-filled: a row for each sample and each label there is. Grouping sets of one pass give the samples, the labels and the counts."""
    n = cells.groupBy(sample, label).agg(F.count("*").alias("n"))
    totals, labels = n.groupBy(sample).agg(F.sum("n").alias("total")), n.agg(F.array_sort(F.collect_set(label)).alias("labels"))
    full = totals.join(labels).withColumn(label, F.explode("labels")).drop("labels")
    return full.join(n, [sample, label], "left").select(sample, label, F.coalesce("n", F.lit(0)).alias("n_cells"), F.round(F.coalesce("n", F.lit(0)) / F.col("total"), 6).alias("fraction"))


def crosstab(cells: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return cells.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)


def cluster_sizes(cells: DataFrame, cluster: str, least: int) -> DataFrame:
    n = cells.groupBy(cluster).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("n_clusters"), F.min("n").alias("smallest"), F.median("n").alias("median_size"), F.max("n").alias("largest"), F.count_if(F.col("n") < least).alias("n_small"), F.coalesce(F.sum(F.when(F.col("n") < least, F.col("n"))), F.lit(0)).alias("cells_in_small"))


def inclusion(cells: DataFrame, tier: str, excluded: tuple[str, ...] = ("Low/Review",)) -> DataFrame:
    """include = tier not excluded; all True if nothing would be left."""
    keep = ~F.coalesce(F.col(tier).isin(*excluded), F.lit(False))
    any_left = cells.agg(F.coalesce(F.max(keep), F.lit(False)).alias("_any"))  # one row
    return cells.join(any_left, F.lit(True), "left").withColumn("include", keep | ~F.col("_any")).drop("_any")


def validation_checks(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """check, status, n: the rows of the validation report that are counts."""
    nested = sample_groups(cells).where("n_groups > 1").agg(F.count("*").alias("n")).select(F.lit("sample_in_one_group").alias("check"), F.when(F.col("n") == 0, "pass").otherwise("fail").alias("status"), "n")
    thin = replication(cells).where("not replicated").agg(F.count("*").alias("n")).select(F.lit("group_replication").alias("check"), F.when(F.col("n") == 0, "pass").otherwise("warn").alias("status"), "n")
    bad = counts.agg(F.count_if(F.col("count") < 0).alias("n")).select(F.lit("non_negative").alias("check"), F.when(F.col("n") == 0, "pass").otherwise("fail").alias("status"), "n")
    empty = cells.join(counts.where("count > 0"), "cell_id", "left_anti").agg(F.count("*").alias("n")).select(F.lit("cells_with_counts").alias("check"), F.when(F.col("n") == 0, "pass").otherwise("fixed").alias("status"), "n")
    twice = cells.groupBy("cell_id").count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("unique_cells").alias("check"), F.when(F.col("n") == 0, "pass").otherwise("fail").alias("status"), "n")
    return nested.unionAll(thin).unionAll(bad).unionAll(empty).unionAll(twice)
