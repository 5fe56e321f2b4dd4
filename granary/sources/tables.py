"""Cohort views over the driver's tables, and the readers of count matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

COUNTS = StructType([StructField("cell_id", StringType()), StructField("gene_id", LongType()), StructField("count", DoubleType())])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell = order, sample = nation, grp = region, donor = customer, cluster = priority, celltype = market segment. The dimensions are joined by Catalyst, which broadcasts what it measures as small."""
    o, c, n, r = (load(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("o_orderkey").alias("cell_id"), F.col("n_name").alias("sample"), F.col("r_name").alias("grp"), F.col("c_custkey").alias("donor"), F.col("o_orderpriority").alias("cluster"), F.col("c_mktsegment").alias("celltype"), F.col("o_orderstatus").alias("status"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse triples (cell_id, gene_id, count); repeated entries are summed."""
    return load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(F.sum(F.col("l_quantity").cast("long")).alias("count"))


def counts_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """counts, shuffled once: all entries of a cell are in one partition."""
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), F.col("l_quantity").cast("long").alias("count"))
    return rows.repartition("cell_id").groupBy("cell_id", "gene_id").agg(F.sum("count").alias("count"))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("gene"), F.col("p_brand").alias("brand"), F.col("p_type").alias("family"), (F.col("p_brand") == "Brand#1").alias("mito"))


def voters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four label columns a cell, one with nulls and one saturated, and a confidence."""
    x = F.col("cell_id")
    return cells(spark, sf_dir).select("cell_id", "cluster", "sample", "grp", F.col("celltype").alias("truth"), F.when(x % 10 < 8, F.col("celltype")).otherwise("AUTOMOBILE").alias("classifier"), F.when(x % 7 == 0, None).when(x % 7 < 5, F.col("celltype")).otherwise("BUILDING").alias("knowledge"), F.when(x % 5 < 3, F.col("celltype")).otherwise("MACHINERY").alias("literature"), F.lit("FURNITURE").alias("saturated"), ((x * 37 % 101) / F.lit(100)).alias("confidence"))


def matrix_market(spark: SparkSession, folder: str) -> DataFrame:
    """A 10x folder (matrix.mtx, barcodes.tsv, features.tsv, each also .gz) as (barcode, feature_id, feature_name, feature_type, count).

    Line numbers are the keys, so each list is numbered in file order by zipWithIndex; matrix lines are split in parallel.
    """
    def found(*names: str) -> str:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for n in names:
            hits = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, n))
            if hits:
                return sorted(str(h.getPath()) for h in hits)[0]
        raise FileNotFoundError(f"{folder}: none of {', '.join(names)}")

    def numbered(path: str) -> DataFrame:
        rows = spark.read.text(path).rdd.zipWithIndex().map(lambda x: (x[1] + 1, x[0].value))
        return spark.createDataFrame(rows, "i long, value string")

    lines = spark.read.text(found("matrix.mtx", "matrix.mtx.gz", "*matrix.mtx*")).where("value not like '\\%%'")
    p = F.split("value", r"\s+")
    entries = lines.select(p[0].cast("long").alias("g"), p[1].cast("long").alias("c"), p[2].cast("double").alias("count"), F.size(p).alias("parts"), F.monotonically_increasing_id().alias("at"))
    if entries.where("parts < 3 or g is null or c is null or count is null").limit(1).count():
        raise ValueError(f"{folder}: the matrix can't be read")
    head = entries.agg(F.min("at").alias("head"))
    entries = entries.join(head, F.col("at") != F.col("head")).select("g", "c", "count")
    t = F.split("value", "\t")
    b = numbered(found("barcodes.tsv", "barcodes.tsv.gz", "*barcodes.tsv*")).select(F.col("i").alias("c"), t[0].alias("barcode"))
    f = numbered(found("features.tsv", "features.tsv.gz", "genes.tsv", "genes.tsv.gz", "*features.tsv*")).select(F.col("i").alias("g"), t[0].alias("feature_id"), F.coalesce(F.get(t, 1), t[0]).alias("feature_name"), F.coalesce(F.get(t, 2), F.lit("Gene Expression")).alias("feature_type"))
    return entries.join(b, "c").join(f, "g").select("barcode", "feature_id", "feature_name", "feature_type", "count")


def check_raw_counts(df: DataFrame, column: str = "count") -> DataFrame:
    """One row: how many stored values are not finite, negative or not integers."""
    x = F.col(column).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return df.agg(F.count_if(~finite).alias("not_finite"), F.count_if(x < 0).alias("negative"), F.count_if(finite & (F.abs(x - F.rint(x)) > 1e-8)).alias("not_integer"))


def group_map(spark: SparkSession, path: str) -> DataFrame:
    """sample, grp of a CSV with those headers in any case; the last of equal samples wins; excluded groups go."""
    from pyspark.sql.window import Window

    from granary.functions.expressions import excluded_group

    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    if not {"sample", "group"} <= set(df.columns):
        raise ValueError(f"{path}: needs sample and group")
    last = Window.partitionBy("sample").orderBy(F.desc("at"))
    return df.withColumn("at", F.monotonically_increasing_id()).withColumn("r", F.row_number().over(last)).where("r = 1").select("sample", F.col("group").alias("grp")).where(~excluded_group(F.col("grp")))


def canonical(df: DataFrame) -> DataFrame:
    """Canonical column names; a name that is taken is not given twice."""
    from granary.functions.expressions import CANONICAL

    taken, out = set(df.columns), {}
    for c in df.columns:
        to = CANONICAL.get(c)
        if to and to not in taken:
            taken.add(to)
            out[c] = to
    return df.withColumnsRenamed(out)


def write_cohort(counts_: DataFrame, cells_: DataFrame, genes_: DataFrame, path: str) -> None:
    """Cells, genes and triples as Parquet; the triples by sample, so that a sample's are read alone."""
    cells_.write.mode("overwrite").parquet(f"{path}/cells")
    genes_.write.mode("overwrite").parquet(f"{path}/genes")
    counts_.join(cells_.select("cell_id", "sample"), "cell_id").write.mode("overwrite").partitionBy("sample").parquet(f"{path}/counts")


def write_mtx(counts_: DataFrame, path: str) -> None:
    """Lines of a Matrix Market body from (g, c, count), 1-based, gzip."""
    counts_.select(F.concat_ws(" ", "g", "c", F.col("count").cast("long")).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)
