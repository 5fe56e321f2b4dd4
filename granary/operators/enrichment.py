"""Over-representation with exact tail probabilities, enrichment chains, and deduplication of pathway names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.operators.numeric import adjusted

#: Genes of a list, level and effect of a list from a contrast.
TOP, ALPHA, EFFECT, LIKE = 200, 0.05, 0.25, 0.9


def fisher(table: DataFrame) -> DataFrame:
    """table (overlap, size, listed, universe, ...) with p_value: the chance of that overlap or more among ``listed`` genes drawn from the universe (hypergeometric tail, one-sided Fisher test)."""

    @F.pandas_udf("double")
    def tail(overlap, size, listed, universe):
        import math

        import pandas as pd

        def p(k, m, n, total):
            log = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
            low, high = max(k, m + n - total, 0), min(m, n)
            return min(1.0, sum(math.exp(log(m, i) + log(total - m, n - i) - log(total, n)) for i in range(low, high + 1)))

        return pd.Series([p(*map(int, x)) for x in zip(overlap, size, listed, universe)])

    return table.withColumn("p_value", F.round(tail("overlap", "size", "listed", "universe"), 12))


def over_represented(lists: DataFrame, sets: DataFrame, universe: DataFrame, *by: str) -> DataFrame:
    """lists (by..., gene_id), sets (set, gene_id) -> by..., set, overlap, size, listed, universe, p_value, p_value_adj, genes. Only genes of the universe count; sets without an overlap are left out."""
    u = universe.select("gene_id").distinct()
    g, s = lists.select(*by, "gene_id").distinct().join(u, "gene_id", "left_semi"), sets.select("set", "gene_id").distinct().join(u, "gene_id", "left_semi")
    listed, size = g.groupBy(*by).agg(F.count("*").alias("listed")), s.groupBy("set").agg(F.count("*").alias("size"))
    d = g.join(s, "gene_id").groupBy(*by, "set").agg(F.count("*").alias("overlap"), F.array_join(F.array_sort(F.collect_list("gene_id")), ";").alias("genes"))
    d = d.join(size, "set").join(listed, list(by)) if by else d.join(size, "set").join(listed)
    d = fisher(d.join(u.agg(F.count("*").alias("universe"))))
    return adjusted(d, "p_value", "set", *by).withColumnRenamed("q", "p_value_adj")


def marker_enrichment(markers: DataFrame, sets: DataFrame, universe: DataFrame, by: str, top: int = TOP) -> DataFrame:
    """The first genes of each cluster by rank, never by p-value."""
    return over_represented(markers.where(F.col("rank") <= top), sets, universe, by)


def contrast_enrichment(de: DataFrame, sets: DataFrame, universe: DataFrame, *by: str, alpha: float = ALPHA, lfc: float = EFFECT) -> DataFrame:
    """Genes of each (cluster, comparison) that pass level and effect."""
    return over_represented(de.where((F.col("p_value_adj") < alpha) & (F.abs("log2_fold_change") >= lfc)), sets, universe, *by)


def semantic_dedup(pathways: DataFrame, by: str, *, like: float = LIKE) -> DataFrame:
    """pathways (by, pathway, padj, score, vector) -> those that are not like a better one of their database: in the order of (padj, -score, name), one goes if its vector's cosine with a kept one is ``like`` or more. Without vectors, equal lower-cased names go.

    The order makes it greedy, so a database is one group; its pathways are a bounded dimension (thousands), of which only names, scores and vectors are held.
    """
    import pandas as pd

    def keep(df: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        df = df.sort_values(["padj", "score", "pathway"], ascending=[True, False, True])
        kept, rows, names = np.zeros((0, 0)), [], set()
        for i, (v, name) in enumerate(zip(df["vector"], df["pathway"])):
            if v is None:
                if name.strip().lower() not in names:
                    rows.append(i)
            else:
                x = np.asarray(v, float)
                x = x / max(np.linalg.norm(x), 1e-12)
                if not len(kept) or (kept @ x).max() < like - 1e-12:
                    kept = np.vstack([kept, x]) if len(kept) else x[None]
                    rows.append(i)
            names.add(name.strip().lower())
        return df.iloc[rows]

    return pathways.groupBy(by).applyInPandas(keep, pathways.schema)


def signature_scores(markers: DataFrame, signatures: DataFrame, by: str) -> DataFrame:
    """markers (by, gene), signatures (signature, gene, weight) -> the sum of weights of the genes in common, and those genes, the heaviest first."""
    d = markers.select(by, "gene").distinct().join(signatures, "gene")
    hits = F.transform(F.sort_array(F.collect_list(F.struct(F.col("weight").alias("w"), "gene")), False), lambda x: x["gene"])
    return d.groupBy(by, "signature").agg(F.round(F.sum("weight"), 4).alias("score"), hits.alias("hits"))


def relevant_markers(panels: DataFrame, present: DataFrame) -> DataFrame:
    """panels (celltype, gene) whose cell type, without ' cell', is part of a label that is present. Both are small vocabularies: distinct names are compared, then joined back."""
    name = lambda c: F.lower(F.regexp_replace(c, r" cells?$", ""))
    p, q = panels.select("celltype").distinct(), present.select(F.lower("label").alias("label")).distinct()
    ok = p.join(q, F.contains(F.col("label"), name(F.col("celltype")))).select("celltype").distinct()
    return panels.join(ok, "celltype", "left_semi")


def drop_rank(df: DataFrame, by: str, order: str, k: int) -> DataFrame:
    """The first k of each group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("_r") <= k).drop("_r")
