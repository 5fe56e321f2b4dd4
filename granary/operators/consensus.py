"""Voter labels: harmonising, tallies, tiers and their spread to cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.expressions import abstains

#: Keywords of cell types, in the order in which they are tried.
KEYWORDS = (
    ("T cell", "Immune", ("t cell", "t-cell", "t_cell", "cd4", "cd8", "treg", "regulatory t", "cytotoxic t", "helper t", "naive t", "memory t", "tcm", "tem", "th1", "th2", "th17", "tfh", "gamma delta", "mait")),
    ("NK cell", "Immune", ("nk cell", "natural killer", "nk_", "cd56")),
    ("B cell", "Immune", ("b cell", "b-cell", "b_cell", "plasma cell", "plasmablast", "germinal center")),
    ("Microglia", "Immune", ("microglia", "microglial")),
    ("Monocyte", "Immune", ("monocyte",)),
    ("Macrophage", "Immune", ("macrophage", "kupffer", "histiocyte", "tam")),
    ("Dendritic cell", "Immune", ("dendritic", "pdc", "cdc", "langerhans")),
    ("Granulocyte", "Immune", ("neutrophil", "eosinophil", "basophil", "mast cell", "granulocyte")),
    ("Hematopoietic progenitor", "Immune", ("hsc", "progenitor", "cmp", "gmp", "mpp", "hematopoietic stem")),
    ("Epithelial cell", "Epithelial", ("epithel", "keratinocyte", "enterocyte", "goblet", "acinar", "ductal", "luminal", "basal cell", "alveolar", "hepatocyte", "secretory", "ciliated", "club cell", "carcinoma", "adenocarcinoma")),
    ("Fibroblast", "Fibroblast", ("fibroblast", "stromal", "myofibroblast", "caf", "mesenchym", "chondrocyte", "osteoblast")),
    ("Endothelial cell", "Endothelial", ("endothel", "vascular ec", "lymphatic ec")),
    ("Mural cell", "Mural", ("pericyte", "smooth muscle", "mural", "vascular smooth")),
    ("Erythrocyte", "Other", ("erythrocyte", "erythroid", "red blood")),
    ("Melanocyte", "Other", ("melanocyte",)),
    ("Excitatory (glutamatergic) neuron", "Other", ("excitatory neuron", "glutamatergic", "pyramidal")),
    ("Inhibitory (GABAergic) neuron", "Other", ("interneuron", "gabaergic", "inhibitory neuron")),
    ("Astrocyte", "Other", ("astrocyte", "astroglia")),
    ("Oligodendrocyte precursor cell", "Other", ("oligodendrocyte precursor", "oligodendrocyte progenitor")),
    ("Oligodendrocyte", "Other", ("oligodendrocyte",)),
    ("Schwann cell", "Other", ("schwann",)),
    ("Neuron", "Other", ("neuron", "neuronal")),
    ("Glial cell", "Other", ("glial", "glia")),
)


def _first_hit(s, pick):
    out = F.lit(None).cast("string")
    for row in reversed(KEYWORDS):
        out = F.when(s.rlike("|".join(rf"\b\Q{k}\E(?!\d)" for k in row[2])), F.lit(row[pick])).otherwise(out)
    return out


def harmonise(label: F.Column) -> F.Column:
    """Canonical type by keyword; nothing known: 'Other: label'; no call: Unassigned."""
    s = F.lower(F.trim(label))
    return F.when(abstains(label), "Unassigned").when(s.startswith("other:"), F.trim(label)).otherwise(F.coalesce(_first_hit(s, 0), F.concat(F.lit("Other: "), F.trim(label))))


def coarse_lineage(label: F.Column) -> F.Column:
    return F.when(abstains(label), "Other").otherwise(F.coalesce(_first_hit(F.lower(F.trim(label)), 1), F.lit("Other")))


def votes_long(df: DataFrame, key: list[str], voters: list[str]) -> DataFrame:
    """(key, voter, label) rows."""
    return df.unpivot(key, voters, "voter", "label")


def tally(votes: DataFrame, key: str) -> DataFrame:
    """votes (key, voter, label, confidence) -> winner, top count, tie, tier of the count and the pattern. Ties: summed confidence, then label."""
    v = votes.where(~abstains(F.col("label")) & (F.col("label") != "Unassigned"))
    per = v.groupBy(key, "label").agg(F.count("*").alias("n"), F.sum(F.round(F.col("confidence") * 1000).cast("long")).alias("conf"))
    by = Window.partitionBy(key)
    ranked = per.withColumns({"r": F.row_number().over(by.orderBy(F.desc("n"), F.desc("conf"), "label")), "total": F.sum("n").over(by), "top": F.max("n").over(by)}).withColumn("tied", F.sum(F.when(F.col("n") == F.col("top"), 1).otherwise(0)).over(by) > 1)
    pattern = v.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "voter", "label"))), "/").alias("pattern"))
    won = ranked.where("r = 1").select(key, F.col("label").alias("winner"), F.col("n").alias("votes"), F.col("total").alias("voters"), "tied")
    every = votes.select(key).distinct().join(won, key, "left").join(pattern, key, "left")
    unanimous, majority = (F.col("voters") >= 2) & (F.col("votes") == F.col("voters")), (F.col("voters") >= 2) & (2 * F.col("votes") > F.col("voters"))
    return every.select(key, F.coalesce("winner", F.lit("Unassigned")).alias("winner"), F.coalesce("votes", F.lit(0)).alias("votes"), F.coalesce("voters", F.lit(0)).alias("voters"), F.coalesce("tied", F.lit(False)).alias("tied"), F.coalesce(unanimous, F.lit(False)).alias("unanimous"), F.coalesce(majority & ~unanimous, F.lit(False)).alias("majority"), F.coalesce("pattern", F.lit("")).alias("pattern"))


def decide(tallied: DataFrame, gate: str, *, state_dominated: str | None = None) -> DataFrame:
    """Tier and label from a tally and the lineage gate: unanimous High; a majority that the gate does not contradict Medium; else Low/Review with the majority, or the gate if there is none."""
    contradicted = (F.col(gate) != "Other") & (coarse_lineage(F.col("winner")) != "Other") & (coarse_lineage(F.col("winner")) != F.col(gate)) & ~F.col("unanimous")
    label = F.when(F.col("winner") == "Unassigned", F.col(gate)).when(contradicted, F.col(gate)).when(F.col("tied"), F.col(gate)).otherwise(F.col("winner"))
    tier = F.when(F.col("unanimous") & ~contradicted, "High").when(F.col("majority") & ~contradicted, "Medium").otherwise("Low/Review")
    if state_dominated:
        tier = F.when(F.col(state_dominated), "Low/Review").otherwise(tier)
    return tallied.withColumns({"contradicted": contradicted, "consensus": label, "tier": tier})


def saturated(votes: DataFrame, *, share: float = 0.8, least: int = 5) -> DataFrame:
    """Voters that give one label to most of what they call."""
    per = votes.where(~abstains(F.col("label"))).groupBy("voter", "label").agg(F.count("*").alias("n"))
    return per.groupBy("voter").agg(F.sum("n").alias("called"), F.max("n").alias("modal")).withColumn("saturated", (F.col("called") >= least) & (F.col("modal") >= share * F.col("called")))


def deferred(tallied: DataFrame, open_label: str, open_conf: str, closed_only: str, unreliable: str) -> DataFrame:
    """Out-of-domain deference: an open-vocabulary voter of 0.8 or more overrules a majority of closed vocabularies whose classifier is unreliable."""
    rule = F.col("majority") & F.col(closed_only) & F.col(unreliable) & (F.col(open_conf) >= 0.8) & (F.col(open_label) != F.col("winner"))
    return tallied.withColumn("deferred", F.coalesce(rule, F.lit(False))).withColumn("winner", F.when(F.col("deferred"), F.col(open_label)).otherwise(F.col("winner")))


def mode_by_cluster(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Dominant and second label, shares, entropy in bits and whether the cluster is mixed."""
    n = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    by = Window.partitionBy(cluster)
    p = n.withColumn("total", F.sum("n").over(by)).withColumn("p", F.col("n") / F.col("total")).withColumn("r", F.row_number().over(by.orderBy(F.desc("n"), label)))
    out = p.groupBy(cluster).agg(F.max(F.when(F.col("r") == 1, F.col(label))).alias("dominant"), F.round(F.max(F.when(F.col("r") == 1, F.col("p"))), 4).alias("dominant_fraction"), F.max(F.when(F.col("r") == 2, F.col(label))).alias("second"), F.round(F.coalesce(F.max(F.when(F.col("r") == 2, F.col("p"))), F.lit(0.0)), 4).alias("second_fraction"), F.round(F.abs(F.sum(F.col("p") * F.log2("p"))), 4).alias("entropy"), F.count("*").alias("n_labels"))
    return out.withColumn("mixed", (F.col("dominant_fraction") < 0.7) | (F.col("second_fraction") >= 0.2))


def spread(cells: DataFrame, clusters: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Cluster labels on cells; no match: Unassigned. A left join on a unique key keeps every cell once."""
    c = clusters.select(cluster, *columns).dropDuplicates([cluster])
    return cells.join(c, cluster, "left").withColumns({k: F.coalesce(k, F.lit("Unassigned")) for k in columns})


def label_map(df: DataFrame, label: str, resolve) -> DataFrame:
    """Each distinct label resolved once, with its count."""
    return df.groupBy(label).agg(F.count("*").alias("n_cells")).withColumn("resolved_label", resolve(F.col(label)))


# ---- label trees ----


def ancestors(nodes: DataFrame) -> DataFrame:
    """nodes (node_id, parent_id) -> node_id, level, path from the root, of every node that has a way to a root, however deep. The vocabulary is a small dimension; a round a level, until none is added."""
    path = nodes.where("parent_id is null").select("node_id", F.array("node_id").alias("path"))
    every, known = path, nodes.select("node_id", "parent_id").where("parent_id is not null")
    while not path.isEmpty():
        path = known.join(path.select(F.col("node_id").alias("parent_id"), F.col("path").alias("up")), "parent_id").where(~F.array_contains("up", F.col("node_id"))).select("node_id", F.concat("up", F.array("node_id")).alias("path"))
        every = every.unionAll(path)
    return every.withColumn("level", F.size("path") - 1)


def rollup(paths: DataFrame, level: int) -> DataFrame:
    return paths.select("node_id", F.get("path", level).alias("rolled"))


def subtree_sizes(paths: DataFrame) -> DataFrame:
    return paths.select(F.explode("path").alias("node_id")).groupBy("node_id").agg((F.count("*") - 1).alias("n_descendants"))


def lowest_common(votes: DataFrame, key: str, paths: DataFrame) -> DataFrame:
    """votes (key, node_id) -> lca: the last level at which all paths agree, by min and max of each level."""
    p = votes.join(paths, "node_id").select(key, F.posexplode("path").alias("level", "step"), F.size("path").alias("depth"))
    n = votes.join(paths, "node_id").groupBy(key).agg(F.count("*").alias("n"))
    agreed = p.groupBy(key, "level").agg(F.min("step").alias("lo"), F.max("step").alias("hi"), F.count("*").alias("m")).join(n, key).where("lo = hi and m = n")
    return n.join(agreed.groupBy(key).agg(F.max(F.struct("level", "lo")).alias("x")), key, "left").select(key, F.col("n").alias("voters"), F.col("x.lo").alias("lca"), F.col("x.level").alias("level"))


def hierarchy_consensus(lca: DataFrame, total: F.Column, confidence: F.Column) -> DataFrame:
    credit = F.element_at(F.array(*map(F.lit, (0.20, 0.40, 0.65, 0.85, 1.00))), F.least(F.col("level") + 1, F.lit(5)).cast("int"))
    return lca.withColumn("score", F.when((F.col("voters") < 2) | F.col("lca").isNull(), 0.0).otherwise(F.round(credit * F.col("voters") / total * confidence, 6)))
