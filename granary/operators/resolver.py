"""Resolves free-text labels on a vocabulary: exact, identifier, canonical label, normalised, without states, compartment, then fuzzy within a lineage. Each distinct label is resolved once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.labels import compatible, normalise, states

#: The confidence of each rung.
EXACT, CANONICAL, NORMALISED, COMPARTMENT, FUZZY, RATIO = 1.0, 0.98, 0.95, 0.8, 0.55, 0.88


def resolve(labels: DataFrame, aliases: DataFrame, nodes: DataFrame, *, compartments: DataFrame | None = None, fuzzy: bool = True) -> DataFrame:
    """labels (label), aliases (raw_label, node_id), nodes (node_id, level, and if known label and cl_id), compartments (raw_label, node_id) -> label, node_id, confidence, method, states, a row for each distinct label.

    Rungs: alias, node id, ontology id, canonical label, normal form, normal form without states, compartment, fuzzy within the lineage. Where several nodes fit, the shallowest wins, then the least id. Only states: no node, method state_only. Null or blank: unresolved. The vocabulary is a dimension; the labels are reduced to distinct ones first, and only what no rung resolved reaches the fuzzy one.
    """
    d = labels.select("label").distinct().withColumns({"k": F.lower(F.trim("label")), "norm": normalise(F.col("label"))})
    d = d.withColumn("x", states(F.col("norm"))).select("label", "k", "norm", normalise(F.col("x.residual")).alias("rest"), F.col("x.states").alias("states"))
    a = aliases.join(nodes.select("node_id", "level"), "node_id").select("node_id", "level", F.lower(F.trim("raw_label")).alias("k"), normalise(F.col("raw_label")).alias("norm"))

    def least(frame, key, name, at):
        return frame.where(F.col(key) != "").groupBy(F.col(key).alias(at)).agg(F.min(F.struct("level", "node_id")).alias(name))

    ids = nodes.select(F.lower("node_id").alias("k"), "level", "node_id")
    rungs = [("exact", EXACT, a, "k", "k"), ("node_id", EXACT, ids, "k", "k")]
    if "cl_id" in nodes.columns:
        rungs.append(("cl_id", EXACT, nodes.select(F.lower("cl_id").alias("k"), "level", "node_id"), "k", "k"))
    if "label" in nodes.columns:
        rungs.append(("canonical", CANONICAL, nodes.select(F.lower("label").alias("k"), "level", "node_id"), "k", "k"))
    rungs += [("normalised", NORMALISED, a, "norm", "norm"), ("normalised", NORMALISED, a, "norm", "rest")]
    if compartments is not None:
        c = compartments.join(nodes.select("node_id", "level"), "node_id").select(normalise(F.col("raw_label")).alias("k"), "level", "node_id")
        rungs.append(("compartment", COMPARTMENT, c, "k", "rest"))
    said, found = F.when(F.lit(False), F.lit("")), []
    conf = F.when(F.lit(False), F.lit(0.0))
    for n, (method, value, frame, key, at) in enumerate(rungs):
        d = d.join(least(frame, key, f"by{n}", at), at, "left")
        said, conf = said.when(F.col(f"by{n}").isNotNull(), method), conf.when(F.col(f"by{n}").isNotNull(), value)
        found.append(f"by{n}")
    method = said.when((F.col("rest") == "") & (F.size("states") > 0), "state_only").otherwise("unresolved")
    d = d.select("label", F.col("rest").alias("norm"), F.coalesce(*found)["node_id"].alias("node_id"), conf.otherwise(0.0).alias("confidence"), method.alias("method"), "states")
    if not fuzzy:
        return d.drop("norm")
    rest = d.where((F.col("method") == "unresolved") & (F.col("norm") != ""))
    b = a.where("norm <> ''").select(F.col("norm").alias("other"), "level", F.col("node_id").alias("near_id")).distinct()
    # A ratio r of lengths m and n needs 2 * matches >= r * (m + n): m is at least r / (2 - r) of n, and at most (1 - r) * (m + n) letters are put in or taken out. So the join is on lengths, and levenshtein is a bound.
    lengths = F.explode(F.sequence(F.ceil(F.length("norm") * (RATIO / (2 - RATIO))).cast("int"), F.floor(F.length("norm") * ((2 - RATIO) / RATIO)).cast("int")))

    @F.pandas_udf("double")
    def ratio(x, y):
        from difflib import SequenceMatcher

        import pandas as pd

        return pd.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)])

    near = rest.withColumn("key", lengths).join(b.withColumn("key", F.length("other")), "key").where((F.levenshtein("norm", "other") <= (1 - RATIO) * (F.length("norm") + F.length("other")) + 1e-9) & compatible(F.col("norm"), F.col("other")))
    near = near.withColumn("ratio", ratio("norm", "other")).where(F.col("ratio") >= RATIO)
    best = near.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("ratio"), "level", "near_id"))).where("r = 1").select(F.col("label").alias("l"), "near_id")
    out = d.join(best, F.col("label") == F.col("l"), "left")
    hit = F.col("near_id").isNotNull()
    return out.select("label", F.coalesce("node_id", "near_id").alias("node_id"), F.when(hit, FUZZY).otherwise(F.col("confidence")).alias("confidence"), F.when(hit, "fuzzy").otherwise(F.col("method")).alias("method"), "states")


def attach(df: DataFrame, column: str, resolved: DataFrame) -> DataFrame:
    """The resolution on every row; rows in = rows out."""
    return df.join(resolved.withColumnRenamed("label", column), column, "left")
