"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.common import ws_words

WEIGHTS = (5, 2, 1)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """(source, source_size) -> also target. Sources are clamped at max_epochs times their size; the excess goes to the others by weight until none is above.

    The fixed point in closed form: in order of cap / weight a source is clamped as long as its cap lies below its share of what the sources before it leave; the first that is not clamped fixes the level of all others. One row per source goes through the window, never documents.
    """
    by_name, by_ratio = Window.orderBy(F.col("source").isNull(), "source"), Window.orderBy("ratio", "rn")
    everything = Window.partitionBy(F.lit(1))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    w = sources.withColumn("rn", F.row_number().over(by_name)).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rn") - 1) % len(weights) + 1).cast("int")).cast("double"))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("ratio", F.col("cap") / F.col("w"))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    w = w.withColumn("level", left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))).withColumn("clamped", F.col("cap") < F.col("w") * F.col("level"))
    w = w.withColumn("top", F.min(F.when(~F.col("clamped"), F.struct("ratio", "rn", "level"))).over(everything))
    return w.select("source", "source_size", F.when(F.col("clamped") | F.col("top").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("top.level"))).alias("target"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: float = 2.0, seed: str = "") -> DataFrame:
    """docs (doc_id, source, text) -> doc_id, size, source_size, target, taken, repetitions.

    Every document is taken floor(target / source size) times. What is left of the source's target is filled with documents in an order seeded by md5; the last of them is taken in part, so a source's words meet its target to within a word. The order is split in 4,096 slices of each source (by the md5's first digits), so no source is ordered in one task.

    Null or empty text: size 0, taken 0. Null source: a source of its own, the last. Equal rows: each counts. Empty table: no rows. Other columns are ignored.
    """
    sized = docs.select("doc_id", "source", F.size(ws_words(F.col("text"))).cast("long").alias("size"), F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("key")).withColumn("slice", F.substring("key", 1, 3)).checkpoint()
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("n")).checkpoint()
    plan = targets(slices.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")).withColumn("quota", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("slice")) - F.col("n")
    s, p = slices.withColumn("before", before).alias("s"), plan.alias("p")
    s = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select(F.col("s.source").alias("source"), "slice", "before", "source_size", "target", "whole", "quota").alias("s")
    d = sized.alias("d").join(s, F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.slice") == F.col("s.slice"))).select("doc_id", "d.source", "size", "key", "d.slice", "before", "source_size", "target", "whole", "quota")
    run = F.col("before") + F.sum("size").over(Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - run))
    return d.withColumn("taken", F.col("whole") * F.col("size") + part).select("doc_id", "size", "source_size", "target", "taken", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0).alias("repetitions"))


SQL = r"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
b AS (SELECT *, ([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1])::DOUBLE AS w, row_number() OVER (ORDER BY source IS NULL, source) AS rn, source_size * 2.0::DOUBLE AS cap FROM a),
c AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM b),
d AS (SELECT *, cap < w * level AS clamped, (SELECT level FROM c WHERE NOT cap < w * level ORDER BY cap / w, rn LIMIT 1) AS top FROM c),
t AS (SELECT source, source_size, CASE WHEN clamped OR top IS NULL THEN cap ELSE least(cap, w * top) END AS target FROM d),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
r AS (SELECT s.doc_id, s.size, u.source_size, u.target, u.whole, floor(u.target)::BIGINT - u.whole * u.source_size AS quota, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING)::BIGINT - s.size AS run FROM s JOIN u ON s.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, quota - run)))::BIGINT AS taken, CASE WHEN size > 0 THEN (whole * size + greatest(0, least(size, quota - run)))::DOUBLE / size ELSE 0.0::DOUBLE END AS repetitions FROM r
"""
