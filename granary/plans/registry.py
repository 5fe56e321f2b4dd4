"""Registered queries on the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import expressions as X
from granary.operators import cohort, consensus, metrics, numeric
from granary.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CELLS = "cells AS (SELECT o_orderkey AS cell_id, n_name AS sample, r_name AS grp, c_custkey AS donor, o_orderpriority AS cluster, c_mktsegment AS celltype, o_orderstatus AS status FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
COUNTS = "counts AS (SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(CAST(l_quantity AS BIGINT))::BIGINT AS count FROM lineitem GROUP BY 1, 2)"
GENES = "genes AS (SELECT p_partkey AS gene_id, p_name AS gene, p_brand AS brand, p_type AS family, p_brand = 'Brand#1' AS mito FROM part)"
VOTERS = f"{CELLS}, voters AS (SELECT cell_id, cluster, sample, grp, celltype AS truth, CASE WHEN cell_id % 10 < 8 THEN celltype ELSE 'AUTOMOBILE' END AS classifier, CASE WHEN cell_id % 7 = 0 THEN NULL WHEN cell_id % 7 < 5 THEN celltype ELSE 'BUILDING' END AS knowledge, CASE WHEN cell_id % 5 < 3 THEN celltype ELSE 'MACHINERY' END AS literature, 'FURNITURE' AS saturated, (cell_id * 37 % 101) / 100.0::DOUBLE AS confidence FROM cells)"
LOGNORM = f"{COUNTS}, lognorm AS (SELECT c.cell_id, c.gene_id, ln(1 + c.count * 1e4::DOUBLE / t.total) AS value FROM counts c JOIN (SELECT cell_id, sum(count)::BIGINT AS total FROM counts GROUP BY 1) t USING (cell_id))"
MICRO = "sum(round({} * 1e6)::BIGINT)::BIGINT"
LABELS = ["classifier", "knowledge", "literature", "saturated"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- sources and quality control ----


@query(f"WITH {COUNTS}, x AS (SELECT CASE gene_id % 11 WHEN 0 THEN count + 0.5 WHEN 1 THEN -count WHEN 2 THEN NULL WHEN 3 THEN 'nan'::DOUBLE ELSE count END::DOUBLE AS x FROM counts) SELECT count(*) FILTER (x IS NULL OR NOT isfinite(x))::BIGINT AS not_finite, count(*) FILTER (x < 0)::BIGINT AS negative, count(*) FILTER (isfinite(x) AND abs(x - round(x)) > 1e-8)::BIGINT AS not_integer FROM x")
def raw_count_check(s, d):
    """All three counts, on counts of which some genes' are spoiled."""
    g, n = F.col("gene_id") % 11, F.col("count").cast("double")
    return T.check_raw_counts(T.counts(s, d).withColumn("count", F.when(g == 0, n + 0.5).when(g == 1, -n).when(g == 2, None).when(g == 3, F.lit(float("nan"))).otherwise(n)))


_QC = f"{COUNTS}, {GENES}, m AS (SELECT cell_id, count(*)::BIGINT AS n_genes, sum(count)::BIGINT AS total_counts, sum(CASE WHEN mito THEN count ELSE 0 END)::BIGINT AS mito FROM counts JOIN genes USING (gene_id) WHERE count > 0 GROUP BY 1), qc AS (SELECT o_orderkey AS cell_id, coalesce(n_genes, 0) AS n_genes, coalesce(total_counts, 0) AS total_counts, 100.0::DOUBLE * mito / total_counts AS pct_mito FROM orders LEFT JOIN m ON o_orderkey = cell_id)"


def _qc(s, d):
    return cohort.qc_metrics(T.counts(s, d), T.genes(s, d), T.cells(s, d))


@query(f"WITH {_QC} SELECT cell_id, n_genes, total_counts, round(pct_mito, 6) AS pct_mito FROM qc")
def qc_metrics(s, d):
    return _qc(s, d).withColumn("pct_mito", F.round("pct_mito", 6))


@query(f"WITH {_QC} SELECT cell_id FROM qc WHERE n_genes > 1 AND n_genes < 7 AND pct_mito < 15")
def qc_filter(s, d):
    return cohort.qc_filter(_qc(s, d), min_genes=1, max_genes=7).select("cell_id")


@query(f"WITH {_QC} SELECT count(*)::BIGINT AS cells_in, count(*) FILTER (NOT n_genes > 1)::BIGINT AS below_min_genes, count(*) FILTER (NOT n_genes < 7)::BIGINT AS above_max_genes, count(*) FILTER (NOT coalesce(pct_mito < 15, false))::BIGINT AS above_max_mito, count(*) FILTER (n_genes > 1 AND n_genes < 7 AND coalesce(pct_mito < 15, false))::BIGINT AS cells_out FROM qc")
def qc_filter_report(s, d):
    return cohort.qc_report(_qc(s, d), min_genes=1, max_genes=7)


@query(f"WITH {COUNTS} SELECT gene_id, count(*)::BIGINT AS n_cells FROM counts WHERE count > 0 GROUP BY 1 HAVING count(*) >= 3")
def gene_min_cells(s, d):
    return cohort.gene_min_cells(T.counts(s, d))


@query(f"WITH {GENES} SELECT gene_id, CASE WHEN row_number() OVER (PARTITION BY gene ORDER BY gene_id) = 1 THEN gene ELSE gene || '-' || (row_number() OVER (PARTITION BY gene ORDER BY gene_id) - 1) END AS gene FROM genes")
def gene_unique_names(s, d):
    return cohort.unique_names(T.genes(s, d))


@query(f"WITH {CELLS} SELECT cell_id, sample FROM cells WHERE NOT (grp IS NULL OR trim(grp) = '' OR lower(trim(grp)) = 'nan' OR starts_with(trim(grp), '_'))")
def sample_exclusion(s, d):
    return T.cells(s, d).where(~X.excluded_group(F.col("grp"))).select("cell_id", "sample")


@query(f"WITH {COUNTS}, {CELLS} SELECT 'sample_in_one_group' AS \"check\", CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status, n FROM (SELECT count(*)::BIGINT AS n FROM (SELECT sample FROM cells GROUP BY 1 HAVING count(DISTINCT grp) > 1)) UNION ALL SELECT 'group_replication', CASE WHEN n = 0 THEN 'pass' ELSE 'warn' END, n FROM (SELECT count(*)::BIGINT AS n FROM (SELECT grp FROM cells GROUP BY 1 HAVING count(DISTINCT sample) < 2)) UNION ALL SELECT 'non_negative', CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END, n FROM (SELECT count(*)::BIGINT AS n FROM counts WHERE count < 0) UNION ALL SELECT 'cells_with_counts', CASE WHEN n = 0 THEN 'pass' ELSE 'fixed' END, n FROM (SELECT count(*)::BIGINT AS n FROM cells WHERE cell_id NOT IN (SELECT cell_id FROM counts WHERE count > 0)) UNION ALL SELECT 'unique_cells', CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END, n FROM (SELECT count(*)::BIGINT AS n FROM (SELECT cell_id FROM cells GROUP BY 1 HAVING count(*) > 1))")
def validation_checks(s, d):
    return cohort.validation_checks(T.counts(s, d), T.cells(s, d))


@query("SELECT event_id, user_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def json_properties(s, d):
    return T.load(s, d, "events").select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# ---- pseudobulk and design ----


@query(f"WITH {COUNTS}, {CELLS} SELECT sample, gene_id, sum(count)::BIGINT AS count FROM counts JOIN cells USING (cell_id) GROUP BY 1, 2")
def pseudobulk_sum(s, d):
    return cohort.pseudobulk(T.counts(s, d), T.cells(s, d), "sample", min_cells=1).select("sample", "gene_id", "count")


@query(f"WITH {COUNTS}, {CELLS} SELECT donor, gene_id, sum(count)::BIGINT AS count, any_value(n_cells) AS n_cells FROM counts JOIN cells USING (cell_id) JOIN (SELECT donor, count(*)::BIGINT AS n_cells FROM cells GROUP BY 1 HAVING count(*) >= 10) USING (donor) GROUP BY 1, 2")
def pseudobulk_min_cells(s, d):
    return cohort.pseudobulk(T.counts(s, d), T.cells(s, d), "donor").select("donor", "gene_id", "count", "n_cells")


@query(f"WITH {COUNTS}, {CELLS} SELECT sample, celltype, gene_id, sum(count)::BIGINT AS count FROM counts JOIN cells USING (cell_id) GROUP BY 1, 2, 3")
def pseudobulk_by_celltype(s, d):
    return cohort.pseudobulk(T.counts(s, d), T.cells(s, d), "sample", "celltype", min_cells=1).select("sample", "celltype", "gene_id", "count")


_BULK = f"{COUNTS}, {CELLS}, bulk AS (SELECT sample, any_value(grp) AS grp, gene_id, sum(count)::BIGINT AS count FROM counts JOIN cells USING (cell_id) GROUP BY 1, 3)"


@query(f"WITH {_BULK}, size AS (SELECT sample, grp, sum(count)::BIGINT AS total FROM bulk WHERE grp IN ('ASIA', 'EUROPE') GROUP BY 1, 2), arms AS (SELECT grp, count(*) AS n FROM size GROUP BY 1), x AS (SELECT b.grp, gene_id, sum(round(b.count * 1e4::DOUBLE / total, 6)::DECIMAL(28, 6))::DOUBLE AS s FROM bulk b JOIN size z USING (sample) GROUP BY 1, 2), y AS (SELECT gene_id, coalesce(max(CASE WHEN grp = 'EUROPE' THEN s / n END), 0.0::DOUBLE) AS focus_mean, coalesce(max(CASE WHEN grp = 'ASIA' THEN s / n END), 0.0::DOUBLE) AS reference_mean FROM x JOIN arms USING (grp) GROUP BY 1) SELECT *, round(log2((focus_mean + 1) / (reference_mean + 1)), 6) AS log2_fold_change, 'EUROPE' AS focus_group, 'ASIA' AS reference_group FROM y")
def pseudobulk_contrast(s, d):
    cells = T.cells(s, d)
    bulk = cohort.pseudobulk(T.counts(s, d), cells, "sample", min_cells=1).select("sample", "gene_id", "count")
    return cohort.contrast(bulk, cells.select("sample", "grp").distinct(), "EUROPE", "ASIA")


@query("WITH g AS (SELECT DISTINCT r_name AS x FROM region) SELECT b.x AS focus_group, a.x AS reference_group FROM g a JOIN g b ON a.x < b.x")
def group_pairs_oriented(s, d):
    return cohort.oriented_pairs(T.load(s, d, "region"), "r_name")


@query(f"WITH {CELLS} SELECT sample, count(DISTINCT grp)::BIGINT AS n_groups, min(grp) AS grp, count(*)::BIGINT AS n_cells FROM cells GROUP BY 1")
def sample_group_unique(s, d):
    return cohort.sample_groups(T.cells(s, d))


@query(f"WITH {CELLS} SELECT grp, count(DISTINCT sample)::BIGINT AS n_samples, count(DISTINCT sample) >= 2 AS replicated FROM cells GROUP BY 1")
def group_replication(s, d):
    return cohort.replication(T.cells(s, d))


@query(f"WITH {CELLS}, p AS (SELECT sample, count(DISTINCT grp) AS g, min(grp) AS one FROM cells GROUP BY 1) SELECT count(*)::BIGINT AS n_batches, max(g)::BIGINT AS most_groups, count(DISTINCT one)::BIGINT AS n_groups, CASE WHEN max(g) = 1 AND count(DISTINCT one) >= 2 THEN 'nested' ELSE 'crossed' END AS design FROM p")
def batch_nesting(s, d):
    return cohort.batch_design(T.cells(s, d), "sample", "grp")


@query(f"WITH {CELLS} SELECT grp, celltype, count(*)::BIGINT AS n_cells, sum(count(*)) OVER (PARTITION BY grp)::BIGINT AS total, round(count(*) / (sum(count(*)) OVER (PARTITION BY grp)), 6) AS fraction FROM cells GROUP BY 1, 2")
def celltype_fraction_by_group(s, d):
    return cohort.composition(T.cells(s, d), "grp", "celltype")


_PROP = f"{CELLS}, n AS (SELECT sample, status, count(*) AS n FROM cells GROUP BY 1, 2), prop AS (SELECT t.sample, l.status, coalesce(n.n, 0)::BIGINT AS n_cells, round(coalesce(n.n, 0) / t.total, 6) AS fraction FROM (SELECT sample, sum(n)::BIGINT AS total FROM n GROUP BY 1) t CROSS JOIN (SELECT DISTINCT status FROM n) l LEFT JOIN n ON n.sample = t.sample AND n.status = l.status)"


@query(f"WITH {_PROP} SELECT * FROM prop")
def donor_proportions_zero_filled(s, d):
    return cohort.donor_proportions(T.cells(s, d), "sample", "status")


_MW = "n AS (SELECT {by}, v, count(*) FILTER (arm = '{a}') AS k, count(*) AS t FROM x WHERE arm IN ('{a}', '{b}') GROUP BY {by}, v), r AS (SELECT *, sum(t) OVER (PARTITION BY {by} ORDER BY v) - (t - 1) / 2.0::DOUBLE AS rank FROM n), s AS (SELECT {by}, sum(rank * k)::DOUBLE AS r, sum(k)::BIGINT AS n1, sum(t)::BIGINT AS n, sum(t * t * t - t)::BIGINT AS ties, count(*) AS vals FROM r GROUP BY {by}), u AS (SELECT {by}, n1, n - n1 AS n2, r - n1 * (n1 + 1) / 2.0::DOUBLE AS u, sqrt(n1 * (n - n1) / 12.0::DOUBLE * (n + 1 - ties::DOUBLE / (n * (n - 1)))) AS sd, vals FROM s), z AS (SELECT *, greatest(abs(u - n1 * n2 / 2.0::DOUBLE) - 0.5::DOUBLE, 0) / sd / 1.4142135623730951::DOUBLE AS x FROM u)"
_TAIL = "(1 / (1 + 0.3275911::DOUBLE * {x})) * (0.254829592::DOUBLE + (1 / (1 + 0.3275911::DOUBLE * {x})) * (-0.284496736::DOUBLE + (1 / (1 + 0.3275911::DOUBLE * {x})) * (1.421413741::DOUBLE + (1 / (1 + 0.3275911::DOUBLE * {x})) * (-1.453152027::DOUBLE + (1 / (1 + 0.3275911::DOUBLE * {x})) * 1.061405429::DOUBLE)))) * exp(-{x} * {x})"


@query(f"WITH {_PROP.replace('n AS (SELECT sample', 'pn AS (SELECT sample').replace('FROM n)', 'FROM pn)').replace('FROM n GROUP', 'FROM pn GROUP').replace('LEFT JOIN n ON', 'LEFT JOIN pn n ON')}, x AS (SELECT status, fraction AS v, CASE WHEN sample IN (SELECT sample FROM cells WHERE grp = 'ASIA') THEN 'ASIA' WHEN sample IN (SELECT sample FROM cells WHERE grp = 'EUROPE') THEN 'EUROPE' END AS arm FROM prop), {_MW.format(by='status', a='ASIA', b='EUROPE')} SELECT status, n1, n2, u, CASE WHEN n1 < 3 OR n2 < 3 THEN NULL WHEN vals = 1 THEN 1.0::DOUBLE ELSE round(least({_TAIL.format(x='x')}, 1.0), 6) END AS p FROM z")
def mannwhitney_u(s, d):
    cells = T.cells(s, d)
    p = cohort.donor_proportions(cells, "sample", "status").join(cells.groupBy("sample").agg(F.min("grp").alias("arm")), "sample")
    return numeric.mann_whitney(p, "fraction", "arm", "ASIA", "EUROPE", "status")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"WITH {CELLS} SELECT sample, {', '.join(f'''count(*) FILTER (celltype = '{x}')::BIGINT AS "{x}"''' for x in SEGMENTS)} FROM cells GROUP BY 1")
def composition_crosstab(s, d):
    return cohort.crosstab(T.cells(s, d), "sample", "celltype", SEGMENTS)


@query(f"WITH {CELLS}, n AS (SELECT cluster, count(*) AS n FROM cells GROUP BY 1) SELECT count(*)::BIGINT AS n_clusters, min(n)::BIGINT AS smallest, median(n)::DOUBLE AS median_size, max(n)::BIGINT AS largest, count(*) FILTER (n < 3000)::BIGINT AS n_small, coalesce(sum(n) FILTER (n < 3000), 0)::BIGINT AS cells_in_small FROM n")
def cluster_size_stats(s, d):
    return cohort.cluster_sizes(T.cells(s, d), "cluster", 3000)


@query(f"WITH {CELLS}, t AS (SELECT sample, count(*) AS n FROM cells GROUP BY 1 ORDER BY n DESC, sample LIMIT 5) SELECT cell_id, sample FROM cells SEMI JOIN t USING (sample)")
def top_donor_subset(s, d):
    c = T.cells(s, d)
    return c.join(c.groupBy("sample").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sample").limit(5), "sample", "left_semi").select("cell_id", "sample")


# ---- consensus ----


@query(f"WITH {CELLS}, n AS (SELECT cluster, celltype, count(*) AS n FROM cells GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS p, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, celltype) AS r FROM n), o AS (SELECT cluster, max(celltype) FILTER (r = 1) AS dominant, round(max(p) FILTER (r = 1), 4) AS dominant_fraction, max(celltype) FILTER (r = 2) AS second, round(coalesce(max(p) FILTER (r = 2), 0.0::DOUBLE), 4) AS second_fraction, round(abs(sum(p * log2(p))), 4) AS entropy, count(*)::BIGINT AS n_labels FROM p GROUP BY 1) SELECT *, dominant_fraction < 0.7 OR second_fraction >= 0.2 AS mixed FROM o")
def cluster_mode_entropy(s, d):
    return consensus.mode_by_cluster(T.cells(s, d), "cluster", "celltype")


def _votes(s, d):
    return consensus.votes_long(T.voters(s, d), ["cell_id", "confidence"], LABELS[:3])


_TALLY = f"{VOTERS}, long AS (SELECT cell_id, confidence, unnest([classifier, knowledge, literature]) AS label, unnest(['classifier', 'knowledge', 'literature']) AS voter FROM voters), v AS (SELECT * FROM long WHERE label IS NOT NULL), per AS (SELECT cell_id, label, count(*)::BIGINT AS n, sum(round(confidence * 1000)::BIGINT)::BIGINT AS conf FROM v GROUP BY 1, 2), rk AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY n DESC, conf DESC, label) AS r, sum(n) OVER (PARTITION BY cell_id)::BIGINT AS total, max(n) OVER (PARTITION BY cell_id) AS top FROM per), td AS (SELECT *, sum(CASE WHEN n = top THEN 1 ELSE 0 END) OVER (PARTITION BY cell_id) > 1 AS tied FROM rk), pt AS (SELECT cell_id, string_agg(voter || '=' || label, '/' ORDER BY voter || '=' || label) AS pattern FROM v GROUP BY 1), tally AS (SELECT cell_id, label AS winner, n AS votes, total AS voters, tied, total >= 2 AND n = total AS unanimous, total >= 2 AND 2 * n > total AND n <> total AS majority, pattern FROM td JOIN pt USING (cell_id) WHERE r = 1)"


@query(f"WITH {_TALLY} SELECT * FROM tally")
def vote_tally(s, d):
    return consensus.tally(_votes(s, d), "cell_id")


@query(f"WITH {_TALLY} SELECT cell_id, winner, CASE WHEN unanimous THEN 'High' WHEN majority THEN 'Medium' ELSE 'Low/Review' END AS tier, CASE WHEN tied THEN 'Other' ELSE winner END AS consensus FROM tally")
def consensus_tiers(s, d):
    t = consensus.tally(_votes(s, d), "cell_id").withColumn("gate", F.lit("Other"))
    return consensus.decide(t, "gate").select("cell_id", "winner", "tier", "consensus")


@query(f"WITH {_TALLY} SELECT cell_id, NOT (NOT unanimous AND NOT majority) AS include FROM tally")
def inclusion_flag(s, d):
    t = consensus.decide(consensus.tally(_votes(s, d), "cell_id").withColumn("gate", F.lit("Other")), "gate")
    return cohort.inclusion(t, "tier").select("cell_id", "include")


@query(f"WITH {VOTERS}, long AS (SELECT unnest([classifier, knowledge, literature, saturated]) AS label, unnest(['classifier', 'knowledge', 'literature', 'saturated']) AS voter FROM voters), p AS (SELECT voter, label, count(*) AS n FROM long WHERE label IS NOT NULL GROUP BY 1, 2) SELECT voter, sum(n)::BIGINT AS called, max(n)::BIGINT AS modal, sum(n) >= 5 AND max(n) >= 0.8 * sum(n) AS saturated FROM p GROUP BY 1")
def saturated_voters(s, d):
    return consensus.saturated(consensus.votes_long(T.voters(s, d), ["cell_id"], LABELS))


@query("SELECT s_suppkey AS id, CASE WHEN max(a) OVER (PARTITION BY n) - min(a) OVER (PARTITION BY n) < 1e-12 THEN 0.5::DOUBLE ELSE (rank() OVER (PARTITION BY n ORDER BY a) + (count(*) OVER (PARTITION BY n, a) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY n) END AS pct FROM (SELECT s_suppkey, s_nationkey AS n, floor(s_acctbal / 1000) AS a FROM supplier)")
def confidence_percent_rank(s, d):
    x = T.load(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("n"), F.floor(F.col("s_acctbal") / 1000).alias("a"))
    return x.select("id", X.percent_rank_average("a", "n").alias("pct"))


@query(f"WITH {CELLS}, c AS (SELECT cluster, min(celltype) AS label FROM cells WHERE cluster <> '5-LOW' GROUP BY 1) SELECT cell_id, cluster, coalesce(label, 'Unassigned') AS label FROM cells LEFT JOIN c USING (cluster)")
def cluster_label_spread(s, d):
    c = T.cells(s, d)
    return consensus.spread(c, c.where("cluster <> '5-LOW'").groupBy("cluster").agg(F.min("celltype").alias("label")), "cluster", ["label"]).select("cell_id", "cluster", "label")


_KEYWORD = "CASE " + " ".join(f"WHEN regexp_matches(lower(name), '\\b({'|'.join(k)})(\\D|$)') THEN '{t}'" for t, _, k in consensus.KEYWORDS) + " ELSE 'Other: ' || name END"


@query(f"SELECT name, {_KEYWORD} AS resolved, count(*)::BIGINT AS n FROM (SELECT CASE p_size % 7 WHEN 0 THEN 'CD56 NK cell' WHEN 1 THEN 'Kupffer like' WHEN 2 THEN 'mast cell' WHEN 3 THEN 'basal cell' WHEN 4 THEN 'CAF' WHEN 5 THEN 'Plasma cells' ELSE p_name END AS name FROM part) GROUP BY 1, 2")
def label_harmonise(s, d):
    z = F.col("p_size") % 7
    name = F.when(z == 0, "CD56 NK cell").when(z == 1, "Kupffer like").when(z == 2, "mast cell").when(z == 3, "basal cell").when(z == 4, "CAF").when(z == 5, "Plasma cells").otherwise(F.col("p_name"))
    n = T.load(s, d, "part").select(name.alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return n.select("name", consensus.harmonise(F.col("name")).alias("resolved"), "n")


_TREE = "nodes AS (SELECT 'all' AS node_id, NULL AS parent_id UNION ALL SELECT 'r' || r_regionkey, 'all' FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation), paths AS (SELECT node_id, ['all'] AS path FROM nodes WHERE parent_id IS NULL UNION ALL SELECT node_id, ['all', node_id] FROM nodes WHERE parent_id = 'all' UNION ALL SELECT node_id, ['all', parent_id, node_id] FROM nodes WHERE starts_with(node_id, 'n'))"


def _tree(s, d):
    r, n = T.load(s, d, "region"), T.load(s, d, "nation")
    nodes = s.createDataFrame([("all", None)], "node_id string, parent_id string").unionAll(r.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")), F.lit("all"))).unionAll(n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))))
    return consensus.ancestors(nodes)


@query(f"WITH {_TREE} SELECT node_id, path[2] AS rolled FROM paths")
def tree_rollup(s, d):
    return consensus.rollup(_tree(s, d), 1)


@query(f"WITH {_TREE} SELECT node_id, (count(*) - 1)::BIGINT AS n_descendants FROM (SELECT unnest(path) AS node_id FROM paths) GROUP BY 1")
def tree_descendants(s, d):
    return consensus.subtree_sizes(_tree(s, d))


@query("WITH v AS (SELECT o_custkey % 97 AS item, n_nationkey, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) SELECT item, count(*)::BIGINT AS voters, CASE WHEN count(DISTINCT n_nationkey) = 1 THEN 'n' || min(n_nationkey) WHEN count(DISTINCT n_regionkey) = 1 THEN 'r' || min(n_regionkey) ELSE 'all' END AS lca, CASE WHEN count(DISTINCT n_nationkey) = 1 THEN 2 WHEN count(DISTINCT n_regionkey) = 1 THEN 1 ELSE 0 END AS level FROM v GROUP BY 1")
def tree_lca(s, d):
    """All orders vote."""
    v = T.load(s, d, "orders").join(T.load(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select((F.col("o_custkey") % 97).alias("item"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("node_id"))
    return consensus.lowest_common(v, "item", _tree(s, d))


# ---- benchmark metrics ----


@query(f"WITH {VOTERS} SELECT truth, classifier AS predicted, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY truth), 6) AS share FROM voters GROUP BY 1, 2")
def confusion_matrix(s, d):
    return metrics.confusion(T.voters(s, d), "truth", "classifier")


_F1 = f"{VOTERS}, c AS (SELECT truth AS class, count(*) AS support FROM voters GROUP BY 1), p AS (SELECT classifier AS class, count(*) AS called FROM voters GROUP BY 1), t AS (SELECT truth AS class, count(*) AS tp FROM voters WHERE truth = classifier GROUP BY 1), f1 AS (SELECT class, support::BIGINT AS support, CASE WHEN called > 0 THEN round(coalesce(tp, 0) / called, 6) ELSE 0.0::DOUBLE END AS precision, round(coalesce(tp, 0) / support, 6) AS recall, round(2 * coalesce(tp, 0) / (coalesce(called, 0) + support), 6) AS f1 FROM c LEFT JOIN p USING (class) LEFT JOIN t USING (class))"


@query(f"WITH {_F1} SELECT * FROM f1")
def per_class_f1(s, d):
    return metrics.per_class_f1(T.voters(s, d), "truth", "classifier")


@query(f"WITH {_F1} SELECT round(avg(f1), 5) AS macro_f1, count(*)::BIGINT AS n_classes, (SELECT count(*) FROM voters)::BIGINT AS n, (SELECT round(avg(CASE WHEN truth = classifier THEN 1.0::DOUBLE ELSE 0.0 END), 5) FROM voters) AS accuracy FROM f1")
def macro_f1(s, d):
    return metrics.macro_f1(T.voters(s, d), "truth", "classifier")


@query()
def macro_f1_bootstrap(s, d):
    return metrics.bootstrap_f1(T.voters(s, d), "truth", "classifier", "cell_id")


_SUB = {"classifier": ["classifier"], "knowledge": ["knowledge"], "literature": ["literature"], "classifier+knowledge": ["classifier", "knowledge"], "classifier+literature": ["classifier", "literature"], "knowledge+literature": ["knowledge", "literature"], "classifier+knowledge+literature": ["classifier", "knowledge", "literature"]}


def _vote_sql(some: list[str]) -> str:
    n = {c: " + ".join(f"CASE WHEN {c} = {o} THEN 1 ELSE 0 END" for o in some) for c in some}
    best = f"greatest({', '.join(n.values())}, 1)"
    return "CASE " + " ".join(f"WHEN {c} IS NOT NULL AND {n[c]} = {best} THEN {c}" for c in some) + " END"


@query(f"WITH {VOTERS} " + " UNION ALL ".join(f"SELECT '{k}' AS voters, count(*)::BIGINT AS n, count(*) FILTER (coalesce(({_vote_sql(v)}) = truth, false))::BIGINT AS hits, round(count(*) FILTER (coalesce(({_vote_sql(v)}) = truth, false)) / count(*), 6) AS accuracy FROM voters" for k, v in _SUB.items()))
def ablation_subsets(s, d):
    return metrics.ablation(T.voters(s, d), "truth", LABELS[:3])


def _curve(s, d):
    return metrics.risk_coverage(T.voters(s, d).withColumn("correct", F.col("truth") == F.col("classifier")), "correct", "confidence", "cell_id")


_CURVE = f"{VOTERS}, o AS (SELECT cell_id, truth = classifier AS hit, row_number() OVER (ORDER BY confidence DESC, cell_id) AS k, count(*) OVER () AS n FROM voters), curve AS (SELECT cell_id, k::BIGINT AS k, round(k / n, 6) AS coverage, round(sum(hit::INT) OVER (ORDER BY k) / k, 6) AS accuracy, round(1 - sum(hit::INT) OVER (ORDER BY k) / k, 6) AS error FROM o)"


@query(f"WITH {_CURVE} SELECT * FROM curve")
def risk_coverage(s, d):
    return _curve(s, d)


@query(f"WITH {_CURVE}, e AS (SELECT k, round(error * 1000000)::BIGINT AS e FROM curve) SELECT count(*)::BIGINT AS n, round((sum(e) - (arg_min(e, k) + arg_max(e, k)) / 2) / count(*) / 1e6, 5) AS aurc FROM e")
def aurc(s, d):
    return metrics.aurc(_curve(s, d))


@query(f"WITH {_CURVE} SELECT arg_min(error, k) AS risk FROM curve WHERE coverage >= 0.8")
def risk_at_coverage(s, d):
    return metrics.risk_at(_curve(s, d), 0.8)


_CAL = f"{VOTERS}, b AS (SELECT greatest(ceil(round(confidence * 10, 9)) - 1, 0)::INT AS bin, confidence, truth = classifier AS hit FROM voters), cal AS (SELECT bin, count(*)::BIGINT AS n, round(avg(round(confidence * 1000)::BIGINT) / 1000, 5) AS mean_confidence, round(avg(hit::INT), 5) AS accuracy FROM b GROUP BY 1), cg AS (SELECT *, round(abs(mean_confidence - accuracy), 5) AS gap FROM cal)"


def _calibrated(s, d):
    return metrics.calibration(T.voters(s, d).withColumn("correct", F.col("truth") == F.col("classifier")), "correct", "confidence")


@query(f"WITH {_CAL} SELECT * FROM cg")
def calibration_bins(s, d):
    return _calibrated(s, d)


@query(f"WITH {_CAL} SELECT round(sum(round(n * gap * 100000)::BIGINT) / sum(n) / 100000, 5) AS ece, max(gap) AS mce FROM cg")
def calibration_ece(s, d):
    return metrics.calibration_error(_calibrated(s, d))


@query(f"WITH {VOTERS}, l AS (SELECT cell_id, unnest([classifier, knowledge, literature]) AS label FROM voters), n AS (SELECT cell_id, label, count(*) AS n FROM l WHERE label IS NOT NULL GROUP BY 1, 2), p AS (SELECT cell_id, n / sum(n) OVER (PARTITION BY cell_id) AS p FROM n) SELECT cell_id, round(abs(sum(p * log2(p))), 5) AS entropy FROM p GROUP BY 1")
def vote_entropy(s, d):
    return metrics.vote_entropy(T.voters(s, d), "cell_id", LABELS[:3])


@query("WITH r AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0::DOUBLE AS b FROM part) SELECT count(*)::BIGINT AS n, round(corr(a, b), 5) AS rho FROM r")
def spearman(s, d):
    return metrics.spearman(T.load(s, d, "part"), "p_size", "p_retailprice")


@query(f"WITH {VOTERS}, l AS (SELECT truth, confidence, unnest([classifier, knowledge, literature]) AS label, unnest(['classifier', 'knowledge', 'literature']) AS method FROM voters), q AS (SELECT *, (label IS NULL OR label = truth OR confidence < 0.5) AS quiet FROM l) SELECT truth AS held_out, method, count(*)::BIGINT AS n, round(avg(quiet::INT), 6) AS abstention_rate, round(avg((NOT quiet)::INT), 6) AS confident_error_rate FROM q GROUP BY 1, 2")
def held_out_summary(s, d):
    return metrics.held_out(T.voters(s, d), "truth", LABELS[:3], "confidence")


@query(f"WITH {VOTERS}, l AS (SELECT unnest([truth, classifier, knowledge]) AS label, unnest(['truth', 'classifier', 'knowledge']) AS \"column\" FROM voters) SELECT \"column\", count(*)::BIGINT AS n, count(*) FILTER (label IS NULL)::BIGINT AS abstained, count(DISTINCT label)::BIGINT AS n_labels, round(count(*) FILTER (label IS NULL) / count(*), 6) AS abstained_fraction FROM l GROUP BY 1")
def label_resolution_report(s, d):
    return metrics.resolution(T.voters(s, d), ["truth", "classifier", "knowledge"])


@query(f"WITH {VOTERS}, n AS (SELECT truth AS a, literature AS b, count(*) AS n FROM voters GROUP BY 1, 2), r AS (SELECT a, sum(n) AS r FROM n GROUP BY 1), c AS (SELECT b, sum(n) AS c FROM n GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS n, (SELECT sum(n * (n - 1) / 2) FROM n) AS ij, (SELECT sum(r * (r - 1) / 2) FROM r) AS si, (SELECT sum(c * (c - 1) / 2) FROM c) AS sj, (SELECT -sum(r / x * ln(r / x)) FROM r, (SELECT sum(n)::DOUBLE AS x FROM n)) AS hr, (SELECT -sum(c / x * ln(c / x)) FROM c, (SELECT sum(n)::DOUBLE AS x FROM n)) AS hc, (SELECT sum(n / x * ln(n * x / (r * c))) FROM n JOIN r USING (a) JOIN c USING (b), (SELECT sum(n)::DOUBLE AS x FROM n)) AS mi FROM n) SELECT round((ij - si * sj / (n * (n - 1) / 2)) / ((si + sj) / 2 - si * sj / (n * (n - 1) / 2)), 6) AS ari, round(2 * mi / (hr + hc), 6) AS nmi FROM t")
def ari_nmi(s, d):
    return metrics.agreement(T.voters(s, d), "truth", "literature")


# ---- numbers ----


def _values(s, d):
    return numeric.lognorm(T.counts(s, d))


@query(f"WITH {LOGNORM} SELECT cell_id, gene_id, round(value, 6) AS value FROM lognorm")
def lognorm(s, d):
    return _values(s, d).withColumn("value", F.round("value", 6))


_MEANS = f"{LOGNORM}, {CELLS}, z AS (SELECT cluster, count(*) AS n FROM cells GROUP BY 1), gm AS (SELECT cluster, gene_id, {MICRO.format('value')} AS s, count(*) AS k FROM lognorm JOIN cells USING (cell_id) GROUP BY 1, 2)"


@query(f"WITH {_MEANS} SELECT cluster, gene_id, round(s / 1e6::DOUBLE / n, 5) AS mean, round(k / n, 6) AS detected FROM gm JOIN z USING (cluster)")
def lognorm_cluster_mean(s, d):
    return numeric.group_means(_values(s, d), T.cells(s, d), "cluster")


def _moments(s, d):
    return numeric.gene_moments(_values(s, d), T.cells(s, d).agg(F.count("*").alias("n")))


_MOM = f"{LOGNORM}, mo AS (SELECT gene_id, {MICRO.format('value')} / 1e6::DOUBLE / n AS mean, {MICRO.format('value * value')} / 1e6::DOUBLE / n AS q, n FROM lognorm, (SELECT count(*) AS n FROM orders) GROUP BY gene_id, n), moments AS (SELECT gene_id, mean, (q - mean * mean) * n / (n - 1) AS variance FROM mo)"


@query(f"WITH {_MOM} SELECT gene_id, round(mean, 6) AS mean, round(variance, 6) AS variance FROM moments")
def gene_moments(s, d):
    return _moments(s, d).select("gene_id", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"))


@query(f"WITH {_MOM}, b AS (SELECT gene_id, round(ln(variance / mean), 4) AS dispersion, ntile(20) OVER (ORDER BY round(mean, 4), gene_id)::INT AS bin FROM moments WHERE mean > 0 AND variance > 0), z AS (SELECT gene_id, bin, round((dispersion - avg(dispersion) OVER (PARTITION BY bin)) / stddev_samp(dispersion) OVER (PARTITION BY bin), 3) AS z FROM b) SELECT gene_id, bin, z, row_number() OVER (ORDER BY z DESC NULLS LAST, gene_id) <= 200 AS highly_variable FROM z")
def hvg_dispersion(s, d):
    return numeric.variable_genes(_moments(s, d))


@query(f"WITH {_MOM} SELECT cell_id, gene_id, round(least((value - mean) / sqrt(variance), 10.0), 4) AS z FROM lognorm JOIN moments USING (gene_id) WHERE variance > 0")
def zscore_clip(s, d):
    return numeric.scaled(_values(s, d), _moments(s, d))


_T = f"{LOGNORM}, {CELLS}, z AS (SELECT cluster, count(*)::BIGINT AS n FROM cells GROUP BY 1), g AS (SELECT cluster, gene_id, {MICRO.format('value')} AS s, {MICRO.format('value * value')} AS q, count(*) AS k FROM lognorm JOIN cells USING (cell_id) GROUP BY 1, 2), tt AS (SELECT gene_id, sum(s)::BIGINT AS ts, sum(q)::BIGINT AS tq FROM g GROUP BY 1), x AS (SELECT *, (SELECT sum(n)::BIGINT FROM z) - n AS n2, s / 1e6::DOUBLE / n AS m1, (ts - s) / 1e6::DOUBLE / ((SELECT sum(n)::BIGINT FROM z) - n) AS m2 FROM g JOIN z USING (cluster) JOIN tt USING (gene_id)), y AS (SELECT *, sqrt((q / 1e6::DOUBLE - n * m1 * m1) / (n - 1) / n + ((tq - q) / 1e6::DOUBLE - n2 * m2 * m2) / (n2 - 1) / n2) AS se FROM x), tested AS (SELECT cluster, gene_id, CASE WHEN se > 0 THEN round((m1 - m2) / se, 3) END AS t, round(log2((exp(m1) - 1 + 1e-9::DOUBLE) / (exp(m2) - 1 + 1e-9::DOUBLE)), 3) AS log2_fold_change, round(k / n, 6) AS detected FROM y)"


@query(f"WITH {_T} SELECT cluster, gene_id, t, log2_fold_change FROM tested")
def ttest_stats(s, d):
    return numeric.t_test(_values(s, d), T.cells(s, d), "cluster")


def _markers(s, d):
    v, c = _values(s, d), T.cells(s, d)
    return numeric.top_markers(numeric.t_test(v, c, "cluster").join(numeric.group_means(v, c, "cluster").select("cluster", "gene_id", "detected"), ["cluster", "gene_id"]), "cluster", 50, 0.002)


_MARKERS = f"{_T}, ok AS (SELECT *, max(detected >= 0.002) OVER (PARTITION BY cluster) AS lively FROM tested WHERE log2_fold_change > 0 AND t IS NOT NULL), rk AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY log2_fold_change DESC, t DESC, gene_id) AS rank FROM ok WHERE detected >= 0.002 OR NOT lively), markers AS (SELECT cluster, gene_id, rank::INT AS rank, log2_fold_change, t, detected FROM rk WHERE rank <= 50)"


@query(f"WITH {_MARKERS} SELECT * FROM markers")
def marker_topn_lfc(s, d):
    return _markers(s, d)


@query(f"WITH {_MARKERS}, pr AS (SELECT p_partkey AS gene_id, p_brand AS programme FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')), m AS (SELECT * FROM markers WHERE rank <= 15), n AS (SELECT cluster, count(*)::BIGINT AS n FROM m GROUP BY 1), h AS (SELECT cluster, programme, count(*) AS k FROM m JOIN pr USING (gene_id) GROUP BY 1, 2), o AS (SELECT cluster, programme FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY k DESC, programme DESC) AS r FROM h) WHERE r = 1), a AS (SELECT cluster, sum(k) AS k FROM h GROUP BY 1) SELECT cluster, n, round(coalesce(k, 0) / n, 4) AS state_fraction, coalesce(programme, '') AS dominant_programme, coalesce(k, 0) / n >= 0.4 AS state_dominated FROM n LEFT JOIN a USING (cluster) LEFT JOIN o USING (cluster)")
def state_fraction(s, d):
    pr = T.genes(s, d).where(F.col("brand").isin("Brand#1", "Brand#2", "Brand#3")).select("gene_id", F.col("brand").alias("programme"))
    return numeric.state_fraction(_markers(s, d), pr, "cluster")


@query(f"WITH {LOGNORM}, {CELLS}, v AS (SELECT gene_id, cluster, round(value, 6) AS v FROM lognorm JOIN cells USING (cell_id)), z AS (SELECT cluster, count(*)::BIGINT AS n1 FROM cells GROUP BY 1), nn AS (SELECT count(*)::BIGINT AS n FROM cells), vc AS (SELECT gene_id, v, count(*)::BIGINT AS t FROM v GROUP BY 1, 2), ar AS (SELECT gene_id, v, t, n, n - sum(t) OVER (PARTITION BY gene_id) AS zeros, n - sum(t) OVER (PARTITION BY gene_id) + sum(t) OVER (PARTITION BY gene_id ORDER BY v) - (t - 1) / 2.0::DOUBLE AS rank FROM vc, nn), ti AS (SELECT gene_id, (sum(t * t * t - t) + max(zeros::HUGEINT * zeros * zeros - zeros))::DOUBLE AS ties, max(zeros)::DOUBLE AS zeros FROM ar GROUP BY 1), sr AS (SELECT gene_id, cluster, sum(rank)::DOUBLE AS r, count(*) AS k FROM v JOIN ar USING (gene_id, v) GROUP BY 1, 2), u AS (SELECT cluster, gene_id, r + (n1 - k) * (zeros + 1) / 2 - n1 * (n1 + 1) / 2.0::DOUBLE AS u, n1::DOUBLE AS n1, (n - n1)::DOUBLE AS n2, n::DOUBLE AS n, ties FROM sr JOIN z USING (cluster) JOIN ti USING (gene_id), nn) SELECT cluster, gene_id, u, round((u - n1 * n2 / 2) / sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))), 4) AS z FROM u")
def rank_sum_markers(s, d):
    """All genes, all cells."""
    return numeric.rank_sum(_values(s, d).withColumn("value", F.round("value", 6)), T.cells(s, d), "cluster")


@query(f"WITH {COUNTS}, {CELLS}, p AS (SELECT p_partkey AS gene_id, p_brand AS panel FROM part), z AS (SELECT panel, count(*) AS genes FROM p GROUP BY 1), n AS (SELECT cluster, count(*) AS cells FROM cells GROUP BY 1), h AS (SELECT cluster, panel, count(*) AS k FROM counts JOIN p USING (gene_id) JOIN cells USING (cell_id) WHERE count > 0 GROUP BY 1, 2), s AS (SELECT cluster, panel, round(k / genes / cells, 6) AS score FROM h JOIN z USING (panel) JOIN n USING (cluster)), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, panel) AS r FROM s) SELECT cluster, CASE WHEN score >= 0.02 THEN panel ELSE 'Other' END AS lineage, score FROM r WHERE r = 1")
def panel_detection_fraction(s, d):
    return numeric.panel_scores(T.counts(s, d), T.genes(s, d).select("gene_id", F.col("brand").alias("panel")), T.cells(s, d), "cluster")


@query("WITH x AS (SELECT o_orderkey AS id, (o_orderkey * 7919 % 10007 + 1) / 10008.0::DOUBLE AS p FROM orders), r AS (SELECT id, p, row_number() OVER (ORDER BY p, id) AS r, count(*) OVER () AS n FROM x) SELECT id, p, round(least(1.0::DOUBLE, min(p * n / r) OVER (ORDER BY r DESC)), 6) AS q FROM r")
def bh_adjust(s, d):
    x = T.load(s, d, "orders").select(F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") * 7919 % 10007 + 1) / F.lit(10008.0)).alias("p"))
    return numeric.adjusted(x, "p", "id")


@query("WITH u AS (SELECT DISTINCT l_partkey AS gene_id FROM lineitem), g AS (SELECT l_partkey AS gene_id FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 800), s AS (SELECT p_brand AS set, p_partkey AS gene_id FROM part SEMI JOIN u ON p_partkey = u.gene_id), t AS (SELECT (SELECT count(*) FROM u)::DOUBLE AS universe, (SELECT count(*) FROM g)::DOUBLE AS listed), n AS (SELECT set, count(*)::DOUBLE AS size, count(*) FILTER (gene_id IN (SELECT gene_id FROM g))::DOUBLE AS overlap FROM s GROUP BY 1) SELECT set, overlap::BIGINT AS overlap, size::BIGINT AS size, listed::BIGINT AS listed, universe::BIGINT AS universe, round(((overlap + 0.5) * (universe - size - listed + overlap + 0.5)) / ((size - overlap + 0.5) * (listed - overlap + 0.5)), 5) AS odds_ratio, round((overlap - listed * size / universe) / sqrt(listed * size / universe * (universe - size) / universe * (universe - listed) / (universe - 1)), 5) AS z FROM n, t")
def ora_counts(s, d):
    li = T.load(s, d, "lineitem").select(F.col("l_partkey").alias("gene_id"), "l_quantity")
    heavy = li.groupBy("gene_id").agg(F.sum("l_quantity").alias("q")).where("q > 800")
    return numeric.over_representation(heavy, T.genes(s, d).select(F.col("brand").alias("set"), "gene_id"), li)


_PATH = "p AS (SELECT p_brand AS db, p_type AS pathway, (p_partkey * 31 % 997) / 997.0::DOUBLE AS padj, p_size AS score, p_partkey AS id FROM part)"


def _paths(s, d):
    return T.load(s, d, "part").select(F.col("p_brand").alias("db"), F.col("p_type").alias("pathway"), ((F.col("p_partkey") * 31 % 997) / F.lit(997.0)).alias("padj"), F.col("p_size").alias("score"), F.col("p_partkey").alias("id"))


def _first(df, by, order, k):
    from pyspark.sql.window import Window

    return df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("r") <= k)


@query(f"WITH {_PATH} SELECT db, pathway, id FROM (SELECT *, row_number() OVER (PARTITION BY db, pathway ORDER BY padj, score DESC, id) AS r FROM p) WHERE r = 1")
def pathway_dedup_exact(s, d):
    return _first(_paths(s, d), ["db", "pathway"], ["padj", F.desc("score"), "id"], 1).select("db", "pathway", "id")


@query(f"WITH {_PATH} SELECT db, pathway, id FROM (SELECT *, row_number() OVER (PARTITION BY db ORDER BY padj, score DESC, id) AS r FROM p) WHERE r <= 2 ORDER BY padj, score DESC, id LIMIT 10")
def top2_per_db(s, d):
    return _first(_paths(s, d), ["db"], ["padj", F.desc("score"), "id"], 2).orderBy("padj", F.desc("score"), "id").limit(10).select("db", "pathway", "id")


@query(f"WITH {_MARKERS}, de AS (SELECT cluster, gene_id, t FROM tested WHERE abs(t) >= 2), f AS (SELECT de.*, m.gene_id IS NOT NULL AS is_marker FROM de LEFT JOIN markers m USING (cluster, gene_id)) SELECT cluster, count(*)::BIGINT AS n_deg, count(*) FILTER (is_marker)::BIGINT AS n_markers, sum(CASE WHEN is_marker THEN 2 ELSE 1 END)::BIGINT AS score FROM f GROUP BY 1")
def de_marker_summary(s, d):
    de = numeric.t_test(_values(s, d), T.cells(s, d), "cluster").where(F.abs("t") >= 2).select("cluster", "gene_id")
    m = _markers(s, d).select("cluster", "gene_id", F.lit(True).alias("is_marker"))
    f = de.join(m, ["cluster", "gene_id"], "left").withColumn("is_marker", F.coalesce("is_marker", F.lit(False)))
    return f.groupBy("cluster").agg(F.count("*").alias("n_deg"), F.count_if("is_marker").alias("n_markers"), F.sum(F.when(F.col("is_marker"), 2).otherwise(1)).alias("score"))


@query("SELECT doc_id, coalesce(quality::VARCHAR, '') AS truth FROM documents LEFT JOIN labels USING (doc_id)")
def truth_join(s, d):
    return T.load(s, d, "documents").select("doc_id").join(T.load(s, d, "labels"), "doc_id", "left").select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("")).alias("truth"))


_KNN = "q AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))), 4) AS distance, b.label FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)"


def _vectors(s, d):
    return T.load(s, d, "embeddings").select(F.col("vec_id").cast("long").alias("id"), "embedding", "label")


@query(f"WITH {_KNN} SELECT id, neighbour, distance, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS r FROM q) WHERE r <= 15")
def knn_exact(s, d):
    v = _vectors(s, d)
    return numeric.nearest(v.where("id % 50 = 0"), v)


@query(f"WITH {_KNN} SELECT id, neighbour, distance, label, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id, label ORDER BY distance, neighbour) AS r FROM q) WHERE r <= 3")
def knn_batch_balanced(s, d):
    v = _vectors(s, d)
    return numeric.nearest(v.where("id % 50 = 0"), v, 3, "label")


@query("WITH x AS (SELECT vec_id AS id, label AS own, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS d FROM embeddings), c AS (SELECT own AS l, d, avg(x) AS c FROM x GROUP BY 1, 2), f AS (SELECT id, own, l, sqrt(sum((x - c) * (x - c))) AS dist FROM x JOIN c USING (d) GROUP BY 1, 2, 3), s AS (SELECT id, own, min(dist) FILTER (l = own) AS a, min(dist) FILTER (l <> own) AS b FROM f GROUP BY 1, 2) SELECT own AS label, count(*)::BIGINT AS n, round(avg((b - a) / greatest(a, b)), 4) AS silhouette FROM s GROUP BY 1")
def silhouette(s, d):
    return numeric.centroid_silhouette(_vectors(s, d).withColumn("embedding", F.col("embedding").cast("array<double>")), "label")


@query()
def pca(s, d):
    return numeric.principal_components(_vectors(s, d).withColumn("embedding", F.col("embedding").cast("array<double>")))


_ARMS = f"{COUNTS}, {CELLS}, bulk AS (SELECT grp || '-' || (cell_id % 2) AS sample, gene_id, sum(count)::BIGINT AS count FROM counts JOIN cells USING (cell_id) GROUP BY 1, 2)"


@query(f"WITH {_ARMS}, n AS (SELECT count(DISTINCT sample) AS n FROM bulk), g AS (SELECT gene_id, avg(ln(count)) AS ref FROM bulk, n WHERE count > 0 GROUP BY gene_id, n HAVING count(*) = n) SELECT sample, round(exp(quantile_cont(round(ln(count) - ref, 6), 0.5)), 5) AS size_factor FROM bulk JOIN g USING (gene_id) GROUP BY 1")
def size_factors(s, d):
    return numeric.size_factors(_arms(s, d))


def _arms(s, d):
    """Ten samples: region and half of its orders."""
    cells = T.cells(s, d).select("cell_id", F.concat_ws("-", "grp", (F.col("cell_id") % 2).cast("string")).alias("sample"))
    return cohort.pseudobulk(T.counts(s, d), cells, "sample", min_cells=1).select("sample", "gene_id", "count")


@query()
def pseudobulk_wald(s, d):
    b = _arms(s, d)
    return numeric.wald_moments(b, b.select("sample", F.substring_index("sample", "-", 1).alias("grp")).distinct(), numeric.size_factors(b), "EUROPE", "ASIA")


@query("SELECT DISTINCT p_type AS label, trim(regexp_replace(regexp_replace(p_type, '[<>:\"/\\\\|?*]', '_', 'g'), '[\\s_]+', '_', 'g'), '_. ') AS safe FROM part")
def safe_names(s, d):
    return T.load(s, d, "part").select(F.col("p_type").alias("label")).distinct().select("label", X.safe_name(F.col("label")).alias("safe"))


@query("SELECT o_orderkey AS id, CASE WHEN (o_orderkey % 1000) / 1000.0 < 0.001 THEN '***' WHEN (o_orderkey % 1000) / 1000.0 < 0.01 THEN '**' WHEN (o_orderkey % 1000) / 1000.0 < 0.05 THEN '*' ELSE 'ns' END AS stars FROM orders")
def significance_stars(s, d):
    return T.load(s, d, "orders").select(F.col("o_orderkey").alias("id"), X.stars((F.col("o_orderkey") % 1000) / 1000.0).alias("stars"))


@query("SELECT label, row_number() OVER (ORDER BY try_cast(label AS BIGINT) IS NULL, try_cast(label AS BIGINT), label)::INT AS pos FROM (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR ELSE p_type END AS label FROM part)")
def natural_sort(s, d):
    from pyspark.sql.window import Window

    x = T.load(s, d, "part").select(F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_type")).alias("label")).distinct()
    return x.withColumn("pos", F.row_number().over(Window.orderBy(*X.natural_key("label"))))
