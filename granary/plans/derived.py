"""Registered queries of resolved labels, label trees, exact enrichment, and cells in component space."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import clusters, consensus, doublets, enrichment, gate, labels, numeric
from granary.operators.lineage import settled
from granary.plans.registry import _TREE, CELLS, LOGNORM, VOTERS, _tree, query
from granary.sources import cohorts
from granary.sources import tables as T

# ---- labels ----

_WORDED = "l AS (SELECT DISTINCT p_size % 4 AS z, lower(p_type) AS t, CASE p_size % 4 WHEN 0 THEN p_type WHEN 1 THEN p_type || ' T Lymphocytes' WHEN 2 THEN 'Cycling ' || p_type || ' Macs' ELSE 'EXHAUSTED ' || p_type || ' ECs' END AS label FROM part)"


def _worded(s, d):
    z, t = F.col("p_size") % 4, F.col("p_type")
    return T.load(s, d, "part").select(F.when(z == 0, t).when(z == 1, F.concat(t, F.lit(" T Lymphocytes"))).when(z == 2, F.concat(F.lit("Cycling "), t, F.lit(" Macs"))).otherwise(F.concat(F.lit("EXHAUSTED "), t, F.lit(" ECs"))).alias("label")).distinct()


@query(f"WITH {_WORDED} SELECT label, CASE z WHEN 0 THEN t WHEN 1 THEN t || ' t cell' WHEN 2 THEN 'cycling ' || t || ' macrophage' ELSE 'exhausted ' || t || ' endothelial' END AS normal, CASE z WHEN 0 THEN t WHEN 1 THEN t || ' t cell' WHEN 2 THEN t || ' macrophage' ELSE t || ' endothelial' END AS residual, CASE z WHEN 2 THEN 'cycling' WHEN 3 THEN 'exhausted' ELSE '' END AS states, CASE z WHEN 1 THEN 't' WHEN 2 THEN 'myeloid' END AS lineage FROM l")
def label_states(s, d):
    x = _worded(s, d).withColumn("normal", labels.normalise(F.col("label"))).withColumn("x", labels.states(F.col("normal")))
    return x.select("label", "normal", "x.residual", F.array_join("x.states", ";").alias("states"), labels.lineage_of(F.col("normal")).alias("lineage"))


_RESOLVED = "resolved AS (SELECT n_name AS label, CASE n_nationkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy' WHEN 2 THEN 'compartment' ELSE 'unresolved' END AS method, CASE n_nationkey % 4 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.9::DOUBLE WHEN 2 THEN 0.95::DOUBLE ELSE 0.0::DOUBLE END AS confidence, 'n' || n_nationkey AS node_id FROM nation), labels AS (SELECT DISTINCT c_mktsegment AS source, n_name AS label FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_AUDIT = f"{_RESOLVED}, audited AS (SELECT source, count(*)::BIGINT AS n_labels, coalesce(string_agg(label, ';' ORDER BY label) FILTER (method = 'unresolved'), '') AS unresolved, coalesce(string_agg(label, ';' ORDER BY label) FILTER (method = 'fuzzy'), '') AS near, coalesce(string_agg(label, ';' ORDER BY label) FILTER (method = 'compartment'), '') AS compartments FROM labels JOIN resolved USING (label) GROUP BY 1)"


def _resolved(s, d):
    z = F.col("n_nationkey") % 4
    return T.load(s, d, "nation").select(F.col("n_name").alias("label"), F.when(z == 0, "exact").when(z == 1, "fuzzy").when(z == 2, "compartment").otherwise("unresolved").alias("method"), F.when(z == 0, 1.0).when(z == 1, 0.9).when(z == 2, 0.95).otherwise(0.0).alias("confidence"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node_id"))


def _audited(s, d):
    c, n = T.load(s, d, "customer"), T.load(s, d, "nation")
    return labels.audit(c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_mktsegment").alias("source"), F.col("n_name").alias("label")), _resolved(s, d))


@query(f"WITH {_AUDIT} SELECT * FROM audited")
def label_audit(s, d):
    return _audited(s, d).select("source", "n_labels", *[F.array_join(c, ";").alias(c) for c in ("unresolved", "near", "compartments")])


@query(f"""WITH {_AUDIT} SELECT source, '    "' || replace(unresolved, ';', '": "",' || chr(10) || '    "') || '": "",' AS stub FROM audited WHERE unresolved <> ''""")
def alias_stubs(s, d):
    return labels.alias_stubs(_audited(s, d))


@query(f"WITH {CELLS}, {_RESOLVED}, c AS (SELECT DISTINCT sample FROM cells) SELECT sample AS cluster, CASE WHEN confidence >= 0.95 THEN 'CL:' || lpad(substr(node_id, 2), 7, '0') ELSE '' END AS cl_id, CASE WHEN confidence >= 0.95 THEN node_id ELSE '' END AS node_id, CASE WHEN confidence >= 0.95 THEN label ELSE '' END AS canonical_label FROM c JOIN resolved ON sample = label")
def ontology_maps(s, d):
    r = _resolved(s, d)
    nodes = r.select("node_id", F.concat(F.lit("CL:"), F.lpad(F.substring("node_id", 2, 9), 7, "0")).alias("cl_id"), "label")
    return labels.ontology_maps(T.cells(s, d).select(F.col("sample").alias("cluster"), F.col("sample").alias("label")).distinct(), r, nodes)


@query(f"WITH {VOTERS}, b AS (SELECT coalesce(CASE WHEN cell_id % 3 > 0 THEN truth END, CASE WHEN cell_id % 2 > 0 THEN grp END, 'Unresolved') AS truth, coalesce(knowledge, grp, 'Unresolved') AS predicted FROM voters) SELECT truth, count(*)::BIGINT AS n, (count(*) FILTER (truth = predicted))::BIGINT AS correct FROM b WHERE truth <> 'Unresolved' GROUP BY 1")
def benchmark_labels(s, d):
    x = F.col("cell_id")
    v = T.voters(s, d).select(labels.benchmark_label(F.when(x % 3 > 0, F.col("truth")), F.when(x % 2 > 0, F.col("grp"))).alias("truth"), labels.benchmark_label(F.col("knowledge"), F.col("grp")).alias("predicted"))
    return v.where(labels.evaluable(F.col("truth"))).groupBy("truth").agg(F.count("*").alias("n"), F.count_if(F.col("truth") == F.col("predicted")).alias("correct"))


@query("WITH x AS (SELECT s_suppkey AS id, s_acctbal / 10000 AS confidence, CASE s_nationkey % 3 WHEN 0 THEN 'pericyte' WHEN 1 THEN 't_cell' END AS main_type, 'Immune' AS lineage FROM supplier) SELECT id, CASE WHEN confidence < 0.95 THEN NULL WHEN main_type = 'pericyte' THEN 'Mural' ELSE lineage END AS gate FROM x")
def gate_lineages(s, d):
    z = F.col("s_nationkey") % 3
    return T.load(s, d, "supplier").select(F.col("s_suppkey").alias("id"), labels.gate_lineage(F.col("s_acctbal") / 10000, F.when(z == 0, "pericyte").when(z == 1, "t_cell"), F.lit("Immune")).alias("gate"))


# ---- label trees ----


@query(f"WITH {_TREE} SELECT node_id, path[1] AS root, path[2] AS branch, path[3] AS leaf FROM paths")
def tree_level_labels(s, d):
    paths = _tree(s, d)
    return labels.level_labels(paths, paths.select("node_id", F.col("node_id").alias("label")), ("root", "branch", "leaf"))


@query(f"WITH {_TREE}, p AS (SELECT node_id, path, path[-2] AS parent_id FROM paths), k AS (SELECT parent_id AS node_id, count(*) AS n FROM p GROUP BY 1), b AS (SELECT unnest(path) AS node_id FROM p), u AS (SELECT node_id, count(*) - 1 AS n FROM b GROUP BY 1), a AS (SELECT 'n' || c_nationkey AS node_id, count(*) AS n FROM customer GROUP BY 1) SELECT p.node_id, parent_id, (len(path) - 1)::INT AS level, array_to_string(path, '|') AS path, coalesce(k.n, 0)::BIGINT AS n_children, u.n::BIGINT AS n_descendants, coalesce(a.n, 0)::BIGINT AS n_aliases FROM p JOIN u USING (node_id) LEFT JOIN k USING (node_id) LEFT JOIN a USING (node_id)")
def tree_rows(s, d):
    paths = _tree(s, d)
    aliases = T.load(s, d, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("node_id"), F.col("c_name").alias("raw_label"))
    return labels.hierarchy_rows(paths.select("node_id", F.get("path", F.size("path") - 2).alias("parent_id")), paths, aliases)


@query("WITH n AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 = 1 THEN 'N-' ELSE 'n_' END || n_nationkey AS node_id FROM nation) SELECT node_id, unnest(list_filter([CASE WHEN k % 4 = 0 THEN 'duplicate id' END, CASE WHEN k % 5 = 1 THEN 'id is not snake case' END, CASE WHEN k % 7 = 3 THEN 'malformed ontology id' END, CASE WHEN k % 6 = 2 THEN 'no label' END, CASE WHEN k % 9 = 4 THEN 'no way to a root' END], lambda f: f IS NOT NULL)) AS fault FROM n")
def tree_faults(s, d):
    k = F.col("n_nationkey")
    n = T.load(s, d, "nation").select(F.concat(F.when(k % 5 == 1, "N-").otherwise("n_"), k.cast("string")).alias("node_id"), F.when(k % 9 == 4, "lost").alias("parent_id"), F.when(k % 7 == 3, "CL:12").otherwise("CL:0000001").alias("cl_id"), F.when(k % 6 == 2, " ").otherwise(F.col("n_name")).alias("label"), (k % 4 == 0).alias("twice"))
    nodes = n.drop("twice").unionAll(n.where("twice").drop("twice"))
    return labels.tree_faults(nodes, consensus.ancestors(nodes.select("node_id", "parent_id").distinct()))


@query("SELECT p_brand AS vocabulary, p_name AS raw_label, min(p_name) AS node_id FROM part GROUP BY 1, 2")
def alias_index(s, d):
    return labels.alias_index(T.load(s, d, "part").select(F.col("p_brand").alias("vocabulary"), F.col("p_name").alias("raw_label"), F.col("p_name").alias("node_id")))


# ---- enrichment ----


@query("WITH l AS (SELECT p_brand AS brand, p_partkey AS g FROM part WHERE p_size > 25), u AS (SELECT count(*) AS universe FROM part), s AS (SELECT p_type AS \"set\", count(*) AS size FROM part GROUP BY 1), n AS (SELECT brand, count(*) AS listed FROM l GROUP BY 1), o AS (SELECT brand, p_type AS \"set\", count(*) AS overlap, string_agg(g, ';' ORDER BY g) AS genes FROM l JOIN part ON g = p_partkey GROUP BY 1, 2), x AS (SELECT * FROM o JOIN s USING (\"set\") JOIN n USING (brand), u), t AS (SELECT brand, \"set\", overlap, size, listed, universe, genes, unnest(range(overlap, least(size, listed) + 1)) AS i FROM x) SELECT brand, \"set\", overlap::BIGINT AS overlap, size::BIGINT AS size, listed::BIGINT AS listed, universe::BIGINT AS universe, genes, round(least(1, sum(exp(lgamma(size + 1) - lgamma(i + 1) - lgamma(size - i + 1) + lgamma(universe - size + 1) - lgamma(listed - i + 1) - lgamma(universe - size - listed + i + 1) - lgamma(universe + 1) + lgamma(listed + 1) + lgamma(universe - listed + 1)))), 6)::DOUBLE AS p_value FROM t WHERE listed - i <= universe - size GROUP BY ALL")
def exact_over_representation(s, d):
    p = T.load(s, d, "part")
    gene = F.col("p_partkey").alias("gene_id")
    x = enrichment.over_represented(p.where("p_size > 25").select(F.col("p_brand").alias("brand"), gene), p.select(F.col("p_type").alias("set"), gene), p.select(gene), "brand")
    return x.select("brand", "set", "overlap", "size", "listed", "universe", "genes", F.round("p_value", 6).alias("p_value"))


_SIGNATURES = "m AS (SELECT DISTINCT p_brand AS brand, p_name AS gene FROM part WHERE p_size > 25), g AS (SELECT p_type AS signature, p_name AS gene, (min(p_size) % 8 / 4.0 - 1)::DOUBLE AS weight FROM part GROUP BY 1, 2)"


@query(f"WITH {_SIGNATURES} SELECT brand, signature, sum(weight) AS score, string_agg(gene, ';' ORDER BY weight DESC, gene DESC) AS hits FROM m JOIN g USING (gene) GROUP BY 1, 2")
def signature_scores(s, d):
    p = T.load(s, d, "part")
    g = p.groupBy(F.col("p_type").alias("signature"), F.col("p_name").alias("gene")).agg((F.min("p_size") % 8 / 4 - 1).alias("weight"))
    return enrichment.signature_scores(p.where("p_size > 25").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("gene")), g, "brand").withColumn("hits", F.array_join("hits", ";"))


@query("SELECT p_brand AS brand, p_name AS pathway, p_size / 50.0::DOUBLE AS padj, p_retailprice AS score FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_size, p_retailprice DESC) = 1")
def pathway_dedup(s, d):
    p = T.load(s, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("pathway"), (F.col("p_size") / 50).alias("padj"), F.col("p_retailprice").alias("score"), F.lit(None).cast("array<double>").alias("vector"))
    return enrichment.semantic_dedup(p, "brand").drop("vector")


@query("WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS celltype, p_type AS gene FROM part) SELECT celltype || ' cells' AS celltype, gene FROM w WHERE EXISTS (SELECT 1 FROM part WHERE p_size > 49 AND contains(lower(p_name), lower(celltype)))")
def relevant_markers(s, d):
    p = T.load(s, d, "part")
    panels = p.select(F.concat(F.substring_index("p_name", " ", 1), F.lit(" cells")).alias("celltype"), F.col("p_type").alias("gene")).distinct()
    return enrichment.relevant_markers(panels, p.where("p_size > 49").select(F.col("p_name").alias("label")))


# ---- clusters and cells ----


@query(f"WITH {CELLS} SELECT sample, count(*)::BIGINT AS n FROM cells GROUP BY 1 HAVING count(*) >= 60 AND count(*) % 2 = 0")
def mixed_cluster_order(s, d):
    n = T.cells(s, d).groupBy("sample").agg(F.count("*").alias("n"))
    return clusters.mixed_clusters(n.select("sample", (F.col("n") % 2 == 0).alias("mixed")), n, "sample")


@query("WITH c AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings), w AS (SELECT CASE WHEN avg(e[1]) FILTER (label = 0) <= avg(e[1]) THEN arg_min(id, {'x': e[1], 'i': id}) FILTER (label = 0) ELSE arg_max(id, {'x': e[1], 'i': id}) FILTER (label = 0) END AS id FROM c), t AS (SELECT a.id, list_distance(a.e, r.e) AS t FROM c a, c r JOIN w ON r.id = w.id) SELECT id, round(t / (SELECT max(t) FROM t), 6) AS pseudotime FROM t")
def root_pseudotime(s, d):
    c = T.load(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("components"))
    return clusters.pseudotime(c.drop("label"), clusters.root_cell(c, "label", 0)).withColumn("pseudotime", F.round("pseudotime", 6))


@query("SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(CAST(l_quantity AS BIGINT))::BIGINT AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2")
def deconvolution_counts(s, d):
    return cohorts.deconvolution_ready(T.counts(s, d), T.cells(s, d).where("status = 'F'"))[0]


_GATE = f"""{LOGNORM}, {CELLS}, p AS (SELECT p_brand AS panel, p_partkey AS gene_id FROM part), nc AS (SELECT count(*) AS n FROM cells), vm AS (SELECT gene_id, sum(round(value * 1e6)::BIGINT)::BIGINT AS s FROM lognorm GROUP BY 1), gb AS (SELECT gene_id, ntile(25) OVER (ORDER BY s, gene_id) AS bin FROM vm),
wanted AS (SELECT DISTINCT panel, bin FROM p JOIN gb USING (gene_id)), first AS (SELECT bin, gene_id FROM (SELECT bin, gene_id, row_number() OVER (PARTITION BY bin ORDER BY md5('0:' || gene_id), gene_id) AS r FROM gb) WHERE r <= 50),
ctl AS (SELECT panel, gene_id FROM wanted JOIN first USING (bin) ANTI JOIN p USING (panel, gene_id)), sets AS (SELECT panel, gene_id, true AS own FROM p UNION ALL SELECT panel, gene_id, false FROM ctl),
n AS (SELECT panel, count(*) FILTER (own) AS a, count(*) FILTER (NOT own) AS b FROM sets GROUP BY 1), x AS (SELECT cell_id, panel, coalesce(sum(round(value * 1e6)::BIGINT) FILTER (own), 0)::BIGINT AS a, coalesce(sum(round(value * 1e6)::BIGINT) FILTER (NOT own), 0)::BIGINT AS b FROM lognorm JOIN sets USING (gene_id) GROUP BY 1, 2),
sc AS (SELECT cells.cell_id, n.panel, round(coalesce(x.a, 0)::DOUBLE / greatest(n.a, 1) / 1e6::DOUBLE - coalesce(x.b, 0)::DOUBLE / greatest(n.b, 1) / 1e6::DOUBLE, 6) AS score FROM cells CROSS JOIN n LEFT JOIN x ON x.cell_id = cells.cell_id AND x.panel = n.panel),
r AS (SELECT cell_id, min((-score, panel)) AS best, min((-score, panel)) FILTER (panel <> 'Brand#1') AS other FROM sc GROUP BY 1), has AS (SELECT DISTINCT cell_id FROM counts JOIN p USING (gene_id) WHERE panel = 'Brand#1' AND gene_id % 2 = 1 AND count > 0),
c AS (SELECT r.cell_id, CASE WHEN best[2] = 'Brand#1' AND has.cell_id IS NULL AND -other[1] > 0.1 THEN other[2] ELSE best[2] END AS panel FROM r LEFT JOIN has ON has.cell_id = r.cell_id),
k AS (SELECT cluster, panel, count(*) AS n FROM c JOIN cells USING (cell_id) GROUP BY 1, 2), m AS (SELECT cluster, min((-n, panel)) AS m, sum(n)::BIGINT AS n_cells FROM k GROUP BY 1),
a AS (SELECT cluster, panel, round(sum(round(score * 1e6)::BIGINT)::BIGINT / count(*) / 1e6::DOUBLE, 5) AS score FROM sc JOIN cells USING (cell_id) GROUP BY 1, 2)"""


@query(f"WITH {_GATE} SELECT m.cluster, CASE WHEN score > 0.1 THEN panel ELSE 'Other' END AS lineage, score, n_cells FROM m JOIN a ON a.cluster = m.cluster AND a.panel = m.m[2]")
def lineage_score_gate(s, d):
    """Brands as panels; the first is gated on its genes of odd ids."""
    values, panels = settled(numeric.lognorm_micro(T.counts_by_cell(s, d))), T.genes(s, d).select(F.col("brand").alias("panel"), "gene_id")
    controls = settled(gate.control_genes(values.groupBy("gene_id").agg(F.sum("micro").alias("mean")), panels))
    marks = panels.where((F.col("panel") == "Brand#1") & (F.col("gene_id") % 2 == 1))
    return gate.gated_lineages(values, panels, controls, T.cells(s, d), "cluster", gated="Brand#1", marks=marks)


@query()
def simulated_doublets(s, d):
    """Doublets among all cells."""
    return doublets.doublets(s, T.counts(s, d), T.cells(s, d), follow=4)
