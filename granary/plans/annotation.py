"""Registered queries of annotation evidence, summaries and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import expressions as X
from granary.operators import annotation as A
from granary.operators import consensus, graphs, metrics, numeric
from granary.operators.lineage import settled
from granary.plans.registry import _MARKERS, _MEANS, _TALLY, CELLS, COUNTS, LABELS, VOTERS, _markers, _values, _votes, query
from granary.sources import tables as T


@query(f"WITH {COUNTS}, {CELLS} SELECT grp || '_' || cell_id AS cell_id, gene_id, count FROM counts JOIN cells USING (cell_id) WHERE grp IN ('ASIA', 'EUROPE')")
def union_of_samples(s, d):
    c, x = T.counts(s, d), T.cells(s, d)
    some = lambda g: c.join(x.where(F.col("grp") == g).select("cell_id"), "cell_id").select("cell_id", "gene_id", "count")
    return A.union_samples([some("ASIA"), some("EUROPE")], ["ASIA", "EUROPE"])


@query(f"WITH {VOTERS} SELECT 'classifier' AS \"column\", count(*) FILTER (classifier IS NULL)::BIGINT AS n_missing, count(*) FILTER (classifier IS NULL) = 0 AS complete FROM voters UNION ALL SELECT 'knowledge', count(*) FILTER (knowledge IS NULL)::BIGINT, count(*) FILTER (knowledge IS NULL) = 0 FROM voters")
def annotation_completeness(s, d):
    return A.completeness(T.voters(s, d), ["classifier", "knowledge"])


@query(f"WITH {CELLS}, i AS (SELECT cluster, bool_or(status = 'P') AS include FROM cells WHERE cluster <> '5-LOW' GROUP BY 1) SELECT cluster, coalesce(include, true) AS include FROM (SELECT DISTINCT cluster FROM cells) LEFT JOIN i USING (cluster)")
def inclusion_stamp(s, d):
    c = T.cells(s, d)
    return A.stamp_inclusion(c.select("cluster").distinct(), c.where("cluster <> '5-LOW'").withColumn("include", F.col("status") == "P"), "cluster")


@query("SELECT p_partkey AS gene_id, p_size > 40 AS highly_variable FROM part")
def hvg_write_back(s, d):
    g = T.load(s, d, "part").select(F.col("p_partkey").alias("gene_id"), "p_size")
    return A.write_back(g.select("gene_id"), g.where("p_size > 40").withColumn("highly_variable", F.lit(True)))


_PANELS = "panels AS (SELECT p_partkey AS gene_id, p_brand AS panel FROM part UNION ALL SELECT p_partkey, 'extra' FROM part WHERE p_size > 45)"


def _panels(s, d):
    p = T.load(s, d, "part")
    return p.select(F.col("p_partkey").alias("gene_id"), F.col("p_brand").alias("panel")).unionAll(p.where("p_size > 45").select("p_partkey", F.lit("extra")))


@query(f"WITH {_PANELS} SELECT DISTINCT gene_id, panel FROM panels WHERE gene_id IN (SELECT gene_id FROM panels GROUP BY 1 HAVING count(DISTINCT panel) = 1)")
def panel_unique_genes(s, d):
    return A.unique_panel_genes(_panels(s, d))


@query("WITH b AS (SELECT p_brand AS panel, p_name AS gene, max(p_size) AS score FROM part GROUP BY 1, 2) SELECT panel, gene, score, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY panel ORDER BY score DESC, gene) AS r FROM b) WHERE r <= 40")
def panel_top_markers(s, d):
    m = T.load(s, d, "part").select(F.col("p_brand").alias("panel"), F.col("p_name").alias("gene"), F.col("p_size").alias("score"))
    return A.top_panel(m, "panel", "gene", "score", 40)


@query(f"WITH {_MEANS}, m AS (SELECT cluster, gene_id, round(s / 1e6::DOUBLE / n, 5) AS x FROM gm JOIN z USING (cluster)), zr AS (SELECT celltype, count(*) AS n FROM cells GROUP BY 1), r AS (SELECT celltype, gene_id, round(sum(round(value * 1e6)::BIGINT)::BIGINT / 1e6::DOUBLE / n, 5) AS y FROM lognorm JOIN cells USING (cell_id) JOIN zr USING (celltype) GROUP BY celltype, gene_id, n), k AS (SELECT cluster, celltype, rank() OVER (PARTITION BY cluster, celltype ORDER BY x) + (count(*) OVER (PARTITION BY cluster, celltype, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY cluster, celltype ORDER BY y) + (count(*) OVER (PARTITION BY cluster, celltype, y) - 1) / 2.0::DOUBLE AS ry FROM m JOIN r USING (gene_id)), c AS (SELECT cluster, celltype, round(corr(rx, ry), 5) AS rho, count(*)::BIGINT AS n_genes FROM k GROUP BY 1, 2) SELECT cluster, celltype, rho, n_genes FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY rho DESC, celltype) AS r FROM c) WHERE r = 1")
def reference_correlation(s, d):
    v, c = _values(s, d), T.cells(s, d)
    return A.reference_correlation(numeric.group_means(v, c, "cluster"), numeric.group_means(v, c, "celltype"), "cluster", "celltype")


@query(f"WITH {VOTERS}, a AS (SELECT cell_id, (classifier = truth)::INT AS classifier_agrees, (knowledge = truth)::INT AS knowledge_agrees, (literature = truth)::INT AS literature_agrees FROM voters) SELECT *, 2 + (knowledge_agrees IS NOT NULL)::INT AS tested, classifier_agrees + coalesce(knowledge_agrees, 0) + literature_agrees AS agree FROM a")
def voter_agreement_matrix(s, d):
    return A.agreement_matrix(T.voters(s, d), "cell_id", "truth", LABELS[:3])


@query(f"WITH {VOTERS}, l AS (SELECT cell_id, truth, unnest([classifier, knowledge, literature]) AS label, unnest(['classifier', 'knowledge', 'literature']) AS voter FROM voters) SELECT cell_id, voter, CASE WHEN label IS NULL THEN 'abstain' WHEN label = truth THEN 'agree' ELSE 'differ' END AS call FROM l")
def method_calls(s, d):
    return A.method_calls(T.voters(s, d), "cell_id", "truth", LABELS[:3])


@query(f"WITH {_MARKERS} SELECT cluster, array_to_string(list(gene_id::VARCHAR ORDER BY rank)[1:10], ', ') AS genes FROM markers GROUP BY 1")
def marker_display(s, d):
    return A.marker_display(_markers(s, d).withColumn("gene", F.col("gene_id").cast("string")), "cluster", "gene")


@query("WITH m AS (SELECT p_brand AS panel, upper(CASE p_size % 5 WHEN 0 THEN 'RPL' || p_size WHEN 1 THEN 'mt-co1' ELSE 'g' || p_size END) AS gene, min(p_partkey) AS rank FROM part GROUP BY 1, 2), k AS (SELECT * FROM m WHERE NOT regexp_matches(gene, '^(RPL\\d|MT-)')) SELECT panel, gene, r::INT AS rank FROM (SELECT panel, gene, row_number() OVER (PARTITION BY panel ORDER BY rank, gene) AS r FROM k) WHERE r <= 30")
def marker_cleaning(s, d):
    z = F.col("p_size") % 5
    gene = F.when(z == 0, F.concat(F.lit("RPL"), F.col("p_size").cast("string"))).when(z == 1, "mt-co1").otherwise(F.concat(F.lit("g"), F.col("p_size").cast("string")))
    return A.clean_markers(T.load(s, d, "part").select(F.col("p_brand").alias("panel"), gene.alias("gene"), F.col("p_partkey").alias("rank")), "panel", "gene")


@query(f"WITH {_TALLY} SELECT count(*)::BIGINT AS n, count(*) FILTER (unanimous)::BIGINT AS high, count(*) FILTER (majority)::BIGINT AS medium, count(*) FILTER (NOT unanimous AND NOT majority)::BIGINT AS low_review, 0::BIGINT AS unassigned FROM tally")
def consensus_summary(s, d):
    return A.tier_summary(consensus.decide(consensus.tally(_votes(s, d), "cell_id").withColumn("gate", F.lit("Other")), "gate"))


@query(f"WITH {VOTERS}, t AS (SELECT cell_id, classifier AS winner, literature AS open_label, confidence, cell_id % 3 = 0 AS closed, cell_id % 2 = 0 AS shaky FROM voters), u AS (SELECT *, closed AND shaky AND confidence >= 0.8 AND open_label <> winner AS deferred FROM t) SELECT cell_id, deferred, CASE WHEN deferred THEN open_label ELSE winner END AS winner FROM u")
def out_of_domain_deference(s, d):
    t = T.voters(s, d).select("cell_id", F.col("classifier").alias("winner"), F.lit(True).alias("majority"), F.col("literature").alias("open_label"), "confidence", (F.col("cell_id") % 3 == 0).alias("closed"), (F.col("cell_id") % 2 == 0).alias("shaky"))
    return consensus.deferred(t, "open_label", "confidence", "closed", "shaky").select("cell_id", "deferred", "winner")


@query("SELECT p_partkey AS id, '(' || p_name || ' OR ' || p_brand || ') AND \"disease\" AND \"tissue\" AND (\"cell type\" OR \"marker\") AND human' AS narrow, '(' || p_name || ' OR ' || p_brand || ') AND (\"cell type\" OR \"marker\") AND human' AS broad FROM part")
def literature_queries(s, d):
    q = A.query_ladder(F.array("p_name", "p_brand"), "disease", "tissue", "human")
    return T.load(s, d, "part").select(F.col("p_partkey").alias("id"), q[0].alias("narrow"), q[2].alias("broad"))


@query("WITH x AS (SELECT p_partkey AS id, p_size % 6 AS n, p_size % 3 AS c, p_size % 4 AS k, CASE p_size % 3 WHEN 0 THEN 0.9::DOUBLE WHEN 1 THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END AS base, CASE WHEN p_partkey % 10 = 0 THEN 'unknown' ELSE p_name END AS label, p_partkey % 4 AS a FROM part), y AS (SELECT *, base + CASE WHEN n >= 3 THEN 0.05::DOUBLE ELSE 0 END + CASE WHEN c >= 2 THEN 0.05::DOUBLE ELSE 0 END - CASE WHEN c = 0 THEN 0.2::DOUBLE ELSE 0 END - 0.1::DOUBLE * least(k, 2) AS s FROM x), z AS (SELECT id, label, c, CASE WHEN a = 0 THEN least(s, 0.25) ELSE s END AS s FROM y), w AS (SELECT id, label, CASE WHEN c = 0 THEN least(s, 0.6) ELSE s END AS s FROM z) SELECT id, round(greatest(0, least(1, CASE WHEN label = 'unknown' THEN least(s, 0.2) ELSE s END)), 6)::DOUBLE AS confidence FROM w")
def literature_confidence(s, d):
    z = F.col("p_size") % 3
    band = F.when(z == 0, "high").when(z == 1, "medium").otherwise("low")
    label = F.when(F.col("p_partkey") % 10 == 0, "unknown").otherwise(F.col("p_name"))
    c = X.evidence_confidence(band, F.col("p_size") % 6, z, F.col("p_size") % 4, label, F.col("p_partkey") % 4)
    return T.load(s, d, "part").select(F.col("p_partkey").alias("id"), F.round(c, 6).alias("confidence"))


@query("SELECT s_suppkey AS id, s_name AS cell_type, CASE WHEN s_suppkey % 4 = 0 THEN 0.0::DOUBLE WHEN s_suppkey % 4 = 1 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS confidence FROM supplier")
def reply_json(s, d):
    conf = F.when(F.col("s_suppkey") % 4 == 0, "bad").when(F.col("s_suppkey") % 4 == 1, "7").otherwise("0.25")
    reply = F.concat(F.lit('Sure: ```json\n{"cell_type": "'), "s_name", F.lit('", "confidence": "'), conf, F.lit('"}\n```'))
    x = T.load(s, d, "supplier").select(F.col("s_suppkey").alias("id"), A.extract_json(reply, "cell_type string, confidence string").alias("j"))
    return x.select("id", "j.cell_type", A.coerce_confidence(F.col("j.confidence")).alias("confidence"))


@query("SELECT p_partkey AS id, p_size % 3 = 0 AS flag, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size::DOUBLE END AS number FROM part")
def typed_columns(s, d):
    text = F.when(F.col("p_size") % 3 == 0, " True ").otherwise("no")
    num = F.when(F.col("p_size") % 4 == 0, " ").otherwise(F.col("p_size").cast("string"))
    return T.load(s, d, "part").select(F.col("p_partkey").alias("id"), A.coerce_flag(text).alias("flag"), A.coerce_number(num).alias("number"))


@query(f"WITH {VOTERS}, c AS (SELECT cell_id, unnest([0, 1, 2]) AS pos, unnest(['classifier', 'knowledge', 'literature']) AS source, unnest([classifier, knowledge, literature]) || ' sub' AS subtype, unnest([classifier, knowledge, literature]) AS parent, truth AS final FROM voters) SELECT cell_id, arg_min(source, pos) AS source, arg_min(subtype, pos) AS subtype FROM c WHERE parent = final AND (cell_id + pos) % 4 <> 0 GROUP BY 1")
def subtype_pick(s, d):
    v = T.voters(s, d)
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("source"), F.col(c).alias("parent")) for i, c in enumerate(LABELS[:3])]))
    c = v.select("cell_id", F.col("truth").alias("final"), rows.alias("x")).select("cell_id", "final", "x.*").withColumn("subtype", F.concat("parent", F.lit(" sub"))).withColumn("supported", (F.col("cell_id") + F.col("pos")) % 4 != 0)
    return A.pick_subtype(c, "cell_id")


_RULES = [("basal", ["K5", "K14"], ["V1"]), ("club", ["S1"], [])]


@query("WITH c AS (SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'Basal cell' WHEN 1 THEN 'club-like' ELSE 'other' END AS subtype, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 < 3 THEN ['K5', 'S1'] ELSE ['K5', 'V1'] END AS m FROM part) SELECT id, subtype, CASE WHEN m IS NULL OR subtype = 'other' THEN true WHEN subtype = 'Basal cell' THEN NOT list_contains(m, 'V1') ELSE list_contains(m, 'S1') END AS supported, CASE WHEN subtype = 'other' THEN 0 ELSE 1 END::BIGINT AS n_rules FROM c")
def subtype_rules(s, d):
    z, k = F.col("p_size") % 3, F.col("p_partkey") % 5
    m = F.when(k == 0, None).when(k < 3, F.array(F.lit("K5"), F.lit("S1"))).otherwise(F.array(F.lit("K5"), F.lit("V1")))
    c = T.load(s, d, "part").select(F.col("p_partkey").alias("id"), F.when(z == 0, "Basal cell").when(z == 1, "club-like").otherwise("other").alias("subtype"), m.alias("markers"))
    return A.rule_support(c, s.createDataFrame(_RULES, "token string, requires_any array<string>, contradicted_by array<string>"), "id")


@query(f"WITH {_MEANS}, m AS (SELECT cluster, gene_id, round(s / 1e6::DOUBLE / n, 5) AS mean, round(k / n, 6) AS detected FROM gm JOIN z USING (cluster)) SELECT *, CASE WHEN max(mean) OVER w - min(mean) OVER w > 0 THEN round((mean - min(mean) OVER w) / (max(mean) OVER w - min(mean) OVER w), 5) ELSE 0.0::DOUBLE END AS scaled FROM m WINDOW w AS (PARTITION BY gene_id)")
def marker_dotplot(s, d):
    """All genes."""
    return A.dotplot(_values(s, d), T.cells(s, d), T.genes(s, d), "cluster")


@query("WITH x AS (SELECT p_partkey AS gene_id, (p_partkey * 31 % 997) / 9970.0::DOUBLE AS padj, (p_size - 25) / 10.0::DOUBLE AS lfc FROM part), y AS (SELECT *, round(-log10(greatest(padj, 1e-300::DOUBLE)), 5) AS height, padj < 0.05 AND abs(lfc) > 1 AS significant FROM x) SELECT *, significant AND row_number() OVER (ORDER BY significant DESC, height DESC, abs(lfc) DESC, gene_id) <= 10 AS labelled FROM y")
def volcano_labels(s, d):
    return A.volcano(T.load(s, d, "part").select(F.col("p_partkey").alias("gene_id"), ((F.col("p_partkey") * 31 % 997) / F.lit(9970.0)).alias("padj"), ((F.col("p_size") - 25) / F.lit(10.0)).alias("lfc")))


@query(f"WITH {_MARKERS}, p AS (SELECT p_partkey AS gene_id, p_brand AS panel, p_size / 50.0::DOUBLE AS score FROM part), pz AS (SELECT panel, count(*) AS size FROM p GROUP BY 1), ps AS (SELECT cluster, panel, count(*)::BIGINT AS overlap, round(sum(1 + score) / sqrt(size), 5) AS score FROM (SELECT cluster, gene_id FROM markers) JOIN p USING (gene_id) JOIN pz USING (panel) GROUP BY cluster, panel, size HAVING count(*) >= 2), r AS (SELECT *, row_number() OVER w AS rank, round((score - coalesce(lead(score) OVER w, 0)) / score, 5) AS confidence FROM ps WINDOW w AS (PARTITION BY cluster ORDER BY score DESC, panel)) SELECT cluster, panel, overlap, score, rank::INT AS rank, confidence FROM r WHERE rank <= 3")
def marker_overlap_score(s, d):
    p = T.load(s, d, "part").select(F.col("p_partkey").alias("gene_id"), F.col("p_brand").alias("panel"), (F.col("p_size") / F.lit(50.0)).alias("score"))
    return A.overlap_score(_markers(s, d).select("cluster", "gene_id"), p, "cluster")


@query("SELECT p_partkey AS id, array_to_string(list_filter(regexp_split_to_array(p_type || ';' || p_name || '/' || p_brand, '[,\\s;/]+'), lambda x: x <> '')[1:4], ', ') AS genes FROM part")
def gene_string_subset(s, d):
    text = F.concat("p_type", F.lit(";"), "p_name", F.lit("/"), "p_brand")
    return T.load(s, d, "part").select(F.col("p_partkey").alias("id"), A.subset_genes(text, 4).alias("genes"))


@query("SELECT s_suppkey AS id, sha256('{\"model\":\"m\",\"user\":\"' || s_name || '\"}') AS key FROM supplier")
def response_cache_key(s, d):
    return T.load(s, d, "supplier").select(F.col("s_suppkey").alias("id"), A.cache_key(user=F.col("s_name"), model=F.lit("m")).alias("key"))


@query("WITH n AS (SELECT p_size AS resolution, count(DISTINCT p_brand)::BIGINT AS n_clusters FROM part GROUP BY 1) SELECT *, lag(n_clusters) OVER (ORDER BY resolution) AS previous, n_clusters - lag(n_clusters) OVER (ORDER BY resolution) AS gained FROM n")
def adjacent_resolutions(s, d):
    return A.compare_adjacent(T.load(s, d, "part").groupBy(F.col("p_size").alias("resolution")).agg(F.countDistinct("p_brand").alias("n_clusters")))


@query("SELECT p_brand AS vocabulary, p_type AS lineage, count(DISTINCT p_name)::BIGINT AS n_nodes FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), ())")
def alias_coverage(s, d):
    return A.coverage(T.load(s, d, "part").select(F.col("p_brand").alias("vocabulary"), F.col("p_type").alias("lineage"), F.col("p_name").alias("node_id")))


@query(f"WITH {COUNTS}, {CELLS}, m AS (SELECT cell_id, any_value(sample) AS sample, ln(1 + sum(count)) AS l, ln(1 + count(*)) AS g FROM counts JOIN cells USING (cell_id) GROUP BY 1), c AS (SELECT sample, median(l) AS ml, median(g) AS mg FROM m GROUP BY 1), x AS (SELECT cell_id, sample, l - ml AS dl, g - mg AS dg FROM m JOIN c USING (sample)), v AS (SELECT sample, median(abs(dl)) AS sl, median(abs(dg)) AS sg FROM x GROUP BY 1), z AS (SELECT cell_id, sample, least(dl / (1.4826::DOUBLE * sl + 1e-9::DOUBLE), dg / (1.4826::DOUBLE * sg + 1e-9::DOUBLE)) AS s FROM x JOIN v USING (sample)) SELECT cell_id, sample, round(s, 4) AS score, s > 2 AS doublet FROM z")
def doublet_scores(s, d):
    return A.doublet_scores(T.counts(s, d), T.cells(s, d))


@query("SELECT o_orderkey AS cell_id FROM orders ORDER BY (o_orderkey * 2654435761) % 4294967296, o_orderkey LIMIT 500")
def seeded_subsample(s, d):
    return T.load(s, d, "orders").select(F.col("o_orderkey").alias("cell_id")).orderBy(F.col("cell_id") * 2654435761 % 4294967296, "cell_id").limit(500)


@query(f"WITH {CELLS} SELECT cluster, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM cells GROUP BY 1 ORDER BY n DESC, cluster LIMIT 8")
def top_celltypes(s, d):
    n = T.cells(s, d).groupBy("cluster").agg(F.count("*").alias("n"))
    return n.join(n.agg(F.sum("n").alias("t"))).select("cluster", "n", F.round(F.col("n") / F.col("t"), 4).alias("share")).orderBy(F.desc("n"), "cluster").limit(8)


@query("WITH f AS (SELECT s_suppkey AS id, unnest(['a', 'b']) AS feature, unnest([s_acctbal / 1000, s_nationkey / 10.0::DOUBLE]) AS x FROM supplier), m AS (SELECT * FROM (VALUES ('u', 'a', 1.0::DOUBLE, 2.0::DOUBLE, 0.5::DOUBLE), ('u', 'b', 1.0, 1.0, -0.25), ('v', 'a', 0.0, 1.0, 0.125), ('v', 'b', 2.0, 4.0, 1.0)) t(class, feature, mean, scale, weight)), z AS (SELECT id, class, sum((x - mean) / scale * weight) + CASE class WHEN 'u' THEN 0.1::DOUBLE ELSE -0.1::DOUBLE END AS z FROM f JOIN m USING (feature) GROUP BY 1, 2), e AS (SELECT id, class, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z) SELECT id, class, round(e / sum(e) OVER (PARTITION BY id), 6) AS probability FROM e")
def linear_probabilities(s, d):
    x = T.load(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.explode(F.array(F.struct(F.lit("a").alias("feature"), (F.col("s_acctbal") / 1000).alias("x")), F.struct(F.lit("b").alias("feature"), (F.col("s_nationkey") / F.lit(10.0)).alias("x")))).alias("f")).select("id", "f.*")
    model = s.createDataFrame([("u", "a", 1.0, 2.0, 0.5), ("u", "b", 1.0, 1.0, -0.25), ("v", "a", 0.0, 1.0, 0.125), ("v", "b", 2.0, 4.0, 1.0)], "class string, feature string, mean double, scale double, weight double")
    return numeric.linear_probabilities(x, model, s.createDataFrame([("u", 0.1), ("v", -0.1)], "class string, b double"))


def _graph(s, d, k=10):
    return graphs.fuzzy(graphs.neighbours(T.load(s, d, "embeddings").select(F.col("vec_id").cast("long").alias("id"), "embedding"), k))


@query()
def approximate_neighbours(s, d):
    """About the 15 nearest of every vector."""
    return graphs.neighbours(T.load(s, d, "embeddings").select(F.col("vec_id").cast("long").alias("id"), "embedding"))


@query()
def neighbour_communities(s, d):
    """Modularity communities of the weighted graph of the ten nearest neighbours of every vector, at the fixed resolution 0.5."""
    return graphs.leiden(settled(_graph(s, d)), 0.5)


@query()
def mixed_cluster_refinement(s, d):
    """The labels of all vectors as clusters, each split where its own neighbours part it."""
    labels = T.load(s, d, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("string").alias("cluster"))
    return graphs.refine_mixed(settled(_graph(s, d)), labels, labels.select("cluster").distinct(), smallest=10)[0]


@query(f"WITH {VOTERS} SELECT 'truth' AS \"column\", truth AS label, count(*)::BIGINT AS n_cells FROM voters GROUP BY ALL UNION ALL SELECT 'knowledge', knowledge, count(*)::BIGINT FROM voters GROUP BY ALL")
def label_mapping_table(s, d):
    return metrics.union_all([T.voters(s, d).groupBy(F.lit(c).alias("column"), F.col(c).alias("label")).agg(F.count("*").alias("n_cells")) for c in ("truth", "knowledge")])




@query("WITH v AS (SELECT DISTINCT p_type AS node_id FROM part), l AS (SELECT DISTINCT CASE p_size % 4 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) || '(+)' WHEN 2 THEN p_type || '-CELLS' ELSE 'zzz' END AS label, p_type, p_size % 4 AS z FROM part) SELECT label, CASE WHEN z = 3 THEN NULL ELSE any_value(p_type) END AS node_id, CASE WHEN z = 3 THEN 0.0::DOUBLE WHEN z = 0 THEN 1.0::DOUBLE ELSE 0.95::DOUBLE END AS confidence, CASE WHEN z = 3 THEN 'unresolved' WHEN z = 0 THEN 'exact' ELSE 'normalised' END AS method FROM l GROUP BY label, z")
def label_resolver(s, d):
    from granary.operators import resolver

    p = T.load(s, d, "part")
    z = F.col("p_size") % 4
    labels = p.select(F.when(z == 0, F.col("p_type")).when(z == 1, F.concat(F.lower("p_type"), F.lit("(+)"))).when(z == 2, F.concat("p_type", F.lit("-CELLS"))).otherwise("zzz").alias("label"))
    v = p.select(F.col("p_type").alias("node_id")).distinct()
    aliases = v.select("node_id", F.col("node_id").alias("raw_label")).unionAll(v.select("node_id", F.concat("node_id", F.lit("+")))).unionAll(v.select("node_id", F.concat("node_id", F.lit(" cell"))))
    return resolver.resolve(labels, aliases, v.withColumn("level", F.lit(1))).drop("states")
