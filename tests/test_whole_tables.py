"""Queries read all their rows."""

import re

import pytest

from granary.operators import metrics, numeric
from granary.plans.registry import QUERIES, SQL

from .test_oracles import DATA, con  # noqa: F401


def test_every_order_votes(spark, con):  # noqa: F811
    assert sum(r.voters for r in QUERIES["tree_lca"](spark, DATA).collect()) == con.sql("SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey").fetchall()[0][0]


@pytest.mark.parametrize("name", ["rank_sum_markers", "marker_dotplot"])
def test_every_gene_has_rows(spark, con, name):  # noqa: F811
    assert QUERIES[name](spark, DATA).select("gene_id").distinct().count() == con.sql("SELECT count(DISTINCT l_partkey) FROM lineitem").fetchall()[0][0]


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_query_or_sql_reads_a_share_of_its_rows(name):
    if name not in ("knn_exact", "knn_batch_balanced"):  # searches: a stated query set against all rows
        assert not re.search(r"(gene_id|orderkey|partkey|vec_id|\bid) % (20|50|100) = 0|gene_id <= \d", SQL[name])


def test_two_nodes_do_not_swap_labels(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    pairs = spark.createDataFrame([(2 * i, 2 * i + 1, 1.0) for i in range(20)], "src long, dst long, weight double")
    label = {r.id: r.label for r in numeric.label_propagation(pairs).collect()}
    assert all(label[2 * i] == label[2 * i + 1] for i in range(20))


def test_a_thousand_resamples(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "ab"[i % 3 % 2]) for i in range(12)], "id long, t string, p string")
    assert metrics.bootstrap_f1(df, "t", "p", "id").collect()[0].rounds == 1000
