"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import granary.plans.annotation  # noqa: F401
import granary.plans.derived  # noqa: F401
from granary.plans.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def norm(v):
    if isinstance(v, float) or hasattr(v, "as_tuple"):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, con, name):
    got = QUERIES[name](spark, DATA)
    want = con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_run(spark, tmp_path, name):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    QUERIES[name](spark, DATA).collect()


def test_partitioning_changes_nothing(spark):
    for name in ("risk_coverage", "vote_tally", "marker_topn_lfc"):
        seen = set()
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = QUERIES[name](spark, DATA)
            seen.add(tuple(rows(df.columns, df.collect())))
        assert len(seen) == 1
    spark.conf.set("spark.sql.shuffle.partitions", "4")
