"""Every registered query against its SQL counterpart on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from locusweave.plans import catalog, oracle

DATA = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(catalog.QUERIES) <= set(entry_module.queries())


def _key(row):
    return [(v is not None, v if not isinstance(v, float) or not math.isnan(v) else -math.inf) for v in row]


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, checker, name):
    df = entry_module.queries()[name](spark, DATA)
    sql = entry_module.oracle_sql()[name]
    described = {r[0]: r[1] for r in checker.execute("DESCRIBE " + sql).fetchall()}
    assert described == {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    columns = sorted(described)
    picked = ", ".join(f'"{c}"' for c in columns)
    want = checker.execute(f"SELECT {picked} FROM ({sql}) q").fetchall()
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


PYTHON_QUERIES = {
    "gwas_linear_regression", "gwas_covariate_regression", "gwas_with_quality_control", "genomic_inflation"}


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_plans_have_no_pairwise_join_and_no_stray_python(spark, name):
    plan = entry_module.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert ("ArrowEvalPython" in plan) == (name in PYTHON_QUERIES)


def test_entry_is_the_region_table(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns[0] == "chrom"
