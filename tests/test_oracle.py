"""Every registered query against its SQL on the smallest test tables."""

import duckdb
import pytest
from conftest import DATA, TABLES

import __spark_entry__ as contract
from socialog.plans.catalog import catalog

QUERIES, SQL = ({n: getattr(q, part) for n, q in catalog().items()} for part in ("build", "sql"))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = [
        tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows
    ]
    return sorted(tidy, key=repr)


@pytest.fixture
def large_plans(settings):
    """No broadcast by size: joins take the form they have on large tables."""
    settings(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        }
    )


PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, large_plans, name):
    df = QUERIES[name](spark, DATA)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name == "rolling_p99" or not any(p in plan for p in PYTHON)
    found = oracle.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == canonical(columns, found.fetchall())
    assert got


def test_entry(spark):
    assert contract.entry(spark).columns == ["TargetFid", "follower_count"]
